"""Bank transaction normalization as Spark jobs (G1, G3, J5-J7, F4, F6, A4,
A10, X16, X17, M6).

The planned tool reads a CSV and normalizes row by row; here every step is a
column expression or a join, so one job handles any number of files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions.bank import CATEGORIES, category_check, clean_text
from corvid.functions.text import is_blank

# Merchant rules (pattern prefix of the cleaned, upper-cased
# description; lower priority number wins, then the longer pattern).
MERCHANT_PATTERNS = [
    ("UBER *TRIP", "Uber", "Transport", 1),
    ("UBER *EATS", "Uber Eats", "Food", 1),
    ("UBER", "Uber", "Transport", 2),
    ("99APP", "99", "Transport", 1),
    ("RCHLO*", "Riachuelo", "Shopping", 1),
    ("IFOOD", "iFood", "Food", 1),
    ("NETFLIX", "Netflix", "Subscriptions", 1),
    ("SPOTIFY", "Spotify", "Subscriptions", 1),
    ("PIX", "Pix Transfer", "Transfer", 1),
    ("DROGASIL", "Drogasil", "Health", 1),
    ("DROGA", "Droga Raia", "Health", 2),      # ends inside a word
    ("ENEL", "Enel", "Bills", 1),
    ("CINEMARK", "Cinemark", "Entertainment", 1),
    ("UDEMY", "Udemy", "Education", 1),
    ("MERCADOLIVRE", "Mercado Livre", "Shopping", 1),
    ("MERCADO", "Mercado", "Shopping", 3),
    ("PAO DE ACUCAR", "Pão de Açúcar", "Food", 1),
]

# Statement descriptions used to derive transactions, with the
# merchant and category a person would label them with.
DESCRIPTIONS = [
    ("UBER *TRIP SP", "Uber", "Transport"),
    ("UBER *TRIP BR", "Uber", "Transport"),
    ("UBER *EATS PENDING", "Uber Eats", "Food"),
    ("99APP *99POP", "99", "Transport"),
    ("RCHLO*Riachuelo", "Riachuelo", "Shopping"),
    ("IFOOD *RESTAURANTE BOM", "iFood", "Food"),
    ("NETFLIX.COM", "Netflix", "Subscriptions"),
    ("SPOTIFY BR", "Spotify", "Subscriptions"),
    ("PIX TRANSF MARIA S", "Pix Transfer", "Transfer"),
    ("DROGASIL 2231", "Drogasil", "Health"),
    ("ENEL SP CONTA LUZ", "Enel", "Bills"),
    ("CINEMARK SHOPPING", "Cinemark", "Entertainment"),
    ("UDEMY ONLINE", "Udemy", "Education"),
    ("MERCADOLIVRE*LOJA", "Mercado Livre", "Shopping"),
    ("PAO DE ACUCAR, LOJA 045", "Pão de Açúcar", "Food"),
    ("PADARIA SÃO JOSÉ", "Padaria São José", "Food"),
    ("TARIFA BANCÁRIA", "Tarifa Bancária", "Bills"),
    ("DROGARAIA 118", "Droga Raia", "Health"),
    ("MERCADOX 24H", "Mercado", "Shopping"),
]

# Noise rules: (modulus, remainder) on the row id.
NOISE_SPACES = (7, 3)
NOISE_SPECIAL = (11, 5)
NOISE_NO_AMOUNT = (13, 7)
NOISE_NO_DATE = (17, 2)
NOISE_BLANK_DESC = (19, 4)
NOISE_BAD_DATE = (23, 9)
NOISE_ALT_DATE = (5, 1)
NOISE_BRACKETS = (29, 6)
NOISE_MINUS = (31, 8)
NOISE_BAD_AMOUNT = (37, 10)
NOISE_BAD_ID = (41, 11)
NOISE_SURPLUS = (43, 12)
# Dates and amounts that must be rejected, picked by row id.
BAD_DATES = ["00/00/0000", "15Mar", "x", "2024-13-45", "31/31", "/"]
BAD_AMOUNTS = ["12abc34", "1e5", "--5", "1.2.3,4,5", "R$", "(5"]
BAD_ID_TEXT = "N/A"


def _hit(row_id, rule):
    return F.pmod(row_id, F.lit(rule[0])) == rule[1]


def _pick(texts, row_id):
    return F.element_at(F.array(*[F.lit(t) for t in texts]),
                        (F.pmod(row_id, F.lit(len(texts))) + 1).cast("int"))


def pattern_table(spark: SparkSession, patterns=MERCHANT_PATTERNS) -> DataFrame:
    return spark.createDataFrame(list(patterns), "pattern string, merchant string, "
                                                 "category string, priority int")


def description_table(spark: SparkSession) -> DataFrame:
    rows = [(i, d, m, c) for i, (d, m, c) in enumerate(DESCRIPTIONS)]
    return spark.createDataFrame(rows, "desc_idx int, description string, gold_merchant string, "
                                       "gold_category string")


def bank_gold(spark: SparkSession, orders: DataFrame, banks: Sequence[str]) -> DataFrame:
    """Truth derived from ``orders``: ``row_id, bank, year, date, description,
    amount, gold_merchant, gold_category`` (date as DATE)."""
    bank_arr = F.array(*[F.lit(b) for b in banks])
    o = orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.element_at(bank_arr, (F.pmod(F.col("o_orderkey"), F.lit(len(banks))) + 1).cast("int"))
        .alias("bank"),
        F.to_date("o_orderdate").alias("date"),
        (-F.col("o_totalprice")).alias("amount"),
        F.pmod(F.col("o_custkey"), F.lit(len(DESCRIPTIONS))).cast("int").alias("desc_idx"))
    # DESCRIPTIONS is a fixed table of a few rows: broadcast is bounded.
    return (o.join(F.broadcast(description_table(spark)), "desc_idx")
            .withColumn("year", F.year("date")).drop("desc_idx"))


def synthesize(seed: DataFrame, variants: int) -> DataFrame:
    """G1: ``variants`` synthetic rows per labelled seed row. Date, amount and
    description are varied by integer arithmetic on ids (deterministic,
    embarrassingly parallel: no shuffle)."""
    desc = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(m).alias("m"), F.lit(c).alias("c"))
                     for d, m, c in DESCRIPTIONS])
    v = F.col("v")
    pick = F.element_at(desc, (F.pmod(F.col("row_id") + v * 5, F.lit(len(DESCRIPTIONS))) + 1)
                        .cast("int"))
    return (seed.select("*", F.explode(F.sequence(F.lit(0), F.lit(variants - 1))).alias("v"))
            .select(
                (F.col("row_id") * variants + v).alias("synth_id"),
                F.col("row_id").alias("seed_id"),
                F.date_add("date", F.pmod(F.col("row_id") * 7 + v * 13, F.lit(28)).cast("int"))
                .alias("date"),
                (F.col("amount") - v * F.lit(1.25)).alias("amount"),
                pick["d"].alias("description"), pick["m"].alias("gold_merchant"),
                pick["c"].alias("gold_category")))


def inject_noise(rendered: DataFrame) -> DataFrame:
    """Extra whitespace, special characters, a second date form, other
    spellings of a negative amount, missing and broken fields, broken ids and
    surplus cells (``surplus``: the row gets one cell too many in its file)."""
    rid = F.col("row_id")
    d = F.col("description_s")
    desc = (F.when(_hit(rid, NOISE_BLANK_DESC), F.lit("   "))
            .when(_hit(rid, NOISE_SPACES),
                  F.concat(F.lit("  "), F.regexp_replace(d, " ", "   "), F.lit(" ")))
            .when(_hit(rid, NOISE_SPECIAL), F.concat(F.lit("\u00a0"), d, F.lit(" ##")))
            .otherwise(d))
    date = (F.when(_hit(rid, NOISE_NO_DATE), F.lit(None).cast("string"))
            .when(_hit(rid, NOISE_BAD_DATE), _pick(BAD_DATES, rid))
            .when(_hit(rid, NOISE_ALT_DATE), F.col("alt_date_s"))
            .otherwise(F.col("date_s")))
    a = F.col("amount_s")
    amount = (F.when(_hit(rid, NOISE_NO_AMOUNT), F.lit(None).cast("string"))
              .when(_hit(rid, NOISE_BAD_AMOUNT), _pick(BAD_AMOUNTS, rid))
              .when(_hit(rid, NOISE_BRACKETS), F.concat(F.lit("("), F.replace(a, F.lit("-"), F.lit("")), F.lit(")")))
              # U+2212 is not in the single-byte encoding of one layout
              .when(_hit(rid, NOISE_MINUS) & (F.col("bank") != "itau"), F.replace(a, F.lit("-"), F.lit("\u2212")))
              .otherwise(a))
    ids = F.when(_hit(rid, NOISE_BAD_ID), F.lit(BAD_ID_TEXT)).otherwise(F.col("id_s"))
    return (rendered.withColumn("description_s", desc).withColumn("date_s", date)
            .withColumn("amount_s", amount).withColumn("id_s", ids)
            .withColumn("surplus", _hit(rid, NOISE_SURPLUS)).drop("alt_date_s"))


def rule_buckets(rules: DataFrame) -> DataFrame:
    """Rules as ``(_bucket, _rules)``: keyed by as many leading characters as
    every rule has, each bucket in the order rules win (priority, longer
    pattern, pattern text). One row for each distinct leading text."""
    text = F.upper("pattern")
    width = rules.agg(F.min(F.length("pattern")).alias("_w"))       # one row
    entry = F.struct("priority", (-F.length("pattern")).alias("short"), "pattern",
                     "merchant", "category")
    return (rules.crossJoin(F.broadcast(width))
            .groupBy(F.substring(text, F.lit(1), F.col("_w")).alias("_bucket"), "_w")
            .agg(F.sort_array(F.collect_list(entry)).alias("_rules")))


def match_merchant(spark: SparkSession, tx: DataFrame, desc_col: str = "description_clean",
                   patterns: DataFrame | Sequence[tuple] = MERCHANT_PATTERNS) -> DataFrame:
    """Merchant, category and matched pattern from a rule table of any size.

    A rule applies when its pattern is a prefix of the upper-cased description,
    also inside a word. All rules share a key width (the shortest pattern), so a
    description meets exactly the bucket of its own leading characters, and the
    first rule that fits is chosen inside the row. The transactions are joined
    once with the bucket table: a short table is broadcast by Spark's own size
    check and nothing moves, a long one joins by key and Spark splits a hot key.
    No match: the text in title case, ``Other``.
    """
    rules = patterns if isinstance(patterns, DataFrame) else pattern_table(spark, patterns)
    d = F.col(desc_col)
    up = F.upper(d)
    buckets = rule_buckets(rules)
    width = buckets.agg(F.max("_w").alias("_width"))                 # one row
    j = (tx.crossJoin(F.broadcast(width))
         .withColumn("_key", F.substring(up, F.lit(1), F.col("_width")))
         .join(buckets.drop("_w"), F.col("_key") == F.col("_bucket"), "left"))
    best = F.get(F.filter("_rules", lambda c: up.startswith(F.upper(c["pattern"]))), 0)
    return (j.withColumn("_best", best)
            .withColumn("merchant", F.coalesce(F.col("_best.merchant"), F.initcap(F.lower(d))))
            .withColumn("category", F.when(d.isNull(), F.lit(None))
                        .otherwise(F.coalesce(F.col("_best.category"), F.lit("Other"))))
            .withColumn("matched_pattern", F.col("_best.pattern"))
            .drop("_best", "_key", "_bucket", "_rules", "_width"))


def validate(df: DataFrame) -> DataFrame:
    """add ``reason`` (NULL = valid): the first failed rule."""
    reason = (F.when(F.col("corrupt").isNotNull(), F.lit("bad_row"))
              .when(F.col("row_id").isNull(), F.lit("bad_id"))
              .when(F.col("date").isNull(), F.lit("bad_date"))
              .when(F.col("amount").isNull(), F.lit("bad_amount"))
              .when(is_blank(F.col("description_raw")), F.lit("blank_description"))
              .when(category_check(F.col("category")) != F.col("category"), F.lit("bad_category")))
    return df.withColumn("reason", reason)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two filters on the reason: nothing is dropped."""
    return df.filter(F.col("reason").isNull()), df.filter(F.col("reason").isNotNull())


def normalize_transactions(spark: SparkSession, raw: DataFrame) -> DataFrame:
    """M6: canonical read -> clean -> merchant/category -> validate.

    Output: ``row_id, bank, year, file, date, merchant, description, amount,
    category, reason`` and the raw cells; description stays the raw text. Every
    input row comes out once, valid or with a reason."""
    t = raw.withColumn("description_clean", clean_text(F.col("description_raw")))
    t = match_merchant(spark, t)
    t = validate(t)
    return t.select("row_id", "bank", "year", "file", "date", "merchant",
                    F.col("description_raw").alias("description"), "amount", "category",
                    "reason", "id_raw", "date_raw", "amount_raw")


RAW_KEY = ("file", "id_raw", "date_raw", "description_raw", "amount_raw")


def completeness(inp: DataFrame, out: DataFrame, key: Sequence[str] = RAW_KEY) -> DataFrame:
    """Rows in, valid, rejected and missing, as one row of counts.

    Rows are identified by the file and the raw cells, so that rows without a
    readable id count too; equal rows are counted, not merged. One aggregation
    over both sides, no join."""
    zero, one = F.lit(0), F.lit(1)
    valid = F.col("reason").isNull().cast("int")
    both = inp.select(*key, one.alias("i"), zero.alias("v"), zero.alias("r")).unionAll(
        out.select(*key, zero.alias("i"), valid.alias("v"), (one - valid).alias("r")))
    per = both.groupBy(*key).agg(*[F.sum(c).alias(c) for c in ("i", "v", "r")])
    return per.agg(F.sum("i").alias("n_input"), F.sum("v").alias("n_valid"),
                   F.sum("r").alias("n_rejected"),
                   F.sum(F.greatest(F.col("i") - F.col("v") - F.col("r"), zero)).alias("n_missing"))


def holdout_files(df: DataFrame, held: Sequence[tuple[str, int]]) -> DataFrame:
    """add ``split`` (test or train) by whole files, given as (bank, year):
    a flag on each row, without a second scan or a join."""
    hit = F.lit(False)
    for bank, year in held:
        hit = hit | ((F.col("bank") == bank) & (F.col("year") == year))
    return df.withColumn("split", F.when(hit, F.lit("test")).otherwise(F.lit("train")))


def compare_gold(pred: DataFrame, gold: DataFrame, key: str = "row_id") -> DataFrame:
    """J6 + A4: full outer join on the row id (a missing side is wrong), then
    the four per-field exact-match rates."""
    p = pred.select(key, *[F.col(c).alias(f"p_{c}") for c in
                           ("bank", "date", "merchant", "amount", "category")])
    g = gold.select(key, *[F.col(c).alias(f"g_{c}") for c in
                           ("bank", "date", "merchant", "amount", "category")])
    j = p.join(g, key, "full_outer")

    def rate(eq):
        return F.round(F.avg(F.coalesce(eq, F.lit(False)).cast("double")), 6)

    return j.groupBy(F.coalesce("g_bank", "p_bank").alias("bank")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("g_bank").alias("n_gold"), F.count("p_bank").alias("n_pred"),
        rate(F.col("p_date") == F.col("g_date")).alias("date_match"),
        rate(F.lower(F.col("p_merchant")) == F.lower(F.col("g_merchant"))).alias("merchant_match"),
        rate(F.col("p_category") == F.col("g_category")).alias("category_match"),
        rate(F.col("p_amount") == F.col("g_amount")).alias("amount_match"))


def response_json() -> Column:
    """The JSON target of a normalized row."""
    return F.to_json(F.struct("date", "merchant", "description", "amount", "category"))


def to_pairs(df: DataFrame, prompt: Column, id_col: str = "row_id") -> DataFrame:
    """``prompt`` from the raw row (P7), ``response`` as the JSON target."""
    return df.select(id_col, prompt.alias("prompt"), response_json().alias("response"))


RESPONSE_SCHEMA = ("date string, merchant string, description string, amount double, "
                   "category string, _corrupt_record string")


def parse_model_json(df: DataFrame, col: str) -> DataFrame:
    """Typed fields from a response text, or a bad-record flag.

    PERMISSIVE parsing never fails the job; malformed text lands in
    ``_corrupt_record`` and the row is flagged, not dropped."""
    parsed = F.from_json(F.col(col), RESPONSE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    out = df.withColumn("_p", parsed)
    ok = (F.col("_p._corrupt_record").isNull() & F.col("_p.date").isNotNull()
          & F.col("_p.merchant").isNotNull() & F.col("_p.description").isNotNull()
          & F.col("_p.amount").isNotNull()
          & (category_check(F.col("_p.category")) == F.col("_p.category"))
          & F.try_to_date(F.col("_p.date"), "yyyy-MM-dd").isNotNull())
    return out.select(*df.columns, ok.alias("ok"),
                      *[F.when(ok, F.col(f"_p.{c}")).alias(c)
                        for c in ("date", "merchant", "description", "amount", "category")])


def compare_approaches(runs: DataFrame) -> DataFrame:
    """A10: accuracy of each approach, and its gap to the best one (a window
    over the per-approach rows)."""
    per = runs.groupBy("approach").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col("correct").cast("double")), 6).alias("accuracy"))
    return per.withColumn("accuracy_gap", F.round(
        F.col("accuracy") - F.max("accuracy").over(Window.partitionBy()), 6))
