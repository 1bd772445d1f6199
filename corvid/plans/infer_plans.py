"""Bank files read without a profile (S3), dates only the file decides (X13) and
merchant rules that hold anywhere (J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.bank import CATEGORIES
from corvid.operators import bank as B
from corvid.operators.dates import date_parts, order_vote, resolve_dates
from corvid.operators.patterns import match_anywhere
from corvid.plans import register
from corvid.plans.bank_plans import (DESC_VALUES, GOLD_CTE, INITCAP_SQL, NOISE_CTE, NORM_CTE,
                                     PAT_VALUES, _q, bank_files, gold)
from corvid.session import fresh_dir
from corvid.sources.bank_csv import PROFILES
from corvid.sources.dialects import infer_dialects, read_any_bank_csv, read_lines, statement_year
from corvid.sources.tables import load_table


@register("bank_infer_read", f"""WITH {NOISE_CTE}
SELECT CASE WHEN surplus OR bad_id THEN NULL ELSE row_id END AS row_id, bank,
       CAST(year AS INTEGER) AS year, id_s AS id_raw,
       date_s AS date_raw, description_s AS description_raw, amount_s AS amount_raw, surplus AS corrupt
FROM noisy""")
def q_bank_infer_read(spark, sf_dir):
    raw = read_any_bank_csv(spark, bank_files(spark, sf_dir))
    return raw.select("row_id", "bank", "year", "id_raw", "date_raw", "description_raw", "amount_raw",
                      F.col("corrupt").isNotNull().alias("corrupt"))


@register("bank_infer_normalize", f"""WITH {NORM_CTE}
SELECT read_id AS row_id, bank, CAST(year AS INTEGER) AS year, date, merchant, description, amount,
       category, reason FROM nv""")
def q_bank_infer_normalize(spark, sf_dir):
    """M6 over files of unknown layout: the rows of ``bank_normalize``."""
    out = B.normalize_transactions(spark, read_any_bank_csv(spark, bank_files(spark, sf_dir)))
    return out.drop("file", "id_raw", "date_raw", "amount_raw")


def _dialect_sql() -> str:
    rows = ", ".join(
        f"({_q(p.bank)}, {_q(p.sep)}, {_q(p.encoding)}, {str(p.header).lower()}, {len(p.columns)}, "
        f"{_q('-'.join(r for _, r in p.columns))}, {_q(p.decimal_mark)})" for p in PROFILES)
    return f"""WITH {GOLD_CTE}
SELECT DISTINCT g.bank, CAST(g.year AS INTEGER) AS year, sep, encoding, header, CAST(n_cells AS INTEGER) AS n_cells,
       roles, decimal_mark
FROM gold g JOIN (VALUES {rows}) p(bank, sep, encoding, header, n_cells, roles, decimal_mark) ON g.bank = p.bank"""


@register("bank_infer_dialect", _dialect_sql())
def q_bank_infer_dialect(spark, sf_dir):
    """The layout of each bank and year, as its files show it. Text that happens
    to be plain ASCII is UTF-8 too: a folder is Latin-1 if one of its files is."""
    lines = read_lines(spark, bank_files(spark, sf_dir))
    d = infer_dialects(lines)
    pos = [F.struct(F.col(f"pos_{r}").alias("p"), F.lit(r).alias("r")) for r in ("id", "date", "description", "amount")]
    roles = F.array_join(F.transform(F.array_sort(F.array(*pos)), lambda x: x["r"]), "-")
    return (d.select(F.regexp_extract("file", "bank=([^/]+)/", 1).alias("bank"), statement_year(F.col("file")).alias("year"),
                     "sep", "encoding", F.col("header").isNotNull().alias("header"), F.col("n_cells").cast("int").alias("n_cells"),
                     roles.alias("roles"), "decimal_mark")
            .groupBy("bank", "year", "sep", "header", "n_cells", "roles", "decimal_mark")
            .agg(F.min("encoding").alias("encoding")))


# ---- X13: statements whose dates are ambiguous ------------------------------------------

#: Statement families: date form, newest row first. In the last two no number is
#: above 12, so that the order alone tells day from month.
FAMILIES = (("dd/MM", False), ("MM/dd", True), ("dd/MM/yyyy", False), ("MM/dd/yyyy", True))
SPAN = 3            # years a statement covers


def statements(spark, sf_dir):
    """Every order as a line of a statement, in date order: ``family, until,
    line`` and the sort key. Days up to 12 go to the open families."""
    g = gold(spark, sf_dir).select("row_id", "date", "description")
    small = F.dayofmonth("date") <= 12
    family = F.when(small & (F.pmod("row_id", F.lit(2)) == 0), 2 + F.pmod(F.floor(F.col("row_id") / 2), F.lit(2))) \
              .otherwise(F.pmod(F.floor(F.col("row_id") / 2), F.lit(2))).cast("int")
    g = g.withColumn("family", family)
    text = None
    for i, (form, _) in enumerate(FAMILIES):
        hit = F.col("family") == i
        text = F.when(hit, F.date_format("date", form)) if text is None else text.when(hit, F.date_format("date", form))
    newest = F.element_at(F.array(*[F.lit(n) for _, n in FAMILIES]), F.col("family") + 1)
    days = F.datediff("date", F.to_date(F.lit("1970-01-01")))
    span = F.floor(F.year("date") / SPAN)
    g = g.withColumn("_span", span).withColumn("place", F.when(newest, -days).otherwise(days))
    last = g.groupBy("family", "_span").agg(F.max(F.year("date")).alias("until"))      # a row a statement
    return (g.join(last, ["family", "_span"])
            .select("family", "until", "place", "row_id", F.concat_ws(";", text, "description", "row_id").alias("line")))


@register("bank_ambiguous_dates", f"""WITH {GOLD_CTE}
SELECT row_id, CAST(CASE WHEN day(date) <= 12 AND row_id % 2 = 0 THEN 2 + (row_id // 2) % 2 ELSE (row_id // 2) % 2 END
            AS INTEGER) AS family, strftime(date, '%Y-%m-%d') AS date FROM gold""")
def q_bank_ambiguous_dates(spark, sf_dir):
    """Files without a single unambiguous date in two of four families, without a
    year in the two others: the dates are those of ``orders``."""
    root = fresh_dir(spark, "bank-statements")
    (statements(spark, sf_dir).repartition("family", "until").sortWithinPartitions("family", "until", "place", "row_id")
     .select("line", "family", "until").write.partitionBy("family", "until").text(root))
    lines = read_lines(spark, root)
    cells = F.split("line", ";")
    rows = lines.select(
        "file", "block", "place", F.get(cells, 0).alias("date_raw"), F.get(cells, 2).cast("bigint").alias("row_id"),
        F.regexp_extract("file", "family=([0-9]+)/", 1).cast("int").alias("family"),
        statement_year(F.col("file")).alias("year"))
    vote = F.sum(order_vote(date_parts(F.col("date_raw"))))
    votes = rows.groupBy("file").agg(vote.alias("_v")).select(
        "file", F.when(F.col("_v") > 0, True).when(F.col("_v") < 0, False).alias("day_first"))
    # votes: a row a file, as the driver's own list of them
    return resolve_dates(rows.join(F.broadcast(votes), "file")).select("row_id", "family", "date")


# ---- J5: rules anywhere in the text -------------------------------------------------------

def part_rules(spark, sf_dir):
    """A rule table that grows with ``part``: names with their brand, names alone,
    and the fixed rules."""
    part = load_table(spark, sf_dir, "part")
    cats = F.array(*[F.lit(c) for c in CATEGORIES])
    with_brand = part.groupBy("p_name", "p_brand").agg(F.min("p_partkey").alias("k")).select(
        F.concat_ws(" ", "p_name", "p_brand").alias("pattern"), F.col("p_brand").alias("merchant"),
        F.element_at(cats, (F.col("k") % len(CATEGORIES) + 1).cast("int")).alias("category"), F.lit(1).alias("priority"))
    alone = part.select("p_name").distinct().select(
        F.col("p_name").alias("pattern"), F.initcap("p_name").alias("merchant"), F.lit("Shopping").alias("category"),
        F.lit(5).alias("priority"))
    return with_brand.unionByName(alone).unionByName(B.pattern_table(spark))


@register("bank_merchant_anywhere", f"""WITH descs AS (SELECT * FROM (VALUES {DESC_VALUES}) t(i, description, m, c)),
rules AS (
  SELECT p_name || ' ' || p_brand AS pattern, p_brand AS merchant,
         ({"[" + ", ".join(_q(c) for c in CATEGORIES) + "]"})[min(p_partkey) % {len(CATEGORIES)} + 1] AS category, 1 AS priority
  FROM part GROUP BY p_name, p_brand
  UNION ALL SELECT DISTINCT p_name, {INITCAP_SQL.format(c='p_name')}, 'Shopping', 5 FROM part
  UNION ALL SELECT * FROM (VALUES {PAT_VALUES}) p(pattern, merchant, category, priority)),
tx AS (SELECT l.l_orderkey, l.l_linenumber, CASE l.l_suppkey % 3
         WHEN 0 THEN 'COMPRA ' || (l.l_suppkey % 10) || ' ' || upper(p.p_name) || ' ' || p.p_brand || ' LTDA'
         WHEN 1 THEN 'PAG ' || p.p_type || ' ' || p.p_name ELSE 'CARTAO 77 ' || d.description END AS description
       FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN descs d ON d.i = l.l_partkey % {len(B.DESCRIPTIONS)}),
dd AS (SELECT DISTINCT description AS d FROM tx),
best AS (SELECT d, merchant, category, pattern FROM (
  SELECT *, row_number() OVER (PARTITION BY d ORDER BY priority, length(pattern) DESC, pattern, merchant, category) AS rn
  FROM dd JOIN rules ON contains(upper(d), upper(pattern))) WHERE rn = 1)
SELECT l_orderkey, l_linenumber, description, coalesce(merchant, {INITCAP_SQL.format(c='description')}) AS merchant,
       coalesce(category, 'Other') AS category, pattern AS matched_pattern FROM tx LEFT JOIN best ON d = description""")
def q_bank_merchant_anywhere(spark, sf_dir):
    """Card texts with the shop somewhere in the middle, against a rule for each
    name and brand there is; the oracle is the plain theta join."""
    part = load_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    l = load_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    j = l.join(part, F.col("l_partkey") == F.col("p_partkey"))
    fixed = F.element_at(F.array(*[F.lit(d) for d, _, _ in B.DESCRIPTIONS]),
                         (F.col("l_partkey") % len(B.DESCRIPTIONS) + 1).cast("int"))
    kind = F.col("l_suppkey") % 3
    text = (F.when(kind == 0, F.concat_ws(" ", F.lit("COMPRA"), F.col("l_suppkey") % 10, F.upper("p_name"), "p_brand", F.lit("LTDA")))
            .when(kind == 1, F.concat_ws(" ", F.lit("PAG"), "p_type", "p_name")).otherwise(F.concat(F.lit("CARTAO 77 "), fixed)))
    tx = j.select("l_orderkey", "l_linenumber", text.alias("description"))
    return match_anywhere(spark, tx, "description", part_rules(spark, sf_dir))
