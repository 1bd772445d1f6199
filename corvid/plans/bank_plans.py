"""Bank statement normalization derived from ``orders`` (step 5).

Transactions: row id = order key, date = order date, amount = -total price,
description = one of a fixed list picked by customer key, bank = order key mod
4. They are rendered in four bank layouts with noise, written as real CSV files
to the shared scratch folder, read back and normalized. The oracles compute the
expected outcome directly from ``orders`` and the fixed rules.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.bank import (CATEGORIES, EN_MONTHS, PT_MONTHS, clean_text, format_row,
                                   match_key)
from corvid.operators import bank as B
from corvid.operators import metrics
from corvid.plans import register
from corvid.session import fresh_dir
from corvid.sources.bank_csv import (BANKS, PROFILES, by_profile, parsed_amount, parsed_date,
                                     read_bank_csv, read_normalized, render_dialect,
                                     write_bank_files, write_normalized)
from corvid.sources.tables import load_table

SYNTH_VARIANTS = 2
HOLDOUT = [("itau", 1998), ("inter", 2000)]


# ---- Spark side ------------------------------------------------------------------

def gold(spark, sf_dir):
    return B.bank_gold(spark, load_table(spark, sf_dir, "orders"), BANKS)


def rendered(spark, sf_dir, noise=True):
    g = gold(spark, sf_dir)
    out = None
    for p in PROFILES:
        r = render_dialect(g.filter(F.col("bank") == p.bank), p)
        out = r if out is None else out.unionByName(r)
    return B.inject_noise(out) if noise else out.drop("alt_date_s")


def bank_files(spark, sf_dir):
    root = fresh_dir(spark, "bank-csv")
    return write_bank_files(rendered(spark, sf_dir), root)


def raw_read(spark, sf_dir):
    return read_bank_csv(spark, bank_files(spark, sf_dir))


def normalized(spark, sf_dir):
    return B.normalize_transactions(spark, raw_read(spark, sf_dir))


# ---- SQL side ----------------------------------------------------------------------

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


DESC_VALUES = ", ".join(f"({i}, {_q(d)}, {_q(m)}, {_q(c)})"
                        for i, (d, m, c) in enumerate(B.DESCRIPTIONS))
PAT_VALUES = ", ".join(f"({_q(p)}, {_q(m)}, {_q(c)}, {r})" for p, m, c, r in B.MERCHANT_PATTERNS)
BANK_LIST = "[" + ", ".join(_q(b) for b in BANKS) + "]"
def _month_list(names):
    return "[" + ", ".join(_q(m) for m in names) + "]"


_DATE_FMT = {"yyyy-MM-dd": "'%Y-%m-%d'", "d/M/yyyy": "'%-d/%-m/%Y'", "MM-dd": "'%m-%d'",
             "dd/MM/yyyy": "'%d/%m/%Y'", "yyyyMMdd": "'%Y%m%d'"}


def _date_s(fmt):
    if "MMM" in fmt:
        names = _month_list(EN_MONTHS if "y" in fmt else PT_MONTHS)
        year = " || '/' || CAST(year(date) AS VARCHAR)" if "y" in fmt else ""
        return f"lpad(CAST(day(date) AS VARCHAR), 2, '0') || '/' || ({names})[month(date)]{year}"
    return f"strftime(date, {_DATE_FMT[fmt]})"


def _amount_s(p):
    if p.thousands:
        s = f"translate(format('{{:,.2f}}', amount), ',.', {_q(p.thousands + p.decimal_mark)})"
    else:
        s = "printf('%.2f', amount)"
        if p.decimal_mark != ".":
            s = f"replace({s}, '.', {_q(p.decimal_mark)})"
    return f"{_q(p.currency_prefix)} || {s}" if p.currency_prefix else s


def _date_case(i):
    return "CASE bank " + " ".join(f"WHEN {_q(p.bank)} THEN {_date_s(p.date_formats[i])}" for p in PROFILES) + " END"


AMOUNT_S = "CASE bank " + " ".join(f"WHEN {_q(p.bank)} THEN {_amount_s(p)}" for p in PROFILES) + " END"


def _hit(rule):
    return f"row_id % {rule[0]} = {rule[1]}"


def _pick(texts):
    return f"([{', '.join(_q(t) for t in texts)}])[row_id % {len(texts)} + 1]"


NO_DATE = f"({_hit(B.NOISE_NO_DATE)} OR {_hit(B.NOISE_BAD_DATE)})"
NO_AMOUNT = f"({_hit(B.NOISE_NO_AMOUNT)} OR {_hit(B.NOISE_BAD_AMOUNT)})"


GOLD_CTE = f"""descs AS (SELECT * FROM (VALUES {DESC_VALUES}) t(desc_idx, description, gold_merchant, gold_category)),
gold AS (
  SELECT o.o_orderkey AS row_id, ({BANK_LIST})[(o.o_orderkey % {len(BANKS)}) + 1] AS bank,
         CAST(o.o_orderdate AS DATE) AS date, CAST(year(CAST(o.o_orderdate AS DATE)) AS INTEGER) AS year,
         -o.o_totalprice AS amount, d.description, d.gold_merchant, d.gold_category
  FROM orders o JOIN descs d ON d.desc_idx = o.o_custkey % {len(B.DESCRIPTIONS)})"""

RENDER_CTE = GOLD_CTE + f""",
rend AS (
  SELECT row_id, bank, year, CAST(row_id AS VARCHAR) AS id_s, {_date_case(0)} AS date_s,
         {_date_case(-1)} AS alt_date_s, description AS description_s, {AMOUNT_S} AS amount_s FROM gold)"""

NOISE_CTE = RENDER_CTE + f""",
noisy AS (
  SELECT row_id, bank, year, CASE WHEN {_hit(B.NOISE_BAD_ID)} THEN {_q(B.BAD_ID_TEXT)} ELSE id_s END AS id_s,
         CASE WHEN {_hit(B.NOISE_NO_DATE)} THEN NULL
              WHEN {_hit(B.NOISE_BAD_DATE)} THEN {_pick(B.BAD_DATES)}
              WHEN {_hit(B.NOISE_ALT_DATE)} THEN alt_date_s ELSE date_s END AS date_s,
         CASE WHEN {_hit(B.NOISE_BLANK_DESC)} THEN '   '
              WHEN {_hit(B.NOISE_SPACES)} THEN '  ' || replace(description_s, ' ', '   ') || ' '
              WHEN {_hit(B.NOISE_SPECIAL)} THEN chr(160) || description_s || ' ##'
              ELSE description_s END AS description_s,
         CASE WHEN {_hit(B.NOISE_NO_AMOUNT)} THEN NULL
              WHEN {_hit(B.NOISE_BAD_AMOUNT)} THEN {_pick(B.BAD_AMOUNTS)}
              WHEN {_hit(B.NOISE_BRACKETS)} THEN '(' || replace(amount_s, '-', '') || ')'
              WHEN {_hit(B.NOISE_MINUS)} AND bank <> 'itau' THEN replace(amount_s, '-', chr(8722))
              ELSE amount_s END AS amount_s,
         {_hit(B.NOISE_SURPLUS)} AS surplus, {_hit(B.NOISE_BAD_ID)} AS bad_id
  FROM rend)"""

CLEAN_SQL = (r"nullif(trim(regexp_replace(regexp_replace(regexp_replace({c}, '[\s\x{{00A0}}]+', ' ', 'g'), "
             r"'[^\p{{L}}\p{{N}} *.,&/-]', '', 'g'), ' +', ' ', 'g')), '')")
INITCAP_SQL = ("array_to_string(list_transform(string_split(lower({c}), ' '), "
               "lambda w: upper(w[1]) || w[2:]), ' ')")
KEY_SQL = "regexp_extract(upper({c}), '^([A-Z0-9]+)', 1)"

# Expected normalized rows straight from the truth and the noise rules.
NORM_CTE = NOISE_CTE + rf""",
cl AS (SELECT n.row_id, n.bank, n.year, n.description_s AS description, n.surplus, n.bad_id,
              CASE WHEN n.surplus OR n.bad_id THEN NULL ELSE n.row_id END AS read_id,
              {CLEAN_SQL.format(c='n.description_s')} AS clean,
              CASE WHEN {NO_DATE} THEN NULL ELSE strftime(g.date, '%Y-%m-%d') END AS date,
              CASE WHEN {NO_AMOUNT} THEN NULL ELSE g.amount END AS amount,
              g.gold_merchant, g.gold_category, strftime(g.date, '%Y-%m-%d') AS gold_date,
              g.amount AS gold_amount, g.description AS gold_description,
              n.date_s, n.amount_s
       FROM noisy n JOIN gold g USING (row_id)),
pats AS (SELECT pattern, merchant, category, priority
         FROM (VALUES {PAT_VALUES}) p(pattern, merchant, category, priority)),
dd AS (SELECT DISTINCT clean AS d FROM cl WHERE clean IS NOT NULL),
cand AS (SELECT d, merchant, category, pattern,
                row_number() OVER (PARTITION BY d ORDER BY priority, length(pattern) DESC) AS rn
         FROM dd JOIN pats ON starts_with(upper(d), upper(pattern))),
best AS (SELECT d, merchant, category, pattern FROM cand WHERE rn = 1),
nm AS (SELECT cl.*, coalesce(best.merchant, {INITCAP_SQL.format(c='cl.clean')}) AS merchant,
              CASE WHEN cl.clean IS NULL THEN NULL ELSE coalesce(best.category, 'Other') END AS category,
              best.pattern AS matched_pattern
       FROM cl LEFT JOIN best ON cl.clean = best.d),
nv AS (SELECT * REPLACE (CASE WHEN surplus THEN NULL ELSE date END AS date,
                         CASE WHEN surplus THEN NULL ELSE amount END AS amount),
                 CASE WHEN surplus THEN 'bad_row' WHEN bad_id THEN 'bad_id'
                      WHEN date IS NULL THEN 'bad_date'
                      WHEN amount IS NULL THEN 'bad_amount'
                      WHEN trim(regexp_replace(description, '[\s\x{{00A0}}]+', ' ', 'g')) = '' THEN 'blank_description'
                 END AS reason
       FROM nm)"""


# ---- G1 / G2 / G3 --------------------------------------------------------------------

@register("bank_synth", f"""WITH {GOLD_CTE},
v AS (SELECT g.*, unnest(generate_series(0, {SYNTH_VARIANTS - 1})) AS v FROM gold g),
dl AS (SELECT list(description ORDER BY desc_idx) AS ds, list(gold_merchant ORDER BY desc_idx) AS ms,
              list(gold_category ORDER BY desc_idx) AS cs FROM descs)
SELECT CAST(row_id * {SYNTH_VARIANTS} + v AS BIGINT) AS synth_id, row_id AS seed_id,
       strftime(date + CAST((row_id * 7 + v * 13) % 28 AS INTEGER), '%Y-%m-%d') AS date,
       amount - v * 1.25 AS amount,
       ds[(row_id + v * 5) % {len(B.DESCRIPTIONS)} + 1] AS description,
       ms[(row_id + v * 5) % {len(B.DESCRIPTIONS)} + 1] AS gold_merchant,
       cs[(row_id + v * 5) % {len(B.DESCRIPTIONS)} + 1] AS gold_category
FROM v, dl""")
def q_bank_synth(spark, sf_dir):
    s = B.synthesize(gold(spark, sf_dir), SYNTH_VARIANTS)
    return s.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("bank_render", f"""WITH {RENDER_CTE}
SELECT row_id, bank, year, id_s, date_s, description_s, amount_s FROM rend""")
def q_bank_render(spark, sf_dir):
    return rendered(spark, sf_dir, noise=False)


@register("bank_noise", f"""WITH {NOISE_CTE}
SELECT row_id, bank, year, id_s, date_s, description_s, amount_s, surplus FROM noisy""")
def q_bank_noise(spark, sf_dir):
    return rendered(spark, sf_dir, noise=True)


# ---- S3 / K3: real files in four layouts, read back as one frame --------------------

@register("bank_csv_read", f"""WITH {NOISE_CTE}
SELECT CASE WHEN surplus OR bad_id THEN NULL ELSE row_id END AS row_id, bank,
       CAST(year AS INTEGER) AS year, bank || '/' || CAST(year AS VARCHAR) AS folder, id_s AS id_raw,
       date_s AS date_raw, description_s AS description_raw, amount_s AS amount_raw, surplus AS corrupt
FROM noisy""")
def q_bank_csv_read(spark, sf_dir):
    raw = raw_read(spark, sf_dir)
    folder = F.concat_ws("/", F.regexp_extract("file", "bank=([^/]+)/", 1),
                         F.regexp_extract("file", "year=([0-9]+)/", 1))
    return raw.select("row_id", "bank", "year", folder.alias("folder"), "id_raw", "date_raw",
                      "description_raw", "amount_raw", F.col("corrupt").isNotNull().alias("corrupt"))


# ---- X13 / X14 / X15 / J5 ---------------------------------------------------------------

@register("bank_date", f"""WITH {NORM_CTE}
SELECT row_id, bank, date_s AS date_raw, date FROM cl""")
def q_bank_date(spark, sf_dir):
    date = by_profile(lambda p: parsed_date(F.col("date_s"), p, F.col("year")))
    return rendered(spark, sf_dir).select("row_id", "bank", F.col("date_s").alias("date_raw"),
                                          date.alias("date"))


@register("bank_amount", f"""WITH {NORM_CTE}
SELECT row_id, bank, amount_s AS amount_raw, amount FROM cl""")
def q_bank_amount(spark, sf_dir):
    amount = by_profile(lambda p: parsed_amount(F.col("amount_s"), p))
    return rendered(spark, sf_dir).select("row_id", "bank", F.col("amount_s").alias("amount_raw"),
                                          amount.alias("amount"))


@register("bank_clean", f"""WITH {NORM_CTE}
SELECT row_id, description AS description_raw, clean AS description_clean FROM cl""")
def q_bank_clean(spark, sf_dir):
    raw = F.col("description_s")
    return rendered(spark, sf_dir).select("row_id", raw.alias("description_raw"),
                                          clean_text(raw).alias("description_clean"))


@register("bank_merchant", f"""WITH {NORM_CTE}
SELECT row_id, clean AS description_clean, merchant, category, matched_pattern FROM nm""")
def q_bank_merchant(spark, sf_dir):
    t = rendered(spark, sf_dir).select(
        "row_id", clean_text(F.col("description_s")).alias("description_clean"))
    return B.match_merchant(spark, t).select("row_id", "description_clean", "merchant",
                                             "category", "matched_pattern")


# ---- F4 / M6 / J7 / F6 -----------------------------------------------------------------------

@register("bank_validate", f"""WITH {NORM_CTE}
SELECT read_id AS row_id, bank, reason FROM nv""")
def q_bank_validate(spark, sf_dir):
    return normalized(spark, sf_dir).select("row_id", "bank", "reason")


@register("bank_normalize", f"""WITH {NORM_CTE}
SELECT read_id AS row_id, bank, CAST(year AS INTEGER) AS year, date, merchant, description, amount,
       category, reason FROM nv""")
def q_bank_normalize(spark, sf_dir):
    return normalized(spark, sf_dir).drop("file", "id_raw", "date_raw", "amount_raw")


@register("bank_completeness", f"""WITH {NORM_CTE}
SELECT count(*) AS n_input, count(*) FILTER (WHERE reason IS NULL) AS n_valid,
       count(*) FILTER (WHERE reason IS NOT NULL) AS n_rejected, CAST(0 AS BIGINT) AS n_missing
FROM nv""")
def q_bank_completeness(spark, sf_dir):
    raw = raw_read(spark, sf_dir)
    out = B.normalize_transactions(spark, raw).withColumnRenamed("description", "description_raw")
    return B.completeness(raw, out)         # two scans of each layout


HOLD_SQL = " OR ".join(f"(bank = {_q(b)} AND year = {y})" for b, y in HOLDOUT)


@register("bank_holdout", f"""WITH {GOLD_CTE}
SELECT CASE WHEN {HOLD_SQL} THEN 'test' ELSE 'train' END AS split, bank, count(*) AS n
FROM gold GROUP BY ALL""")
def q_bank_holdout(spark, sf_dir):
    raw = B.holdout_files(raw_read(spark, sf_dir), HOLDOUT)
    return raw.groupBy("split", "bank").agg(F.count(F.lit(1)).alias("n"))


# ---- J6 / A4 / A3 ------------------------------------------------------------------------

def valid_with_gold(spark, sf_dir):
    valid, _ = B.split_valid(normalized(spark, sf_dir))
    g = gold(spark, sf_dir).select("row_id", "gold_category")
    return valid.join(g, "row_id")


def gold_fields(spark, sf_dir):
    return gold(spark, sf_dir).select(
        "row_id", "bank", F.date_format("date", "yyyy-MM-dd").alias("date"), "description",
        F.col("gold_merchant").alias("merchant"), "amount", F.col("gold_category").alias("category"))


@register("bank_eval", f"""WITH {NORM_CTE},
p AS (SELECT row_id, bank, date, merchant, amount, category FROM nv WHERE reason IS NULL),
g AS (SELECT row_id, bank, strftime(date, '%Y-%m-%d') AS date, gold_merchant AS merchant, amount,
             gold_category AS category FROM gold),
j AS (SELECT coalesce(g.bank, p.bank) AS bank, g.row_id IS NOT NULL AS has_g, p.row_id IS NOT NULL AS has_p,
             coalesce(p.date = g.date, false) AS dm,
             coalesce(lower(p.merchant) = lower(g.merchant), false) AS mm,
             coalesce(p.category = g.category, false) AS cm,
             coalesce(p.amount = g.amount, false) AS am
      FROM p FULL OUTER JOIN g ON p.row_id = g.row_id)
SELECT bank, count(*) AS n, count(*) FILTER (WHERE has_g) AS n_gold, count(*) FILTER (WHERE has_p) AS n_pred,
       round(avg(CASE WHEN dm THEN 1.0 ELSE 0.0 END), 6) AS date_match,
       round(avg(CASE WHEN mm THEN 1.0 ELSE 0.0 END), 6) AS merchant_match,
       round(avg(CASE WHEN cm THEN 1.0 ELSE 0.0 END), 6) AS category_match,
       round(avg(CASE WHEN am THEN 1.0 ELSE 0.0 END), 6) AS amount_match
FROM j GROUP BY bank""")
def q_bank_eval(spark, sf_dir):
    valid, _ = B.split_valid(normalized(spark, sf_dir))
    return B.compare_gold(valid, gold_fields(spark, sf_dir))


@register("confusion_long", f"""WITH {NORM_CTE}
SELECT gold_category AS gold, category AS predicted, count(*) AS n FROM nv WHERE reason IS NULL
GROUP BY ALL""")
def q_confusion_long(spark, sf_dir):
    return metrics.confusion_long(valid_with_gold(spark, sf_dir), "gold_category", "category")


_WIDE = ", ".join(f"count(*) FILTER (WHERE category = {_q(c)}) AS {c}" for c in CATEGORIES)


@register("confusion_wide", f"""WITH {NORM_CTE}
SELECT gold_category AS gold, {_WIDE} FROM nv WHERE reason IS NULL GROUP BY gold_category""")
def q_confusion_wide(spark, sf_dir):
    return metrics.confusion_wide(valid_with_gold(spark, sf_dir), "gold_category", "category",
                                  CATEGORIES)


# ---- P7 / X17 / X16 ------------------------------------------------------------------------

def _prompt_sql():
    cases = []
    for p in PROFILES:
        col = {"date": "date_s", "description": "description_s", "amount": "amount_s"}
        parts = [f"{_q(n + ': ')} || coalesce({col[r]}, '')" for n, r in p.columns if r != "id"]
        body = " || ', ' || ".join(parts)
        cases.append(f"WHEN {_q(p.bank)} THEN 'Normalize this bank transaction: ' || {body}")
    return "CASE bank " + " ".join(cases) + " END"


PROMPT_SQL = _prompt_sql()


def prompt_column(names=("date_s", "description_s", "amount_s")):
    """P7 in the layout of the row's bank."""
    col = dict(zip(("date", "description", "amount"), map(F.col, names)))
    return by_profile(lambda p: format_row([n for n, r in p.columns if r != "id"],
                                           [col[r] for _, r in p.columns if r != "id"]))


@register("bank_prompt", f"""WITH {NOISE_CTE}
SELECT row_id, bank, {PROMPT_SQL} AS prompt FROM noisy""")
def q_bank_prompt(spark, sf_dir):
    return rendered(spark, sf_dir).select("row_id", "bank", prompt_column().alias("prompt"))


RESPONSE_SQL = ("to_json({'date': strftime(g.date, '%Y-%m-%d'), 'merchant': g.gold_merchant, "
                "'description': g.description, 'amount': g.amount, 'category': g.gold_category})")


@register("bank_pairs", f"""WITH {NOISE_CTE}
SELECT n.row_id, {PROMPT_SQL.replace('CASE bank', 'CASE n.bank')} AS prompt,
       CAST({RESPONSE_SQL} AS VARCHAR) AS response
FROM noisy n JOIN gold g ON n.row_id = g.row_id""")
def q_bank_pairs(spark, sf_dir):
    raw = rendered(spark, sf_dir).select("row_id", "bank", "date_s", "description_s", "amount_s")
    gold_rows = gold_fields(spark, sf_dir).drop("bank")
    return B.to_pairs(raw.join(gold_rows, "row_id"), prompt_column())


CORRUPT_TRUNC = (29, 3)
CORRUPT_AMOUNT = (31, 5)
_CATS = ", ".join(_q(c) for c in CATEGORIES)


@register("bank_json_validate", f"""WITH {GOLD_CTE},
r AS (SELECT g.row_id, CAST({RESPONSE_SQL} AS VARCHAR) AS resp FROM gold g),
c AS (SELECT row_id, CASE WHEN {_hit(CORRUPT_TRUNC)} THEN substr(resp, 1, 20)
                          WHEN {_hit(CORRUPT_AMOUNT)} THEN regexp_replace(resp, '"amount":[^,}}]+', '"amount":"abc"')
                          ELSE resp END AS response FROM r),
v AS (SELECT row_id, response, CASE WHEN json_valid(response) THEN response END AS vj FROM c),
k AS (SELECT row_id, response, vj,
             coalesce(json_type(vj, '$.amount') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
                      AND json_extract_string(vj, '$.category') IN ({_CATS})
                      AND try_strptime(json_extract_string(vj, '$.date'), '%Y-%m-%d') IS NOT NULL,
                      false) AS ok
      FROM v)
SELECT row_id, response, ok,
       CASE WHEN ok THEN json_extract_string(vj, '$.date') END AS date,
       CASE WHEN ok THEN json_extract_string(vj, '$.merchant') END AS merchant,
       CASE WHEN ok THEN json_extract_string(vj, '$.description') END AS description,
       CASE WHEN ok THEN CAST(json_extract(vj, '$.amount') AS DOUBLE) END AS amount,
       CASE WHEN ok THEN json_extract_string(vj, '$.category') END AS category
FROM k""")
def q_bank_json_validate(spark, sf_dir):
    g = gold_fields(spark, sf_dir)
    resp = B.response_json()
    rid = F.col("row_id")
    bad = (F.when(F.pmod(rid, F.lit(CORRUPT_TRUNC[0])) == CORRUPT_TRUNC[1], F.substring(resp, 1, 20))
           .when(F.pmod(rid, F.lit(CORRUPT_AMOUNT[0])) == CORRUPT_AMOUNT[1],
                 F.regexp_replace(resp, '"amount":[^,}]+', '"amount":"abc"'))
           .otherwise(resp))
    return B.parse_model_json(g.select("row_id", bad.alias("response")), "response")


# ---- A10: two approaches compared ---------------------------------------------------------

def _keyword_table(spark):
    from pyspark.sql import Window
    pats = B.pattern_table(spark).withColumn("key", match_key(F.col("pattern")))
    w = Window.partitionBy("key").orderBy("priority", F.desc(F.length("pattern")), "pattern")
    return pats.withColumn("_r", F.row_number().over(w)).filter("_r = 1") \
        .select("key", F.col("category").alias("kw_category"))


@register("approach_compare", f"""WITH {NORM_CTE},
kw AS (SELECT key, category, row_number() OVER (PARTITION BY key ORDER BY priority, length(pattern) DESC, pattern) AS rn
       FROM (SELECT *, {KEY_SQL.format(c='pattern')} AS key FROM pats)),
kw1 AS (SELECT key, category AS kw_category FROM kw WHERE rn = 1),
v AS (SELECT nv.*, coalesce(kw1.kw_category, 'Other') AS kw_category FROM nv
      LEFT JOIN kw1 ON {KEY_SQL.format(c='nv.clean')} = kw1.key WHERE reason IS NULL),
runs AS (
  SELECT 'patterns' AS approach, CASE WHEN category = gold_category THEN 1 ELSE 0 END AS correct FROM v
  UNION ALL
  SELECT 'keyword', CASE WHEN kw_category = gold_category THEN 1 ELSE 0 END FROM v),
per AS (SELECT approach, count(*) AS n, round(avg(correct), 6) AS accuracy
        FROM runs GROUP BY approach)
SELECT *, round(accuracy - max(accuracy) OVER (), 6) AS accuracy_gap FROM per""")
def q_approach_compare(spark, sf_dir):
    v = valid_with_gold(spark, sf_dir)
    v = v.join(F.broadcast(_keyword_table(spark)), match_key(clean_text(F.col("description"))) ==
               F.col("key"), "left").withColumn("kw_category", F.coalesce("kw_category", F.lit("Other")))
    # one pass over the normalized rows: each row yields one run per approach
    runs_arr = F.array(*[F.struct(
        F.lit(name).alias("approach"),
        (F.col(found) == F.col("gold_category")).cast("int").alias("correct"))
        for name, found in (("patterns", "category"), ("keyword", "kw_category"))])
    runs = v.select(F.explode(runs_arr).alias("r")).select("r.*")
    return B.compare_approaches(runs)


# ---- S4: sink and read back ----------------------------------------------------------------

@register("bank_sink_roundtrip", f"""WITH {NORM_CTE}
SELECT row_id, date, merchant, description, amount, category FROM nv WHERE reason IS NULL""")
def q_bank_sink_roundtrip(spark, sf_dir):
    valid, _ = B.split_valid(normalized(spark, sf_dir))
    path = fresh_dir(spark, "bank-normalized")
    write_normalized(valid.select("row_id", "date", "merchant", "description", "amount", "category"),
                     path, "json")
    return read_normalized(spark, path, "json")
