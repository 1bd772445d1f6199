"""G1 learned from the labelled rows: counts, generated rows, how near they come."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import generate as G
from corvid.plans import register
from corvid.plans.bank_plans import GOLD_CTE, gold
from corvid.session import fresh_dir

VARIANTS = 2

LABEL = "gold_merchant || chr(31) || gold_category"
LEARN_CTE = GOLD_CTE + f""",
lr AS (SELECT {LABEL} AS label, list_filter(string_split(description, ' '), lambda t: t <> '') AS toks,
              strftime(date, '%Y-%m') AS month,
              CAST(CAST(floor(round(amount * 100) / {G.AMOUNT_STEP}) AS BIGINT) AS VARCHAR) AS step FROM gold),
pt AS (SELECT label, list_concat(list_concat([chr(2)], toks), [chr(3)]) AS path FROM lr),
pr AS (SELECT label, path, unnest(range(1, len(path))) AS i FROM pt),
cn AS (SELECT 'next' AS kind, label || chr(31) || path[i] AS ctx, path[i + 1] AS value, count(*) AS n FROM pr GROUP BY ALL
       UNION ALL SELECT 'label', '', label, count(*) FROM lr GROUP BY ALL
       UNION ALL SELECT 'month', label, month, count(*) FROM lr GROUP BY ALL
       UNION ALL SELECT 'amount', label, step, count(*) FROM lr GROUP BY ALL)"""


def _number(salt: str) -> str:
    return f"('0x' || substr(md5(CAST(synth_id AS VARCHAR) || '|' || {salt}), 1, 15))::BIGINT"


DRAW_CTE = "WITH RECURSIVE " + LEARN_CTE + f""",
ch AS (SELECT *, sum(n) OVER (PARTITION BY kind, ctx ORDER BY value) AS hi, sum(n) OVER (PARTITION BY kind, ctx) AS total FROM cn),
ids AS (SELECT CAST(row_id * {VARIANTS} + v AS BIGINT) AS synth_id FROM gold, range({VARIANTS}) t(v)),
lb AS (SELECT synth_id, value AS label FROM ids JOIN ch ON kind = 'label'
       AND {_number("'label'")} % total >= hi - n AND {_number("'label'")} % total < hi),
walk(synth_id, label, i, here, words) AS (
  SELECT synth_id, label, 0, chr(2), '' FROM lb
  UNION ALL
  SELECT w.synth_id, w.label, w.i + 1, ch.value,
         CASE WHEN ch.value = chr(3) THEN w.words WHEN w.words = '' THEN ch.value ELSE w.words || ' ' || ch.value END
  FROM (SELECT *, {_number("'token' || i")} AS h FROM walk WHERE here <> chr(3) AND i < {G.MAX_TOKENS}) w
  JOIN ch ON ch.kind = 'next' AND ch.ctx = w.label || chr(31) || w.here AND h % total >= hi - n AND h % total < hi),
dn AS (SELECT synth_id, label, words FROM walk WHERE here = chr(3) OR i = {G.MAX_TOKENS}),
made AS (
  SELECT synth_id, strftime(CAST(mo.value || '-01' AS DATE) + CAST({_number("'day'")} % 28 AS INTEGER), '%Y-%m-%d') AS date,
         (CAST(am.value AS BIGINT) * {G.AMOUNT_STEP} + {_number("'cents'")} % {G.AMOUNT_STEP}) / 100.0 AS amount,
         words AS description, split_part(label, chr(31), 1) AS gold_merchant, split_part(label, chr(31), 2) AS gold_category
  FROM dn JOIN ch mo ON mo.kind = 'month' AND mo.ctx = label
            AND {_number("'month'")} % mo.total >= mo.hi - mo.n AND {_number("'month'")} % mo.total < mo.hi
       JOIN ch am ON am.kind = 'amount' AND am.ctx = label
            AND {_number("'amount'")} % am.total >= am.hi - am.n AND {_number("'amount'")} % am.total < am.hi)
"""


def learned(spark, sf_dir):
    path = fresh_dir(spark, "generator")
    G.learn(gold(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


def generated(spark, sf_dir):
    ids = gold(spark, sf_dir).select(
        F.explode(F.sequence(F.col("row_id") * VARIANTS, F.col("row_id") * VARIANTS + VARIANTS - 1)).alias("synth_id"))
    return G.generate(ids, learned(spark, sf_dir))


@register("generator_learn", f"WITH {LEARN_CTE} SELECT kind, ctx, value, n FROM cn")
def q_generator_learn(spark, sf_dir):
    return learned(spark, sf_dir)


@register("generator_rows", DRAW_CTE + "SELECT * FROM made")
def q_generator_rows(spark, sf_dir):
    return generated(spark, sf_dir).withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("generator_fit", DRAW_CTE + """,
fit AS (SELECT 'category' AS what, gold_category AS value, 1 AS s, 0 AS m FROM gold
         UNION ALL SELECT 'merchant', gold_merchant, 1, 0 FROM gold UNION ALL SELECT 'description', description, 1, 0 FROM gold
         UNION ALL SELECT 'category', gold_category, 0, 1 FROM made
         UNION ALL SELECT 'merchant', gold_merchant, 0, 1 FROM made UNION ALL SELECT 'description', description, 0, 1 FROM made)
SELECT what, value, CAST(sum(s) AS BIGINT) AS seed_n, CAST(sum(m) AS BIGINT) AS made_n FROM fit GROUP BY ALL""")
def q_generator_fit(spark, sf_dir):
    path = fresh_dir(spark, "generated")
    generated(spark, sf_dir).write.parquet(path)
    by = {"category": F.col("gold_category"), "merchant": F.col("gold_merchant"), "description": F.col("description")}
    return G.frequencies(gold(spark, sf_dir), spark.read.parquet(path), by)
