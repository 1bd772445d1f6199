"""Predicted category of every transaction by the many-class model (M4, M5), exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.bank import clean_text
from corvid.operators import bank as B
from corvid.operators import metrics
from corvid.operators.classes import GRAM, predict_classes, train_classes
from corvid.plans import register
from corvid.plans.bank_plans import NORM_CTE, _q, gold, normalized
from corvid.plans.ml_plans import HELD_DESCRIPTIONS
from corvid.session import stored

_HELD = ", ".join(_q(d) for d in HELD_DESCRIPTIONS)
_PRED = rf"""WITH {NORM_CTE},
dat AS (SELECT row_id, clean AS text, gold_category AS label, CASE WHEN gold_description IN ({_HELD}) THEN 'test' ELSE 'train' END AS split
         FROM nv WHERE reason IS NULL),
tx AS (SELECT DISTINCT text, '^' || lower(text) || '$' AS t FROM dat),
gr AS MATERIALIZED (SELECT text, unnest(list_transform(range(1, len(t) - {GRAM} + 2), lambda i: substr(t, i, {GRAM}))) AS gram FROM tx),
tm AS (SELECT text, label AS class, count(*) AS m FROM dat WHERE split = 'train' GROUP BY ALL),
ct AS (SELECT gram, class, sum(m) AS c FROM tm JOIN gr USING (text) GROUP BY ALL),
kl AS (SELECT p.class, round(ln(p.r / (SELECT sum(m) FROM tm)) * 8) / 8 AS prior, g.t, round(ln(1 / g.t) * 8) / 8 AS unseen
       FROM (SELECT class, sum(m)::DOUBLE AS r FROM tm GROUP BY class) p
       JOIN (SELECT class, (sum(c) + (SELECT count(DISTINCT gram) FROM ct) + 1)::DOUBLE AS t FROM ct GROUP BY class) g USING (class)),
wt AS (SELECT gram, class, round(ln((c + 1) / t) * 8) / 8 - unseen AS weight FROM ct JOIN kl USING (class)),
sz AS (SELECT text, count(*) AS n FROM gr GROUP BY text),
sc AS (SELECT sz.text, kl.class, prior + n * unseen + coalesce(s, 0) AS score FROM sz CROSS JOIN kl
       LEFT JOIN (SELECT text, class, sum(weight) AS s FROM gr JOIN wt USING (gram) GROUP BY ALL) x ON x.text = sz.text AND x.class = kl.class),
bs AS (SELECT text, class AS predicted, score FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY score DESC, class) AS rn FROM sc)
       WHERE rn = 1),
pr AS (SELECT row_id, split, label, predicted, score FROM dat JOIN bs USING (text))"""


def predictions(spark, sf_dir):
    valid, _ = B.split_valid(normalized(spark, sf_dir))
    g = gold(spark, sf_dir).select("row_id", F.col("gold_category").alias("label"), F.col("description").alias("gold_description"))
    # stored: training, the distinct texts and the result don't read the files again
    data = stored(valid.join(g, "row_id").select(
        "row_id", clean_text(F.col("description")).alias("text"), "label",
        F.when(F.col("gold_description").isin(HELD_DESCRIPTIONS), "test").otherwise("train").alias("split")), "category-rows")
    weights, classes = train_classes(data.filter(F.col("split") == "train"))
    return predict_classes(data, weights, classes)


@register("category_predict", f"{_PRED}\nSELECT row_id, split, label, predicted, score FROM pr")
def q_category_predict(spark, sf_dir):
    return predictions(spark, sf_dir).select("row_id", "split", "label", "predicted", "score")


@register("category_eval", f"""{_PRED}
SELECT split, label, count(*) AS n, round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM pr GROUP BY split, label""")
def q_category_eval(spark, sf_dir):
    """Accuracy by true category, on descriptions seen in training and held out."""
    hit = (F.col("label") == F.col("predicted")).cast("double")
    return predictions(spark, sf_dir).groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(hit), metrics.DIGITS).alias("accuracy"))
