"""Spark ML fits: the oracle gives the rows that count and that each model does
better than the plain alternative (majority class, merchant rules)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.operators import metrics, ml
from corvid.plans import register
from corvid.plans.common import LAB_CTE, labelled
from corvid.session import fresh_dir, stored
from corvid.sources.tables import split_filter

REG_GRID = [0.0, 0.01, 0.1]
# Descriptions the category model never sees in training.
HELD_DESCRIPTIONS = ["UBER *TRIP BR", "DROGARAIA 118", "MERCADOX 24H"]


def _splits(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    return split_filter(lab, "train"), split_filter(lab, "validation")


def beats_majority(scores: DataFrame, lab: DataFrame) -> DataFrame:
    """``split, n, beats_majority``: accuracy above the larger class's share."""
    share = metrics.class_balance(lab, "label", ["split"]).groupBy("split").agg(F.max("share").alias("_m"))
    return scores.join(share, "split").select(
        "split", "n", (F.col("accuracy") > F.col("_m")).alias("beats_majority"))


def _sql(where: str = "") -> str:
    return f"""WITH {LAB_CTE} SELECT split, count(*) AS n, true AS beats_majority FROM lab {where} GROUP BY split"""


def fitted_sentiment(spark, sf_dir):
    train, _ = _splits(spark, sf_dir)
    return ml.text_classifier(0.01).fit(ml.class_weighted(train))


@register("train_sentiment", _sql())
def q_train_sentiment(spark, sf_dir):
    path = ml.save_model(fitted_sentiment(spark, sf_dir), fresh_dir(spark, "sentiment-model"))
    lab = labelled(spark, sf_dir)
    return beats_majority(ml.evaluate(ml.load_model(path), lab, "label", ["split"]), lab)


@register("eval_model", _sql("WHERE split = 'validation'"))
def q_eval_model(spark, sf_dir):
    _, valid = _splits(spark, sf_dir)
    return beats_majority(ml.evaluate(fitted_sentiment(spark, sf_dir), valid, "label", ["split"]), valid)


@register("select_model", _sql("WHERE split = 'validation'"))
def q_select_model(spark, sf_dir):
    train, valid = _splits(spark, sf_dir)
    best, _ = ml.select_best(train, valid, REG_GRID)
    return beats_majority(best.withColumn("split", F.lit("validation")), valid)


def _category_sql() -> str:
    from corvid.plans.bank_plans import NORM_CTE, _q
    held = ", ".join(_q(d) for d in HELD_DESCRIPTIONS)
    return f"""WITH {NORM_CTE}
SELECT CASE WHEN gold_description IN ({held}) THEN 'test' ELSE 'train' END AS split, count(*) AS n,
       true AS beats_majority FROM nv WHERE reason IS NULL GROUP BY ALL"""


@register("train_category", _category_sql())
def q_train_category(spark, sf_dir):
    """M5 with whole descriptions held out: the model must carry over to text it
    has not seen."""
    from corvid.operators import bank as B
    from corvid.plans.bank_plans import gold, normalized
    valid, _ = B.split_valid(normalized(spark, sf_dir))
    g = gold(spark, sf_dir).select("row_id", F.col("gold_category").alias("label"),
                                   F.col("description").alias("gold_description"))
    split = F.when(F.col("gold_description").isin(HELD_DESCRIPTIONS), "test").otherwise("train")
    # stored: the fit, the scores and the shares don't read the files again
    data = stored(valid.join(g, "row_id").select(F.col("description").alias("text"), "label", split.alias("split")),
                  "category-rows")
    fitted = ml.category_classifier().fit(split_filter(data, "train"))
    names = F.array(*[F.lit(x) for x in fitted.stages[3].labels])
    pred = fitted.transform(data).withColumn(
        "predicted", F.element_at(names, F.col("prediction").cast("int") + 1))
    scores = pred.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("predicted") == F.col("label")).cast("double")).alias("accuracy"))
    # the majority class of the training rows, on either split
    top = (split_filter(data, "train").groupBy("label").agg(F.count(F.lit(1)).alias("c"))
           .agg(F.max_by("label", F.struct("c", "label")).alias("_top")))
    share = (data.crossJoin(F.broadcast(top)).groupBy("split")       # one row
             .agg(F.avg((F.col("label") == F.col("_top")).cast("double")).alias("_m")))
    return scores.join(share, "split").select(
        "split", "n", (F.col("accuracy") > F.col("_m")).alias("beats_majority"))
