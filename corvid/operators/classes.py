"""A text model with any number of classes as a long weight table (M4, M5).

The model is ``(gram, class, weight)`` over character n-grams, fit by counting
(multinomial naive Bayes). Only pairs that occur have a row: its weight is what
the gram adds over the class's weight of an unseen gram, so a text's score is

    ``prior + grams of the text * unseen + sum of the weights of its grams``

Weights are multiples of 1/8, so that sums are exact in any order. Texts repeat:
both training and scoring work on distinct texts, and a prediction is joined back
by its text. The class table has a row per class; no broadcast is forced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP = 8.0
GRAM = 3


def char_grams(text: Column, n: int = GRAM) -> Column:
    """All ``n``-character pieces of ``^text$``, repeats included; NULL has none."""
    t = F.concat(F.lit("^"), F.lower(text), F.lit("$"))
    last = F.length(t) - n + 1
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.transform(places, lambda i: F.substring(t, i, F.lit(n))), F.array().cast("array<string>"))


def _weight(c: Column) -> Column:
    return F.round(F.log(c) * STEP) / STEP


def train_classes(rows: DataFrame, n: int = GRAM, text: str = "text", label: str = "label") -> tuple[DataFrame, DataFrame]:
    """``(weights(gram, class, weight), classes(class, prior, unseen))`` of labelled rows."""
    texts = rows.filter(F.col(label).isNotNull()).groupBy(F.col(text).alias("text"), F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("m"))
    counts = (texts.select("class", "m", F.explode(char_grams(F.col("text"), n)).alias("gram"))
              .groupBy("gram", "class").agg(F.sum("m").alias("c")))
    size = counts.select("gram").distinct().agg(F.count(F.lit(1)).alias("v"))                       # one row
    total = counts.groupBy("class").agg(F.sum("c").alias("t"))
    whole = Window.partitionBy()                                                                     # a row per class
    prior = texts.groupBy("class").agg(F.sum("m").alias("r")).withColumn("all", F.sum("r").over(whole))
    grams = F.coalesce("t", F.lit(0)) + F.col("v") + 1
    classes = (prior.join(total, "class", "left").crossJoin(size)
               .select("class", _weight(F.col("r") / F.col("all")).alias("prior"), _weight(1 / grams).alias("unseen"),
                       grams.alias("_t")))
    weights = counts.join(classes, "class").select(
        "gram", "class", (_weight((F.col("c") + 1) / F.col("_t")) - F.col("unseen")).alias("weight"))
    return weights, classes.drop("_t")


def predict_classes(rows: DataFrame, weights: DataFrame, classes: DataFrame, n: int = GRAM, text: str = "text") -> DataFrame:
    """``rows`` with ``predicted`` (the smaller name on a tie) and ``score``."""
    texts = rows.select(F.col(text).alias("_t")).distinct()
    grams = texts.select("_t", F.explode(char_grams(F.col("_t"), n)).alias("gram"))
    sums = (grams.join(weights, "gram").groupBy("_t", "class").agg(F.sum("weight").alias("_s")))
    # a row per distinct text and class: the score of a class that no gram names, too
    size = F.size(char_grams(F.col("_t"), n))
    base = (texts.withColumn("_n", size).join(classes)
            .select("_t", "class", (F.col("prior") + F.col("_n") * F.col("unseen")).alias("_base")))
    scored = base.join(sums, [base["_t"].eqNullSafe(sums["_t"]), base["class"] == sums["class"]], "left").select(
        base["_t"], base["class"], (F.col("_base") + F.coalesce("_s", F.lit(0.0))).alias("score"))
    best = scored.groupBy("_t").agg(F.min(F.struct((-F.col("score")).alias("k"), "class")).alias("b"))
    return (rows.join(best, F.col(text).eqNullSafe(F.col("_t")), "left")
            .withColumn("predicted", F.col("b.class")).withColumn("score", -F.col("b.k")).drop("b", "_t"))
