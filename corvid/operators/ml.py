"""Spark ML training, evaluation and selection (M1, M2, M3, M5; S5, S6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (HashingTF, IDF, NGram, Normalizer, RegexTokenizer,
                                StringIndexer)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import MODEL_TOKEN
from corvid.operators import metrics

#: Hashed columns; few, so that they can be learned from a few hundred rows.
NUM_FEATURES = 1 << 10
WEIGHT_COL = "class_weight"


def text_features(text_col: str = "text") -> list:
    """Words and marks -> hashed term frequencies -> IDF -> unit length, so that a
    long text weighs no more than a short one."""
    return [
        RegexTokenizer(inputCol=text_col, outputCol="words", pattern=MODEL_TOKEN, gaps=False,
                       toLowercase=True, minTokenLength=1),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=NUM_FEATURES),
        IDF(inputCol="tf", outputCol="idf"),
        Normalizer(inputCol="idf", outputCol="features"),
    ]


def sentiment_head(reg_param: float = 0.01, max_iter: int = 50, label_col: str = "label") -> LogisticRegression:
    """L2-regularised logistic regression (``regParam`` plays the part of weight
    decay) on rows weighted by class, so that the rare class counts as much."""
    return LogisticRegression(featuresCol="features", labelCol=label_col, weightCol=WEIGHT_COL,
                              regParam=reg_param, elasticNetParam=0.0, maxIter=max_iter)


def text_classifier(reg_param: float = 0.01, max_iter: int = 50, text_col: str = "text",
                    label_col: str = "label") -> Pipeline:
    """M1: features and head as one pipeline; fit it on ``class_weighted`` rows."""
    return Pipeline(stages=[*text_features(text_col), sentiment_head(reg_param, max_iter, label_col)])


def class_weighted(train: DataFrame, label_col: str = "label") -> DataFrame:
    """Add the weight ``n / (classes * n of the row's class)``."""
    counts = train.groupBy(label_col).agg(F.count(F.lit(1)).alias("_c"))
    whole = counts.agg(F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return (train.join(F.broadcast(counts), label_col).crossJoin(F.broadcast(whole))   # a row per class, one row
            .withColumn(WEIGHT_COL, F.col("_n") / (F.col("_k") * F.col("_c"))).drop("_c", "_n", "_k"))


def category_classifier(n: int = 3, reg_param: float = 0.01, text_col: str = "text",
                        label_col: str = "label") -> Pipeline:
    """M5: character n-grams of a description -> multinomial logistic regression."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="chars", pattern="", gaps=True,
                       toLowercase=True, minTokenLength=1),
        NGram(n=n, inputCol="chars", outputCol="grams"),
        HashingTF(inputCol="grams", outputCol="features", numFeatures=1 << 16),
        StringIndexer(inputCol=label_col, outputCol="label_idx", handleInvalid="keep"),
        LogisticRegression(featuresCol="features", labelCol="label_idx", regParam=reg_param,
                           family="multinomial", maxIter=100),
    ])


def save_model(model: PipelineModel, path: str) -> str:
    """The fitted stages (tokenizer settings included) in one folder."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load once on the driver; executors receive the stages with the plan."""
    return PipelineModel.load(path)


def evaluate(model: PipelineModel, df: DataFrame, label_col: str = "label",
             group_cols: Sequence[str] = ()) -> DataFrame:
    """M2: scoring only, then accuracy and F1 as aggregates."""
    pred = model.transform(df).withColumn("pred", F.col("prediction").cast("int"))
    return metrics.binary_metrics(pred, label_col, "pred", group_cols)


def select_best(train: DataFrame, valid: DataFrame, reg_params: Sequence[float],
                label_col: str = "label") -> tuple[DataFrame, PipelineModel]:
    """M3: one head per setting on a fixed split; keep the best on validation
    accuracy (earliest setting on ties). Features are fit and computed once."""
    features = Pipeline(stages=text_features()).fit(train)
    rows = features.transform(class_weighted(train, label_col)).select(label_col, WEIGHT_COL, "features").persist()
    check = features.transform(valid).select(label_col, "features").persist()
    scores, heads = [], []
    try:
        for i, rp in enumerate(reg_params):
            head = sentiment_head(rp, label_col=label_col).fit(rows)
            heads.append(head)
            pred = head.transform(check).withColumn("pred", F.col("prediction").cast("int"))
            r = metrics.binary_metrics(pred, label_col, "pred").first()      # one row
            scores.append((i, float(rp), r["n"], r["accuracy"], r["f1"]))
    finally:
        rows.unpersist()
        check.unpersist()
    hist = train.sparkSession.createDataFrame(
        scores, "candidate int, reg_param double, n bigint, accuracy double, f1 double")
    best = metrics.best_by(hist, "candidate", "accuracy")
    idx = best.first()["candidate"]
    return hist.join(best.select("candidate"), "candidate"), PipelineModel(stages=[*features.stages, heads[idx]])
