"""A table-shaped two-class text model: training (M1, SQL form) and scoring (M4).

The model is a weight table ``(token, w0, w1)``: a multinomial naive Bayes fit
done entirely with aggregations. ``[CLS]`` carries the class priors, as every
encoded sequence starts with it, and ``[UNK]`` the weights of every token
outside the vocabulary, so that each token of a text counts. Weights are rounded
to multiples of 1/8 so that sums are exact whatever the summation order
(partial aggregation).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions.probs import argmax, label_name, round_score, softmax
from corvid.functions.text import CLS, UNK, model_tokens

WEIGHT_STEP = 8.0
#: Number of a row within one plan.
ROW = "_row"
#: Rows of a vocabulary, that of the usual English WordPiece model.
VOCAB_SIZE = 30_522


def _round_step(c: Column) -> Column:
    return F.round(c * F.lit(WEIGHT_STEP)) / F.lit(WEIGHT_STEP)


def train_weights(spark: SparkSession, train: DataFrame, k: int = VOCAB_SIZE,
                  alpha: float = 1.0, text_col: str = "text",
                  label_col: str = "label") -> DataFrame:
    """Fit ``(token, w0, w1)`` on labelled rows (labels 0/1) over whole texts,
    tokenized as the model sees them (words and punctuation marks).

    Vocabulary = the ``k`` most frequent training tokens and ``[UNK]``, which
    takes the counts of all others; token counts and priors are smoothed by
    ``alpha``, so a class without training rows has finite weights. The table
    has at most ``k + 2`` rows whatever the corpus size (the bound for its
    broadcast).
    """
    toks = train.select(F.col(label_col).alias("label"),
                        F.explode(model_tokens(F.col(text_col))).alias("token"))
    # label 1 is what is not label 0: the totals need the same columns as the
    # top-k, so both read one exchange
    counts = toks.groupBy("token").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum(F.when(F.col("label") == 0, 1).otherwise(0)).alias("c0"))
    top = counts.orderBy(F.desc("cnt"), F.asc("token")).limit(k)
    everything = counts.agg(F.sum("cnt").alias("a"), F.sum("c0").alias("a0"))
    inside = top.agg(F.sum("cnt").alias("s"), F.sum("c0").alias("s0"))
    unk = everything.crossJoin(inside).select(          # one row each
        F.lit(UNK).alias("token"),
        *[(F.coalesce(a, F.lit(0)) - F.coalesce(s, F.lit(0))).alias(c)
          for a, s, c in (("a", "s", "cnt"), ("a0", "s0", "c0"))])
    whole = Window.partitionBy()  # over the k + 1 rows only
    a = F.lit(float(alpha))
    v = F.count(F.lit(1)).over(whole).cast("double")

    def weight(c: str) -> Column:
        total = F.sum(c).over(whole).cast("double")
        return _round_step(F.log((F.col(c).cast("double") + a) / (total + a * v)))

    words = (top.unionByName(unk).withColumn("c1", F.col("cnt") - F.col("c0"))
             .select("token", weight("c0").alias("w0"), weight("c1").alias("w1")))
    priors = train.agg(
        F.count(F.when(F.col(label_col) == 0, 1)).cast("double").alias("n0"),
        F.count(F.when(F.col(label_col) == 1, 1)).cast("double").alias("n1"))
    n = F.col("n0") + F.col("n1") + a * 2
    bias = priors.select(F.lit(CLS).alias("token"), _round_step(F.log((F.col("n0") + a) / n)).alias("w0"),
                         _round_step(F.log((F.col("n1") + a) / n)).alias("w1"))
    return words.unionByName(bias)


def sequence_tokens(df: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """Long form ``(*id_cols, token)`` of ``[CLS] + words`` over the whole text;
    a NULL text is ``[CLS]`` alone."""
    seq = F.concat(F.array(F.lit(CLS)), F.coalesce(model_tokens(F.col(text_col)), F.array().cast("array<string>")))
    return df.select(*id_cols, F.explode(seq).alias("token"))


def logits(df: DataFrame, weights: DataFrame, id_cols: list[str],
           text_col: str = "text") -> DataFrame:
    """``(*id_cols, l0, l1)``: broadcast lookup of the bounded weight table, then
    a per-row sum. Partial aggregation collapses each row's tokens before the
    shuffle, so only ``(row, id, l0, l1)`` crosses the network. Rows are told
    apart by a number of their own: rows that share an id stay rows."""
    rows = df.withColumn(ROW, F.monotonically_increasing_id())
    toks = sequence_tokens(rows, [ROW, *id_cols], text_col)
    whole = Window.partitionBy()    # the bounded table
    table = weights.select("*", *[F.max(F.when(F.col("token") == UNK, F.col(f"w{c}"))).over(whole).alias(f"_u{c}")
                                  for c in (0, 1)])
    # a row's [CLS] always meets the table and brings the weights of unknown tokens
    unknown = F.sum(F.when(F.col("w0").isNull(), 1).otherwise(0))
    return (toks.join(F.broadcast(table), "token", "left").groupBy(ROW, *id_cols)
            .agg(*[(F.sum(f"w{c}") + unknown * F.max(f"_u{c}")).alias(f"l{c}") for c in (0, 1)]).drop(ROW))


def predict_from_logits(lg: DataFrame, id_cols: list[str]) -> DataFrame:
    """softmax -> argmax -> label name -> rounded score."""
    probs = softmax(F.array(F.col("l0"), F.col("l1")))
    out = lg.select(*id_cols, probs.alias("probs"))
    pred = argmax(F.col("probs")).cast("int")
    return out.select(
        *id_cols,
        pred.alias("pred"),
        label_name(pred).alias("label"),
        round_score(F.array_max("probs")).alias("score"),
        "probs")


def score_texts(df: DataFrame, weights: DataFrame, id_cols: list[str] | str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """M4: ``(*id_cols, pred, label, score, probs)`` for every input row."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    return predict_from_logits(logits(df, weights, ids, text_col), ids)
