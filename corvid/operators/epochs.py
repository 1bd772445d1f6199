"""Epochs of mini-batch gradient steps in integer arithmetic.

A linear text classifier over token shares, trained as the reference trains its
network: epochs over shuffled mini-batches, weight decay, a history row for each
epoch and split, and the epoch with the best validation accuracy kept. Every
number is a fixed-point integer (``ONE`` stands for 1.0) and every division
rounds down, so a sum does not depend on its order and the same steps in SQL give
the same weights, bit for bit:

* ``z = bias + GAIN * sum(tf * w) / n``, ``p = clamp(1/2 + z/4, 0, 1)``,
  ``err = y - p`` (the gradient of a logistic loss with a straight-line sigmoid);
* ``w += RATE * mean(err * GAIN * tf / n) - w / DECAY``, ``bias += RATE * mean(err)``.

A step is two joins and two aggregations over the token rows of its mini-batch
(one folder of the stored table): sums per document, then gradients per token.
The weight table has at most ``k + 2`` rows, is broadcast under that bound, and
is stored after each step, which cuts the lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.functions.text import UNK, model_tokens
from corvid.operators import metrics
from corvid.operators.score import VOCAB_SIZE
from corvid.session import fresh_dir, stored

ONE = 1 << 16
BIAS = "[BIAS]"


@dataclass(frozen=True)
class Schedule:
    """``batches`` mini-batches an epoch; a batch is ``doc_id * shuffle % batches``."""
    epochs: int = 3
    batches: int = 4
    gain: int = 8
    rate: int = 1
    decay: int = 1024
    shuffle: int = 7919
    vocab: int = VOCAB_SIZE


def exact_floor(a: str, b: str) -> Column:
    """Integer division that rounds down."""
    return F.expr(f"({a} - pmod({a}, {b})) div {b}")


def token_rows(docs: DataFrame, train: DataFrame, s: Schedule) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, batch, token, tf, n)`` of all ``docs``, in a folder for each
    batch, and the starting weights ``(token, w)``. The vocabulary is that of
    the training rows; all other tokens are ``[UNK]``."""
    def tokens(df):
        return df.select("doc_id", F.explode(model_tokens(F.col("text"))).alias("token"))
    top = (tokens(train).groupBy("token").agg(F.count(F.lit(1)).alias("c"))
           .orderBy(F.desc("c"), "token").limit(s.vocab).select("token"))
    top = stored(top, "epoch-vocab")
    known = F.broadcast(top.withColumn("_known", F.lit(True)))            # at most ``vocab`` rows
    each = (tokens(docs).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("tf")).join(known, "token", "left")
            .groupBy("doc_id", F.when(F.col("_known"), F.col("token")).otherwise(F.lit(UNK)).alias("token"))
            .agg(F.sum("tf").alias("tf")))
    n = each.groupBy("doc_id").agg(F.sum("tf").alias("n"))
    rows = each.join(n, "doc_id").withColumn("batch", F.pmod(F.col("doc_id") * s.shuffle, F.lit(s.batches)).cast("int"))
    path = fresh_dir(docs.sparkSession, "epoch-tokens")
    rows.write.partitionBy("batch").parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    start = top.select("token").union(docs.sparkSession.createDataFrame([(UNK,), (BIAS,)], "token string")).distinct()
    return rows, stored(start.withColumn("w", F.lit(0).cast("bigint")), "epoch-weights")


def scores(docs: DataFrame, rows: DataFrame, weights: DataFrame, s: Schedule) -> DataFrame:
    """``docs`` with ``z`` (fixed point), ``p`` and ``pred``; a text without tokens has the bias."""
    sums = (rows.join(F.broadcast(weights), "token").groupBy("doc_id")            # at most ``vocab + 2`` rows
            .agg(F.sum(F.col("tf") * F.col("w")).alias("_s"), F.first("n").alias("_n")))
    bias = F.broadcast(weights.filter(F.col("token") == BIAS).select(F.col("w").alias("_b")))   # one row
    out = docs.join(sums, "doc_id", "left").crossJoin(bias)
    out = out.withColumn("z", F.col("_b") + F.coalesce(exact_floor(f"(_s * {s.gain})", "_n"), F.lit(0)))
    p = F.least(F.greatest(F.lit(ONE // 2) + exact_floor("z", "4"), F.lit(0)), F.lit(ONE))
    return out.withColumn("p", p).withColumn("pred", (F.col("z") > 0).cast("int")).drop("_s", "_n", "_b")


def step(docs: DataFrame, rows: DataFrame, weights: DataFrame, s: Schedule) -> DataFrame:
    """The weights after one mini-batch ``(docs, rows)``."""
    # stored: the bias step and the gradients read the same scores
    err = stored(scores(docs, rows, weights, s).select("doc_id", (F.col("label") * ONE - F.col("p")).alias("err")), "epoch-err")
    size = err.agg(F.count(F.lit(1)).alias("_c"), F.coalesce(F.sum("err"), F.lit(0)).alias("_e"))    # one row
    grads = (rows.join(err, "doc_id").select("token", exact_floor(f"(err * tf * {s.gain})", "n").alias("g"))
             .groupBy("token").agg(F.sum("g").alias("g")))
    new = (weights.join(grads, "token", "left").crossJoin(F.broadcast(size))
           .withColumn("_g", F.when(F.col("token") == BIAS, F.col("_e")).otherwise(F.coalesce("g", F.lit(0))) * s.rate)
           .withColumn("_m", F.greatest("_c", F.lit(1))))
    decayed = F.when(F.col("token") == BIAS, F.col("w")).otherwise(F.col("w") - exact_floor("w", str(s.decay)))
    return stored(new.select("token", (decayed + exact_floor("_g", "_m")).cast("bigint").alias("w")), "epoch-weights")


def train_epochs(labelled: DataFrame, s: Schedule = Schedule()) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """``(history, weights after each epoch, token rows)`` of rows ``(doc_id, text, label, split)``.

    The history has a row for each epoch and split: ``epoch, split, n, accuracy,
    f1, loss`` (mean squared error)."""
    docs = stored(labelled.select("doc_id", "label", "split",
                                  F.pmod(F.col("doc_id") * s.shuffle, F.lit(s.batches)).cast("int").alias("batch")), "epoch-docs")
    rows, w = token_rows(labelled, labelled.filter(F.col("split") == "train"), s)
    train = docs.filter(F.col("split") == "train")
    kept, history = [], None
    for epoch in range(1, s.epochs + 1):
        for b in range(s.batches):
            w = step(train.filter(F.col("batch") == b), rows.filter(F.col("batch") == b), w, s)
        kept.append(w)
        scored = stored(scores(docs, rows, w, s).select("split", "label", "pred", "p"), "epoch-scores")   # read twice
        row = epoch_metrics(scored).select(F.lit(epoch).alias("epoch"), "*")
        history = row if history is None else history.unionByName(row)
    return stored(history, "epoch-history"), kept, rows


def epoch_metrics(scored: DataFrame) -> DataFrame:
    """``split, n, accuracy, f1, f1_neg, loss``."""
    err = F.col("label") * ONE - F.col("p")
    loss = scored.groupBy("split").agg(
        F.round(F.sum(err * err).cast("double") / F.count(F.lit(1)) / float(ONE * ONE), metrics.DIGITS).alias("loss"))
    return metrics.binary_metrics(scored, "label", "pred", ["split"]).join(loss, "split")


def best_epoch(history: DataFrame, split: str = "validation") -> DataFrame:
    """``epoch`` with the best accuracy on ``split``, the earliest on ties."""
    return metrics.best_by(history.filter(F.col("split") == split), "epoch", "accuracy")
