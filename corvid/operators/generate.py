"""G1 learned: synthetic transactions drawn from the counts of labelled rows.

``learn`` counts, as one long table ``(kind, ctx, value, n)``:

- ``label``: (merchant, category) pairs;
- ``next``: the token that follows a token in descriptions of one merchant,
  with a start and an end mark (a first-order chain per label);
- ``month`` and ``amount``: the month and the amount step, per label.

``choices`` gives each value of a context its share ``[lo, hi)`` of the
context's total. A draw is a place in that range, taken from the md5 of the new
row's id and the step, so that every run gives the same rows. A guide table
makes it an equi-join: the range is cut into about as many slots as the context
has values, each value is listed in the slots it overlaps, and a draw meets the
one or two values of its slot. The slot is part of the join key, so the start
mark, which every row begins with, is not one hot key.

Counts are pre-aggregated; the window of ``choices`` holds the distinct values
of one context. Generated frequencies come near the learned ones as the square
root of the number of rows. Rows without a label, date, amount or description
teach nothing; a seed without rows gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END, SEP = "\u0002", "\u0003", "\u001f"
#: Tokens of a generated description at most.
MAX_TOKENS = 8
#: Width of an amount step, in cents.
AMOUNT_STEP = 100_000


def _label() -> Column:
    return F.concat_ws(SEP, "gold_merchant", "gold_category")


def learn(seed: DataFrame, amount_step: int = AMOUNT_STEP) -> DataFrame:
    """``(kind, ctx, value, n)`` of seed rows ``(date, amount, description,
    gold_merchant, gold_category)``."""
    needed = ["date", "amount", "description", "gold_merchant", "gold_category"]
    tokens = F.filter(F.split("description", " "), lambda t: t != "")
    rows = seed.dropna(subset=needed).select(
        _label().alias("label"), tokens.alias("tokens"), F.date_format("date", "yyyy-MM").alias("month"),
        F.floor(F.round(F.col("amount") * 100) / amount_step).cast("string").alias("step"))
    path = F.concat(F.array(F.lit(START)), "tokens", F.array(F.lit(END)))
    pairs = rows.groupBy("label", "tokens").count().select(      # a description is split up once
        "label", "count", F.posexplode(path).alias("i", "t"), path.alias("path")).filter(F.col("t") != END).select(
        F.lit("next").alias("kind"), F.concat_ws(SEP, "label", "t").alias("ctx"),
        F.element_at("path", F.col("i") + 2).alias("value"), "count")
    out = pairs.groupBy("kind", "ctx", "value").agg(F.sum("count").alias("n"))
    one = F.count(F.lit(1)).alias("n")
    for kind, ctx, value in (("label", F.lit(""), "label"), ("month", F.col("label"), "month"),
                             ("amount", F.col("label"), "step")):
        out = out.unionByName(rows.groupBy(F.lit(kind).alias("kind"), ctx.alias("ctx"),
                                           F.col(value).alias("value")).agg(one))
    return out


def choices(counts: DataFrame) -> DataFrame:
    """Guide table ``(kind, ctx, slot, value, lo, hi, total, width)``."""
    ctx = Window.partitionBy("kind", "ctx")
    rising = ctx.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    cut = (counts.withColumn("hi", F.sum("n").over(rising)).withColumn("lo", F.col("hi") - F.col("n"))
           .withColumn("total", F.sum("n").over(ctx))
           .withColumn("width", F.greatest(F.lit(1), F.floor(F.col("total") / F.count(F.lit(1)).over(ctx)))))
    first, last = F.floor(F.col("lo") / F.col("width")), F.floor((F.col("hi") - 1) / F.col("width"))
    return cut.select("kind", "ctx", "value", "lo", "hi", "total", "width", F.explode(F.sequence(first, last)).alias("slot"))


def hash_number(*cols: Column | str) -> Column:
    """A number below 2^60 from the md5 of the columns, joined by ``|``."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("bigint")


def draw(rows: DataFrame, table: DataFrame, kind: str, ctx: Column, name: str, salt: str) -> DataFrame:
    """Add ``name``: a value of ``(kind, ctx)`` drawn by ``synth_id`` and ``salt``;
    null where the context is unknown."""
    part = table.filter(F.col("kind") == kind)
    sizes = part.select(F.col("ctx").alias("_c"), "total", "width").distinct()
    placed = (rows.withColumn("_ctx", ctx).join(sizes, F.col("_ctx") == F.col("_c"), "left")
              .withColumn("_r", F.pmod(hash_number(F.col("synth_id").cast("string"), F.lit(salt)), F.col("total")))
              .withColumn("_slot", F.floor(F.col("_r") / F.col("width"))).drop("_c", "total", "width"))
    values = part.select(F.col("ctx").alias("_c"), F.col("slot").alias("_s"), "lo", "hi", F.col("value").alias(name))
    return placed.join(values, (F.col("_ctx") == F.col("_c")) & (F.col("_slot") == F.col("_s"))
                       & (F.col("_r") >= F.col("lo")) & (F.col("_r") < F.col("hi")), "left").drop(
        "_ctx", "_r", "_slot", "_c", "_s", "lo", "hi")


def generate(ids: DataFrame, counts: DataFrame, max_tokens: int = MAX_TOKENS,
             amount_step: int = AMOUNT_STEP) -> DataFrame:
    """One row for each ``synth_id`` of ``ids``: ``synth_id, date, amount,
    description, gold_merchant, gold_category``. ``counts`` (of ``learn``) is
    read in every step: store it first."""
    table = choices(counts)
    rows = draw(ids.select("synth_id"), table, "label", F.lit(""), "label", "label").filter("label IS NOT NULL")
    rows = rows.withColumns({"words": F.array().cast("array<string>"), "at": F.lit(START)})
    for i in range(max_tokens):
        ctx = F.when(F.col("at") != END, F.concat_ws(SEP, "label", "at"))
        rows = draw(rows, table, "next", ctx, "token", f"token{i}")
        word = F.col("token").isNotNull() & (F.col("token") != END)
        rows = rows.withColumns({
            "words": F.when(word, F.concat("words", F.array("token"))).otherwise(F.col("words")),
            "at": F.coalesce("token", F.lit(END))}).drop("token")
    rows = draw(rows, table, "month", F.col("label"), "month", "month")
    rows = draw(rows, table, "amount", F.col("label"), "step", "amount")
    sid = F.col("synth_id").cast("string")
    day = F.pmod(hash_number(sid, F.lit("day")), F.lit(28)).cast("int")
    cents = F.col("step").cast("bigint") * amount_step + F.pmod(hash_number(sid, F.lit("cents")), F.lit(amount_step))
    parts = F.split("label", SEP)
    return rows.select(
        "synth_id", F.date_add(F.to_date(F.concat("month", F.lit("-01"))), day).alias("date"),
        (cents / 100).alias("amount"), F.array_join("words", " ").alias("description"),
        parts[0].alias("gold_merchant"), parts[1].alias("gold_category"))


def frequencies(seed: DataFrame, made: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """How near the generated rows come: ``(what, value, seed_n, made_n)``."""
    out = None
    for what, value in by.items():
        one = None
        for name, rows in (("seed_n", seed), ("made_n", made)):
            n = rows.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias(name))
            one = n if one is None else one.join(n, "value", "full")
        one = one.select(F.lit(what).alias("what"), "value", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("seed_n", "made_n")])
        out = one if out is None else out.unionByName(one)
    return out
