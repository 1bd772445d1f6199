"""WordPiece vocabulary learning by merging pairs.

Words start as characters (``##`` marks one that continues a word). In each
round a pair of neighbours scores ``count(ab) / (count(a) * count(b))``: high
where the two rarely stand apart. Of the ``per_round`` best pairs those that
share no piece with a better one are merged at once, so that a vocabulary of
thousands of pieces takes hundreds of jobs, not thousands.

Everything works on distinct words with their counts, a table far smaller than
the corpus; a round is one aggregation of pieces and pairs, and only words that
hold a merged pair are rewritten. The driver sees ``per_round`` rows a round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.operators.wordpiece import CONT
from corvid.session import stored

_SEP = "\u0001"


def word_counts(words: DataFrame) -> DataFrame:
    """``(word, cnt)`` of a column ``word``; empty and NULL words are left out."""
    return words.filter(F.length("word") > 0).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def characters(word: Column) -> Column:
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    return F.transform(chars, lambda c, i: F.when(i == 0, c).otherwise(F.concat(F.lit(CONT), c)))


def pairs_of(pieces: Column) -> Column:
    """Neighbours as ``a\\u0001b``."""
    return F.when(F.size(pieces) > 1, F.transform(F.slice(pieces, 2, F.size(pieces) - 1), lambda b, i: F.concat(
        F.get(pieces, i), F.lit(_SEP), b))).otherwise(F.array().cast("array<string>"))


def merged(pieces: Column, table: Column) -> Column:
    """The pieces with the pairs of ``table`` (pair -> piece) merged, left to right."""
    def step(acc: Column, x: Column) -> Column:
        new = F.try_element_at(table, F.concat(F.try_element_at(acc, F.lit(-1)), F.lit(_SEP), x))
        return F.when(new.isNull(), F.concat(acc, F.array(x))).otherwise(
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(new)))
    return F.aggregate(pieces, F.array().cast("array<string>"), step)


def best_pairs(state: DataFrame, per_round: int, min_count: int) -> list[tuple[str, str, int]]:
    """``(a, b, count)`` of the pairs a round merges, best first."""
    parts = state.select(F.explode("pieces").alias("p"), "cnt").groupBy("p").agg(F.sum("cnt").alias("c"))
    pairs = (state.select(F.explode(pairs_of(F.col("pieces"))).alias("ab"), "cnt").groupBy("ab").agg(F.sum("cnt").alias("n"))
             .filter(F.col("n") >= min_count).select(F.split("ab", _SEP).alias("ab"), "n"))
    a, b = F.get("ab", 0), F.get("ab", 1)
    left, right = (parts.select(F.col("p").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    top = (pairs.select(a.alias("a"), b.alias("b"), "n").join(left, "a").join(right, "b")
           .withColumn("score", F.col("n").cast("double") / (F.col("ca").cast("double") * F.col("cb").cast("double")))
           .orderBy(F.desc("score"), "a", "b").limit(per_round).collect())
    out, seen = [], set()
    for r in top:
        if not {r["a"], r["b"]} & seen:
            out.append((r["a"], r["b"], r["n"]))
        seen |= {r["a"], r["b"]}
    return out


def learn_pieces(counts: DataFrame, rounds: int, per_round: int, min_count: int = 2) -> DataFrame:
    """``(piece, round, n)``: the characters (round 0) with their counts, then every
    merged piece with the count its pair had. Stops early when no pair is left."""
    spark = counts.sparkSession
    state = stored(counts.select("word", "cnt", characters(F.col("word")).alias("pieces")), "pieces")
    out = (state.select(F.explode("pieces").alias("piece"), "cnt").groupBy("piece").agg(F.sum("cnt").alias("n"))
           .select("piece", F.lit(0).alias("round"), "n"))
    learned = []
    for i in range(1, rounds + 1):
        best = best_pairs(state, per_round, min_count)
        if not best:
            break
        learned += [(a + b.removeprefix(CONT), i, n) for a, b, n in best]
        table = F.create_map(*[F.lit(x) for a, b, _ in best for x in (a + _SEP + b, a + b.removeprefix(CONT))])
        keys = F.array(*[F.lit(a + _SEP + b) for a, b, _ in best])
        held = F.arrays_overlap(pairs_of(F.col("pieces")), keys)
        state = stored(state.select("word", "cnt", F.when(held, merged(F.col("pieces"), table)).otherwise(F.col("pieces"))
                                    .alias("pieces")), "pieces")
    return out.unionByName(spark.createDataFrame(learned, "piece string, round int, n bigint"))
