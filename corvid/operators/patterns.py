"""Merchant rules that hold anywhere in a description.

A theta join of every description with every rule grows with their product. Here
a rule is found by its rarest piece: of the ``GRAM``-letter pieces of its
pattern, the one that the fewest descriptions contain is its key. Descriptions
meet the rules keyed by one of their own pieces, and only those are compared in
full. The pieces of a description that are no rule's key are never shuffled
where Spark can broadcast the keys; a long rule table joins by key, and Spark
splits a hot one.

Work is done once for each distinct description, then joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.operators.bank import MERCHANT_PATTERNS, pattern_table
from corvid.session import stored

#: Letters of a piece; a shorter pattern is a piece by itself.
GRAM = 5


def _pieces(text: Column, width: int) -> Column:
    """The distinct ``width``-letter pieces of a text; none if it is shorter."""
    last = F.length(text) - width + 1
    places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(width))))


def rule_pieces(rules: DataFrame, gram: int = GRAM) -> DataFrame:
    """``(piece, _rule)``: every piece that could be the key of a rule. A rule
    without text is left out."""
    text = F.upper("_rule.pattern")
    pieces = F.when(F.length(text) <= gram, F.array(text)).otherwise(_pieces(text, gram))
    rule = F.struct("priority", (-F.length("pattern")).alias("short"), "pattern", "merchant", "category")
    return (rules.filter(F.length("pattern") > 0).select(rule.alias("_rule")).distinct()
            .select("_rule", F.explode(pieces).alias("piece")))


def match_anywhere(spark: SparkSession, tx: DataFrame, desc_col: str = "description_clean",
                   patterns: DataFrame | Sequence[tuple] = MERCHANT_PATTERNS, gram: int = GRAM) -> DataFrame:
    """``tx`` with ``merchant, category, matched_pattern`` of the first rule (lowest
    priority, then the longer pattern, then its text, merchant, category) whose
    pattern stands anywhere in the description, in either case.

    No match: the text in title case, ``Other``; a NULL description: NULLs.
    """
    rules = patterns if isinstance(patterns, DataFrame) else pattern_table(spark, patterns)
    keys = stored(rule_pieces(rules, gram), "rule-pieces")
    # the lengths of pieces there are: at most ``gram`` numbers
    widths = [r[0] for r in keys.select(F.length("piece")).distinct().collect()]
    d = F.col("_d")
    texts = stored(tx.select(F.col(desc_col).alias("_d")).filter(d.isNotNull()).distinct(), "rule-texts")
    own = F.array_distinct(F.concat(*[_pieces(F.upper(d), w) for w in widths])) if widths else F.array().cast("array<string>")
    held = texts.select("_d", F.explode(own).alias("piece"))
    counts = (held.join(keys.select("piece").distinct(), "piece").groupBy("piece").agg(F.count(F.lit(1)).alias("_n")))
    rarest = (keys.join(counts, "piece", "left")
              .groupBy("_rule").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "piece"))["piece"].alias("piece")))
    rarest = stored(rarest, "rule-keys")
    best = (held.join(rarest, "piece").filter(F.contains(F.upper(d), F.upper("_rule.pattern")))
            .groupBy("_d").agg(F.min("_rule").alias("_best")))
    out = tx.join(best, F.col(desc_col) == d, "left")
    c = F.col(desc_col)
    return (out.withColumn("merchant", F.coalesce(F.col("_best.merchant"), F.initcap(F.lower(c))))
            .withColumn("category", F.when(c.isNotNull(), F.coalesce(F.col("_best.category"), F.lit("Other"))))
            .withColumn("matched_pattern", F.col("_best.pattern")).drop("_best", "_d"))
