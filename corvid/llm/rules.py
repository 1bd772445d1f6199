"""Quality rules (5): learned decision lists.

Every text gets countable statistics. From the labelled ones a list of rejecting
rules is learned by sequential covering: a rule *grows* by the threshold
condition with the best gain on the rows not yet covered, up to
``MAX_CONDITIONS`` of them, and is then *pruned* on rows set aside to the prefix
with the best margin of right over wrong rejections. A rule that does not reach
``MIN_PRECISION`` there ends the list. The list is a Spark conditional
expression, in order.

Every value of the rows not yet covered is tried as a threshold. Quantiles of
each statistic cut it into bins; a step first counts each bin, then looks at the
single values of the bins that can hold the best threshold, as running sums
inside each bin. The driver gets a row per statistic and bin, and the winner.
Only DataFrame functions.

Defined cases: null and empty texts have no words and fail the base rule; with
no labelled rows, or one class only, the list is empty and keeps what passes
the base rule; null ids are not labelled; equal rows get equal results; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.spark_util import GAP_CHARS, WORD_GAP, read_table, stored

GRAM = 5
SYMBOLS = "#*$%&|<>"
MAX_RULES, MAX_CONDITIONS, BINS = 12, 3, 24
MIN_PRECISION, MIN_COVER = 0.8, 5


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts over the whole text of every row, keyed by ``key``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"))
    rows = rows.select("key", "text", F.btrim("text", F.lit(GAP_CHARS)).alias("trimmed"))
    rows = rows.select(
        "key", "text",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>"))
        .otherwise(F.split("trimmed", WORD_GAP)).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, GAP_CHARS, "")) > 0).alias("lines"))
    word = F.col("words")
    grams = F.when(F.size("words") >= GRAM, F.transform(
        F.sequence(F.lit(0), F.size("words") - GRAM),
        lambda i: F.xxhash64(*[F.get(word, i + j) for j in range(GRAM)]))).otherwise(F.array().cast("array<bigint>"))
    size = F.length("text")
    rows = rows.select(
        "key", grams.alias("grams"), F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("text", GAP_CHARS, "")).cast("long").alias("word_chars"),
        (size - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        (size - F.length(F.translate("text", "!?", ""))).cast("long").alias("n_marks"),
        (size - F.length(F.translate("text", "0123456789", ""))).cast("long").alias("n_digits"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))
    # windows that occur again: sort their hashes only where two are equal
    again = F.size(F.array_distinct("grams")) < F.size("grams")
    rows = rows.withColumn("sorted", F.when(again, F.array_sort(F.transform(
        "grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))).drop("grams")
    by = F.col("sorted")
    rows = rows.withColumn("at", F.array_sort(F.transform(F.filter(
        by, lambda x, k: F.coalesce(F.get(by, k - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(by, k + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))).drop("sorted")
    at = F.col("at")
    words_in = F.aggregate(F.transform(at, lambda v, k: F.least(F.lit(GRAM), F.coalesce(F.get(at, k + 1) - v, F.lit(GRAM)))),
                           F.lit(0), lambda a, b: a + b)
    return rows.withColumn("n_repeat_words", F.coalesce(words_in, F.lit(0)).cast("long")).drop("at")


def _per(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


#: The statistics rules may test, by name.
FEATURES = {
    "words": lambda: F.col("n_words").cast("double"),
    "word_length": lambda: _per("word_chars", "n_words"),
    "symbols_per_word": lambda: _per("n_symbols", "n_words"),
    "dup_line_share": lambda: _per("n_dup_lines", "n_lines"),
    "repeat_share": lambda: _per("n_repeat_words", "n_words"),
    "distinct_share": lambda: _per("n_distinct", "n_words"),
    "marks_per_word": lambda: _per("n_marks", "n_words"),
    "digits_per_char": lambda: _per("n_digits", "word_chars"),
    "upper_per_char": lambda: _per("n_upper", "word_chars"),
}


@dataclass(frozen=True)
class Condition:
    """``feature >= threshold`` or, for ``above`` false, ``feature < threshold``."""
    feature: str
    above: bool
    threshold: float

    def column(self, value: Column | None = None) -> Column:
        v = FEATURES[self.feature]() if value is None else value
        return v >= self.threshold if self.above else v < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


def _all(conditions, column) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & column(c)
    return out


class Learner:
    """Labelled rows as counts of equal values; see the module's text."""

    def __init__(self, labelled: DataFrame):
        """``labelled``: the statistics, ``label`` (1 good, 0 bad) and ``aside``."""
        names = list(FEATURES)
        values = labelled.select("label", "aside", *[FEATURES[n]().alias(n) for n in names])
        cuts = values.agg(*[F.percentile_approx(n, [i / BINS for i in range(1, BINS)], 5_000).alias(n) for n in names]).first()
        self.cuts = {n: sorted(set(cuts[n] or ())) for n in names}
        rows = values.groupBy("label", "aside", *names).agg(F.count(F.lit(1)).alias("n"))
        self.rows = stored(rows.select("*", *[self._bin(n).alias(f"bin_{n}") for n in names]), "rule-rows")

    def _bin(self, name: str) -> Column:
        """How many of the statistic's thresholds a value reaches."""
        out = F.lit(0)
        for cut in self.cuts[name]:
            out = out + (F.col(name) >= cut).cast("int")
        return out

    def column(self, c: Condition) -> Column:
        """The condition on the labelled rows."""
        return c.column(F.col(c.feature))

    def _bins(self, rows: DataFrame) -> dict[str, list[list[int]]]:
        """Per statistic and bin: rows with label 0, rows with label 1."""
        names = list(FEATURES)
        got = (rows.select("label", "n", F.explode(F.array(*[
                   F.struct(F.lit(i).alias("f"), F.col(f"bin_{n}").alias("b")) for i, n in enumerate(names)])).alias("x"))
               .groupBy("x.f", "x.b").agg(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("bad"),
                                          F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("good"))
               .collect())                      # BINS rows for each statistic at most
        out = {n: [[0, 0] for _ in range(len(self.cuts[n]) + 1)] for n in names}
        for r in got:
            out[names[r["f"]]][r["b"]] = [r["bad"], r["good"]]
        return out

    def grow(self, open_rows: DataFrame) -> list[Condition]:
        conditions: list[Condition] = []
        while len(conditions) < MAX_CONDITIONS:
            rows = open_rows.filter(_all(conditions, self.column)) if conditions else open_rows
            bins = self._bins(rows)
            bad, good = (sum(b[k] for b in next(iter(bins.values()))) for k in (0, 1))
            if not bad or not good:
                break
            best = self._best(rows, bins, bad, good)
            if best is None:
                break
            conditions.append(best)
        return conditions

    def _best(self, rows: DataFrame, bins: dict[str, list[list[int]]], bad: int, good: int) -> Condition | None:
        """The condition of the best gain, over all values as thresholds. Bins in
        which no threshold can beat the best bin edge are left out."""
        base = math.log2(bad / (bad + good))

        def gain(p: int, n: int) -> float:
            return p * (math.log2(p / (p + n)) - base) if p >= MIN_COVER else 0.0

        edge, spans = 0.0, []
        for f, table in enumerate(bins.values()):
            p, n = 0, 0
            for b, (in_bad, in_good) in enumerate(table):
                edge = max(edge, gain(p, n), gain(bad - p, good - n))
                most = max(gain(p + in_bad, n), gain(bad - p, good - n - in_good))
                spans.append((most, f, b, p, n))
                p, n = p + in_bad, n + in_good
        spans = [x[1:] for x in spans if x[0] > 1e-9 and x[0] >= edge - 1e-9]
        if not spans:
            return None
        names = list(FEATURES)
        before = F.create_map(*[x for f, b, p, n in spans for x in (
            F.lit(f * 1000 + b), F.struct(F.lit(p).cast("long").alias("p"), F.lit(n).cast("long").alias("n")))])
        per = {f: [b for g, b, _, _ in spans if g == f] for f, *_ in spans}
        tests = F.filter(F.array(*[F.when(F.col(f"bin_{names[f]}").isin(at), F.struct(
            F.lit(f).alias("f"), F.col(f"bin_{names[f]}").alias("b"), F.col(names[f]).alias("v"))) for f, at in per.items()]),
            lambda x: x.isNotNull())
        values = (rows.select("label", "n", F.explode(tests).alias("x")).groupBy("x.f", "x.b", "x.v")
                  .agg(F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("bad"),
                       F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("good")))
        under = Window.partitionBy("f", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
        low = F.element_at(before, F.col("f") * 1000 + F.col("b"))
        values = values.select("f", "v", *[(low[k] + F.coalesce(F.sum(c).over(under), F.lit(0))).alias(k)
                                           for k, c in (("p", "bad"), ("n", "good"))])
        sides = values.select("f", "v", F.explode(F.array(
            F.struct(F.lit(False).alias("above"), F.col("p").alias("p"), F.col("n").alias("n")),
            F.struct(F.lit(True).alias("above"), (F.lit(bad) - F.col("p")).alias("p"), (F.lit(good) - F.col("n")).alias("n")))).alias("s"))
        got = (sides.select("f", "v", "s.*").filter(F.col("p") >= MIN_COVER)
               .withColumn("gain", F.round(F.col("p") * (F.log2(F.col("p") / (F.col("p") + F.col("n"))) - base), 9))
               .agg(F.max(F.struct("gain", (-F.col("f")).alias("f"), (~F.col("above")).alias("below"), (-F.col("v")).alias("v"))).alias("x"))
               .first()["x"])
        if got is None or got["gain"] <= 1e-9:
            return None
        return Condition(names[-got["f"]], not got["below"], 0.0 - got["v"])

    def prune(self, conditions: list[Condition], aside: DataFrame) -> tuple[list[Condition], float]:
        """The best prefix on the rows set aside, and its precision there."""
        fits = [_all(conditions[:k], self.column) for k in range(1, len(conditions) + 1)]
        got = aside.agg(*[F.sum(F.when(f & (F.col("label") == y), F.col("n")).otherwise(0)).alias(f"c{k}_{y}")
                          for k, f in enumerate(fits) for y in (0, 1)]).first()
        scored = []
        for k in range(len(fits)):
            p, n = got[f"c{k}_0"] or 0, got[f"c{k}_1"] or 0
            scored.append(((p - n) / (p + n) if p + n else -1.0, p, -k, p / (p + n) if p + n else 0.0))
        margin, _, k, precision = max(scored)
        return conditions[:1 - k], precision

    def learn(self) -> list[list[Condition]]:
        rules: list[list[Condition]] = []
        rest = self.rows
        while len(rules) < MAX_RULES:
            grown = self.grow(rest.filter(~F.col("aside")))
            if not grown:
                break
            rule, precision = self.prune(grown, rest.filter("aside"))
            if precision < MIN_PRECISION:
                break
            rules.append(rule)
            rest = rest.filter(~_all(rule, self.column))
        return rules


def learn_rules(stats: DataFrame, labels: DataFrame) -> list[list[Condition]]:
    """Rejecting rules, in order, from ``statistics`` rows and ``labels``."""
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.max("quality").alias("label")).withColumnRenamed("doc_id", "key"))
    aside = F.crc32(F.encode(F.concat(F.lit("aside:"), F.col("key").cast("string")), "UTF-8")) % 3 == 0
    return Learner(stats.join(known, "key").withColumn("aside", aside)).learn()


def verdict(rules: list[list[Condition]]) -> Column:
    """The decision list as one conditional expression: the first rule that
    holds rejects, otherwise the row is kept."""
    out = F.when(F.lit(False), F.lit(False))
    for rule in rules:
        out = out.when(_all(rule, Condition.column), F.lit(False))
    return out.otherwise(F.lit(True))


def rule_text(rules: list[list[Condition]]) -> list[str]:
    """The list as readable lines."""
    return [f"reject if {' and '.join(map(str, rule))}" for rule in rules]


def op5_rules(spark, sf_dir: str) -> DataFrame:
    stats = stored(statistics(read_table(spark, sf_dir, "documents")), "text-statistics")
    rules = learn_rules(stats, read_table(spark, sf_dir, "labels"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return stats.select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
