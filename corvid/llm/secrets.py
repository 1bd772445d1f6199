"""Secret scans (6): sliding-window entropy over candidate strings.

Base kinds (``assign``, ``access``, ``hex``) are found by pattern. On top,
candidates are the maximal runs of key characters. Each is put in a character
class (hex digits, letters and digits, base64), and a window slides over it.
The window's Shannon entropy is kept up to date from counts: a character that
enters or leaves changes one count ``c``, and the sum of ``c log2 c`` changes by
the difference of two table entries. Windows at or above the class's threshold
are joined into spans of kind ``entropy``. Windows that meet a base span, or a
part between delimiters that holds an allowed word, do not count: what is left
of the candidate beside them is scanned by itself.

Only DataFrame expressions; one pass over each text, no shuffle.

Defined cases: null texts are empty and have no spans; equal rows get equal
results; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.spans import SPANS, as_spans, joined, matches
from corvid.llm.spark_util import read_table

# fixed values: the base kinds
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"          # AKIA[A-Z0-9]+ of 16 or more
HEX = r"[0-9a-f]{32,}"                 # [0-9a-f]+ of 32 or more

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character class -> (its candidates, least entropy of a window in bits).
CLASSES = (("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.1),
           ("alnum", r"^[A-Za-z0-9]+$", 3.8),
           ("base64", r"", 3.9))
#: Candidates that are no secrets, whatever their entropy.
ALLOWED = (
    r"^[0-9]+$",                                                    # numbers
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",      # UUIDs
    r"^[A-Za-z]+(?:[/_=+-]+[A-Za-z]+)*[/_=+-]*$",                   # words, paths and names of letters only
    r"^(?:[0-9]{1,4}[/_-])+[0-9]*$",                                # dates and numbered parts
)
#: Words that make the part of a candidate between delimiters no secret.
WORDS = r"(?i)example|sample|placeholder|changeme|dummy|x{6,}|0123456789|abcdefgh"
PART = r"[^/_=+-]++"


#: Characters of a candidate scanned at once.
PIECE = 256
PLACES_ONLY = "array<struct<start:long,end:long>>"


def _gain() -> Column:
    """``c * log2(c)`` for c from 0 to the window's length."""
    return F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 1)])


def entropy_windows(candidate: Column, threshold: Column) -> Column:
    """``array<struct<start, end>>`` of the joined windows at the threshold.

    A run is cut into pieces of ``PIECE`` characters, each read with the last
    ``WINDOW - 1`` of the one before it: every window lies in one piece, a step
    costs the same anywhere in a run, and the time grows with its length."""
    pieces = F.regexp_extract_all(candidate, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    pairs = F.arrays_zip(pieces.alias("p"), F.concat(F.array(F.lit("")), pieces).alias("before"))
    # bound to the variables of a lambda each is computed once, not once a step
    read = F.transform(F.filter(pairs, lambda x: x["p"].isNotNull()), lambda x, i: F.struct(
        (i * PIECE - F.least(F.length(x["before"]), F.lit(WINDOW - 1))).cast("long").alias("offset"),
        F.concat(F.substring(x["before"], 1 - WINDOW, WINDOW - 1), x["p"]).alias("text")))

    def of(r: Column) -> Column:
        return F.transform(_piece_windows(r["text"], threshold), lambda w: F.struct(
            (r["offset"] + w["start"]).alias("start"), (r["offset"] + w["end"]).alias("end")))

    def join(acc: Column, w: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        grown = F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                         F.array(F.struct(last["start"].alias("start"), w["end"].alias("end"))))
        return F.when(last.isNotNull() & (last["end"] >= w["start"]), grown).otherwise(F.concat(acc, F.array(w)))

    return F.aggregate(F.flatten(F.transform(read, of)), F.array().cast(PLACES_ONLY), join)


def _piece_windows(candidate: Column, threshold: Column) -> Column:
    """The joined windows of one piece."""
    table = _gain()

    def count(window: Column, char: Column) -> Column:
        return F.length(window) - F.length(F.replace(window, char, F.lit("")))

    def change(window: Column, char: Column) -> Column:
        """What one more ``char`` adds to the sum over ``window``."""
        c = count(window, char)
        return F.get(table, c + 1) - F.get(table, c)

    def step(acc: Column, i: Column) -> Column:
        # i is the place (from 1) of the character that enters
        at = i.cast("int")
        inside = F.substring(candidate, F.greatest(at - (WINDOW - 1), F.lit(1)), F.least(at - 1, F.lit(WINDOW - 1)))
        enter = change(inside, F.substring(candidate, at, F.lit(1)))
        full = F.substring(candidate, at - WINDOW + 1, F.lit(WINDOW))
        leave = F.when(at >= WINDOW, change(F.substring(full, 2, WINDOW), F.substring(full, 1, 1))).otherwise(0.0)
        total = acc["sum"] + enter
        hot = (at >= WINDOW) & (F.lit(math.log2(WINDOW)) - total / WINDOW >= threshold - 1e-9)
        last = F.get(acc["out"], F.size(acc["out"]) - 1)
        begin, end = (i - WINDOW).cast("long"), i.cast("long")
        grown = F.concat(F.slice(acc["out"], 1, F.greatest(F.size(acc["out"]) - 1, F.lit(0))),
                         F.array(F.struct(last["start"].alias("start"), end.alias("end"))))
        added = F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("end"))))
        out = F.when(~hot, acc["out"]).when(last.isNotNull() & (last["end"] >= begin), grown).otherwise(added)
        return F.struct((total - leave).alias("sum"), out.alias("out"))

    zero = F.struct(F.lit(0.0).alias("sum"), F.array().cast(PLACES_ONLY).alias("out"))
    return F.aggregate(F.sequence(F.lit(1), F.length(candidate)), zero, step)["out"]


def _threshold(candidate: Column) -> Column:
    out = F.lit(CLASSES[-1][2])
    for _, pattern, least in reversed(CLASSES[:-1]):
        out = F.when(candidate.rlike(pattern), F.lit(least)).otherwise(out)
    return out


def _allowed(candidate: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | candidate.rlike(pattern)
    return out


def clear_runs(m: Column, base: Column) -> Column:
    """What is left of the candidate ``m`` outside base spans and outside parts
    that hold an allowed word, as ``array<struct<start, end, text>>``."""
    place = "array<struct<start:long,end:long>>"
    met = F.transform(F.filter(base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])),
                      lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
    parts = F.when(m["text"].rlike(WORDS), F.transform(
        F.filter(matches(m["text"], PART), lambda p: p["text"].rlike(WORDS)), lambda p: F.struct(
            (m["start"] + p["start"]).alias("start"), (m["start"] + p["end"]).alias("end")))).otherwise(F.array().cast(place))
    last = F.array(F.struct(m["end"].alias("start"), m["end"].alias("end")))
    blocks = F.concat(F.array_sort(F.concat(met, parts)), last)
    zero = F.struct(m["start"].alias("at"), F.array().cast(place).alias("out"))

    def step(acc: Column, b: Column) -> Column:
        one = F.struct(acc["at"].alias("start"), b["start"].alias("end"))
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.when(
            b["start"] - acc["at"] >= WINDOW, F.concat(acc["out"], F.array(one))).otherwise(acc["out"]).alias("out"))

    return F.transform(F.aggregate(blocks, zero, step)["out"], lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), F.substring(
            m["text"], (r["start"] - m["start"] + 1).cast("int"), (r["end"] - r["start"]).cast("int")).alias("text"),
        (r["start"] > m["start"]).alias("behind")))


def entropy_spans(places: Column, base: Column) -> Column:
    """Spans of kind ``entropy`` in the candidates, clear of ``base`` spans."""
    def of(r: Column) -> Column:
        return F.transform(entropy_windows(r["text"], r["least"]), lambda w: F.struct(
            (r["start"] + w["start"]).alias("start"), F.lit(4).alias("rank"), F.lit("entropy").alias("kind"),
            (r["start"] + w["end"]).alias("end")))

    # the delimiter behind a base span or an allowed part is no part of a number, path or UUID
    def allowed(r: Column) -> Column:
        return _allowed(F.when(r["behind"], F.regexp_replace(r["text"], r"^[/_=+-]+", "")).otherwise(r["text"]))

    whole = F.filter(places, lambda m: ~_allowed(m["text"]))
    suspects = F.filter(F.flatten(F.transform(whole, lambda m: clear_runs(m, base))), lambda r: ~allowed(r))
    suspects = F.transform(suspects, lambda r: F.struct(
        r["start"].alias("start"), r["text"].alias("text"), _threshold(r["text"]).alias("least")))
    return F.flatten(F.transform(suspects, of))


def secret_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, base, added)``: base spans and entropy spans of every row."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.select("key",
                       matches(F.col("text"), ASSIGN, 1).alias("assign"), matches(F.col("text"), ACCESS).alias("access"),
                       matches(F.col("text"), HEX).alias("hex"), matches(F.col("text"), CANDIDATE).alias("run"))
    rows = rows.select("key", "run", F.concat(
        as_spans(F.col("assign"), 1, "assign", lambda m: F.length(m["value"]) >= 8),
        as_spans(F.col("access"), 2, "access"), as_spans(F.col("hex"), 3, "hex")).cast(SPANS).alias("base"))
    return rows.select("key", "base", F.when(F.size("run") > 0, entropy_spans(F.col("run"), F.col("base")))
                       .otherwise(F.array()).cast(SPANS).alias("added"))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op6_secrets(spark, sf_dir: str) -> DataFrame:
    rows = secret_spans(read_table(spark, sf_dir, "documents"))
    base = F.col("base")
    return rows.select(
        F.col("key").alias("doc_id"), *[count_kind(base, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.concat("base", "added")).alias("spans"))
