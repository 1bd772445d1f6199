"""Spans of regular-expression matches as DataFrame expressions.

A span is ``struct(start, rank, kind, end)`` in code points, end exclusive; the
natural order of the struct is by start, then by the rank of the kind. Patterns
are Java's. Groups that repeat are possessive, so that matching needs no stack
that grows with the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<start:long,rank:int,kind:string,end:long>>"
PLACES = "array<struct<start:long,end:long,text:string,value:string>>"


#: Matches placed at once, and characters of a block of text.
CHUNK, BLOCK = 128, 4096


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once. An expression inside the
    lambda of a higher-order function is computed anew for every element; the
    lambda's variable is not."""
    return F.get(F.transform(F.array(value), body), 0)


def placed(parts: Column, out: str, one: Callable[[Column, Column, Column], Column],
           shift: Callable[[Column, Column], Column]) -> Column:
    """An array of type ``out`` with ``one(start, end, part)`` for every part
    (``gap`` before it, match ``m``) that ``one`` gives a value for.

    Parts are placed chunk by chunk, counting from the chunk's start, and the
    chunks are ``shift``-ed to their places: the time grows with the parts."""
    def of(chunk: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(out).alias("out"))

        def step(acc: Column, x: Column) -> Column:
            begin = (acc["at"] + F.length(x["gap"])).cast("long")
            end = (begin + F.length(x["m"])).cast("long")
            return F.struct(end.alias("at"), F.concat(acc["out"], one(begin, end, x)).alias("out"))
        return F.aggregate(chunk, start, step)

    def chunked(p: Column) -> Column:
        last = F.greatest(F.ceil(F.size(p) / CHUNK).cast("int") - 1, F.lit(0))
        done = F.transform(F.sequence(F.lit(0), last), lambda i: of(F.slice(p, i * CHUNK + 1, F.lit(CHUNK))))
        return let(done, lambda d: let(
            F.aggregate(d, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<long>").alias("from")),
                        lambda acc, c: F.struct((acc["at"] + c["at"]).alias("at"), F.concat(acc["from"], F.array(acc["at"])).alias("from"))),
            lambda f: F.flatten(F.transform(d, lambda c, i: let(
                F.get(f["from"], i), lambda off: F.transform(c["out"], lambda x: shift(x, off)))))))
    return let(parts, chunked)


def match_parts(text: Column, pattern: str, group: int = 0) -> Column:
    """The matches (``m``, ``v`` the given group) with the ``gap`` before each: the
    piece of text that splitting leaves there."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    parts = F.arrays_zip(found.alias("m"), value.alias("v"), F.split(text, pattern, -1).alias("gap"))
    # the last piece has no match behind it
    return F.filter(parts, lambda x: x["m"].isNotNull())


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<start, end, text, value>>`` of the leftmost, non-overlapping
    matches; ``value`` is the given group. Null text has none. Texts without a
    match are only scanned."""
    def one(begin: Column, end: Column, x: Column) -> Column:
        return F.array(F.struct(begin.alias("start"), end.alias("end"), x["m"].alias("text"), x["v"].alias("value")))

    def shift(x: Column, off: Column) -> Column:
        return F.struct((x["start"] + off).alias("start"), (x["end"] + off).alias("end"),
                        x["text"].alias("text"), x["value"].alias("value"))
    found = placed(match_parts(text, pattern, group), PLACES, one, shift)
    return F.when(F.coalesce(text, F.lit("")).rlike(pattern), found).otherwise(F.array().cast(PLACES))


def blocks_of(text: Column, many: Column) -> Column:
    """``struct(width, parts, size)``: the text in blocks where there is ``many`` to
    read in it, else in one. To be bound with ``let``."""
    return F.struct(F.when(many, F.lit(BLOCK)).otherwise(F.lit((1 << 31) - 1)).cast("long").alias("width"),
                    F.when(many, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))).otherwise(F.array(text)).alias("parts"),
                    F.length(text).alias("size"))


def block_text(b: Column, begin: Column, length: Column) -> Column:
    """``length`` characters from ``begin`` (from 0), read from the blocks they lie in."""
    first, last = F.floor(begin / b["width"]), F.floor((begin + length) / b["width"])
    near = F.array_join(F.slice(b["parts"], (first + 1).cast("int"), (last - first + 1).cast("int")), "")
    return F.substring(near, (begin - first * b["width"] + 1).cast("int"), length.cast("int"))


def as_spans(places: Column, rank: int, kind: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the matches that pass ``keep``."""
    kept = F.filter(places, keep) if keep else places
    return F.transform(kept, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans in order, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def overlaps(a: Column, spans: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"]))


#: Characters of a coarse and a fine cell, and how far a fine one looks ahead.
COARSE, FINE, AHEAD = 16_384, 512, 128
#: Spans up to which comparing with each is cheapest.
FEW = 24


def cells_of(spans: Column, size: Column) -> Column:
    """Spans by the stretch of text they touch, coarse and fine, for
    ``meets``. To be bound with ``let``; one empty cell where they are few."""
    def touching(among: Column, begin: Column, width: int) -> Column:
        return F.filter(among, lambda s: (s["start"] < begin + width + AHEAD) & (s["end"] > begin))

    def fine(c: Column, i: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(COARSE // FINE - 1)),
                           lambda k: touching(c, i * COARSE + k * FINE, FINE))
    last = F.when(F.size(spans) > FEW, F.floor(size / COARSE).cast("int")).otherwise(F.lit(0))
    coarse = F.transform(F.sequence(F.lit(0), last), lambda i: touching(spans, i * COARSE, COARSE))
    return F.when(F.size(spans) > FEW, F.transform(coarse, fine))


def meets(a: Column, spans: Column, cells: Column) -> Column:
    """Does ``a`` overlap one of the ``spans``, looked up in their ``cells``."""
    near = F.get(F.get(cells, F.floor(a["start"] / COARSE).cast("int")), F.floor((a["start"] % COARSE) / FINE).cast("int"))
    return F.when(cells.isNull() | (a["end"] - a["start"] > AHEAD), overlaps(a, spans)).otherwise(overlaps(a, near))


def replaced(text: Column, edits: Column) -> Column:
    """The text with each ``struct(start, end, put)`` replaced; where some overlap
    the first one's ``put`` stands for all they cover. ``edits`` are sorted by start."""
    kind = "array<struct<start:long,end:long,put:string>>"

    def merge(acc: Column, e: Column) -> Column:
        one = F.array(F.struct(e["start"].alias("start"), e["end"].alias("end"), e["put"].alias("put")))
        last = F.get(acc, F.size(acc) - 1)
        wider = F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], e["end"]).alias("end"), last["put"].alias("put")))
        return F.when(e["start"] < last["end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), wider)).otherwise(F.concat(acc, one))

    def filled(b: Column, kept: Column) -> Column:
        def piece(e: Column, i: Column) -> Column:
            at = F.when(i > 0, F.get(kept, i - 1)["end"]).otherwise(F.lit(0).cast("long"))
            return F.concat(block_text(b, at, e["start"] - at), e["put"])
        end = F.coalesce(F.get(kept, F.size(kept) - 1)["end"], F.lit(0).cast("long"))
        return F.concat(F.array_join(F.transform(kept, piece), ""), block_text(b, end, b["size"] - end))

    return let(F.aggregate(edits, F.array().cast(kind), merge),
               lambda kept: let(blocks_of(text, F.size(kept) > FEW), lambda b: filled(b, kept)))
