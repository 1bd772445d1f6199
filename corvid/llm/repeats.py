"""Suffix-array dedup (1): common-prefix interval trees over sampled suffixes.

Finds every byte that lies in a string of ``MIN_LEN`` bytes that also starts
elsewhere, in another text or the same one.

1. *Sampling.* Of the ``SEED``-byte strings of every ``MIN_LEN``-byte window the
   one with the least hash (leftmost on ties) is the window's seed. Equal
   windows have the same seed at the same offset, so two equal windows meet at
   their seed, and each window start belongs to exactly one seed. Only seeds
   that occur at two or more places go on.
2. *Enhanced suffix array of each seed's bucket.* The suffixes behind the seed's
   occurrences are sorted, with the common-prefix lengths of neighbours. A
   stack scan lists the common-prefix intervals: all suffixes that share ``r``
   bytes, not just neighbours. For each interval the left extension is tested:
   its members are arranged by the text before the seed, and a second scan
   lists the sets that share ``l`` bytes there and no more (left-diverse). A
   set from at least two children of the interval (right-diverse) with
   ``l + SEED + r >= MIN_LEN`` is a maximal repeat group; all its occurrences
   are reported. Context goes as far as the windows of the seed reach, so a
   repeat longer than a window is reported as the chain of its seeds' groups.
3. *Hot buckets.* A seed with more than ``SPLIT`` occurrences gives the same
   groups without one task holding its bucket. Occurrences with equal context
   are folded. A group that shares ``r`` bytes behind the seed belongs to one
   part of the bucket, that of the window ending there; a part is ordered by the
   text before its window alone. Parts with more than ``SPLIT`` contexts descend
   the tree level by level in Spark: the least and the greatest text of a node
   give its common prefix, its members go on to the child of their next byte,
   until every node fits a task.

Copies of one text are one node throughout; a text that occurs in several rows
is a repeat as a whole.

The same method on words in place of bytes finds passages: every word becomes
``CODE`` letters of its hash, and strings of ``MIN_WORDS`` words are looked for.
A passage of short words has fewer than ``MIN_LEN`` bytes and is told, not removed.

Defined cases: null and empty texts have no bytes; texts below ``MIN_LEN``
bytes keep everything; equal rows are copies of each other; null doc_ids are
kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.spark_util import read_table, stored
from corvid.llm.textbatch import RollingHash, chunks, rows_of, text_buffer, words

MIN_LEN, SEED = 400, 128
#: Words of the shortest passage, and of its seed; letters of a word's code, 6 bits each.
MIN_WORDS, SEED_WORDS, CODE = 51, 16, 5
#: Words that are hashed at once.
PART = 1 << 14
#: Occurrences of a seed, or contexts of a tree node, that one task holds at most.
SPLIT = 20_000
#: Longest stretch of one text that is scanned at once.
STRETCH = 1 << 20
#: Bytes of short texts that are scanned at once.
SCAN = 1 << 18
#: Texts whose places or stretches are Python objects at once.
TEXTS = 256
LOW = np.uint64((1 << 24) - 1)


def sample_seeds(data: np.ndarray, off: np.ndarray, min_len: int = MIN_LEN, seed: int = SEED):
    """``(place, first window, last window, hash)`` of the seeds of the texts.

    The windows of a seed start at ``first..last``, and every window start of
    every text belongs to one returned seed.
    """
    if len(data) <= STRETCH + min_len or len(off) > 2:
        return _seeds(data, off, min_len, seed)
    parts = [_seeds(data[a:a + STRETCH + min_len - 1], np.array([0, min(STRETCH + min_len - 1, len(data) - a)]), min_len, seed)
             for a in range(0, len(data), STRETCH)]
    p, s, e = (np.concatenate([part[i] + k * STRETCH for k, part in enumerate(parts)]) for i in range(3))
    new = np.flatnonzero(np.append(True, p[1:] != p[:-1]))      # a seed met from both sides is one
    return p[new], s[new], e[np.append(new[1:], len(p)) - 1], np.concatenate([x[3] for x in parts])[new]


def _seeds(data, off, min_len, seed):
    h = RollingHash(data).windows(seed)
    wide = min_len - seed + 1
    none = np.empty(0, np.int64)
    if len(h) < wide:
        return none, none, none, h[:0]
    least = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)     # the place breaks ties
    span = 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[:span - wide], least[wide - span:])
    ends = np.zeros(len(data) + 1, np.int32)                    # starts too close to a text's end
    np.add.at(ends, np.maximum(off[:-1], off[1:] - min_len + 1), 1)
    np.add.at(ends, off[1:], -1)
    start = np.flatnonzero(np.cumsum(ends)[:len(least)] == 0)
    if not len(start):
        return none, none, none, h[:0]
    place = (least[start] & LOW).astype(np.int64)
    new = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)))
    p = place[new]
    return p, start[new], start[np.append(new[1:] - 1, len(start) - 1)], h[p]


# -- enhanced suffix array of one bucket ---------------------------------------

def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(lcp: Sequence[int], least: int) -> Iterator[tuple[int, int, int]]:
    """``(depth, first, last)`` of the common-prefix intervals, by a stack scan.

    ``lcp[i]`` is the common prefix of entries ``i`` and ``i + 1``; intervals of
    depth below ``least`` are left out. Children come before their parents.
    """
    stack: list[tuple[int, int]] = []
    for i in range(len(lcp) + 1):
        here = lcp[i] if i < len(lcp) else -1
        first = i
        while stack and stack[-1][0] > here:
            depth, first = stack.pop()
            if depth >= least:
                yield depth, first, i
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, first))


def bucket_groups(contexts: Sequence[tuple[bytes, bytes]], need: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeat groups ``(l, r, members)`` of distinct contexts.

    A context is ``(text before the seed, reversed; text behind it)``; groups
    have ``l + r >= need``.
    """
    m = len(contexts)
    if m == 2:
        l, r = common(contexts[0][0], contexts[1][0]), common(contexts[0][1], contexts[1][1])
        if l + r >= need:
            yield l, r, [0, 1]
        return
    order = sorted(range(m), key=lambda i: contexts[i][1])
    lcp = [common(contexts[order[i]][1], contexts[order[i + 1]][1]) for i in range(m - 1)]
    rank = [0] * m
    for at, i in enumerate(sorted(range(m), key=lambda i: contexts[i][0])):
        rank[i] = at
    for r, first, last in intervals(lcp, 0):
        child = {order[first]: 0}
        for at in range(first + 1, last + 1):
            child[order[at]] = child[order[at - 1]] + (lcp[at - 1] == r)
        members = sorted(child, key=rank.__getitem__)
        left = [common(contexts[members[i]][0], contexts[members[i + 1]][0]) for i in range(len(members) - 1)]
        for l, a, z in intervals(left, max(0, need - r)):
            group = members[a:z + 1]
            if any(child[i] != child[group[0]] for i in group):
                yield l, r, group


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one seed at a time; the rows come sorted by seed."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _part(seed: bytes, left: bytes, right: bytes, r: int, need: int) -> bytes:
    """Name of the window that ends ``r`` bytes behind the seed."""
    return hashlib.blake2b(b"%b%d." % (seed, r) + left[:need - r] + right[:r], digest_size=16).digest()


def _name(part: bytes, rest: bytes) -> bytes:
    """Name of the group that shares a window and ``rest`` before it."""
    return hashlib.md5(part + rest).digest()


def _groups(need: int, seed: int, extents: bool) -> Callable:
    """Rows ``(seed, node, place, left, right)`` -> groups, or covered stretches."""
    def run(batches):
        out: list[tuple] = []
        for rows in _buckets(batches):
            at: dict[tuple[bytes, bytes], list[int]] = {}
            for i, row in enumerate(rows):
                at.setdefault((row[3][::-1], row[4]), []).append(i)
            contexts, places = list(at), list(at.values())
            found = [(len(c[0]), len(c[1]), [j]) for j, c in enumerate(contexts)
                     if len(places[j]) > 1 and len(c[0]) + len(c[1]) >= need]
            if len(contexts) > 1:
                found += bucket_groups(contexts, need)
            if extents:
                most: dict[int, tuple[int, int]] = {}
                for l, r, members in found:
                    for j in members:
                        a, b = most.get(j, (0, 0))
                        most[j] = (max(a, l), max(b, r))
                out += [(rows[i][1], rows[i][2] - l, rows[i][2] + seed + r)
                        for j, (l, r) in most.items() for i in places[j]]
            else:
                for l, r, members in found:
                    left, right = contexts[members[0]]
                    name = _name(_part(rows[0][0], left, right, r, need), left[need - r:l])
                    out += [(rows[i][1], rows[i][2] - l, rows[i][2] + seed + r, name) for j in members for i in places[j]]
            if len(out) > 50_000:
                yield _batch(out, extents)
                out = []
        yield _batch(out, extents)
    return run


def _batch(rows: list[tuple], extents: bool) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * (3 if extents else 4)
    types = [pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                      names=["node", "start", "end", "group"][:len(cols)])


# -- Spark ---------------------------------------------------------------------

def _node(text) -> F.Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _halves(raw: bytes) -> tuple[int, int]:
    return int.from_bytes(raw[:8], "big", signed=True), int.from_bytes(raw[8:], "big", signed=True)


def _seed_rows(min_len: int, seed: int) -> Callable:
    """(text) -> (hash, n1, n2, place); a text is read once in each task."""
    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            data, off = text_buffer(batch.column(0))
            for lo, hi, d, o in chunks(data, off, SCAN):
                raw = d.tobytes()
                names = [hashlib.md5(raw[o[i]:o[i + 1]]).digest() for i in range(hi - lo)]
                fresh = np.array([o[i + 1] - o[i] >= min_len and not (n in seen or seen.add(n)) for i, n in enumerate(names)])
                p, s, e, h = sample_seeds(d, o, min_len, seed)
                row = rows_of(o, p)
                ok = fresh[row] if len(row) else np.zeros(0, bool)
                p, s, e, h, row = p[ok], s[ok], e[ok], h[ok], row[ok]
                half = np.array([_halves(n) for n in names], dtype=np.int64).reshape(-1, 2)[row]
                packed = (p - o[row]) << 20 | (p - e) << 10 | (p - s)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h.view(np.int64), half[:, 0], half[:, 1], packed)],
                                                 names=["h", "n1", "n2", "at"])
    return run


CONTEXT = [("seed", pa.binary()), ("node", pa.binary()), ("place", pa.int64()), ("left", pa.binary()), ("right", pa.binary()),
           ("ctx", pa.binary())]
CONTEXTS = "seed binary, node binary, place long, left binary, right binary"


def _contexts(min_len: int, seed: int, named: bool = False) -> Callable:
    """(text, places) -> (seed, node, place, left, right), a few texts at a
    time; ``named`` adds ``ctx``, the name of the context."""
    need = min_len - seed
    fields = CONTEXT if named else CONTEXT[:-1]

    def run(batches):
        out: list[tuple] = []
        for batch in batches:
            for i in range(0, len(batch), TEXTS):
                for node, raw, places in zip(*(c.to_pylist() for c in batch.slice(i, TEXTS).columns)):
                    text = zstandard.decompress(raw)
                    for at in places:
                        p, least, most = at >> 20, at >> 10 & 1023, at & 1023
                        end = p + seed
                        name, left, right = hashlib.blake2b(text[p:end], digest_size=16).digest(), text[p - most:p], text[end:end + need - least]
                        row = (name, node, p, left, right)
                        if named:
                            row += (hashlib.blake2b(b"%b%d." % (name, most) + left + right, digest_size=16).digest(),)
                        out.append(row)
                        if len(out) >= 10_000:
                            yield _table(out, fields)
                            out = []
        yield _table(out, fields)
    return run


def _windows(need: int) -> Callable:
    """(ctx, seed, left, right) -> its windows: (part, ctx, r, rest, next byte or -1)."""
    def run(batches):
        for batch in batches:
            out: list[tuple] = []
            for ctx, seed, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                back = left[::-1]
                for r in range(max(0, need - len(back)), len(right) + 1):
                    out.append((_part(seed, back, right, r, need), ctx, r, back[need - r:],
                                right[r] if r < len(right) else -1))
                if len(out) > 20_000:
                    yield _table(out, WINDOW)
                    out = []
            yield _table(out, WINDOW)
    return run


WINDOW = [("part", pa.binary()), ("ctx", pa.binary()), ("r", pa.int32()), ("rest", pa.binary()), ("next", pa.int32())]
MEMBER = [("ctx", pa.binary()), ("l", pa.int32()), ("r", pa.int32()), ("group", pa.binary())]
MEMBERS = "ctx binary, l int, r int, `group` binary"


def _table(rows: list[tuple], fields) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _whole(need: int) -> Callable:
    """Contexts met more than once are groups of their own."""
    def run(batches):
        for batch in batches:
            yield _table([(ctx, len(left), len(right), _name(_part(seed, left[::-1], right, len(right), need),
                                                            left[::-1][need - len(right):]))
                          for ctx, seed, left, right in zip(*(c.to_pylist() for c in batch.columns))], MEMBER)
    return run


def _common(batches):
    """(key, least, most) -> (key, length of their common prefix)."""
    for batch in batches:
        key, least, most = (c.to_pylist() for c in batch.columns)
        yield _table([(k, common(a, b)) for k, a, b in zip(key, least, most)], [("key", pa.binary()), ("d", pa.int32())])


def _nodes(need: int) -> Callable:
    """Rows (key, part, ctx, r, rest, next), one tree node after the other in
    the order of ``rest`` -> members of its left- and right-diverse groups."""
    def run(batches):
        out: list[tuple] = []
        for rows in _buckets(batches):
            lcp = [common(rows[i][4], rows[i + 1][4]) for i in range(len(rows) - 1)]
            for d, a, z in intervals(lcp, 0):
                after = [row[5] for row in rows[a:z + 1]]
                if min(after) == -1 or min(after) != max(after):
                    name, r = _name(rows[a][1], rows[a][4][:d]), rows[a][3]
                    out += [(row[2], need - r + d, r, name) for row in rows[a:z + 1]]
            if len(out) > 50_000:
                yield _table(out, MEMBER)
                out = []
        yield _table(out, MEMBER)
    return run


def _squeeze(batches):
    """(node, text) -> (node, compressed text)."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data, off = text_buffer(batch.column(1))
        raw = [pack.compress(data[off[i]:off[i + 1]].tobytes()) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["node", "raw"])


def _meeting(docs: DataFrame, min_len: int, seed: int, split: int) -> tuple[DataFrame, DataFrame]:
    """Texts with the places of repeated seeds, and the texts alone."""
    if min_len - seed > 1023:
        raise ValueError("a window may reach at most 1023 bytes beyond its seed")
    need_text = docs.filter(F.octet_length("text") >= min_len)
    seeds = stored(need_text.select("text").mapInArrow(_seed_rows(min_len, seed), "h long, n1 long, n2 long, at long"), "seeds")
    one = F.xxhash64("n1", "n2", "at")
    # stored, so that the join below reads two plain exchanges and Spark can split a hot seed
    counts = stored(seeds.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("lo"), F.max(one).alias("hi"))
                    .filter("lo <> hi").select("h", "n"), "seed-counts")
    hexed = F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("n1", "n2")])
    met = (seeds.join(counts, "h").withColumn("node", F.unhex(hexed))
           .groupBy("node").agg(                     # one row a text, as long as the text at most
               F.collect_set(F.when(F.col("n") <= split, F.col("at"))).alias("places"),
               F.collect_set(F.when(F.col("n") > split, F.col("at"))).alias("hot")))
    texts = (need_text.select(_node(F.col("text")).alias("node"), "text").mapInArrow(_squeeze, "node binary, raw binary")
             .groupBy("node").agg(F.first("raw").alias("raw")))     # copies are equal: any one will do
    found = stored(texts.join(met, "node"), "seed-texts")
    return found, found.select("node", "raw")


def _covered(found: DataFrame, min_len: int, seed: int, extents: bool = True) -> DataFrame:
    rows = (found.filter(F.size("places") > 0).select("node", "raw", "places")
            .mapInArrow(_contexts(min_len, seed), CONTEXTS))
    schema = "node binary, start long, end long" + ("" if extents else ", `group` binary")
    return (rows.repartition("seed").sortWithinPartitions("seed", "node", "place")
            .mapInArrow(_groups(min_len - seed, seed, extents), schema))


def _by_key(rows: DataFrame, split: int) -> DataFrame:
    """Rows of tree nodes with two members or more, with ``hot``: more than ``split``."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    return stored(rows.join(sizes, "key").withColumn("hot", F.col("m") > split).drop("m"), "tree-level")


def _hot_groups(found: DataFrame, min_len: int, seed: int, split: int) -> DataFrame:
    """Groups of seeds with more than ``split`` occurrences: ``(node, start, end, group)``."""
    need = min_len - seed
    occ = stored(found.filter(F.size("hot") > 0).select("node", "raw", "hot")
                 .mapInArrow(_contexts(min_len, seed, named=True), CONTEXTS + ", ctx binary"), "hot-places")
    if occ.isEmpty():
        return occ.sparkSession.createDataFrame([], "node binary, start long, end long, `group` binary")
    ctxs = stored(occ.groupBy("ctx").agg(*[F.first(c).alias(c) for c in ("seed", "left", "right")],
                                         F.count(F.lit(1)).alias("n")), "hot-contexts")
    kept = ctxs.filter((F.octet_length("left") + F.octet_length("right")) >= need)
    out = kept.filter("n > 1").select("ctx", "seed", "left", "right").mapInArrow(_whole(need), MEMBERS)
    rows = (kept.select("ctx", "seed", "left", "right")
            .mapInArrow(_windows(need), "part binary, ctx binary, r int, rest binary, next int"))
    level = _by_key(rows.select(F.col("part").alias("key"), "*"), split)
    for _ in range(need + 1):               # each level reads one more byte at least
        small = level.filter("NOT hot").drop("hot")
        out = out.unionByName(small.repartition("key").sortWithinPartitions("key", "rest", "ctx")
                              .mapInArrow(_nodes(need), MEMBERS))
        hot = level.filter("hot").drop("hot")
        if hot.isEmpty():
            break
        node = stored(hot.groupBy("key").agg(F.min("rest").alias("least"), F.max("rest").alias("most"),
                                             F.min("next").alias("a"), F.max("next").alias("z")), "tree-nodes")
        deep = node.select("key", "least", "most").mapInArrow(_common, "key binary, d int")
        hot = stored(hot.join(deep.join(node.select("key", "a", "z"), "key"), "key"), "tree-hot")

        def prefix(n):
            return F.unhex(F.md5(F.concat("part", F.substring("rest", F.lit(1), n))))
        out = out.unionByName(hot.filter("a = -1 OR a <> z").select(
            "ctx", (need - F.col("r") + F.col("d")).alias("l"), "r", prefix(F.col("d")).alias("group")))
        level = _by_key(hot.filter(F.octet_length("rest") > F.col("d"))
                        .withColumn("key", prefix(F.col("d") + 1)).drop("a", "z", "d"), split)
    return out.join(occ.select("ctx", "node", "place"), "ctx").select(
        "node", (F.col("place") - F.col("l")).alias("start"), (F.col("place") + seed + F.col("r")).alias("end"), "group")


def repeat_groups(docs: DataFrame, min_len: int = MIN_LEN, seed: int = SEED, split: int = SPLIT) -> DataFrame:
    """Maximal repeat groups: ``(group, node, start, end)``, one row for each
    occurrence; ``node`` is the md5 of the text, places are in bytes."""
    found, _ = _meeting(docs, min_len, seed, split)
    one = _covered(found, min_len, seed, extents=False).distinct()
    hot = _hot_groups(found, min_len, seed, split).distinct()
    return one.unionByName(hot).select("group", "node", "start", "end")


def _rest(batches):
    """(node, text, stretches) -> what is left of the text."""
    for batch in (whole.slice(i, TEXTS) for whole in batches for i in range(0, len(whole), TEXTS)):
        out = []
        for node, raw, spans in zip(*(c.to_pylist() for c in batch.columns)):
            text, runs = zstandard.decompress(raw), []
            for s in sorted((s["start"], s["end"]) for s in spans):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append(list(s))
            left = hashlib.sha256()
            at = 0
            for a, z in runs:
                left.update(text[at:a])
                at = z
            left.update(text[at:])
            out.append((node, sum(z - a for a, z in runs), len(runs), left.hexdigest()))
        yield _table(out, [("node", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                           ("kept_sha256", pa.string())])


def remove_repeats(docs: DataFrame, min_len: int = MIN_LEN, seed: int = SEED, split: int = SPLIT,
                   more: DataFrame | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` of every row, then
    the columns of ``more``, which has one row a ``node`` (md5 of the text)."""
    found, texts = _meeting(docs, min_len, seed, split)
    spans = (_covered(found, min_len, seed)
             .unionByName(_hot_groups(found, min_len, seed, split).select("node", "start", "end"))
             .groupBy("node").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    spans = spans.join(texts, "node").select("node", "raw", "spans").mapInArrow(
        _rest, "node binary, n_removed long, n_spans long, kept_sha256 string")
    body = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", _node(F.col("text")).alias("node"), F.octet_length(body).cast("long").alias("n_bytes"),
                       F.sha2(body, 256).alias("whole"))
    copies = rows.filter(F.col("n_bytes") >= min_len).groupBy("node").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    known = copies.select("node", F.lit(True).alias("all")).join(spans, "node", "full")
    if more is not None:
        known = known.join(more, "node", "full")
    known = stored(known, "removed")
    all_ = F.coalesce("all", F.lit(False))
    return rows.join(known, "node", "left").select(
        "doc_id", "n_bytes",
        F.when(all_, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        *[c for c in (more.columns if more is not None else []) if c != "node"])


def _word_codes(batches):
    """(node, text) -> (node, the codes of the text's words)."""
    for batch in batches:
        data, off = text_buffer(batch.column(1))
        for lo, hi, d, o in chunks(data, off, SCAN):
            s, e = words(d, o)
            code = np.empty((len(s), CODE), np.uint8)
            for i in range(0, len(s), PART):
                a, b = s[i:i + PART], e[i:i + PART]
                h = RollingHash(d[a[0]:b[-1]]).ranges(a - a[0], b - a[0])
                for k in range(CODE):
                    code[i:i + PART, k] = 48 + (h >> np.uint64(58 - 6 * k) & np.uint64(63))
            ends = (np.searchsorted(s, o) * CODE).astype(np.int64)
            text = pa.Array.from_buffers(pa.large_string(), hi - lo, [None, pa.py_buffer(ends), pa.py_buffer(code)])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), text.cast(pa.string())], names=["node", "text"])


def repeat_passages(docs: DataFrame, min_words: int = MIN_WORDS, seed: int = SEED_WORDS, split: int = SPLIT) -> DataFrame:
    """``(node, n_passages)`` of the texts that have any: the maximal runs of words
    covered by strings of ``min_words`` words that also start elsewhere."""
    coded = (docs.select(_node(F.col("text")).alias("doc_id"), "text")
             .mapInArrow(_word_codes, "doc_id binary, text string"))
    return (remove_repeats(coded, min_words * CODE, seed * CODE, split).filter("n_spans > 0")
            .groupBy(F.col("doc_id").alias("node")).agg(F.max("n_spans").alias("n_passages")))


def op1_repeats(spark, sf_dir: str) -> DataFrame:
    """The contract's columns, then ``removed`` (does anything go), ``kept_share`` and
    ``n_passages`` (passages of over 50 words that also stand elsewhere, removed or not)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    got = remove_repeats(docs, more=repeat_passages(docs)).withColumn("n_passages", F.coalesce("n_passages", F.lit(0)))
    left = F.col("n_bytes") - F.col("n_removed")
    share = F.when(F.col("n_bytes") > 0, left / F.col("n_bytes")).otherwise(F.lit(1.0))
    return got.select(*got.columns[:-1], (F.col("n_removed") > 0).alias("removed"), share.alias("kept_share"), "n_passages")
