"""Best-fit packing (4): large-item matching.

Documents become token ids plus one end id; only documents longer than the
capacity are cut, into full pieces with the remainder first. Pieces above a
third of the capacity go at most two to a sequence: taken from the largest
down, each is matched with the largest unmatched piece that fits beside it.
Smaller pieces, largest first, each go to the gap they leave least room in,
and open a new sequence only if no gap holds them.

Pieces of one length are interchangeable, so the plan is computed on the
length histogram, which has at most ``capacity`` rows whatever the size of the
corpus. The plan is a list of runs: "ranks r..r+n of length L fill sequences
b, b+1, ..., q to a sequence, at offset o". Each piece gets its rank within its
length by distributed numbering and looks its place up in the plan, so packing
is global (no partly filled sequence per partition) and no piece travels to
the driver.

Defined cases: a null or empty text is the end id alone (one piece of length
1); equal rows are separate pieces; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.spark_util import number_rows, read_table, stored

CAPACITY = 2048
END_ID = 0
VOCAB, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
#: The vocabulary's own pattern, and the same without its look-ahead, which
#: only matters where two space characters meet.
PLAIN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
TWO_GAPS = re.compile(r"\s\s")
#: Space characters in a row from which on the look-ahead's stack may not do.
LONG_GAP = 20_000
_LONG_GAP = re.compile(rf"\s{{{LONG_GAP}}}")


@functools.lru_cache(maxsize=2)
def _encoders(folder: str | None):
    import public_tokenizers as P
    import tiktoken
    from tokenizers import Tokenizer
    at = (lambda name: f"{folder}/{name}") if folder else P.path
    with open(at(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    plain = tiktoken.Encoding("plain", pat_str=PLAIN, mergeable_ranks=ranks, special_tokens={})
    return own, plain, Tokenizer.from_file(at(VOCAB))


def token_ids(text: str, folder: str | None = None) -> list[int]:
    """Ids of the whole text, those of the ``tokenizers`` vocabulary file.

    The rank form of the same vocabulary gives the same ids several times
    faster; texts naming the special token, and those with very long gaps, are
    left to the file itself.
    """
    own, plain, file = _encoders(folder)
    if SPECIAL in text or len(text) >= LONG_GAP and _LONG_GAP.search(text):
        return file.encode(text, add_special_tokens=False).ids
    return (own if TWO_GAPS.search(text) else plain).encode_ordinary(text)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """``(start, length)`` of the pieces of an ``n``-id document."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


PIECES = "key long, piece int, start long, length long, ids_crc32 long"


def doc_pieces(docs: DataFrame, capacity: int = CAPACITY, folder: str | None = None) -> DataFrame:
    """Pieces of ``docs(key, text)``, without their ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text in enumerate(batch.column(1)):
                ids = np.array([*token_ids(text.as_py() or "", folder), END_ID], dtype="<u4")
                for i, (s, n) in enumerate(cut(len(ids), capacity)):
                    out.append((row, i, s, n, zlib.crc32(ids[s:s + n].tobytes())))
            rows, *rest = np.array(out, dtype=np.int64).reshape(-1, 5).T
            rest[0] = rest[0].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows)), *map(pa.array, rest)],
                names=["key", "piece", "start", "length", "ids_crc32"])
    return docs.select(F.col("key").cast("long").alias("key"), "text").mapInArrow(run, PIECES)


class Plan:
    """Runs ``(length, first rank, count, first sequence, per sequence, offset)``."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.bins = 0
        self._rank = dict.fromkeys(histogram, 0)
        self._gaps: list[int] = []                          # sorted
        self._free: dict[int, list[tuple[int, int]]] = {}   # gap -> (first sequence, how many)
        left = {size: n for size, n in histogram.items() if n}
        self._large({s: n for s, n in left.items() if 3 * s > capacity}, capacity)
        for size in sorted((s for s in left if 3 * s <= capacity), reverse=True):
            self._small(size, left[size], capacity)

    def _put(self, size: int, count: int, first_bin: int, per_bin: int, offset: int) -> None:
        self.runs.append((size, self._rank[size], count, first_bin, per_bin, offset))
        self._rank[size] += count

    def _leave(self, gap: int, first_bin: int, n: int) -> None:
        if gap and n:
            if gap not in self._free:
                bisect.insort(self._gaps, gap)
                self._free[gap] = []
            self._free[gap].append((first_bin, n))

    def _pair(self, a: int, b: int, n: int, capacity: int) -> None:
        """``n`` new sequences of ``a``, and of ``b`` behind it if not 0."""
        if n:
            self._put(a, n, self.bins, 1, 0)
            if b:
                self._put(b, n, self.bins, 1, a)
            self._leave(capacity - a - b, self.bins, n)
            self.bins += n

    def _large(self, left: dict[int, int], capacity: int) -> None:
        sizes = sorted(left)
        while sizes:
            a = sizes.pop()
            n = left[a]
            if 2 * a <= capacity:           # nothing left is larger than a itself
                self._pair(a, a, n // 2, capacity)
                n %= 2
            while n:
                i = bisect.bisect_right(sizes, capacity - a) - 1
                b = sizes[i] if i >= 0 else 0
                m = min(n, left[b]) if b else n
                self._pair(a, b, m, capacity)
                n -= m
                if b:
                    left[b] -= m
                    if not left[b]:
                        del sizes[i]

    def _small(self, size: int, n: int, capacity: int) -> None:
        while n:
            i = bisect.bisect_left(self._gaps, size)
            if i < len(self._gaps):
                gap = self._gaps[i]
                first, many = self._free[gap].pop()
                if not self._free[gap]:
                    del self._free[gap], self._gaps[i]
                offset = capacity - gap
            else:
                gap, first, offset = capacity, self.bins, 0
                many = -(-n // (capacity // size))
                self.bins += many
            per = gap // size
            used = min(many, n // per)
            if used:
                self._put(size, used * per, first, per, offset)
                self._leave(gap - per * size, first, used)
                n -= used * per
            if used < many:
                if n and n < per:       # the last few share one sequence
                    self._put(size, n, first + used, n, offset)
                    self._leave(gap - n * size, first + used, 1)
                    used, n = used + 1, 0
                self._leave(gap, first + used, many - used)

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        table = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 6)
        return table[:, 0] << 44 | table[:, 1], table


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces`` (as ``doc_pieces``)."""
    pieces = stored(pieces, "pieces")
    cols = pieces.columns
    # at most ``capacity`` rows
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    keys, table = Plan(histogram, capacity).arrays()
    ranked = number_rows(pieces, cols, "_rank", part=["length"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size, r = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        run = table[np.searchsorted(keys, size << 44 | r, "right") - 1]
        k = r - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + k // run[:, 4],
                             "offset": run[:, 5] + k % run[:, 4] * size})

    return (ranked.withColumn("_p", place("length", "_rank"))
            .select(*cols, "_p.sequence_id", "_p.offset"))


def op4_packing(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents") if docs is None else docs
    pieces = doc_pieces(docs.select(F.col("doc_id").alias("key"), "text"))
    return pack(pieces).withColumnRenamed("key", "doc_id")
