"""Vector code compression (11): product codes by slice-and-intersect bitmasks.

A vector is cut into ``PARTS`` equal consecutive parts; each part position has
a codebook of at most ``ENTRIES`` entries, refined by rounds of exact integer
k-means. What takes the time is the search for each part's nearest entry:

* *Slices.* Per dimension the entries' coordinates are sorted, and place ``i``
  of the sorted list carries the bitmask (``uint64`` words) of the first ``i``
  entries. The entries whose coordinate lies in a range are the prefix mask at
  its end without the prefix mask at its start.
* *Intersect.* A radius selects one range per dimension; the ANDed masks are
  exactly the entries in the cube around the part. Whatever lies within the
  radius (Euclidean) lies in the cube.
* *Certainty.* The first radius is one at which an entry's cube holds a few others.
  A part whose best candidate is no farther than the radius is done. The
  others widen their radius to that candidate's distance, or double it where
  the cube was empty, and try again; the nearest entry and every tie are then
  candidates, so the result is exact.

Work on Spark: vectors are read, never moved. In each round a task adds up its
parts per codebook entry (one table per vector length, a fixed number of
slices); the slices are added where they meet, and the driver receives one
codebook's worth of sums, whatever the number of vectors.

Defined cases: vectors that are null or hold null or non-finite components take
no part, nor do those whose length isn't a multiple of ``PARTS``. Lengths that
differ have codebooks of their own (``codebooks_sha256`` is that of the row's
length); the empty vector has the code of entry 0 and no error. Repeated rows
and repeated or null vec_ids are separate rows; null ids come last where the
first ids seed the codebooks, equal ids are ordered by vector. Fewer vectors
than entries: fewer entries. Null labels share one ``label_error``. Components
and errors beyond the 64-bit range saturate (a ``label_error`` there is null);
large ones are computed with Python integers.
An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.spark_util import read_table, stored

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Slices of a codebook's sums, added in parallel.
SLICES = 16
#: Differences (part, entry, dimension) computed at once.
BATCH = 1 << 20
#: Largest component whose squared distances are exact in 64 bits.
SAFE = 1 << 22
MOST = (1 << 63) - 1


def whole(arr: np.ndarray) -> np.ndarray:
    """int64 when all arithmetic on it is exact there, else Python integers."""
    big = max((abs(int(x)) for x in (arr.min(initial=0), arr.max(initial=0))), default=0)
    return arr.astype(np.int64) if big <= SAFE else arr.astype(object)


class Slices:
    """One codebook ready for search: sorted coordinates and prefix masks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        n, dim = entries.shape
        self.words = max(1, -(-n // 64))
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bit = np.zeros((n, self.words), dtype=np.uint64)
        bit[np.arange(n), np.arange(n) // 64] = np.uint64(1) << (np.arange(n) % 64).astype(np.uint64)
        self.prefix = np.zeros((dim, n + 1, self.words), dtype=np.uint64)
        for d in range(dim):
            np.bitwise_or.accumulate(bit[self.order[:, d]], axis=0, out=self.prefix[d, 1:])
        self.radius = max(1, self._company()) if dim else 1

    def _company(self, others: int = 12) -> int:
        """The radius at which the cube around an entry typically holds ``others`` more."""
        far = [np.sort(abs(self.entries - e).max(axis=1))[min(others, len(self.entries) - 1)] for e in self.entries]
        return int(sorted(far)[len(far) // 2])

    def cube(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks of the entries within ``radius`` of ``x`` in every dimension."""
        mask = np.broadcast_to(self.prefix[0, -1], (len(x), self.words)).copy()
        for d in range(x.shape[1]):
            lo = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            hi = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            mask &= self.prefix[d, hi] ^ self.prefix[d, lo]
        return mask

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry (ties: lower index)."""
        n, dim = self.entries.shape
        code, error = np.zeros(len(x), np.int64), np.zeros(len(x), x.dtype)
        if not dim:
            return code, error
        todo, radius = np.arange(len(x)), np.full(len(x), self.radius, dtype=x.dtype)
        while len(todo):
            mask = self.cube(x[todo], radius)
            row, entry = np.nonzero(np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :n])
            half = dim // 2 if len(row) > 1 << 12 else dim
            far = _square(x[todo[row], :half], self.entries[entry, :half])
            if half < dim:                  # what is beyond the radius already can't be a certain nearest
                near = (far <= (radius * radius)[row]).astype(bool)
                some = np.zeros(len(todo), bool)
                some[row[near]] = True
                near = np.flatnonzero(near | ~some[row])
                row, entry = row[near], entry[near]
                far = far[near] + _square(x[todo[row], half:], self.entries[entry, half:])
            # candidates come row by row: the least (distance, entry) of each row
            start = np.flatnonzero(np.diff(row, prepend=-1))
            hit = row[start]
            least = np.minimum.reduceat(far * n + entry, start) if len(row) else far
            sure = np.zeros(len(todo), bool)
            sure[hit] = least // n <= radius[hit] * radius[hit]
            code[todo[hit]], error[todo[hit]] = least % n, least // n
            radius = radius * 2
            radius[hit] = [_root_up(f) for f in (least // n).tolist()]
            todo, radius = todo[~sure], radius[~sure]
        return code, error


def _square(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances row by row, exact in the arrays' own type."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap) if gap.dtype != object else (gap * gap).sum(axis=1)


def _root_up(square: int) -> int:
    """The least integer whose square is no smaller."""
    import math
    root = math.isqrt(int(square))
    return root + (root * root < square)


class Codebooks:
    """The codebooks of one vector length."""

    def __init__(self, seeds: np.ndarray):
        self.dim = seeds.shape[1]
        self.books = [whole(p) for p in np.split(seeds, PARTS, axis=1)]

    def prepare(self) -> list[Slices]:
        return [Slices(b) for b in self.books]

    def update(self, part: int, first: int, count: list[int], sums: list[list[int]]) -> None:
        book = self.books[part].astype(object)
        for i, (n, s) in enumerate(zip(count, sums)):
            if n:
                book[first + i] = [int(v) // int(n) for v in s]
        self.books[part] = whole(book)

    def digest(self) -> str:
        flat = (str(int(v)) for b in self.books for entry in b for v in entry)
        return hashlib.sha256(",".join(flat).encode()).hexdigest()


def assign(mat: np.ndarray, slices: list[Slices]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(part matrix, codes, errors)`` for each part position."""
    for x, s in zip(np.split(mat, PARTS, axis=1), slices):
        step = max(1, BATCH // max(1, s.entries.size))
        got = [s.nearest(x[i:i + step]) for i in range(0, len(x), step)]
        yield x, np.concatenate([c for c, _ in got]), np.concatenate([e for _, e in got])


def matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, row numbers, integer matrix)`` of the batch's column ``v``."""
    col = batch.column(batch.schema.get_field_index("v"))
    off = col.offsets.to_numpy().astype(np.int64)
    flat = col.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        at = off[rows][:, None] + np.arange(dim)
        yield int(dim), rows, whole(flat[at].reshape(len(rows), int(dim)))


def _entry_slices(n: int) -> list[np.ndarray]:
    return np.array_split(np.arange(n), SLICES)


def _sum_parts(books: dict[int, Codebooks]):
    """Per task: counts and sums of each codebook entry, in slices."""
    def run(batches):
        ready = {d: b.prepare() for d, b in books.items()}
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for dim, _, mat in matrices(batch):
                for part, (x, code, _) in enumerate(assign(mat, ready[dim])):
                    n = len(books[dim].books[part])
                    total = held.setdefault((dim, part), [np.zeros(n, object), np.zeros((n, x.shape[1]), object)])
                    total[0] += np.bincount(code, minlength=n).astype(object)
                    add = np.zeros((n, x.shape[1]), x.dtype)
                    np.add.at(add, code, x)
                    total[1] += add
        out = [(dim, part, s, pickle.dumps((n[at].tolist(), sums[at].tolist())))
               for (dim, part), (n, sums) in held.items() for s, at in enumerate(_entry_slices(len(n)))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
            names=["dim", "part", "slice", "sums"])
    return run


def _add_slices(batches):
    held: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for r in batch.to_pylist():
            n, sums = (np.array(a, dtype=object) for a in pickle.loads(r["sums"]))
            key = r["dim"], r["part"], r["slice"]
            held[key] = (held[key][0] + n, held[key][1] + sums) if key in held else (n, sums)
    out = [(*k, pickle.dumps((n.tolist(), s.tolist()))) for k, (n, s) in held.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
        names=["dim", "part", "slice", "sums"])


def learn_codebooks(vectors: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> dict[int, Codebooks]:
    """Codebooks of every vector length of ``(vec_id, v array<long>)``."""
    first = Window.partitionBy(F.size("v")).orderBy(F.col("vec_id").asc_nulls_last(), "v")
    seeds = (vectors.select("vec_id", "v", F.row_number().over(first).alias("_i"))
             .filter(F.col("_i") <= entries).select("_i", "v").collect())      # ``entries`` rows a length
    by_dim: dict[int, list] = {}
    for r in sorted(seeds, key=lambda r: r["_i"]):
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    books = {d: Codebooks(np.array(vs, dtype=object).reshape(len(vs), d)) for d, vs in by_dim.items()}
    schema = "dim int, part int, slice int, sums binary"
    for _ in range(rounds if books else 0):
        part = vectors.select("v").mapInArrow(_sum_parts(books), schema)
        for r in part.repartition("dim", "part", "slice").mapInArrow(_add_slices, schema).collect():
            book = books[r["dim"]].books[r["part"]]
            at = _entry_slices(len(book))[r["slice"]]
            if len(at):
                books[r["dim"]].update(r["part"], int(at[0]), *pickle.loads(r["sums"]))
    return books


def encode(vectors: DataFrame, books: dict[int, Codebooks]) -> DataFrame:
    """``(vec_id, label, code, error, codebooks_sha256)`` of every row."""
    digest = {d: b.digest() for d, b in books.items()}

    def run(batches):
        ready = {d: b.prepare() for d, b in books.items()}
        for batch in batches:
            n = batch.num_rows
            code, error, sha = [""] * n, [0] * n, [""] * n
            for dim, rows, mat in matrices(batch):
                for _, c, e in assign(mat, ready[dim]):
                    for r, ci, ei in zip(rows.tolist(), c.tolist(), e.tolist()):
                        code[r] += f"{ci:02x}"
                        error[r] = min(error[r] + int(ei), MOST)
                for r in rows.tolist():
                    sha[r] = digest[dim]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code), pa.array(error, pa.int64()), pa.array(sha)],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"])

    kind = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.select("vec_id", "label", "v").mapInArrow(
        run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long, codebooks_sha256 string")


def usable_vectors(raw: DataFrame, scale: int) -> DataFrame:
    """``(vec_id, label, v)``: rows with finite components only, ``floor(scale * x)``."""
    good = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return raw.filter(good).select(
        "vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("v"))


def op11_codes(spark, sf_dir: str) -> DataFrame:
    vectors = stored(usable_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), SCALE)
                     .filter(F.size("v") % PARTS == 0), "pq-vectors")
    coded = stored(encode(vectors, learn_codebooks(vectors)), "pq-codes")
    # one row a label; stored, so that Spark sees its size before it chooses a join
    per_label = stored(coded.groupBy("label").agg(F.try_sum("error").alias("label_error"))
                       .withColumnRenamed("label", "_label"), "pq-labels")
    return (coded.join(per_label, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", "codebooks_sha256"))


def _sql() -> str:
    ctes = [f"""good AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS i, vec_id, label,
     list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {SCALE}) AS BIGINT)) AS v
   FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) % {PARTS} = 0
     AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
x AS MATERIALIZED (SELECT i, (p - 1) * {PARTS} // len(v) AS part, (p - 1) % (len(v) // {PARTS}) AS pos, v[p] AS x
   FROM good, unnest(range(1, len(v) + 1)) t(p)),
b0 AS MATERIALIZED (SELECT part, i - 1 AS entry, pos, x AS c FROM x WHERE i <= {ENTRIES})"""]

    def assigned(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (SELECT i, part, min(entry) AS entry, min(d) AS d FROM (
   SELECT *, min(d) OVER (PARTITION BY i, part) AS least FROM (
     SELECT i, x.part, entry, sum((x - c) * (x - c)) AS d FROM x JOIN b{r} b ON x.part = b.part AND x.pos = b.pos
     GROUP BY i, x.part, entry)) WHERE d = least GROUP BY i, part)"""
    for r in range(ROUNDS):
        ctes.append(assigned(r))
        ctes.append(f"""b{r + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos, coalesce(m.c, b.c) AS c FROM b{r} b LEFT JOIN (
     SELECT x.part, entry, pos, CAST((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS c
     FROM x JOIN a{r} USING (i, part) GROUP BY x.part, entry, pos) m USING (part, entry, pos))""")
    ctes.append(assigned(ROUNDS))
    ctes.append(f"""sha AS (SELECT sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos), '')) AS s
   FROM b{ROUNDS}),
coded AS (SELECT i, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code,
     CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY i)""")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, s AS codebooks_sha256
FROM good JOIN coded USING (i), sha"""


SQL = _sql()
