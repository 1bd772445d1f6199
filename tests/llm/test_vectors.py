"""Vector codes and hard negatives against plain Python and their SQL, on odd tables."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import codes, hardneg


def odd_rows(n, dim, seed, hot=0.4):
    """Clustered vectors with ties, repeated rows and ids, nulls and broken ones."""
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.2) for _ in range(dim)] for _ in range(12)]
    rows = []
    for i in range(n):
        v = [x + rng.gauss(0, 0.03) for x in base[i % 12]]
        label = 3 if rng.random() < hot else rng.randrange(10)
        rows.append((i, v, label))
    rows += rows[:30]                                               # repeated rows, ids 0 and others among them
    rows += [(i % 5 * 100, [x * 2 for x in rows[i][1]], 3) for i in range(10)]   # repeated ids
    rows += [(n + 1, None, 1), (n + 2, [math.nan] * dim, 1), (n + 3, [None] + [0.1] * (dim - 1), 1),
             (n + 4, [math.inf] * dim, 2), (n + 5, base[0], None), (None, base[1], 4), (None, base[1], None),
             (n + 6, [0.0] * dim, 3), (n + 700, [0.0] * dim, 3), (n + 7, [-0.001] * dim, 5)]
    rng.shuffle(rows)
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int, row long, v string"


def table(spark, tmp_path, rows, parts=5):
    path = str(tmp_path / "embeddings.parquet")
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA)      # extra columns named as the operators' own
    df.repartition(parts).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return str(tmp_path), con


def same(df, rel):
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted(repr([r[c] for c in cols]) for r in df.collect())
    assert got == sorted(repr([r[rel.columns.index(c)] for c in cols]) for r in rel.fetchall())
    return len(got)


def test_codes_equal_sql(spark, tmp_path):
    sf, con = table(spark, tmp_path, odd_rows(700, 8, 1))
    assert same(codes.op11_codes(spark, sf), con.sql(codes.SQL)) > 700


def test_codes_of_few_vectors(spark, tmp_path):
    sf, con = table(spark, tmp_path, odd_rows(9, 4, 2))
    assert same(codes.op11_codes(spark, sf), con.sql(codes.SQL))


def test_codes_of_other_lengths(spark, tmp_path):
    rows = [(1, [1.0, 2.0], 0), (2, [], 0), (3, [1.0] * 4, 0), (4, [2.0] * 8, 0), (5, [2.1] * 8, 1)]
    sf, _ = table(spark, tmp_path, rows)
    got = {r.vec_id: r for r in codes.op11_codes(spark, sf).collect()}
    assert sorted(got) == [2, 3, 4, 5]
    assert got[2].code == "00000000" and got[2].error == 0
    assert got[4].code != got[5].code and got[4].codebooks_sha256 != got[3].codebooks_sha256


def test_empty_tables(spark, tmp_path):
    sf, con = table(spark, tmp_path, [(1, None, 1)])
    assert codes.op11_codes(spark, sf).count() == 0 and hardneg.op12_hard_negatives(spark, sf).count() == 0


@pytest.mark.parametrize("scale", [1, 30, 1 << 20, 1 << 40])
def test_nearest_equals_brute_force(scale):
    rng = np.random.default_rng(3)
    entries = rng.integers(-scale, scale + 1, (200, 5))
    entries[50:60] = entries[40:50]                                  # ties
    x = np.vstack([rng.integers(-2 * scale, 2 * scale + 1, (300, 5)), entries[45:50]])
    code, error = codes.Slices(codes.whole(entries)).nearest(codes.whole(x))
    far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, e)) for e in entries] for v in x]
    assert [int(e) for e in error] == [min(f) for f in far]
    assert list(code) == [f.index(min(f)) for f in far]


def test_cube_holds_exactly_what_lies_in_it():
    rng = np.random.default_rng(4)
    entries, x = rng.integers(-50, 51, (130, 3)), rng.integers(-50, 51, (40, 3))
    radius = rng.integers(1, 60, 40)
    mask = codes.Slices(entries).cube(x, radius)
    got = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :130].astype(bool)
    want = (abs(x[:, None] - entries[None]) <= radius[:, None, None]).all(axis=2)
    assert (got == want).all()


def test_huge_components(spark, tmp_path):
    rows = [(i, [1e30 if i == 3 else float(i)] * 4, i % 2) for i in range(8)]
    sf, _ = table(spark, tmp_path, rows)
    got = {r.vec_id: r for r in codes.op11_codes(spark, sf).collect()}
    assert len(got) == 8 and all(r.error == 0 for r in got.values())


def test_hard_negatives_equal_sql(spark, tmp_path):
    sf, con = table(spark, tmp_path, odd_rows(900, 8, 5))
    assert same(hardneg.op12_hard_negatives(spark, sf), con.sql(hardneg.SQL)) > 100


def test_hard_negatives_in_small_blocks(spark, tmp_path):
    """Many blocks of both kinds give what one block gives."""
    rng = random.Random(6)
    rows = [(i, rng.randrange(3), [rng.randrange(-40, 90) for _ in range(6)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>").repartition(4)
    args = {"n_positives": 3, "n_negatives": 4, "low": 60}
    small = hardneg.hard_negatives(df, F.col("vec_id") % 5 == 0, anchor_block=7, candidate_block=16, **args).collect()
    want = []
    for a, la, va in rows[::5]:
        sc = sorted((-sum(x * y for x, y in zip(va, v)), i, lab) for i, lab, v in rows if i != a)
        for ps, p, _ in [s for s in sc if s[2] == la][:3]:
            near = [(n, -ns) for ns, n, lab in sc if lab != la and 60 * -ps <= 100 * -ns <= 100 * -ps][:4]
            want += [(a, p, k + 1, n, -ps, ns) for k, (n, ns) in enumerate(near)]
    assert sorted(map(tuple, small)) == sorted(want) and len(want) > 100


def test_vectors_of_two_lengths_do_not_meet(spark):
    rows = [(i, i % 2, [i + 1, 3]) for i in range(20)] + [(i, i % 2, [i, 2, 9]) for i in range(20, 40)] + [(40, 0, [])]
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<long>")
    got = hardneg.hard_negatives(df, F.col("vec_id") % 2 == 0).collect()
    assert got and all((r.anchor_id < 20) == (r.negative_id < 20) for r in got)


def test_spanning_tree_bounds_hold():
    rng = np.random.default_rng(7)
    a, c = rng.normal(0, 50, (30, 6)).round(), rng.normal(0, 50, (400, 6)).round()
    tree = hardneg.spanning_tree(a)
    assert [t[1] for t in tree].count(-1) == 1 and len({t[0] for t in tree}) == 30
    seen = []

    def want(i, b):
        s = c @ a[i]
        assert (b.low <= s).all() and (s <= b.high).all()
        seen.append(i)
        return np.flatnonzero(b.high >= np.sort(b.low)[-5])
    for i, rows, scores in hardneg.walk(a, c, want):
        assert (scores == c[rows] @ a[i]).all()
        assert set(np.argsort(-(c @ a[i]), kind="stable")[:3]) <= set(rows)
    assert len(seen) == 30


def test_near_anchors_are_not_rescored_everywhere():
    """Where anchors are close, the bounds leave most candidates out."""
    rng = np.random.default_rng(8)
    a = rng.normal(0, 100, 16).round() + rng.integers(-1, 2, (20, 16))
    c = rng.normal(0, 100, (2000, 16)).round()
    rescored = [len(rows) for _, rows, _ in
                hardneg.walk(a, c, lambda i, b: np.flatnonzero(b.high >= np.sort(b.low)[-5]))]
    assert sum(rescored[1:]) < 0.2 * 2000 * 19
