"""Sharding, mixing, top-k search and the classifier on small tables."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import mixing, quality, sharding, vafile
from corvid.llm.spark_util import number_rows, read_table
from tests.conftest import SF_MID


@pytest.mark.parametrize("n", [1, 2, 5, 64, 1000, 4097])
def test_permutation_and_inverse(n):
    x = np.arange(n)
    y = sharding.permute(x, n, 3)
    assert sorted(y) == list(x) and (sharding.unpermute(y, n, 3) == x).all()
    assert n < 64 or (y != x).mean() > 0.9


def test_row_numbers(spark):
    rows = [(i % 7, None if i % 5 == 0 else f"t{i % 11}") for i in range(500)] + [(1, "same")] * 300
    df = spark.createDataFrame(rows, "a long, b string")
    got = number_rows(df, ["a", "b"], per_bucket=10).collect()
    assert sorted(r.row_no for r in got) == list(range(800))
    assert collections.Counter((r.a, r.b) for r in got) == collections.Counter(rows)
    part = number_rows(df, ["a", "b"], part=["a"], per_bucket=10).collect()
    for a in range(7):
        assert sorted(r.row_no for r in part if r.a == a) == list(range(sum(x == a for x, _ in rows)))


def test_shards(spark):
    rows = [(i, "x" * (i % 9)) for i in range(395)] + [(None, None)] * 5
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = sharding.shard_rows(df, ["doc_id", "text"], 40).collect()
    two = sharding.shard_rows(df.repartition(7), ["doc_id", "text"], 40).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))
    by = collections.defaultdict(list)
    for r in one:
        by[r.shard].append(r.slot)
    assert len(by) == 40 and all(sorted(s) == list(range(10)) for s in by.values())


def plain_mix(rows, weights, epochs):
    """Targets by giving the excess to the rest until none is above."""
    sizes = collections.Counter()
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > epochs * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: float(epochs * sizes[s]) for s in full}
        left -= sum(epochs * sizes[s] for s in full)
        open_ -= full
    return sizes, target


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rng = random.Random(seed)
    names = [None, "é", "a", "b", "c", "zz", ""]
    rows = [(i, rng.choice(names[:4] + [names[2]] * 6 + names[4:]), rng.randint(0, 40)) for i in range(900)] + [(1, "b", 7)] * 50
    df = spark.createDataFrame(rows, "key long, source string, size long")
    got = mixing.fair_mix(df, (5, 2, 1)).collect()
    again = mixing.fair_mix(df.repartition(5), (5, 2, 1)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes, target = plain_mix(rows, (5, 2, 1), 3)
    assert collections.Counter((r.key, r.source, r.size) for r in got) == collections.Counter(rows)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - target[s]) <= 41 for s in sizes)
    assert sum(sizes.values()) - 41 * len(sizes) <= sum(taken.values()) <= sum(sizes.values())


def test_mix_edges(spark):
    schema = "key long, source string, size long"
    assert mixing.fair_mix(spark.createDataFrame([], schema), (5, 2, 1)).collect() == []
    zero = mixing.fair_mix(spark.createDataFrame([(1, "a", 0), (2, None, 0)], schema), (5, 2, 1)).collect()
    assert [(r.target, r.copies) for r in zero] == [(0.0, 0)] * 2
    docs = spark.createDataFrame([(1, "a b c", "s", 9), (1, "a b c", "s", 9), (2, "d e", None, 8), (3, None, "t", 7)],
                                 "doc_id long, text string, source string, copies long")
    mixed = mixing.mix_documents(docs, (1,))
    assert mixed.columns == docs.columns
    got = collections.Counter((r.doc_id, r.text, r.source, r.copies) for r in mixed.collect())
    assert set(got) <= {(1, "a b c", "s", 9), (2, "d e", None, 8)} and sum(len(k[1].split()) * n for k, n in got.items()) <= 8


def test_word_count(spark):
    texts = [None, "", " ", "a", " a", "a ", "a b c", "\x0b\x0ca\tb\n\r", "x  y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2]


def brute_topk(vectors, queries, k):
    out = []
    for q, v in queries:
        if v is None:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("seed,scale", [(1, 3), (2, 1000), (3, 10 ** 8)])
def test_topk_is_exact(spark, seed, scale):
    rng = random.Random(seed)
    rows = [(i, [rng.randint(-scale, scale) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(20)] + [(900, [1, 2]), (901, [2, 3])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(3)
    got = vafile.va_topk(df, df.filter("vec_id % 20 = 0"), 10, bits=3, q_block=7, c_block=64)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, [r for r in rows if r[0] % 20 == 0], 10)


def test_topk_reads_few():
    rng = np.random.default_rng(0)
    mat = rng.integers(-1000, 1000, (2000, 8))
    lo, hi = mat.min(0), mat.max(0)
    codes, read = vafile.encode_cells(mat, lo, hi, 6), []
    low, high = vafile.cell_bounds(codes, lo, hi, 6)
    assert (low <= mat).all() and (mat <= high).all()
    list(vafile.search_block(np.array([-1]), mat[:1], np.arange(2000), codes, lo, hi, 6,
                             lambda at: read.append(len(at)) or mat[at], 10))
    assert sum(read) < 400


def test_vectors_that_take_no_part(spark, tmp_path):
    rows = [(0, [1.0, 2.0]), (100, None), (200, [1.0, None]), (300, [float("nan"), 1.0]), (400, [float("inf"), 0.0]), (1, [-0.3, 0.7]), (2, [])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [tuple(r) for r in vafile.op3_vafile(spark, str(tmp_path)).collect()] == [(0, 1, 1, 1024 * -308 + 2048 * 716)]


def test_repeated_query_ids(spark, tmp_path):
    """Rows that share an id are queries and candidates of their own."""
    import duckdb
    rng = random.Random(4)
    rows = [(i % 400, [rng.uniform(-1, 1) for _ in range(5)], 1) for i in range(900)] + [(100, [0.5] * 5, 2)] * 3
    path = f"{tmp_path}/embeddings.parquet"
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, row long").repartition(3).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/*.parquet')")
    got = vafile.op3_vafile(spark, str(tmp_path)).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(vafile.SQL).fetchall()) and len(got) == 10 * (3 + 3 + 2 + 3 + 2 - 1)


def test_null_source_beside_tilde(spark):
    df = spark.createDataFrame([(5, None, 10), (5, "~", 10), (None, "~", 10), (6, "a", 90)], "key long, source string, size long")
    got = mixing.fair_mix(df, (5, 2, 1)).collect()
    assert len(got) == 4 and all(0 <= r.copies <= 3 for r in got)
    assert sum(r.copies * r.size for r in got) <= 120


def test_empty_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, v array<long>")
    assert vafile.va_topk(df, df, 10).collect() == []


def test_quality_held_out(spark):
    docs, labels = (read_table(spark, SF_MID, t) for t in ("documents", "labels"))
    vectors, net = quality.fit(docs, labels)
    rows = {r.doc_id: r.score for r in quality.quality_scores(docs, vectors, net).collect()}
    known = [(r.doc_id, r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    right = np.mean([(rows[d] >= 0.3) == q for d, q in known])
    assert right >= 0.93 and right > np.mean([q for _, q in known]) + 0.05
    assert all(0 <= s <= 1 for s in rows.values())


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, "", 6), (None, "some text", 7)], "doc_id long, text string, score long")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    vectors, net = quality.fit(docs, labels)
    assert [r.score for r in quality.quality_scores(docs, vectors, net).collect()] == [net.base] * 3
    assert quality.keep_good(docs, labels.limit(0)).collect() == docs.collect()
    none = docs.limit(0)
    vectors, net = quality.fit(none, labels.limit(0))
    assert quality.quality_scores(none, vectors, net).collect() == []


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 4))
    p = 1 / (1 + np.exp(-(x @ [1.0, -1.0, 0.5, 0.0])))
    y = (rng.random(3000) < p).astype(float)
    net = quality.Network(x, y)
    s = net.score(x)
    for lo in (0.0, 0.25, 0.5, 0.75):
        at = (s >= lo) & (s < lo + 0.25)
        assert abs(s[at].mean() - p[at].mean()) < 0.08
    assert all(quality.Network(x[:0], y[:0]).score(x) == 0.5)
