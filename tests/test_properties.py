"""Property tests: invariants checked on many generated inputs at once."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from corvid.functions.probs import argmax, softmax
from corvid.functions.text import encode_fixed
from corvid.operators.prefix import row_number, running_sum
from corvid.operators.wordpiece import greedy_pieces

floats = st.floats(min_value=-50, max_value=50, allow_nan=False)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(floats, min_size=1, max_size=6), min_size=1, max_size=40))
def test_softmax_sums_to_one_and_keeps_argmax(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x array<double>")
    out = df.select("x", softmax(F.col("x")).alias("p"), argmax(F.col("x")).alias("a"),
                    argmax(softmax(F.col("x"))).alias("b")).collect()
    for r in out:
        assert math.isclose(sum(r.p), 1.0, rel_tol=1e-9)
        assert r.x[r.a] == max(r.x) and r.p[r.b] == max(r.p)
        # argmax is kept, except where exp() rounds logits closer than its
        # resolution to exactly equal probabilities (then the first index wins)
        assert r.a == r.b or r.p[r.a] == r.p[r.b]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=300), min_size=1, max_size=30))
def test_encode_length_and_mask(spark, sizes):
    n = 128
    df = spark.createDataFrame([(i, list(range(4, 4 + s))) for i, s in enumerate(sizes)],
                               "i int, ids array<int>")
    ids, mask = encode_fixed(F.slice("ids", 1, n - 2), n)
    for r in df.select("ids", ids.alias("e"), mask.alias("m")).collect():
        assert len(r.e) == n and len(r.m) == n
        assert sum(r.m) == min(len(r.ids) + 2, n)


def test_block_prefix_sum_equals_window(spark):
    # one hot key holding most rows, a tiny block size to force many blocks
    rows = [(0 if i % 5 else 1 + i % 3, i, i % 7) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, pos long, v long")
    got = running_sum(df, ["k"], "pos", {"s": F.col("v")}, block_size=16).select("k", "pos", "s")
    want = df.select("k", "pos", F.sum("v").over(
        Window.partitionBy("k").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    assert sorted(got.collect()) == sorted(want.collect())
    rn = row_number(df, ["k"], "pos", "rn", block_size=16).select("k", "pos", "rn")
    want_rn = df.select("k", "pos", F.row_number().over(Window.partitionBy("k").orderBy("pos"))
                        .cast("long").alias("rn"))
    assert sorted(rn.collect()) == sorted(want_rn.collect())


def test_windows_are_bounded_on_hashed_ids(spark):
    import hashlib
    ids = [int.from_bytes(hashlib.md5(str(i).encode()).digest()[:8], "big", signed=True) for i in range(3000)]
    df = spark.createDataFrame([("t", i) for i in ids], "k string, pos long")
    got = {r.pos: r.rn for r in row_number(df, ["k"], "pos").collect()}
    assert [got[i] for i in sorted(ids)] == list(range(1, 3001))
    # what each level's window may hold, for any 64-bit order column
    from corvid.operators.prefix import BLOCK_SIZE, LEVELS
    assert 2 ** 64 / BLOCK_SIZE ** LEVELS <= BLOCK_SIZE


def _brute_pieces(word, vocab):
    out, i = [], 0
    while i < len(word):
        cands = [j for j in range(i + 1, len(word) + 1)
                 if (word[i:j] if i == 0 else "##" + word[i:j]) in vocab]
        if not cands:
            return ["[UNK]"]
        j = max(cands)
        out.append(word[i:j] if i == 0 else "##" + word[i:j])
        i = j
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abc", min_size=1, max_size=12),
       st.sets(st.text(alphabet="abc", min_size=1, max_size=4), max_size=12))
def test_wordpiece_matches_brute_force(word, pieces):
    vocab = set()
    for p in pieces:
        vocab.add(p)
        vocab.add("##" + p)
    assert greedy_pieces(word, vocab, max_piece=12) == _brute_pieces(word, vocab)


def test_word_of_any_length_is_split():
    assert greedy_pieces("ab" * 500, {"ab", "##ab"}, 2) == ["ab"] + ["##ab"] * 499


def test_tables_move_only_when_asked(spark):
    from corvid.sources.tables import load_table
    from tests.conftest import SF_SMALL
    plain = load_table(spark, SF_SMALL, "documents")
    assert "Exchange" not in plain._jdf.queryExecution().toString()
    assert load_table(spark, SF_SMALL, "documents", partitions=3).rdd.getNumPartitions() == 3


def test_shared_folder_is_needed_on_a_cluster():
    import pytest
    from corvid.session import scratch_root

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return self

        def get(self, *_):
            return None

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Session())
