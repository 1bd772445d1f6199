"""DartMinHash near-dedup against all pairs by brute force."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import neardup
from corvid.llm.spark_util import read_table
from corvid.llm.textbatch import text_buffer
from tests.conftest import SF_MID


def shingle_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def brute_classes(rows):
    """{row index: class id} of (doc_id, text) rows."""
    s = [shingle_counts(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    holders = collections.defaultdict(list)
    for i, c in enumerate(s):
        for k in c:
            holders[k].append(i)
    both = collections.Counter()
    for k, at in holders.items():
        for x in range(len(at)):
            for y in range(x):
                both[at[y], at[x]] += min(s[at[x]][k], s[at[y]][k])
    for (a, b), n in both.items():
        if n / (sum(s[a].values()) + sum(s[b].values()) - n) >= 0.8:
            parent[find(a)] = find(b)
    first = {}
    for i, (_, t) in enumerate(rows):          # exact copies, also of wordless texts
        parent[find(i)] = find(first.setdefault(t or "", i))
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if r not in least else min((x for x in (least[r], d) if x is not None), default=None)
    return [least[find(i)] for i in range(len(rows))]


def check(spark, rows):
    df = spark.createDataFrame([(i, d, t, "z") for i, (d, t) in enumerate(rows)], "node long, doc_id long, text string, sig string")
    got = neardup.near_dup_classes(df).collect()
    want = collections.Counter((d, c) for (d, _), c in zip(rows, brute_classes(rows)))
    assert collections.Counter((r.doc_id, r.class_id) for r in got) == want


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10 ** 6)}"
    return " ".join(out)


def test_planted_and_edges(spark):
    rng = random.Random(4)
    rows = []
    for g in range(12):
        words = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(40, 300))]
        rows += [(len(rows) + k, edited(rng, words, rng.choice([0, 1, 2, len(words) // 8]))) for k in range(rng.randint(1, 9))]
    rows += [(None, "a b"), (None, "a  b"), (900, "a b"), (901, ""), (902, None), (903, " \n"), (903, " \n"), (None, "solo text"),
             (904, "x " * 4000), (905, "x " * 4001), (906, "x y " * 2000)]
    check(spark, rows)


def test_chains_link_through_the_middle(spark):
    words = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(words[:200 - 12 * i] + [f"t{i}x{j}" for j in range(12 * i)])) for i in range(7)]
    check(spark, rows)


def test_documents(spark):
    check(spark, [(r.doc_id, r.text) for r in read_table(spark, SF_MID, "documents").select("doc_id", "text").collect()])


def test_agreement_estimates_weighted_jaccard():
    import pyarrow as pa
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in rng.integers(0, 200, 400)]
    other = words[:300] + [f"o{i}" for i in range(100)]
    data, off = text_buffer(pa.array([" ".join(words), " ".join(other)]))
    row, h, c = neardup.shingles(data, off)
    ids = neardup.dart_minhash(row, h, c, 2, 4000)
    a, b = (shingle_counts(" ".join(x)) for x in (words, other))
    want = sum((a & b).values()) / sum((a | b).values())
    assert abs((ids[0] == ids[1]).mean() - want) < 0.03
    heavy = neardup.dart_minhash(np.array([0, 0, 1]), np.array([5, 6, 5], np.uint64), np.array([30, 10, 30]), 2, 4000)
    assert abs((heavy[0] == heavy[1]).mean() - 0.75) < 0.03


def test_keep_one(spark):
    rows = [(3, "same text here for all of us", 1), (1, "same text here for all of us", 2), (1, "same text here for all of us", 2),
            (5, "other words stand alone in this one", 3), (None, "nameless", 4), (None, "nameless", 4), (7, None, 5), (8, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = sorted(map(tuple, neardup.keep_one(df).collect()), key=str)
    assert got == sorted([(1, rows[1][1], 2), (5, rows[3][1], 3), (None, "nameless", 4), (7, None, 5)], key=str)


def test_cross_search_finds_what_the_star_misses(spark):
    """Two members of a bucket that are near each other but not near its head."""
    sig = np.zeros((3, neardup.T), np.uint16)
    sig[0, 4:], sig[1, 4:], sig[2, 4:] = 1, 2, 2        # all share the first band
    fine = np.zeros((3, neardup.FINE), np.uint8)
    rows = [(bytes([i] * 16), 9, 0, 3, bytes([i] * 16)) for i in range(3)]
    mixed = spark.createDataFrame(rows, "node binary, key long, band int, n long, root binary")
    nodes = spark.createDataFrame([(r[0], s.tobytes()) for r, s in zip(rows, sig)], "node binary, sig binary")
    longer = spark.createDataFrame([(r[0], s.tobytes()) for r, s in zip(rows, fine)], "node binary, fine binary")
    got = neardup._cross_pairs(mixed, nodes, longer).collect()
    assert [(bytes(r.a), bytes(r.b)) for r in got] == [(bytes([1] * 16), bytes([2] * 16))]


@pytest.mark.parametrize("run", [neardup.near_dup_classes, neardup.keep_one])
def test_empty(spark, run):
    assert run(spark.createDataFrame([], "doc_id long, text string")).collect() == []
