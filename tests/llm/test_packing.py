"""Packing: ids, cuts, plan and places."""

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corvid.llm import packing
from corvid.llm.spark_util import read_table
from tests.conftest import SF_SMALL

FILE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Z9'.,\n\t\r\x0b\x1c\x85\xa0 é漢😀")) | st.characters(codec="utf-8"), max_size=40))
def test_ids_are_the_files(text):
    assert packing.token_ids(text) == FILE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("gap", [" ", "\n", " \t\r\n\u00a0"])
def test_very_long_gaps(gap):
    text = "a" + gap * (2_000_000 // len(gap)) + "b  c"
    assert packing.token_ids(text) == FILE.encode(text, add_special_tokens=False).ids


def test_special_string():
    text = "a <|endoftext|> b"
    assert packing.token_ids(text) == FILE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 7, 8, 9, 16, 17, 100])
def test_cut(n):
    parts = packing.cut(n, 8)
    assert [s for s, _ in parts] == [sum(k for _, k in parts[:i]) for i in range(len(parts))]
    assert sum(k for _, k in parts) == n and all(k == 8 for _, k in parts[1:]) and 0 < parts[0][1] <= 8


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_plan_fills_without_gaps(histogram):
    plan = packing.Plan(histogram, 30)
    keys, table = plan.arrays()
    bins = collections.defaultdict(list)
    for size, n in histogram.items():
        for r in range(n):
            run = table[np.searchsorted(keys, size << 44 | r, "right") - 1]
            k = r - run[1]
            assert run[0] == size and 0 <= k < run[2]
            bins[run[3] + k // run[4]].append((run[5] + k % run[4] * size, size))
    for places in bins.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= 30
    assert len(bins) == plan.bins
    fewest = max(-(-sum(s * n for s, n in histogram.items()) // 30), sum(n for s, n in histogram.items() if s > 15))
    assert plan.bins <= fewest * 1.5 + 1


def test_large_items_pair_best():
    plan = packing.Plan({60: 1, 55: 1, 45: 1, 40: 1, 34: 2}, 100)
    assert plan.bins == 3                       # 60+40, 55+45, 34+34


def check(spark, rows, capacity):
    df = spark.createDataFrame(rows, "key long, text string")
    got = packing.pack(packing.doc_pieces(df, capacity), capacity).collect()
    want = collections.Counter()
    for key, text in rows:
        ids = np.array(FILE.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for i, (s, n) in enumerate(packing.cut(len(ids), capacity)):
            want[key, i, s, n, zlib.crc32(ids[s:s + n].tobytes())] += 1
    assert collections.Counter((r.key, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    return bins


def test_documents(spark):
    rows = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    bins = check(spark, rows, 2048)
    total = sum(n for places in bins.values() for _, n in places)
    assert len(bins) <= 1.02 * total / 2048 + 1


def test_edges(spark):
    rng = random.Random(0)
    rows = [(1, None), (1, ""), (None, "x"), (2, "same"), (2, "same"), (2 ** 60 + 1, "word " * 500)]
    rows += [(i, "a b" * rng.randint(0, 30)) for i in range(50)]
    check(spark, rows, 16)


def test_empty(spark):
    df = spark.createDataFrame([], "key long, text string")
    assert packing.pack(packing.doc_pieces(df)).collect() == []
