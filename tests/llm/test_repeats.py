"""Suffix-array dedup against brute force over all windows."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from corvid.llm import repeats
from tests.llm.brute import WORD


def brute(texts, k):
    """Covered bytes of each text by its windows that also start elsewhere."""
    raw = [(t or "").encode() for t in texts]
    places = defaultdict(list)
    for i, b in enumerate(raw):
        for s in range(len(b) - k + 1):
            places[b[s:s + k]].append((i, s))
    hit = [np.zeros(len(b), bool) for b in raw]
    for at in places.values():
        if len(at) > 1:
            for i, s in at:
                hit[i][s:s + k] = True
    out = []
    for b, h in zip(raw, hit):
        edges = np.diff(np.concatenate([[0], h.astype(np.int8), [0]]))
        left = bytes(np.frombuffer(b, np.uint8)[~h])
        out.append((len(b), int(h.sum()), int((edges == 1).sum()), hashlib.sha256(left).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abc é\n") for _ in range(rng.randint(0, 160))) for _ in range(25)]
    made = list(base)
    for _ in range(60):
        a, b = rng.choice(base), rng.choice(base)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        made.append(a[:i] + "".join(rng.choice("xyz") for _ in range(rng.randint(0, 4))) + b[j:])
    made += [made[3], made[3], "", None, "ab" * 300, "a" * 200, "a" * 200 + "b", None]
    return made


@pytest.mark.parametrize("seed,split", [(1, 20_000), (2, 20_000), (3, 3)])
def test_against_brute_force(spark, seed, split):
    texts = corpus(seed)
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_bytes int").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in repeats.remove_repeats(df, 24, 8, split).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 24)


def test_groups_list_all_occurrences(spark):
    common = "the shared passage that three texts hold in full"
    texts = [f"{i}{i} {x} {common} {y}" for i, (x, y) in enumerate([("p", "q"), ("r", "s"), ("t", "u")])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = defaultdict(set)
    for r in repeats.repeat_groups(df, 24, 8).collect():
        groups[r.group].add((bytes(r.node), r.start, r.end))
    best = max(groups.values(), key=len)
    assert len(best) == 3
    nodes = {hashlib.md5(t.encode()).digest(): t.encode() for t in texts}
    for g in groups.values():
        assert len({nodes[n][a:z] for n, a, z in g}) == 1 and len(g) > 1


def test_intervals_by_stack_scan():
    assert list(repeats.intervals([2, 2, 0, 1], 0)) == [(2, 0, 2), (1, 3, 4), (0, 0, 4)]
    assert list(repeats.intervals([2, 2, 0, 1], 2)) == [(2, 0, 2)]


def test_long_text_in_stretches(monkeypatch):
    rng = np.random.default_rng(0)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    off = np.array([0, len(data)])
    whole = repeats.sample_seeds(data, off, 24, 8)
    monkeypatch.setattr(repeats, "STRETCH", 700)
    parts = repeats.sample_seeds(data, off, 24, 8)
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(df).collect() == []


def test_documents_with_production_parameters(spark):
    from corvid.llm.spark_util import read_table
    from tests.conftest import SF_SMALL
    rows = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.op1_repeats(spark, SF_SMALL).collect()}
    assert [got[r.doc_id] for r in rows] == brute([r.text for r in rows], repeats.MIN_LEN)
    assert any(0 < g[1] < g[0] for g in got.values())


def occurrences(spark, texts, split):
    """Every maximal group as the set of its occurrences, by name."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    groups = defaultdict(set)
    for r in repeats.repeat_groups(df, 24, 8, split).collect():
        groups[bytes(r.group)].add((bytes(r.node), r.start, r.end))
    return dict(groups)


@pytest.mark.parametrize("seed,split", [(5, 3), (6, 1), (7, 8)])
def test_groups_do_not_depend_on_the_split(spark, seed, split):
    texts = corpus(seed)
    rng = random.Random(seed)
    line = "a line that stands in every page of the site"      # hot, with varied surroundings
    texts += ["".join(rng.choice("ab") for _ in range(rng.randint(0, 20))) + line
              + "".join(rng.choice("ab") for _ in range(rng.randint(0, 20))) for _ in range(40)]
    want = occurrences(spark, texts, 20_000)
    assert len(want) > 100 and occurrences(spark, texts, split) == want


def passages(texts, k):
    """Maximal runs of words in strings of ``k`` words that also start elsewhere."""
    split = [WORD.findall(t or "") for t in texts]
    places = defaultdict(list)
    for i, w in enumerate(split):
        for s in range(len(w) - k + 1):
            places[tuple(w[s:s + k])].append((i, s))
    hit = [np.zeros(len(w) + 2, np.int8) for w in split]
    for at in places.values():
        if len(at) > 1:
            for i, s in at:
                hit[i][s + 1:s + k + 1] = 1
    return [int((np.diff(h) == 1).sum()) for h in hit]


@pytest.mark.parametrize("seed,split", [(1, 20_000), (2, 3)])
def test_passages_against_brute_force(spark, monkeypatch, seed, split):
    monkeypatch.setattr(repeats, "PART", 7)
    texts = corpus(seed) + ["\u00e9 a  b\tc a b c a b c a b c", " \n\t "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {bytes(r.node): r.n_passages for r in repeats.repeat_passages(df, 6, 2, split).collect()}
    assert [got.get(hashlib.md5((t or "").encode()).digest(), 0) for t in texts] == passages(texts, 6)


def test_planted_passages_of_over_50_words_are_told(spark, tmp_path):
    """A shared passage of 51 words and under 400 bytes shows, but the contract keeps its bytes."""
    rng = random.Random(4)

    def own(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    told, short = own(51), own(50)
    texts = [f"{own(40)} {told} {own(60)}", own(200), f"{told}\n{own(5)} {own(20)}", f"{own(30)} {short} {own(9)}", short, None, "",
             own(150) + " " + told, None]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, own(90)), (1, own(70))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = repeats.op1_repeats(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(r.n_removed == 0 and r.n_spans == 0 and not r.removed for r in got)
    assert sorted(r.doc_id for r in got if r.n_passages) == [0, 2, 7]
    assert {r.n_passages for r in got} == {0, 1}
