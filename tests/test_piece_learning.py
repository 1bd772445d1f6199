"""Learned WordPiece vocabularies against a plain trainer."""

import collections
import random

import pytest

from corvid.operators.piece_learning import learn_pieces, word_counts
from corvid.operators.wordpiece import greedy_pieces


def plain_learn(words, rounds, per_round, min_count):
    state = {w: [w[0], *("##" + c for c in w[1:])] for w in words}
    chars = collections.Counter()
    for w, n in words.items():
        for p in state[w]:
            chars[p] += n
    out = [(p, 0, n) for p, n in chars.items()]
    for i in range(1, rounds + 1):
        c, ab = collections.Counter(), collections.Counter()
        for w, n in words.items():
            for p in state[w]:
                c[p] += n
            for pair in zip(state[w], state[w][1:]):
                ab[pair] += n
        top = sorted((-(n / (float(c[a]) * float(c[b]))), a, b) for (a, b), n in ab.items() if n >= min_count)[:per_round]
        pick = {}
        for k, (_, a, b) in enumerate(top):
            if not any({a, b} & set(t[1:]) for t in top[:k]):
                pick[a, b] = a + b[2:]
                out.append((a + b[2:], i, ab[a, b]))
        for w in words:
            new = []
            for p in state[w]:
                if new and (new[-1], p) in pick:
                    new[-1] = pick[new[-1], p]
                else:
                    new.append(p)
            state[w] = new
    return out


@pytest.mark.parametrize("per_round,rounds", [(1, 3), (20, 4)])
def test_equals_a_plain_trainer(spark, per_round, rounds):
    rng = random.Random(per_round)
    text = ["".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(300)] * 2 + ["aaaaaaa", "abab", "z"]
    words = collections.Counter(text)
    df = spark.createDataFrame([(w,) for w in text] + [("",), (None,)], "word string")
    got = learn_pieces(word_counts(df), rounds, per_round, 2).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(plain_learn(words, rounds, per_round, 2))


def test_stems_are_learned(spark):
    """A stem that stands in many words becomes a piece, also inside a word."""
    words = {"unhappiness": 30, "unhappily": 20, "unhappier": 25, "kindness": 40, "sadness": 35, "unkind": 30, "undo": 20, "sadly": 15, "kindly": 15}
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, cnt long")
    vocab = {r.piece for r in learn_pieces(df, 7, 12).collect()}
    assert any("happi" in p for p in vocab)
    assert "[UNK]" not in greedy_pieces("unhappiness", vocab, 20)


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], "word string")
    assert learn_pieces(word_counts(none), 3, 5).count() == 0
    one = spark.createDataFrame([("a",)], "word string")
    assert [tuple(r) for r in learn_pieces(word_counts(one), 3, 5).collect()] == [("a", 0, 1)]
