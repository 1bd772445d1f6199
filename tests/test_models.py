"""The many-class table model and the versioned bundle."""

import collections
import math
import random

import pytest

from corvid.operators.bundle import latest, load_bundle, save_bundle, score_bundle
from corvid.operators.classes import predict_classes, train_classes


def grams(t):
    t = f"^{t.lower()}$"
    return [t[i:i + 3] for i in range(len(t) - 2)]


def plain_classes(train, texts):
    def r(x):
        return math.floor(math.log(x) * 8 + 0.5) / 8 if math.log(x) >= 0 else -math.floor(-math.log(x) * 8 + 0.5) / 8
    count, rows = collections.defaultdict(collections.Counter), collections.Counter()
    for t, c in train:
        rows[c] += 1
        count[c].update(grams(t) if t is not None else [])
    vocab = {g for c in count for g in count[c]}
    out = []
    for t in texts:
        best = []
        for c in rows:
            total = sum(count[c].values()) + len(vocab) + 1
            gs = grams(t) if t is not None else []
            best.append((-(r(rows[c] / len(train)) + sum(r((count[c][g] + 1) / total) if count[c][g] else r(1 / total) for g in gs)), c))
        out.append(min(best)[1])
    return out


def test_classes_equal_plain_counting(spark):
    rng = random.Random(5)
    words = {f"class {c}": [f"{rng.choice('abcdef')}{rng.choice('aeiou')}{c}{rng.choice('xyz')}" for _ in range(6)] for c in range(14)}
    train = [(" ".join(rng.choices(w, k=rng.randrange(1, 4))), c) for c, w in words.items() for _ in range(12)] + [("Same", "class 1"), ("same", "class 2"), (None, "class 3")]
    texts = [t for t, _ in train] + ["", "q", None, "unseen thing", "ba3x"] * 2
    weights, classes = train_classes(spark.createDataFrame(train + [("no label", None)], "text string, label string"))
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: r.predicted for r in predict_classes(rows, weights, classes).collect()}
    assert [got[i] for i in range(len(texts))] == plain_classes(train, texts)


def test_no_classes(spark):
    weights, classes = train_classes(spark.createDataFrame([], "text string, label string"))
    got = predict_classes(spark.createDataFrame([("a",)], "text string"), weights, classes).first()
    assert got.predicted is None and got.score is None


W1 = [("[CLS]", 0.0, 0.0), ("[UNK]", 0.0, 0.0), ("good", -1.0, 2.0)]
W2 = [("[CLS]", 0.0, 0.0), ("[UNK]", 0.0, 0.0), ("good", 2.0, -1.0)]
WS = "token string, w0 double, w1 double"


def test_bundle_versions(spark, tmp_path):
    root = str(tmp_path / "model")
    assert latest(spark, root) == 0
    with pytest.raises(FileNotFoundError):
        load_bundle(spark, root)
    assert save_bundle(spark.createDataFrame(W1, WS), root) == 1
    docs = spark.createDataFrame([(1, "good"), (1, "good"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.pred, r.model) for r in score_bundle(docs, root).collect()) == [(1, 1, 1), (1, 1, 1), (2, 0, 1)]
    # a version whose manifest is not there yet does not exist
    spark.createDataFrame(W2, WS).write.parquet(f"{root}/weights/2")
    assert latest(spark, root) == 1
    assert save_bundle(spark.createDataFrame(W2, WS), root) == 2
    assert {r.pred for r in score_bundle(docs, root).collect()} == {0} and load_bundle(spark, root, 1)[1] == 1
    # files that are not the manifest's are refused
    spark.createDataFrame(W1[:2], WS).write.mode("overwrite").parquet(f"{root}/weights/2")
    with pytest.raises(ValueError):
        load_bundle(spark, root)
