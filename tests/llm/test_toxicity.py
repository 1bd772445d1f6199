"""The toxicity classifier: held-out accuracy, interactions and odd rows."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corvid.llm import toxicity
from corvid.llm.quality import held_out
from corvid.llm.spark_util import read_table
from corvid.llm.textbatch import text_buffer

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = read_table(spark, SF, "labels").select("doc_id", "toxic")
    got = toxicity.op13_toxicity(spark, SF).cache()
    assert got.count() == 10_000 and got.filter("score < 0 or score > 1 or score is null").count() == 0
    rows = got.join(truth, "doc_id").filter("held_out").collect()
    hits = [r for r in rows if r.toxic == 1]
    assert len(hits) > 80
    assert sum(r.predicted for r in hits) >= 0.85 * len(hits)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.01 * len(rows)
    got.unpersist()


def planted(n, seed):
    """Toxic only where an insult and a group stand together; either alone is clean."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(n):
        kind = i % 4
        text = rng.choices(words, k=rng.randrange(5, 25))
        text += ["vermin"] * (kind in (1, 3)) + ["strangers"] * (kind in (2, 3))
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(kind == 3)))
    return rows


def test_pairs_of_terms_are_learned(spark):
    rows = planted(1600, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, toxicity.train(docs, labels)).withColumn("h", held_out(F.col("doc_id")))
    want = {r[0]: r[2] for r in rows}
    tested = [(r.score >= 0.5, want[r.doc_id] == 1) for r in got.collect() if r.h]
    assert sum(a == b for a, b in tested) >= 0.98 * len(tested) and len(tested) > 250


def test_terms_equal_plain_loop():
    texts = ["Idiot! idiots, ÉTÉ été", None, "", "a bc def " * 3, "x" * 9000]
    got = {i: set() for i in range(len(texts))}
    for lo, _, row, bucket in toxicity.term_pairs(*text_buffer(pa.array(texts))):
        for r, b in zip(row, bucket):
            got[lo + r].add(int(b))

    def one(term):          # a text of one word has its stems and itself
        return {int(b) for _, _, _, bs in toxicity.term_pairs(*text_buffer(pa.array([term]))) for b in bs}
    assert got[1] == got[2] == set()
    assert got[0] == one("idiot") | one("idiots") | one("été")
    assert got[3] == one("a") | one("bc") | one("def")
    assert len(one("idiots")) == 5 and len(one("a")) == 1


def test_machine_equals_plain_sum():
    m = toxicity.FactorizationMachine(np.array([0.5, 1.0, 2.0]), 0.3)
    m.w = np.array([0.1, -0.2, 0.3])
    x = m.value
    want = m.bias[0] + 0.1 * x[0] + 0.3 * x[2] + (m.v[0] @ m.v[2]) * x[0] * x[2]
    z = m.sums(np.array([1, 1]), np.array([0, 2]), 3)[0]
    assert np.allclose(z, [m.bias[0], want, m.bias[0]])


def test_odd_rows(spark):
    rows = planted(400, 2)
    docs = spark.createDataFrame([(*r[:2], 1.0) for r in rows] + [(None, "vermin strangers", 2.0), (9000, None, 1.0), (9001, "", 1.0),
                                 (9002, "vermin " * 60_000 + "strangers", 1.0), (5, "another text", 1.0)],
                                 "doc_id long, text string, y double")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (7, None), (8, 0), (8, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, toxicity.train(docs, labels)).collect()
    assert len(got) == 405 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[9000] == by[9001] < 0.5


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    ones = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity_scores(docs, toxicity.train(docs, none)).collect()] == [0.5, 0.5]
    assert {r.score for r in toxicity.toxicity_scores(docs, toxicity.train(docs, ones)).collect()} <= {1.0, 0.5}
    assert toxicity.toxicity_scores(docs.limit(0), toxicity.train(docs.limit(0), ones)).count() == 0
