"""Integer epochs against a plain trainer; rules anywhere against the theta join;
one answer for each input row."""

import collections
import random
import re

from pyspark.sql import functions as F

from corvid.operators import epochs as E
from corvid.operators.patterns import match_anywhere
from corvid.operators.score import score_texts
from corvid.operators.serve import parse_requests, score_requests, score_singles

TOKEN = re.compile(r"[^\W_]+|[^\w \t\n\r\f]|_")


def plain_epochs(rows, s):
    tf = {i: collections.Counter(TOKEN.findall((t or "").lower())) for i, t, _, _ in rows}
    seen = collections.Counter()
    for i, _, _, split in rows:
        if split == "train":
            seen.update(tf[i])
    vocab = set(sorted(seen, key=lambda t: (-seen[t], t))[:s.vocab])
    for i in tf:
        c = collections.Counter()
        for t, n in tf[i].items():
            c[t if t in vocab else "[UNK]"] += n
        tf[i] = c
    w = dict.fromkeys([*vocab, "[UNK]"], 0)
    bias, out = 0, []

    def z(i):
        n = sum(tf[i].values())
        return bias + (sum(c * w[t] for t, c in tf[i].items()) * s.gain // n if n else 0)
    for _ in range(s.epochs):
        for b in range(s.batches):
            batch = [(i, y) for i, _, y, split in rows if split == "train" and i * s.shuffle % s.batches == b]
            err = {i: y * E.ONE - min(max(E.ONE // 2 + z(i) // 4, 0), E.ONE) for i, y in batch}
            g = collections.Counter()
            for i, e in err.items():
                n = sum(tf[i].values())
                for t, c in tf[i].items():
                    g[t] += e * c * s.gain // n
            m = max(1, len(batch))
            w = {t: v - v // s.decay + s.rate * g[t] // m for t, v in w.items()}
            bias += s.rate * sum(err.values()) // m
        out.append({**w, E.BIAS: bias})
    return out, {i: z(i) for i, *_ in rows}


def test_epochs_equal_a_plain_trainer(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["good", "fine", "the", "a", "."] if y else ["bad", "poor", "the", "a", "!"], k=rng.randrange(1, 30))),
             y, "validation" if i % 5 == 0 else "train") for i in range(200) for y in [int(rng.random() < 0.7)]]
    rows += [(300, "", 1, "train"), (301, None, 0, "train"), (302, "unseen words only", 1, "validation")]
    s = E.Schedule(epochs=2, batches=3, vocab=6)
    history, kept, tokens = E.train_epochs(spark.createDataFrame(rows, "doc_id long, text string, label int, split string"), s)
    want, z = plain_epochs(rows, s)
    assert [{r.token: r.w for r in k.collect()} for k in kept] == want
    docs = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    assert {r.doc_id: r.z for r in E.scores(docs, tokens, kept[-1], s).collect()} == z
    hist = {(r.epoch, r.split): r for r in history.collect()}
    assert len(hist) == 4 and hist[2, "validation"].accuracy > 0.9
    assert E.best_epoch(history).first().epoch in (1, 2)


def test_rules_anywhere_equal_the_theta_join(spark):
    """10,000 random rules of 1 to 12 letters, hot pieces, ties and repeats."""
    rng = random.Random(2)
    syl = ["CA", "RO", "MER", "LO", "JA", "PAG", " ", "*", "ÉL", "X", "7"]
    rules = [("".join(rng.choices(syl, k=rng.randrange(2, 6)))[:12], f"m{i % 977}", f"c{i % 10}", rng.randrange(4)) for i in range(9_990)]
    rules += [("", "none", "c0", 0), ("Q", "one letter", "c1", 3), ("caro", "lower", "c2", 0), *rules[:7]]
    texts = ["".join(rng.choices(syl, k=rng.randrange(1, 12))).lower() if i % 3 else "COMPRA " + "".join(rng.choices(syl, k=6))
             for i in range(400)] + [None, "", "Q", "zzz"] + ["COMPRA CAROLO"] * 50
    tx = spark.createDataFrame(list(enumerate(texts)), "i long, description_clean string")
    pats = spark.createDataFrame(rules, "pattern string, merchant string, category string, priority int")
    got = {r.i: (r.merchant, r.category, r.matched_pattern) for r in match_anywhere(spark, tx, patterns=pats).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        fits = [(p, -len(x), x, m, c) for x, m, c, p in rules if x and t is not None and x.upper() in t.upper()]
        if fits:
            assert got[i] == (min(fits)[3], min(fits)[4], min(fits)[2]), (t, min(fits))
        else:
            assert got[i][1:] == (None if t is None else "Other", None)


def test_without_rules(spark):
    none = spark.createDataFrame([], "pattern string, merchant string, category string, priority int")
    tx = spark.createDataFrame([(1, "some shop")], "i long, description_clean string")
    assert match_anywhere(spark, tx, patterns=none).first().merchant == "Some Shop"


WEIGHTS = [("[CLS]", 0.0, 0.0), ("[UNK]", 0.0, 0.0), ("good", -1.0, 2.0), ("bad", 2.0, -1.0)]


def test_rows_that_share_an_id_are_scored_one_by_one(spark):
    w = spark.createDataFrame(WEIGHTS, "token string, w0 double, w1 double")
    docs = spark.createDataFrame([(1, "good good"), (1, "bad"), (2, "good"), (1, "bad"), (None, "good"), (None, None)],
                                 "doc_id long, text string")
    got = sorted((str(r.doc_id), r.pred) for r in score_texts(docs, w).collect())
    assert got == [("1", 0), ("1", 0), ("1", 1), ("2", 1), ("None", 0), ("None", 1)]


def test_requests_that_share_an_id_get_an_answer_each(spark):
    w = spark.createDataFrame(WEIGHTS, "token string, w0 double, w1 double")
    reqs = spark.createDataFrame([("r", '{"text": "good"}'), ("r", '{"text": "bad"}'), ("r", "{"), (None, '{"text": "bad"}')], "rid string, body string")
    got = score_singles(parse_requests(reqs, "body"), w, "rid").collect()
    assert sorted((str(r.text), str(r.label)) for r in got) == [("None", "None"), ("bad", "Negative"), ("bad", "Negative"), ("good", "Positive")]
    many = spark.createDataFrame([("r", ["good", None]), ("r", ["bad", "good", "bad"]), ("r", [])], "rid string, texts array<string>")
    out = sorted([p.label for p in r.predictions] for r in score_requests(many, w, "rid").select(
        "rid", F.col("predictions")).collect() if all(p.label for p in r.predictions))
    assert out == [[], ["Negative", "Positive", "Negative"]]
