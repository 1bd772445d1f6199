"""Prompts from keyed state against the batch operator; the learned generator."""

import datetime as dt
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corvid.operators import chat as ops
from corvid.operators import generate as G

TURNS = "conv_id long, turn int, role string, text string"
ROLES = ["system", "user", "assistant", "user", "assistant", "user"]


def conversations(spark):
    rows = [(c, t, ROLES[t], f" text {c} {t} ") for c in range(7) for t in range(6)]
    rows[8] = (1, 2, "assistant", None)
    return spark.createDataFrame(rows, TURNS)


@pytest.mark.parametrize("orders", [[[0, 1, 2, 3]], [[3, 2, 1, 0]], [[2, 0], [2, 0], [3, 1, 3]]])
def test_prompts_equal_the_batch_after_any_arrival(spark, orders):
    from corvid.plans.stream_plans import prompt_arrivals
    turns = conversations(spark)
    want = ops.context_prompts(ops.drop_blank(turns)).collect()
    got = prompt_arrivals(spark, turns, orders).collect()
    assert sorted(map(tuple, got)) == sorted((r.conv_id, r.turn, r.prompt_chars, r.prompt_fp) for r in want)


def test_blank_turns_quit_gaps_and_missing_keys(spark):
    from corvid.plans.stream_plans import prompt_arrivals
    turns = spark.createDataFrame([
        (1, 0, "user", "hello"), (1, 1, "user", "  "), (1, 2, "user", "more"), (1, 3, "user", " QUIT"), (1, 4, "user", "late"),
        (2, 0, "user", "hello"), (2, 2, "user", "turn 1 never comes"),
        (3, 0, "user", None), (3, 1, None, "no role"), (3, 2, "user", "x"),
        (None, 0, "user", "no key"), (4, None, "user", "no turn"), (4, 0, "user", "")], TURNS)
    got = prompt_arrivals(spark, turns, [[3, 2, 1, 0]]).collect()
    assert sorted((r.conv_id, r.turn) for r in got) == [(1, 0), (1, 2), (2, 0), (3, 2)]


SEED = "date date, amount double, description string, gold_merchant string, gold_category string"


def seed_rows():
    rng = random.Random(4)
    texts = {("Uber", "Transport"): ["UBER *TRIP SP", "UBER *TRIP BR", "UBER  *EATS"], ("Pix", "Transfer"): ["PIX MARIA", "PIX A A A"],
             ("Ümlaut", "Bills"): ["X"]}
    labels = [("Uber", "Transport")] * 6 + [("Pix", "Transfer")] * 3 + [("Ümlaut", "Bills")]
    return [(dt.date(2024, rng.randint(1, 3), rng.randint(1, 28)), -rng.randint(1, 400_000) / 100, rng.choice(texts[label]), *label)
            for label in labels * 8]


def test_counts_equal_a_plain_count(spark):
    rows = seed_rows()
    extra = [(None, 1.0, "A", "M", "C"), (dt.date(2024, 1, 1), None, "A", "M", "C"), (dt.date(2024, 1, 1), 1.0, "A", None, "C")]
    got = {(r.kind, r.ctx, r.value): r.n for r in G.learn(spark.createDataFrame(rows + extra, SEED)).collect()}
    want = Counter()
    for date, amount, text, m, c in rows:
        label = m + G.SEP + c
        want["label", "", label] += 1
        want["month", label, f"{date:%Y-%m}"] += 1
        want["amount", label, str(round(amount * 100) // G.AMOUNT_STEP)] += 1
        for a, b in itertools.pairwise([G.START, *text.split(), G.END]):
            want["next", label + G.SEP + a, b] += 1
    assert got == dict(want)


def test_guide_table_covers_every_place_once(spark):
    counts = spark.createDataFrame([("k", "a", v, n) for v, n in zip("abcdefg", [1, 50, 2, 1, 7, 300, 1])]
                                   + [("k", "b", "only", 9)], "kind string, ctx string, value string, n long")
    places = defaultdict(list)
    for r in G.choices(counts).collect():
        places[r.ctx] += [(p, r.value) for p in range(r.lo, r.hi) if p // r.width == r.slot]
    assert sorted(p for p, _ in places["a"]) == list(range(362))
    assert Counter(v for _, v in places["a"]) == Counter(dict(zip("abcdefg", [1, 50, 2, 1, 7, 300, 1])))
    assert sorted(places["b"]) == [(p, "only") for p in range(9)]


def test_generated_rows_follow_the_seed(spark):
    seed = spark.createDataFrame(seed_rows(), SEED)
    counts = G.learn(seed)
    ids = spark.range(6000).withColumnRenamed("id", "synth_id")
    made = G.generate(ids, counts).cache()
    again = G.generate(ids.repartition(7), counts.repartition(5))
    assert made.exceptAll(again).count() == 0 and made.count() == 6000
    n_seed = 80
    for r in G.frequencies(seed, made, {"label": F.col("gold_merchant")}).collect():
        share = r.seed_n / n_seed                       # five standard deviations
        assert abs(r.made_n / 6000 - share) < 5 * (share * (1 - share) / 6000) ** 0.5
    seen = {k for k, in counts.filter("kind = 'next'").select("ctx").collect()}
    for r in made.collect():
        words = [G.START, *r.description.split()]
        assert all(f"{r.gold_merchant}{G.SEP}{r.gold_category}{G.SEP}{w}" in seen for w in words)
        assert len(words) <= G.MAX_TOKENS + 1 and dt.date(2024, 1, 1) <= r.date <= dt.date(2024, 3, 28)
        assert -4000 <= r.amount < 0
    assert G.generate(ids, G.learn(seed.limit(0))).count() == 0
