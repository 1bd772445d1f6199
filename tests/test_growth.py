"""What a step holds or reads must not grow with the table: streams, user
functions, windows and repeated reads."""

from __future__ import annotations

import os
import random
from collections import Counter

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvid.operators import chat as ops

SF = "/root/testdata/sf0.001"


def scans(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conversation_dir(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"c{c} t{t}") for c in range(12) for t in range(8)]
    (spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(6)
     .write.parquet(str(tmp_path / "conversations.parquet")))
    return str(tmp_path)


# F1

def test_category_training_reads_the_files_once(spark):
    from corvid.plans.ml_plans import q_train_category
    assert "csv" not in scans(q_train_category(spark, SF)).lower()


# F2

def test_prompt_batches_do_not_grow_with_files(spark, conversation_dir, monkeypatch):
    from corvid.plans import stream_plans as SP
    monkeypatch.setattr(SP, "fresh_dir", lambda s, name: f"{conversation_dir}/{name}")
    got = SP.q_stream_prompts(spark, conversation_dir)
    assert got.count() == 12 * 4
    assert len([x for x in os.listdir(f"{conversation_dir}/stream-prompts/out") if x.startswith("batch_id=")]) <= 4


# F3, F5

def test_wordpiece_works_on_bounded_parts(spark):
    from corvid.operators.wordpiece import greedy_pieces, whole_rows, wordpiece_ids
    docs = [["ab", "b"], [], None, ["abab"] * 5, ["xx", "a"], ["b"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(docs, pa.list_(pa.string()))], names=["i", "w"])
    parts = [(p.column(0).to_pylist(), ends.tolist()) for p, ends in whole_rows(batch, 1, words=3)]
    assert parts == [([0, 1, 2], [0, 2, 2, 2]), ([3], [0, 5]), ([4, 5], [0, 2, 3])]
    vocab = {"[UNK]": 1, "a": 4, "##b": 5, "ab": 6, "b": 7, "##ab": 8}
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, w array<string>").coalesce(1)
    v = spark.createDataFrame(list(vocab.items()), "piece string, piece_id int")
    got = {r.i: (r.piece_ids, r.n_unk) for r in wordpiece_ids(spark, df, v, "w").collect()}
    for i, d in enumerate(docs):
        split = [greedy_pieces(w, vocab, 2) for w in d or ()]
        assert got[i] == ([vocab[p] for s in split for p in s], sum(s == ["[UNK]"] for s in split))


# F4

def test_inferred_cells_are_read_not_the_lines(spark):
    from corvid.plans.bank_plans import bank_files
    from corvid.sources.dialects import read_any_bank_csv
    assert "Scan text" not in scans(read_any_bank_csv(spark, bank_files(spark, SF)))


# F6

def test_causal_context_inside_rows_equals_the_long_form(spark):
    docs = [(1, ["a", "b", "ç"]), (2, []), (3, None), (4, ["x"]), (None, ["lost"]), (5, ["p", "q"]), (5, ["p", "q"]),
            (6, [f"w{i}" for i in range(50)])]
    df = spark.createDataFrame(docs, "id int, t array<string>")
    long = df.select("id", F.posexplode("t").alias("pos", "token"))
    got = ops.causal_context(df, "id", tokens_col="t").filter("id <> 5")
    want = ops.causal_context(long.filter("id <> 5"), "id").select(got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    both = ops.causal_context(df, "id", tokens_col="t").filter("id = 5").collect()
    assert len(both) == 4 and len({r.context_fp for r in both}) == 4       # one sequence of both rows


# F7

def test_user_functions_tokenize_bounded_parts(monkeypatch):
    from corvid.plans import udf_plans as U
    seen, tokens = [], U._tokens
    monkeypatch.setattr(U, "_tokens", lambda texts, pattern: seen.append(texts.str.len().sum()) or tokens(texts, pattern))
    texts = pd.Series(["ab " * 200_000, "cd " * 200_000, None, "", "ef " * 600_000, "x"])
    out = U._tokenize_batch(pd.DataFrame({"doc_id": range(6), "text": texts}))
    assert out["n_tokens"].tolist() == [200_000, 200_000, 0, 0, 600_000, 1]
    assert max(seen) == 1_800_000 and len(seen) == 4      # the longest text alone


# F8

def test_a_step_scores_its_batch_once(spark, monkeypatch):
    from corvid.operators import epochs as E
    names, stored = [], E.stored
    monkeypatch.setattr(E, "stored", lambda df, name: names.append(name) or stored(df, name))
    rows = [(i, "good fine" if i % 2 else "bad poor", i % 2, "validation" if i % 5 == 0 else "train") for i in range(20)]
    E.train_epochs(spark.createDataFrame(rows, "doc_id long, text string, label int, split string"),
                   E.Schedule(epochs=1, batches=2))
    assert names.count("epoch-err") == 2 and names.count("epoch-scores") == 1


# F9

def test_sequences_stay_out_of_the_numbering(spark, monkeypatch):
    seen, number = [], ops.row_number
    monkeypatch.setattr(ops, "row_number", lambda df, *a, **k: seen.append(df.columns) or number(df, *a, **k))
    rows = spark.createDataFrame([(c, p, "a", 1) for c in (3, 1, 2) for p in range(c + 1)],
                                 "conv_id long, pos long, token string, mask int")
    vocab = spark.createDataFrame([("a", 4), (ops.C.PAD_TOKEN or ops.C.EOS_TOKEN, 5)], "token string, token_id int")
    got = {r.conv_id: (r.micro_batch, r.seq_len, r.padded_len, r.input_ids)
           for r in ops.pad_batches(rows, vocab, 3, 2, 1).collect()}
    assert got == {1: (0, 2, 3, [4, 4, 5]), 2: (0, 3, 3, [4] * 3), 3: (1, 3, 3, [4] * 3)}
    assert seen == [["conv_id", "seq_len"]]


# F10

def test_category_scoring_reads_the_files_once(spark):
    from corvid.plans.class_plans import predictions
    assert "csv" not in scans(predictions(spark, SF)).lower()


# F11

def test_chat_batches_do_not_grow_with_files(spark, conversation_dir, monkeypatch):
    from corvid.plans import stream_plans as SP
    from corvid.plans.chat_plans import terminal_inputs
    monkeypatch.setattr(SP, "fresh_dir", lambda s, name: f"{conversation_dir}/{name}")
    got = SP.q_stream_chat(spark, conversation_dir)
    want = ops.chat_rules(terminal_inputs(SP.load_table(spark, conversation_dir, "conversations")))
    key = lambda r: (r.conv_id, r.turn, r.role, r.text)
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    assert len([x for x in os.listdir(f"{conversation_dir}/stream-chat/out/turns") if x.startswith("batch_id=")]) <= 4


# F12

def test_blocks_are_bounded_and_dates_stay(spark, tmp_path, monkeypatch):
    from corvid.operators import dates as D
    from corvid.sources import dialects as S
    days = [f"{d:02d}/{m:02d}" for _ in range(2) for m in range(1, 13) for d in (5, 20)]
    (tmp_path / "year=2021").mkdir()
    (tmp_path / "year=2021" / "a.txt").write_text("\n".join(days))

    def dates():
        lines = S.read_lines(spark, str(tmp_path)).withColumn("year", F.lit(2021)).withColumn("day_first", F.lit(True))
        most = lines.groupBy("file", "block").count().agg(F.max("count")).first()[0]
        return most, [r.date for r in D.resolve_dates(lines.withColumnRenamed("line", "date_raw")).orderBy("place").collect()]
    most, whole = dates()
    assert most == 48 and whole[0] == "2020-01-05" and whole[-1] == "2021-12-20"
    monkeypatch.setattr(S, "BLOCK_LINES", 5)
    monkeypatch.setattr(D, "BLOCKS_EACH", 1)
    most, cut = dates()
    assert most <= 5 and cut == whole


# F13

def test_pairs_are_zipped_without_a_function_a_token(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["x"]), (3, []), (4, None)], "id int, t array<string>")
    out = ops.next_token_pairs(df, "id", "t")
    assert sorted(map(tuple, out.collect())) == [(1, 0, "a", "b"), (1, 1, "b", "c")]
    assert "lambdafunction" not in scans(out)


@pytest.mark.parametrize("at_once", [1 << 20, 1])
def test_followers_are_counted_once_and_ranked_in_parts(spark, monkeypatch, at_once):
    monkeypatch.setattr(ops, "FOLLOWERS", at_once, raising=False)
    rng = random.Random(at_once)
    words = ["a", "b", "B", "é", "", "zz", "\U0001f600", "\uffff", None]
    rows = [(rng.choice(words[:2] if i % 3 else words), rng.choice(words)) for i in range(400)]
    out = ops.next_token_topk(spark.createDataFrame(rows, "token string, next_token string").repartition(7), 3)
    assert scans(out).count("partial_count(1)") == 1
    code = lambda w: b"" if w is None else b"x" + w.encode()  # noqa: E731 nulls first, then by bytes
    want = []
    for token in {t for t, _ in rows if t is not None}:
        of = Counter(n for t, n in rows if t == token)
        best = sorted(of.items(), key=lambda x: (-x[1], code(x[0])))[:3]
        want += [(token, n, c, round(c / sum(of.values()), 6), i + 1) for i, (n, c) in enumerate(best)]
    order = lambda r: (r[0], r[4])
    assert sorted(map(tuple, out.collect()), key=order) == sorted(want, key=order)
    assert out.columns == ["token", "next_token", "cnt", "share", "rank"]
