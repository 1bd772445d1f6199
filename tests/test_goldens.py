"""Worked examples of the reference, as unit tests."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from corvid.functions import chat as C
from corvid.functions.bank import format_row, normalize_date, parse_amount
from corvid.functions.probs import argmax, label_name, softmax
from corvid.functions.text import encode_fixed, tokenize_words, truncate_tokens
from corvid.operators import bank as B
from corvid.operators import chat as ops
from corvid.operators.metrics import batches_per_epoch
from corvid.operators.wordpiece import greedy_pieces


def test_softmax_golden(spark):
    r = spark.range(1).select(softmax(F.array(F.lit(-1.8), F.lit(0.3))).alias("p")).first()
    assert [round(x, 2) for x in r.p] == [0.11, 0.89]


def test_argmax_first_on_ties(spark):
    r = spark.range(1).select(argmax(F.array(F.lit(2.0), F.lit(5.0), F.lit(5.0))).alias("i")).first()
    assert r.i == 1


def test_label_map_strict(spark):
    import pytest
    ok = spark.range(1).select(label_name(F.lit(1)).alias("l")).first().l
    assert ok == "Positive"
    with pytest.raises(Exception):
        spark.range(1).select(label_name(F.lit(5)).alias("l")).collect()


def test_next_token_labels(spark):
    df = spark.createDataFrame([(1, "The cat sat on the mat".split())], "id int, t array<string>")
    pairs = ops.next_token_pairs(df, "id", "t").orderBy("pos").collect()
    assert [p.token for p in pairs] == ["The", "cat", "sat", "on", "the"]
    assert [p.next_token for p in pairs] == ["cat", "sat", "on", "the", "mat"]


def test_causal_context(spark):
    toks = "The cat sat on the mat".split()
    df = spark.createDataFrame([(1, toks)], "id int, t array<string>") \
        .select("id", "t", F.posexplode("t").alias("pos", "token"))
    rows = {r.token + str(r.pos): r.ctx for r in
            df.select("token", "pos", ops.context_tokens("t", "pos").alias("ctx")).collect()}
    assert rows["mat5"] == ["The", "cat", "sat", "on", "the"]
    assert rows["sat2"] == ["The", "cat"]


def test_padding_layout(spark):
    df = spark.createDataFrame([("This movie was great",)], "text string")
    toks = tokenize_words(F.col("text"))
    ids = F.transform(truncate_tokens(toks, 128), lambda x: F.lit(7))
    input_ids, mask = encode_fixed(ids, 128)
    r = df.select(input_ids.alias("i"), mask.alias("m")).first()
    assert len(r.i) == 128 and r.i[:6] == [2, 7, 7, 7, 7, 3] and set(r.i[6:]) == {0}
    assert sum(r.m) == 6 and r.m[:6] == [1] * 6


def test_wordpiece_golden():
    vocab = {"un", "##happi", "##ness"}
    assert greedy_pieces("unhappiness", vocab, 6) == ["un", "##happi", "##ness"]
    assert greedy_pieces("happiness", vocab, 6) == ["[UNK]"]


def test_batch_count(spark):
    r = batches_per_epoch(spark.range(67349), 32, 3).first()
    assert (r.batches_per_epoch, r.total_steps) == (2105, 6315)


def test_chat_tags(spark):
    df = spark.createDataFrame([(1, 0, "user", "What is Python?"),
                                (1, 1, "assistant", "Python is a programming language...")],
                               "conv_id long, turn long, role string, text string")
    segs = ops.render_segments(df).orderBy("turn").collect()
    text = C.BOS + "".join(s.segment for s in segs)
    assert text == ("<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n"
                    "What is Python?<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n"
                    "Python is a programming language...<|eot_id|>")
    assert segs[1].seg_start == len(C.BOS) + len(segs[0].segment)


def test_chat_stop_rule(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "user", "  "), (1, 2, "user", "QUIT"),
                                (1, 3, "user", "more")],
                               "conv_id long, turn long, role string, text string")
    assert [r.text for r in ops.chat_rules(df).collect()] == ["hi"]


def test_merchant_and_category(spark):
    tx = spark.createDataFrame([("RCHLO*Riachuelo",), ("UBER *TRIP BR",), ("UBER *EATS X",),
                                ("PADARIA SÃO JOSÉ",)], "description_clean string")
    got = {r.description_clean: (r.merchant, r.category)
           for r in B.match_merchant(spark, tx).collect()}
    assert got["RCHLO*Riachuelo"] == ("Riachuelo", "Shopping")
    assert got["UBER *TRIP BR"] == ("Uber", "Transport")
    assert got["UBER *EATS X"] == ("Uber Eats", "Food")
    assert got["PADARIA SÃO JOSÉ"] == ("Padaria São José", "Other")


def test_merchant_rules_are_prefixes(spark):
    rules = [("MERCADO", "Mercado", "Food", 2), ("MERCADOL", "Livre", "Shopping", 1), ("UBER", "Uber", "Transport", 1)]
    texts = ["MERCADOLIVRE LOJA", "MERCADOX", "UBERX 1", "uber eats", "MERC", "", None]
    tx = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, description_clean string")
    for given in (rules, B.pattern_table(spark, rules)):
        got = [r.matched_pattern for r in B.match_merchant(spark, tx, patterns=given).orderBy("i").collect()]
        assert got == ["MERCADOL", "MERCADO", "UBER", "UBER", None, None, None]


def test_dates(spark):
    df = spark.createDataFrame([("15/Mar", "03-15", "15/03/2024", "31/02/2024", "5/3/2024")],
                               "a string, b string, c string, d string, e string")
    y = F.lit(2024)
    r = df.select(normalize_date(F.col("a"), ["dd/MMM"], y).alias("a"),
                  normalize_date(F.col("b"), ["MM-dd"], y).alias("b"),
                  normalize_date(F.col("c"), ["d/M/yyyy"]).alias("c"),
                  normalize_date(F.col("d"), ["d/M/yyyy"]).alias("d"),
                  normalize_date(F.col("e"), ["d/M/yyyy"]).alias("e")).first()
    assert (r.a, r.b, r.c, r.d, r.e) == ("2024-03-15", "2024-03-15", "2024-03-15", None, "2024-03-05")
    pt = spark.createDataFrame([("02/fev",)], "a string").select(
        normalize_date(F.col("a"), ["dd/MMM"], y).alias("a")).first().a
    assert pt == "2024-02-02"


def test_amounts(spark):
    df = spark.createDataFrame([("-25.90", "R$ -1.234,56", "abc", None)],
                               "a string, b string, c string, d string")
    r = df.select(parse_amount(F.col("a")).alias("a"), parse_amount(F.col("b"), ",", ".").alias("b"),
                  parse_amount(F.col("c")).alias("c"), parse_amount(F.col("d")).alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (-25.9, -1234.56, None, None)


def test_prompt_and_pair(spark):
    row = spark.createDataFrame([Row(row_id=1, d="15/03/2024", desc="UBER *TRIP SP", v="-25.90",
                                     date="2024-03-15", merchant="Uber", description="UBER *TRIP SP",
                                     amount=-25.90, category="Transport")])
    p = B.to_pairs(row, format_row(["Data", "Descrição", "Valor"],
                                   [F.col("d"), F.col("desc"), F.col("v")])).first()
    assert p.prompt == ("Normalize this bank transaction: Data: 15/03/2024, "
                        "Descrição: UBER *TRIP SP, Valor: -25.90")
    assert p.response == ('{"date":"2024-03-15","merchant":"Uber","description":"UBER *TRIP SP",'
                          '"amount":-25.9,"category":"Transport"}')


def test_empty_batch_request(spark):
    from corvid.operators.serve import score_requests
    w = spark.createDataFrame([("[CLS]", -0.5, -1.0), ("good", -2.0, -0.5), ("[UNK]", -1.0, -1.0)],
                              "token string, w0 double, w1 double")
    req = spark.createDataFrame([(1, ["good good", "bad"]), (2, []), (3, [None, "good good", None]), (4, None)],
                                "rid int, texts array<string>")
    out = {r.rid: r.predictions for r in score_requests(req, w, "rid").collect()}
    assert out[2] == []
    assert [p.text for p in out[1]] == ["good good", "bad"]
    assert out[1][0].label == "Positive" and out[1][1].label == "Negative"
    assert [(p.text, p.label, p.error) for p in out[3]] == [
        (None, None, "text is missing"), ("good good", "Positive", None), (None, None, "text is missing")]
    assert out[4] == []


def test_every_request_is_answered(spark):
    import json
    from corvid.operators.serve import parse_requests, score_singles, to_responses
    w = spark.createDataFrame([("[CLS]", -0.5, -1.0), ("good", -2.0, -0.5), ("[UNK]", -1.0, -1.0)],
                              "token string, w0 double, w1 double")
    bodies = ['{"text": "good good"}', '{"text": ', "nonsense", None, "{}", '{"text": null}', '{"text": ""}']
    df = spark.createDataFrame(list(enumerate(bodies)), "rid int, body string")
    out = {r.rid: json.loads(r.response) for r in
           to_responses(score_singles(parse_requests(df, "body"), w, "rid"), "rid").collect()}
    assert out[0]["label"] == "Positive" and out[6]["text"] == ""
    assert [out[i] for i in (1, 2, 3)] == [{"error": "invalid JSON"}] * 3
    assert [out[i] for i in (4, 5)] == [{"error": "text is missing"}] * 2


def test_absent_class_has_finite_weights(spark):
    from corvid.operators.score import score_texts, train_weights
    train = spark.createDataFrame([("good film", 1), ("nice film", 1)], "text string, label int")
    w = train_weights(spark, train)
    assert w.filter("w0 is null or w1 is null").count() == 0
    df = spark.createDataFrame([(1, "good film"), (2, None)], "doc_id int, text string")
    assert {r.doc_id: r.pred for r in score_texts(df, w).collect()} == {1: 1, 2: 1}


def test_odd_dates_and_amounts(spark):
    y = F.lit(2024)
    dates = {"15Mar": None, "x": None, "": None, None: None, "/": None, "15/": None, "15/Feb": "2024-02-15",
             "15/fev": "2024-02-15", "31/Feb": None, "02/May/2023": "2023-05-02", "2/5/7/9": None}
    df = spark.createDataFrame([(d,) for d in dates], "a string")
    got = df.select("a", normalize_date(F.col("a"), ["dd/MMM", "dd/MMM/yyyy"], y).alias("d")).collect()
    assert {r.a: r.d for r in got} == dates
    amounts = {"12abc34": None, "1e5": None, "(123.45)": -123.45, "\u2212159.90": -159.9, "-5": -5.0, "--5": None,
               "R$ 3.50": 3.5, "-R$ 3.50": -3.5, "R$ -3.50": -3.5, "(-5)": None, "(5": None, " 7 ": 7.0, "": None, "-": None}
    df = spark.createDataFrame([(a,) for a in amounts], "a string")
    assert {r.a: r.v for r in df.select("a", parse_amount(F.col("a")).alias("v")).collect()} == amounts
    grouped = {"1.234,56": 1234.56, "1.23,4": None, "12.345.678": 12345678.0, "1234,5": 1234.5, "1.234.5": None}
    df = spark.createDataFrame([(a,) for a in grouped], "a string")
    assert {r.a: r.v for r in df.select("a", parse_amount(F.col("a"), ",", ".").alias("v")).collect()} == grouped


def test_broken_rows_keep_their_place(spark, tmp_path):
    from corvid.sources.bank_csv import PROFILES, read_bank_csv
    p = PROFILES[0]
    folder = tmp_path / f"bank={p.bank}" / "year=2024"
    folder.mkdir(parents=True)
    lines = [",".join(p.names()), "2024-01-02,-5.00,1,SPOTIFY BR", "2024-01-02,-5.00,2,PAO DE ACUCAR, LOJA 045",
             "2024-01-02,-5.00,N/A,SPOTIFY BR", "2024-01-02,-5.00", '2024-01-02,-5.00,3,"PAO DE ACUCAR, LOJA 045"']
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    raw = read_bank_csv(spark, str(tmp_path), (p,))
    out = B.normalize_transactions(spark, raw)
    got = sorted(out.select("row_id", "reason").collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, None), (None, "bad_row"), (None, "bad_id"), (None, "bad_row"), (3, None)], key=str)
    r = B.completeness(raw, out.withColumnRenamed("description", "description_raw")).first()
    assert tuple(r) == (5, 2, 3, 0)
