"""Corpus text work: tokens, vocabulary, ids, fixed encoding, batches (step 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.text import (encode_fixed, join_ints, model_tokens, tokenize_words,
                                   truncate_tokens)
from corvid.operators import metrics
from corvid.operators.batches import assign_batches
from corvid.operators.vocab import encode_ids
from corvid.operators.wordpiece import AFFIX_LENGTHS, build_piece_vocab, wordpiece_ids
from corvid.plans import register
from corvid.plans.common import (BATCH, EPOCHS, LAB_CTE, MAX_LEN, VOCAB_CTE, VOCAB_K,
                                 corpus_vocab, labelled, model_tok, tok)
from corvid.sources.tables import load_table


@register("tokenize_words", f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens,
       md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {tok('text')} AS t FROM documents)""")
def q_tokenize_words(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    t = tokenize_words(F.col("text"))
    return docs.select("doc_id", F.size(t).cast("bigint").alias("n_tokens"),
                       F.md5(F.array_join(t, " ")).alias("tokens_md5"))


@register("vocab_topk", f"""WITH {VOCAB_CTE}
SELECT token, token_id, cnt FROM vocab""")
def q_vocab_topk(spark, sf_dir):
    return corpus_vocab(spark, sf_dir)


@register("encode_ids", f"""WITH {VOCAB_CTE},
t AS (SELECT doc_id, {tok('text')} AS toks FROM documents),
u AS (SELECT doc_id, unnest(toks) AS token, unnest(generate_series(0, len(toks) - 1)) AS pos
      FROM t WHERE len(toks) > 0)
SELECT u.doc_id, CAST(u.pos AS INTEGER) AS pos, u.token,
       CAST(coalesce(vocab.token_id, 1) AS INTEGER) AS token_id
FROM u LEFT JOIN vocab ON u.token = vocab.token""")
def q_encode_ids(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    toks = docs.select("doc_id", F.posexplode(tokenize_words(F.col("text"))).alias("pos", "token"))
    return encode_ids(toks, corpus_vocab(spark, sf_dir)).select(
        "doc_id", F.col("pos").cast("int").alias("pos"), "token", "token_id")


def _pieces_cte(words: str) -> str:
    """CTEs ending in ``enc(word, ids, unk)``: the piece vocabulary over the words
    of ``words(word)`` and every distinct word's greedy split."""
    affix = "\n".join(
        f"  UNION ALL SELECT substr(word, 1, {n}), cnt FROM wc WHERE length(word) > {n}\n"
        f"  UNION ALL SELECT '##' || right(word, {n}), cnt FROM wc WHERE length(word) > {n}"
        for n in AFFIX_LENGTHS)
    return f"""wc AS (SELECT word, count(*) AS cnt FROM {words} GROUP BY word),
ch AS (SELECT unnest(string_split(word, '')) AS c, cnt FROM wc),
cand AS (
  SELECT word AS piece, cnt FROM wc
{affix}
  UNION ALL SELECT c, cnt FROM ch WHERE length(c) = 1
  UNION ALL SELECT '##' || c, cnt FROM ch WHERE length(c) = 1),
pc AS (SELECT piece, sum(cnt) AS cnt FROM cand GROUP BY piece ORDER BY cnt DESC, piece ASC LIMIT {VOCAB_K}),
pieces AS (SELECT piece, CAST(row_number() OVER (ORDER BY cnt DESC, piece ASC) + 3 AS INTEGER) AS piece_id FROM pc),
pm AS (SELECT map(list(piece), list(piece_id)) AS ids,
              max(length(CASE WHEN starts_with(piece, '##') THEN substr(piece, 3) ELSE piece END)) AS longest
       FROM pieces),
rec AS (
  SELECT word, 0 AS pos, []::INTEGER[] AS ids FROM wc
  UNION ALL
  SELECT r.word, r.pos + b.len, list_append(r.ids, b.id)
  FROM rec r, LATERAL (
    SELECT max(t.L) AS len, arg_max(p.piece_id, t.L) AS id
    FROM range(1, least(length(r.word) - r.pos, (SELECT longest FROM pm)) + 1) t(L)
    JOIN pieces p ON p.piece = (CASE WHEN r.pos = 0 THEN '' ELSE '##' END) || substr(r.word, r.pos + 1, t.L)) b
  WHERE r.pos < length(r.word) AND b.len IS NOT NULL),
fin AS (SELECT word, max(pos) AS pos, arg_max(ids, pos) AS ids FROM rec GROUP BY word),
enc AS (SELECT word, CASE WHEN pos = length(word) THEN ids ELSE [1] END AS ids,
               CASE WHEN pos = length(word) THEN 0 ELSE 1 END AS unk FROM fin)"""


def piece_vocab(spark, docs, words):
    return build_piece_vocab(spark, docs.select(F.explode(words).alias("word")))


@register("encode_fixed", f"""WITH RECURSIVE {LAB_CTE},
t AS (SELECT doc_id, label, {model_tok('text')} AS toks FROM lab),
u AS (SELECT doc_id, unnest(toks) AS word, unnest(generate_series(1, len(toks))) AS pos FROM t WHERE len(toks) > 0),
{_pieces_cte('u')},
ids AS (SELECT u.doc_id, flatten(list(enc.ids ORDER BY u.pos)) AS ids FROM u JOIN enc USING (word) GROUP BY u.doc_id),
body AS (SELECT t.doc_id, t.label, len(coalesce(ids.ids, [])) AS n_tokens,
                list_concat([2], coalesce(ids.ids, [])[1:{MAX_LEN - 2}], [3]) AS b
         FROM t LEFT JOIN ids ON t.doc_id = ids.doc_id)
SELECT doc_id, label AS labels, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(len(b) AS INTEGER) AS n_real,
       array_to_string(list_concat(b, list_resize([0], {MAX_LEN} - len(b), 0)), ' ') AS input_ids,
       array_to_string(list_concat(list_resize([1], len(b), 1),
                                   list_resize([0], {MAX_LEN} - len(b), 0)), ' ') AS attention_mask
FROM body""")
def q_encode_fixed(spark, sf_dir):
    """WordPiece ids of words and punctuation, cut to the window, padded."""
    lab = labelled(spark, sf_dir)
    words = model_tokens(F.col("text"))
    # Raw text and index dropped, label renamed, int arrays.
    ids = wordpiece_ids(spark, lab.select("doc_id", F.col("label").alias("labels"), words.alias("words")),
                        piece_vocab(spark, lab, words), "words")
    kept = ids.withColumn("kept", truncate_tokens(F.col("piece_ids"), MAX_LEN))
    input_ids, mask = encode_fixed(F.col("kept"), MAX_LEN)
    return kept.select("doc_id", "labels", F.size("piece_ids").cast("bigint").alias("n_tokens"),
                       (F.size("kept") + 2).cast("int").alias("n_real"),
                       join_ints(input_ids).alias("input_ids"), join_ints(mask).alias("attention_mask"))


@register("sequence_stats", f"""WITH {LAB_CTE},
t AS (SELECT split, len({tok('text')}) AS n FROM lab)
SELECT split, count(*) AS n, round(avg(n), 6) AS avg_tokens,
       round(avg(least(n + 2, {MAX_LEN})), 6) AS avg_kept,
       round(avg(({MAX_LEN} - least(n + 2, {MAX_LEN})) / {MAX_LEN}), 6) AS pad_share,
       round(avg(CASE WHEN n + 2 > {MAX_LEN} THEN 1 ELSE 0 END), 6) AS truncated_share
FROM t GROUP BY split""")
def q_sequence_stats(spark, sf_dir):
    lab = labelled(spark, sf_dir).withColumn("n_tokens", F.size(tokenize_words(F.col("text"))))
    return metrics.sequence_stats(lab, "n_tokens", MAX_LEN, ["split"])


@register("assign_batches", f"""WITH {LAB_CTE},
r AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS i FROM lab)
SELECT doc_id, split, CAST(i // {BATCH} AS BIGINT) AS batch_id,
       CAST(i % {BATCH} AS BIGINT) AS pos_in_batch FROM r""")
def q_assign_batches(spark, sf_dir):
    lab = labelled(spark, sf_dir).select("doc_id", "split")
    return assign_batches(lab, ["split"], "doc_id", BATCH)


@register("batch_plan", f"""WITH {LAB_CTE}
SELECT split, count(*) AS n, CAST(ceil(count(*) / {BATCH}) AS BIGINT) AS batches_per_epoch,
       CAST(ceil(count(*) / {BATCH}) * {EPOCHS} AS BIGINT) AS total_steps
FROM lab GROUP BY split""")
def q_batch_plan(spark, sf_dir):
    return metrics.batches_per_epoch(labelled(spark, sf_dir), BATCH, EPOCHS, ["split"])


@register("wordpiece_encode", f"""WITH RECURSIVE w AS (SELECT doc_id, unnest({tok('text')}) AS word FROM documents),
{_pieces_cte('w')}
SELECT d.doc_id, count(enc.word) AS n_words, CAST(coalesce(sum(len(enc.ids)), 0) AS BIGINT) AS n_pieces,
       CAST(coalesce(sum(enc.unk), 0) AS BIGINT) AS n_unk
FROM documents d LEFT JOIN w ON w.doc_id = d.doc_id LEFT JOIN enc ON w.word = enc.word GROUP BY d.doc_id""")
def q_wordpiece_encode(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    words = tokenize_words(F.col("text"))
    long = docs.select("doc_id", F.size(words).cast("bigint").alias("n_words"), words.alias("words"))
    return wordpiece_ids(spark, long, piece_vocab(spark, docs, words), "words").select(
        "doc_id", "n_words", F.size("piece_ids").cast("bigint").alias("n_pieces"), "n_unk")
