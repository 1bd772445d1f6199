"""Shared building blocks for plans and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.text import tokenize_words
from corvid.operators.score import VOCAB_SIZE, train_weights
from corvid.operators.vocab import build_vocab
from corvid.sources.tables import load_labelled, load_table, split_filter

VOCAB_K = MODEL_K = VOCAB_SIZE
MAX_LEN = 128
BATCH = 32
EPOCHS = 3


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_labelled(spark, sf_dir)


def model(spark: SparkSession, sf_dir: str, k: int = MODEL_K) -> DataFrame:
    lab = labelled(spark, sf_dir)
    return train_weights(spark, split_filter(lab, "train"), k=k)


def corpus_vocab(spark: SparkSession, sf_dir: str, k: int = VOCAB_K) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return build_vocab(spark, docs.select(F.explode(tokenize_words(F.col("text"))).alias("token")), k)


# ---- SQL fragments (DuckDB dialect) ------------------------------------------

def tok(col: str) -> str:
    return ("list_filter(regexp_split_to_array(lower(" + col + r"), '[^\p{L}\p{N}]+'), "
            "lambda x: x <> '')")


def model_tok(col: str) -> str:
    return ("regexp_extract_all(lower(" + col + r"), '[\p{L}\p{N}]+|[^\p{L}\p{N} \t\n\r\f]')")


LAB_CTE = """lab AS (
  SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS label,
         CASE WHEN d.doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

def model_cte(k: int = MODEL_K, s: str = "") -> str:
    """CTEs ending in ``w{s}(token, w0, w1)``: the naive Bayes weight table."""
    return f"""trtok{s} AS (SELECT label, unnest({model_tok('text')}) AS token FROM lab WHERE split = 'train'),
cnt{s} AS (SELECT token, count(*) AS cnt,
               sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS c0,
               sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS c1
        FROM trtok{s} GROUP BY token),
kept{s} AS (SELECT token, c0, c1 FROM cnt{s} ORDER BY cnt DESC, token ASC LIMIT {k}),
top{s} AS (SELECT * FROM kept{s} UNION ALL
           SELECT '[UNK]', (SELECT coalesce(sum(c0), 0) FROM cnt{s}) - (SELECT coalesce(sum(c0), 0) FROM kept{s}),
                  (SELECT coalesce(sum(c1), 0) FROM cnt{s}) - (SELECT coalesce(sum(c1), 0) FROM kept{s})),
tot{s} AS (SELECT sum(c0)::DOUBLE AS t0, sum(c1)::DOUBLE AS t1, count(*)::DOUBLE AS v FROM top{s}),
pri{s} AS (SELECT sum(CASE WHEN label = 0 THEN 1 ELSE 0 END)::DOUBLE AS n0,
               sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)::DOUBLE AS n1
        FROM lab WHERE split = 'train'),
w{s} AS (SELECT token,
             round(ln((c0::DOUBLE + 1.0) / (t0 + 1.0 * v)) * 8) / 8 AS w0,
             round(ln((c1::DOUBLE + 1.0) / (t1 + 1.0 * v)) * 8) / 8 AS w1
      FROM top{s}, tot{s}
      UNION ALL
      SELECT '[CLS]', round(ln((n0 + 1.0) / (n0 + n1 + 2.0)) * 8) / 8,
             round(ln((n1 + 1.0) / (n0 + n1 + 2.0)) * 8) / 8 FROM pri{s})"""


MODEL_CTE = LAB_CTE + ",\n" + model_cte()


def score_cte(src: str, id_cols: str, text_col: str = "text", s: str = "") -> str:
    """CTEs ending in ``sm{s}(id_cols, p0, p1)``: ``src`` scored with ``w{s}``."""
    return f"""seq{s} AS (SELECT {id_cols}, unnest(list_concat(['[CLS]'], coalesce({model_tok(text_col)}, []))) AS token
             FROM {src}),
unk{s} AS (SELECT w0 AS u0, w1 AS u1 FROM w{s} WHERE token = '[UNK]'),
lg{s} AS (SELECT {id_cols}, sum(coalesce(w0, u0)) AS l0, sum(coalesce(w1, u1)) AS l1
       FROM seq{s} LEFT JOIN w{s} USING (token) CROSS JOIN unk{s} GROUP BY {id_cols}),
ex{s} AS (SELECT {id_cols}, exp(l0 - greatest(l0, l1)) AS e0, exp(l1 - greatest(l0, l1)) AS e1
       FROM lg{s}),
sm{s} AS (SELECT {id_cols}, e0 / (e0 + e1) AS p0, e1 / (e0 + e1) AS p1 FROM ex{s})"""


PRED_COLS = """CAST(CASE WHEN p1 > p0 THEN 1 ELSE 0 END AS INTEGER) AS pred,
       CASE WHEN p1 > p0 THEN 'Positive' ELSE 'Negative' END AS label,
       round(greatest(p0, p1), 4) AS score"""

VOCAB_CTE = f"""dtok AS (SELECT unnest({tok('text')}) AS token FROM documents),
vc AS (SELECT token, count(*) AS cnt FROM dtok GROUP BY token),
vt AS (SELECT token, cnt FROM vc ORDER BY cnt DESC, token ASC LIMIT {VOCAB_K}),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY cnt DESC, token ASC) + 3 AS INTEGER) AS token_id,
         CAST(cnt AS BIGINT) AS cnt FROM vt
  UNION ALL
  SELECT token, CAST(token_id AS INTEGER), CAST(cnt AS BIGINT)
  FROM (VALUES ('[PAD]', 0, 0), ('[UNK]', 1, 0), ('[CLS]', 2, 0), ('[SEP]', 3, 0)) r(token, token_id, cnt))"""
