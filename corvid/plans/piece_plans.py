"""WordPiece vocabulary learned from the corpus (X7), round by round, exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.text import tokenize_words
from corvid.operators.piece_learning import learn_pieces, word_counts
from corvid.plans import register
from corvid.plans.common import tok
from corvid.sources.tables import load_table

ROUNDS, PER_ROUND, MIN_COUNT = 4, 64, 20


def _sql() -> str:
    out = [f"""wc AS (SELECT word, count(*) AS cnt FROM (SELECT unnest({tok('text')}) AS word FROM documents) GROUP BY word),
s0 AS MATERIALIZED (SELECT word, cnt, list_transform(range(1, len(word) + 1), lambda i: CASE WHEN i = 1 THEN '' ELSE '##' END || word[i]) AS ps FROM wc)"""]
    for i in range(1, ROUNDS + 1):
        s = f"s{i - 1}"
        out.append(f"""c{i} AS (SELECT p, sum(cnt) AS c FROM (SELECT unnest(ps) AS p, cnt FROM {s}) GROUP BY p),
p{i} AS (SELECT x.a, x.b, sum(cnt) AS n FROM (SELECT unnest(list_transform(range(1, len(ps)), lambda i: {{'a': ps[i], 'b': ps[i + 1]}})) AS x, cnt
         FROM {s}) GROUP BY ALL HAVING sum(cnt) >= {MIN_COUNT}),
t{i} AS MATERIALIZED (SELECT a, b, n, row_number() OVER (ORDER BY score DESC, a, b) AS rk FROM (
  SELECT p.*, n::DOUBLE / (ca.c::DOUBLE * cb.c::DOUBLE) AS score FROM p{i} p JOIN c{i} ca ON ca.p = a JOIN c{i} cb ON cb.p = b)
  ORDER BY score DESC, a, b LIMIT {PER_ROUND}),
m{i} AS MATERIALIZED (SELECT a, b, a || b[3:] AS piece, n FROM t{i} t WHERE NOT EXISTS (
  SELECT 1 FROM t{i} u WHERE u.rk < t.rk AND (u.a IN (t.a, t.b) OR u.b IN (t.a, t.b)))),
k{i} AS (SELECT coalesce(map(list(a || chr(1) || b), list(piece)), MAP {{}}) AS mm FROM m{i}),
s{i} AS MATERIALIZED (SELECT word, cnt, list_reduce(list_transform(ps, lambda x: [x]), lambda acc, x:
    CASE WHEN mm[acc[-1] || chr(1) || x[1]] IS NULL THEN list_concat(acc, x)
         ELSE list_concat(acc[:-2], [mm[acc[-1] || chr(1) || x[1]]]) END) AS ps FROM {s}, k{i})""")
    rows = " UNION ALL ".join(f"SELECT piece, {i}, n FROM m{i}" for i in range(1, ROUNDS + 1))
    return "WITH " + ",\n".join(out) + f"""
SELECT piece, CAST(round AS INTEGER) AS round, CAST(n AS BIGINT) AS n FROM (
  SELECT p AS piece, 0 AS round, c AS n FROM c1 UNION ALL {rows})"""


@register("wordpiece_learn", _sql())
def q_wordpiece_learn(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    words = docs.select(F.explode(tokenize_words(F.col("text"))).alias("word"))
    return learn_pieces(word_counts(words), ROUNDS, PER_ROUND, MIN_COUNT)
