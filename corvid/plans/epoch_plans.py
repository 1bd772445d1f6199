"""Training by epochs (M1, A8, M2): history, best epoch and its predictions, exact."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators import epochs as E
from corvid.plans import register
from corvid.plans.common import LAB_CTE, labelled, model_tok

S = E.Schedule()


def _floor(a: str, b: str) -> str:
    return f"(({a} - (({a} % {b}) + {b}) % {b}) // {b})"


def _scored(name: str, weights: str, where: str = "true") -> str:
    """A CTE ``name(doc_id, label, split, z, p, pred)`` of the documents that ``where`` names."""
    return f"""{name} AS MATERIALIZED (SELECT doc_id, label, split, z, least(greatest({E.ONE // 2} + {_floor('z', '4')}, 0), {E.ONE}) AS p,
    CAST(z > 0 AS INTEGER) AS pred FROM (
  SELECT d.doc_id, d.label, d.split, b.w + coalesce({_floor(f'(s * {S.gain})', 'n')}, 0) AS z
  FROM lab d LEFT JOIN (SELECT r.doc_id, CAST(sum(tf * w) AS BIGINT) AS s, any_value(n) AS n FROM tr r JOIN {weights} USING (token)
                        GROUP BY r.doc_id) x ON x.doc_id = d.doc_id
       CROSS JOIN (SELECT w FROM {weights} WHERE token = '{E.BIAS}') b WHERE {where}))"""


def _train_sql() -> str:
    out = [LAB_CTE, f"""tk AS (SELECT doc_id, split, unnest({model_tok('text')}) AS token FROM lab),
vt AS (SELECT token FROM tk WHERE split = 'train' GROUP BY token ORDER BY count(*) DESC, token LIMIT {S.vocab}),
tr AS MATERIALIZED (SELECT *, CAST(sum(tf) OVER (PARTITION BY doc_id) AS BIGINT) AS n FROM (
  SELECT doc_id, coalesce(vt.token, '[UNK]') AS token, count(*) AS tf FROM tk LEFT JOIN vt ON tk.token = vt.token GROUP BY ALL)),
w0 AS MATERIALIZED (SELECT DISTINCT token, CAST(0 AS BIGINT) AS w FROM (
  SELECT token FROM vt UNION ALL SELECT '[UNK]' UNION ALL SELECT '{E.BIAS}'))"""]
    n = 0
    for epoch in range(1, S.epochs + 1):
        for b in range(S.batches):
            out.append(_scored(f"q{n}", f"w{n}", f"split = 'train' AND d.doc_id * {S.shuffle} % {S.batches} = {b}"))
            out.append(f"""g{n} AS (SELECT token, CAST(sum({_floor(f'(err * tf * {S.gain})', 'n')}) AS BIGINT) AS g
  FROM tr JOIN (SELECT doc_id, label * {E.ONE} - p AS err FROM q{n}) e USING (doc_id) GROUP BY token),
c{n} AS (SELECT greatest(count(*), 1) AS c, CAST(coalesce(sum(label * {E.ONE} - p), 0) AS BIGINT) AS e FROM q{n}),
w{n + 1} AS MATERIALIZED (SELECT token, CAST(CASE WHEN token = '{E.BIAS}' THEN w ELSE w - {_floor('w', str(S.decay))} END
      + {_floor('x', 'c')} AS BIGINT) AS w FROM (
  SELECT w.token, w.w, c.c, {S.rate} * CASE WHEN w.token = '{E.BIAS}' THEN c.e ELSE coalesce(g.g, 0) END AS x
  FROM w{n} w LEFT JOIN g{n} g ON g.token = w.token CROSS JOIN c{n} c))""")
            n += 1
        out.append(_scored(f"s{epoch}", f"w{n}"))
    hist = " UNION ALL ".join(f"SELECT {e} AS epoch, * FROM s{e}" for e in range(1, S.epochs + 1))
    out.append(f"""hist AS MATERIALIZED (SELECT CAST(epoch AS INTEGER) AS epoch, split, count(*) AS n, round(avg(CAST(label = pred AS INTEGER)), 6) AS accuracy,
  round(CASE WHEN sum(label + pred) = 0 THEN 0.0 ELSE 2.0 * sum(label * pred) / sum(label + pred) END, 6) AS f1,
  round(CASE WHEN sum(2 - label - pred) = 0 THEN 0.0 ELSE 2.0 * sum((1 - label) * (1 - pred)) / sum(2 - label - pred) END, 6) AS f1_neg,
  round(CAST(sum((label * {E.ONE} - p) * (label * {E.ONE} - p)) AS DOUBLE) / count(*) / {float(E.ONE * E.ONE)}, 6) AS loss
  FROM ({hist}) GROUP BY epoch, split),
best AS (SELECT epoch FROM hist WHERE split = 'validation' ORDER BY accuracy DESC, epoch LIMIT 1)""")
    return "WITH " + ",\n".join(out)


TRAIN = _train_sql()
_PRED = " UNION ALL ".join(f"SELECT {e} AS epoch, * FROM s{e}" for e in range(1, S.epochs + 1))


@register("train_epochs", f"""{TRAIN}
SELECT h.*, h.epoch = b.epoch AS is_best FROM hist h, best b""")
def q_train_epochs(spark, sf_dir):
    """M1: what each epoch reached on either split, and which one is kept."""
    history, _, _ = E.train_epochs(labelled(spark, sf_dir))
    best = E.best_epoch(history).select(F.col("epoch").alias("_best"))
    return history.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("epoch") == F.col("_best")).drop("_best")   # one row


@register("eval_best_epoch", f"""{TRAIN}
SELECT p.epoch, doc_id, split, label, pred, z, p FROM ({_PRED}) p JOIN best b ON p.epoch = b.epoch""")
def q_eval_best_epoch(spark, sf_dir):
    """M2: every labelled document as the kept epoch sees it."""
    lab = labelled(spark, sf_dir)
    history, kept, rows = E.train_epochs(lab)
    best = E.best_epoch(history).first()["epoch"]
    out = E.scores(lab.select("doc_id", "split", "label"), rows, kept[best - 1], S)
    return out.select(F.lit(best).alias("epoch"), "doc_id", "split", "label", "pred", "z", "p")
