"""Labelled data, the weight-table model, scoring and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.text import tokenize_words
from corvid.operators import metrics
from corvid.operators.batches import assign_batches
from corvid.operators.score import score_texts
from corvid.operators.serve import (BAD_JSON, NO_TEXT, parse_requests, score_requests,
                                    score_singles, to_responses)
from corvid.plans import register
from corvid.plans.common import (BATCH, LAB_CTE, MODEL_CTE, PRED_COLS, labelled, model,
                                 model_cte, score_cte)
from corvid.sources.tables import load_table, split_counts

# ---- S1 / S8 / A11 -----------------------------------------------------------


@register("labelled_split", f"""WITH {LAB_CTE}
SELECT doc_id, text, label, split FROM lab""")
def q_labelled_split(spark, sf_dir):
    return labelled(spark, sf_dir)


@register("split_counts", f"""WITH {LAB_CTE}
SELECT split, count(*) AS n_rows FROM lab GROUP BY split""")
def q_split_counts(spark, sf_dir):
    return split_counts(labelled(spark, sf_dir))


@register("class_balance", f"""WITH {LAB_CTE},
c AS (SELECT split, label, count(*) AS n FROM lab GROUP BY split, label)
SELECT split, label, n, round(n / sum(n) OVER (PARTITION BY split), 6) AS share FROM c""")
def q_class_balance(spark, sf_dir):
    return metrics.class_balance(labelled(spark, sf_dir), "label", ["split"])


# ---- M1 (SQL form) / M4 -------------------------------------------------------


@register("model_weights", f"""WITH {MODEL_CTE}
SELECT token, w0, w1 FROM w""")
def q_model_weights(spark, sf_dir):
    return model(spark, sf_dir)


@register("score_texts", f"""WITH {MODEL_CTE},
{score_cte('documents', 'doc_id')}
SELECT doc_id, {PRED_COLS} FROM sm""")
def q_score_texts(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    return score_texts(docs, model(spark, sf_dir), "doc_id").drop("probs")


# ---- J2 / A1 / A2 ---------------------------------------------------------------

_EVAL_SQL = f"""WITH {MODEL_CTE},
{score_cte('lab', 'doc_id')},
j AS (SELECT lab.split, lab.label, CASE WHEN p1 > p0 THEN 1 ELSE 0 END AS pred
      FROM sm JOIN lab USING (doc_id)),
c AS (SELECT split, count(*) AS n,
             sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END)::DOUBLE AS tp,
             sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END)::DOUBLE AS fp,
             sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END)::DOUBLE AS fn,
             sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END)::DOUBLE AS tn
      FROM j GROUP BY split)
SELECT split, n, round((tp + tn) / n, 6) AS accuracy,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
       round(CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END, 6) AS f1_neg
FROM c"""


def scored_labelled(spark, sf_dir, k=None):
    lab = labelled(spark, sf_dir).withColumnRenamed("label", "truth")
    w = model(spark, sf_dir) if k is None else model(spark, sf_dir, k)
    # The truth (a function of doc_id) rides along as a grouping key of
    # the per-document sum, so predictions need no second scan and no join.
    return score_texts(lab, w, ["doc_id", "truth", "split"])


@register("eval_binary", _EVAL_SQL)
def q_eval_binary(spark, sf_dir):
    return metrics.binary_metrics(scored_labelled(spark, sf_dir), "truth", "pred", ["split"])


# ---- A5 / X3 ----------------------------------------------------------------------

@register("cross_entropy", f"""WITH {MODEL_CTE},
{score_cte('lab', 'doc_id')},
b AS (SELECT lab.split, lab.label, p0, p1,
             (row_number() OVER (PARTITION BY lab.split ORDER BY lab.doc_id) - 1) // {BATCH} AS batch_id
      FROM sm JOIN lab USING (doc_id)),
l AS (SELECT split, batch_id, -ln(CASE WHEN label = 0 THEN p0 ELSE p1 END) AS nll FROM b)
SELECT split, CAST(batch_id AS BIGINT) AS batch_id, count(*) AS n, round(avg(nll), 6) AS loss
FROM l GROUP BY split, batch_id
UNION ALL
SELECT split, CAST(-1 AS BIGINT), count(*), round(avg(nll), 6) FROM l GROUP BY split""")
def q_cross_entropy(spark, sf_dir):
    # ids are numbered alone, and the batch rides along as a grouping key: texts
    # are scored once and nothing is numbered after scoring
    lab = labelled(spark, sf_dir).withColumnRenamed("label", "truth")
    batches = assign_batches(lab.select("doc_id", "split"), ["split"], "doc_id", BATCH)
    scored = score_texts(lab.join(batches.select("doc_id", "batch_id"), "doc_id"), model(spark, sf_dir),
                         ["doc_id", "truth", "split", "batch_id"])
    # one pass: every row counts for its batch and for the split total (-1)
    both = scored.withColumn("batch_id", F.explode(F.array(F.col("batch_id"),
                                                            F.lit(-1).cast("bigint"))))
    return metrics.mean_cross_entropy(both, "probs", "truth", ["split", "batch_id"])


# ---- A8: best candidate on validation accuracy --------------------------------------

CANDIDATE_K = [250, 500, 1000, 2000]


def _best_sql() -> str:
    parts = [LAB_CTE]
    sel = []
    for i, k in enumerate(CANDIDATE_K, start=1):
        s = f"_{i}"
        parts.append(model_cte(k, s))
        parts.append(score_cte("lab", "doc_id", s=s))
        sel.append(f"""SELECT {i} AS epoch, avg(CASE WHEN (CASE WHEN p1 > p0 THEN 1 ELSE 0 END) = lab.label
                       THEN 1.0 ELSE 0.0 END) AS acc
FROM sm{s} JOIN lab USING (doc_id) WHERE lab.split = 'validation'""")
    hist = "\nUNION ALL\n".join(sel)
    return ("WITH " + ",\n".join(parts) + f""",
hist AS ({hist})
SELECT CAST(arg_max(epoch, (round(acc, 6), -epoch)) AS INTEGER) AS epoch,
       max(round(acc, 6)) AS eval_accuracy, count(*) AS n_candidates FROM hist""")


@register("best_epoch", _best_sql())
def q_best_epoch(spark, sf_dir):
    hist = None
    for i, k in enumerate(CANDIDATE_K, start=1):
        s = scored_labelled(spark, sf_dir, k).filter(F.col("split") == "validation")
        h = s.agg(F.round(F.avg((F.col("pred") == F.col("truth")).cast("double")), 6)
                  .alias("eval_accuracy")).withColumn("epoch", F.lit(i))
        hist = h if hist is None else hist.unionByName(h)
    best = metrics.best_by(hist, "epoch", "eval_accuracy")
    return best.select(
        F.col("epoch").cast("int").alias("epoch"), "eval_accuracy",
        F.lit(len(CANDIDATE_K)).cast("bigint").alias("n_candidates"))


# ---- P6 / J1: batch requests -------------------------------------------------------

REQUEST_SIZE = 8
# Requests and texts that cannot be served: extra ones, beside the real documents
# of these ids.
NULL_TEXT = (13, 4)
BROKEN = (17, 5)       # body cut off
NO_FIELD = (19, 6)     # body without a text
NULL_BODY = (23, 7)


def _hit(rule, col="doc_id"):
    return f"{col} % {rule[0]} = {rule[1]}"


def _rule(rule):
    return F.pmod(F.col("doc_id"), F.lit(rule[0])) == rule[1]


@register("score_batch", f"""WITH {MODEL_CTE},
texts AS (SELECT doc_id, 0 AS k, text FROM documents
          UNION ALL SELECT doc_id, 1, NULL FROM documents WHERE {_hit(NULL_TEXT)}),
req AS (SELECT doc_id // {REQUEST_SIZE} AS request_id, doc_id, text,
               row_number() OVER (PARTITION BY doc_id // {REQUEST_SIZE} ORDER BY doc_id, k) - 1 AS pos
        FROM texts),
served AS (SELECT * FROM req WHERE text IS NOT NULL),
{score_cte('served', 'request_id, pos')}
SELECT CAST(request_id AS BIGINT) AS request_id, count(*) AS n_texts,
       count(*) FILTER (WHERE req.text IS NULL) AS n_errors,
       md5(string_agg(CASE WHEN req.text IS NULL THEN '{NO_TEXT}' ELSE req.text || '|' ||
                      (CASE WHEN p1 > p0 THEN 'Positive' ELSE 'Negative' END) || '|' ||
                      printf('%.4f', round(greatest(p0, p1), 4)) END, chr(10) ORDER BY req.pos)) AS digest
FROM req LEFT JOIN sm USING (request_id, pos) GROUP BY request_id""")
def q_score_batch(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    extra = docs.filter(_rule(NULL_TEXT)).select("doc_id", F.lit(1).alias("k"), F.lit(None).cast("string").alias("text"))
    docs = docs.select("doc_id", F.lit(0).alias("k"), "text").unionAll(extra)
    # Requests of at most REQUEST_SIZE documents, built from the table (bounded groups).
    requests = (docs.groupBy(F.floor(F.col("doc_id") / REQUEST_SIZE).cast("bigint").alias("request_id"))
                .agg(F.array_sort(F.collect_list(F.struct("doc_id", "k", "text"))).alias("items"))
                .select("request_id", F.transform("items", lambda x: x["text"]).alias("texts")))
    out = score_requests(requests, model(spark, sf_dir), "request_id", "texts")
    line = F.transform("predictions", lambda p: F.coalesce(p["error"], F.concat_ws(
        "|", p["text"], p["label"], F.format_string("%.4f", p["score"]))))
    return out.select("request_id", F.size("predictions").cast("bigint").alias("n_texts"),
                      F.size(F.filter("predictions", lambda p: p["error"].isNotNull())).cast("bigint").alias("n_errors"),
                      F.md5(F.array_join(line, "\n")).alias("digest"))


# ---- S7: JSON request in, JSON response out -----------------------------------------

@register("request_json", f"""WITH {MODEL_CTE},
{score_cte('documents', 'doc_id')}
SELECT doc_id, CAST(to_json({{'text': d.text,
                       'label': CASE WHEN p1 > p0 THEN 'Positive' ELSE 'Negative' END,
                       'score': round(greatest(p0, p1), 4)}}) AS VARCHAR) AS response
FROM sm JOIN documents d USING (doc_id)
UNION ALL SELECT -1 - doc_id, '{{"error":"{BAD_JSON}"}}' FROM documents WHERE {_hit(NULL_BODY)}
UNION ALL SELECT -1 - doc_id, '{{"error":"{BAD_JSON}"}}' FROM documents WHERE {_hit(BROKEN)}
UNION ALL SELECT -1 - doc_id, '{{"error":"{NO_TEXT}"}}' FROM documents WHERE {_hit(NO_FIELD)}""")
def q_request_json(spark, sf_dir):
    docs = load_table(spark, sf_dir, "documents")
    bodies = docs.select("doc_id", F.to_json(F.struct("text")).alias("body"))
    for rule, body in ((NULL_BODY, None), (BROKEN, '{"text": "cut'), (NO_FIELD, '{"other": 1}')):
        bodies = bodies.unionAll(docs.filter(_rule(rule)).select(-1 - F.col("doc_id"), F.lit(body).cast("string")))
    reqs = parse_requests(bodies, "body")
    return to_responses(score_singles(reqs, model(spark, sf_dir), "doc_id"), "doc_id")
