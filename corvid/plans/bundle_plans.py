"""A versioned model bundle and its swap under a running stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators.bundle import save_bundle
from corvid.operators.score import train_weights
from corvid.plans import register
from corvid.plans.common import LAB_CTE, MODEL_K, PRED_COLS, labelled, model_cte, score_cte
from corvid.session import fresh_dir
from corvid.sources.tables import load_table, split_filter
from corvid.streaming import streams as S

SECOND_K = 1000


@register("bundle_stream", f"""WITH {LAB_CTE},
{model_cte(MODEL_K, '1')},
{model_cte(SECOND_K, '2')},
d1 AS (SELECT * FROM documents WHERE doc_id % 2 = 0), d2 AS (SELECT * FROM documents WHERE doc_id % 2 = 1),
{score_cte('d1', 'doc_id', s='1')},
{score_cte('d2', 'doc_id', s='2')}
SELECT doc_id, {PRED_COLS}, CAST(1 AS BIGINT) AS model FROM sm1
UNION ALL SELECT doc_id, {PRED_COLS}, CAST(2 AS BIGINT) FROM sm2""")
def q_bundle_stream(spark, sf_dir):
    """Half of the documents arrive before a new version is saved, half after:
    each is scored by exactly the version of its time."""
    base = fresh_dir(spark, "bundle")
    train = split_filter(labelled(spark, sf_dir), "train")
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "text")
    for part, k in enumerate((MODEL_K, SECOND_K)):
        save_bundle(train_weights(spark, train, k=k), f"{base}/model")
        docs.filter(F.pmod(F.col("doc_id"), F.lit(2)) == part).write.mode("append").parquet(f"{base}/in")
        S.bundle_stream(spark, f"{base}/in", docs.schema, f"{base}/model", f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out").drop("batch_id")
