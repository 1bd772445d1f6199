"""Streams compared with their batch results (step 7): same oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions import chat as C
from corvid.plans import ORACLE, register
from corvid.plans.chat_plans import BOS_LEN, GEN_LEN, STRIP_SQL, fp_sql
from corvid.plans.common import model
from corvid.session import fresh_dir
from corvid.sources.tables import load_table
from corvid.streaming import prompts as P
from corvid.streaming import streams as S

N_CHUNKS = 4


@register("stream_score")
def q_stream_score(spark, sf_dir):
    base = fresh_dir(spark, "stream-score")
    model(spark, sf_dir).write.parquet(f"{base}/model")  # S5: the bounded model table
    # the table's own files are the arrivals: nothing is copied
    schema = load_table(spark, sf_dir, "documents").select("doc_id", "text").schema
    # (as a pattern: a file source takes one file only so)
    S.score_stream(spark, f"{sf_dir.rstrip('/')}/documents.parque[t]", schema, f"{base}/model",
                   f"{base}/out", f"{base}/ckpt", files_per_trigger=N_CHUNKS)
    return spark.read.parquet(f"{base}/out").drop("batch_id")


def chat_arrivals(spark, sf_dir, order):
    """The kept turns after the stream has seen the chunks in ``order``."""
    from corvid.plans.chat_plans import conversations, terminal_inputs
    inputs = terminal_inputs(conversations(spark, sf_dir))
    base = fresh_dir(spark, "stream-chat")
    chunk = F.pmod(F.col("turn"), F.lit(N_CHUNKS))
    src = S.stage_files(inputs, f"{base}/in", chunk, N_CHUNKS, order=order)
    S.chat_stream(spark, src, inputs.schema, f"{base}/out", f"{base}/ckpt",
                  files_per_trigger=S.files_each(S.n_files(spark, src), len(order)))
    return S.chat_state(spark, f"{base}/out", inputs.schema).select("conv_id", "turn", "role", "text")


@register("stream_chat")
def q_stream_chat(spark, sf_dir):
    # Adversarial arrival: later turns first, a conversation over several batches.
    return chat_arrivals(spark, sf_dir, [3, 1, 2, 0])


def prompt_inputs(turns):
    """``turns`` and, for every third conversation, what a person types at its
    end: a blank line, "quit", and a turn that comes too late."""
    last = turns.filter(F.pmod("conv_id", F.lit(3)) == 0).groupBy("conv_id").agg(F.max("turn").alias("last"))
    typed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(t).alias("t"))
                      for i, t in enumerate(["  ", " Quit ", "one more question"], 1)])
    tail = last.select("conv_id", "last", F.explode(typed).alias("x")).select(
        "conv_id", (F.col("last") + F.col("x.i")).cast("int").alias("turn"), F.lit("user").alias("role"),
        F.col("x.t").alias("text"))
    return turns.select("conv_id", F.col("turn").cast("int").alias("turn"), "role", "text").unionByName(tail)


def prompt_arrivals(spark, turns, orders):
    """The prompts emitted after the chunks have come in ``orders``, one run of
    the stream (same checkpoint) for each order; a chunk may come again."""
    base = fresh_dir(spark, "stream-prompts")
    chunk = F.pmod(F.col("turn"), F.lit(N_CHUNKS))
    seen = 0
    for order in orders:
        S.stage_files(turns, f"{base}/in", chunk, N_CHUNKS, order=order)
        files = S.n_files(spark, f"{base}/in")
        P.prompt_stream(spark, f"{base}/in", turns.schema, f"{base}/out", f"{base}/ckpt",
                        files_per_trigger=S.files_each(files - seen, len(order)))
        seen = files
    return P.emitted(spark, f"{base}/out")


@register("stream_prompts", f"""WITH s AS (
  SELECT conv_id, turn, role, '{C.HEADER_START}' || role || '{C.HEADER_END}' || chr(10) ||
         CASE WHEN role = 'user' THEN {STRIP_SQL.format()} ELSE text END || '{C.EOT}' AS segment
  FROM conversations),
r AS (SELECT conv_id, turn, role, sum(length(segment)) OVER w AS c,
             sum({fp_sql("CAST(turn AS VARCHAR) || '|' || segment")}) OVER w AS f
      FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn,
       CAST(c + {BOS_LEN + GEN_LEN} AS BIGINT) AS prompt_chars, CAST(f AS BIGINT) AS prompt_fp
FROM r WHERE role = 'user'""")
def q_stream_prompts(spark, sf_dir):
    # later turns first, over several micro-batches; early ones are held
    turns = prompt_inputs(load_table(spark, sf_dir, "conversations"))
    return prompt_arrivals(spark, turns, [[3, 1], [2, 0]])


@register("stream_bank")
def q_stream_bank(spark, sf_dir):
    from corvid.plans.bank_plans import bank_files
    root = bank_files(spark, sf_dir)
    base = fresh_dir(spark, "stream-bank")
    S.bank_stream(spark, root, f"{base}/out", f"{base}/ckpt", files_per_trigger=N_CHUNKS)
    return spark.read.parquet(f"{base}/out").drop(
        "batch_id", "valid", "file", "id_raw", "date_raw", "amount_raw")


def _attach_oracles():
    from corvid.plans import bank_plans, chat_plans, score_plans  # noqa: F401
    ORACLE["stream_score"] = ORACLE["score_texts"]
    ORACLE["stream_chat"] = ORACLE["chat_stop"]
    ORACLE["stream_bank"] = ORACLE["bank_normalize"]


_attach_oracles()
