"""Structured Streaming versions of scoring, chat rules and bank normalization
(T1-T3).

Each stream uses ``foreachBatch`` so a micro-batch is handled by exactly the
batch operator (same plan, same result), and writes into
``<sink>/batch_id=<n>`` with overwrite: a replayed batch after a failure
replaces its own output, so the sinks are exactly-once. Checkpoints live in
the shared scratch folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions import chat as C
from corvid.operators import bank as B
from corvid.operators import chat as chat_ops
from corvid.operators.score import score_texts
from corvid.sources.bank_csv import (CORRUPT, PROFILES, BankProfile, canonical_columns,
                                     profile_schema)


def stage_files(df: DataFrame, path: str, chunk_col, n_chunks: int,
                order: Sequence[int] | None = None) -> str:
    """Write ``df`` into a drop folder as ``n_chunks`` successive appends (one
    per chunk value), so a file-source stream sees them as separate arrivals,
    in ``order``."""
    for i in (order or range(n_chunks)):
        df.filter(chunk_col == i).write.mode("append").parquet(path)
    return path


def n_files(spark: SparkSession, path: str) -> int:
    return len(spark.read.parquet(path).inputFiles())


def files_each(files: int, batches: int) -> int:
    """Files a micro-batch takes, so that ``files`` are read in at most
    ``batches``: an arrival of many files is one micro-batch, not many."""
    return max(1, -(-files // batches))


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def score_stream(spark: SparkSession, source: str, schema, weights_path: str, sink: str,
                 checkpoint: str, files_per_trigger: int = 1000) -> None:
    """Documents arriving as files under ``source`` (a folder, glob or file)
    -> label and score per document."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
              .parquet(source))

    def each(batch: DataFrame, batch_id: int) -> None:
        w = batch.sparkSession.read.parquet(weights_path)  # bounded model table
        out = score_texts(batch, w, "doc_id").drop("probs")
        out.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    _run(stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())


def bundle_stream(spark: SparkSession, source: str, schema, bundle: str, sink: str, checkpoint: str,
                  files_per_trigger: int = 1000) -> None:
    """T1 with a model that may be swapped: each micro-batch asks for the newest
    complete version once, and every row of it carries that version (``model``).
    A batch that is replayed after a failure replaces its rows as a whole."""
    from corvid.operators.bundle import score_bundle
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)

    def each(batch: DataFrame, batch_id: int) -> None:
        score_bundle(batch, bundle).drop("probs").write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    _run(stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())


QUITS = "conv_id bigint, quit_turn bigint"


def chat_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str,
                files_per_trigger: int = 1000) -> None:
    """Turns arriving in any order and split across micro-batches.

    Two queries on the source. One applies the stateless blank rule and appends
    the turns. The other keeps the state: the first user "quit" of each
    conversation, as a streaming aggregation in Spark's state store; a
    micro-batch writes only the conversations whose state it changed.
    ``chat_state`` reads the current conversations.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    # an empty state to start from, so that reading never depends on arrivals
    spark.createDataFrame([], QUITS).write.mode("ignore").parquet(f"{sink}/quits/batch_id=-1")

    def turns(batch: DataFrame, batch_id: int) -> None:
        chat_ops.drop_blank(batch).write.mode("overwrite").parquet(f"{sink}/turns/batch_id={batch_id}")

    def quits(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/quits/batch_id={batch_id}")

    first = (stream.filter((F.col("role") == "user") & C.is_quit(F.col("text")))
             .groupBy("conv_id").agg(F.min(F.col("turn").cast("bigint")).alias("quit_turn")))
    for frame, each, mode, name in ((stream, turns, "append", "turns"), (first, quits, "update", "quits")):
        _run(frame.writeStream.outputMode(mode).foreachBatch(each)
             .option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start())


def chat_state(spark: SparkSession, sink: str, schema) -> DataFrame:
    """Kept turns of every conversation so far: turns before its first quit."""
    turns = spark.read.schema(schema).parquet(f"{sink}/turns")
    quits = spark.read.schema(QUITS).parquet(f"{sink}/quits").groupBy("conv_id").agg(
        F.min("quit_turn").alias("_q"))
    return (turns.join(quits, "conv_id", "left")
            .filter(F.col("_q").isNull() | (F.col("turn") < F.col("_q"))).drop("_q"))


def bank_stream(spark: SparkSession, root: str, sink: str, checkpoint: str,
                profiles: Sequence[BankProfile] = PROFILES, files_per_trigger: int = 1000) -> None:
    """CSV files dropped per bank folder -> normalized rows, each batch
    normalized and written once; ``valid=true`` and ``valid=false`` folders
    separate valid and rejected rows."""
    streams = None
    for p in profiles:
        raw = (spark.readStream.schema(profile_schema(p))
               .option("sep", p.sep).option("encoding", p.encoding).option("columnNameOfCorruptRecord", CORRUPT)
               .option("header", str(p.header).lower()).option("maxFilesPerTrigger", files_per_trigger)
               .csv(f"{root}/bank={p.bank}"))
        df = raw.select(*canonical_columns(p))
        streams = df if streams is None else streams.unionByName(df)

    def each(batch: DataFrame, batch_id: int) -> None:
        norm = B.normalize_transactions(batch.sparkSession, batch)
        (norm.withColumn("valid", F.col("reason").isNull()).write.mode("overwrite")
         .partitionBy("valid").parquet(f"{sink}/batch_id={batch_id}"))

    _run(streams.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
