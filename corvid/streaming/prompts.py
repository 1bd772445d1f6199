"""T2 with keyed state: context prompts of conversations whose turns arrive in
any order.

A conversation's state is its next turn number, the length and fingerprint of
the rendering so far, and whether it is closed. A turn that comes before its
predecessors is held as four numbers until the gap in front of it is filled;
texts are digested before the shuffle and never enter the state, which is five
values for a conversation that arrives in order.

Rules: turns are numbered from 0 without gaps; a blank user turn takes its
number and adds nothing; the first user "quit" closes the conversation, turns
after it are dropped, whenever they arrive. A turn that comes again (a source
file delivered twice) is dropped. Prompts behind a turn that never comes are
not emitted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from corvid.functions import chat as C
from corvid.functions.text import fingerprint, is_blank, py_strip
from corvid.streaming.streams import _run

#: What a turn does to its conversation.
PLAIN, ASK, BLANK, QUIT = 0, 1, 2, 3
STATE = "closed boolean, next bigint, chars bigint, fp bigint, early array<bigint>"
PROMPTS = "conv_id bigint, turn bigint, prompt_chars bigint, prompt_fp bigint"


def turn_digests(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, kind, seg_len, seg_fp)``: what the state needs of a turn."""
    user = F.coalesce(F.col("role") == "user", F.lit(False))
    text: Column = F.when(user, py_strip(F.col("text"))).otherwise(F.col("text"))
    segment = C.render_segment(F.col("role"), text)
    kind = (F.when(user & is_blank(F.col("text")), BLANK)
            .when(user & F.coalesce(C.is_quit(F.col("text")), F.lit(False)), QUIT)
            .when(user, ASK).otherwise(PLAIN))
    turn = F.col("turn").cast("bigint")
    return turns.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), turn.alias("turn"), kind.cast("bigint").alias("kind"),
        F.coalesce(F.length(segment), F.lit(0)).cast("bigint").alias("seg_len"),
        fingerprint(F.concat_ws("|", turn.cast("string"), segment)).cast("bigint").alias("seg_fp"))


def _advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Take the new turns of one conversation; emit the prompts they complete."""
    closed, nxt, chars, fp, early = state.get if state.exists else (False, 0, 0, 0, [])
    held = {early[i]: tuple(early[i + 1:i + 4]) for i in range(0, len(early), 4)}
    added = len(C.BOS) + len(C.HEADER_START) + len("assistant") + len(C.HEADER_END) + 1
    for batch in batches:
        out = []
        for turn, *digest in zip(*(batch[c].tolist() for c in ("turn", "kind", "seg_len", "seg_fp"))):
            if not closed and turn >= nxt:
                held.setdefault(turn, tuple(digest))
        while not closed and nxt in held:
            kind, seg_len, seg_fp = held.pop(nxt)
            if kind == QUIT:
                closed = True
                held.clear()
            elif kind != BLANK:
                chars, fp = chars + seg_len, fp + seg_fp
                if kind == ASK:
                    out.append((key[0], nxt, chars + added, fp))
            nxt += 1
        if out:
            yield pd.DataFrame(np.array(out, "int64"), columns=["conv_id", "turn", "prompt_chars", "prompt_fp"])
    state.update((closed, nxt, chars, fp, [x for t in sorted(held) for x in (t, *held[t])]))


def prompt_stream(spark: SparkSession, source: str, schema, sink: str, checkpoint: str,
                  files_per_trigger: int = 1000) -> None:
    """Turns arriving as files under ``source`` -> one row for each prompt, as
    soon as all turns before it are there. Batches are written by number with
    overwrite, so a batch replayed after a failure replaces its own rows."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    prompts = turn_digests(stream).groupBy("conv_id").applyInPandasWithState(
        _advance, PROMPTS, STATE, "append", GroupStateTimeout.NoTimeout)

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    _run(prompts.writeStream.outputMode("append").foreachBatch(each)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def emitted(spark: SparkSession, sink: str) -> DataFrame:
    """The prompts written so far."""
    return spark.read.schema(PROMPTS).parquet(sink).drop("batch_id")
