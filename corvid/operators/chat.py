"""Conversation tables: collection, rendering, context, stop rules, masks.

Input is the long table ``(conv_id, turn, role, text)``. Per-conversation
results use distributive aggregates or the block prefix sum of
``corvid.operators.prefix``, so a conversation holding a large share of all
turns is still processed by many tasks. ``collect_conversation`` gives the
message array of conversations up to a stated number of turns; longer ones stay
in long form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions import chat as C
from corvid.functions.text import fingerprint, is_blank, py_strip, tokenize_words
from corvid.operators.prefix import row_number, running_sum
from corvid.operators.vocab import encode_ids
from corvid.operators.wordpiece import whole_rows
from corvid.session import stored

KEYS = ["conv_id"]
#: Counted pairs that a task ranks at once, and their bytes.
FOLLOWERS, FOLLOWER_BYTES = 1 << 20, 1 << 26


def collect_conversation(turns: DataFrame, max_turns: int) -> DataFrame:
    """``(conv_id, part, messages array<struct<turn,role,text>>)`` in turn
    order: the message array, in parts of ``max_turns`` turn numbers, so that a
    row is bounded and no turn is left out. A usual conversation is part 0."""
    return turns.groupBy("conv_id", F.floor(F.col("turn") / max_turns).cast("bigint").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))


def message_fp(turns: DataFrame) -> DataFrame:
    return turns.withColumn("msg_fp", fingerprint(F.concat_ws(
        "|", F.col("turn").cast("string"), F.col("role"), F.col("text"))))


def conversation_summary(turns: DataFrame) -> DataFrame:
    """A7 digest: counts, roles and an order-aware fingerprint, by aggregation only."""
    t = message_fp(turns)
    return t.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"),
        F.sum((F.col("role") == "user").cast("int")).cast("bigint").alias("n_user"),
        F.sum((F.col("role") == "assistant").cast("int")).cast("bigint").alias("n_assistant"),
        F.sum((F.col("role") == "system").cast("int")).cast("bigint").alias("n_system"),
        F.sum(F.length("text")).cast("bigint").alias("total_chars"),
        F.sum("msg_fp").cast("bigint").alias("conv_fp"))


def render_segments(turns: DataFrame, template: C.Template = C.TEMPLATE,
                    ask: bool = False) -> DataFrame:
    """X9 in long form: each turn's rendered piece and its character offset in
    the whole rendering (the template's ``bos`` first). Concatenating
    ``segment`` in turn order gives the conversation text. With ``ask`` each
    conversation ends with the open assistant header, as a turn of its own."""
    seg = turns.select("conv_id", "turn", "role",
                       C.render_segment(F.col("role"), F.col("text"), template).alias("segment"))
    if ask:
        seg = seg.unionByName(turns.groupBy("conv_id").agg(F.max("turn").alias("_last")).select(
            "conv_id", (F.col("_last") + 1).alias("turn"), F.lit("assistant").alias("role"),
            C.generation_prompt(template).alias("segment")))
    seg = seg.withColumn("seg_len", F.length("segment").cast("bigint"))
    out = running_sum(seg, KEYS, "turn", {"_before": F.col("seg_len")}, inclusive=False)
    return out.withColumn("seg_start", (F.col("_before") + F.lit(len(template.bos))).cast("bigint")) \
              .drop("_before")


def context_prompts(turns: DataFrame) -> DataFrame:
    """For every user turn, the prompt = all turns so far + generation header.

    Emitted as ``prompt_chars`` (its length) and ``prompt_fp`` (sum of the
    segment fingerprints it contains): a prompt is the prefix
    ``[0, prompt_chars - len(gen))`` of the rendering plus the header, so it is
    never copied per turn (that would grow with the square of the length).
    """
    seg = turns.withColumn("segment", C.render_segment(F.col("role"), F.col("text")))
    seg = seg.withColumn("seg_len", F.length("segment").cast("bigint")) \
             .withColumn("seg_fp", fingerprint(F.concat_ws("|", F.col("turn").cast("string"),
                                                           F.col("segment"))))
    run = running_sum(seg, KEYS, "turn", {"_chars": F.col("seg_len"), "_fp": F.col("seg_fp")})
    gen_len = len(C.HEADER_START) + len("assistant") + len(C.HEADER_END) + 1
    return run.filter(F.col("role") == "user").select(
        "conv_id", "turn",
        (F.col("_chars") + F.lit(len(C.BOS) + gen_len)).cast("bigint").alias("prompt_chars"),
        F.col("_fp").cast("bigint").alias("prompt_fp"))


def drop_blank(turns: DataFrame) -> DataFrame:
    """user input is stripped; blank input is skipped."""
    user = F.col("role") == "user"
    return (turns.filter(~(user & is_blank(F.col("text"))))
            .withColumn("text", F.when(user, py_strip(F.col("text"))).otherwise(F.col("text"))))


def stop_at_quit(turns: DataFrame) -> DataFrame:
    """From the first user "quit" on, nothing is kept ("quit" included).

    The first quit turn per conversation is an aggregate (partial aggregation
    handles hot conversations); the cut is an equi-join plus a filter.
    """
    quit_turn = F.when((F.col("role") == "user") & C.is_quit(F.col("text")), F.col("turn"))
    first = turns.groupBy("conv_id").agg(F.min(quit_turn).alias("_quit"))
    return (turns.join(first, "conv_id", "left")
            .filter(F.col("_quit").isNull() | (F.col("turn") < F.col("_quit")))
            .drop("_quit"))


def chat_rules(turns: DataFrame) -> DataFrame:
    """The interactive loop's rules on a whole table: skip blanks, stop at quit."""
    return stop_at_quit(drop_blank(turns))


def segment_token_counts(turns: DataFrame) -> DataFrame:
    """Tokens per message and where each message starts in the token sequence
    (position 0 is BOS)."""
    t = turns.withColumn("n_seg_tokens", F.size(C.segment_tokens(F.col("role"), F.col("text")))
                         .cast("bigint"))
    run = running_sum(t, KEYS, "turn", {"_before": F.col("n_seg_tokens")}, inclusive=False)
    return run.withColumn("tok_start", F.col("_before") + F.lit(1)).drop("_before")


HEADER_TOKENS = 3


def token_rows(turns: DataFrame) -> DataFrame:
    """X10 in long form: ``(conv_id, pos, turn, token, mask)`` of the whole token
    sequence. ``mask`` is 1 for what is trained on: assistant content and end
    tags; headers, other roles and the BOS at position 0 (turn NULL) are 0.
    Nothing is collected, so a conversation of any length is many rows."""
    t = segment_token_counts(turns)
    seg = t.select("conv_id", "turn", "role", "tok_start", F.posexplode(
        C.segment_tokens(F.col("role"), F.col("text"))).alias("i", "token"))
    trained = (F.col("role") == "assistant") & (F.col("i") >= HEADER_TOKENS)
    rows = seg.select("conv_id", (F.col("tok_start") + F.col("i")).cast("bigint").alias("pos"), "turn", "token",
                      trained.cast("int").alias("mask"))
    bos = turns.select("conv_id").distinct().select(
        "conv_id", F.lit(0).cast("bigint").alias("pos"),
        F.lit(None).cast(dict(turns.dtypes)["turn"]).alias("turn"), F.lit(C.BOS).alias("token"), F.lit(0).alias("mask"))
    return rows.unionByName(bos)


def all_tokens(turns: DataFrame) -> DataFrame:
    """The tokens of ``token_rows`` alone, for counting: no places, no running sums."""
    bos = turns.select("conv_id").distinct().select(F.lit(C.BOS).alias("token"))
    return turns.select(F.explode(C.segment_tokens(F.col("role"), F.col("text"))).alias("token")).unionByName(bos)


def pad_batches(rows: DataFrame, vocab: DataFrame, max_len: int, size: int, accumulate: int) -> DataFrame:
    """``token_rows`` -> sequences of at most ``max_len`` ids, in micro-batches
    of ``size`` padded on the right to the widest of the batch. Conversations are
    numbered by id and length alone: no sequence goes through that window. The
    sequences are stored once, for the numbering and for the result.

    ``input_ids`` (padded with the end tag's id), ``attention_mask``, ``labels``
    (the id where trained on, else -100), and the optimizer ``step_id``. Only the
    first ``max_len`` positions of a conversation meet in one row.
    """
    pad = vocab.filter(F.col("token") == (C.PAD_TOKEN or C.EOS_TOKEN)).select(F.col("token_id").alias("_pad"))
    ids = encode_ids(rows.filter(F.col("pos") < max_len), vocab)
    seqs = ids.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "token_id", "mask"))).alias("_s"))
    seqs = stored(seqs.withColumn("_n", F.size("_s").cast("bigint")), "sequences")
    lengths = seqs.select("conv_id", F.col("_n").alias("seq_len"))
    numbered = row_number(lengths, [], "conv_id", "_rn").withColumn(
        "micro_batch", F.floor((F.col("_rn") - 1) / size).cast("bigint"))
    widest = numbered.groupBy("micro_batch").agg(F.max("seq_len").alias("padded_len"))
    places = numbered.join(widest, "micro_batch").withColumnRenamed("conv_id", "_conv")
    n_pad = (F.col("padded_len") - F.col("seq_len")).cast("int")
    wide = (seqs.join(places, F.col("conv_id").eqNullSafe(F.col("_conv")))
            .crossJoin(F.broadcast(pad)))                                        # one row
    return wide.select(
        "conv_id", "micro_batch", "seq_len", "padded_len", n_pad.cast("bigint").alias("n_pad"),
        F.floor(F.col("micro_batch") / accumulate).cast("bigint").alias("step_id"),
        F.concat(F.transform("_s", lambda x: x["token_id"]), F.array_repeat(F.col("_pad"), n_pad)).alias("input_ids"),
        F.concat(F.transform("_s", lambda x: F.lit(1)), F.array_repeat(F.lit(0), n_pad)).alias("attention_mask"),
        F.concat(F.transform("_s", lambda x: F.when(x["mask"] == 1, x["token_id"]).otherwise(F.lit(-100))),
                 F.array_repeat(F.lit(-100), n_pad)).alias("labels"))


def next_token_pairs(df: DataFrame, id_col: str, tokens_col: str) -> DataFrame:
    """``(id, pos, token, next_token)`` for every position that has a
    successor, built inside each row (no window, no shuffle)."""
    t = F.col(tokens_col)
    heads = F.slice(t, 1, F.greatest(F.size(t) - F.lit(1), F.lit(0)))
    tails = F.slice(t, 2, F.greatest(F.size(t) - F.lit(1), F.lit(0)))
    pairs = F.arrays_zip(heads.alias("token"), tails.alias("next_token"))
    return (df.select(id_col, F.posexplode(pairs).alias("pos", "p"))
            .select(id_col, "pos", "p.token", "p.next_token"))


def _best_followers(k: int) -> Callable:
    """(token, next_token, cnt) -> the best ``k`` followers of each token among
    ``FOLLOWERS`` rows at a time; the first of them carries the sum of them all."""

    def best(part: pa.Table) -> pa.RecordBatch:
        token, follower = (part.column(i).combine_chunks().dictionary_encode() for i in (0, 1))
        place = np.empty(len(follower.dictionary), np.int64)
        place[pc.sort_indices(follower.dictionary).to_numpy()] = np.arange(len(place))
        code, at = (c.indices.fill_null(-1).to_numpy() for c in (token, follower))
        place = np.append(place, -1)[at]                            # nulls first
        cnt = part.column(2).to_numpy()
        order = np.lexsort((place, -cnt, code))
        first = np.flatnonzero(np.diff(code[order], prepend=-2))    # where a token's rows begin
        within = np.arange(len(order)) - np.repeat(first, np.diff(first, append=len(order)))
        total = np.zeros(len(order), np.int64)
        total[first] = np.add.reduceat(cnt[order], first)
        kept = pa.array(order[within < k])
        return pa.RecordBatch.from_arrays(
            [part.column(i).take(kept).combine_chunks() for i in range(3)] + [pa.array(total[within < k])],
            names=["token", "next_token", "cnt", "_sum"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = size = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= FOLLOWERS or size >= FOLLOWER_BYTES:
                yield best(pa.Table.from_batches(held))
                held, rows, size = [], 0, 0
        if held:
            yield best(pa.Table.from_batches(held))
    return run


def next_token_topk(pairs: DataFrame, k: int) -> DataFrame:
    """K2: followers of each token with their share, best ``k`` kept (ties by
    token).

    Pairs are counted once, before anything else moves, and their counts are
    read once: a task reduces them to the best ``k`` rows of each token and the
    token's sum, unsorted. Only those rows meet by token (a token with very many
    followers sends at most ``k`` rows per part), for its total and its ranks.
    """
    from pyspark.sql import Window
    counts = pairs.filter(F.col("token").isNotNull()).groupBy("token", "next_token").agg(F.count(F.lit(1)).alias("cnt"))
    types = dict(counts.dtypes)
    best = counts.mapInArrow(_best_followers(k), f"token {types['token']}, next_token {types['next_token']}, "
                                                 "cnt bigint, _sum bigint")
    by_token = Window.partitionBy("token")
    ranked = best.withColumn("_total", F.sum("_sum").over(by_token)).withColumn(
        "rank", F.row_number().over(by_token.orderBy(F.desc("cnt"), F.asc("next_token"))))
    return ranked.filter(F.col("rank") <= k).select(
        "token", "next_token", "cnt", F.round(F.col("cnt") / F.col("_total"), 6).alias("share"), "rank")


def row_contexts(rows: DataFrame, id_col: str, tokens_col: str, pos_col: str, token_col: str) -> DataFrame:
    """``causal_context`` of texts that each stand whole in one row: the sums run
    along the row's own array where it is read, and no token is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, ends in whole_rows(batch, 1):
                tokens = part.column(1).flatten()
                n = np.diff(ends)
                pos = np.arange(len(tokens)) - np.repeat(ends[:-1], n)
                fps = np.fromiter((int.from_bytes(md5(f"{i}|{t}".encode()).digest()[:4], "big")
                                   for i, t in zip(pos.tolist(), tokens.to_pylist())), np.int64, len(tokens))
                before = np.cumsum(fps) - fps
                before -= np.repeat(before[ends[:-1][n > 0]], n[n > 0])
                left = pc.take(tokens, pa.array(np.arange(len(tokens)) - 1, mask=pos == 0))
                yield pa.RecordBatch.from_arrays(
                    [pc.take(part.column(0), pa.array(np.repeat(np.arange(len(n)), n))), pa.array(pos, pa.int32()),
                     tokens, pa.array(pos, pa.int64()), left, pa.array(before, pa.int64())],
                    names=[id_col, pos_col, token_col, "n_context", "prev_token", "context_fp"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, tokens_col).mapInArrow(
        run, f"`{id_col}` {kind}, `{pos_col}` int, `{token_col}` string, n_context bigint, prev_token string, context_fp bigint")


def causal_context(tokens: DataFrame, id_col: str, pos_col: str = "pos",
                   token_col: str = "token", tokens_col: str | None = None) -> DataFrame:
    """What each position may attend to: the tokens strictly to its left.

    Returned as the context size, the previous token and a fingerprint of the
    context (an exclusive running sum over the block prefix operator, so even
    one huge document is spread over many tasks); ``context_tokens`` gives the
    tokens themselves as a slice of the row's own array when they are wanted.
    When ``tokens`` already has ``prev_token`` (built inside each row) no window
    is used for it.

    ``tokens_col``: ``tokens`` has a row a text, with its tokens as an array. An id
    with one row is worked on inside that row; ids with several rows are one
    sequence of all their rows' tokens and go the long way.
    """
    if tokens_col:
        several = tokens.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(id_col)
        t = F.col(tokens_col)
        # each element carries its left neighbour: no window, no array copied per row
        pairs = F.transform(t, lambda x, i: F.struct(
            x.alias(token_col), F.when(i > 0, F.element_at(t, i)).alias("prev_token")))
        long = tokens.join(several, id_col, "left_semi").select(id_col, F.posexplode(pairs).alias(pos_col, "_p")).select(
            id_col, F.col(pos_col).cast("int").alias(pos_col), f"_p.{token_col}", "_p.prev_token")
        single = tokens.filter(F.col(id_col).isNotNull()).join(several, id_col, "left_anti")
        return row_contexts(single, id_col, tokens_col, pos_col, token_col).unionByName(
            causal_context(long, id_col, pos_col, token_col))
    fp = fingerprint(F.concat_ws("|", F.col(pos_col).cast("string"), F.col(token_col)))
    if "prev_token" in tokens.columns:
        base = tokens
    else:
        from pyspark.sql import Window
        base = tokens.withColumn("prev_token", F.lag(token_col).over(
            Window.partitionBy(id_col).orderBy(pos_col)))
    run = running_sum(base, [id_col], pos_col, {"context_fp": fp}, inclusive=False)
    return run.select(id_col, pos_col, token_col,
                      F.col(pos_col).cast("bigint").alias("n_context"), "prev_token",
                      F.col("context_fp").cast("bigint").alias("context_fp"))


def context_tokens(tokens_col: str, pos_col: str) -> "F.Column":
    """Tokens left of a 0-based position, taken from the row's token array."""
    return F.slice(F.col(tokens_col), 1, F.col(pos_col))
