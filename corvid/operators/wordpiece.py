"""WordPiece encoding at corpus scale.

Greedy longest-match-first over a piece vocabulary, ``##`` marking a piece
that continues a word. Documents are encoded where they are read: the pieces
are a bounded broadcast and each task remembers the words it has split, so no
token is shuffled and a very common word is split once per task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvid.functions.text import RESERVED, UNK
from corvid.operators.score import VOCAB_SIZE
from corvid.operators.udfs import broadcast_table

CONT = "##"
#: Lengths of the word beginnings and endings that are candidate pieces.
AFFIX_LENGTHS = (2, 3, 4)
#: Words a task remembers at most before it starts over.
CACHE_WORDS = 1 << 16
#: Words that are worked on at once; a longer text is a part of its own.
PART_WORDS = 1 << 16


def greedy_pieces(word: str, vocab: set[str] | dict, max_piece: int) -> list[str]:
    """Longest vocabulary piece at each position, for a word of any length; a
    word with an unmatched position becomes a single ``[UNK]``."""
    out: list[str] = []
    start = 0
    while start < len(word):
        end = min(len(word), start + max_piece)
        found = None
        while end > start:
            sub = word[start:end] if start == 0 else CONT + word[start:end]
            if sub in vocab:
                found = sub
                break
            end -= 1
        if found is None:
            return [UNK]
        out.append(found)
        start = end
    return out


def build_piece_vocab(spark: SparkSession, words: DataFrame, k: int = VOCAB_SIZE,
                      lengths: Iterable[int] = AFFIX_LENGTHS) -> DataFrame:
    """``(piece, piece_id)``: the reserved entries, then the ``k`` most frequent
    candidate pieces (ties by piece).

    Candidates are whole words, word beginnings and endings of ``lengths``
    characters, and single characters in both forms, weighted by word counts.
    ``k`` is the size of the whole vocabulary: one top-k over the aggregated
    pieces, per partition and then merged.
    """
    wc = words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    w = F.col("word")
    cands = [w]
    for n in lengths:
        longer = F.length(w) > n
        cands.append(F.when(longer, F.substring(w, 1, n)))
        cands.append(F.when(longer, F.concat(F.lit(CONT), F.expr(f"substring(word, -{n})"))))
    chars = F.filter(F.split(w, ""), lambda c: F.length(c) == 1)
    both = F.concat(F.filter(F.array(*cands), lambda x: x.isNotNull()), chars,
                    F.transform(chars, lambda c: F.concat(F.lit(CONT), c)))
    counts = (wc.select(F.explode(both).alias("piece"), "cnt")
              .groupBy("piece").agg(F.sum("cnt").alias("cnt")))
    top = counts.orderBy(F.desc("cnt"), F.asc("piece")).limit(k)
    ranked = top.select("piece", (F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc("piece")))   # k rows
                                  + F.lit(len(RESERVED) - 1)).cast("int").alias("piece_id"))
    return spark.createDataFrame(RESERVED, "piece string, piece_id int").unionByName(ranked)


def whole_rows(batch: pa.RecordBatch, col: int, words: int = PART_WORDS) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """``batch`` in parts of whole rows with at most ``words`` list entries in
    column ``col`` (a longer row is alone), and where each row's entries begin
    and end. A part's working memory so does not grow with the batch."""
    n = pc.fill_null(pc.list_value_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + words, "right")) - 1)
        yield batch.slice(lo, hi - lo), ends[lo:hi + 1] - ends[lo]
        lo = hi


def wordpiece_ids(spark: SparkSession, docs: DataFrame, vocab: DataFrame, words_col: str) -> DataFrame:
    """``docs`` with its word array replaced by ``piece_ids array<int>`` and
    ``n_unk``, the words without a split; whole texts, any word length."""
    bc = broadcast_table(spark, vocab, "piece", ["piece_id"])
    others = [c for c in docs.columns if c != words_col]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = {p: i for p, (i,) in bc.value.items()}
        unk = table[UNK]
        longest = max(len(p.removeprefix(CONT)) for p in table)
        known: dict[str, list[int]] = {}

        def ids_of(word: str) -> list[int]:
            got = known.get(word)
            if got is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                got = known[word] = [table[p] for p in greedy_pieces(word, table, longest)]
            return got

        for batch in batches:
            for part, ends in whole_rows(batch, len(others)):
                coded = part.column(len(others)).flatten().dictionary_encode()
                which = coded.indices.to_numpy(zero_copy_only=False)
                split = [ids_of(w) for w in coded.dictionary.to_pylist()]      # the part's distinct words
                ids = np.fromiter((i for s in split for i in s), np.int32)
                size = np.fromiter(map(len, split), np.int64, len(split))
                n = size[which]
                after = np.concatenate([[0], np.cumsum(n)])
                first = (np.cumsum(size) - size)[which]
                pieces = ids[np.repeat(first - after[:-1], n) + np.arange(after[-1])]
                lost = np.fromiter((s == [unk] for s in split), np.int64, len(split))[which]
                n_unk = np.diff(np.concatenate([[0], np.cumsum(lost)])[ends])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(others)],
                     pa.ListArray.from_arrays(pa.array(after[ends], pa.int32()), pa.array(pieces, pa.int32())),
                     pa.array(n_unk, pa.int64())],
                    names=[*others, "piece_ids", "n_unk"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return docs.select(*others, words_col).mapInArrow(
        encode, f"{schema}, piece_ids array<int>, n_unk bigint")
