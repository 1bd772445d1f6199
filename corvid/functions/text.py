"""Column functions for text: strip, tokenize, truncation and fixed encoding.

All are built-in Spark expressions (JVM side, whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved vocabulary entries and their ids.
PAD, UNK, CLS, SEP = "[PAD]", "[UNK]", "[CLS]", "[SEP]"
RESERVED = [(PAD, 0), (UNK, 1), (CLS, 2), (SEP, 3)]
PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3

# Word boundary: anything that is not a letter or a digit.
WORD_SPLIT = r"[^\p{L}\p{N}]+"
# Python's str.strip() removes U+00A0 too; Spark's trim and \s do not.
_EDGE_SPACE = "^[\\s\\u00a0]+|[\\s\\u00a0]+$"


def py_strip(c: Column) -> Column:
    """Strip leading/trailing whitespace including no-break space."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.length(py_strip(c)) == 0)


def tokenize_words(c: Column) -> Column:
    """Lowercase, split on non letters/digits, drop empty pieces."""
    return F.filter(F.split(F.lower(c), WORD_SPLIT), lambda x: x != F.lit(""))


# Model input tokens, as a WordPiece-style pre-tokenizer sees them: runs of
# letters/digits, and every other non-space character on its own. Whitespace is
# spelled out so that Java, RE2 and Python regex engines agree.
MODEL_MARK = "[^\\p{L}\\p{N} \\t\\n\\r\\f]"
MODEL_TOKEN = "[\\p{L}\\p{N}]+|" + MODEL_MARK


def model_tokens(c: Column) -> Column:
    """Lowercased word runs plus single punctuation characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(MODEL_TOKEN), 0)


def truncate_tokens(tokens: Column, max_len: int) -> Column:
    """keep at most ``max_len - 2`` real tokens (CLS and SEP use two slots)."""
    return F.slice(tokens, 1, max_len - 2)


def encode_fixed(ids: Column, max_len: int) -> tuple[Column, Column]:
    """``[CLS] ids [SEP] [PAD]...`` to exactly ``max_len`` and its 1/0 mask.

    ``ids`` must already be truncated to ``max_len - 2`` entries.
    """
    body = F.concat(F.array(F.lit(CLS_ID)), ids.cast("array<int>"), F.array(F.lit(SEP_ID)))
    n_pad = F.lit(max_len) - F.size(body)
    input_ids = F.concat(body, F.array_repeat(F.lit(PAD_ID), n_pad))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(body)), F.array_repeat(F.lit(0), n_pad))
    return input_ids, mask


def join_ints(arr: Column, sep: str = " ") -> Column:
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


def fingerprint(c: Column) -> Column:
    """32-bit content fingerprint from md5, identical in Spark SQL and DuckDB.

    Summing fingerprints gives an order-aware digest of a group (include the
    position in ``c``) that is a distributive aggregate: partial aggregation
    works, and no group is ever collected.
    """
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint")
