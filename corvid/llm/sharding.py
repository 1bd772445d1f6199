"""Sharding (7): Feistel permutation with cycle walking over global row numbers.

Every row gets a global number ``i`` in ``[0, n)``. A keyed four-round Feistel
network on the smallest even-bit domain holding ``n`` permutes the numbers;
values that fall outside ``[0, n)`` are walked along their cycle until they
fall inside, which keeps the map a bijection of ``[0, n)``. The permuted number
``p`` *is* the shuffle: shard ``p mod s``, slot ``p div s``. Shard sizes differ
by at most one row, slots have no gaps, and shard and slot of row ``i`` (and,
through ``unpermute``, the row in a given slot) are computed without a lookup
table.

Defined cases: an empty table gives no rows; a null text counts as no bytes;
null keys are values like any other; equal rows get consecutive numbers and
hence independent places; extra columns are ignored unless named as keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.spark_util import number_rows, read_table, stored

ROUNDS = 4
M31 = (1 << 31) - 1


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """Odd multiplier and offset, both below 2^31, for each round."""
    out = []
    for r in range(rounds):
        d = hashlib.md5(f"feistel:{seed}:{r}".encode()).digest()
        out.append((int.from_bytes(d[:4], "little") >> 1 | 1, int.from_bytes(d[4:8], "little") >> 1))
    return out


def half_bits(n: int) -> int:
    """Bits of each Feistel half: the least ``h`` with ``4**h >= n``."""
    h = 1
    while 4 ** h < n:
        h += 1
    if h > 31:
        raise ValueError("at most 2^62 rows")
    return h


def _mix(half: np.ndarray, key: tuple[int, int], mask: int) -> np.ndarray:
    t = (half * key[0] + key[1]) & M31
    t = t ^ (t >> 15)
    t = (t * key[0]) & M31
    return (t ^ (t >> 13)) & mask


def _pass(x: np.ndarray, keys: Sequence[tuple[int, int]], h: int, forward: bool) -> np.ndarray:
    mask = (1 << h) - 1
    left, right = x >> h, x & mask
    if forward:
        for k in keys:
            left, right = right, left ^ _mix(right, k, mask)
    else:
        for k in reversed(keys):
            left, right = right ^ _mix(left, k, mask), left
    return left << h | right


def permute(x: np.ndarray, n: int, seed: int, forward: bool = True) -> np.ndarray:
    """The permutation of ``[0, n)`` (or its inverse) at the numbers ``x``."""
    keys, h = round_keys(seed), half_bits(n)
    y = _pass(np.asarray(x, dtype=np.int64), keys, h, forward)
    while True:
        out = np.flatnonzero(y >= n)
        if not len(out):
            return y
        y[out] = _pass(y[out], keys, h, forward)


def unpermute(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    return permute(x, n, seed, forward=False)


def shard_rows(df: DataFrame, keys: Sequence[str], n_shards: int, seed: int = 7) -> DataFrame:
    """``keys`` plus ``row_no``, ``shard`` and ``slot`` for every row of ``df``."""
    numbered = stored(number_rows(df, keys), "row-numbers")
    n = numbered.count()

    @F.pandas_udf("long")
    def place(i: pd.Series) -> pd.Series:
        return pd.Series(permute(i.to_numpy(), n, seed))

    return (numbered.withColumn("_p", place("row_no"))
            .select(*keys, "row_no", (F.col("_p") % n_shards).cast("int").alias("shard"),
                    F.floor(F.col("_p") / n_shards).cast("long").alias("slot")))


N_SHARDS, SEED = 40, 7


def op7_shards(spark, sf_dir: str) -> DataFrame:
    """Law ``rows``: shard sizes at most one row apart."""
    docs = read_table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    light = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return shard_rows(light, ["doc_id", "size", "text_crc32"], N_SHARDS, SEED).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _sql_round(x: str, r: int) -> str:
    """One Feistel round on ``x`` as SQL; ``h`` and ``m`` are columns."""
    a, c = round_keys(SEED)[r]
    right = f"({x} & m)"
    t1 = f"(({right} * {a} + {c}) & {M31})"
    t2 = f"((xor({t1}, {t1} >> 15) * {a}) & {M31})"
    return f"(({right} << h) | xor({x} >> h, xor({t2}, {t2} >> 13) & m))"


def _sql_pass(src: str) -> str:
    """Nested SELECTs applying all rounds to column ``x`` of ``src``."""
    for r in range(ROUNDS):
        src = f"(SELECT * REPLACE ({_sql_round('x', r)} AS x) FROM {src})"
    return src


SQL = f"""WITH RECURSIVE light AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 16 AS BIGINT) AS size,
         coalesce(text, '') AS body FROM documents),
crc_table AS (SELECT b, CAST(list_reduce(list_concat([b::BIGINT], range(8)::BIGINT[]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS BIGINT) AS t
  FROM range(256) r(b)),
tab AS (SELECT list(t ORDER BY b) AS ts FROM crc_table),
crced AS (
  SELECT doc_id, size, CAST(xor(list_reduce(list_concat([4294967295::BIGINT],
      CAST(list_transform(range(0, CAST(strlen(body) AS BIGINT)), lambda i:
        CAST(('0x' || substr(hx, CAST(2 * i + 1 AS BIGINT), 2)) AS BIGINT)) AS BIGINT[])),
      lambda c, v: xor(ts[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) AS BIGINT) AS text_crc32
  FROM (SELECT *, hex(encode(body)) AS hx FROM light), tab),
num AS (
  SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', coalesce(doc_id::VARCHAR, '~'),
      size::VARCHAR, text_crc32::VARCHAR)), doc_id, size, text_crc32) - 1 AS i,
    count(*) OVER () AS n FROM crced),
dom AS (SELECT min(h) AS h FROM range(1, 32) t(h), (SELECT count(*) AS n FROM light)
        WHERE pow(4, h) >= n),
walk AS (
  SELECT * FROM {_sql_pass("(SELECT num.*, h, (1::BIGINT << h) - 1 AS m, i AS x FROM num, dom)")}
  UNION ALL
  SELECT * FROM {_sql_pass("(SELECT * FROM walk WHERE x >= n)")})
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(x % {N_SHARDS} AS INTEGER) AS shard,
       CAST(x // {N_SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM walk WHERE x < n"""
