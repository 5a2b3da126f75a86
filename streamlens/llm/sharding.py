"""Reproducible shuffle into shards: a Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in a total order.  A keyed Feistel network permutes
[0, N): it acts on a*b >= N cells (a, b near sqrt(N)) and walks its cycle until
the result is below N, so it is a bijection for every N.  Position p of a row
gives shard p mod n and slot p div n: counts differ by at most one, slots are
gapless, and both can be computed (and inverted) from the row number alone.

Edge cases: an empty table gives an empty result.  NULLs in any column are
ordinary values of the order (first).  Rows that are equal in every ordering
value are interchangeable; they get different numbers.  Input columns named
like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from streamlens.llm.common import materialize, set_aside, without

ROUNDS = 6
_LOCAL_BITS = 33  # monotonically_increasing_id: partition << 33 | row in partition
_M64 = (1 << 64) - 1


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser (xor-shift multiply) keyed by addition."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(key)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _round_keys(seed: int) -> list[int]:
    k = np.arange(1, ROUNDS + 1, dtype=np.uint64)
    return [int(v) for v in _mix(k * np.uint64(0x9E3779B97F4A7C15), seed & _M64)]


def _sides(n: int) -> tuple[int, int]:
    a = isqrt(n - 1) + 1
    return a, -(-n // a)


def permute(numbers: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The position of each row number under the permutation of [0, n)."""
    if n <= 1:
        return np.zeros_like(numbers)
    a, b = (np.uint64(s) for s in _sides(n))
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    keys = _round_keys(seed)
    while len(todo):  # a walk always ends: the cycle returns to its start, which is below n
        x = out[todo]
        left, right = x // b, x % b
        for i, k in enumerate(keys):  # alternate sides, so a and b may differ
            if i % 2 == 0:
                left = (left + _mix(right, k) % a) % a
            else:
                right = (right + _mix(left, k) % b) % b
        x = left * b + right
        out[todo] = x
        todo = todo[x >= n]
    return out.astype(np.int64)


def unpermute(positions: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Inverse of ``permute``: which row number lies at a position."""
    if n <= 1:
        return np.zeros_like(positions)
    a, b = (np.uint64(s) for s in _sides(n))
    out = positions.astype(np.uint64)
    todo = np.arange(len(out))
    keys = list(enumerate(_round_keys(seed)))[::-1]
    while len(todo):
        x = out[todo]
        left, right = x // b, x % b
        for i, k in keys:
            if i % 2 == 0:
                left = (left + a - _mix(right, k) % a) % a
            else:
                right = (right + b - _mix(left, k) % b) % b
        x = left * b + right
        out[todo] = x
        todo = todo[x >= n]
    return out.astype(np.int64)


def number_rows(df: DataFrame, order_by: list[str], out: str = "row_number") -> tuple[DataFrame, int]:
    """Number all rows 0..N-1 in the order of ``order_by`` (NULLs first).

    The range exchange also gets a per-row tie value, so a key that holds a
    third of all rows spreads over several partitions.  The sorted rows are
    written once; then one count per partition (all the driver sees) turns
    local indexes into global ones.
    """
    keys = [F.col(f"`{c}`").asc_nulls_first() for c in order_by]
    df = df.withColumn("__tie", F.monotonically_increasing_id())
    ordered = df.repartitionByRange(*keys, F.col("__tie")).sortWithinPartitions(*keys, "__tie").drop("__tie")
    ordered = materialize(ordered.withColumn("__pos", F.monotonically_increasing_id()), "row-order")
    part = F.shiftright("__pos", _LOCAL_BITS)
    counts = sorted((r[0], r[1]) for r in ordered.groupBy(part.alias("p")).count().collect())
    total, starts = 0, []
    for p, c in counts:
        starts.append((p, total))
        total += c
    offsets = df.sparkSession.createDataFrame(starts, "__p long, __start long")
    numbered = (ordered.withColumn("__p", part)
                .join(F.broadcast(offsets), "__p")  # one row per partition
                .withColumn(out, F.col("__start") + F.col("__pos").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
                .drop("__p", "__start", "__pos"))
    return numbered, total


def feistel_shards(df: DataFrame, n_shards: int, seed: int = 0,
                   order_by: list[str] | None = None) -> DataFrame:
    """``df`` plus ``row_number``, ``shard`` (int) and ``slot`` (long).

    ``order_by`` fixes the row numbering; by default a 64-bit hash of all
    columns, so equal tables give equal shards whatever their file layout.
    """
    df, now, back = set_aside(without(df, "row_number", "shard", "slot"), "__tie", "__pos", "__p", "__start", "__at", "__order")
    order_by = order_by and [now(c) for c in order_by]
    if order_by is None:
        df = df.withColumn("__order", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    numbered, total = number_rows(df, order_by or ["__order"])

    @pandas_udf("long")
    def position(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            yield pd.Series(permute(s.to_numpy(), total, seed))

    return back(numbered.withColumn("__at", position("row_number"))
            .withColumn("shard", F.pmod("__at", F.lit(n_shards)).cast("int"))
            .withColumn("slot", F.expr(f"__at div {n_shards}"))
            .drop("__at", "__order"))
