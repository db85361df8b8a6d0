"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in the order of their key (ties by a hash of the whole row), the number
goes through a keyed Feistel network over a domain slightly larger than n, and values beyond n
walk the cycle until they fall inside.  The permuted number p gives shard p mod k and slot
p div k: shard sizes differ by at most one, slots have no gaps, and the place of any row number
can be computed (and inverted) without looking at the data.

Numbering is distributed: rows are range-partitioned by key (a hot key is split by the row
hash and then by its scan position), each partition numbers its own rows, and only the
partition counts are summed.

Defined cases: null ids come first; rows with equal keys are ordered by their hash, identical
rows are interchangeable; an empty table gives an empty result."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.text import if_small, partitions, written

P = (1 << 31) - 1
ROUNDS = 6


def _keys(seed: int) -> list[tuple[int, int]]:
    """Round keys from a linear congruential sequence of the seed."""
    x, out = (seed * 2654435761 + 97) % P, []
    for _ in range(ROUNDS):
        x = (x * 48271 + 11) % P
        y = x = (x * 48271 + 11) % P
        x = (x * 48271 + 11) % P
        out.append((y | 1, x))
    return out


def _mixed(half: np.ndarray, key: tuple[int, int]) -> np.ndarray:
    t = (half % P * key[0] + key[1]) % P
    return (t * t + key[1]) % P


def domain(n: int) -> tuple[int, int]:
    """Sides a, b with n <= a*b < n + a: the smaller the excess, the shorter the walk."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def permute(x: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """Keyed bijection of 0..n-1 (vectorised); ``back`` inverts it."""
    a, b = domain(n)
    keys = _keys(seed)
    out = np.asarray(x, dtype=np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // b, out[todo] % b
        for i in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
            f = _mixed(right if i % 2 == 0 else left, keys[i]) * (-1 if back else 1)
            if i % 2 == 0:
                left = (left + f) % a
            else:
                right = (right + f) % b
        out[todo] = left * b + right
        todo = todo[out[todo] >= n]
    return out


def permuted(c: Column, n: int, seed: int) -> Column:
    @F.pandas_udf("long")
    def f(s: pd.Series) -> pd.Series:
        return pd.Series(permute(s.to_numpy(), n, seed))
    return f(c)


def numbered(df: DataFrame, order_by: list[str]) -> tuple[DataFrame, int]:
    """The rows of ``df`` as ``_row`` with their global ``row_number`` (from 0, by ``order_by``),
    and how many there are.  Columns of ``df`` may have any names."""
    hashed = [c for c, t in df.dtypes if "map<" not in t]
    keyed = df.select(F.struct("*").alias("_row"), F.xxhash64(*hashed).alias("_tie"), F.monotonically_increasing_id().alias("_at"))
    keys = [*(F.col("_row")[c].asc_nulls_first() for c in order_by), F.col("_tie"), F.col("_at")]
    # the id of a row is its partition (upper bits) and its place in the sorted partition
    placed = (keyed.repartitionByRange(partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
              .withColumn("_place", F.monotonically_increasing_id()).drop("_tie", "_at"))
    table = written(placed, "numbered")
    part = F.shiftright("_place", 33)
    counts = table.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).checkpoint()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    n, parts = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count("*")).first()
    return (table.withColumn("_part", part).join(if_small(offsets, parts, 100_000), "_part")
            .withColumn("row_number", F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1))
            .drop("_part", "_place", "_before")), n


def shard(df: DataFrame, n_shards: int = 24, seed: int = 1, order_by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``df`` with ``shard`` int and ``slot`` long; columns of these names are replaced."""
    rows, n = numbered(df.drop("shard", "slot"), list(order_by))
    return rows.withColumn("_p", permuted(F.col("row_number"), n, seed)).select(
        "_row.*", (F.col("_p") % n_shards).cast("int").alias("shard"),
        F.expr(f"_p div {int(n_shards)}").cast("long").alias("slot"))
