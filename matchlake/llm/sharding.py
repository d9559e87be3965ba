"""Shards of near-equal bytes by histogram sort.

Rows are ordered by a hash of their group, then by a hash of their own, so that equal texts lie together. Splitters of that
order are found by counting: each round sums the exact bytes between candidate boundaries across all partitions and looks
closer only into the intervals that hold an undecided splitter. Then rows move once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import shipped, staged

#: A round cuts every open interval into 2 ** BITS equal ones.
BITS = 8
ROUNDS = 128 // BITS
#: A splitter is settled when its interval holds at most this part of a shard.
TOLERANCE = 0.002
#: A shard is sorted and numbered in ranges of about this many bytes, at most MOST_RANGES of them.
RANGE_BYTES = 256 << 20
MOST_RANGES = 64

LOWEST = -(1 << 63)


def _prefix(level: int) -> tuple[Column, Column]:
    """The leading BITS * level bits of (group hash, row hash) as two signed numbers."""
    bits = BITS * level
    first = F.shiftright("_h1", 64 - min(bits, 64)) if bits else F.lit(0).cast("long")
    second = F.shiftright("_h2", 128 - bits) if bits > 64 else F.lit(0).cast("long")
    return first.alias("p1"), second.alias("p2")


def _start(level: int, p1: int, p2: int) -> tuple[int, int]:
    """First key of an interval."""
    bits = BITS * level
    return (p1 << (64 - min(bits, 64)) if bits else LOWEST), (p2 << (128 - bits) if bits > 64 else LOWEST)


def splitters(keyed: DataFrame, weight: str, targets: list[int], near: float) -> list[tuple[int, int]]:
    """Keys with, within `near`, `targets` bytes below them. `keyed` has `_h1`, `_h2` and is read once a round.

    The driver sees at most 2 ** BITS sums for each open splitter of a round; a single row is never looked into.
    """
    settled: dict[int, tuple[int, int]] = {}
    waiting: dict[int, dict[tuple[int, int], tuple[int, list[int]]]] = {0: {(0, 0): (0, list(range(len(targets))))}}
    spark = keyed.sparkSession
    while waiting:
        level = min(waiting)
        parents = waiting.pop(level)
        q1, q2 = _prefix(level)
        p1, p2 = _prefix(level + 1)
        rows = keyed.select(weight, p1, p2, q1.alias("q1"), q2.alias("q2"), "_h1")
        if level:
            wanted = spark.createDataFrame(list(parents), "q1 long, q2 long")
            rows = rows.join(F.broadcast(wanted), ["q1", "q2"], "left_semi")
        counted = rows.groupBy("q1", "q2", "p1", "p2").agg(
            F.sum(weight).alias("w"), F.count("*").alias("n"), F.min("_h1").alias("a"), F.max("_h1").alias("b")).collect()
        inside: dict[tuple[int, int], list] = {}
        for r in counted:
            inside.setdefault((r.q1, r.q2), []).append((r.p1, r.p2, r.w, r.n, r.a, r.b))
        for parent, (below, asked) in parents.items():
            cells = sorted(inside.get(parent, []))
            edges = [below]
            for cell in cells:
                edges.append(edges[-1] + cell[2])
            for j in asked:
                at = min(max(bisect_right(edges, targets[j]) - 1, 0), len(cells) - 1)
                low, high = edges[at], edges[at + 1]
                c1, c2, _, n, first, last = cells[at]
                if level + 1 == ROUNDS or n == 1 or high - low <= near or targets[j] in (low, high):
                    if high - targets[j] >= targets[j] - low:
                        settled[j] = _start(level + 1, c1, c2)
                    else:
                        settled[j] = _start(level + 1, *cells[at + 1][:2]) if at + 1 < len(cells) else _after(level + 1, c1, c2)
                elif first == last and (level + 1) * BITS < 64:  # one group: go on with the hashes of its rows
                    waiting.setdefault(64 // BITS, {}).setdefault((first, 0), (low, []))[1].append(j)
                else:
                    waiting.setdefault(level + 1, {}).setdefault((c1, c2), (low, []))[1].append(j)
    return [settled[j] for j in range(len(targets))]


def _after(level: int, p1: int, p2: int) -> tuple[int, int]:
    """First key behind an interval."""
    bits = BITS * level
    if bits <= 64:
        first = (p1 + 1) << (64 - bits)
        return (first, LOWEST) if first < 1 << 63 else ((1 << 63) - 1, (1 << 63) - 1)
    second = (p2 + 1) << (128 - bits)
    if second < 1 << 63:
        return p1, second
    return (p1 + 1, LOWEST) if p1 + 1 < 1 << 63 else ((1 << 63) - 1, (1 << 63) - 1)


def _range_of(cuts: list[tuple[int, int]]):
    """Column function: how many splitters are at or below (group hash, row hash)."""
    first = np.array([a for a, _ in cuts], dtype=np.int64)
    second = np.array([b for _, b in cuts], dtype=np.int64)

    @F.arrow_udf("int")
    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for a, b in batches:
            h1, h2 = a.to_numpy(zero_copy_only=False), b.to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(first, h1, "left"), np.searchsorted(first, h1, "right")
            out = high.astype(np.int32)
            tied = np.flatnonzero(low < high)
            for at in np.unique(low[tied]).tolist():
                mine = tied[low[tied] == at]
                end = int(high[mine[0]])
                out[mine] = at + np.searchsorted(second[at:end], h2[mine], "right")
            yield pa.array(out, pa.int32())
    return place


def shard_by_bytes(rows: DataFrame, shards: int, *, weight: str = "size", group: tuple[str, ...] = (),
                   tolerance: float = TOLERANCE) -> DataFrame:
    """`rows` with `shard` (0 to shards-1, weights near equal) and `slot` (from 0 without gaps in each shard).

    Rows of a group lie together unless their group is larger than the tolerance: then it is cut like anything else, row by
    row, also where rows are equal in all columns. `group` defaults to all columns. The input is staged once in the shared
    folder, so that row hashes hold in every round. Null weights count 0; an empty table gives an empty result; columns
    already called `shard` or `slot` are replaced.
    """
    spark = shipped(rows.sparkSession)
    rows = rows.drop("shard", "slot")
    keyed = staged(rows.withColumns({
        "_h1": F.xxhash64(*(group or rows.columns)),
        "_h2": F.xxhash64(F.monotonically_increasing_id(), F.xxhash64(*rows.columns)),
        "_w": F.coalesce(F.col(weight).cast("long"), F.lit(0))}))
    total = keyed.agg(F.coalesce(F.sum("_w"), F.lit(0)).alias("w"), F.count("*").alias("n")).first()
    if not total.n:
        return rows.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
    ranges = max(1, min(MOST_RANGES, -(-total.w // (shards * RANGE_BYTES))))
    n = shards * ranges
    near = tolerance * total.w / shards
    cuts = splitters(keyed, "_w", [total.w * j // n for j in range(1, n)], near)
    placed = keyed.withColumn("_range", _range_of(cuts)("_h1", "_h2"))
    held = dict(placed.groupBy("_range").agg(F.count("*")).collect())
    offset, seen = [], 0
    for j in range(n):
        seen = 0 if j % ranges == 0 else seen
        offset.append((j, seen))
        seen += held.get(j, 0)
    schema = T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_from", T.LongType())])
    order = Window.partitionBy("_range").orderBy("_h1", "_h2")
    return placed.withColumn("_at", F.row_number().over(order)) \
        .join(F.broadcast(spark.createDataFrame(offset, schema)), "_range") \
        .withColumns({"shard": F.floor(F.col("_range") / ranges).cast("int"), "slot": (F.col("_from") + F.col("_at") - 1).cast("long")}) \
        .drop("_range", "_from", "_at", "_h1", "_h2", "_w")
