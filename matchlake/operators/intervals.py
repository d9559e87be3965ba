"""Interval operators without nested-loop joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .prefix import prefix_sum


def tag_ranges(points: DataFrame, ranges: DataFrame, point: str, lo: str, hi: str) -> DataFrame:
    """Attach to each day the range it falls in: ranges become one row per day, then an equality join."""
    days = ranges.withColumn(point, F.explode(F.sequence(F.col(lo), F.col(hi)))).drop(lo, hi)
    return points.join(days, point, "left")


def count_in_interval(rows: DataFrame, events: DataFrame, keys: Sequence[str], event_time: str, lo: str, hi: str,
                      out: str, bits: int = 16) -> DataFrame:
    """Number of events of the same key with lo < time <= hi, for every row. Times and bounds are integers.

    An interval count is the difference of two running counts. The running count is needed only at the distinct bounds,
    so the work is linear in rows + events even when one key owns most of both.
    """
    keys = list(keys)
    bounds = rows.select(*keys, F.explode(F.array(lo, hi)).alias("_t"))
    points = bounds.filter(F.col("_t").isNotNull()).distinct().withColumn("_n", F.lit(0))
    seen = events.select(*keys, F.col(event_time).alias("_t")).groupBy(*keys, "_t").agg(F.count("*").alias("_n"))
    axis = seen.unionByName(points).groupBy(*keys, "_t").agg(F.sum("_n").alias("_n"))
    upto = prefix_sum(axis, "_t", F.col("_n"), "_upto", keys=keys, bits=bits).select(*keys, "_t", "_upto")
    at_lo = upto.select(*keys, F.col("_t").alias(lo), F.col("_upto").alias("_lo_count"))
    at_hi = upto.select(*keys, F.col("_t").alias(hi), F.col("_upto").alias("_hi_count"))
    counted = rows.join(at_lo, [*keys, lo], "left").join(at_hi, [*keys, hi], "left")
    gained = F.coalesce(F.col("_hi_count") - F.col("_lo_count"), F.lit(0))
    return counted.withColumn(out, F.greatest(gained, F.lit(0))).select(*rows.columns, out)


def date_chunks(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """Split each [start, end] into inclusive pieces of n days, the last one clipped."""
    steps = F.sequence(F.col(start), F.col(end), F.expr(f"interval {int(days)} days"))
    pieces = df.withColumn("from_date", F.explode(steps))
    return pieces.withColumn("to_date", F.least(F.date_add("from_date", days - 1), F.col(end)))
