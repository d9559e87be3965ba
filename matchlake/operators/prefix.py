"""Ordered running totals that never put a whole table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def prefix_sum(df: DataFrame, order: str, value: Column, out: str, keys: Sequence[str] = (),
               bucket: Column | None = None, bits: int = 16) -> DataFrame:
    """Inclusive running sum of ``value`` by ``order`` inside ``keys``; rows with equal order share the total.

    The order axis is cut into buckets. Totals per bucket are added up first (a small relation), each bucket is then
    summed on its own and shifted by what lies before it. With an integer order column and at most one row per
    (keys, order), a bucket holds at most ``2**bits`` rows whatever the data looks like.
    """
    keys = list(keys)
    part = [*keys, "_bucket"]
    rows = df.withColumn("_bucket", F.shiftright(F.col(order), bits) if bucket is None else bucket)
    totals = rows.groupBy(*part).agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*part).orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("_inside", F.sum(value).over(inside))
            .join(offsets, part)
            .withColumn(out, F.col("_inside") + F.col("_offset"))
            .drop("_bucket", "_inside", "_offset"))
