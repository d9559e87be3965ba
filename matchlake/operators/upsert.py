"""Upserts and refresh scopes as relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def delete_insert(target: DataFrame, batch: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Drop target rows whose key occurs in the batch, then add every batch row (duplicates inside it survive)."""
    keys = [key] if isinstance(key, str) else list(key)
    kept = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return kept.select(*target.columns).unionByName(batch.select(*target.columns))


def replace_where(target: DataFrame, batch: DataFrame, scope: Column) -> DataFrame:
    """Drop the target rows inside ``scope`` (NULL counts as outside) and add the batch."""
    return target.filter(~F.coalesce(scope, F.lit(False))).unionByName(batch, allowMissingColumns=True)


def since_high_water(df: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Rows newer than the newest row of the target; an empty target takes everything."""
    mark = target.agg(F.max(ts).alias("mark")).scalar()
    return df.filter(mark.isNull() | (F.col(ts) > mark))


def add_missing_columns(df: DataFrame, ddl: str) -> DataFrame:
    """Append declared columns the table does not have yet, filled with NULL."""
    for part in ddl.split(","):
        name, kind = part.split()
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast(kind))
    return df


def first_seen(df: DataFrame, key: Sequence[str] | str, arrival: Sequence[str]) -> DataFrame:
    """Keep the first row per key in arrival order."""
    from .keys import latest_per_key
    return latest_per_key(df, [key] if isinstance(key, str) else key, arrival, oldest=True)


def known_keys(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Keys of this batch and every key stored before."""
    return batch.select(key).union(stored.select(key)).distinct()
