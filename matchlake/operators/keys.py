"""Surrogate keys, sentinel rows, foreign keys, overlays, latest row per key."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.storage import workspace
from .literals import values


#: The bits of ``monotonically_increasing_id`` that count the rows of a partition.
IN_PARTITION = (1 << 33) - 1


def latest_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str | Column], oldest: bool = False) -> DataFrame:
    """The row with the greatest ``by`` per key, NULLs counting as smallest. ``by`` must end in a tiebreak.

    Written as a combinable aggregate: every task keeps one row per key before the shuffle, so a key that owns a large
    share of the rows costs no more than any other.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if oldest else F.max_by
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*by)).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in rest]).select(*df.columns)


def dense_number(df: DataFrame, key: str, out: str, start: Column | int = 0) -> DataFrame:
    """``start`` + 1, 2, 3... in the order of the unique column ``key``, which may be of any type.

    The rows are cut into ranges of the key at its quantiles, numbered where they are sorted, and written down once; ranges are
    counted, and numbers shifted by what lies before their range. Rows cross the network once. The one window without partition
    sees a row per range, and those are all that is sent to every task.
    """
    first = F.lit(start) if isinstance(start, int) else start
    path = f"{workspace(df.sparkSession)}/numbered"
    ranged = df.repartitionByRange(key).sortWithinPartitions(key).select(
        "*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND(F.lit(IN_PARTITION)).alias("_place"))
    ranged.write.parquet(path)
    rows = df.sparkSession.read.schema(ranged.schema).parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (rows.join(F.broadcast(offsets), "_range")
            .withColumn(out, (F.col("_place") + 1 + F.col("_offset") + first).cast("bigint")).drop("_range", "_place", "_offset"))


def merge_scd1(target: DataFrame | None, source: DataFrame, key: str, sk: str, update: Sequence[str],
               dense: bool = False) -> DataFrame:
    """Overwrite-in-place merge with stable surrogate keys; returns the merged real rows (sk > 0).

    Rows already known keep their key and take the ``update`` columns of the source, rows missing from the source stay,
    new rows are numbered after the highest key. The number counts *all* source rows, so known rows leave gaps; with
    ``dense`` only the new rows are counted.
    """
    update = list(update)
    source = source.select(key, *update)
    if target is None:
        return dense_number(source, key, sk).select(sk, key, *update)
    old = target.filter(F.col(sk) > 0).select(F.col(sk).cast("bigint").alias(sk), key, *update)
    top = old.agg(F.coalesce(F.max(sk), F.lit(0)).alias("top")).scalar()
    if dense:
        fresh = dense_number(source.join(old.select(key), key, "left_anti").select(key), key, "_rank")
        ranked = source.join(fresh, key, "left")
    else:
        ranked = dense_number(source, key, "_rank")
    ranked = ranked.withColumn("_in_source", F.lit(True))
    t, s = old.alias("t"), ranked.alias("s")
    both = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return both.select(
        F.coalesce(F.col(f"t.{sk}"), F.col("s._rank") + top).alias(sk),
        F.coalesce(F.col(f"t.{key}"), F.col(f"s.{key}")).alias(key),
        *[F.when(F.col("s._in_source"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in update])


def with_sentinels(dim: DataFrame, sk: str, rows: Sequence[Mapping], keep_existing: bool = False) -> DataFrame:
    """Put the special rows back: drop and add them, or with ``keep_existing`` add only the missing ones."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dim.schema)
    extra = values(dim.sparkSession, ddl, [tuple(r.get(c) for c in dim.columns) for r in rows])
    if keep_existing:
        return dim.unionByName(extra.join(dim.filter(F.col(sk) < 0).select(sk), sk, "left_anti").select(*dim.columns))
    return dim.filter(~F.col(sk).isin(*[r[sk] for r in rows])).unionByName(extra)


def resolve_fks(fact: DataFrame, lookups: Sequence[tuple], unknown: int = -1) -> DataFrame:
    """Replace natural keys by surrogate keys; unmatched or NULL keys point at the unknown member.

    ``lookups`` holds (dim, fact_key, dim_key, sk, out). Whether a dimension is broadcast or shuffled is left to Spark,
    which knows its size.
    """
    keys = []
    for i, (dim, fact_key, dim_key, sk, out) in enumerate(lookups):
        named = dim.filter(F.col(dim_key).isNotNull()).select(F.col(dim_key).alias(f"_k{i}"), F.col(sk).alias(f"_s{i}"))
        fact = fact.join(named, F.col(fact_key) == F.col(f"_k{i}"), "left")
        keys.append(F.coalesce(f"_s{i}", F.lit(unknown)).alias(out))
    taken = {out for *_, out in lookups}
    kept = [c for c in fact.columns if c not in taken and not re.fullmatch(r"_[ks]\d+", c)]
    return fact.select(*kept, *keys)


def resolve_fk(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, sk: str, out: str | None = None,
               unknown: int = -1) -> DataFrame:
    return resolve_fks(fact, [(dim, fact_key, dim_key, sk, out or sk)], unknown)


def with_fallback(master: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """Master rows plus the fallback rows whose key the master lacks; columns missing in the fallback become NULL."""
    extra = fallback.filter(F.col(key).isNotNull()).join(master.select(key), key, "left_anti")
    return master.unionByName(extra, allowMissingColumns=True)


def overlay(df: DataFrame, seed: DataFrame, key: Sequence[str] | str, mapping: Mapping[str, str]) -> DataFrame:
    """Curated values win over source values: for each column, coalesce(seed, source)."""
    keys = [key] if isinstance(key, str) else list(key)
    named = seed.select(*keys, *[F.col(s).alias(f"_seed_{t}") for t, s in mapping.items()])
    merged = df.join(named, keys, "left")
    for target in mapping:
        seeded = F.col(f"_seed_{target}")
        merged = merged.withColumn(target, F.coalesce(seeded, F.col(target)) if target in df.columns else seeded)
    return merged.drop(*[f"_seed_{t}" for t in mapping]).select(
        *df.columns, *[t for t in mapping if t not in df.columns])


def canonical_id(df: DataFrame, aliases: DataFrame, column: str, alias: str, canonical: str) -> DataFrame:
    """Replace alias ids by the canonical id."""
    seed = aliases.select(F.col(alias).alias("_alias"), F.col(canonical).alias("_canonical"))
    return (df.join(seed, F.col(column) == F.col("_alias"), "left")
            .withColumn(column, F.coalesce("_canonical", column)).drop("_alias", "_canonical"))
