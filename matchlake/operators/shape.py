"""Pivots, stacked keys, two-sided rows, unpivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def eav_pivot(df: DataFrame, keys: Sequence[str], code: str, value: str, codes: Mapping, default=None,
              cast: str | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """Code/value rows to one wide row per key, one combinable max per code.

    ``extra`` adds further aggregates over the same groups. A key without any listed code still gives a row.
    """
    columns = []
    for number, name in codes.items():
        picked = F.when(F.col(code) == number, F.col(value))
        best = F.max(picked if default is None else picked.otherwise(F.lit(default)))
        columns.append((best if cast is None else best.cast(cast)).alias(name))
    return df.groupBy(*keys).agg(*columns, *extra)


def stack_by_key(parts: Sequence[DataFrame], keys: Sequence[str], how: Mapping[str, Column]) -> DataFrame:
    """Bring relations that share a key together with one aggregate instead of a chain of outer joins.

    Every part contributes the columns it has; the union is folded per key. All parts cross the network once, already
    combined per task, and no join has to be planned.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.groupBy(*keys).agg(*[fold.alias(name) for name, fold in how.items()])


def pair_opponents(df: DataFrame, group: str, side: str, cols: Sequence[str], prefix: str = "opponent_",
                   sides: tuple = ("home", "away")) -> DataFrame:
    """Each row next to the row of the other side of its group; groups without both sides drop out.

    Folds a group to its two sides and emits two rows, so the cost stays linear in the rows of a group.
    """
    rest = [c for c in df.columns if c not in (group, side)]
    first, second = sides
    row = F.struct(*rest)
    folded = df.groupBy(group).agg(F.max(F.when(F.col(side) == first, row)).alias("_a"),
                                   F.max(F.when(F.col(side) == second, row)).alias("_b"))
    both = folded.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    pairs = both.select(group, F.explode(F.array(
        F.struct(F.lit(first).alias("side"), F.col("_a").alias("own"), F.col("_b").alias("other")),
        F.struct(F.lit(second).alias("side"), F.col("_b").alias("own"), F.col("_a").alias("other")))).alias("_p"))
    return pairs.select(group, F.col("_p.side").alias(side), *[F.col(f"_p.own.{c}").alias(c) for c in rest],
                        *[F.col(f"_p.other.{c}").alias(prefix + c) for c in cols])


def two_sided(df: DataFrame, shared: Sequence[str], home: Mapping[str, str], away: Mapping[str, str]) -> DataFrame:
    """One wide row to two rows (home view, away view); ``home``/``away`` map output names to input columns."""
    view = lambda cols, side: F.struct(F.lit(side).alias("side_sk"), *[F.col(c).alias(n) for n, c in cols.items()])
    return df.select(*shared, F.explode(F.array(view(home, 1), view(away, 2))).alias("_v")).select(*shared, "_v.*")


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "col",
                    value: str = "val", keep_null: bool = False) -> DataFrame:
    """Columns to rows; rows without a value are dropped unless ``keep_null``."""
    long = df.unpivot(list(ids), list(cols), name, value)
    return long if keep_null else long.filter(F.col(value).isNotNull())


def dominant_value(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Most frequent value per key, the alphabetically first one on ties."""
    counts = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(out))
