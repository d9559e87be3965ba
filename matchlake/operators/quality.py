"""Data-quality checks. Each returns the violating rows; an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .literals import values
from .shape import unpivot_columns


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    return df if where is None else df.filter(where)


def not_null(df: DataFrame, column: str, where=None) -> DataFrame:
    return _where(df, where).filter(F.col(column).isNull())


def unique(df: DataFrame, columns: Sequence[str] | str, where=None) -> DataFrame:
    """Key values that occur more than once; one column or a combination."""
    keys = [columns] if isinstance(columns, str) else list(columns)
    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return _where(df, where).filter(filled).groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def accepted_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    bad = df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))
    return bad.groupBy(column).agg(F.count("*").alias("row_count"))


def rows_per_key(df: DataFrame, key: str, expected: int, where=None) -> DataFrame:
    return _where(df, where).groupBy(key).agg(F.count("*").alias("row_count")).filter(F.col("row_count") != expected)


def missing_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows whose key the other relation lacks. NULL keys on either side never match."""
    known = other.select(F.col(other_key or key).alias("_known")).filter("_known IS NOT NULL").distinct()
    return df.join(known, F.col(key) == F.col("_known"), "left_anti")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return missing_in(child.filter(F.col(column).isNotNull()), parent, column, parent_key).groupBy(column).agg(
        F.count("*").alias("row_count"))


def sentinels_present(dims: Mapping[str, tuple[DataFrame, str]], expected: Sequence[int] = (-1, -2)) -> DataFrame:
    parts = []
    for name, (dim, sk) in dims.items():
        wanted = values(dim.sparkSession, "dim_name string, expected_sk int", [(name, e) for e in expected])
        parts.append(missing_in(wanted, dim.filter(F.col(sk) < 0), "expected_sk", sk))
    return reduce(DataFrame.unionByName, parts)


def unresolved(df: DataFrame, checks: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Foreign keys left at the unknown member; ``checks`` maps the key column to the rows it must be resolved for.

    One pass: every row lists its failing keys.
    """
    failing = F.filter(F.array(*[F.when(F.expr(f"({where}) AND {fk} = -1"), F.lit(fk)) for fk, where in checks.items()]),
                       lambda x: x.isNotNull())
    return df.select(F.explode(failing).alias("fk"), *keep)


def negative(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    wide = df.select(*ids, *[F.col(c).cast("double") for c in columns])
    if columns:  # few rows have one, and only those become as many rows as there are columns
        wide = wide.filter(reduce(Column.__or__, [F.col(c) < 0 for c in columns]))
    return unpivot_columns(wide, ids, columns).filter("val < 0").select(*ids, "col")


def outside(df: DataFrame, column: str, lo=None, hi=None, where=None) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    bad = bad | (c < lo) if lo is not None else bad
    bad = bad | (c > hi) if hi is not None else bad
    return _where(df, where).filter(bad)


def too_few(tables: Mapping[str, tuple[DataFrame, str | None, int]]) -> DataFrame:
    """Tables below their row floor."""
    parts = [_where(df, where).agg(F.count("*").alias("actual")).select(
        F.lit(name).alias("model"), "actual", F.lit(floor).alias("min_expected")).filter("actual < min_expected")
        for name, (df, where, floor) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Check:
    """A named check; ``warn`` results are reported but do not fail a run."""
    name: str
    violations: DataFrame
    severity: str = "error"


def summary(checks: Sequence[Check]) -> DataFrame:
    """(check, severity, violations, status) of a set of checks."""
    parts = [c.violations.agg(F.count("*").alias("violations")).select(
        F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "violations",
        F.when(F.col("violations") == 0, "pass").otherwise(c.severity).alias("status")) for c in checks]
    return reduce(DataFrame.unionByName, parts)
