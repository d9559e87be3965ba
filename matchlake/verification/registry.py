"""Registered queries with their expected results."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.storage import configure
from .oracle import compose

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _plain_times(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, so both engines report them alike."""
    kinds = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss", "timestamp_ntz": "yyyy-MM-dd HH:mm:ss"}
    return df.select(*[F.date_format(c, kinds[t]).alias(c) if t in kinds else F.col(c) for c, t in df.dtypes])


def register(name: str, fn: Callable[[SparkSession, str], DataFrame], sql: str | None = None, dates=(), times=()) -> None:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return _plain_times(fn(spark, sf_dir))

    assert name not in QUERIES, name
    QUERIES[name] = run
    if sql is not None:
        text = compose(sql)
        shown = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in dates] + [
            f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times]
        ORACLE[name] = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({text})" if shown else text


def query(name: str, sql: str | None = None, dates=(), times=()):
    def wrap(fn):
        register(name, fn, sql, dates, times)
        return fn
    return wrap
