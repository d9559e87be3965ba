"""Inline relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values(spark: SparkSession, ddl: str, rows: list[tuple]) -> DataFrame:
    """A VALUES relation with declared types. It has exact statistics, so Spark can choose to broadcast it."""
    columns = [part.strip().split(None, 1) for part in ddl.split(",")]
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"`{name}`" for name, _ in columns)
    casts = ", ".join(f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in columns)
    return spark.sql(f"SELECT {casts} FROM VALUES {body} AS t({names})")
