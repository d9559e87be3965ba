"""Column helpers shared by every plan: casts, rates, dates, predicates. All stay inside Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from . import codes

ALL = "All"


# casts -------------------------------------------------------------------------------------------------------------

def int_from_text(c: Column, kind: str = "bigint") -> Column:
    """Text to integer; decimal text is rounded half up, unreadable text becomes NULL."""
    return F.coalesce(c.try_cast(kind), F.round(c.try_cast("double")).try_cast(kind))


def int_from_double(c: Column, kind: str = "int") -> Column:
    """Double to integer with ties to even (a plain Spark cast would truncate)."""
    return F.rint(c).cast(kind)


def stat_value(c: Column) -> Column:
    """Statistic text to double: true/false count as 1/0, other text as NULL."""
    return F.when(c == "true", F.lit(1.0)).when(c == "false", F.lit(0.0)).otherwise(c.try_cast("double"))


def from_text(c: Column, kind: str) -> Column:
    """Cast a JSON text leaf to the declared column type."""
    if kind == "string":
        return c
    if kind in ("int", "bigint"):
        return int_from_text(c, kind)
    if kind == "stat":
        return stat_value(c)
    if kind == "timestamp":
        return c.try_cast("timestamp_ntz")
    return c.try_cast(kind)


# rates -------------------------------------------------------------------------------------------------------------

def rounded(c: Column, digits: int) -> Column:
    """Round a double half away from zero on its binary value.

    Scaling first keeps the arithmetic in doubles; Spark's two-argument ``round`` goes through the decimal text of the
    number and lands on the other side for values such as 0.145.
    """
    if digits == 0:
        return F.round(c)
    scale = F.lit(float(10 ** digits))
    return F.round(c * scale) / scale


def ratio(num: Column, den: Column, digits: int | None = None, scale: float = 1.0) -> Column:
    """scale * num / den as a double, NULL when the denominator is 0."""
    top = num.cast("double") if scale == 1.0 else F.lit(float(scale)) * num.cast("double")
    value = top / F.nullif(den.cast("double"), F.lit(0.0))
    return value if digits is None else rounded(value, digits)


def percent(num: Column, den: Column, digits: int | None = 1) -> Column:
    return ratio(num, den, digits, 100.0)


def per90(num: Column, minutes: Column, digits: int | None = 2) -> Column:
    return ratio(num, minutes, digits, 90.0)


def weighted(terms: Iterable[tuple[Column, int]], den: Column, digits: int | None = None) -> Column:
    """Weighted composite index: sum(weight * term) / den."""
    total = None
    for term, weight in terms:
        piece = term if weight == 1 else term * F.lit(weight)
        total = piece if total is None else total + piece
    return ratio(total, den, digits)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, value: Column | None = None) -> Column:
    return F.sum(F.when(condition, F.lit(1) if value is None else value).otherwise(F.lit(0)))


# dates -------------------------------------------------------------------------------------------------------------

def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def season_tag(name: Column) -> Column:
    """'2024/2025' -> '2024/25'."""
    return F.concat(F.left(name, F.lit(4)), F.lit("/"), F.right(name, F.lit(2)))


def short_season(tag: Column) -> Column:
    """'2024/25' -> '24/25'."""
    return F.concat(F.substring(tag, 3, 2), F.lit("/"), F.right(tag, F.lit(2)))


def local_time(ts_utc: Column, zone: str = codes.LOCAL_ZONE) -> Column:
    """UTC wall-clock timestamp to the wall clock of ``zone``; independent of the session time zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc.cast("timestamp_ntz"))


# predicates --------------------------------------------------------------------------------------------------------

def is_finished(state: Column) -> Column:
    return state.isin(*codes.FINISHED_STATES)


def played(result: Column | None = None) -> Column:
    return (F.col("result") if result is None else result).isin(*codes.PLAYED_RESULTS)


def any_of(column: Column, choices) -> Column:
    """Multi-select parameter; 'All' switches the filter off."""
    picks = [choices] if isinstance(choices, str) else list(choices)
    return F.lit(True) if ALL in picks else column.isin(*picks)


def recent_date_key(column: Column, days_back: int, as_of: str | None = None, days_forward: int | None = None) -> Column:
    """date_sk inside a rolling window around ``as_of`` (today when not given)."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    keep = column >= date_key(F.date_sub(today, days_back))
    return keep if days_forward is None else keep & (column <= date_key(F.date_add(today, days_forward)))
