"""Small column expressions shared by the operators. All are JVM built-ins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equality join on ``keys`` in which null meets null; the key columns of ``left`` are kept."""
    names = {k: f"_right_{k}" for k in keys}
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(ts: str | Column) -> Column:
    """Microseconds since the epoch; the session runs in UTC."""
    return F.unix_micros(as_col(ts).cast("timestamp"))


def plus_micros(ts: str | Column, n: int | Column) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add("MICROSECOND", n.cast("bigint"), as_col(ts))


def seconds_between(later: str | Column, earlier: str | Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def number_or_zero(c: str | Column) -> Column:
    """Text to double; empty, absent or unreadable text counts as 0.

    Empty text is common and not cast: each failed cast throws an exception inside.
    """
    return F.coalesce(F.when(as_col(c).cast("string") != "", as_col(c).try_cast("double")), F.lit(0.0))


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(as_col(c), F.lit(""))


def is_absent(c: str | Column) -> Column:
    """The text convention for "no value": empty or null."""
    return text_or_empty(c) == ""


def ratio(num: Column, den: Column, places: int = 4) -> Column:
    """``num / den`` rounded, 0 when the denominator is 0 or absent."""
    return F.round(F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0)), places)


def share_of(cond: Column, places: int = 4) -> Column:
    """Share of rows meeting ``cond``, as an aggregate."""
    return ratio(F.count_if(cond), F.count(F.lit(1)), places)


def ntz(text: str) -> Column:
    """A zone-free timestamp literal from ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.lit(text).cast("timestamp_ntz")


def within_half_open(ts: str | Column, start: Column, end: Column) -> Column:
    return (as_col(ts) >= start) & (as_col(ts) < end)


def minute_of(ts: str | Column) -> Column:
    return grid_floor(ts, 60)


def grid_floor(ts: str | Column, step_seconds: int) -> Column:
    """Start of the ``step_seconds`` slot that holds ``ts``, as a zone-free timestamp."""
    step = step_seconds * 1_000_000
    at = micros(ts)
    return F.timestamp_micros(at - F.pmod(at, F.lit(step))).cast("timestamp_ntz")


def half_up(c: str | Column, places: int) -> Column:
    """Round half up in plain double arithmetic, so that every engine gets the same digits."""
    scale = float(10**places)
    return F.floor(as_col(c) * scale + 0.5) / scale
