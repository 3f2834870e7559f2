"""Time helpers that do not depend on the session time zone for zone-less timestamps."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def newest(df: DataFrame, ts: str = "ts") -> Column:
    """``max(ts)`` as a scalar subquery: evaluated once, no join."""
    return df.agg(F.max(ts)).scalar()


def moment(value: dt.datetime | Column | None, df: DataFrame, ts: str = "ts", day: str | None = None) -> Column:
    """The end of a look-back window. ``None`` means the newest row, looked for in the newest ``day`` if one is named."""
    if value is None:
        return newest(last_day(df, day), ts)
    return value if isinstance(value, Column) else F.lit(value)


def last_day(df: DataFrame, day: str | None) -> DataFrame:
    """Rows of the newest day; all rows if no day column is named."""
    return df if day is None else df.where(F.col(day) == df.agg(F.max(day)).scalar())


def hours_before(
    df: DataFrame, hours: float, as_of: dt.datetime | Column | None = None, ts: str = "ts", day: str | None = None
) -> Column:
    """Start of a look-back window. The subtraction is part of the subquery, so that the filter
    compares with a plain value the scan can use."""
    span = F.make_dt_interval(hours=F.lit(int(hours)), secs=F.lit((hours % 1) * 3600))
    if as_of is None:
        return last_day(df, day).agg(F.max(ts) - span).scalar()
    return moment(as_of, df, ts) - span


def since(
    df: DataFrame,
    hours: float,
    as_of: dt.datetime | Column | None = None,
    ts: str = "ts",
    day: str | None = None,
) -> DataFrame:
    """Rows newer than ``as_of - hours``. ``day`` names a date partition column to prune by."""
    cutoff = hours_before(df, hours, as_of, ts, day)
    out = df.where(F.col(ts) > cutoff)
    if day:
        out = out.where(F.col(day) >= F.to_date(cutoff))
    return out


def micros(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)


def second_of(value: dt.datetime) -> int:
    """Epoch seconds of a zone-less moment, rounded down."""
    return calendar.timegm(value.timetuple())


def at_second(seconds: Column) -> Column:
    """Zone-less timestamp from epoch seconds."""
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def hour_text(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, "yyyy-MM-dd HH:00:00")


def tick_after(ts: Column | str, step_seconds: int) -> Column:
    """First multiple of the step at or after ``ts``, in epoch seconds (cells are left-open)."""
    at = micros(ts)
    up = at + F.pmod(-at, F.lit(step_seconds * 1_000_000))
    return (up / 1_000_000).cast("long")
