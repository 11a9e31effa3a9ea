"""Fiscal-year calendar (1 July to 30 June) and date tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fiscal_bounds(fy: str) -> tuple[dt.date, dt.date]:
    """``'18-19'`` to its first and last day; two-digit years from 70 on are
    in the twentieth century."""
    start = int(fy.split("-")[0])
    start += 1900 if start >= 70 else 2000
    return dt.date(start, 7, 1), dt.date(start + 1, 6, 30)


def fiscal_label(c: Column) -> Column:
    """Label such as ``'18-19'`` of the fiscal year that holds a date."""
    start = F.year(c) - F.when(F.month(c) >= 7, 0).otherwise(1)
    two = lambda y: F.lpad((y % 100).cast("string"), 2, "0")
    return F.concat(two(start), F.lit("-"), two(start + 1))


def fiscal_days(spark: SparkSession, fy: str, periods: int | None = None) -> DataFrame:
    """One row per day.

    With ``periods`` the year is cut into that many evenly spaced stamps
    instead: 365 stamps over a leap year leave out the day before the last.
    """
    first, last = fiscal_bounds(fy)
    span = (last - first).days
    steps = (periods - 1) if periods else span
    return spark.range(steps + 1).select(
        F.date_add(F.lit(first), F.floor(F.col("id") * span / steps).cast("int")).alias("day")
    )


def endpoint_in_range(
    start: Column, end: Column, first: dt.date, last: dt.date, periods: int | None = None
) -> Column:
    """True when either end of an interval is a day of the range.

    An interval that spans the whole range is not a match. ``periods`` tests
    against the evenly spaced stamps of :func:`fiscal_days`. Missing dates
    never match.
    """
    def inside(c: Column) -> Column:
        day = c.cast("date")
        hit = day.between(F.lit(first), F.lit(last))
        if periods:
            span = (last - first).days
            offset = F.datediff(day, F.lit(first))
            # offset is a stamp if some step s in 0..periods-1 floors to it
            step = F.ceil(offset * (periods - 1) / span)
            hit = hit & (F.floor(step * span / (periods - 1)) == offset)
        return F.coalesce(hit, F.lit(False))

    return inside(start) | inside(end)
