"""Periods, weeks and month names."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Spanish month names, January first.
MONTH_NAMES = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)


def week_of_year(date: Column) -> Column:
    """Week number: week 1 holds January 1, weeks begin on Sunday."""
    lead = F.dayofweek(F.trunc(date, "year")) - 1  # days of week 1 before January 1
    return (F.floor((F.dayofyear(date) - 1 + lead) / 7) + 1).cast("int")


def month_start_by_name(date: Column, name: Column) -> Column:
    """First day of the named month in the year of ``date``; NULL if unknown."""
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    number = F.nullif(F.array_position(names, F.lower(F.rtrim(name))), F.lit(0).cast("bigint"))
    return F.make_date(F.year(date), number.cast("int"), F.lit(1))


def previous_month(month: Column) -> Column:
    return F.when(month == 1, 12).otherwise(month - 1).cast("int")


def previous_year(month: Column, year: Column) -> Column:
    return F.when(month == 1, year - 1).otherwise(year).cast("int")


def month_index(date: Column) -> Column:
    """Months counted through: neighbours differ by one."""
    return (F.year(date) * 12 + F.month(date) - 1).cast("int")


def month_number(year: int, month: int) -> int:
    """``month_index`` of a period."""
    return year * 12 + month - 1


def index_year(index: Column) -> Column:
    return F.floor(index / 12).cast("int")


def index_month(index: Column) -> Column:
    return (index % 12 + 1).cast("int")


def month_indexes(periods: Sequence[tuple[int, int]]) -> Column:
    """Array of the periods' indexes, one sequence for each run of neighbouring months."""
    runs: list[list[int]] = []
    for index in sorted({month_number(*period) for period in periods}):
        if runs and index == runs[-1][1] + 1:
            runs[-1][1] = index
        else:
            runs.append([index, index])
    none = F.array().cast("array<int>")
    return F.concat(none, *[F.sequence(F.lit(a), F.lit(b)) for a, b in runs])


def parse_day_month_year(text: Column) -> Column:
    return F.try_to_date(F.trim(text), "d/M/yyyy")


def within(date: Column, first: dt.date, last: dt.date) -> Column:
    """Both ends included; a plain range, so it reaches the file scan."""
    return (date >= F.lit(first)) & (date < F.lit(last + dt.timedelta(days=1)))


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    following = dt.date(year + month // 12, month % 12 + 1, 1)
    return dt.date(year, month, 1), following - dt.timedelta(days=1)


def previous_period(year: int, month: int) -> tuple[int, int]:
    return (year - 1, 12) if month == 1 else (year, month - 1)


def session_date(spark: SparkSession) -> dt.date:
    """Today in the session's time zone; no job is run for it."""
    return spark.sql("SELECT current_date()").first()[0]


def resolve_period(
    year: int | None, month: int | None, today: dt.date | None = None
) -> tuple[int, int]:
    """The given period, or the month before today if a part is missing."""
    if year is not None and month is not None:
        return year, month
    if today is None:
        raise ValueError("a period without year or month needs the day it is run on")
    return previous_period(today.year, today.month)
