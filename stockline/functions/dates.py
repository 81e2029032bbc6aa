"""Calendar expressions, and the few date values a driver program needs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockline import spec


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value))


def month_end(value: str | dt.date) -> dt.date:
    day = as_date(value)
    first_of_next = (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return first_of_next - dt.timedelta(days=1)


def shift_days(value: str | dt.date, days: int) -> dt.date:
    return as_date(value) + dt.timedelta(days=days)


def shift_months(value: str | dt.date, months: int) -> dt.date:
    """Month end of the month ``months`` later."""
    day = as_date(value)
    count = day.year * 12 + day.month - 1 + months
    return month_end(dt.date(count // 12, count % 12 + 1, 1))


def month_ends(start: str | dt.date, end: str | dt.date) -> list[dt.date]:
    """Every month end from the month of ``start`` to the month of ``end``."""
    first, last = month_end(start), month_end(end)
    span = (last.year - first.year) * 12 + last.month - first.month
    return [shift_months(first, n) for n in range(span + 1)]


def month_end_of(date: Column) -> Column:
    return F.last_day(date)


def month_shifted(date: Column, months: int) -> Column:
    return F.last_day(F.add_months(date, months))


def with_calendar(df: DataFrame, date: str = spec.DATE) -> DataFrame:
    """Add the calendar parts of ``date``; weeks are ISO weeks, Sunday is day 1."""
    day = F.col(date)
    return df.withColumns({
        "Yearday": F.dayofyear(day),
        "Month": F.month(day),
        "DayOfWeek": F.dayofweek(day),
        "DayOfMonth": F.dayofmonth(day),
        "Year": F.year(day),
        "Quarter": F.quarter(day),
        "WeekOfYear": F.weekofyear(day),
        "MonthQuarter": F.ceil(F.month(day) / 3),
    })


def with_month_end(df: DataFrame, date: str = spec.DATE, month: str = spec.MONTH) -> DataFrame:
    return df.withColumn(month, F.last_day(date))


def month_calendar(bounds: DataFrame, start: str, end: str, out: str = spec.MONTH) -> DataFrame:
    """One row per month end between the two date columns of a one-row frame."""
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("interval 1 month"))
    return bounds.select(F.explode(months).alias("first_day")).select(
        F.last_day("first_day").alias(out))


def calendar_between(spark: SparkSession, start: str | dt.date, end: str | dt.date,
                     out: str = spec.MONTH) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(as_date(start)).alias("start"), F.lit(as_date(end)).alias("end"))
    return month_calendar(bounds, "start", "end", out)
