"""Calendar expressions (GEN-*, SC-1, SC-2): date keys, seasons, Sundays,
date spines and date labels.  All built-in Column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import config as C

SUNDAY = 6  # weekday(): Monday = 0 ... Sunday = 6


def as_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (_dt.date, _dt.datetime)):
        return F.lit(x).cast("date")
    return F.col(x)


def date_key(d) -> Column:
    """Deterministic surrogate key ``yyyymmdd`` (int)."""
    d = as_col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def season(month, labels: C.Labels = C.Labels()) -> Column:
    """Meteorological season of a month number."""
    m = as_col(month)
    return (
        F.when(m.isin(*C.WINTER_MONTHS), F.lit(labels.winter))
        .when(m.isin(*C.SPRING_MONTHS), F.lit(labels.spring))
        .when(m.isin(*C.SUMMER_MONTHS), F.lit(labels.summer))
        .otherwise(F.lit(labels.autumn))
    )


def season_rank(season_col, labels: C.Labels = C.Labels()) -> Column:
    """Sort key spring, summer, autumn, winter; unknown labels last."""
    s = as_col(season_col)
    expr = None
    for i, name in enumerate(labels.season_order):
        expr = (F.when(s == name, F.lit(i)) if expr is None else expr.when(s == name, F.lit(i)))
    return expr.otherwise(F.lit(len(labels.season_order)))


def is_sunday(d) -> Column:
    return F.weekday(as_col(d)) == SUNDAY


def first_sunday_on_or_after(d) -> Column:
    return F.next_day(F.date_sub(as_col(d), 1), "SU")


def last_sunday_on_or_before(d) -> Column:
    return F.date_sub(F.next_day(as_col(d), "SU"), 7)


def sunday_on_or_after(d) -> Column:
    """Same as :func:`first_sunday_on_or_after`, written with ``weekday``."""
    d = as_col(d)
    return F.date_add(F.to_date(d), (F.lit(SUNDAY) - F.weekday(d)).cast("int"))


def parse_api_date(s) -> Column:
    """ISO text such as ``2024-01-07T00:00:00+00:00`` -> date (first 10 chars)."""
    return F.to_date(F.substring(as_col(s), 1, 10))


def iso_label(d) -> Column:
    return F.date_format(as_col(d), "yyyy-MM-dd")


def day_month_label(d) -> Column:
    return F.date_format(as_col(d), "dd.MM")


def day_month_year_label(d) -> Column:
    return F.date_format(as_col(d), "dd.MM.yyyy")


def period_label(start, end) -> Column:
    """``dd.MM - dd.MM.yyyy``"""
    return F.concat(day_month_label(start), F.lit(" - "), day_month_year_label(end))


def api_noon_label(d) -> Column:
    """Date -> ``yyyy-MM-ddT12:00:00+00:00`` (the API's ranking-date text)."""
    return F.concat(iso_label(d), F.lit("T12:00:00+00:00"))


def dim_time_rows(days: DataFrame, date_col: str = "date", labels: C.Labels = C.Labels()) -> DataFrame:
    """Rows of the time dimension for a DataFrame of distinct dates."""
    d = F.col(date_col)
    return days.select(
        date_key(d).alias("date_id"),
        d.cast("date").alias("date"),
        F.month(d).alias("month"),
        season(F.month(d), labels).alias("season"),
    )


def date_spine(bounds: DataFrame, start: str = "start", end: str = "end", name: str = "date") -> DataFrame:
    """One row per day in every closed range [start, end] of ``bounds``.

    ``bounds`` holds few rows (date ranges), so the explode is cheap; the
    output is one row per calendar day.
    """
    return bounds.select(
        F.explode(F.sequence(F.col(start).cast("date"), F.col(end).cast("date"), F.expr("interval 1 day"))).alias(name)
    )


def span_days(start, end) -> Column:
    """Number of days in the closed range (EXPECTED_DAYS)."""
    return F.datediff(as_col(end), as_col(start)) + 1


def span_years(start, end) -> Column:
    """Array of the calendar years touched by the range (YEARS)."""
    return F.sequence(F.year(as_col(start)), F.year(as_col(end)))


def literal_range(spark: SparkSession, start: _dt.date, end: _dt.date) -> DataFrame:
    """A one-row DataFrame holding a closed date range given by parameters."""
    return spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
