"""Join helpers for the star schema.

Size rule: tables with one row per calendar day (``dim_time``, whose ``date``
is unique, and aggregates by date) are bounded by the calendar span, not by
the data volume: ~365 rows a year, a few dozen bytes each.  They are broadcast
explicitly, after checking the span against a row budget.  ``dim_weather``
(nothing makes its rows unique per date) and ``dim_track`` are never hinted:
the static planner or AQE picks broadcast or shuffle join from measured sizes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# One row per day for 30 years is ~11k rows; a calendar table above this
# budget is joined by shuffle instead of broadcast.
CALENDAR_ROW_BUDGET = 40_000


@dataclass(frozen=True)
class Star:
    """The four warehouse tables (lazy DataFrames).

    ``calendar_days`` is the number of days the time dimension spans, read
    from metadata when the star is built or opened; it bounds the size of
    every per-day table, and :meth:`calendar` uses it to decide between a
    broadcast and a shuffle join.
    """

    dim_time: DataFrame
    dim_track: DataFrame
    dim_weather: DataFrame
    fact: DataFrame
    calendar_days: int | None = None

    def calendar(self, df: DataFrame) -> DataFrame:
        """Join side for a per-day table of this star (see :func:`calendar_side`)."""
        return calendar_side(df, self.calendar_days)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_time": self.dim_time,
            "dim_track": self.dim_track,
            "dim_weather": self.dim_weather,
            "fact_track_chart": self.fact,
        }


def calendar_side(df: DataFrame, span_days: int | None = None) -> DataFrame:
    """Join side for a table with at most one row per calendar day.

    ``span_days`` is the number of days the calendar covers (an upper bound of
    the table's rows).  Within :data:`CALENDAR_ROW_BUDGET` the table is
    broadcast; above it the join is left to the planner (sort-merge or
    shuffle-hash, AQE may still convert it), and so it is when the span is
    unknown (``None``).
    """
    if span_days is None or span_days > CALENDAR_ROW_BUDGET:
        return df
    return F.broadcast(df)


def by_country(fact: DataFrame, country: str | None) -> DataFrame:
    """Optional country filter (FL-1): applied only when a country is given."""
    return fact if not country else fact.filter(F.col("country") == country)


def one_weather_per_date(dim_weather: DataFrame) -> DataFrame:
    """date_id -> weather_id lookup with one row per date.

    Nothing in the schema stops two weather rows for one date; the lookup
    keeps the highest weather_id (deterministic, unlike a last-read dict).
    The grouping is partial-aggregated map side, so a hot date cannot pile up
    in one task.
    """
    return dim_weather.groupBy("date_id").agg(F.max("weather_id").alias("weather_id"))
