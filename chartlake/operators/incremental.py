"""High-water marks and backlogs of the incremental load (LD-7 ... LD-12,
LD-14).  Each returns a DataFrame; nothing is collected to the driver."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake.functions import calendar as cal
from chartlake.operators.dims import Star
from chartlake.operators.landed_keys import anti_join
from chartlake.operators.ranges import batches, date_ranges


def latest_fact_date(star: Star) -> Column:
    """Scalar: latest date that has facts (any country)."""
    dated = star.fact.select("date_id").distinct().join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
    return dated.agg(F.max("date")).scalar()


def latest_weather_date(star: Star) -> Column:
    dated = star.dim_weather.select("date_id").distinct().join(
        star.calendar(star.dim_time.select("date_id", "date")), "date_id"
    )
    return dated.agg(F.max("date")).scalar()


def missing_chart_sundays(star: Star) -> DataFrame:
    """Sundays of the time dimension after the latest charted date (LD-7).

    Empty when there are no facts (the scalar is NULL).  Internal gaps are not
    looked for, as in the reference.
    """
    latest = latest_fact_date(star)
    return star.dim_time.filter((F.col("date") > latest) & cal.is_sunday("date")).select(
        "date", cal.api_noon_label("date").alias("api_date")
    )


def missing_weather_dates(star: Star) -> DataFrame:
    """Time-dimension dates after the latest weather date (LD-8)."""
    return star.dim_time.filter(F.col("date") > latest_weather_date(star)).select("date")


def missing_features(dim_track: DataFrame, cap: int | None = None) -> DataFrame:
    """Tracks without audio features (NULL danceability), by id (LD-9); with
    ``cap``, one fetch run's budget, only the first ones."""
    missing = dim_track.filter(F.col("danceability").isNull()).select("track_id").orderBy("track_id")
    return missing if cap is None else missing.limit(cap)


def weather_gap_ranges(star: Star) -> DataFrame:
    """Closed ranges of time-dimension dates without weather (LD-10 input)."""
    no_weather = star.dim_time.select("date_id", "date").join(
        star.dim_weather.select("date_id"), "date_id", "left_anti"
    )
    return date_ranges(no_weather, "date")


def missing_weather_ranges(star: Star) -> DataFrame:
    """Re-load ranges of the missing weather dates (LD-10)."""
    return date_ranges(missing_weather_dates(star), "date")


def feature_backlog(charts: DataFrame, landed: DataFrame | None = None, filters: DataFrame | None = None, blocks: int = 0) -> DataFrame:
    """Songs to fetch features for, newest first (LD-11).

    Per song: latest chart date, best position, total streams; songs already
    landed are removed (anti join; with the ``filters`` of the landed files only
    songs that may be landed take part in it).  Order: latest desc, position asc, id.
    """
    per_song = charts.groupBy("song_uuid").agg(
        F.max(F.col("chart_date").cast("date")).alias("latest_chart_date"),
        F.min("position").alias("best_position"),
        F.sum("streams").alias("total_streams"),
    )
    if landed is not None and filters is not None:
        per_song = anti_join(per_song, landed, "song_uuid", filters, blocks)
    elif landed is not None:
        per_song = per_song.join(landed.select("song_uuid").distinct(), "song_uuid", "left_anti")
    return per_song


def backlog_order() -> list[Column]:
    """Newest chart date first, then best position, then song id (total order)."""
    return [F.col("latest_chart_date").desc(), F.col("best_position").asc(), F.col("song_uuid").asc()]


def ordered_backlog(backlog: DataFrame) -> DataFrame:
    return backlog.orderBy(*backlog_order())


def backlog_head(backlog: DataFrame, n: int) -> DataFrame:
    """The first ``n`` songs of the ordered backlog: one fetch run's request
    budget (SO-8).  Plans as a top-k (TakeOrderedAndProject), no full sort."""
    return ordered_backlog(backlog).limit(n)


def backlog_batches(backlog: DataFrame, size: int = C.FEATURE_BATCH_SONGS) -> DataFrame:
    """Numbered fetch batches of ``size`` songs in backlog order (LD-15)."""
    return batches(backlog, backlog_order(), size)


def remaining_dates(
    available: DataFrame,
    landed: DataFrame | None,
    start: _dt.date,
    end: _dt.date,
    text_col: str = "api_date",
) -> DataFrame:
    """Chart dates still to land (LD-12): API texts parsed (SC-1), kept inside
    [first Sunday >= start, last Sunday <= end] (GEN-3, FL-9), de-duplicated
    (ST-4) and minus the dates already landed (JN-12)."""
    lo = cal.first_sunday_on_or_after(F.lit(start).cast("date"))
    hi = cal.last_sunday_on_or_before(F.lit(end).cast("date"))
    parsed = available.select(cal.parse_api_date(F.col(text_col)).alias("chart_date"), F.col(text_col).alias("api_date"))
    in_range = parsed.filter(F.col("chart_date").between(lo, hi))
    firsts = in_range.groupBy("chart_date").agg(F.min("api_date").alias("api_date"))
    if landed is not None:
        firsts = firsts.join(landed.select(F.col("chart_date").cast("date").alias("chart_date")), "chart_date", "left_anti")
    return firsts


def landed_dates(staged_charts: DataFrame | None) -> DataFrame | None:
    """Distinct chart dates already staged (SRC-8); None when nothing is staged."""
    if staged_charts is None:
        return None
    return staged_charts.select(F.col("chart_date").cast("date").alias("chart_date")).distinct()


def incremental_plan(star: Star) -> DataFrame:
    """What is still missing (LD-14), one row; a fetch run's cap does not enter the counts."""
    n_weather = missing_weather_dates(star).agg(F.count(F.lit(1))).scalar()
    n_sundays = missing_chart_sundays(star).agg(F.count(F.lit(1))).scalar()
    n_features = star.dim_track.agg(F.count_if(F.col("danceability").isNull())).scalar()
    one = star.dim_time.sparkSession.range(1)
    return one.select(
        n_weather.alias("missing_weather_dates"),
        n_sundays.alias("missing_chart_sundays"),
        n_features.alias("missing_features"),
        ((n_weather + n_sundays + n_features) == 0).alias("up_to_date"),
    )
