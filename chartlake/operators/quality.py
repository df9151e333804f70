"""Data-quality rules and load summaries (validation step of the full load).

One aggregate per table, combined through scalar sub-queries into a small
rules table; ratios use ``try_divide`` so empty tables give NULL instead of
failing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake.functions import scalars as sc
from chartlake.operators.dims import Star


def _count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def table_counts(star: Star) -> dict[str, Column]:
    """Row counts as scalar sub-queries: one aggregate (one scan) per table."""
    facts = star.fact.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count("weather_id").alias("with_weather"))
    ).scalar()
    tracks = star.dim_track.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.count("danceability").alias("with_features"))
    ).scalar()
    return {
        "time_rows": _count(star.dim_time),
        "weather_rows": _count(star.dim_weather),
        "track_rows": tracks.getField("n"),
        "tracks_with_features": tracks.getField("with_features"),
        "fact_rows": facts.getField("n"),
        "facts_with_weather": facts.getField("with_weather"),
    }


def dq_report(star: Star, expected_days: Column | int) -> DataFrame:
    """Rules table (rule, severity, actual, threshold, passed)."""
    c = table_counts(star)
    exp = expected_days if isinstance(expected_days, Column) else F.lit(expected_days)
    coverage = sc.ratio(c["tracks_with_features"], c["track_rows"])
    linkage = sc.ratio(c["facts_with_weather"], c["fact_rows"])

    def rule(name: str, severity: str, actual: Column, threshold: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"),
            F.lit(severity).alias("severity"),
            actual.cast("double").alias("actual"),
            threshold.cast("double").alias("threshold"),
            F.coalesce(passed, F.lit(False)).alias("passed"),
        )

    rules = [
        rule("time_rows_expected", "error", c["time_rows"], exp, c["time_rows"] == exp),
        rule("weather_rows_min", "error", c["weather_rows"], F.lit(C.MIN_WEATHER_ROWS), c["weather_rows"] >= C.MIN_WEATHER_ROWS),
        rule("fact_rows_nonzero", "error", c["fact_rows"], F.lit(0), c["fact_rows"] > 0),
        rule("track_rows_min", "warning", c["track_rows"], F.lit(C.MIN_TRACK_ROWS), c["track_rows"] >= C.MIN_TRACK_ROWS),
        rule("feature_coverage_min", "warning", coverage, F.lit(C.MIN_FEATURE_COVERAGE), coverage >= C.MIN_FEATURE_COVERAGE),
        rule("weather_linkage_min", "warning", linkage, F.lit(C.MIN_WEATHER_LINKAGE), linkage >= C.MIN_WEATHER_LINKAGE),
    ]
    return star.dim_time.sparkSession.range(1).select(F.inline(F.array(*rules)))


def dq_passed(report: DataFrame) -> DataFrame:
    """One row: true when no rule of severity ``error`` failed."""
    return report.agg(
        F.coalesce(F.bool_and(F.col("passed") | (F.col("severity") != "error")), F.lit(True)).alias("passed"),
        F.count(F.when(~F.col("passed") & (F.col("severity") == "error"), 1)).alias("errors"),
        F.count(F.when(~F.col("passed") & (F.col("severity") == "warning"), 1)).alias("warnings"),
    )


def load_summary(star: Star) -> DataFrame:
    """Tracks, feature coverage %, facts, weather-linked % (one row)."""
    c = table_counts(star)
    return star.dim_time.sparkSession.range(1).select(
        c["track_rows"].alias("tracks"),
        c["tracks_with_features"].alias("tracks_with_features"),
        sc.percent_of(c["tracks_with_features"], c["track_rows"]).alias("feature_pct"),
        c["fact_rows"].alias("facts"),
        c["facts_with_weather"].alias("facts_with_weather"),
        sc.percent_of(c["facts_with_weather"], c["fact_rows"]).alias("weather_pct"),
    )


def staging_summary(charts: DataFrame, features: DataFrame) -> DataFrame:
    """Staged chart rows, date range, distinct songs and staged feature rows."""
    feats = features.agg(
        F.struct(F.count(F.lit(1)).alias("rows"), F.count_distinct("song_uuid").alias("songs"))
    ).scalar()
    n_features, n_feature_songs = feats.getField("rows"), feats.getField("songs")
    return charts.agg(
        F.count(F.lit(1)).alias("chart_rows"),
        F.min(F.col("chart_date").cast("date")).alias("first_chart_date"),
        F.max(F.col("chart_date").cast("date")).alias("last_chart_date"),
        F.count_distinct(F.col("chart_date").cast("date")).alias("chart_weeks"),
        F.count_distinct("song_uuid").alias("distinct_songs"),
    ).select("*", n_features.alias("feature_rows"), n_feature_songs.alias("feature_songs"))
