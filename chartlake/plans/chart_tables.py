"""Chart-ready tables: the data half of the dashboard figures.

Figures themselves are not drawn; each function returns the rows a plotting
layer would consume, built from the marts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake.functions import calendar as cal
from chartlake.functions import scalars as sc
from chartlake.operators.dims import Star
from chartlake.plans import marts as M


def top_cards(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Rank, title, artist, cover and a truncated ``123K`` stream label."""
    top = M.current_top_tracks(star, cfg)
    return top.select(
        F.col("position").alias("rank"),
        F.col("track_name").alias("title"),
        F.col("artist_names").alias("artist"),
        "image_url",
        "streams",
        sc.thousands_label("streams").alias("streams_label"),
        "chart_date",
    )


def weekly_trend_labels(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Weekly changes with up / down / flat labels (thresholds per kind)."""
    w = M.weekly_feature_changes(star, cfg)
    thr = F.when(F.col("metric_kind") == "weather", F.lit(C.WEATHER_TREND_THRESHOLD)).otherwise(
        F.lit(C.FEATURE_TREND_THRESHOLD)
    )
    d = F.col("change")
    return w.select("metric_kind", "metric", "current", "previous", "change", "change_pct",
                    F.abs(d).alias("abs_change"), sc.trend_label(d, thr, cfg.labels).alias("trend"))


def season_series(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Season mart in long form: (season_order, season, feature, value, entries, tracks)."""
    wide = M.audio_features_by_season(star, cfg)
    long = wide.unpivot(
        ["season", "chart_entries", "unique_tracks"], list(M.SEASON_FEATURES), "feature", "value"
    )
    return long.select(
        cal.season_rank("season", cfg.labels).alias("season_order"), "season", "feature", "value",
        "chart_entries", "unique_tracks",
    )


def season_totals(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Total entries and the sum of per-season distinct tracks (not a distinct
    count overall, as the figure subtitle shows)."""
    return M.audio_features_by_season(star, cfg).agg(
        F.sum("chart_entries").alias("total_entries"), F.sum("unique_tracks").alias("total_unique")
    )


def axis_ranges(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Tempo axis [min*0.95, max*1.05]; loudness axis [min*1.1, max*0.9]."""
    return M.audio_features_by_season(star, cfg).agg(
        (F.min("tempo") * 0.95).alias("tempo_lo"),
        (F.max("tempo") * 1.05).alias("tempo_hi"),
        (F.min("loudness") * 1.1).alias("loudness_lo"),
        (F.max("loudness") * 0.9).alias("loudness_hi"),
    )


def weather_series(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Weather-category mart in long form."""
    wide = M.audio_features_by_weather(star, cfg)
    keep = ["weather_category", "avg_sunshine", "avg_precipitation", "avg_temperature", "chart_entries", "unique_tracks"]
    return wide.unpivot(keep, list(M.SEASON_FEATURES), "feature", "value").withColumn(
        "category_order", sc.label_rank("weather_category", cfg.labels.week_weather_order)
    )


def top_keys(star: Star, cfg: C.MartConfig = C.DEFAULT_MART, k: int = 10) -> DataFrame:
    """Rows of the key distribution for the ``k`` key names with the most
    entries (ties by name)."""
    dist = M.key_distribution(star, cfg)
    totals = dist.groupBy("key_name").agg(F.sum("track_count").alias("total"))
    best = totals.orderBy(F.col("total").desc(), F.col("key_name").asc()).limit(k)
    return dist.join(best.select("key_name"), "key_name", "left_semi")


def sunshine_series(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Sunshine mart ordered by exact sunshine, values in percent."""
    s = M.danceability_by_sunshine(star, cfg)
    return s.select(
        "sunshine_hours",
        "exact_sunshine",
        (F.col("avg_danceability") * 100).alias("danceability_pct"),
        (F.col("avg_valence") * 100).alias("valence_pct"),
        F.row_number().over(Window.orderBy("exact_sunshine", "sunshine_hours")).alias("point_order"),
    )


def period_bars(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Period comparison ordered by |diff_pct| descending."""
    p = M.period_comparison(star, cfg)
    return p.select(
        "*",
        F.row_number().over(Window.orderBy(F.abs("diff_pct").desc_nulls_last(), "feature")).alias("bar_order"),
    )


def seasonal_bars(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Seasonal trend as bars in the order of the months, each with its label and
    its share of its season's streams (at most 12 rows meet the windows)."""
    t = M.seasonal_streaming_trends(star, cfg)
    return t.select(
        "season", "month", "total_streams",
        sc.number_label("total_streams").alias("bar_label"),
        sc.ratio("total_streams", F.sum("total_streams").over(Window.partitionBy("season"))).alias("season_share"),
        F.row_number().over(Window.orderBy("month", "season")).alias("bar_order"),
    )


def acoustic_bars(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Acoustic mart as grouped bars: a group per weather (highest bar first, the
    group without weather last), a bar per track type inside it (at most 9 rows)."""
    bars = M.acoustic_vs_electronic(star, cfg)
    highest = F.max("avg_streams").over(Window.partitionBy("weather"))
    return bars.withColumn("_highest", highest).select(
        "weather", "track_type", "avg_streams", "sample_size",
        sc.number_label("avg_streams", 1).alias("bar_label"),
        F.dense_rank().over(Window.orderBy(F.col("weather").isNull(), F.col("_highest").desc_nulls_last(), "weather")).alias("group_order"),
        F.row_number().over(Window.partitionBy("weather").orderBy("track_type")).alias("bar_order"),
    )
