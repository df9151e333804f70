"""The ten analytical marts (Q1 ... Q10) over the star schema.

Each mart is one lazy DataFrame.  Scalar sub-queries ("the latest chart
date") stay inside the plan as ``DataFrame.scalar()`` sub-queries, which
Spark runs once and pushes into the scans as runtime filters; the
"one query per chart date" loops become joins; "the same query with another
constant" becomes conditional aggregation over a single scan.

Marts that look up the tracks of facts first reduce the facts to one row per
track and group (map-side combined), so a hit song reaches the track join as a
few rows, and then take means weighted by the number of entries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake.functions import calendar as cal
from chartlake.functions import scalars as sc
from chartlake.operators.dims import Star, by_country
from chartlake.operators.ranges import trailing_window

SEASON_FEATURES = ("danceability", "energy", "instrumentalness", "loudness", "valence", "tempo", "acousticness")
WEEKLY_FEATURES = ("valence", "danceability", "energy", "tempo", "acousticness")
WEEKLY_WEATHER = (("temperature", "temperature_avg"), ("sunshine", "sunshine_hours"), ("precipitation", "precipitation_mm"))
PERIOD_FEATURES = (("Valence", "valence"), ("Energy", "energy"), ("Danceability", "danceability"))


def _inline(rows: list[Column]) -> Column:
    """Explode a fixed list of structs into rows (unpivot of a 1-row frame)."""
    return F.inline(F.array(*rows))


def latest_chart_date_id(star: Star, country: str | None) -> Column:
    """Scalar sub-query: date_id of the latest chart with a time row."""
    dated = by_country(star.fact, country).join(
        star.calendar(star.dim_time.select("date_id")), "date_id", "left_semi"
    )
    return dated.agg(F.max("date_id")).scalar()


def weighted_mean(value, n) -> Column:
    """Mean of ``value`` over rows that stand for ``n`` entries each; NULL values do not count."""
    v, n = cal.as_col(value), cal.as_col(n)
    return F.try_divide(F.sum(v * n), F.sum(F.when(v.isNotNull(), n)).cast("double"))


# --- Q1 ---------------------------------------------------------------------------

def kpis(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Headline figures, one row (Q1).

    Streams, unique tracks and feature coverage honour the country; the mean
    temperature and the chart date range do not (as in the reference).
    Facts are reduced to one row per track before the track join.
    """
    per_track = by_country(star.fact, cfg.country).groupBy("track_id").agg(
        F.sum("stream_count").alias("streams")
    )
    featured = star.dim_track.select("track_id", "danceability")
    joined = per_track.join(featured, "track_id", "left")
    avg_temp = star.dim_weather.agg(F.avg("temperature_avg")).scalar()
    charted_dates = star.fact.select("date_id").distinct().join(
        star.calendar(star.dim_time.select("date_id", "date")), "date_id"
    )
    span = charted_dates.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    first_date, last_date = span.getField("lo"), span.getField("hi")
    agg = joined.agg(
        sc.zero_if_null(F.sum("streams")).cast("long").alias("total_streams"),
        F.count(F.lit(1)).alias("unique_tracks"),
        F.count(F.when(F.col("danceability").isNotNull(), F.lit(1))).alias("tracks_with_features"),
    )
    return agg.select(
        "total_streams",
        sc.compact_count("total_streams").alias("total_streams_label"),
        "unique_tracks",
        sc.zero_if_null(avg_temp).cast("double").alias("avg_temp"),
        "tracks_with_features",
        F.when(F.col("unique_tracks") > 0, F.col("tracks_with_features") / F.col("unique_tracks") * 100.0)
        .otherwise(F.lit(0.0))
        .alias("feature_coverage_pct"),
        first_date.alias("first_chart_date"),
        last_date.alias("last_chart_date"),
        F.coalesce(F.concat(first_date.cast("string"), F.lit(" - "), last_date.cast("string")), F.lit("N/A"))
        .alias("date_range"),
    )


# --- Q2 ---------------------------------------------------------------------------

def current_top_tracks(star: Star, cfg: C.MartConfig = C.DEFAULT_MART, country: str | None = "__cfg__") -> DataFrame:
    """Top tracks of the latest chart for a country (Q2); ties broken by track id."""
    ctry = cfg.country if country == "__cfg__" else country
    latest = latest_chart_date_id(star, ctry)
    week = by_country(star.fact, ctry).filter(F.col("date_id") == latest)
    return (
        week.join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
        .join(star.dim_track.select("track_id", "track_name", "artist_names", "image_url"), "track_id")
        .select(
            "track_name",
            "artist_names",
            "image_url",
            F.col("stream_count").alias("streams"),
            F.col("chart_position").alias("position"),
            F.col("date").alias("chart_date"),
            "track_id",
        )
        .orderBy(F.col("position").asc_nulls_first(), "track_id")
        .limit(cfg.top_limit)
        .drop("track_id")
    )


def latest_chart_tops(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Top tracks of each country's own latest chart (WN-5); ``cfg.country`` None takes all countries.

    The latest date of a country is a map-side combined maximum; its chart is cut
    to the first ``top_limit`` rows by a ranking that every task cuts to that many
    rows a country before they are shuffled, so a hot country is no hot task."""
    dated = by_country(star.fact, cfg.country).join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
    latest = dated.groupBy("country").agg(F.max("date_id").alias("date_id"))
    place = F.row_number().over(Window.partitionBy("country").orderBy(F.col("chart_position").asc_nulls_first(), "track_id"))
    top = dated.join(latest, ["country", "date_id"]).withColumn("place", place).filter(F.col("place") <= cfg.top_limit)
    return top.join(star.dim_track.select("track_id", "track_name", "artist_names", "image_url"), "track_id").select(
        "country", "place", "track_name", "artist_names", "image_url", F.col("stream_count").alias("streams"),
        F.col("chart_position").alias("position"), F.col("date").alias("chart_date"))


# --- Q3 ---------------------------------------------------------------------------

def weekly_feature_changes(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Latest chart vs the chart exactly seven days earlier (Q3), long form.

    Features: mean over the entries (valence not NULL) of each chart; change
    and percent change.  Weather: mean over [L-6, L] vs [L-13, L-7], change
    only.  All weather rows count, whatever the country.

    The chart entries of both weeks and the weather days of both periods are
    unioned and reduced by ONE conditional aggregate (no join of one-row
    frames, no second pass), then unpivoted.
    """
    t = star.dim_time.select("date_id", "date")
    latest = (
        by_country(star.fact, cfg.country).select("date_id").distinct()
        .join(star.calendar(t), "date_id").agg(F.max("date")).scalar()
    )
    prev = F.date_sub(latest, 7)

    # the two weeks as flags of the calendar days, worked out once on the small side
    d = F.col("date")
    days = t.withColumn("latest", latest).filter(d.between(F.date_sub("latest", 13), F.col("latest"))).select(
        "date_id",
        (d == F.col("latest")).alias("cur"),
        (d == F.date_sub("latest", 7)).alias("was"),
        (d >= F.date_sub("latest", 6)).alias("wcur"),
        (d <= F.date_sub("latest", 7)).alias("wprev"),
    )
    entries = (
        by_country(star.fact, cfg.country)
        .select("track_id", "date_id")
        .join(star.calendar(days.filter("cur or was").select("date_id", "cur", "was")), "date_id")
        .join(star.dim_track.filter(F.col("valence").isNotNull()).select("track_id", *WEEKLY_FEATURES), "track_id")
        .select("cur", "was", "track_id", *WEEKLY_FEATURES)
    )
    weather_days = star.dim_weather.join(star.calendar(days.select("date_id", "wcur", "wprev")), "date_id").select(
        "wcur", "wprev", *[F.col(c).alias("w_" + m) for m, c in WEEKLY_WEATHER]
    )
    both = entries.unionByName(weather_days, allowMissingColumns=True)

    cur, was, wcur, wprev = F.col("cur"), F.col("was"), F.col("wcur"), F.col("wprev")
    wide = both.agg(
        F.count_distinct("track_id").alias("unique_songs"),
        *[F.avg(F.when(cur, F.col(f))).alias("c_" + f) for f in WEEKLY_FEATURES],
        *[F.avg(F.when(was, F.col(f))).alias("p_" + f) for f in WEEKLY_FEATURES],
        *[F.avg(F.when(wcur, F.col("w_" + m))).alias("c_" + m) for m, _ in WEEKLY_WEATHER],
        *[F.avg(F.when(wprev, F.col("w_" + m))).alias("p_" + m) for m, _ in WEEKLY_WEATHER],
    )
    rows = [
        F.struct(F.lit("feature").alias("metric_kind"), F.lit(f).alias("metric"),
                 F.col("c_" + f).alias("current"), F.col("p_" + f).alias("previous"))
        for f in WEEKLY_FEATURES
    ] + [
        F.struct(F.lit("weather").alias("metric_kind"), F.lit(m).alias("metric"),
                 F.col("c_" + m).alias("current"), F.col("p_" + m).alias("previous"))
        for m, _ in WEEKLY_WEATHER
    ]
    long = wide.select("unique_songs", _inline(rows))
    pct = F.when(F.col("metric_kind") == "feature", sc.change_pct("current", "previous"))
    return long.select(
        F.lit(latest).cast("date").alias("chart_date"),
        prev.alias("previous_chart_date"),
        cal.period_label(F.date_sub(latest, 6), latest).alias("weather_period_current"),
        cal.period_label(F.date_sub(latest, 13), prev).alias("weather_period_previous"),
        "unique_songs",
        "metric_kind",
        "metric",
        "current",
        "previous",
        (F.col("current") - F.col("previous")).alias("change"),
        pct.alias("change_pct"),
    ).filter(F.col("chart_date").isNotNull())


# --- Q4 ---------------------------------------------------------------------------

def audio_features_by_season(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Mean audio features per season over chart entries (Q4)."""
    tracks = star.dim_track.filter(F.col("danceability").isNotNull()).select("track_id", *SEASON_FEATURES)
    per_track = (
        by_country(star.fact, cfg.country)
        .select("track_id", "date_id")
        .join(star.calendar(star.dim_time.select("date_id", "season")), "date_id")
        .groupBy("track_id", "season")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_track.join(tracks, "track_id")
        .groupBy("season")
        .agg(
            *[weighted_mean(f, "n").alias(f) for f in SEASON_FEATURES],
            F.sum("n").alias("chart_entries"),
            F.count(F.lit(1)).alias("unique_tracks"),
        )
        .orderBy(cal.season_rank("season", cfg.labels))
    )


# --- Q5 ---------------------------------------------------------------------------

def weekly_weather(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Per chart date of the country: mean weather of the 7 days ending on it,
    and its category (NULL sunshine weeks and uncategorised weeks dropped)."""
    charted = (
        by_country(star.fact, cfg.country)
        .select("date_id")
        .distinct()
        .join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
        .select(F.col("date").alias("chart_date"))
    )
    days = star.dim_weather.join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
    means = trailing_window(
        days, charted, 7, span_days=star.calendar_days, measures=
        {"avg_temperature": "temperature_avg", "avg_precipitation": "precipitation_mm", "avg_sunshine": "sunshine_hours"},
    )
    cat = sc.week_weather("avg_precipitation", "avg_sunshine", cfg.labels)
    return (
        means.filter(F.col("avg_sunshine").isNotNull())
        .withColumn("weather_category", cat)
        .filter(F.col("weather_category").isNotNull())
    )


def audio_features_by_weather(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Audio features per weekly weather category (Q5).

    Weather means are entry-weighted: every chart entry carries its week's
    weather (NULL rain / temperature count as 0).
    """
    weeks = weekly_weather(star, cfg).join(
        star.calendar(star.dim_time.select("date_id", F.col("date").alias("chart_date"))), "chart_date"
    )
    tracks = star.dim_track.filter(F.col("danceability").isNotNull()).select("track_id", *SEASON_FEATURES)
    per_track = (
        by_country(star.fact, cfg.country)
        .select("track_id", "date_id")
        .join(star.calendar(weeks), "date_id")
        .groupBy("track_id", "weather_category")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("avg_sunshine").alias("sunshine"),
            F.sum(F.coalesce("avg_precipitation", F.lit(0.0))).alias("precipitation"),
            F.sum(F.coalesce("avg_temperature", F.lit(0.0))).alias("temperature"),
        )
    )
    return (
        per_track.join(tracks, "track_id")
        .groupBy("weather_category")
        .agg(
            (F.sum("sunshine") / F.sum("n")).alias("avg_sunshine"),
            (F.sum("precipitation") / F.sum("n")).alias("avg_precipitation"),
            (F.sum("temperature") / F.sum("n")).alias("avg_temperature"),
            *[weighted_mean(f, "n").alias(f) for f in SEASON_FEATURES],
            F.sum("n").alias("chart_entries"),
            F.count(F.lit(1)).alias("unique_tracks"),
        )
        .orderBy(sc.label_rank("weather_category", cfg.labels.week_weather_order))
    )


# --- Q6 ---------------------------------------------------------------------------

def danceability_by_sunshine(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Danceability and valence per same-day sunshine bucket (Q6), HAVING
    count > ``cfg.sunshine_min_count``."""
    tracks = star.dim_track.filter(F.col("danceability").isNotNull() & F.col("valence").isNotNull()).select(
        "track_id", "danceability", "valence"
    )
    weather = star.dim_weather.select("weather_id", "sunshine_hours")
    bucket = sc.sunshine_bucket("sunshine_hours", cfg.labels, cfg.null_sunshine_bucket)
    per_track = (
        by_country(star.fact, cfg.country)
        .select("track_id", "weather_id")
        .join(weather, "weather_id")
        .groupBy("track_id", bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("sunshine_hours").alias("hours"), F.count("sunshine_hours").alias("n_hours"))
    )
    return (
        per_track.join(tracks, "track_id")
        .groupBy(F.col("bucket").alias("sunshine_hours"))
        .agg(
            F.try_divide(F.sum("hours"), F.sum("n_hours").cast("double")).alias("exact_sunshine"),
            weighted_mean("danceability", "n").alias("avg_danceability"),
            weighted_mean("valence", "n").alias("avg_valence"),
            F.sum("n").alias("_n"),
        )
        .filter(F.col("_n") > cfg.sunshine_min_count)
        .drop("_n")
    )


# --- Q7 ---------------------------------------------------------------------------

def seasonal_streaming_trends(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Total streams per (season, month), ordered by month (Q7)."""
    return (
        by_country(star.fact, cfg.country)
        .select("date_id", "stream_count")
        .join(star.calendar(star.dim_time.select("date_id", "season", "month")), "date_id")
        .groupBy("season", "month")
        .agg(F.sum("stream_count").alias("total_streams"))
        .orderBy("month")
    )


# --- Q8 ---------------------------------------------------------------------------

def acoustic_vs_electronic(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Mean streams per (track type, same-day weather) (Q8); the NULL weather
    group is kept; HAVING count > ``cfg.acoustic_min_count``."""
    tracks = star.dim_track.filter(F.col("acousticness").isNotNull()).select("track_id", "acousticness")
    weather = star.dim_weather.select("weather_id", "precipitation_mm", "sunshine_hours")
    per_track = (
        by_country(star.fact, cfg.country)
        .select("track_id", "weather_id", "stream_count")
        .join(weather, "weather_id")
        .groupBy("track_id", sc.day_weather("precipitation_mm", "sunshine_hours", cfg.labels).alias("weather"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum("stream_count").alias("streams"), F.count("stream_count").alias("n_streams"))
    )
    return (
        per_track.join(tracks, "track_id")
        .groupBy(sc.acoustic_type("acousticness", cfg.labels).alias("track_type"), "weather")
        .agg(F.try_divide(F.sum("streams").cast("double"), F.sum("n_streams").cast("double")).alias("avg_streams"), F.sum("n").alias("sample_size"))
        .filter(F.col("sample_size") > cfg.acoustic_min_count)
    )


# --- Q9 ---------------------------------------------------------------------------

def key_distribution(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Chart entries per (key name, season) (Q9).

    The key name is a function of (key, mode), so grouping by it directly
    gives the re-summed counts in a single aggregation.
    """
    tracks = star.dim_track.filter(
        F.col("key").isNotNull() & F.col("mode").isNotNull() & F.col("key").between(0, 11)
    ).select("track_id", sc.note_name("key", "mode").alias("key_name"))
    per_track = (
        by_country(star.fact, cfg.country)
        .select("track_id", "date_id")
        .join(star.calendar(star.dim_time.select("date_id", "season")), "date_id")
        .groupBy("track_id", "season")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_track.join(tracks, "track_id").groupBy("key_name", "season").agg(F.sum("n").alias("track_count"))


# --- Q10 --------------------------------------------------------------------------

def period_flags(star: Star, cfg: C.MartConfig) -> DataFrame:
    """Time rows inside any event period or the baseline, with flags.

    Overlapping periods count once (an OR of closed ranges)."""
    if not cfg.periods or cfg.baseline is None:
        raise ValueError("the period comparison needs MartConfig.periods and MartConfig.baseline")
    d = F.col("date")
    in_period = F.lit(False)
    for a, b in cfg.periods:
        in_period = in_period | d.between(F.lit(a), F.lit(b))
    in_base = d.between(F.lit(cfg.baseline[0]), F.lit(cfg.baseline[1]))
    return (
        star.dim_time.select("date_id", in_period.alias("in_period"), in_base.alias("in_baseline"))
        .filter(F.col("in_period") | F.col("in_baseline"))
    )


def period_comparison(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Mean valence, energy, danceability: event periods vs baseline (Q10)."""
    tracks = star.dim_track.filter(
        F.col("valence").isNotNull() & F.col("energy").isNotNull() & F.col("danceability").isNotNull()
    ).select("track_id", *[c for _, c in PERIOD_FEATURES])
    per_track = (
        by_country(star.fact, cfg.country)
        .select("track_id", "date_id")
        .join(star.calendar(period_flags(star, cfg)), "date_id")
        .groupBy("track_id")
        .agg(F.count_if("in_period").alias("n_period"), F.count_if("in_baseline").alias("n_baseline"))
    )
    wide = per_track.join(tracks, "track_id").agg(
        *[weighted_mean(c, "n_period").alias("p_" + c) for _, c in PERIOD_FEATURES],
        *[weighted_mean(c, "n_baseline").alias("b_" + c) for _, c in PERIOD_FEATURES],
        F.coalesce(F.sum("n_period"), F.lit(0)).alias("period_sample"),
        F.coalesce(F.sum("n_baseline"), F.lit(0)).alias("baseline_sample"),
    )
    long = wide.select(
        "period_sample",
        "baseline_sample",
        _inline([
            F.struct(F.lit(name).alias("feature"), F.col("p_" + c).alias("period_avg"), F.col("b_" + c).alias("baseline_avg"))
            for name, c in PERIOD_FEATURES
        ]),
    )
    diff = F.col("baseline_avg") - F.col("period_avg")
    return long.select(
        "feature",
        "period_avg",
        "baseline_avg",
        diff.alias("difference"),
        (F.try_divide(diff, F.col("period_avg")) * 100.0).alias("diff_pct"),
        "period_sample",
        "baseline_sample",
    )


# --- trailing weather and week-over-week history (JN-8, WN-2) --------------------

def trailing_weather(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Mean weather of the 7 days ending on every chart date (JN-8), before
    any category rule."""
    charted = (
        by_country(star.fact, cfg.country)
        .select("date_id")
        .distinct()
        .join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
        .select(F.col("date").alias("chart_date"))
    )
    days = star.dim_weather.join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
    return trailing_window(
        days, charted, 7, span_days=star.calendar_days, measures=
        {
            "avg_temperature": "temperature_avg",
            "avg_precipitation": "precipitation_mm",
            "avg_sunshine": "sunshine_hours",
            "avg_wind_speed": "wind_speed_kmh",
        },
    )


def weekly_change_history(star: Star, cfg: C.MartConfig = C.DEFAULT_MART) -> DataFrame:
    """Every chart date vs the chart exactly 7 days earlier (WN-2, all dates).

    Per-date feature means (valence not NULL) are joined to themselves on
    ``date - 7``: an equi-join on a per-date table, so a missing week gives
    NULL previous values instead of comparing with an older chart.
    """
    per_date = (
        by_country(star.fact, cfg.country)
        .select("track_id", "date_id")
        .join(star.calendar(star.dim_time.select("date_id", "date")), "date_id")
        .join(star.dim_track.filter(F.col("valence").isNotNull()).select("track_id", *WEEKLY_FEATURES), "track_id")
        .groupBy("date")
        .agg(*[F.avg(f).alias(f) for f in WEEKLY_FEATURES])
    )
    prev = per_date.select(F.date_add("date", 7).alias("date"), *[F.col(f).alias("p_" + f) for f in WEEKLY_FEATURES])
    joined = per_date.join(star.calendar(prev), "date", "left")
    long = joined.select(
        F.col("date").alias("chart_date"),
        _inline([
            F.struct(F.lit(f).alias("metric"), F.col(f).alias("current"), F.col("p_" + f).alias("previous"))
            for f in WEEKLY_FEATURES
        ]),
    )
    return long.select(
        "chart_date", "metric", "current", "previous",
        (F.col("current") - F.col("previous")).alias("change"),
        F.when(F.col("previous").isNull(), F.lit(None).cast("double"))
        .otherwise(sc.change_pct("current", "previous"))
        .alias("change_pct"),
    )
