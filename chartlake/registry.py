"""Registry of the queries checked by the driver, with their oracle SQL.

Each entry is ``name -> (spark, sf_dir) -> DataFrame``.  The callables build
the test star schema lazily from the raw tables and run one operator on it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake import config as C
from chartlake import schemas as SCH
from chartlake import sql_oracle as O
from chartlake.functions import calendar as CAL
from chartlake.functions import scalars as SC
from chartlake.operators import incremental as INC
from chartlake.operators import landed_keys as LK
from chartlake.operators import loaders as LD
from chartlake.operators import quality as Q
from chartlake.plans import chart_tables as CT
from chartlake.plans import marts as M
from chartlake.plans import warehouse as WH
from chartlake.sources import fixture_docs as DOCS
from chartlake.sources import staging as ST
from chartlake.sources import testdata as TD

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def edge(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns for the cross-engine comparison: to 10 places
    first (absorbs last-bit differences of summation order), then half-up to
    ``digits`` -- the oracle SQL applies the same two steps."""
    return df.select(
        *[
            F.round(F.round(F.col(f.name), 10), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: edge(fn(spark, sf_dir))
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _star(spark: SparkSession, sf_dir: str):
    """The star for queries that do not name chart positions."""
    return TD.load_fixture(spark, sf_dir).plain_star


def _ranked_star(spark: SparkSession, sf_dir: str):
    return TD.load_fixture(spark, sf_dir).star


MART_DE = TD.MART
# Parameters of the loader / incremental queries on the fixture.
PARTIAL_CALENDAR_END = "2001-01-01"     # time dimension cut for the skip counter
INCREMENTAL_CUTOFF_ID = 20010901        # facts before this date_id count as loaded
LANDED_BEFORE = "1998-01-01"            # chart dates already staged
KNOWN_BEFORE = "1995-07-01"             # tracks of the initial load: charted before this
REMAINING_RANGE = (_dt.date(1996, 1, 1), _dt.date(2000, 12, 31))
MART_ALL = C.MartConfig(country=None, periods=TD.PERIODS, baseline=TD.BASELINE)


# --- marts (Q1-Q10) ------------------------------------------------------------

@register("kpis", O.kpis("de"))
def _kpis(spark, sf):
    return M.kpis(_star(spark, sf), MART_DE)


@register("kpis_all", O.kpis(None))
def _kpis_all(spark, sf):
    return M.kpis(_star(spark, sf), MART_ALL)


@register("current_top_tracks", O.current_top_tracks("de", 3))
def _top(spark, sf):
    return M.current_top_tracks(_ranked_star(spark, sf), MART_DE)


@register("current_top_tracks_at10", O.current_top_tracks("at", 10))
def _top_at(spark, sf):
    return M.current_top_tracks(_ranked_star(spark, sf), C.MartConfig(country="at", top_limit=10))


@register("latest_chart_tops", O.latest_chart_tops(10))
def _latest_tops(spark, sf):
    return M.latest_chart_tops(_late_at(spark, sf), C.MartConfig(country=None, top_limit=10))


def _late_at(spark, sf):
    """The star without the last charts of one country, so that countries differ in their latest chart."""
    star = _ranked_star(spark, sf)
    return replace(star, fact=star.fact.filter((F.col("country") != "at") | (F.col("date_id") < INCREMENTAL_CUTOFF_ID)))


@register("weekly_feature_changes", O.weekly_feature_changes("de"))
def _weekly(spark, sf):
    return M.weekly_feature_changes(_star(spark, sf), MART_DE)


@register("audio_features_by_season", O.audio_features_by_season("de"))
def _season(spark, sf):
    return M.audio_features_by_season(_star(spark, sf), MART_DE)


@register("audio_features_by_season_all", O.audio_features_by_season(None))
def _season_all(spark, sf):
    return M.audio_features_by_season(_star(spark, sf), MART_ALL)


@register("audio_features_by_weather", O.audio_features_by_weather("de"))
def _by_weather(spark, sf):
    return M.audio_features_by_weather(_star(spark, sf), MART_DE)


@register("audio_features_by_weather_all", O.audio_features_by_weather(None))
def _by_weather_all(spark, sf):
    return M.audio_features_by_weather(_star(spark, sf), MART_ALL)


@register("danceability_by_sunshine", O.danceability_by_sunshine("de", 20))
def _sunshine(spark, sf):
    return M.danceability_by_sunshine(_star(spark, sf), MART_DE)


@register("danceability_by_sunshine_null_bucket", O.danceability_by_sunshine("de", 20, "no data"))
def _sunshine_null(spark, sf):
    cfg = C.MartConfig(country="de", periods=TD.PERIODS, baseline=TD.BASELINE, null_sunshine_bucket="no data")
    return M.danceability_by_sunshine(_star(spark, sf), cfg)


@register("seasonal_streaming_trends", O.seasonal_streaming_trends(None))
def _trends(spark, sf):
    return M.seasonal_streaming_trends(_star(spark, sf), MART_ALL)


@register("seasonal_streaming_trends_de", O.seasonal_streaming_trends("de"))
def _trends_de(spark, sf):
    return M.seasonal_streaming_trends(_star(spark, sf), MART_DE)


@register("acoustic_vs_electronic", O.acoustic_vs_electronic(None, 10))
def _acoustic(spark, sf):
    return M.acoustic_vs_electronic(_star(spark, sf), MART_ALL)


@register("acoustic_vs_electronic_min3200", O.acoustic_vs_electronic(None, 3200))
def _acoustic_3200(spark, sf):
    # at sf0.01 this limit drops the acoustic/rain and electronic/rain groups
    cfg = C.MartConfig(country=None, acoustic_min_count=3200)
    return M.acoustic_vs_electronic(_star(spark, sf), cfg)


@register("key_distribution", O.key_distribution(None))
def _keys(spark, sf):
    return M.key_distribution(_star(spark, sf), MART_ALL)


@register("period_comparison", O.period_comparison("de"))
def _periods(spark, sf):
    return M.period_comparison(_star(spark, sf), MART_DE)


# --- windows over dates (JN-8, WN-2) ------------------------------------------------

@register("trailing_weather", O.trailing_weather(None))
def _trailing(spark, sf):
    return M.trailing_weather(_star(spark, sf), MART_ALL)


@register("weekly_change_history", O.weekly_change_history("de"))
def _history(spark, sf):
    return M.weekly_change_history(_star(spark, sf), MART_DE)


# --- calendar (GEN-*, SC-1, SC-2) -------------------------------------------------------

@register("dim_time_build", O.DIM_TIME_BUILD)
def _dim_time(spark, sf):
    return TD.load_fixture(spark, sf).dim_time


@register("dim_time_extend", O.DIM_TIME_EXTEND)
def _dim_time_extend(spark, sf):
    fx = TD.load_fixture(spark, sf)
    bounds = fx.bounds
    last_ship = bounds.select("last_ship").scalar()
    existing = fx.dim_time.filter(F.col("date") <= last_ship)
    today = bounds.select(F.date_add("last_ship", TD.TAIL_DAYS)).scalar()
    return LD.extend_dim_time(existing, today)


@register("sunday_bounds", O.SUNDAY_BOUNDS)
def _sundays(spark, sf):
    t = TD.load_fixture(spark, sf).dim_time
    months = t.groupBy(F.date_trunc("month", F.col("date").cast("timestamp")).cast("date").alias("month_start")).agg(
        F.min("date").alias("first_day"), F.max("date").alias("last_day")
    )
    return months.select(
        "month_start",
        CAL.first_sunday_on_or_after("first_day").alias("first_sunday"),
        CAL.last_sunday_on_or_before("last_day").alias("last_sunday"),
    )


@register("calendar_span", O.CALENDAR_SPAN)
def _span(spark, sf):
    b = TD.load_fixture(spark, sf).bounds
    return b.select(
        "first_ship", "last_ship",
        CAL.span_days("first_ship", "last_ship").alias("expected_days"),
        F.explode(CAL.span_years("first_ship", "last_ship")).alias("year"),
    )


@register("date_labels", O.DATE_LABELS)
def _labels(spark, sf):
    s = _star(spark, sf)
    d = s.fact.select("date_id").distinct().join(s.dim_time, "date_id").select("date")
    return d.select(
        "date",
        CAL.iso_label("date").alias("iso"),
        CAL.day_month_label("date").alias("day_month"),
        CAL.day_month_year_label("date").alias("day_month_year"),
        CAL.api_noon_label("date").alias("api_date"),
        CAL.is_sunday("date").alias("is_sunday"),
    )


# --- loaders (LD-1 ... LD-5) --------------------------------------------------------------

@register("daily_weather", O.DAILY_WEATHER)
def _daily(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return LD.daily_weather(TD.weather_readings(fx.weather_raw))


@register("dim_weather_load", O.DIM_WEATHER)
def _dim_weather(spark, sf):
    return TD.load_fixture(spark, sf).dim_weather


@register("dim_track_load", O.DIM_TRACK_LOAD)
def _dim_track_load(spark, sf):
    return LD.load_tracks(TD.load_fixture(spark, sf).features_all)


@register("fact_load", O.FACT_LOAD)
def _fact(spark, sf):
    return TD.load_fixture(spark, sf).fact


@register("fact_load_partial_calendar", O.FACT_LOAD_PARTIAL)
def _fact_partial(spark, sf):
    fx = TD.load_fixture(spark, sf)
    cal_2000 = fx.dim_time.filter(F.col("date") < F.lit(PARTIAL_CALENDAR_END).cast("date"))
    return LD.load_facts(fx.chart_raw, cal_2000, fx.dim_weather, span_days=fx.span)


@register("fact_load_skipped", O.FACT_LOAD_SKIPPED)
def _fact_skipped(spark, sf):
    fx = TD.load_fixture(spark, sf)
    cal_2000 = fx.dim_time.filter(F.col("date") < F.lit(PARTIAL_CALENDAR_END).cast("date"))
    rows = fx.chart_raw.select("chart_date")
    return LD.skipped_dates(rows, cal_2000, "chart_date", fx.span).agg(F.count(F.lit(1)).alias("skipped"))


def _initial_load_tracks(fx) -> DataFrame:
    """Track dimension of an initial load that covered the first half year:
    the tracks charted before ``KNOWN_BEFORE``."""
    first_load = F.col("chart_date") < F.lit(KNOWN_BEFORE).cast("date")
    before = fx.chart_raw.filter(first_load).select(F.col("song_uuid").alias("track_id"))
    return fx.dim_track.join(before, "track_id", "left_semi")


def _cutoff_date():
    return F.to_date(F.lit(str(INCREMENTAL_CUTOFF_ID)), "yyyyMMdd")


def _chart_entries(fx) -> DataFrame:
    """Flattened chart entries of the fixture (names from the song ids)."""
    p = F.col("position")
    return fx.chart_raw.select(
        "chart_date", "country", "position", "streams", "song_uuid",
        F.concat(F.lit("Title "), F.col("song_uuid")).alias("song_name"),
        F.when(p % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Artist "), F.col("song_uuid"))).alias(
            "artist_name"
        ),
        F.concat(F.lit("cover/"), F.col("song_uuid"), F.lit(".jpg")).alias("image_url"),
    )


@register("placeholder_tracks", O.PLACEHOLDER_TRACKS)
def _placeholders(spark, sf):
    fx = TD.load_fixture(spark, sf)
    known = _initial_load_tracks(fx)
    return LD.placeholder_tracks(_chart_entries(fx), known)


@register("incremental_chart_load", O.INCREMENTAL_CHART_LOAD)
def _incr_load(spark, sf):
    fx = TD.load_fixture(spark, sf)
    existing = fx.fact.filter(F.col("date_id") < INCREMENTAL_CUTOFF_ID)
    return LD.new_chart_facts(_chart_entries(fx), fx.dim_time, fx.dim_weather, existing,
                              span_days=fx.span)


@register("track_feature_merge", O.TRACK_FEATURE_MERGE)
def _merge(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return LD.merge_track_features(fx.dim_track, fx.features_staged)


@register("updated_track_count", O.UPDATED_TRACK_COUNT)
def _merge_count(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return LD.updated_track_count(fx.dim_track, fx.features_staged)


# --- incremental marks and backlogs (LD-7 ... LD-15) ---------------------------------------

@register("missing_chart_sundays", O.MISSING_CHART_SUNDAYS)
def _miss_sundays(spark, sf):
    return INC.missing_chart_sundays(_star(spark, sf))


@register("missing_weather_dates", O.MISSING_WEATHER_DATES)
def _miss_weather(spark, sf):
    return INC.missing_weather_dates(_star(spark, sf))


@register("missing_features", O.MISSING_FEATURES)
def _miss_features(spark, sf):
    return INC.missing_features(TD.load_fixture(spark, sf).dim_track)


@register("weather_gap_ranges", O.WEATHER_GAP_RANGES)
def _gaps(spark, sf):
    return INC.weather_gap_ranges(_star(spark, sf))


@register("feature_backlog", O.FEATURE_BACKLOG)
def _backlog(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return INC.feature_backlog(fx.chart_raw, fx.features_staged)


@register("feature_backlog_filtered", O.FEATURE_BACKLOG)
def _backlog_filtered(spark, sf):
    """Features land in three files, each with its Bloom filter; the backlog meets the landed songs through them."""
    fx = TD.load_fixture(spark, sf)
    landing, filters = ST.shared_path(spark, "features"), ST.shared_path(spark, "feature_filters")
    blocks = LK.blocks_for(fx.part.count())
    third = F.crc32(F.col("song_uuid").cast("binary")) % 3
    for k in range(3):
        arrived = fx.features_staged.filter(third == k)
        ST.append_parquet(arrived, landing)
        ST.append_parquet(LK.key_filters(arrived, "song_uuid", F.lit(k), blocks), filters)
    return INC.feature_backlog(fx.chart_raw, spark.read.parquet(landing), spark.read.parquet(filters), blocks)


@register("backlog_batches", O.BACKLOG_BATCHES)
def _batches(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return INC.backlog_batches(INC.feature_backlog(fx.chart_raw, fx.features_staged))


@register("feature_backlog_head", O.FEATURE_BACKLOG_HEAD)
def _backlog_head(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return INC.backlog_head(INC.feature_backlog(fx.chart_raw, fx.features_staged), C.FEATURE_BATCH_SONGS)


@register("remaining_dates", O.REMAINING_DATES)
def _remaining(spark, sf):
    fx = TD.load_fixture(spark, sf)
    available = fx.chart_raw.select(CAL.api_noon_label("chart_date").alias("api_date"))
    landed = fx.chart_raw.filter(F.col("chart_date") < F.lit(LANDED_BEFORE).cast("date")).select("chart_date")
    return INC.remaining_dates(available, INC.landed_dates(landed), *REMAINING_RANGE)


@register("landed_dates", O.LANDED_DATES)
def _landed(spark, sf):
    return INC.landed_dates(TD.load_fixture(spark, sf).chart_raw)


@register("incremental_plan", O.INCREMENTAL_PLAN)
def _plan(spark, sf):
    return INC.incremental_plan(_star(spark, sf))


# --- sources and sinks (SRC-*, SNK-*) ----------------------------------------------------------

@register("chart_top_n", O.CHART_TOP_N)
def _top_n(spark, sf):
    fx = TD.load_fixture(spark, sf)
    # positions are partly missing and partly repeated: the first 50 are those of the joined pages
    path = DOCS.land_text(DOCS.short_pages_json(fx.chart_raw), ST.shared_path(spark, "pages"), 5 * DOCS.PAGES_PER_FILE)
    items = ST.chart_items(ST.read_chart_pages(spark, path), top_n=50)
    return items.select(
        CAL.parse_api_date("chart_date").alias("chart_date"), "country",
        F.col("item.position").alias("position"), F.col("item.song.uuid").alias("song_uuid"),
        F.col("item.metric").alias("streams"),
    )


@register("flatten_chart_items", O.FLATTEN_CHART_ITEMS)
def _flatten_items(spark, sf):
    fx = TD.load_fixture(spark, sf)
    path = DOCS.land_text(DOCS.chart_pages_json(fx.chart_raw), ST.shared_path(spark, "pages"), DOCS.PAGES_PER_FILE)
    flat = ST.flatten_chart_items(ST.chart_items(ST.read_chart_pages(spark, path)), F.lit(None).cast("string"))
    return flat.drop("fetched_at")


@register("flatten_song_features", O.FLATTEN_SONG_FEATURES)
def _flatten_songs(spark, sf):
    fx = TD.load_fixture(spark, sf)
    path = DOCS.land_text(DOCS.song_docs_json(fx.part), ST.shared_path(spark, "songs"))
    docs = spark.read.text(path).select(
        F.get_json_object("value", "$.song_uuid").alias("song_uuid"), F.col("value").alias("json")
    )
    return ST.flatten_song_features(docs)


@register("explode_weather_arrays", O.EXPLODE_WEATHER_ARRAYS)
def _weather_docs(spark, sf):
    fx = TD.load_fixture(spark, sf)
    path = DOCS.land_text(DOCS.weather_docs_json(fx.weather_raw), ST.shared_path(spark, "weather"))
    return ST.explode_weather_arrays(spark.read.schema(SCH.WEATHER_DOC_DDL).json(path))


@register("dim_location", O.DIM_LOCATION)
def _locations(spark, sf):
    return ST.location_dimension(TD.fixture_locations(TD.read_table(spark, sf, "nation")))


def _staged_chart_rows(fx) -> DataFrame:
    e = _chart_entries(fx)
    return e.select(
        CAL.api_noon_label("chart_date").alias("chart_date"),
        F.lit(None).cast("string").alias("fetched_at"),
        "position",
        F.lit(None).cast("int").alias("old_position"),
        F.lit(None).cast("int").alias("position_change"),
        "streams",
        F.lit("STABLE").alias("entry_state"),
        F.lit(None).cast("string").alias("entry_date"),
        F.lit(None).cast("string").alias("rank_date"),
        F.lit(None).cast("int").alias("weeks_on_chart"),
        F.lit("week").alias("time_unit"),
        "song_uuid", "song_name", "artist_name", "image_url",
        F.to_json(F.struct("position", "song_uuid", "country")).alias("raw_json"),
    )


@register("src_chart_csv", O.SRC_CHART_CSV)
def _chart_csv(spark, sf):
    fx = TD.load_fixture(spark, sf)
    path = ST.shared_path(spark, "charts_csv")
    # as exported by a data-frame library: whole numbers as 5.0, quotes, commas and line breaks in names
    odd = F.concat(F.lit('The "'), F.col("song_name"), F.lit('", part\none'))
    exported = _staged_chart_rows(fx).withColumn("song_name", odd).withColumns(
        {c: F.format_string("%.1f", F.col(c).cast("double")) for c in ("position", "streams")})
    ST.write_csv(exported, path)
    return ST.read_chart_csv(spark, path).drop("fetched_at", "raw_json")


@register("src_feature_csv", O.SRC_FEATURE_CSV)
def _feature_csv(spark, sf):
    fx = TD.load_fixture(spark, sf)
    path = ST.shared_path(spark, "features_csv")
    odd = F.concat(F.col("song_name"), F.lit(', "live"\ntake 2'))
    exported = fx.features_all.withColumn("song_name", odd).withColumns(
        {c: F.col(c).cast("double") for c in ("key", "mode", "time_signature")})
    ST.write_csv(exported, path)
    return ST.read_feature_csv(spark, path)


@register("sink_append_roundtrip", O.FACT_LOAD)
def _append(spark, sf):
    fx = TD.load_fixture(spark, sf)
    path = ST.shared_path(spark, "fact_append")
    early = F.col("date_id") < INCREMENTAL_CUTOFF_ID
    ST.append_parquet(fx.fact.filter(early), path)
    ST.append_parquet(fx.fact.filter(~early), path)
    return spark.read.schema(SCH.FACT_TRACK_CHART).parquet(path)


@register("staging_union_sorted", O.STAGING_UNION_SORTED)
def _union_sorted(spark, sf):
    fx = TD.load_fixture(spark, sf)
    rows = fx.chart_raw.select("chart_date", "country", "position", "song_uuid", "streams")
    old = F.col("chart_date") < F.lit(LANDED_BEFORE).cast("date")
    return ST.union_sorted_charts(rows.filter(old), rows.filter(~old))


@register("staging_union_dedup", O.STAGING_UNION_DEDUP)
def _union_dedup(spark, sf):
    fx = TD.load_fixture(spark, sf)
    # every part is staged already and comes again; every part also comes as a song of another key
    again = fx.part.select(
        F.col("p_partkey").cast("string").alias("song_uuid"),
        F.concat(F.lit("New "), F.col("p_name")).alias("song_name"),
        F.col("p_brand").alias("artist_name"),
        (F.col("p_size") * 2.0).alias("duration"),
    )
    new = again.unionByName(again.withColumn("song_uuid", F.concat(F.lit("b"), "song_uuid")))
    return ST.union_first_wins(fx.features_all, new).select(
        "song_uuid", "song_name", "artist_name", "duration", "danceability", "genres"
    )


# --- quality and summaries -------------------------------------------------------------------

def _expected_days(fx):
    b = fx.bounds
    return b.select(CAL.span_days("first_ship", F.date_add("last_ship", TD.TAIL_DAYS))).scalar()


@register("dq_report", O.DQ_REPORT)
def _dq(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return Q.dq_report(fx.star, _expected_days(fx))


@register("dq_passed", O.DQ_PASSED)
def _dq_passed(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return Q.dq_passed(Q.dq_report(fx.star, _expected_days(fx)))


@register("load_summary", O.LOAD_SUMMARY)
def _load_summary(spark, sf):
    return Q.load_summary(_star(spark, sf))


@register("staging_summary", O.STAGING_SUMMARY)
def _staging_summary(spark, sf):
    fx = TD.load_fixture(spark, sf)
    return Q.staging_summary(fx.chart_raw, fx.features_all)


# --- chart-ready tables ---------------------------------------------------------------------

@register("chart_top_cards", O.CHART_TOP_CARDS)
def _cards(spark, sf):
    return CT.top_cards(_ranked_star(spark, sf), MART_DE)


@register("weekly_trend_labels", O.WEEKLY_TREND_LABELS)
def _trend(spark, sf):
    return CT.weekly_trend_labels(_star(spark, sf), MART_DE)


@register("chart_season_series", O.CHART_SEASON_SERIES)
def _season_series(spark, sf):
    return CT.season_series(_star(spark, sf), MART_DE)


@register("chart_season_totals", O.CHART_SEASON_TOTALS)
def _season_totals(spark, sf):
    return CT.season_totals(_star(spark, sf), MART_DE)


@register("chart_axis_ranges", O.CHART_AXIS_RANGES)
def _axis(spark, sf):
    return CT.axis_ranges(_star(spark, sf), MART_DE)


@register("chart_weather_series", O.CHART_WEATHER_SERIES)
def _weather_series(spark, sf):
    return CT.weather_series(_star(spark, sf), MART_DE)


@register("chart_top_keys", O.CHART_TOP_KEYS)
def _top_keys(spark, sf):
    return CT.top_keys(_star(spark, sf), MART_ALL)


@register("chart_sunshine_series", O.CHART_SUNSHINE_SERIES)
def _sun_series(spark, sf):
    return CT.sunshine_series(_star(spark, sf), MART_DE)


@register("chart_period_bars", O.CHART_PERIOD_BARS)
def _period_bars(spark, sf):
    return CT.period_bars(_star(spark, sf), MART_DE)


# --- full / incremental warehouse loads and the stream (LD-13, LD-14, 2.13) -------------------

@register("warehouse_row_counts", O.WAREHOUSE_ROW_COUNTS)
def _warehouse_counts(spark, sf):
    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    WH.write_star(fx.star, root)
    return WH.row_counts(WH.read_star(spark, root))


@register("warehouse_build_dq", O.DQ_BUILD)
def _warehouse_build(spark, sf):
    fx = TD.load_fixture(spark, sf)
    src = WH.Sources(
        chart_entries=fx.chart_raw,
        features=fx.features_all.unionByName(fx.features_all),  # staged twice: one row per song is loaded
        weather_readings=TD.weather_readings(fx.weather_raw),
        dim_time=fx.dim_time,
    )
    root = ST.shared_path(spark, "warehouse")
    WH.build_warehouse(spark, src, root)
    return WH.build_warehouse(spark, src, root)  # a second run adds nothing


def _refreshed_twice(spark, sf) -> TD.Star:
    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    last_ship = fx.bounds.select("last_ship").scalar()
    known = _initial_load_tracks(fx)
    WH.write_star(
        TD.Star(
            dim_time=fx.dim_time.filter(F.col("date") <= last_ship),
            dim_track=known,
            dim_weather=fx.dim_weather.filter(F.col("date_id") < INCREMENTAL_CUTOFF_ID),
            fact=fx.fact.filter(F.col("date_id") < INCREMENTAL_CUTOFF_ID),
        ),
        root,
    )
    today = fx.bounds.select(F.date_add("last_ship", TD.TAIL_DAYS)).scalar()
    landing = WH.Landing(
        chart_entries=_chart_entries(fx),
        weather_readings=TD.weather_readings(fx.weather_raw),
        features=fx.features_staged.unionByName(fx.features_staged),
    )
    WH.refresh_warehouse(spark, root, landing, today)
    WH.refresh_warehouse(spark, root, landing, today)
    return WH.read_star(spark, root)


@register("warehouse_refresh_twice", O.WAREHOUSE_REFRESH)
def _warehouse_refresh(spark, sf):
    return WH.row_counts(_refreshed_twice(spark, sf))


@register("warehouse_refresh_tracks", O.WAREHOUSE_REFRESH_TRACKS)
def _warehouse_refresh_tracks(spark, sf):
    return _refreshed_twice(spark, sf).dim_track


@register("warehouse_create", O.WAREHOUSE_CREATE)
def _warehouse_create(spark, sf):
    """Create the tables, load them, create again: nothing is created or lost the second time."""
    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    created = WH.create_warehouse(spark, root)
    empty = WH.row_counts(WH.read_star(spark, root)).withColumnRenamed("rows", "rows_created")
    WH.write_star(fx.star, root)
    again = WH.create_warehouse(spark, root)
    return empty.join(WH.row_counts(WH.read_star(spark, root)), "table") \
        .withColumns({"created": F.col("table").isin(created), "created_again": F.col("table").isin(again) if again else F.lit(False)})


@register("track_merge_on_read", O.TRACK_FEATURE_MERGE)
def _merge_on_read(spark, sf):
    """Three merges of staged features, the second one repeating the first, with a compaction between them."""
    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    WH.write_star(fx.star, root)
    third = F.crc32(F.col("song_uuid").cast("binary")) % 3
    for parts in ((0,), (0, 1), (2,)):
        WH.merge_features(spark, root, fx.features_staged.filter(third.isin(*parts)))
        if parts == (0, 1):
            tx = WH.begin(spark, root)
            batches = tx.view.of("dim_track") + tx.view.of("dim_track", "changes")
            tx.replace(WH.read_dim_track(spark, root, tx.view), "dim_track", batches)
            tx.commit()
    return WH.read_dim_track(spark, root)


@register("warehouse_versions", O.WAREHOUSE_VERSIONS)
def _warehouse_versions(spark, sf):
    """Row counts of every published version: an early load, a full load that stops
    after three tables (which publishes nothing), the full load."""
    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    early = F.col("date_id") < INCREMENTAL_CUTOFF_ID
    WH.write_star(replace(fx.star, dim_weather=fx.dim_weather.filter(early), fact=fx.fact.filter(early)), root)
    src = WH.Sources(chart_entries=fx.chart_raw, features=fx.features_all, weather_readings=TD.weather_readings(fx.weather_raw), dim_time=fx.dim_time)
    stopped = WH.begin(spark, root)
    for name, df in list(WH.build_star(spark, src).tables().items())[:3]:
        stopped.append(df, name)
    WH.build_warehouse(spark, src, root)
    out = None
    for v in WH.log.versions(spark, root):
        counts = WH.row_counts(WH.read_star(spark, root, WH.log.read_version(spark, root, v))).select(F.lit(v).alias("version"), "table", "rows")
        out = counts if out is None else out.unionByName(counts)
    return out


@register("unique_tracks_sketch", O.UNIQUE_TRACKS_SKETCH)
def _unique_tracks(spark, sf):
    """Unique tracks by quarter from stored sketches, held against the exact count: sketches
    are stored after the first of two loads, the second load's are made on reading."""
    from chartlake.operators import sketches as SK

    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    early = F.col("date_id") < INCREMENTAL_CUTOFF_ID
    WH.write_star(replace(fx.star, fact=fx.fact.filter(early)), root)
    WH.store_sketches(spark, root)
    tx = WH.begin(spark, root)
    tx.append(fx.fact.filter(~early), "fact_track_chart")
    tx.commit()
    year, quarter = F.floor(F.col("date_id") / 10000).cast("int").alias("year"), F.floor((F.floor(F.col("date_id") / 100) % 100 + 2) / 3).cast("int").alias("quarter")
    by = ["country", year, quarter]
    near = SK.unique_tracks(WH.read_sketches(spark, root), *by).withColumnRenamed("unique_tracks", "estimate")
    exact = WH.read_star(spark, root).fact.groupBy(*by).agg(F.count_distinct("track_id").alias("unique_tracks"))
    return near.join(exact, ["country", "year", "quarter"]).select(
        "country", "year", "quarter", "entries", "unique_tracks", (F.abs(F.col("estimate") - F.col("unique_tracks")) <= 0.03 * F.col("unique_tracks")).alias("within_3_percent"))


@register("season_by_track_layout", O.audio_features_by_season(None))
def _season_layout(spark, sf):
    """Q4 over the bucketed copy of facts and tracks, written in two steps."""
    from chartlake.plans import track_layout as TL

    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    early = F.col("date_id") < INCREMENTAL_CUTOFF_ID
    WH.write_star(replace(fx.star, fact=fx.fact.filter(early)), root)
    TL.refresh_layout(spark, root, buckets=8)
    tx = WH.begin(spark, root)
    tx.append(fx.fact.filter(~early), "fact_track_chart")
    tx.commit()
    TL.refresh_layout(spark, root)
    return M.audio_features_by_season(TL.open_layout(spark, root), MART_ALL)


@register("incremental_stream_replay", O.INCREMENTAL_STREAM)
def _stream_replay(spark, sf):
    """The stream of ``incremental_stream`` run again after its checkpoint was lost: its files are in the ledger."""
    from chartlake.streaming import chart_stream as CS

    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    WH.write_star(replace(fx.star, fact=fx.fact.filter(F.col("date_id") < INCREMENTAL_CUTOFF_ID)), root)
    pages = DOCS.chart_pages_json(fx.chart_raw.filter(F.col("chart_date") >= _cutoff_date())).repartition(3)
    landing = DOCS.land_text(pages, ST.shared_path(spark, "landing"))
    for _ in range(2):
        CS.start_chart_stream(spark, landing, root, ST.shared_path(spark, "stream_ckpt"), max_files_per_trigger=1).awaitTermination()
    return WH.read_star(spark, root).fact


@register("incremental_stream", O.INCREMENTAL_STREAM)
def _stream(spark, sf):
    from chartlake.streaming import chart_stream as CS

    fx = TD.load_fixture(spark, sf)
    root = ST.shared_path(spark, "warehouse")
    early = F.col("date_id") < INCREMENTAL_CUTOFF_ID
    WH.write_star(TD.Star(dim_time=fx.dim_time, dim_track=fx.dim_track, dim_weather=fx.dim_weather,
                          fact=fx.fact.filter(early)), root)
    cutoff = _cutoff_date()
    new_pages = DOCS.chart_pages_json(fx.chart_raw.filter(F.col("chart_date") >= cutoff)).repartition(3)
    landing = DOCS.land_text(new_pages, ST.shared_path(spark, "landing"))
    q = CS.start_chart_stream(spark, landing, root, ST.shared_path(spark, "stream_ckpt"),
                              available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    return WH.read_star(spark, root).fact


# --- key sets, ranges, repair -------------------------------------------------------------

@register("new_tracks", O.NEW_TRACKS)
def _new_tracks(spark, sf):
    fx = TD.load_fixture(spark, sf)
    known = _initial_load_tracks(fx)
    return LD.new_track_ids(fx.chart_raw, known)


@register("known_tracks", O.KNOWN_TRACKS)
def _known_tracks(spark, sf):
    fx = TD.load_fixture(spark, sf)
    known = _initial_load_tracks(fx)
    return LD.known_track_ids(fx.chart_raw, known)


@register("date_ranges", O.DATE_RANGES)
def _date_ranges(spark, sf):
    return INC.missing_weather_ranges(_star(spark, sf))


@register("relink_weather", O.FACT_LOAD)
def _relink(spark, sf):
    fx = TD.load_fixture(spark, sf)
    # facts of 2001 loaded before their weather: weather_id still NULL
    stale = fx.fact.withColumn(
        "weather_id", F.when(F.col("date_id") >= 20010101, F.lit(None).cast("int")).otherwise(F.col("weather_id"))
    )
    return LD.relink_weather(stale, fx.dim_weather, fx.span)


# --- small operators on their own -----------------------------------------------------------

@register("parse_api_dates", O.PARSE_API_DATES)
def _api_dates(spark, sf):
    texts = TD.load_fixture(spark, sf).chart_raw.select(CAL.api_noon_label("chart_date").alias("api_date")).distinct()
    return texts.select("api_date", CAL.parse_api_date(F.col("api_date")).alias("chart_date"))


@register("genre_root", O.GENRE_ROOT)
def _genre_root(spark, sf):
    return TD.load_fixture(spark, sf).features_all.select(
        "song_uuid", "genres", SC.genre_root(F.col("genres")).alias("genre_root"),
        SC.genre_list_non_empty(F.col("genres")).alias("has_genre"))


@register("feature_coverage", O.FEATURE_COVERAGE)
def _coverage(spark, sf):
    return M.kpis(_star(spark, sf), MART_DE).select("unique_tracks", "tracks_with_features", "feature_coverage_pct")


@register("chart_dates", O.CHART_DATES)
def _chart_dates(spark, sf):
    s = _star(spark, sf)
    return s.fact.select("date_id", "country").distinct().join(s.calendar(s.dim_time), "date_id") \
        .select(F.col("date").alias("chart_date"), "country")


@register("chart_seasonal_bars", O.chart_seasonal_bars(None))
def _seasonal_bars(spark, sf):
    return CT.seasonal_bars(_star(spark, sf), MART_ALL)


@register("chart_acoustic_bars", O.chart_acoustic_bars(None, 10))
def _acoustic_bars(spark, sf):
    return CT.acoustic_bars(_star(spark, sf), MART_ALL)
