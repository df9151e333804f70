"""Warehouse loaders (LD-1 ... LD-6, GEN-1).

Each loader is a function ``DataFrame(s) -> DataFrame`` that returns the rows
to write; the dictionary lookups of a row-by-row loader become joins against
per-day calendar tables, and the row loops become projections.  Surrogate
keys are deterministic so every load can be re-run.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake import schemas as S
from chartlake.functions import calendar as cal
from chartlake.functions import scalars as sc
from chartlake.operators.dims import calendar_side, one_weather_per_date


# --- time dimension ---------------------------------------------------------

def build_dim_time(
    spark: SparkSession,
    start: _dt.date,
    end: _dt.date,
    existing: DataFrame | None = None,
    labels: C.Labels = C.Labels(),
) -> DataFrame:
    """Daily time dimension for [start, end], skipping dates already present
    (GEN-1, GEN-2, GEN-5)."""
    days = cal.date_spine(cal.literal_range(spark, start, end))
    if existing is not None:
        days = days.join(existing.select("date"), "date", "left_anti")
    return cal.dim_time_rows(days, "date", labels)


def dim_time_from_bounds(bounds: DataFrame, labels: C.Labels = C.Labels()) -> DataFrame:
    """Time dimension from a DataFrame of closed ranges (columns start, end)."""
    return cal.dim_time_rows(cal.date_spine(bounds), "date", labels)


def extend_dim_time(dim_time: DataFrame, today, labels: C.Labels = C.Labels()) -> DataFrame:
    """New time rows from max(date)+1 up to ``today`` (LD-6).

    Empty when the dimension is already current, and empty when the
    dimension is empty (a full load must run first).
    """
    today_col = cal.as_col(today) if not isinstance(today, str) else F.lit(today).cast("date")
    bounds = (
        dim_time.agg(F.max("date").alias("latest"))
        .select(F.date_add("latest", 1).alias("start"), today_col.alias("end"))
        .filter(F.col("start").isNotNull() & (F.col("start") <= F.col("end")))
    )
    return dim_time_from_bounds(bounds, labels)


# --- weather -----------------------------------------------------------------

def daily_weather(readings: DataFrame) -> DataFrame:
    """Mean over locations per day (AG-13); NULL readings are skipped for all
    four measures."""
    return readings.groupBy(F.col("date").cast("date").alias("date")).agg(
        F.avg("temperature_avg").alias("temperature_avg"),
        F.avg("precipitation_mm").alias("precipitation_mm"),
        F.avg("wind_speed_kmh").alias("wind_speed_kmh"),
        F.avg("sunshine_hours").alias("sunshine_hours"),
    )


def load_weather(daily: DataFrame, dim_time: DataFrame, span_days: int | None = None) -> DataFrame:
    """Weather dimension rows (LD-1): date -> date_id lookup, unmatched dates
    skipped; ``weather_id = date_id`` (one row per date).  ``span_days``: days
    the time dimension covers (see :func:`calendar_side`)."""
    keyed = daily.join(calendar_side(dim_time.select("date", "date_id"), span_days), "date", "inner")
    return keyed.select(
        F.col("date_id").alias("weather_id"),
        "date_id",
        "temperature_avg",
        "precipitation_mm",
        "wind_speed_kmh",
        "sunshine_hours",
    )


def skipped_dates(rows: DataFrame, dim_time: DataFrame, date_col: str = "date",
                  span_days: int | None = None) -> DataFrame:
    """Rows whose date is absent from the time dimension (JN-6 counter)."""
    return rows.join(
        calendar_side(dim_time.select(F.col("date").alias(date_col)), span_days), date_col, "left_anti"
    )


# --- tracks ------------------------------------------------------------------

def track_columns(features: DataFrame, default_name: str = C.DEFAULT_LOAD.default_name) -> list[Column]:
    """Projection staged features -> dim_track columns (SC-4, SC-5, SC-6, SC-10)."""
    f = F.col
    return [
        f("song_uuid").alias("track_id"),
        sc.with_default(f("song_name"), default_name).alias("track_name"),
        sc.with_default(f("artist_name"), default_name).alias("artist_names"),
        sc.genre_root(f("genres")).alias("genre"),
        sc.seconds_to_ms(f("duration")).alias("duration_ms"),
        f("release_date").cast("string").alias("release_date"),
        f("language_code").alias("language_code"),
        f("image_url").alias("image_url"),
        *[f(c).cast("double").alias(c) for c in S.AUDIO_DOUBLES],
        *[sc.nullable_int(f(c)).alias(c) for c in S.AUDIO_INTS],
    ]


def load_tracks(features: DataFrame, cfg: C.LoadConfig = C.DEFAULT_LOAD, order_col: str | None = None) -> DataFrame:
    """Track dimension rows from staged features (LD-2), one per song (see
    :func:`latest_staged`).  Rows without a song id are dropped (FL-11)."""
    one = latest_staged(features, order_col)
    return one.select(*track_columns(one, cfg.default_name))


# --- facts ------------------------------------------------------------------------

def fact_key(date_id, country, track_id) -> Column:
    """Deterministic fact key: the grain (date, country, track) as text, null-safe."""
    parts = [F.coalesce(cal.as_col(c).cast("string"), F.lit("")) for c in (date_id, country, track_id)]
    return F.concat_ws("|", *parts)


def load_facts(
    charts: DataFrame,
    dim_time: DataFrame,
    dim_weather: DataFrame,
    cfg: C.LoadConfig = C.DEFAULT_LOAD,
    span_days: int | None = None,
) -> DataFrame:
    """Fact rows from chart entries (LD-3).

    ``charts`` holds chart_date, song_uuid, streams, position and optionally
    country (else ``cfg.country``, SC-25).  The date lookup is an inner join
    (unmatched rows skipped, count them with :func:`skipped_dates`); the
    weather lookup is a left join (NULL when the date has no weather).
    """
    country = F.col("country") if "country" in charts.columns else F.lit(cfg.country)
    rows = charts.select(
        F.col("chart_date").cast("date").alias("date"),
        F.col("song_uuid").cast("string").alias("track_id"),
        country.alias("country"),
        sc.nullable_int(F.col("position")).alias("chart_position"),
        F.col("streams").try_cast("long").alias("stream_count"),
    ).filter(F.col("track_id").isNotNull())
    keyed = rows.join(calendar_side(dim_time.select("date", "date_id"), span_days), "date", "inner")
    linked = keyed.join(calendar_side(one_weather_per_date(dim_weather), span_days), "date_id", "left")
    return linked.select(
        fact_key("date_id", "country", "track_id").alias("fact_id"),
        "track_id",
        "date_id",
        "weather_id",
        "country",
        "stream_count",
        "chart_position",
    )


def relink_weather(fact: DataFrame, dim_weather: DataFrame, span_days: int | None = None) -> DataFrame:
    """Idempotent repair: fill weather_id of facts loaded before their weather."""
    lookup = one_weather_per_date(dim_weather).withColumnRenamed("weather_id", "_w")
    return fact.join(calendar_side(lookup, span_days), "date_id", "left").select(
        "fact_id", "track_id", "date_id",
        F.coalesce("weather_id", "_w").alias("weather_id"),
        "country", "stream_count", "chart_position",
    )


# --- incremental chart load (LD-4) --------------------------------------------

def first_per_key(df: DataFrame, key: str, order: list[Column], last: bool = False) -> DataFrame:
    """One row per ``key``: the first (or last) by ``order``.

    An aggregate (``min_by`` / ``max_by`` over the whole row), not a window:
    it combines map side, so a key holding a third of all rows never piles
    up in one task.  The full row is appended to the order as a tie-break, so
    the pick is deterministic.
    """
    cols = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(c) for c in cols])
    rank = F.struct(*order, row)
    pick = F.max_by(row, rank) if last else F.min_by(row, rank)
    return df.groupBy(key).agg(pick.alias("_row")).select(key, *[F.col("_row").getField(c).alias(c) for c in cols])


def placeholder_tracks(
    entries: DataFrame, dim_track: DataFrame, cfg: C.LoadConfig = C.DEFAULT_LOAD
) -> DataFrame:
    """Track rows for chart ids not yet in the dimension (JN-10, LD-4).

    One row per new id even when the id is charted several times: the name
    and artist come from its first entry by (chart_date, position).  Audio
    columns stay NULL ("features not fetched yet").
    """
    keep = ["song_uuid", "chart_date", "position", "song_name", "artist_name"]
    if "image_url" in entries.columns:
        keep.append("image_url")
    candidates = (
        entries.filter(F.col("song_uuid").isNotNull())
        .select(*keep)
        .join(dim_track.select(F.col("track_id").alias("song_uuid")), "song_uuid", "left_anti")
    )
    order = [F.coalesce(F.col("chart_date"), F.lit("9999-12-31").cast("date")),
             F.coalesce(F.col("position"), F.lit(2**31 - 1))]
    new = first_per_key(candidates, "song_uuid", order)
    cols = {
        "track_id": F.col("song_uuid"),
        "track_name": sc.with_default(F.col("song_name"), cfg.default_name),
        "artist_names": sc.with_default(F.col("artist_name"), cfg.default_name),
        "image_url": F.col("image_url") if "image_url" in entries.columns else F.lit(None).cast("string"),
    }
    return new.select(
        *[
            (cols[fld.name] if fld.name in cols else F.lit(None).cast(fld.dataType)).alias(fld.name)
            for fld in S.DIM_TRACK.fields
        ]
    )


def new_chart_facts(
    entries: DataFrame,
    dim_time: DataFrame,
    dim_weather: DataFrame,
    existing_fact: DataFrame,
    cfg: C.LoadConfig = C.DEFAULT_LOAD,
    span_days: int | None = None,
) -> DataFrame:
    """Facts of chart entries not loaded yet (LD-4, idempotent by fact_id).

    Entries repeated inside the batch (a replayed page, a track at two
    positions) collapse to one fact, the best position.  The existing facts are first cut to the dates being loaded (a per-day key
    set, broadcast), so the key anti-join touches only those weeks, not the
    whole fact table.
    """
    facts = load_facts(entries, dim_time, dim_weather, cfg, span_days)
    dates = calendar_side(facts.select("date_id").distinct(), span_days)
    touched = existing_fact.select("fact_id", "date_id").join(dates, "date_id", "left_semi")
    new = facts.join(touched.select("fact_id"), "fact_id", "left_anti")
    order = [F.coalesce(F.col("chart_position"), F.lit(2**31 - 1)), -F.coalesce(F.col("stream_count"), F.lit(0))]
    return first_per_key(new, "fact_id", order)


# --- feature merge (LD-5) -----------------------------------------------------------

def latest_staged(staged: DataFrame, order_col: str | None = None) -> DataFrame:
    """One staged row per song: the last one by ``order_col`` wins; without an
    order column, or where it ties, the greatest row by its columns in order."""
    order = [F.col(order_col)] if order_col else []
    return first_per_key(staged.filter(F.col("song_uuid").isNotNull()), "song_uuid", order, last=True)


def feature_changes(staged: DataFrame, order_col: str | None = None) -> DataFrame:
    """Staged features -> one change per song (TRACK_CHANGE): the values a merge
    applies.  Work in proportion to the staged rows; the dimension is not read."""
    s = latest_staged(staged, order_col)
    cols = {
        "track_id": F.col("song_uuid"),
        "track_name": F.col("song_name"),
        "artist_names": F.col("artist_name"),
        "genre": sc.genre_root(F.col("genres")),
        "duration_ms": sc.seconds_to_ms(F.col("duration")),
        "release_date": F.col("release_date").cast("string"),
        "language_code": F.col("language_code"),
        "image_url": F.col("image_url"),
        **{c: F.col(c).cast("double") for c in S.AUDIO_DOUBLES},
        **{c: sc.nullable_int(F.col(c)) for c in S.AUDIO_INTS},
        "genre_set": F.coalesce(sc.genre_list_non_empty(F.col("genres")), F.lit(False)),
    }
    return s.select(*[cols[f.name].alias(f.name) for f in S.TRACK_CHANGE.fields])


def overlay_changes(tracks: DataFrame, changes: DataFrame, seq: str, broadcast: bool = False) -> DataFrame:
    """Track rows with all later changes applied, in order (merge on read).

    Both sides carry ``seq``; a change applies to a track row that is not younger
    than it, so changes of tracks that were not known then never apply (JN-15).
    Name and artist are the last ones that are not NULL, the genre the last one
    whose text named a genre, every other column that of the last change, even
    NULL.  A track has at most one change per merge, so its list is as short as
    the number of merges since the last compaction."""
    values = [f.name for f in S.TRACK_CHANGE.fields if f.name != "track_id"]
    per_track = changes.groupBy("track_id").agg(
        F.sort_array(F.collect_list(F.struct(seq, *values)), asc=False).alias("_changes"))
    j = tracks.join(F.broadcast(per_track) if broadcast else per_track, "track_id", "left") \
        .withColumn("_later", F.filter("_changes", lambda c: c[seq] >= F.col(seq)))
    last = F.get(F.col("_later"), F.lit(0))

    def value(n: str) -> Column:
        if n == "track_id":
            return F.col(n)
        if n in ("track_name", "artist_names"):
            return F.coalesce(F.get(F.filter("_later", lambda c: c[n].isNotNull()), F.lit(0))[n], F.col(n))
        if n == "genre":
            named = F.get(F.filter("_later", lambda c: c["genre_set"]), F.lit(0))
            return F.when(named.isNotNull(), named[n]).otherwise(F.col(n))
        return F.when(last.isNotNull(), last[n]).otherwise(F.col(n))

    return j.select(*[value(f.name).alias(f.name) for f in S.DIM_TRACK.fields])


def merge_track_features(dim_track: DataFrame, staged: DataFrame, order_col: str | None = None) -> DataFrame:
    """The track dimension with staged features applied (LD-5).

    Only known tracks change (unmatched staged rows are ignored, JN-15).
    Name and artist change only when the staged value is not NULL; every
    other column is overwritten, even by NULL; the genre changes only when
    the staged text parses to a non-empty list.
    """
    return overlay_changes(dim_track.withColumn("_seq", F.lit(0)), feature_changes(staged, order_col).withColumn("_seq", F.lit(1)), "_seq")


def updated_track_count(dim_track: DataFrame, staged: DataFrame) -> DataFrame:
    """Number of known tracks the merge touches (the loader's return value)."""
    ids = staged.select(F.col("song_uuid").alias("track_id")).distinct()
    return dim_track.select("track_id").join(ids, "track_id", "left_semi").agg(F.count(F.lit(1)).alias("updated"))


# --- key sets (ST-2, ST-5, JN-10, JN-11) ------------------------------------------------

def charted_ids(entries: DataFrame) -> DataFrame:
    """Distinct non-NULL song ids of chart entries (ST-5)."""
    return entries.select(F.col("song_uuid").alias("track_id")).filter(F.col("track_id").isNotNull()).distinct()


def new_track_ids(entries: DataFrame, dim_track: DataFrame) -> DataFrame:
    """Charted ids not in the track dimension (JN-10, ST-2)."""
    return charted_ids(entries).join(dim_track.select("track_id"), "track_id", "left_anti")


def known_track_ids(entries: DataFrame, dim_track: DataFrame) -> DataFrame:
    """Charted ids already in the track dimension (JN-11)."""
    return charted_ids(entries).join(dim_track.select("track_id"), "track_id", "left_semi")
