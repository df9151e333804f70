"""Full and incremental warehouse loads (LD-13, LD-14) on parquet tables.

Tables are sets of batch folders named by a commit log (``commit_log``): a load
stages all its batches and publishes them with one log file, so readers see
the warehouse before it or after it and never a part of it.  Appends are made
idempotent by anti-joins on the deterministic keys.

* ``fact_track_chart`` is partitioned by country, the filter every mart applies;
  small batches are compacted, so the number of files does not grow with the
  number of loads.
* ``dim_track`` is merged on read: a feature merge writes its staged rows as a
  batch of changes, and readers lay the changes over the tracks.  Past a ratio
  of changes to tracks, or a number of batches, both are rewritten as one.

A warehouse without a log (tables as plain folders, ``dim_track/v=<n>``) is still
read; a load into it starts a log with its tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake import schemas as S
from chartlake.functions import calendar as cal
from chartlake.operators import incremental as inc
from chartlake.operators import loaders as ld
from chartlake.operators import quality as q
from chartlake.operators import sketches as sk
from chartlake.operators.dims import Star
from chartlake.plans import commit_log as log
from chartlake.plans.commit_log import Snapshot, Transaction

#: Changes that are broadcast to the tracks on read (some 300 bytes each).
BROADCAST_CHANGES = 100_000
#: Tracks are rewritten when changes exceed this share of them ...
CHANGE_RATIO = 0.2
#: ... or when there are more batches of tracks or changes than this.
TRACK_BATCHES = 16
#: Batches of any other table below this size are rewritten as one when there are ``FANOUT`` of them.
SMALL_ROWS = 5_000_000
FANOUT = 16
#: Times a load is staged where other writers publish first.
ATTEMPTS = 3
#: Versions that stay readable.
KEEP_VERSIONS = 10


def _p(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


# --- tables without a log --------------------------------------------------------------

def track_versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of the track dimension of a warehouse without a log, in order."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(_p(root, "dim_track"))
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [f.getPath() for f in fs.listStatus(base)] if fs.exists(base) else []
    return sorted(int(p.getName()[2:]) for p in found if p.getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def _version_path(root: str, version: int) -> str:
    return f"{_p(root, 'dim_track')}/v={version}"


def write_dim_track_version(df: DataFrame, root: str, version: int, append: bool = False) -> None:
    """Write a complete track dimension as ``version``, or append new tracks to it."""
    log.conform(df, S.DIM_TRACK).write.mode("append" if append else "overwrite").parquet(_version_path(root, version))


def prune_track_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all versions but the last ``keep``."""
    for v in track_versions(spark, root)[:-keep]:
        log.delete(spark, _version_path(root, v))


def _read_plain(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = _version_path(root, track_versions(spark, root)[-1]) if name == "dim_track" else _p(root, name)
    return spark.read.schema(S.WAREHOUSE[name]).parquet(path)


def _plain_tables(spark: SparkSession, root: str) -> list[str]:
    """Tables of a warehouse without a log."""
    from chartlake.sources.staging import path_exists

    return [name for name in S.WAREHOUSE if (track_versions(spark, root) if name == "dim_track" else path_exists(spark, _p(root, name)))]


# --- read / write ------------------------------------------------------------------

def read_table(spark: SparkSession, root: str, name: str, at: Snapshot | None = None) -> DataFrame:
    """One table with its declared schema, in the last published state or in the state ``at``."""
    at = log.current(spark, root) if at is None else at
    if not at.version and not at.batches:
        return _read_plain(spark, root, name)
    if name == "dim_track" and at.of(name, "changes"):
        changes = log.read_batches(spark, root, name, at.of(name, "changes"), with_seq="_seq")
        tracks = log.read_batches(spark, root, name, at.of(name), with_seq="_seq")
        return ld.overlay_changes(tracks, changes, "_seq", broadcast=at.rows(name, "changes") <= BROADCAST_CHANGES)
    return log.read_batches(spark, root, name, at.of(name))


def read_dim_track(spark: SparkSession, root: str, at: Snapshot | None = None) -> DataFrame:
    """The track dimension with all its changes."""
    return read_table(spark, root, "dim_track", at)


def calendar_days(dim_time: DataFrame) -> int | None:
    """Days spanned by a time dimension (min/max of one small column): the
    size bound of every per-day table of the star."""
    row = dim_time.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    if row is None or row["lo"] is None:
        return None
    return (row["hi"] - row["lo"]).days + 1


def read_star(spark: SparkSession, root: str, at: Snapshot | None = None) -> Star:
    """The four tables of one state of the warehouse: the last published one, an
    older one (``commit_log.read_version``) or the view of a transaction."""
    at = log.current(spark, root) if at is None else at
    tables = {name: read_table(spark, root, name, at) for name in S.WAREHOUSE}
    return Star(dim_time=tables["dim_time"], dim_track=tables["dim_track"], dim_weather=tables["dim_weather"],
                fact=tables["fact_track_chart"], calendar_days=calendar_days(tables["dim_time"]))


def begin(spark: SparkSession, root: str) -> Transaction:
    """A transaction on the last published state.  Tables of a warehouse without
    a log become its first batches."""
    tx = Transaction(spark, root)
    if not tx.base.version:
        for name in _plain_tables(spark, root):
            tx.append(_read_plain(spark, root, name), name)
    return tx


def compact(tx: Transaction) -> Transaction:
    """Rewrite what has become too scattered, inside the transaction."""
    spark, root = tx.spark, tx.root
    tracks, changes = tx.view.of("dim_track"), tx.view.of("dim_track", "changes")
    changed = sum(b.rows for b in changes)
    if changed > CHANGE_RATIO * sum(b.rows for b in tracks) or len(tracks) + len(changes) > TRACK_BATCHES:
        tx.replace(read_dim_track(spark, root, tx.view), "dim_track", tracks + changes)
    for name in S.STORED:
        small = [b for b in tx.view.of(name) if b.rows < SMALL_ROWS]
        if name != "dim_track" and len(small) >= FANOUT:
            tx.replace(log.read_batches(spark, root, name, small), name, small)
    return tx


def publish(spark: SparkSession, root: str, stage: Callable[[Transaction], None]) -> Snapshot:
    """Run ``stage`` in a transaction, compact and commit.  Where another writer
    publishes first, stage anew on its state.  Now and then, batches and log
    files that only old versions name are deleted."""
    for attempt in range(ATTEMPTS):
        tx = begin(spark, root)
        stage(tx)
        try:
            at = compact(tx).commit()
        except log.CommitConflict:
            if attempt == ATTEMPTS - 1:
                raise
            continue
        if at.version % KEEP_VERSIONS == 0 and at.version != tx.base.version:
            log.vacuum(spark, root, keep=KEEP_VERSIONS)
        return at
    raise AssertionError("no attempt was made")


def merge_features(spark: SparkSession, root: str, staged: DataFrame, order_col: str | None = None) -> Snapshot:
    """Merge staged features into the published track dimension (SNK-4, LD-5):
    bytes written grow with the staged rows, not with the dimension."""
    return publish(spark, root, lambda tx: tx.append(ld.feature_changes(staged, order_col), "dim_track", "changes"))


def facts_between(tx: Transaction, low: int | None, high: int | None) -> DataFrame:
    """Facts of the batches whose dates meet the closed range [low, high]: the log
    keeps each batch's range, so other batches are not even listed."""
    near = [b for b in tx.view.of("fact_track_chart") if low is not None and b.low <= high and b.high >= low]
    return log.read_batches(tx.spark, tx.root, "fact_track_chart", near)


# --- sketches of distinct tracks (AG-5, approximate) ---------------------------------

def _sketched(spark: SparkSession, root: str, at: Snapshot) -> tuple[DataFrame, DataFrame, list[log.Batch]]:
    """(stored sketches of the fact batches of ``at``, other stored ones, fact batches without a sketch)"""
    stored = log.read_batches(spark, root, "track_sketch", at.of("track_sketch"))
    names = [b.name for b in at.of("fact_track_chart")]
    done = {r["of_batch"] for r in stored.select("of_batch").distinct().collect()}  # one row a batch
    ours = F.col("of_batch").isin(names) if names else F.lit(False)
    return stored.filter(ours), stored.filter(~ours), [b for b in at.of("fact_track_chart") if b.name not in done]


def _sketch(spark: SparkSession, root: str, batches: list[log.Batch]) -> DataFrame:
    return sk.week_sketches(log.read_batches(spark, root, "fact_track_chart", batches, with_name="of_batch"), "of_batch")


def store_sketches(spark: SparkSession, root: str) -> Snapshot:
    """Sketch the fact batches that have no sketch yet; each is read once in its life."""
    tx = begin(spark, root)
    ours, stale, missing = _sketched(spark, root, tx.view)
    if not missing:
        return tx.base
    new = _sketch(spark, root, missing)
    if stale.isEmpty():
        tx.append(new, "track_sketch")
    else:  # sketches of batches that were compacted away go
        tx.replace(ours.unionByName(new), "track_sketch", tx.view.of("track_sketch"))
    return tx.commit()


def read_sketches(spark: SparkSession, root: str, at: Snapshot | None = None) -> DataFrame:
    """(country, date_id, of_batch, entries, sketch) of all facts: stored ones, and
    sketches made now for batches that have none."""
    at = log.current(spark, root) if at is None else at
    ours, _, missing = _sketched(spark, root, at)
    return ours.unionByName(_sketch(spark, root, missing)) if missing else ours


def create_warehouse(spark: SparkSession, root: str) -> list[str]:
    """Publish an empty warehouse if there is none (SNK-5).  Returns the names of
    the tables created; tables that are there are left untouched."""
    tx = begin(spark, root)
    if tx.base.version:
        return []
    created = [name for name in S.WAREHOUSE if name not in _plain_tables(spark, root)]
    if created:
        tx.commit()
    return created


# --- full load ------------------------------------------------------------------------

@dataclass(frozen=True)
class Sources:
    """Landed inputs of a full load."""

    chart_entries: DataFrame     # chart_date, song_uuid, streams, position [, country, names]
    features: DataFrame          # staged song features (SONG_FEATURES)
    weather_readings: DataFrame  # date, location, four measures (WEATHER_READING)
    start: _dt.date | None = None
    end: _dt.date | None = None
    dim_time: DataFrame | None = None  # pre-built calendar (else start..end)


def build_star(spark: SparkSession, src: Sources, cfg: C.LoadConfig = C.DEFAULT_LOAD,
               labels: C.Labels = C.Labels()) -> Star:
    """The four warehouse tables of a full load, as lazy DataFrames."""
    if src.dim_time is not None:
        dim_time, span = src.dim_time, calendar_days(src.dim_time)
    else:
        dim_time = ld.build_dim_time(spark, src.start, src.end, labels=labels)
        span = (src.end - src.start).days + 1
    dim_weather = ld.load_weather(ld.daily_weather(src.weather_readings), dim_time, span)
    dim_track = ld.load_tracks(src.features, cfg)
    fact = ld.load_facts(src.chart_entries, dim_time, dim_weather, cfg, span)
    return Star(dim_time=dim_time, dim_track=dim_track, dim_weather=dim_weather, fact=fact, calendar_days=span)


def write_star(star: Star, root: str) -> None:
    """Publish a star: the four tables in one commit (dimensions staged first)."""
    tx = begin(star.dim_time.sparkSession, root)
    tx.append(star.dim_time, "dim_time")
    tx.append(star.dim_weather, "dim_weather")
    tx.replace(star.dim_track, "dim_track", tx.view.of("dim_track") + tx.view.of("dim_track", "changes"))
    tx.append(star.fact, "fact_track_chart")
    tx.commit()


def load_star(spark: SparkSession, src: Sources, root: str, cfg: C.LoadConfig = C.DEFAULT_LOAD) -> Transaction:
    """Stage a full load into ``root``, row by key: every append leaves out the
    keys that are there already, so a load that is run again adds nothing.
    Nothing is visible before the transaction is committed."""
    create_warehouse(spark, root)
    tx = begin(spark, root)
    star, old = build_star(spark, src, cfg), read_star(spark, root, tx.view)
    tx.append(star.dim_time.join(old.dim_time.select("date_id"), "date_id", "left_anti"), "dim_time")
    tx.append(star.dim_weather.join(old.dim_weather.select("date_id"), "date_id", "left_anti"), "dim_weather")
    tx.append(star.dim_track.join(old.dim_track.select("track_id"), "track_id", "left_anti"), "dim_track")
    staged = read_star(spark, root, tx.view)
    # a first load has no facts to read; a later one meets those of all dates
    facts = ld.new_chart_facts(src.chart_entries, staged.dim_time, staged.dim_weather, staged.fact, cfg, staged.calendar_days)
    tx.append(facts, "fact_track_chart")
    return tx


class LoadFailed(Exception):
    """A full load whose tables break a rule of severity ``error``."""


def build_warehouse(spark: SparkSession, src: Sources, root: str, expected_days: int | None = None,
                    cfg: C.LoadConfig = C.DEFAULT_LOAD) -> DataFrame:
    """Full load (LD-13): build, stage, validate the staged tables, publish.

    Returns the data-quality report of the published warehouse.  A failed write
    raises, which stops the load at that step; so does a failed error rule.
    Either way the warehouse stays as it was.
    """
    tx = load_star(spark, src, root, cfg)
    written = read_star(spark, root, tx.view)
    exp = expected_days
    if exp is None and src.start is not None and src.end is not None:
        exp = (src.end - src.start).days + 1
    if exp is None:
        exp_col = written.dim_time.agg(cal.span_days(F.min("date"), F.max("date"))).scalar()
    else:
        exp_col = F.lit(exp)
    report = q.dq_report(written, exp_col)
    failed = [r["rule"] for r in report.filter("severity = 'error' and not passed").select("rule").collect()]  # six rules at most
    if failed:
        raise LoadFailed(f"rules not met: {', '.join(failed)}")
    compact(tx).commit()
    return report


def row_counts(star: Star) -> DataFrame:
    """(table, rows) for the four tables; one small job per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in star.tables().items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- incremental load -------------------------------------------------------------------

@dataclass(frozen=True)
class Landing:
    """Newly landed inputs of an incremental run (any of them may be None)."""

    chart_entries: DataFrame | None = None
    weather_readings: DataFrame | None = None
    features: DataFrame | None = None


def refresh_warehouse(spark: SparkSession, root: str, landing: Landing, today,
                      cfg: C.LoadConfig = C.DEFAULT_LOAD) -> DataFrame:
    """Incremental load (LD-14): extend time, then load weather, charts and
    features for what is missing, published in one commit.  Every step is
    idempotent, so a re-run (or a retry after a lost executor) loads nothing
    twice.  Returns what is still missing after the run (the incremental plan of
    the new state)."""
    def stage(tx: Transaction) -> None:
        # 1. calendar
        tx.append(ld.extend_dim_time(read_table(spark, root, "dim_time", tx.view), today), "dim_time")
        # 2. weather for dates without weather
        if landing.weather_readings is not None:
            star = read_star(spark, root, tx.view)
            daily = ld.daily_weather(landing.weather_readings)
            new = ld.load_weather(daily, star.dim_time, star.calendar_days).join(
                star.dim_weather.select("date_id"), "date_id", "left_anti")
            tx.append(new, "dim_weather")
        # 3. charts: placeholder tracks for unknown ids, then new facts
        if landing.chart_entries is not None:
            stage_charts(tx, landing.chart_entries, cfg)
        # 4. features for tracks without them
        if landing.features is not None:
            tracks = read_dim_track(spark, root, tx.view)
            wanted = tracks.filter(F.col("danceability").isNull()).select(F.col("track_id").alias("song_uuid"))
            tx.append(ld.feature_changes(landing.features.join(wanted, "song_uuid", "left_semi")), "dim_track", "changes")

    publish(spark, root, stage)
    return inc.incremental_plan(read_star(spark, root))


def stage_charts(tx: Transaction, entries: DataFrame, cfg: C.LoadConfig = C.DEFAULT_LOAD) -> None:
    """Stage chart entries (LD-4): placeholder tracks for unknown ids, then the
    facts not there yet.  Only fact batches with dates of the entries are read."""
    star = read_star(tx.spark, tx.root, tx.view)
    tx.append(ld.placeholder_tracks(entries, star.dim_track, cfg), "dim_track")
    day = cal.date_key(F.col("chart_date").cast("date"))
    low, high = entries.agg(F.min(day), F.max(day)).first()
    tx.append(ld.new_chart_facts(entries, star.dim_time, star.dim_weather, facts_between(tx, low, high), cfg, star.calendar_days), "fact_track_chart")
