"""Star schema derived from the TPC-H-style test tables (FIXTURES.md B).

The reference reads API dumps that are not in the tree, so the registered
queries derive the four warehouse tables from ``lineitem``, ``part`` and
``nation`` by fixed rules.  Every derived table grows with its input:

* ``chart_raw``: one row per (chart Sunday, country, part) from lineitem,
  every one with its position in the week's chart;
* ``weather_raw``: time dimension x all nations (explode of the fixed 25-row
  table as one array, not a cross join);
* ``dim_track`` from ``part``; ``features_all`` from every part;
  ``features_staged`` too, but a seventh of the songs come under a new id, so
  merges and backlogs meet unmatched ids on both sides.

The loaders of :mod:`chartlake.operators.loaders` turn these into the
warehouse tables, exactly as a production load would.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake import config as C
from chartlake import schemas as S
from chartlake.functions import calendar as cal
from chartlake.functions import scalars as sc
from chartlake.operators import loaders as ld
from chartlake.operators.dims import Star
from chartlake.operators.ranges import ordered_index
from chartlake.session import cut_lineage

# Fixed values of the fixture rules (FIXTURES.md B).
# ---------------------------------------------------------------------------
TAIL_DAYS = 28              # time dimension runs 28 days past the last shipdate
WEATHER_LAST_DAY = 29       # weather only on day-of-month < 30
RAIN_EPOCH = "1995-01-01"   # wet spell: 14 of every 70 days from this date
AT_SUPPKEY_MOD = 4          # l_suppkey % 4 == 0 -> country 'at', else 'de'
# Event periods and baseline year for the period comparison on this data.
PERIODS = (
    (_dt.date(1993, 6, 1), _dt.date(1993, 9, 30)),
    (_dt.date(1995, 1, 15), _dt.date(1995, 4, 10)),
    (_dt.date(1995, 4, 1), _dt.date(1995, 7, 31)),  # overlaps the one before
)
BASELINE = (_dt.date(1998, 1, 1), _dt.date(1998, 12, 31))
# ---------------------------------------------------------------------------

MART = C.MartConfig(periods=PERIODS, baseline=BASELINE)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ratio(n: Column, mod: int) -> Column:
    """((n) % mod) / mod as double (integer part cast before dividing)."""
    return (n % mod).cast("double") / float(mod)


class Fixture:
    """The derived tables, each built when it is first asked for.

    With ``materialize`` the two results computed from ``lineitem`` -- the
    calendar bounds (one row) and the ranked weekly charts -- are checkpointed
    into the shared checkpoint folder, so a query that uses the fact table in
    several branches aggregates ``lineitem`` once instead of once per branch.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, labels: C.Labels = C.Labels(), materialize: bool = True):
        self.labels = labels
        self._keep = cut_lineage if materialize else (lambda df: df)
        self.lineitem = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
        self.part = read_table(spark, sf_dir, "part")
        self.nation = read_table(spark, sf_dir, "nation")

    @cached_property
    def bounds(self) -> DataFrame:
        """One row: first_ship, last_ship."""
        return self._keep(ship_bounds(self.lineitem))

    @cached_property
    def span(self) -> int | None:
        return calendar_span(self.bounds)

    @cached_property
    def chart_raw(self) -> DataFrame:
        return self._keep(rank_charts(chart_totals(self.lineitem)))

    @cached_property
    def dim_time(self) -> DataFrame:
        return fixture_dim_time(self.bounds, self.labels)

    @cached_property
    def weather_raw(self) -> DataFrame:
        return fixture_weather_raw(self.bounds, self.nation)

    @cached_property
    def dim_weather(self) -> DataFrame:
        return ld.load_weather(ld.daily_weather(weather_readings(self.weather_raw)), self.dim_time, self.span)

    @cached_property
    def dim_track(self) -> DataFrame:
        return fixture_dim_track(self.part)

    @cached_property
    def features_all(self) -> DataFrame:
        return fixture_features(self.part)

    @cached_property
    def features_staged(self) -> DataFrame:
        song = F.col("song_uuid")
        return self.features_all.withColumn("song_uuid", F.when(song.cast("long") % 7 == 0, F.concat(F.lit("x"), song)).otherwise(song))

    @cached_property
    def fact(self) -> DataFrame:
        return ld.load_facts(self.chart_raw, self.dim_time, self.dim_weather, span_days=self.span)

    @cached_property
    def plain_star(self) -> Star:
        """The star without chart positions, for queries that do not name them: their facts need no order of all entries."""
        entries = self._keep(chart_totals(self.lineitem)).withColumn("position", F.lit(None).cast("int"))
        fact = ld.load_facts(entries, self.dim_time, self.dim_weather, span_days=self.span)
        return Star(dim_time=self.dim_time, dim_track=self.dim_track, dim_weather=self.dim_weather, fact=fact, calendar_days=self.span)

    @cached_property
    def star(self) -> Star:
        return Star(dim_time=self.dim_time, dim_track=self.dim_track, dim_weather=self.dim_weather, fact=self.fact,
                    calendar_days=self.span)


def ship_bounds(lineitem: DataFrame) -> DataFrame:
    """One row: first and last ship date (a global aggregate, partial per task)."""
    return lineitem.agg(
        F.min("l_shipdate").cast("date").alias("first_ship"),
        F.max("l_shipdate").cast("date").alias("last_ship"),
    )


def calendar_span(bounds: DataFrame) -> int | None:
    """Days covered by the fixture calendar, read from the one-row bounds
    table (metadata for the broadcast decision, not data)."""
    row = bounds.first()
    if row is None or row["first_ship"] is None:
        return None
    return (row["last_ship"] - row["first_ship"]).days + 1 + TAIL_DAYS


def fixture_dim_time(bounds: DataFrame, labels: C.Labels = C.Labels()) -> DataFrame:
    """Every day from the first ship date to the last one plus the tail."""
    rng = bounds.select(F.col("first_ship").alias("start"), F.date_add("last_ship", TAIL_DAYS).alias("end"))
    return ld.dim_time_from_bounds(rng, labels)


def fixture_weather_raw(bounds: DataFrame, nation: DataFrame) -> DataFrame:
    """Readings per (day, location) in the weather_raw shape of FIXTURES.md."""
    spine = bounds.select(
        F.explode(F.sequence("first_ship", "last_ship", F.expr("interval 1 day"))).alias("date")
    )
    # nation is a fixed 25-row table: one array
    locs = nation.agg(F.collect_list(F.struct(F.col("n_nationkey").alias("n"), F.col("n_name").alias("location")))).scalar()
    r = spine.filter(F.dayofmonth("date") <= WEATHER_LAST_DAY).withColumn("locs", locs) \
        .select("date", F.inline("locs"))
    did = cal.date_key(F.col("date"))
    month = F.month("date")
    n = F.col("n")
    wet = (F.datediff(F.col("date"), F.lit(RAIN_EPOCH).cast("date")) % 70) < 14
    return r.select(
        "date",
        "location",
        (24 - 4 * F.abs(month - 7) + ((did * 7 + n * 13) % 50).cast("double") / 10).alias("temperature_2m_mean"),
        ((F.when(wet, 60).otherwise(5) + (did + n * 5) % 20).cast("double") / 10).alias("precipitation_sum"),
        (((did * 3 + n * 7) % 400).cast("double") / 10).alias("windspeed_10m_max"),
        F.greatest(F.lit(0), 3600 * (14 - 3 * F.abs(month - 6)) + (did * 31 + n * 17) % 1800)
        .cast("double")
        .alias("sunshine_duration"),
    )


def weather_readings(weather_raw: DataFrame) -> DataFrame:
    """API reading -> weather record (SC-3: sunshine seconds to hours)."""
    return weather_raw.select(
        "date",
        "location",
        F.col("temperature_2m_mean").alias("temperature_avg"),
        F.col("precipitation_sum").alias("precipitation_mm"),
        F.col("windspeed_10m_max").alias("wind_speed_kmh"),
        sc.seconds_to_hours("sunshine_duration").alias("sunshine_hours"),
    )


def chart_totals(lineitem: DataFrame) -> DataFrame:
    """Weekly streams per (chart Sunday, country, part), before the cut."""
    sunday = cal.sunday_on_or_after(F.col("l_shipdate"))
    # group on a boolean and the numeric part key (cheap to hash), label after
    is_at = F.col("l_suppkey") % AT_SUPPKEY_MOD == 0
    return (
        lineitem.select(sunday.alias("chart_date"), is_at.alias("_at"), "l_partkey", "l_quantity")
        .groupBy("chart_date", "_at", "l_partkey")
        .agg((F.sum("l_quantity") * 1000).cast("long").alias("streams"))
        .select(
            "chart_date",
            F.when(F.col("_at"), F.lit("at")).otherwise(F.lit("de")).alias("country"),
            F.col("l_partkey").cast("string").alias("song_uuid"),
            "streams",
        )
    )


def rank_charts(totals: DataFrame) -> DataFrame:
    """Position of every entry in its (country, week) by streams desc, song id.

    One ordered index over all entries minus the first index of the group, so
    no task holds a whole group, however hot the country or the week is.
    """
    week = ["country", "chart_date"]
    indexed = ordered_index(totals, [*[F.col(c).asc() for c in week], F.col("streams").desc(), F.col("song_uuid").asc()], name="_i")
    first = indexed.groupBy(*week).agg(F.min("_i").alias("_first"))
    return indexed.join(first, week).withColumn("position", (F.col("_i") - F.col("_first") + 1).cast("int")) \
        .select(*totals.columns, "position")


def fixture_dim_track(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    nul = lambda mod, v: F.when(k % mod == 0, F.lit(None).cast("double")).otherwise(v)
    cols = {
        "track_id": k.cast("string"),
        "track_name": F.col("p_name"),
        "artist_names": F.col("p_brand"),
        "genre": F.col("p_type"),
        "duration_ms": (F.col("p_size") * 10000).cast("int"),
        "release_date": F.lit(None).cast("string"),
        "language_code": F.when(k % 3 == 0, F.lit("de")).otherwise(F.lit("en")),
        "image_url": F.concat(F.lit("cover/"), k.cast("string"), F.lit(".jpg")),
        "danceability": nul(20, _ratio(k * 37, 1000)),
        "energy": nul(20, _ratio(k * 53, 1000)),
        "valence": nul(25, _ratio(k * 91, 1000)),
        "tempo": (60 + (k * 7) % 140).cast("double"),
        "loudness": ((0 - (k * 11) % 600).cast("double") / 10),
        "speechiness": _ratio(k * 19, 1000),
        "acousticness": nul(30, _ratio(k * 71, 1000)),
        "instrumentalness": _ratio(k * 17, 1000),
        "liveness": _ratio(k * 13, 1000),
        "key": F.when(k % 17 == 0, F.lit(None)).otherwise(k % 13).cast("int"),
        "mode": F.when(k % 19 == 0, F.lit(None)).otherwise(k % 2).cast("int"),
        "time_signature": (3 + k % 2).cast("int"),
    }
    return part.select(*[cols[f.name].alias(f.name) for f in S.DIM_TRACK.fields])


def fixture_features(part: DataFrame) -> DataFrame:
    """Staged feature rows, one per part."""
    k = F.col("p_partkey")
    genres = (
        F.when(k % 4 == 0, F.concat(F.lit('[{"root":"'), F.col("p_type"), F.lit('"}]')))
        .when(k % 4 == 1, F.lit("[]"))
        .when(k % 4 == 2, F.lit("not json"))
    )
    cols = {
        "song_uuid": k.cast("string"),
        "song_name": F.when(k % 6 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.col("p_name"), F.lit(" v2"))),
        "artist_name": F.col("p_brand"),
        "isrc": F.lit(None).cast("string"),
        "release_date": F.lit(None).cast("string"),
        "duration": F.col("p_size") * 1.5,
        "explicit": (k % 2 == 0),
        "language_code": F.lit("de"),
        "acousticness": _ratio(k * 23, 1000),
        "danceability": F.when(k % 9 == 0, F.lit(None).cast("double")).otherwise(_ratio(k * 29, 1000)),
        "energy": _ratio(k * 31, 1000),
        "instrumentalness": _ratio(k * 41, 1000),
        "key": (k % 12).cast("int"),
        "liveness": _ratio(k * 43, 1000),
        "loudness": ((0 - (k * 7) % 600).cast("double") / 10),
        "mode": ((k + 1) % 2).cast("int"),
        "speechiness": _ratio(k * 47, 1000),
        "tempo": (70 + (k * 3) % 120).cast("double"),
        "time_signature": F.lit(4),
        "valence": F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(_ratio(k * 59, 1000)),
        "image_url": F.lit(None).cast("string"),
        "genres": genres,
        "copyright": F.lit(None).cast("string"),
    }
    return part.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in S.SONG_FEATURES.fields])


def load_fixture(spark: SparkSession, sf_dir: str, labels: C.Labels = C.Labels(), materialize: bool = True) -> Fixture:
    """The derived tables of the test star schema."""
    return Fixture(spark, sf_dir, labels, materialize)


def fixture_locations(nation: DataFrame) -> DataFrame:
    """Every nation as a weather location with made-up coordinates."""
    n = F.col("n_nationkey")
    return nation.select(n.alias("location_id"), F.col("n_name").alias("location"),
                         ((n * 7) % 180 - 90).cast("double").alias("lat"), ((n * 13) % 360 - 180).cast("double").alias("lon"))
