"""Staging sources and sinks: landed API documents (JSON), staging CSV files,
and the union/dedupe rewrites of the staging area (SRC-1 ... SRC-9,
SNK-1 ... SNK-3).

The API clients of the reference are not rebuilt; their responses are read
as landed JSON files (one document per line) with declared schemas.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake import schemas as S
from chartlake.functions import calendar as cal
from chartlake.functions import scalars as sc


# --- shared scratch folder ----------------------------------------------------

def shared_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    Never a machine-local temp folder: every executor must see the files.
    """
    from chartlake.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), "chartlake", *parts, uuid.uuid4().hex])


# --- CSV (SRC-1, SRC-2) ---------------------------------------------------------

# The files' dialect: quotes doubled inside quoted fields, which may hold
# commas and line breaks; whole numbers may come as "5.0".  Files with line
# breaks in fields cannot be split: one task reads the whole of a file, so a
# large staging area is written as many files.
CSV_DIALECT = {"header": True, "escape": '"', "multiLine": True, "mode": "PERMISSIVE"}
#: Rows of a written CSV file (about 20 MB of chart entries).
CSV_FILE_ROWS = 100_000


def _read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Text columns cast to ``schema``: numbers through double, NULL where they do not parse."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).options(**CSV_DIALECT).csv(path)

    def typed(f: T.StructField) -> Column:
        if isinstance(f.dataType, (T.IntegerType, T.LongType)):
            # exact for plain whole numbers of any length, through double for "5.0"
            return F.coalesce(F.col(f.name).try_cast(f.dataType), F.col(f.name).try_cast("double").try_cast(f.dataType))
        return F.col(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name).try_cast(f.dataType)

    return raw.select(*[typed(f).alias(f.name) for f in schema.fields])


def read_chart_csv(spark: SparkSession, path: str) -> DataFrame:
    """Chart history CSV with header, declared schema; chart_date parsed."""
    return _read_csv(spark, path, S.CHART_ENTRY).withColumn("chart_date", cal.parse_api_date(F.col("chart_date")))


def read_feature_csv(spark: SparkSession, path: str) -> DataFrame:
    """Song feature CSV with header, declared schema."""
    return _read_csv(spark, path, S.SONG_FEATURES)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", file_rows: int = CSV_FILE_ROWS) -> None:
    """CSV files with header of at most ``file_rows`` rows each."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("maxRecordsPerFile", file_rows).csv(path)


# --- chart pages (SRC-3, SRC-9) ----------------------------------------------------

def read_chart_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed chart pages: one JSON document per line, ``{chart_date, items}``."""
    return spark.read.schema(S.CHART_PAGE_DDL).json(path)


def parse_chart_pages(text: DataFrame, col: str = "value") -> DataFrame:
    """Chart page JSON text -> (chart_date, items) with the declared schema."""
    return text.select(F.from_json(F.col(col), S.CHART_PAGE_DDL).alias("p")).select("p.*")


def first_items(pages: DataFrame, n: int) -> DataFrame:
    """Pages cut to the first ``n`` items of each chart's pages, joined in order
    of their offset (SRC-9, WN-6).

    A chart is a (chart date[, country]).  An item's own position plays no part,
    so items without one, or with one that repeats, stay in their place.  The
    first ``n`` pages that hold items are enough and are found by a ranking that
    each task cuts to ``n`` rows a chart; what is left of ``n`` for a page follows
    from the sizes of the pages before it, so no items are shuffled alone."""
    keys = [c for c in pages.columns if c not in ("items", "offset")]
    order = [F.col("offset").asc_nulls_first(), F.col("items")] if "offset" in pages.columns else [F.col("items")]
    chart = Window.partitionBy(*keys).orderBy(*order)
    held = pages.filter(F.size("items") > 0).withColumn("_page", F.row_number().over(chart)).filter(F.col("_page") <= n)
    before = F.sum(F.size("items")).over(Window.partitionBy(*keys).orderBy("_page").rowsBetween(Window.unboundedPreceding, -1))
    return held.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < n) \
        .withColumn("items", F.slice("items", F.lit(1), (F.lit(n) - F.col("_before")).cast("int"))).select(*pages.columns)


def chart_items(pages: DataFrame, top_n: int | None = None) -> DataFrame:
    """Pages of one chart -> one row per item: ``item`` (declared fields) and
    ``item_json`` (the whole item as text); with ``top_n`` only the first N items
    of every (chart date[, country]) (see :func:`first_items`)."""
    keys = [c for c in pages.columns if c not in ("items", "offset")]
    pages = pages if top_n is None else first_items(pages, top_n)
    return pages.select(*keys, F.explode("items").alias("item_json")) \
        .withColumn("item", F.from_json("item_json", S.CHART_ITEM_DDL))


def flatten_chart_items(items: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """Chart entry struct -> the 16 flat staging columns (SRC-3, SC-8, SC-9).

    Nested ``song.*`` fields are lifted; a missing song gives NULLs; the whole
    item, undeclared and null fields included, is kept as JSON text.
    """
    i = F.col("item")
    song = i.getField("song")
    keys = [c for c in items.columns if c not in ("item", "item_json", "chart_date")]
    return items.select(
        F.col("chart_date").cast("string").alias("chart_date"),
        (fetched_at if fetched_at is not None else F.current_timestamp().cast("string")).alias("fetched_at"),
        i.getField("position").alias("position"),
        i.getField("oldPosition").alias("old_position"),
        i.getField("positionEvolution").alias("position_change"),
        i.getField("metric").alias("streams"),
        i.getField("entryState").alias("entry_state"),
        i.getField("entryDate").alias("entry_date"),
        i.getField("rankDate").alias("rank_date"),
        i.getField("timeOnChart").alias("weeks_on_chart"),
        i.getField("timeOnChartUnit").alias("time_unit"),
        song.getField("uuid").alias("song_uuid"),
        song.getField("name").alias("song_name"),
        song.getField("creditName").alias("artist_name"),
        song.getField("imageUrl").alias("image_url"),
        F.col("item_json").alias("raw_json"),
        *keys,
    )


# --- song metadata (SRC-4) -------------------------------------------------------------

def flatten_song_features(docs: DataFrame, uuid_col: str = "song_uuid", json_col: str = "json") -> DataFrame:
    """Song metadata JSON -> 23 flat feature columns (SRC-4).

    Songs whose audio block is absent, empty or all NULL are rejected (SC-12).
    ``isrc.value`` is read only when ``isrc`` is an object (SC-11).
    """
    obj = F.from_json(F.col(json_col), f"struct<object:{S.SONG_OBJECT_DDL}>").getField("object")
    parsed = docs.select(
        F.col(uuid_col).alias("song_uuid"),
        obj.alias("o"),
        F.get_json_object(F.col(json_col), "$.object.isrc").alias("_isrc_raw"),
        F.get_json_object(F.col(json_col), "$.object.genres").alias("_genres_raw"),
    )
    audio_fields = [
        "acousticness", "danceability", "energy", "instrumentalness", "key", "liveness",
        "loudness", "mode", "speechiness", "tempo", "timeSignature", "valence",
    ]
    a = F.col("o.audio")
    has_audio = sc.any_not_null(*[a.getField(f) for f in audio_fields])
    isrc_obj = F.from_json(F.col("_isrc_raw"), "struct<value:string>")
    isrc = F.when(F.col("_isrc_raw").startswith("{"), isrc_obj.getField("value"))
    o = F.col("o")
    return parsed.filter(has_audio).select(
        "song_uuid",
        o.getField("name").alias("song_name"),
        o.getField("creditName").alias("artist_name"),
        isrc.alias("isrc"),
        o.getField("releaseDate").alias("release_date"),
        o.getField("duration").alias("duration"),
        o.getField("explicit").alias("explicit"),
        o.getField("languageCode").alias("language_code"),
        a.getField("acousticness").alias("acousticness"),
        a.getField("danceability").alias("danceability"),
        a.getField("energy").alias("energy"),
        a.getField("instrumentalness").alias("instrumentalness"),
        a.getField("key").alias("key"),
        a.getField("liveness").alias("liveness"),
        a.getField("loudness").alias("loudness"),
        a.getField("mode").alias("mode"),
        a.getField("speechiness").alias("speechiness"),
        a.getField("tempo").alias("tempo"),
        a.getField("timeSignature").alias("time_signature"),
        a.getField("valence").alias("valence"),
        o.getField("imageUrl").alias("image_url"),
        F.coalesce(F.col("_genres_raw"), F.lit("[]")).alias("genres"),
        o.getField("copyright").alias("copyright"),
    )


# --- weather documents (SRC-5, SRC-7) ----------------------------------------------------

def explode_weather_arrays(docs: DataFrame) -> DataFrame:
    """Weather document with parallel ``daily`` arrays -> one reading per day,
    index-aligned, tagged with the location (SRC-5, SC-3)."""
    d = F.col("daily")
    zipped = F.arrays_zip(
        d.getField("time").alias("time"),
        d.getField("temperature_2m_mean").alias("t"),
        d.getField("precipitation_sum").alias("p"),
        d.getField("windspeed_10m_max").alias("w"),
        d.getField("sunshine_duration").alias("s"),
    )
    rows = docs.select("location", F.inline(zipped))
    return rows.select(
        F.to_date("time").alias("date"),
        "location",
        F.col("t").alias("temperature_avg"),
        F.col("p").alias("precipitation_mm"),
        F.col("w").alias("wind_speed_kmh"),
        sc.seconds_to_hours("s").alias("sunshine_hours"),
    )


def location_dimension(locations: DataFrame) -> DataFrame:
    """Static weather-location dimension (SRC-7): (location_id, location, lat, lon) of every named place."""
    return locations.select(
        "location_id", "location", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon")
    ).filter(F.col("location").isNotNull())


# --- staging rewrites (SNK-2, SNK-3) ----------------------------------------------------------

def union_sorted_charts(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Staging charts = old ∪ new, chart_date as ISO text, ordered by
    (chart_date, position, then country and song for a total order) (SNK-2, ST-1, SO-4)."""
    both = new if existing is None else existing.unionByName(new, allowMissingColumns=True)
    return both.withColumn("chart_date", cal.iso_label(F.col("chart_date").cast("date"))).orderBy(
        "chart_date", "position", *[c for c in ("country", "song_uuid") if c in both.columns])


def write_staged_charts(df: DataFrame, path: str) -> None:
    """Partitioned by chart date, rows in position order inside each file; range
    partitions, so a date with very many rows is dealt over several tasks."""
    df.repartitionByRange("chart_date", "position").sortWithinPartitions("chart_date", "position").write.mode("overwrite").partitionBy("chart_date").parquet(path)


def union_first_wins(existing: DataFrame | None, new: DataFrame, key: str = "song_uuid") -> DataFrame:
    """Staging features = old ∪ new, first row per key wins (SNK-3, WN-4)."""
    if existing is None:
        return new
    from chartlake.operators.loaders import first_per_key

    tagged = existing.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return first_per_key(tagged, key, [F.col("_src")]).drop("_src").select(*tagged.drop("_src").columns)


def append_parquet(df: DataFrame, path: str) -> None:
    """Append one batch as a single atomic job (SNK-1)."""
    df.write.mode("append").parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a table folder exists in the session's file system (asked
    through Hadoop: a path of the driver's own disk says nothing on a cluster)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Landed keys so far, or an empty frame of the schema when nothing has
    landed yet (SRC-8)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(path)
