"""API-shaped JSON documents derived from the test tables.

The registered source queries land these as JSON lines in the shared folder
and read them back through the real readers, so the parsing path runs.
Every document holds a bounded group: a chart page has at most 100 items, a
weather document covers one location for one month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartlake.functions import calendar as cal

PAGE_SIZE = 100
#: Chart pages landed in one gzipped file (about 160 MB of text for pages of 100 items).
PAGES_PER_FILE = 5_000


def _ratio(n: Column, mod: int) -> Column:
    return (n % mod).cast("double") / float(mod)


def chart_item(chart_date: Column, p: Column, streams: Column, uid: Column) -> Column:
    """The item struct of a chart row, in the API's field names."""
    old = F.when(p % 5 == 0, F.lit(None).cast("int")).otherwise(p + 1)
    song = F.when(
        p % 50 != 0,
        F.struct(
            uid.alias("uuid"),
            F.concat(F.lit("Title "), uid).alias("name"),
            F.when(p % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Artist "), uid)).alias("creditName"),
            F.concat(F.lit("cover/"), uid, F.lit(".jpg")).alias("imageUrl"),
        ),
    )
    return F.struct(
        p.alias("position"),
        old.alias("oldPosition"),
        (old - p).alias("positionEvolution"),
        streams.alias("metric"),
        F.when(p <= 10, F.lit("UP")).otherwise(F.lit("STABLE")).alias("entryState"),
        cal.iso_label(F.date_sub(chart_date, (p % 4) * 7)).alias("entryDate"),
        cal.iso_label(chart_date).alias("rankDate"),
        (p % 9 + 1).alias("timeOnChart"),
        F.lit("week").alias("timeOnChartUnit"),
        song.alias("song"),
        F.struct((p % 3).alias("id")).alias("label"),  # a field no schema declares
    )


def chart_pages_json(chart_raw: DataFrame) -> DataFrame:
    """One JSON line per (country, chart date, page of 100).  The rows are
    shuffled as they are; a page's items are made from them afterwards."""
    paged = chart_raw.withColumn("page", ((F.col("position") - 1) / PAGE_SIZE).cast("int"))
    pages = paged.groupBy("chart_date", "country", "page").agg(F.array_sort(F.collect_list(F.struct("position", "streams", "song_uuid"))).alias("rows"))
    day = F.col("chart_date")
    items = F.transform("rows", lambda r: chart_item(day, r["position"], r["streams"], r["song_uuid"]))
    return pages.select(F.to_json(F.struct(
        F.concat(cal.iso_label(day), F.lit("T00:00:00+00:00")).alias("chart_date"), "country", items.alias("items"))).alias("value"))


def short_pages_json(chart_raw: DataFrame, size: int = 20) -> DataFrame:
    """Pages of ``size`` items in rank order, each with its offset, whose items'
    positions are partly missing (every sixth) or repeat the one before (every fifth)."""
    p = F.col("position")
    odd = chart_raw.select("chart_date", "country", "song_uuid", "streams", p.alias("rank"),
                           F.when(p % 6 == 0, F.lit(None).cast("int")).when(p % 5 == 0, p - 1).otherwise(p).alias("position"))
    item = F.struct("position", F.col("streams").alias("metric"), F.struct(F.col("song_uuid").alias("uuid")).alias("song"))
    paged = odd.select(F.concat(cal.iso_label("chart_date"), F.lit("T00:00:00+00:00")).alias("chart_date"), "country",
                       (F.floor((F.col("rank") - 1) / size) * size).alias("offset"), F.struct("rank", item.alias("item")).alias("ranked"))
    pages = paged.groupBy("chart_date", "country", "offset").agg(F.array_sort(F.collect_list("ranked")).alias("ranked"))
    return pages.select(F.to_json(F.struct("chart_date", "country", "offset", F.col("ranked.item").alias("items"))).alias("value"))


def song_docs_json(part: DataFrame) -> DataFrame:
    """Song metadata documents; ``isrc`` is an object for even keys and a bare
    string for odd ones; audio is all-NULL for k % 7 == 0 and absent for
    k % 11 == 0; genres vary (one, none, absent, two)."""
    k = F.col("p_partkey")
    genre = F.struct(F.col("p_type").alias("root"), F.array(F.lit("sub a")).alias("sub"))
    genres = (
        F.when(k % 4 == 0, F.array(genre))
        .when(k % 4 == 1, F.array().cast("array<struct<root:string,sub:array<string>>>"))
        .when(k % 4 == 3, F.array(genre, F.struct(F.lit("pop").alias("root"), F.array(F.lit("sub b")).alias("sub"))))
    )
    audio_values = F.struct(
        _ratio(k * 23, 1000).alias("acousticness"),
        _ratio(k * 29, 1000).alias("danceability"),
        _ratio(k * 31, 1000).alias("energy"),
        _ratio(k * 41, 1000).alias("instrumentalness"),
        (k % 12).cast("int").alias("key"),
        _ratio(k * 43, 1000).alias("liveness"),
        ((0 - (k * 7) % 600).cast("double") / 10).alias("loudness"),
        ((k + 1) % 2).cast("int").alias("mode"),
        _ratio(k * 47, 1000).alias("speechiness"),
        (70 + (k * 3) % 120).cast("double").alias("tempo"),
        F.lit(4).alias("timeSignature"),
        F.when(k % 5 == 0, F.lit(None).cast("double")).otherwise(_ratio(k * 59, 1000)).alias("valence"),
    )
    null_audio = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in (
        ("acousticness", "double"), ("danceability", "double"), ("energy", "double"),
        ("instrumentalness", "double"), ("key", "int"), ("liveness", "double"),
        ("loudness", "double"), ("mode", "int"), ("speechiness", "double"),
        ("tempo", "double"), ("timeSignature", "int"), ("valence", "double"),
    )])
    audio = F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, null_audio).otherwise(audio_values)
    obj = F.struct(
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("creditName"),
        F.concat(F.lit("199"), (k % 10).cast("string"), F.lit("-01-01")).alias("releaseDate"),
        (F.col("p_size") * 1.5).alias("duration"),
        (k % 2 == 1).alias("explicit"),
        F.lit("en").alias("languageCode"),
        F.concat(F.lit("cover/"), k.cast("string"), F.lit(".jpg")).alias("imageUrl"),
        F.concat(F.col("p_brand"), F.lit(" records")).alias("copyright"),
        genres.alias("genres"),
        audio.alias("audio"),
    )
    isrc_text = F.concat(F.lit("ISRC"), k.cast("string"))
    isrc_json = F.when(k % 2 == 0, F.concat(F.lit('{"value":"'), isrc_text, F.lit('"}'))).otherwise(
        F.concat(F.lit('"'), isrc_text, F.lit('"'))
    )
    obj_json = F.to_json(obj)
    with_isrc = F.concat(F.lit('{"isrc":'), isrc_json, F.lit(","), F.expr("substring(_o, 2)"))
    return part.select("p_partkey", k.cast("string").alias("song_uuid"), obj_json.alias("_o")).select(
        F.concat(F.lit('{"song_uuid":"'), F.col("song_uuid"), F.lit('","object":'), with_isrc, F.lit("}")).alias("value")
    )


def weather_docs_json(weather_raw: DataFrame) -> DataFrame:
    """One document per (location, month) with the ``daily`` parallel arrays."""
    per_day = weather_raw.select(
        "location",
        F.date_trunc("month", F.col("date").cast("timestamp")).alias("month"),
        F.struct(
            cal.iso_label("date").alias("time"),
            F.col("temperature_2m_mean").alias("t"),
            F.col("precipitation_sum").alias("p"),
            F.col("windspeed_10m_max").alias("w"),
            F.col("sunshine_duration").alias("s"),
        ).alias("d"),
    )
    docs = per_day.groupBy("location", "month").agg(F.array_sort(F.collect_list("d")).alias("days"))
    daily = F.struct(
        F.transform("days", lambda x: x["time"]).alias("time"),
        F.transform("days", lambda x: x["t"]).alias("temperature_2m_mean"),
        F.transform("days", lambda x: x["p"]).alias("precipitation_sum"),
        F.transform("days", lambda x: x["w"]).alias("windspeed_10m_max"),
        F.transform("days", lambda x: x["s"]).alias("sunshine_duration"),
    )
    return docs.select(F.to_json(F.struct("location", daily.alias("daily"))).alias("value"))


def land_text(df: DataFrame, path: str, per_file: int | None = None) -> str:
    """Write one text line per row (JSON documents) and return the path.  With
    ``per_file`` the files are gzipped and hold at most so many documents, as
    one task reads the whole of a gzipped file."""
    writer = df.write.mode("overwrite")
    if per_file:
        writer = writer.option("compression", "gzip").option("maxRecordsPerFile", per_file)
    writer.text(path)
    return path
