"""Declared schemas of the warehouse tables and of the staging records."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


DIM_TIME = _struct(
    ("date_id", _I, False),
    ("date", T.DateType(), False),
    ("month", _I, False),
    ("season", _S, False),
)

AUDIO_DOUBLES = (
    "danceability", "energy", "valence", "tempo", "loudness",
    "speechiness", "acousticness", "instrumentalness", "liveness",
)
AUDIO_INTS = ("key", "mode", "time_signature")

DIM_TRACK = _struct(
    ("track_id", _S, False),
    ("track_name", _S, False),
    ("artist_names", _S, True),
    ("genre", _S, True),
    ("duration_ms", _I, True),
    ("release_date", _S, True),
    ("language_code", _S, True),
    ("image_url", _S, True),
    *[(c, _D, True) for c in AUDIO_DOUBLES],
    *[(c, _I, True) for c in AUDIO_INTS],
)

DIM_WEATHER = _struct(
    ("weather_id", _I, False),
    ("date_id", _I, False),
    ("temperature_avg", _D, True),
    ("precipitation_mm", _D, True),
    ("wind_speed_kmh", _D, True),
    ("sunshine_hours", _D, True),
)

FACT_TRACK_CHART = _struct(
    ("fact_id", _S, False),
    ("track_id", _S, False),
    ("date_id", _I, False),
    ("weather_id", _I, True),
    ("country", _S, False),
    ("stream_count", _L, True),
    ("chart_position", _I, True),
)

WAREHOUSE = {
    "dim_time": DIM_TIME,
    "dim_track": DIM_TRACK,
    "dim_weather": DIM_WEATHER,
    "fact_track_chart": FACT_TRACK_CHART,
}

# Changes of tracks, merged on read: the values of a staged row, and whether its
# genre text named a genre.
TRACK_CHANGE = T.StructType([
    *[T.StructField(f.name, f.dataType, f.name != "track_id") for f in DIM_TRACK.fields],
    T.StructField("genre_set", _B, False),
])

# Files that streaming queries have loaded.
LOADED_FILE = _struct(("query", _S, False), ("epoch", _L, False), ("file", _S, False))

# Sketches of the distinct tracks of a week, by the fact batch they stand for.
TRACK_SKETCH = _struct(("country", _S, False), ("date_id", _I, False), ("of_batch", _S, False), ("entries", _L, False), ("sketch", T.BinaryType(), False))

#: All tables that the commit log may name.
STORED = {**WAREHOUSE, "loaded_file": LOADED_FILE, "track_sketch": TRACK_SKETCH}

# Staging records -----------------------------------------------------------

CHART_ENTRY = _struct(
    ("chart_date", _S, True),
    ("fetched_at", _S, True),
    ("position", _I, True),
    ("old_position", _I, True),
    ("position_change", _I, True),
    ("streams", _L, True),
    ("entry_state", _S, True),
    ("entry_date", _S, True),
    ("rank_date", _S, True),
    ("weeks_on_chart", _I, True),
    ("time_unit", _S, True),
    ("song_uuid", _S, True),
    ("song_name", _S, True),
    ("artist_name", _S, True),
    ("image_url", _S, True),
    ("raw_json", _S, True),
)

SONG_FEATURES = _struct(
    ("song_uuid", _S, True),
    ("song_name", _S, True),
    ("artist_name", _S, True),
    ("isrc", _S, True),
    ("release_date", _S, True),
    ("duration", _D, True),
    ("explicit", _B, True),
    ("language_code", _S, True),
    ("acousticness", _D, True),
    ("danceability", _D, True),
    ("energy", _D, True),
    ("instrumentalness", _D, True),
    ("key", _I, True),
    ("liveness", _D, True),
    ("loudness", _D, True),
    ("mode", _I, True),
    ("speechiness", _D, True),
    ("tempo", _D, True),
    ("time_signature", _I, True),
    ("valence", _D, True),
    ("image_url", _S, True),
    ("genres", _S, True),
    ("copyright", _S, True),
)

WEATHER_READING = _struct(
    ("date", T.DateType(), True),
    ("location", _S, True),
    ("temperature_avg", _D, True),
    ("precipitation_mm", _D, True),
    ("wind_speed_kmh", _D, True),
    ("sunshine_hours", _D, True),
)

# API documents (landed JSON) ------------------------------------------------

SONG_REF = "struct<uuid:string, name:string, creditName:string, imageUrl:string>"
CHART_ITEM_DDL = (
    "struct<position:int, oldPosition:int, positionEvolution:int, metric:bigint, "
    "entryState:string, entryDate:string, rankDate:string, timeOnChart:int, "
    f"timeOnChartUnit:string, song:{SONG_REF}>"
)
# Items stay text, so that fields outside the declared ones are kept; offset is
# that of the page's request, its place among the pages of the chart.
CHART_PAGE_DDL = "chart_date string, country string, offset bigint, items array<string>"

AUDIO_DDL = (
    "struct<acousticness:double, danceability:double, energy:double, instrumentalness:double, "
    "key:int, liveness:double, loudness:double, mode:int, speechiness:double, tempo:double, "
    "timeSignature:int, valence:double>"
)
GENRES_DDL = "array<struct<root:string>>"
SONG_OBJECT_DDL = (
    "struct<name:string, creditName:string, releaseDate:string, duration:double, "
    "explicit:boolean, languageCode:string, imageUrl:string, copyright:string, "
    f"audio:{AUDIO_DDL}>"
)

WEATHER_DOC_DDL = (
    "location string, daily struct<time:array<string>, temperature_2m_mean:array<double>, "
    "precipitation_sum:array<double>, windspeed_10m_max:array<double>, "
    "sunshine_duration:array<double>>"
)
AVAILABLE_DATES_DDL = "items array<string>"
