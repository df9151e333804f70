"""Hand-made star schemas for edge-rule tests, and the smallest given tables."""

import datetime as dt

from chartlake import schemas as S
from chartlake.functions import calendar as cal
from chartlake.operators.dims import Star

SF_SMALL = "/root/testdata/sf0.001"


def dim_time(spark, start, end):
    days = cal.date_spine(cal.literal_range(spark, start, end))
    return cal.dim_time_rows(days)


def track_row(tid, **kw):
    base = {f.name: None for f in S.DIM_TRACK.fields}
    base.update(track_id=tid, track_name=f"name {tid}")
    base.update(kw)
    return tuple(base[f.name] for f in S.DIM_TRACK.fields)


def tracks(spark, rows):
    return spark.createDataFrame([track_row(t, **kw) for t, kw in rows], S.DIM_TRACK)


def weather(spark, rows):
    """rows: (date, temp, precip, wind, sun)"""
    data = []
    for d, t, p, w, s in rows:
        k = int(d.strftime("%Y%m%d"))
        data.append((k, k, t, p, w, s))
    return spark.createDataFrame(data, S.DIM_WEATHER)


def facts(spark, rows):
    """rows: (track_id, date, country, streams, position[, weather_id])"""
    data = []
    for r in rows:
        tid, d, c, streams, pos = r[:5]
        k = int(d.strftime("%Y%m%d"))
        w = r[5] if len(r) > 5 else k
        data.append((f"{k}|{c}|{tid}", tid, k, w, c, streams, pos))
    return spark.createDataFrame(data, S.FACT_TRACK_CHART)


def star(spark, track_rows, fact_rows, weather_rows, start=dt.date(2024, 1, 1), end=dt.date(2024, 3, 31)):
    return Star(dim_time=dim_time(spark, start, end), dim_track=tracks(spark, track_rows),
                dim_weather=weather(spark, weather_rows), fact=facts(spark, fact_rows))
