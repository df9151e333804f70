"""Range operators against brute force on small inputs."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from chartlake.operators import incremental as inc
from chartlake.operators.ranges import batches, date_ranges, ordered_index, trailing_window

D = dt.date


def test_trailing_window_matches_between_join(spark):
    rnd = random.Random(7)
    days = [(D(2024, 1, 1) + dt.timedelta(days=i), rnd.random() * 10) for i in range(60) if rnd.random() > 0.2]
    anchors = [(D(2024, 1, 1) + dt.timedelta(days=i),) for i in range(0, 70, 3)]
    ddf = spark.createDataFrame(days, "date date, v double")
    adf = spark.createDataFrame(anchors, "chart_date date")
    got = {r.chart_date: r.m for r in trailing_window(ddf, adf, 7, {"m": "v"}).collect()}
    want = {}
    for (a,) in anchors:
        vals = [v for d, v in days if a - dt.timedelta(days=6) <= d <= a]
        if vals:
            want[a] = sum(vals) / len(vals)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_date_ranges_gaps_and_islands(spark):
    dates = [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3), D(2024, 1, 5), D(2024, 1, 31), D(2024, 2, 1), D(2024, 1, 2)]
    df = spark.createDataFrame([(d,) for d in dates], "date date")
    got = sorted((r.start, r.end, r.days) for r in date_ranges(df).collect())
    assert got == [(D(2024, 1, 1), D(2024, 1, 3), 3), (D(2024, 1, 5), D(2024, 1, 5), 1), (D(2024, 1, 31), D(2024, 2, 1), 2)]


def test_ordered_index_equals_row_number(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 50), f"k{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string")
    got = {r.b: r.idx for r in ordered_index(df, [F.col("a").desc(), F.col("b")], num_partitions=7).collect()}
    want = {r.b: r.rn - 1 for r in df.withColumn("rn", F.row_number().over(Window.orderBy(F.col("a").desc(), "b"))).collect()}
    assert got == want


def test_batches_of_fifty(spark):
    df = spark.createDataFrame([(i,) for i in range(123)], "x int")
    got = {r.x: r.batch for r in batches(df, [F.col("x")], 50).collect()}
    assert got[0] == 0 and got[49] == 0 and got[50] == 1 and got[122] == 2


def test_feature_backlog_order_and_landed(spark):
    charts = spark.createDataFrame(
        [(D(2024, 1, 7), "a", 3, 10), (D(2024, 1, 14), "a", 5, 20), (D(2024, 1, 14), "b", 1, 5), (D(2024, 1, 7), "c", 1, 1)],
        "chart_date date, song_uuid string, position int, streams long")
    landed = spark.createDataFrame([("c",)], "song_uuid string")
    bl = inc.feature_backlog(charts, landed)
    order = [r.song_uuid for r in inc.ordered_backlog(bl).collect()]
    assert order == ["b", "a"]
    a = [r for r in bl.collect() if r.song_uuid == "a"][0]
    assert (a.latest_chart_date, a.best_position, a.total_streams) == (D(2024, 1, 14), 3, 30)


def test_remaining_dates(spark):
    avail = spark.createDataFrame([(f"{d}T00:00:00+00:00",) for d in
                                   ["2024-01-07", "2024-01-07", "2024-01-14", "2023-12-31", "2024-02-04"]], "api_date string")
    landed = spark.createDataFrame([(D(2024, 1, 14),)], "chart_date date")
    got = sorted(r.chart_date for r in inc.remaining_dates(avail, landed, D(2024, 1, 1), D(2024, 2, 3)).collect())
    assert got == [D(2024, 1, 7)]


def test_calendar_side_broadcast_only_within_budget(spark):
    from chartlake.operators.dims import CALENDAR_ROW_BUDGET, calendar_side

    df = spark.range(10).withColumnRenamed("id", "k")
    hinted = calendar_side(df, 3650)._jdf.queryExecution().analyzed().toString()
    plain = calendar_side(df, CALENDAR_ROW_BUDGET + 1)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted.lower() and "broadcast" not in plain.lower()


def test_mart_without_broadcast_gives_same_rows(spark):
    import dataclasses

    from chartlake.plans import marts as M
    from chartlake.sources import testdata as TD
    from tiny import SF_SMALL

    star = TD.load_fixture(spark, SF_SMALL).star
    wide = dataclasses.replace(star, calendar_days=10**6)  # forces the shuffle-join path
    a = sorted(tuple(r) for r in M.audio_features_by_weather(star, TD.MART).collect())
    b = sorted(tuple(r) for r in M.audio_features_by_weather(wide, TD.MART).collect())
    assert len(a) == len(b) and all(x[0] == y[0] and abs(x[1] - y[1]) < 1e-9 for x, y in zip(a, b))


def test_incremental_plan_up_to_date(spark):
    from chartlake import schemas as S
    from chartlake.operators.dims import Star
    from tiny import dim_time, tracks, weather

    t = dim_time(spark, D(2024, 1, 1), D(2024, 1, 7))
    wx = weather(spark, [(D(2024, 1, 1) + dt.timedelta(days=i), 1.0, 1.0, 1.0, 1.0) for i in range(7)])
    fact = spark.createDataFrame([(20240107001, "a", 20240107, 20240107, "de", 1, 1)], S.FACT_TRACK_CHART)
    star = Star(dim_time=t, dim_track=tracks(spark, [("a", dict(danceability=0.5))]), dim_weather=wx, fact=fact)
    r = inc.incremental_plan(star).first()
    assert (r.missing_weather_dates, r.missing_chart_sundays, r.missing_features, r.up_to_date) == (0, 0, 0, True)
    star2 = Star(dim_time=dim_time(spark, D(2024, 1, 1), D(2024, 1, 21)), dim_track=star.dim_track,
                 dim_weather=wx, fact=fact)
    r2 = inc.incremental_plan(star2).first()
    assert (r2.missing_weather_dates, r2.missing_chart_sundays, r2.up_to_date) == (14, 2, False)
