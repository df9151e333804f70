"""Warehouse loads: idempotent refresh and versioned track dimension."""

import datetime as dt

from pyspark.sql import functions as F

from chartlake.operators.dims import Star
from chartlake.plans import warehouse as WH
from chartlake.sources import staging as ST
from chartlake.sources import testdata as TD

from tiny import SF_SMALL


def counts(spark, root):
    return {r.table: r.rows for r in WH.row_counts(WH.read_star(spark, root)).collect()}


def test_refresh_is_idempotent_and_versions_tracks(spark):
    fx = TD.load_fixture(spark, SF_SMALL)
    root = ST.shared_path(spark, "test_wh")
    WH.write_star(Star(dim_time=fx.dim_time.filter(F.col("date") < dt.date(2001, 1, 1)),
                       dim_track=fx.dim_track.filter(F.col("track_id").cast("long") % 5 != 0)
                       .withColumn("danceability", F.lit(None).cast("double")),
                       dim_weather=fx.dim_weather.filter(F.col("date_id") < 20000101),
                       fact=fx.fact.filter(F.col("date_id") < 20000101)), root)
    landing = WH.Landing(
        chart_entries=fx.chart_raw.withColumn("song_name", F.lit("t")).withColumn("artist_name", F.lit(None).cast("string")),
        weather_readings=TD.weather_readings(fx.weather_raw),
        features=fx.features_staged,
    )
    WH.refresh_warehouse(spark, root, landing, dt.date(2001, 12, 2))
    once = counts(spark, root)
    left = WH.refresh_warehouse(spark, root, landing, dt.date(2001, 12, 2)).first()
    assert counts(spark, root) == once
    assert once["fact_track_chart"] == fx.fact.count()
    assert once["dim_weather"] == fx.dim_weather.count()
    assert once["dim_time"] == fx.dim_time.count()
    assert left.missing_chart_sundays == 4 and left.missing_weather_dates == 28
    tracks = WH.read_star(spark, root).dim_track
    assert tracks.select("track_id").distinct().count() == tracks.count()
    merged = tracks.filter(F.col("danceability").isNotNull()).count()
    assert merged > 0


def test_create_warehouse_only_missing_tables(spark):
    root = ST.shared_path(spark, "test_create")
    assert sorted(WH.create_warehouse(spark, root)) == ["dim_time", "dim_track", "dim_weather", "fact_track_chart"]
    assert WH.create_warehouse(spark, root) == []
    star = WH.read_star(spark, root)
    assert star.fact.count() == 0 and star.dim_track.count() == 0
    assert star.fact.schema.names == [f.name for f in WH.S.FACT_TRACK_CHART.fields]


def test_read_or_empty_and_staged_chart_write(spark):
    from chartlake import schemas as S

    path = ST.shared_path(spark, "test_staged")
    assert ST.read_or_empty(spark, path, S.CHART_ENTRY).count() == 0
    rows = spark.createDataFrame(
        [(dt.date(2024, 1, 7), 2, "b"), (dt.date(2024, 1, 7), 1, "a"), (dt.date(2023, 12, 31), 1, "c")],
        "chart_date date, position int, song_uuid string")
    staged = ST.union_sorted_charts(None, rows)
    assert [r.song_uuid for r in staged.collect()] == ["c", "a", "b"]
    ST.write_staged_charts(staged, path)
    back = spark.read.parquet(path)
    assert back.count() == 3 and "chart_date" in back.columns


def test_stream_replay_with_lost_checkpoint_loads_nothing_twice(spark):
    from chartlake.sources import fixture_docs as DOCS
    from chartlake.streaming import chart_stream as CS

    fx = TD.load_fixture(spark, SF_SMALL)
    root = ST.shared_path(spark, "test_stream")
    early = F.col("date_id") < 20010101
    WH.write_star(Star(dim_time=fx.dim_time, dim_track=fx.dim_track, dim_weather=fx.dim_weather,
                       fact=fx.fact.filter(early)), root)
    pages = DOCS.chart_pages_json(fx.chart_raw.filter(F.col("chart_date") >= dt.date(2001, 1, 1))).repartition(2)
    landing = DOCS.land_text(pages, ST.shared_path(spark, "test_landing"))
    for _ in range(2):  # second run: new checkpoint folder, same files -> replay of every batch
        q = CS.start_chart_stream(spark, landing, root, ST.shared_path(spark, "test_ckpt"), max_files_per_trigger=1)
        q.awaitTermination()
    fact = WH.read_star(spark, root).fact
    expected = fx.fact.filter(early | (F.col("chart_position") % 50 != 0)).count()
    assert fact.count() == expected
    assert fact.select("fact_id").distinct().count() == expected


def test_read_star_reports_calendar_span(spark):
    fx = TD.load_fixture(spark, SF_SMALL)
    root = ST.shared_path(spark, "test_span")
    WH.write_star(fx.star, root)
    star = WH.read_star(spark, root)
    assert star.calendar_days == fx.star.calendar_days == fx.dim_time.count()
