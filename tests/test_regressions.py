"""Inputs of ordinary shape that once broke a loader or reader."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from chartlake import schemas as S
from chartlake.operators import incremental as inc
from chartlake.operators import loaders as ld
from chartlake.operators.ranges import batches, ordered_index
from chartlake.plans import warehouse as WH
from chartlake.session import ensure_checkpoint_dir
from chartlake.sources import fixture_docs as DOCS
from chartlake.sources import staging as st
from chartlake.sources import testdata as TD

from tiny import SF_SMALL, dim_time, tracks, weather

D = dt.date
ENTRY = "chart_date date, country string, song_uuid string, streams long, position int"


def entries(spark):
    day = D(2024, 1, 7)
    return spark.createDataFrame([
        (day, "de", "a", 10, 1), (day, "fr", "a", 10, 1), (day, "us", "a", 9, 1), (day, "at", "a", 8, 501), (day, "de", "b", 10, 1),
        (day, "de", "c", None, None), (day, "de", "d", 3, None), (day, "de", "e", 1, 700), (day, "at", "b", 1, 1)], ENTRY)


def test_facts_keep_every_country_tie_and_missing_position(spark):
    t, w = dim_time(spark, D(2024, 1, 1), D(2024, 1, 10)), weather(spark, [])
    none = spark.createDataFrame([], S.FACT_TRACK_CHART)
    once = ld.new_chart_facts(entries(spark), t, w, none)
    assert ld.load_facts(entries(spark), t, w).count() == once.count() == 9
    assert once.select("fact_id").distinct().count() == 9
    assert ld.new_chart_facts(entries(spark), t, w, once).count() == 0
    twice = entries(spark).unionByName(entries(spark).withColumn("position", F.col("position") + 1))
    rows = {r.fact_id: r.chart_position for r in ld.new_chart_facts(twice, t, w, none).collect()}
    assert len(rows) == 9 and rows["20240107|at|a"] == 501


def test_ordered_index_with_payload_on_a_million_rows(spark):
    df = spark.range(1_000_000).select((F.xxhash64("id") % 1000).alias("k"), "id", F.repeat(F.col("id").cast("string"), 3).alias("payload"))
    out = ordered_index(df, [F.col("k"), F.col("id")], name="i")
    row = out.agg(F.count_distinct("i").alias("n"), F.min("i").alias("lo"), F.max("i").alias("hi"), F.count("payload").alias("p")).first()
    assert (row.n, row.lo, row.hi, row.p) == (1_000_000, 0, 999_999, 1_000_000)
    assert batches(df, [F.col("k"), F.col("id")], 50).groupBy("batch").count().agg(F.max("count")).first()[0] == 50


def test_csv_as_a_data_frame_library_writes_it(spark, tmp_path):
    head = ("chart_date,fetched_at,position,old_position,position_change,streams,entry_state,entry_date,rank_date,weeks_on_chart,time_unit,"
            "song_uuid,song_name,artist_name,image_url,raw_json")
    row = '2024-01-07T12:00:00+00:00,now,1,5.0,4.0,12345678901.0,UP,,,3.0,week,u1,"Say ""Hi"", twice","A, B\nand C",,"{""position"": 1, ""x"": null}"'
    (tmp_path / "charts.csv").write_text(f"{head}\n{row}\n")
    r = st.read_chart_csv(spark, f"file://{tmp_path}/charts.csv").collect()
    assert len(r) == 1 and (r[0].position, r[0].old_position, r[0].streams, r[0].weeks_on_chart) == (1, 5, 12345678901, 3)
    assert (r[0].song_name, r[0].artist_name, r[0].image_url) == ('Say "Hi", twice', "A, B\nand C", None)
    assert r[0].raw_json == '{"position": 1, "x": null}' and r[0].chart_date == D(2024, 1, 7)
    names = [f.name for f in S.SONG_FEATURES.fields]
    values = dict(song_uuid="u", key="5.0", mode="1.0", time_signature="4.0", explicit="True", tempo="120.5", genres='"[{""root"": ""pop, rock""}]"', copyright="c")
    (tmp_path / "features.csv").write_text(",".join(names) + "\n" + ",".join(values.get(n, "") for n in names) + "\n")
    r = st.read_feature_csv(spark, f"file://{tmp_path}/features.csv").first()
    assert (r.key, r.mode, r.time_signature, r.explicit, r.tempo, r.genres, r.copyright) == (5, 1, 4, True, 120.5, '[{"root": "pop, rock"}]', "c")


def test_written_csv_files_hold_a_bounded_number_of_rows(spark, tmp_path):
    k = F.col("id").cast("string")
    rows = spark.range(95).coalesce(1).select(k.alias("song_uuid"), F.concat(F.lit('The "'), k, F.lit('", part\none')).alias("song_name"))
    want = rows.select(*[F.col(f.name) if f.name in rows.columns else F.lit(None).cast("string").alias(f.name) for f in S.CHART_ENTRY.fields])
    st.write_csv(want, f"file://{tmp_path}/csv", file_rows=10)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 10
    got = st.read_chart_csv(spark, f"file://{tmp_path}/csv").select("song_uuid", "song_name").collect()
    assert sorted(map(tuple, got)) == sorted((str(i), f'The "{i}", part\none') for i in range(95))


def test_chart_pages_shuffle_rows_only_and_land_in_bounded_gzip_files(spark, tmp_path):
    day = D(2024, 1, 7)
    rows = [(day, "de", str(i), None if i % 30 == 4 else 1000 - i, i) for i in range(1, 251)]
    chart = spark.createDataFrame(rows, ENTRY).repartition(3)
    pages = DOCS.chart_pages_json(chart)
    below = pages._jdf.queryExecution().sparkPlan().toString()
    below = below[below.rindex("ObjectHashAggregate"):]  # the side of the shuffle that reads the rows
    assert "collect_list" in below and "Artist" not in below
    path = DOCS.land_text(pages.coalesce(1), f"file://{tmp_path}/pages", 2)
    assert len(list((tmp_path / "pages").glob("*.gz"))) == 2
    got = st.flatten_chart_items(st.chart_items(st.read_chart_pages(spark, path)), F.lit("t")).collect()
    assert sorted((r.position, r.streams, r.song_uuid, r.artist_name) for r in got if r.position % 50) == [
        (i, m, u, None if i % 7 == 0 else f"Artist {u}") for _, _, u, m, i in sorted(rows, key=lambda r: r[4]) if i % 50]
    assert sorted(r.position for r in got) == list(range(1, 251))
    assert {r.raw_json for r in got if r.position == 50} == {
        '{"position":50,"metric":950,"entryState":"STABLE","entryDate":"2023-12-24","rankDate":"2024-01-07","timeOnChart":6,"timeOnChartUnit":"week","label":{"id":2}}'}
    kept = [[x["position"] for x in map(json.loads, r["items"])] for r in st.read_chart_pages(spark, path).collect()]
    assert sorted(kept) == [list(range(1, 101)), list(range(101, 201)), list(range(201, 251))]  # in order inside a page


def test_raw_json_keeps_undeclared_and_null_fields(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"chart_date":"2024-01-07T00:00:00+00:00","country":"de","items":[{"position":1,"x":{"y":[1]},"metric":null}]}\n')
    r = st.flatten_chart_items(st.chart_items(st.read_chart_pages(spark, f"file://{tmp_path}/p.json")), F.lit("t")).first()
    assert r.raw_json == '{"position":1,"x":{"y":[1]},"metric":null}' and r.position == 1 and r.streams is None
    docs = spark.createDataFrame([("a", '{"object":{"genres":[{"root":"r","sub":["s"]}],"audio":{"key":1}}}')], "song_uuid string, json string")
    assert st.flatten_song_features(docs).first().genres == '[{"root":"r","sub":["s"]}]'


def test_duplicate_staged_rows_load_one_track(spark):
    row = {f.name: None for f in S.SONG_FEATURES.fields}
    staged = spark.createDataFrame([tuple((row | dict(song_uuid="a", danceability=x)).values()) for x in (0.1, 0.2, 0.2)], S.SONG_FEATURES)
    assert [r.danceability for r in ld.load_tracks(staged).collect()] == [0.2]
    assert ld.merge_track_features(tracks(spark, [("a", {}), ("b", {})]), staged).count() == 2


def test_full_load_twice_and_failed_rules(spark):
    fx = TD.load_fixture(spark, SF_SMALL)
    src = WH.Sources(chart_entries=fx.chart_raw, features=fx.features_all, weather_readings=TD.weather_readings(fx.weather_raw), dim_time=fx.dim_time)
    root = st.shared_path(spark, "test_full")
    WH.build_warehouse(spark, src, root)
    once = {r.table: r.rows for r in WH.row_counts(WH.read_star(spark, root)).collect()}
    WH.build_warehouse(spark, src, root)
    assert once == {r.table: r.rows for r in WH.row_counts(WH.read_star(spark, root)).collect()}
    assert once["dim_track"] == fx.part.count() and once["fact_track_chart"] == fx.chart_raw.count()
    with pytest.raises(WH.LoadFailed, match="time_rows_expected"):
        WH.build_warehouse(spark, src, root, expected_days=3)


def test_track_versions_are_pruned(spark):
    root = st.shared_path(spark, "test_versions")
    for v in range(4):
        WH.write_dim_track_version(tracks(spark, [(str(v), {})]), root, v)
    WH.prune_track_versions(spark, root)
    assert WH.track_versions(spark, root) == [2, 3]
    assert WH.read_dim_track(spark, root).first().track_id == "3"


def test_missing_features_are_not_capped(spark):
    dim = tracks(spark, [(f"t{i:04d}", {}) for i in range(500)])
    assert inc.missing_features(dim).count() == 500
    assert [r.track_id for r in inc.missing_features(dim, 2).collect()] == ["t0000", "t0001"]


def test_period_comparison_needs_its_ranges(spark):
    from chartlake.config import MartConfig
    from chartlake.plans.marts import period_comparison

    with pytest.raises(ValueError, match="periods"):
        period_comparison(TD.load_fixture(spark, SF_SMALL).star, MartConfig())


def test_checkpoint_folder_is_never_guessed_on_a_cluster(spark):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
