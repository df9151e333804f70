"""Loader and merge rules on hand-made frames."""

import datetime as dt

from pyspark.sql import functions as F

from chartlake import schemas as S
from chartlake.operators import loaders as ld
from chartlake.sources import staging as st

from tiny import dim_time, tracks, weather

D = dt.date


def feat(spark, rows):
    out = []
    for r in rows:
        base = {f.name: None for f in S.SONG_FEATURES.fields}
        base.update(r)
        out.append(tuple(base[f.name] for f in S.SONG_FEATURES.fields))
    return spark.createDataFrame(out, S.SONG_FEATURES)


def test_feature_merge_overwrites_with_null_keeps_names(spark):
    dim = tracks(spark, [("a", dict(artist_names="x", genre="rock", danceability=0.5, energy=0.4, key=3)),
                         ("b", dict(genre="pop", danceability=0.1))])
    staged = feat(spark, [dict(song_uuid="a", song_name=None, artist_name="y", danceability=None, energy=0.9,
                               genres="not json", key=None),
                          dict(song_uuid="zz", song_name="ghost", danceability=0.3)])
    out = {r.track_id: r for r in ld.merge_track_features(dim, staged).collect()}
    a = out["a"]
    assert a.track_name == "name a" and a.artist_names == "y"
    assert a.danceability is None and a.energy == 0.9 and a.key is None
    assert a.genre == "rock"
    assert out["b"].danceability == 0.1 and "zz" not in out


def test_feature_merge_genre_rules(spark):
    dim = tracks(spark, [(t, dict(genre="old")) for t in "abcd"])
    staged = feat(spark, [dict(song_uuid="a", genres='[{"root":"new"}]'), dict(song_uuid="b", genres="[]"),
                          dict(song_uuid="c", genres='[{"x":1}]'), dict(song_uuid="d", genres=None)])
    out = {r.track_id: r.genre for r in ld.merge_track_features(dim, staged).collect()}
    assert out == {"a": "new", "b": "old", "c": "", "d": "old"}


def test_feature_merge_last_staged_row_wins(spark):
    dim = tracks(spark, [("a", {})])
    staged = feat(spark, [dict(song_uuid="a", danceability=0.1), dict(song_uuid="a", danceability=0.2)])
    staged = staged.withColumn("seq", F.when(F.col("danceability") == 0.2, 2).otherwise(1))
    assert ld.merge_track_features(dim, staged, "seq").first().danceability == 0.2


def test_load_tracks_defaults_and_units(spark):
    staged = feat(spark, [dict(song_uuid="a", duration=1.9999, key=None), dict(song_uuid=None, song_name="drop")])
    rows = ld.load_tracks(staged).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.track_name == "Unknown" and r.artist_names == "Unknown" and r.duration_ms == 1999


def test_facts_skip_unknown_dates_and_null_weather(spark):
    t = dim_time(spark, D(2024, 1, 1), D(2024, 1, 10))
    w = weather(spark, [(D(2024, 1, 7), 1.0, 1.0, 1.0, 1.0)])
    charts = spark.createDataFrame(
        [(D(2024, 1, 7), "a", 10, 1), (D(2024, 1, 8), "b", 5, 2), (D(2025, 1, 1), "c", 1, 1)],
        "chart_date date, song_uuid string, streams long, position int")
    facts = {r.track_id: r for r in ld.load_facts(charts, t, w).collect()}
    assert set(facts) == {"a", "b"} and facts["a"].weather_id == 20240107 and facts["b"].weather_id is None
    assert facts["a"].country == "de" and facts["a"].fact_id == "20240107|de|a"
    assert ld.skipped_dates(charts.select("chart_date"), t, "chart_date").count() == 1


def test_duplicate_weather_rows_pick_max_id(spark):
    t = dim_time(spark, D(2024, 1, 1), D(2024, 1, 2))
    w = spark.createDataFrame([(7, 20240101, 1.0, 1.0, 1.0, 1.0), (9, 20240101, 2.0, 2.0, 2.0, 2.0)], S.DIM_WEATHER)
    charts = spark.createDataFrame([(D(2024, 1, 1), "a", 1, 1)], "chart_date date, song_uuid string, streams long, position int")
    assert ld.load_facts(charts, t, w).first().weather_id == 9


def test_placeholders_one_row_per_new_id(spark):
    dim = tracks(spark, [("a", {})])
    entries = spark.createDataFrame(
        [(D(2024, 1, 14), "n", 5, "late", None), (D(2024, 1, 7), "n", 9, "early", None), (D(2024, 1, 7), "a", 1, "x", "y")],
        "chart_date date, song_uuid string, position int, song_name string, artist_name string")
    rows = ld.placeholder_tracks(entries, dim).collect()
    assert [(r.track_id, r.track_name, r.artist_names, r.danceability) for r in rows] == [("n", "early", "Unknown", None)]


def test_new_chart_facts_idempotent(spark):
    t = dim_time(spark, D(2024, 1, 1), D(2024, 1, 10))
    w = weather(spark, [])
    entries = spark.createDataFrame([(D(2024, 1, 7), "a", 10, 1)], "chart_date date, song_uuid string, streams long, position int")
    first = ld.new_chart_facts(entries, t, w, spark.createDataFrame([], S.FACT_TRACK_CHART))
    assert first.count() == 1
    assert ld.new_chart_facts(entries, t, w, first).count() == 0


def test_extend_dim_time(spark):
    t = dim_time(spark, D(2024, 1, 1), D(2024, 1, 10))
    assert ld.extend_dim_time(t, D(2024, 1, 15)).count() == 5
    assert ld.extend_dim_time(t, D(2024, 1, 10)).count() == 0
    empty = spark.createDataFrame([], S.DIM_TIME)
    assert ld.extend_dim_time(empty, D(2024, 1, 15)).count() == 0


def test_build_dim_time_skips_existing(spark):
    existing = dim_time(spark, D(2024, 1, 1), D(2024, 1, 5))
    assert ld.build_dim_time(spark, D(2024, 1, 1), D(2024, 1, 10), existing).count() == 5


def test_daily_weather_skips_nulls(spark):
    r = spark.createDataFrame([(D(2024, 1, 1), "x", 1.0, None, 2.0, None), (D(2024, 1, 1), "y", 3.0, 4.0, None, 6.0)],
                              S.WEATHER_READING)
    row = ld.daily_weather(r).first()
    assert (row.temperature_avg, row.precipitation_mm, row.wind_speed_kmh, row.sunshine_hours) == (2.0, 4.0, 2.0, 6.0)


def test_flatten_song_features_rejects_empty_audio(spark):
    docs = spark.createDataFrame([
        ("a", '{"object":{"name":"A","isrc":{"value":"I1"},"audio":{"danceability":0.5}}}'),
        ("b", '{"object":{"name":"B","isrc":"bare","audio":{}}}'),
        ("c", '{"object":{"name":"C"}}'),
        ("d", '{"object":{"name":"D","isrc":"bare","audio":{"key":null,"tempo":90.0},"genres":[{"root":"x"}]}}'),
    ], "song_uuid string, json string")
    rows = {r.song_uuid: r for r in st.flatten_song_features(docs).collect()}
    assert set(rows) == {"a", "d"}
    assert rows["a"].isrc == "I1" and rows["d"].isrc is None
    assert rows["a"].genres == "[]" and rows["d"].genres == '[{"root":"x"}]'


def test_flatten_chart_items_missing_song(spark):
    pages = st.parse_chart_pages(spark.createDataFrame(
        [('{"chart_date":"2024-01-07T00:00:00+00:00","country":"de","items":[{"position":1,"metric":5},'
          '{"position":2,"song":{"uuid":"u","name":"n"}}]}',)], "value string"))
    rows = st.flatten_chart_items(st.chart_items(pages), F.lit("t")).orderBy("position").collect()
    assert rows[0].song_uuid is None and rows[0].streams == 5
    assert rows[1].song_uuid == "u" and rows[1].artist_name is None and rows[1].raw_json.startswith("{")
    assert st.chart_items(pages, top_n=1).count() == 1


def test_union_first_wins(spark):
    old = feat(spark, [dict(song_uuid="a", song_name="old")])
    new = feat(spark, [dict(song_uuid="a", song_name="new"), dict(song_uuid="b", song_name="b")])
    got = {r.song_uuid: r.song_name for r in st.union_first_wins(old, new).collect()}
    assert got == {"a": "old", "b": "b"}


def test_explode_weather_arrays_index_aligned(spark):
    docs = spark.createDataFrame(
        [("x", (["2024-01-01", "2024-01-02"], [1.0, 2.0], [0.5, None], [3.0, 4.0], [0.0, 7200.0]))],
        S.WEATHER_DOC_DDL)
    rows = st.explode_weather_arrays(docs).orderBy("date").collect()
    assert [(r.date, r.temperature_avg, r.precipitation_mm, r.sunshine_hours) for r in rows] == [
        (D(2024, 1, 1), 1.0, 0.5, None), (D(2024, 1, 2), 2.0, None, 2.0)]


def test_first_per_key_hot_key_is_map_side_combined(spark):
    hot = [("hot", i, f"v{i}") for i in range(3000)]
    cold = [(f"k{i}", i, "x") for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "k string, seq int, v string").repartition(8)
    out = ld.first_per_key(df, "k", [F.col("seq")], last=True)
    rows = {r.k: (r.seq, r.v) for r in out.collect()}
    assert len(rows) == 6001 and rows["hot"] == (2999, "v2999")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan  # combined before the shuffle


def test_relink_weather_idempotent_and_keeps_existing(spark):
    t = dim_time(spark, D(2024, 1, 1), D(2024, 1, 10))
    w = weather(spark, [(D(2024, 1, 7), 1.0, 1.0, 1.0, 1.0)])
    charts = spark.createDataFrame([(D(2024, 1, 7), "a", 10, 1), (D(2024, 1, 8), "b", 5, 2)],
                                   "chart_date date, song_uuid string, streams long, position int")
    facts = ld.load_facts(charts, t, spark.createDataFrame([], S.DIM_WEATHER))
    assert [r.weather_id for r in facts.orderBy("track_id").collect()] == [None, None]
    once = ld.relink_weather(facts, w)
    twice = ld.relink_weather(once, w)
    got = sorted((r.track_id, r.weather_id) for r in twice.collect())
    assert got == [("a", 20240107), ("b", None)] == sorted((r.track_id, r.weather_id) for r in once.collect())
