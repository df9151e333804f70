"""The layout by track: no exchange below the final group-by, append and compaction."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_snapshots import facts, small_star, staged

from chartlake import config as C
from chartlake.plans import commit_log as log
from chartlake.plans import marts as M
from chartlake.plans import track_layout as TL
from chartlake.plans import warehouse as WH
from chartlake.sources import staging as ST

D = dt.date


def same(spark, root):
    laid, plain = TL.open_layout(spark, root), WH.read_star(spark, root)
    for a, b in ((laid.fact, plain.fact), (laid.dim_track, plain.dim_track)):
        assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def add(spark, root, *rows):
    tx = WH.begin(spark, root)
    tx.append(facts(spark, list(rows)), "fact_track_chart")
    tx.commit()


def test_layout_follows_appends_merges_and_compaction(spark, monkeypatch):
    root = ST.shared_path(spark, "test_layout")
    WH.write_star(small_star(spark), root)
    first = TL.refresh_layout(spark, root, buckets=4)
    same(spark, root)
    assert TL.refresh_layout(spark, root) == first
    add(spark, root, ("b", D(2024, 1, 21), "de", 3, 1), ("x", D(2024, 1, 21), "at", 3, 2))
    second = TL.refresh_layout(spark, root)
    assert second["folder"] == first["folder"] and second["tracks_at"] == first["tracks_at"] and len(second["parts"]) == 2
    same(spark, root)
    WH.merge_features(spark, root, staged(spark, [{"song_uuid": "b", "danceability": 0.25}]))
    third = TL.refresh_layout(spark, root)
    assert third["parts"] == second["parts"] and third["tracks_at"] != second["tracks_at"]
    same(spark, root)
    monkeypatch.setattr(WH, "FANOUT", 2)
    WH.compact(WH.begin(spark, root)).commit()
    fourth = TL.refresh_layout(spark, root, buckets=4)
    assert fourth["folder"] != first["folder"] and len(fourth["parts"]) == 1
    same(spark, root)


def test_a_layout_that_breaks_off_is_not_read_twice(spark, monkeypatch):
    root = ST.shared_path(spark, "test_broken")
    WH.write_star(small_star(spark), root)
    TL.refresh_layout(spark, root, buckets=4)
    add(spark, root, ("b", D(2024, 1, 21), "de", 3, 1))
    monkeypatch.setattr(TL, "_write_json", lambda *_a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        TL.refresh_layout(spark, root)
    monkeypatch.undo()
    assert TL.open_layout(spark, root).fact.count() == 6
    TL.refresh_layout(spark, root)
    same(spark, root)


def test_season_mart_has_no_exchange_below_its_groups(spark):
    root = ST.shared_path(spark, "test_plan")
    WH.write_star(small_star(spark), root)
    TL.refresh_layout(spark, root, buckets=4)
    add(spark, root, ("b", D(2024, 1, 21), "de", 3, 1))
    TL.refresh_layout(spark, root)
    assert log.current(spark, root).version == 2
    cfg = C.MartConfig(country=None)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def exchanges(star):
            plan = M.audio_features_by_season(star, cfg)._jdf.queryExecution().executedPlan().toString()
            return [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "track_id" in x]

        assert len(exchanges(WH.read_star(spark, root))) >= 2
        assert exchanges(TL.open_layout(spark, root)) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
