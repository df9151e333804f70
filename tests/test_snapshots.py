"""Commit log, merge on read, compaction, stream ledger and sketches."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F
from tiny import SF_SMALL, dim_time, facts, star, tracks, weather

from chartlake import schemas as S
from chartlake.operators import loaders as ld
from chartlake.operators import sketches as SK
from chartlake.plans import commit_log as log
from chartlake.plans import warehouse as WH
from chartlake.sources import staging as ST
from chartlake.sources import testdata as TD

D = dt.date


def files(root):
    """{path below root: bytes} of the parquet files of a local folder."""
    base = root.removeprefix("file:")
    return {os.path.relpath(os.path.join(d, n), base): os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(base) for n in names if n.endswith(".parquet")}


def counts(spark, root):
    return {r.table: r.rows for r in WH.row_counts(WH.read_star(spark, root)).collect()}


def small_star(spark):
    days = [D(2024, 1, 7), D(2024, 1, 14)]
    return star(spark, [("a", {"danceability": 0.5}), ("b", {}), ("c", {"genre": "rock"})],
                [(t, d, c, 10, i) for i, (t, c) in enumerate([("a", "de"), ("b", "de"), ("a", "at")], 1) for d in days],
                [(d, 1.0, 2.0, 3.0, 4.0) for d in days])


def staged(spark, rows):
    names = [f.name for f in S.SONG_FEATURES.fields]
    return spark.createDataFrame([tuple({**dict.fromkeys(names), **r}[n] for n in names) for r in rows], S.SONG_FEATURES)


# ------------------------------------------------------------ commits


@pytest.mark.parametrize("stop_at", [0, 1, 2, 3])
def test_a_load_that_stops_is_not_seen(spark, monkeypatch, stop_at):
    root = ST.shared_path(spark, "test_stop")
    WH.write_star(small_star(spark), root)
    before, version = counts(spark, root), log.current(spark, root).version
    src = WH.Sources(
        chart_entries=spark.createDataFrame([(D(2024, 1, 21), "d", 5, 1)], "chart_date date, song_uuid string, streams long, position int"),
        features=staged(spark, [{"song_uuid": "d"}]), start=D(2023, 12, 1), end=D(2024, 4, 30),
        weather_readings=spark.createDataFrame([(D(2024, 1, 21), "x", 1.0, 1.0, 1.0, 1.0)], S.WEATHER_READING))
    append, calls = log.Transaction.append, []

    def stops(self, df, table, kind="rows"):
        if len(calls) == stop_at:
            raise RuntimeError("lost")
        calls.append(table)
        return append(self, df, table, kind)

    monkeypatch.setattr(log.Transaction, "append", stops)
    with pytest.raises(RuntimeError):
        WH.load_star(spark, src, root)
    monkeypatch.undo()
    assert counts(spark, root) == before and log.current(spark, root).version == version
    tx = WH.load_star(spark, src, root)
    assert counts(spark, root) == before  # staged, not published
    tx.commit()
    after = counts(spark, root)
    assert all(after[t] > before[t] for t in before)
    gone = log.vacuum(spark, root)
    assert len(gone) == stop_at and counts(spark, root) == after


def test_failed_rules_publish_nothing(spark):
    root = ST.shared_path(spark, "test_rules")
    WH.write_star(small_star(spark), root)
    fx = TD.load_fixture(spark, SF_SMALL)
    src = WH.Sources(chart_entries=fx.chart_raw, features=fx.features_all, weather_readings=TD.weather_readings(fx.weather_raw), dim_time=fx.dim_time)
    before, version = counts(spark, root), log.current(spark, root).version
    with pytest.raises(WH.LoadFailed):
        WH.build_warehouse(spark, src, root, expected_days=3)
    assert counts(spark, root) == before and log.current(spark, root).version == version


def test_two_writers_and_a_broken_log_file(spark):
    root = ST.shared_path(spark, "test_conflict")
    WH.write_star(small_star(spark), root)
    one, two = WH.begin(spark, root), WH.begin(spark, root)
    extra = facts(spark, [("c", D(2024, 1, 7), "de", 1, 9)])
    one.append(extra, "fact_track_chart")
    two.append(extra, "fact_track_chart")
    one.commit()
    with pytest.raises(log.CommitConflict):
        two.commit()
    assert counts(spark, root)["fact_track_chart"] == 7
    before = log.current(spark, root)
    with open(root.removeprefix("file:") + f"/_log/{before.version + 1:012d}.json", "w") as f:
        f.write('{"version": ')
    assert log.current(spark, root).version == before.version
    tx = WH.begin(spark, root)
    tx.append(facts(spark, [("b", D(2024, 1, 7), "at", 1, 9)]), "fact_track_chart")
    assert tx.commit().version == before.version + 2
    assert counts(spark, root)["fact_track_chart"] == 8
    log.vacuum(spark, root)
    assert counts(spark, root)["fact_track_chart"] == 8


def test_nothing_new_publishes_nothing(spark):
    root = ST.shared_path(spark, "test_nothing")
    WH.write_star(small_star(spark), root)
    version = log.current(spark, root).version
    tx = WH.begin(spark, root)
    assert tx.append(facts(spark, []), "fact_track_chart") is None
    assert tx.commit().version == version and log.versions(spark, root) == [version]


def test_tables_without_a_log_are_read_and_taken_over(spark):
    root, s = ST.shared_path(spark, "test_plain"), small_star(spark)
    for name in ("dim_time", "dim_weather"):
        s.tables()[name].write.parquet(f"{root}/{name}")
    s.fact.write.partitionBy("country").parquet(f"{root}/fact_track_chart")
    WH.write_dim_track_version(s.dim_track, root, 0)
    before = counts(spark, root)
    WH.merge_features(spark, root, staged(spark, [{"song_uuid": "b", "danceability": 0.25}]))
    assert counts(spark, root) == before
    assert {r.track_id: r.danceability for r in WH.read_dim_track(spark, root).collect()} == {"a": 0.5, "b": 0.25, "c": None}
    assert counts(spark, root)["fact_track_chart"] == 6


# ------------------------------------------------------------ merge on read


def test_merges_on_read_equal_merges_in_place(spark, monkeypatch):
    monkeypatch.setattr(WH, "CHANGE_RATIO", 100)
    r = random.Random(2)
    root = ST.shared_path(spark, "test_merge")
    ids = list("abcdefgh")
    base = tracks(spark, [(t, {"genre": "old", "energy": 0.1}) for t in ids[:5]])
    tx = WH.begin(spark, root)
    tx.append(base, "dim_track")
    tx.commit()
    want = base
    for step in range(4):
        rows = [{"song_uuid": t, "song_name": r.choice([None, f"n{step}"]), "artist_name": r.choice([None, f"x{step}"]),
                 "genres": r.choice([None, "[]", '[{"root":"g%d"}]' % step]), "duration": r.choice([None, 2.5 + step]),
                 "danceability": r.choice([None, step / 10]), "key": r.choice([None, step])}
                for t in r.sample(ids + ["nobody"], 5)] + [{"song_uuid": None}]
        new = staged(spark, rows + rows[:2])
        WH.merge_features(spark, root, new)
        want = ld.merge_track_features(want, new)
        if step == 1:  # tracks that come after two merges are not touched by those
            more = tracks(spark, [(t, {"genre": "new"}) for t in ids[5:]])
            tx = WH.begin(spark, root)
            tx.append(more, "dim_track")
            tx.commit()
            want = want.unionByName(more)
    at = log.current(spark, root)
    assert len(at.of("dim_track", "changes")) == 4
    got = sorted(map(str, WH.read_dim_track(spark, root).collect()))
    assert got == sorted(map(str, want.collect()))
    monkeypatch.setattr(WH, "BROADCAST_CHANGES", 0)
    assert got == sorted(map(str, WH.read_dim_track(spark, root).collect()))
    monkeypatch.setattr(WH, "CHANGE_RATIO", 0)
    WH.compact(WH.begin(spark, root)).commit()
    now = log.current(spark, root)
    assert not now.of("dim_track", "changes") and len(now.of("dim_track")) == 1
    assert got == sorted(map(str, WH.read_dim_track(spark, root).collect()))
    assert got == sorted(map(str, WH.read_dim_track(spark, root, at).collect()))  # the version before is still there


def test_bytes_of_a_merge_grow_with_the_staged_rows(spark):
    root = ST.shared_path(spark, "test_bytes")
    many = spark.range(200_000).select(F.concat(F.lit("track "), F.col("id")).alias("track_id"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("track_name"))
    tx = WH.begin(spark, root)
    tx.append(many.select(*[(F.col(f.name) if f.name in many.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in S.DIM_TRACK.fields]), "dim_track")
    tx.commit()
    size = sum(files(root).values())
    for n in (10, 20):
        WH.merge_features(spark, root, staged(spark, [{"song_uuid": f"track {i}", "danceability": 0.5} for i in range(n)]))
        assert sum(files(root).values()) < 1.02 * size
    assert WH.read_dim_track(spark, root).filter("danceability = 0.5").count() == 20


def test_changes_past_the_ratio_are_compacted(spark):
    root = ST.shared_path(spark, "test_ratio")
    WH.write_star(small_star(spark), root)
    WH.merge_features(spark, root, staged(spark, [{"song_uuid": "a", "danceability": 0.7}]))
    assert not log.current(spark, root).of("dim_track", "changes")
    assert {r.track_id: r.danceability for r in WH.read_dim_track(spark, root).collect()} == {"a": 0.7, "b": None, "c": None}


# ------------------------------------------------------------ fact batches


def test_files_stay_bounded_over_many_appends(spark, monkeypatch):
    monkeypatch.setattr(WH, "FANOUT", 4)
    root = ST.shared_path(spark, "test_appends")
    rows = [(f"t{i % 7}", D(2024, 1, 7) + dt.timedelta(days=7 * (i % 40)), "de" if i % 3 else "at", i, i % 50) for i in range(400)]
    most = 0
    for k in range(20):
        tx = WH.begin(spark, root)
        tx.append(facts(spark, rows[k::20]).repartition(8), "fact_track_chart")
        WH.compact(tx).commit()
        log.vacuum(spark, root)
        most = max(most, len([f for f in files(root) if f.startswith("fact_track_chart")]))
    assert most <= 2 * 2 * 4  # two countries, batches named by the last two versions
    at = log.current(spark, root)
    assert len(at.of("fact_track_chart")) < 4 and at.rows("fact_track_chart") == 400
    got = WH.read_table(spark, root, "fact_track_chart").collect()
    assert sorted(map(str, got)) == sorted(map(str, facts(spark, rows).collect()))
    low, high = min(b.low for b in at.batches), max(b.high for b in at.batches)
    assert (low, high) == (min(r.date_id for r in got), max(r.date_id for r in got))
    import pyarrow.parquet as pq
    for f in files(root):
        dates = pq.read_table(root.removeprefix("file:") + "/" + f, columns=["date_id"], partitioning=None).column(0).to_pylist()
        assert dates == sorted(dates)


# ------------------------------------------------------------ stream ledger


def page(date, *items):
    listed = ", ".join('{"position": %d, "metric": 7, "song": {"uuid": "%s", "name": "n"}}' % (i + 1, t) for i, t in enumerate(items))
    return '{"chart_date": "%sT00:00:00+00:00", "country": "de", "items": [%s]}' % (date, listed)


def test_replayed_batches_are_skipped_before_the_facts(spark, tmp_path, monkeypatch):
    from chartlake.streaming import chart_stream as CS

    root, landing = ST.shared_path(spark, "test_ledger"), tmp_path / "landing"
    landing.mkdir()
    WH.write_star(small_star(spark), root)
    (landing / "1.json").write_text(page("2024-01-21", "a", "new"))

    def run(checkpoint):
        CS.start_chart_stream(spark, str(landing), root, str(tmp_path / checkpoint)).awaitTermination()

    run("one")
    assert counts(spark, root) == {"dim_time": 91, "dim_track": 4, "dim_weather": 2, "fact_track_chart": 8}
    once = log.current(spark, root)
    assert list(once.loads.values()) == [0]

    def touched(*_args):
        raise AssertionError("the fact table is read")

    monkeypatch.setattr(WH, "stage_charts", touched)
    run("two")  # another query, the same file
    pages = spark.createDataFrame([("x",)], "landed_file string")
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", list(once.loads)[0])
    CS.load_batch(root)(pages, 0)  # the same query, the same epoch: not even the files are looked at
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    monkeypatch.undo()
    assert counts(spark, root)["fact_track_chart"] == 8
    (landing / "2.json").write_text(page("2024-01-28", "b"))
    run("three")  # both files in one batch: the new one is loaded
    assert counts(spark, root)["fact_track_chart"] == 9
    assert WH.read_star(spark, root).fact.select("fact_id").distinct().count() == 9
    assert log.read_batches(spark, root, "loaded_file", log.current(spark, root).of("loaded_file")).count() == 2


# ------------------------------------------------------------ sketches


def test_sketches_of_any_period_stay_near_the_exact_count(spark, monkeypatch):
    root = ST.shared_path(spark, "test_sketch")
    big = spark.range(60_000).select(
        F.concat(F.lit("x"), F.col("id")).alias("fact_id"), F.concat(F.lit("t"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("track_id"),
        (20240101 + F.col("id") % 9).cast("int").alias("date_id"), F.lit(None).cast("int").alias("weather_id"),
        F.when(F.col("id") % 3 == 0, "at").otherwise("de").alias("country"), F.col("id").alias("stream_count"), F.lit(1).alias("chart_position"))
    for k in range(3):
        tx = WH.begin(spark, root)
        tx.append(big.filter(F.col("id") % 3 == k), "fact_track_chart")
        tx.commit()
        WH.store_sketches(spark, root)
    at = log.current(spark, root)
    assert at.rows("track_sketch") == 9 and WH.store_sketches(spark, root).version == at.version

    def close():
        for by in ([], ["country"], ["date_id"], [(F.col("date_id") > 20240104).alias("late")]):
            near = {r[:-2]: (r.entries, r.unique_tracks) for r in SK.unique_tracks(WH.read_sketches(spark, root), *by).collect()}
            exact = {r[:-2]: (r[-2], r[-1]) for r in WH.read_table(spark, root, "fact_track_chart").groupBy(*by).agg(F.count(F.lit(1)), F.count_distinct("track_id")).collect()}
            assert near.keys() == exact.keys() and all(n == exact[k][0] and abs(u - exact[k][1]) <= 0.03 * exact[k][1] for k, (n, u) in near.items())

    close()
    monkeypatch.setattr(WH, "FANOUT", 3)
    WH.compact(WH.begin(spark, root)).commit()
    close()  # the compacted batch has no sketch yet: made on reading
    WH.store_sketches(spark, root)
    assert log.current(spark, root).rows("track_sketch") == 9 * 1
    close()


# ------------------------------------------------------------ first items, latest charts


def test_first_items_of_joined_pages(spark):
    rows = [("d1", "de", 100, ['{"position": 2}', '{"position": null}', '{"position": 1}']), ("d1", "de", 0, ['{"position": 9}', '{"x": 1}', '{"position": 9}']),
            ("d1", "de", 200, ['{"position": 3}']), ("d1", "at", 0, None), ("d1", "at", 100, []), ("d1", "at", 200, ['{"position": 4}', '{"position": 4}']),
            ("d2", None, None, ['{"position": 8}']), ("d2", None, 5, ['{"position": 7}'])]
    pages = spark.createDataFrame(rows, S.CHART_PAGE_DDL).repartition(4)
    for n in (1, 2, 4, 6, 50):
        want = {}
        for d, c, o, items in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0)):
            want.setdefault((d, c), []).extend(items or [])
        want = sorted(str((*k, x)) for k, v in want.items() for x in v[:n])
        assert sorted(str(tuple(r)[:3]) for r in ST.chart_items(pages, n).select("chart_date", "country", "item_json").collect()) == want
    assert ST.chart_items(pages.limit(0), 3).count() == 0
    assert ST.chart_items(pages).count() == 11


def test_latest_chart_of_each_country(spark):
    from chartlake import config as C
    from chartlake.plans import marts as M

    s = star(spark, [(t, {}) for t in "abcd"],
             [("a", D(2024, 1, 7), "de", 1, 1), ("b", D(2024, 1, 14), "de", 1, 2), ("c", D(2024, 1, 14), "de", 1, None), ("d", D(2024, 1, 14), "de", 1, 2),
              ("a", D(2024, 1, 7), "at", 1, 5), ("b", D(2030, 1, 6), "at", 1, 1)], [])
    got = {(r.country, r.place): (r.track_name, r.position, r.chart_date) for r in M.latest_chart_tops(s, C.MartConfig(country=None, top_limit=2)).collect()}
    assert got == {("de", 1): ("name c", None, D(2024, 1, 14)), ("de", 2): ("name b", 2, D(2024, 1, 14)), ("at", 1): ("name a", 5, D(2024, 1, 7))}
    assert M.latest_chart_tops(s, C.MartConfig(country="at", top_limit=2)).count() == 1
    empty = star(spark, [], [], [])
    assert M.latest_chart_tops(empty, C.MartConfig(country=None)).count() == 0


def test_a_load_is_staged_anew_after_another_writer(spark):
    root = ST.shared_path(spark, "test_anew")
    WH.write_star(small_star(spark), root)
    seen = []

    def stage(tx):
        seen.append(tx.base.version)
        if len(seen) == 1:  # another writer publishes meanwhile
            WH.merge_features(spark, root, staged(spark, [{"song_uuid": "b", "danceability": 0.25}]))
        tx.append(facts(spark, [("c", D(2024, 1, 7), "de", 1, 9)]), "fact_track_chart")

    at = WH.publish(spark, root, stage)
    assert seen == [1, 2] and at.version == 3 and counts(spark, root)["fact_track_chart"] == 7
    assert WH.read_dim_track(spark, root).filter("danceability = 0.25").count() == 1


def test_only_batches_of_the_dates_are_read(spark):
    root = ST.shared_path(spark, "test_zones")
    WH.write_star(small_star(spark), root)
    tx = WH.begin(spark, root)
    tx.append(facts(spark, [("c", D(2025, 1, 5), "de", 1, 9)]), "fact_track_chart")
    assert WH.facts_between(tx, 20240114, 20240120).count() == 6
    assert WH.facts_between(tx, 20240115, 20250105).count() == 1
    assert WH.facts_between(tx, 20240101, 20260101).count() == 7
    assert WH.facts_between(tx, None, None).count() == 0
    assert len(WH.facts_between(tx, 20240115, 20250105).inputFiles()) == 1
