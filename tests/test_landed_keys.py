"""Bloom filters of landed keys: the anti-join through them equals the plain one."""

import pytest
from pyspark.sql import functions as F

from chartlake.operators import landed_keys as LK


def keys_of(spark, low, high):
    return spark.range(low, high).select(F.concat(F.lit("song-"), F.col("id")).alias("song_uuid"))


def plain(rows, landed):
    return sorted(r.n for r in rows.join(landed, "song_uuid", "left_anti").collect())


@pytest.mark.parametrize("blocks", [1, 16, 2 * LK.BROADCAST_BLOCKS])
def test_equals_the_plain_anti_join(spark, blocks):
    # one block holds ten times the keys it is made for, so that most keys need the exact step
    landed = keys_of(spark, 0, 30_000).unionByName(keys_of(spark, 0, 50))
    rows = keys_of(spark, 25_000, 45_000).unionByName(keys_of(spark, 44_000, 45_000)).unionByName(spark.createDataFrame([(None,), ("",)], "song_uuid string")) \
        .withColumn("n", F.monotonically_increasing_id())
    filters = LK.key_filters(landed, "song_uuid", F.crc32("song_uuid") % 3, blocks)
    assert sorted(r.n for r in LK.anti_join(rows, landed, "song_uuid", filters, blocks).collect()) == plain(rows, landed)


def test_no_landed_key_is_missed_and_few_others_are_taken_for_landed(spark):
    blocks = LK.blocks_for(30_000)
    assert blocks == 16 and LK.blocks_for(0) == 1
    filters = LK.key_filters(keys_of(spark, 0, 30_000), "song_uuid", F.lit("a"), blocks)
    maybe = LK.with_maybe(keys_of(spark, 0, 130_000), "song_uuid", filters, blocks).groupBy(
        (F.substring_index("song_uuid", "-", -1).cast("int") < 30_000).alias("landed"), "maybe").count().collect()
    counts = {(r["landed"], r["maybe"]): r["count"] for r in maybe}
    assert counts[(True, True)] == 30_000 and (True, False) not in counts
    assert counts[(False, True)] < 0.02 * 100_000


def test_filters_of_files_are_united(spark, tmp_path):
    path = str(tmp_path / "filters")
    for name, (low, high) in {"a": (0, 400), "b": (300, 900)}.items():
        LK.key_filters(keys_of(spark, low, high), "song_uuid", F.lit(name), 4).write.mode("append").parquet(path)
    stored = spark.read.parquet(path)
    assert {r.of_file for r in stored.select("of_file").distinct().collect()} == {"a", "b"}
    whole = LK.key_filters(keys_of(spark, 0, 900), "song_uuid", F.lit("all"), 4)
    assert {(r.block, bytes(r.bits)) for r in LK.united(stored).collect()} == {(r.block, bytes(r.bits)) for r in whole.collect()}


def test_empty_sides(spark):
    rows = keys_of(spark, 0, 3).withColumn("n", F.lit(1))
    none = keys_of(spark, 0, 0)
    filters = LK.key_filters(none, "song_uuid", F.lit("a"), 1)
    assert LK.anti_join(rows, none, "song_uuid", filters, 1).count() == 3
    assert LK.anti_join(rows.limit(0), keys_of(spark, 0, 5), "song_uuid", LK.key_filters(keys_of(spark, 0, 5), "song_uuid", F.lit("a"), 1), 1).count() == 0


def test_only_rows_that_may_be_landed_are_shuffled(spark):
    """The rows reach the filter by a broadcast; an exchange lies only above the flag's filter."""
    blocks = 16
    rows = keys_of(spark, 0, 60_000).withColumn("n", F.lit(1))
    landed = keys_of(spark, 0, 30_000)
    filters = LK.key_filters(landed, "song_uuid", F.lit("a"), blocks)
    flagged = LK.with_maybe(rows, "song_uuid", filters, blocks)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
