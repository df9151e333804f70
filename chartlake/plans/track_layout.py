"""A copy of the facts and tracks laid out by track (JN-1, JN-5).

Both tables are bucketed and sorted by ``track_id`` into the same number of
buckets, so the per-track reduction of the marts and its join with the tracks
run bucket by bucket without an exchange: a hit song is shuffled when the layout
is written, not in every query.

Layout under ``root``: ``_layout/<id>/fact`` (also partitioned by batch and country),
``_layout/<id>/tracks-<id>`` and, written last, ``_layout/<version>_<id>.json``
with the number of buckets and what belongs to the layout at that version.

* Append: a new fact batch becomes a partition of the same buckets (one file a
  bucket and country); where tracks changed they are written anew.  A partition
  whose writer stopped is named by no description and so is never read.
* Compaction: once batches that the layout holds were compacted away, or it has
  more than ``MAX_PARTS`` partitions, the next refresh writes a new layout.

Both keep the bucketing, as Spark reads the bucket from the file name.  Spark
only knows bucketing of tables in its catalog, so ``open_layout`` registers the
two folders there, under names made from their path.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake import schemas as S
from chartlake.operators.dims import Star
from chartlake.plans import commit_log as log
from chartlake.plans import warehouse as WH
from chartlake.sources.staging import path_exists

#: Batches of a layout after which it is written anew.
MAX_PARTS = 16


def _base(root: str) -> str:
    return f"{root.rstrip('/')}/_layout"


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    p, fs = log._path(spark, path)
    out = fs.create(p, False)
    out.write(json.dumps(value).encode())
    out.close()


def layouts(spark: SparkSession, root: str) -> list[dict]:
    """Finished layouts, the newest last."""
    found = []
    for n in sorted(x for x in log._names(spark, _base(root)) if x.endswith(".json")):
        p, fs = log._path(spark, f"{_base(root)}/{n}")
        stream = fs.open(p)
        try:
            found.append(json.loads(bytes(stream.readAllBytes()).decode()))
        except json.JSONDecodeError:
            continue
        finally:
            stream.close()
    return found


def _table(spark: SparkSession, path: str, schema: T.StructType, buckets: int, *by: str) -> str:
    """Register a bucketed folder in the catalog; its name there."""
    name = "by_track_" + hashlib.sha256(path.encode()).hexdigest()[:24]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet " + (f"PARTITIONED BY ({', '.join(by)}) " if by else "")
              + f"CLUSTERED BY (track_id) SORTED BY (track_id) INTO {buckets} BUCKETS LOCATION '{path}'")
    if by and path_exists(spark, path):
        spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)
    return name


def _add(df: DataFrame, path: str, schema: T.StructType, buckets: int, *by: str) -> None:
    """Add rows to a bucketed folder: one file a bucket and partition."""
    name = _table(df.sparkSession, path, schema, buckets, *by)
    names = [f.name for f in schema.fields if f.name not in by]
    df.select(*names, *by).repartition(buckets, "track_id").write.insertInto(name)


FACT = T.StructType([*S.FACT_TRACK_CHART.fields, T.StructField("part", T.StringType())])


def refresh_layout(spark: SparkSession, root: str, buckets: int = 512) -> dict:
    """Bring the layout to the last published version; returns its description.

    ``buckets`` of a new layout: the rows of a bucket should fit a task."""
    at = log.current(spark, root)
    facts = [b.name for b in at.of("fact_track_chart")]
    tracks = [b.name for b in at.of("dim_track") + at.of("dim_track", "changes")]
    old = (layouts(spark, root) or [None])[-1]
    if old and sorted(old["parts"]) == sorted(facts) and old["tracks"] == tracks:
        return old
    if not old or not old["parts"].keys() <= set(facts) or len(facts) > MAX_PARTS:
        old = {"folder": f"{_base(root)}/{uuid.uuid4().hex[:12]}", "buckets": buckets, "parts": {}, "tracks": None, "tracks_at": None}
    new = [b for b in at.of("fact_track_chart") if b.name not in old["parts"]]
    parts = dict(old["parts"])
    if len(facts) > MAX_PARTS or len(new) == len(facts):
        groups = [new] if new else []  # a new layout is one partition
    else:
        groups = [[b] for b in new]
    for group in groups:
        part = uuid.uuid4().hex[:12]
        rows = log.read_batches(spark, root, "fact_track_chart", group).withColumn("part", F.lit(f"p{part}"))
        _add(rows, f"{old['folder']}/fact", FACT, old["buckets"], "part", "country")
        parts |= {b.name: f"p{part}" for b in group}
    tracks_at = old["tracks_at"]
    if old["tracks"] != tracks:
        tracks_at = f"{old['folder']}/tracks-{uuid.uuid4().hex[:12]}"
        _add(WH.read_dim_track(spark, root, at), tracks_at, S.DIM_TRACK, old["buckets"])
    done = {"folder": old["folder"], "buckets": old["buckets"], "version": at.version, "parts": parts, "tracks": tracks, "tracks_at": tracks_at}
    _write_json(spark, f"{_base(root)}/{at.version:012d}_{uuid.uuid4().hex[:12]}.json", done)
    return done


def open_layout(spark: SparkSession, root: str) -> Star:
    """The star at the version of the newest layout, facts and tracks by track."""
    now = layouts(spark, root)[-1]
    star = WH.read_star(spark, root, log.read_version(spark, root, now["version"]))
    fact = spark.table(_table(spark, f"{now['folder']}/fact", FACT, now["buckets"], "part", "country"))
    tracks = spark.table(_table(spark, now["tracks_at"], S.DIM_TRACK, now["buckets"]))
    parts = sorted(set(now["parts"].values()))
    return replace(star, fact=fact.filter(F.col("part").isin(parts) if parts else F.lit(False)).select(*S.FACT_TRACK_CHART.names), dim_track=tracks)
