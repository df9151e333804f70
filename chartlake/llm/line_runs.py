"""Line dedup with levelled sorted runs of line hashes (DataFrame functions only).

A run is a Parquet folder of (h1, h2, docs): 128 bits that stand for a line
key and the number of documents of its batches that hold it, range-partitioned
and sorted by hash.  Each batch is anti-joined with the keys that are already
settled (found in ``min_docs`` documents; they need no more counting) and adds
the rest as a run of level 0.  When a level holds ``fanout`` runs they are
merged into one run of the next level, and keys that reach ``min_docs`` there
move to the settled runs.  A last compaction merges what is left.

A line's key is the line without [\\x20\\x09-\\x0D] at both ends, A-Z
lower-cased.  Keys of fewer than ``min_chars`` code points are never dropped.

Defined results: null and empty texts are one empty line; rows are documents,
so repeated rows count as many as they are; a line repeated inside one document
counts once; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.llm.common import BLANKS, LOWER, UPPER, col, content_key, fresh, remove_folder, shared_folder, text_or_empty
from chartlake.session import cut_lineage


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_keys(text: Column) -> Column:
    """Keys of all lines of a text: lower-casing A-Z first leaves the line breaks where they are."""
    return F.transform(lines_of(F.translate(text, UPPER, LOWER)), lambda x: F.btrim(x, F.lit(BLANKS)))


class LineRuns:
    """Run folders by level; the folders live below the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, min_docs: int = 10, fanout: int = 3):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: dict[int, list[str]] = defaultdict(list)
        self.settled: list[str] = []

    def _write(self, rows: DataFrame) -> str:
        path = shared_folder(self.spark, "line-run")
        rows.repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2").write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], "h1 long, h2 long, docs long")
        return self.spark.read.schema("h1 long, h2 long, docs long").parquet(*paths)

    def add(self, counts: DataFrame) -> None:
        """counts: (h1, h2, docs) of one batch, a row per key."""
        if self.settled:
            counts = counts.join(self._read(self.settled), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(counts))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact([level], level + 1)
            level += 1

    def _compact(self, levels: list[int], to: int) -> None:
        paths = [p for x in levels for p in self.levels.pop(x, [])]
        if not paths:
            return
        merged = self._write(self._read(paths).groupBy("h1", "h2").agg(F.sum("docs").alias("docs")))
        rows = self._read([merged])
        self.settled.append(self._write(rows.where(F.col("docs") >= self.min_docs)))
        self.levels[to].append(self._write(rows.where(F.col("docs") < self.min_docs)))
        for p in [*paths, merged]:
            remove_folder(self.spark, p)

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys found in at least ``min_docs`` documents so far."""
        if self.levels:
            self._compact(sorted(self.levels), max(self.levels) + 1)
        return self._read(self.settled).select("h1", "h2")

    def remove(self) -> None:
        """Delete all run folders; frames that still read them must have been written before."""
        for p in [*self.settled, *(p for x in self.levels.values() for p in x)]:
            remove_folder(self.spark, p)
        self.settled.clear()
        self.levels.clear()


def build_runs(docs: DataFrame, text_col: str = "text", min_docs: int = 10, min_chars: int = 1,
               batches: int = 4, fanout: int = 3) -> LineRuns:
    """Runs over all of ``docs``, which arrive in ``batches`` batches.

    One scan counts every batch's keys (map-side combined: a key that a third
    of all lines share leaves each task as one row) into a staged table."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    keys = F.filter(F.array_distinct(line_keys(text)), lambda k: F.length(k) >= min_chars)
    h1, h2 = content_key(F.col("key"))
    staged = shared_folder(spark, "line-batches")
    docs.select(F.pmod(F.xxhash64(text), F.lit(batches)).alias("batch"), F.explode(keys).alias("key")) \
        .select("batch", h1.alias("h1"), h2.alias("h2")) \
        .groupBy("batch", "h1", "h2").agg(F.count(F.lit(1)).alias("docs")) \
        .write.parquet(staged)
    rows = spark.read.schema("batch long, h1 long, h2 long, docs long").parquet(staged)
    runs = LineRuns(spark, min_docs, fanout)
    for b in range(batches):
        runs.add(rows.where(F.col("batch") == b).drop("batch"))
    remove_folder(spark, staged)
    return runs


def drop_lines(docs: DataFrame, frequent: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with two columns appended (names made ``fresh``): line_drops,
    the positions of the dropped lines, and line_kept, the text of the others.

    Only hashes and positions of lines are shuffled to meet the runs; the texts
    are shuffled once, by 128 bits of their content, to meet their positions.
    Equal texts have equal positions, so nothing depends on an id.  The positions
    that stay are a hashed set difference and fetch their lines from an array, so
    a text costs time in proportion to its lines, however many of them go."""
    drops, kept, t1, t2, f1, f2, at, lines = fresh(docs, "line_drops", "line_kept", "text_h1", "text_h2", "found_h1", "found_h2", "found_at", "text_lines")
    text = text_or_empty(text_col)
    k1, k2 = content_key(text)
    keyed = docs.withColumn(t1, k1).withColumn(t2, k2)
    h1, h2 = content_key(F.col("key"))
    found = keyed.select(col(t1).alias("t1"), col(t2).alias("t2"), F.posexplode(line_keys(text)).alias("at", "key")) \
        .where(F.length("key") > 0).select("t1", "t2", "at", h1.alias("h1"), h2.alias("h2")) \
        .join(frequent, ["h1", "h2"], "left_semi") \
        .groupBy("t1", "t2").agg(F.collect_set("at").alias("found"))
    found = cut_lineage(found)  # written, so that the skew join may split the rows of a text with many copies
    joined = keyed.join(found.toDF(f1, f2, at), (col(t1) == col(f1)) & (col(t2) == col(f2)), "left")
    # ``lines`` is named twice below, so the optimiser keeps it as a column instead of splitting the text for each line
    stay = F.array_except(F.sequence(F.lit(0), F.size(col(lines)) - 1), col(drops))
    keep = F.transform(stay, lambda i: F.get(col(lines), i))
    return joined.withColumn(drops, F.coalesce(col(at), F.array().cast("array<int>"))) \
        .select(*[col(c) for c in docs.columns], col(drops), F.when(F.size(col(drops)) > 0, lines_of(text)).alias(lines)) \
        .select(*[col(c) for c in docs.columns], col(drops), F.when(F.size(col(drops)) == 0, text).otherwise(F.array_join(keep, "\n")).alias(kept))
