"""Helpers shared by the corpus operators: table access, column names that
cannot clash, lineage cuts and connected components."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartlake.session import cut_lineage, ensure_checkpoint_dir

#: The characters of the class [\x20\x09-\x0D], used wherever "white space" is meant.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"

_TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def lower_ascii(text: str) -> str:
    """A-Z lower-cased, every other character as it is."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").translate(_TO_LOWER).decode("utf-8", "surrogatepass")


def lower_utf8(text: str) -> bytes:
    """The UTF-8 bytes of a text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TO_LOWER)


#: Bytes or characters of a text whose words are held as a list at a time.
PIECE = 4 << 20
_BLANK = {str: re.compile("[\x20\x09-\x0D]"), bytes: re.compile(rb"[\x20\x09-\x0D]")}


def pieces(text):
    """A text (str or bytes) in order, cut at blanks every ``PIECE`` or a little
    more, so that a very long text never becomes one list of words."""
    start = 0
    while start < len(text):
        cut = _BLANK[type(text)].search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        yield text[start:end]
        start = end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (compared without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name (dots and blanks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def content_key(text: Column) -> tuple[Column, Column]:
    """128 bits that stand for a text: two seeded 64-bit hashes."""
    return F.xxhash64(text), F.xxhash64(F.lit("second"), text)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``shared_folder`` through Spark's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark free the shuffles, broadcasts and checkpoints of frames that are
    no longer held: its cleaner acts when the driver's JVM collects garbage, which
    a driver that only plans many small jobs seldom does by itself."""
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that ``edges`` names: root is the smallest
    node of its connected component.

    Alternating large-star and small-star steps: each is one aggregation by
    node and one join on it, until every pair joins a node to a root that has no
    smaller neighbour itself.  The smallest neighbours are written before the join, so both of
    its sides are plain exchanges and the adaptive skew join may split a hub.  Self edges are allowed, an empty input gives no rows.
    """
    def pairs(df: DataFrame) -> DataFrame:
        return df.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def done(df: DataFrame) -> bool:
        sides = df.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(df.select(F.col("b").alias("node"), F.lit(0).alias("up")))
        return not sides.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("low")).where("up > 1 or (up = 1 and low = 0)").limit(1).count()

    nodes = edges.select(F.explode(F.array(col(a), col(b))).alias("node")).distinct()
    e = cut_lineage(pairs(edges.select(col(a).alias("a"), col(b).alias("b"))))
    while not done(e):
        # large star: the larger neighbours of each node move to the smallest of its neighbourhood
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut_lineage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        e = pairs(both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: each node and its smaller neighbours move to the smallest of them
        e = cut_lineage(e)
        low = cut_lineage(e.groupBy("a").agg(F.min("b").alias("m")))
        moved = e.join(low, "a")
        e = cut_lineage(pairs(moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))))
        release(e.sparkSession)
    root = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.join(root, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
