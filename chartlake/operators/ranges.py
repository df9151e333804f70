"""Range and order operators: the trailing-window join (JN-8 / WN-1), a
distributed ordered index, gaps and islands (WN-3) and batch numbering
(LD-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartlake.operators.dims import calendar_side
from chartlake.session import cut_lineage


def trailing_window(
    days: DataFrame,
    anchors: DataFrame,
    width: int,
    measures: dict[str, str],
    date_col: str = "date",
    anchor_col: str = "chart_date",
    span_days: int | None = None,
) -> DataFrame:
    """Mean of each measure over the ``width`` days ending on every anchor
    date (inclusive), one row per anchor that has at least one day.

    A ``BETWEEN`` join would plan as a nested-loop join.  Instead every day row
    is fanned out to the ``width`` anchors whose window contains it
    (``explode(sequence(d, d + width - 1))``) and joined on equality.  The
    fan-out is applied to the per-day side, so it costs ``width`` x days,
    independent of the number of facts.
    """
    fanned = days.select(
        F.explode(F.sequence(F.col(date_col).cast("date"), F.date_add(F.col(date_col).cast("date"), width - 1))).alias(
            anchor_col
        ),
        *[F.col(src).alias(f"_m_{name}") for name, src in measures.items()],
    )
    keys = calendar_side(anchors.select(F.col(anchor_col).cast("date").alias(anchor_col)).distinct(), span_days)
    return fanned.join(keys, anchor_col).groupBy(anchor_col).agg(
        *[F.avg(f"_m_{name}").alias(name) for name in measures]
    )


def ordered_index(df: DataFrame, order: list[Column], num_partitions: int | None = None, name: str = "idx") -> DataFrame:
    """Add a 0-based position in a total order without a single-task window.

    The frame is range-partitioned and sorted on the order once and written
    with a (partition, row) number, so everything after it sees the same
    boundaries.  Every partition is shifted by the row count of the partitions
    before it (a table of one row per partition, broadcast).  Same result as a
    global ``row_number``, but the work is spread over all tasks.
    """
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    # monotonically_increasing_id: partition number above bit 33, row number below
    placed = cut_lineage(ranged.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_pid", F.shiftright("_at", 33)).withColumn("_rn", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    # one row per partition: bounded by the partition count
    return (
        placed.join(F.broadcast(offsets), "_pid")
        .withColumn(name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rn")).cast("long"))
        .drop("_pid", "_rn", "_off", "_at")
    )


def date_ranges(dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Consecutive dates -> closed ranges (start, end) (WN-3, LD-10).

    Island key: date minus its position in date order; consecutive dates share
    it.  Duplicates are removed first.
    """
    distinct = dates.select(F.col(date_col).cast("date").alias("_d")).filter(F.col("_d").isNotNull()).distinct()
    indexed = ordered_index(distinct, [F.col("_d")], name="_i")
    island = F.date_sub(F.col("_d"), F.col("_i").cast("int"))
    return indexed.groupBy(island.alias("_island")).agg(
        F.min("_d").alias("start"), F.max("_d").alias("end"), F.count(F.lit(1)).alias("days")
    ).drop("_island")


def batches(df: DataFrame, order: list[Column], size: int, name: str = "batch") -> DataFrame:
    """Number the rows of an ordered backlog in batches of ``size`` (LD-15):
    batch = floor(position / size), position 0-based."""
    return ordered_index(df, order, name="_pos").withColumn(name, F.floor(F.col("_pos") / size).cast("long")).withColumnRenamed(
        "_pos", "position_in_backlog"
    )
