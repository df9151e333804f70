"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Every source is a queue of its documents in shuffled order, served up to
``max_passes`` times over.  A document's virtual finish time is the number of
tokens its source has sent once it is through, divided by the source's weight;
the mix serves all queues in the order of that time until the budget is spent.
The cut is therefore one virtual time for all sources: the water level at
which sum(min(weight * level, max_passes * source size)) equals the budget.

* Prefix sums of a source are taken in two steps (sums of hash buckets, then
  inside a bucket), so a source with a third of all rows is dealt over many tasks;
  buckets that rows of one id and size overfill are split further.
* A document on the cut is taken when at least half of it lies before the cut,
  which keeps each source within half a document of its target.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a null id takes part like any other; repeated rows are separate
documents; documents of size 0 take no words; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartlake.llm.common import col, fresh, text_or_empty
from chartlake.operators.ranges import ordered_index
from chartlake.session import cut_lineage

WORD = "[^\\x20\\x09-\\x0D]+"
#: Mean rows of a hash bucket; buckets grow in number with the table, not in size.
BUCKET_ROWS = 1024
#: Rows of a bucket beyond which it is split: rows of one id and size share a bucket.
HOT_ROWS = 16 * BUCKET_ROWS
ADDED = ("size", "source_size", "target", "taken", "copies", "finish")


def _before(df: DataFrame, order: list, values: dict[str, str]) -> DataFrame:
    """Running sums in a total order: each column of ``values`` gets, under its
    new name, the sum over the rows before.  Rows are range-partitioned and
    written once; the partitions' sums, a row each, shift the sums inside them."""
    at, pid, *offsets = fresh(df, "at", "pid", *[f"offset_{v}" for v in values])
    placed = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()))
    placed = placed.withColumn(pid, F.shiftright(at, 33))
    so_far = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    shift = placed.groupBy(pid).agg(*[F.sum(v).alias(o) for v, o in zip(values, offsets, strict=True)]) \
        .select(pid, *[F.coalesce(F.sum(o).over(so_far), F.lit(0)).alias(o) for o in offsets])
    inside = Window.partitionBy(pid).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return placed.join(F.broadcast(shift), pid) \
        .select(*df.columns, *[(F.col(o) + F.coalesce(F.sum(v).over(inside), F.lit(0))).alias(name) for (v, name), o in zip(values.items(), offsets, strict=True)])


def targets(sizes: DataFrame, cycle: tuple[int, ...] = (1, 2, 3), max_passes: int = 3,
            budget: int | None = None) -> DataFrame:
    """(source, source_size) -> + weight, target: the water level over the sources.

    In the order in which sources run dry, a row's level is the one that spends
    the budget if just the sources before it are dry; no such level is above the
    true one, and the true one is among them, so it is the largest.  Any number
    of sources: their order and sums are taken over range partitions."""
    indexed = ordered_index(sizes, [F.col("source").asc_nulls_last()], name="place")
    dry = indexed.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in cycle]), (F.col("place") % len(cycle)).cast("int"))) \
        .withColumn("cap", F.lit(float(max_passes)) * F.col("source_size")).drop("place")
    order = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    steps = _before(dry, order, {"cap": "cap_before", "weight": "weight_before"})
    whole = dry.agg(F.struct(F.sum("source_size").cast("double").alias("size"), F.sum("weight").alias("weight"))).scalar()
    total = F.lit(float(budget)) if budget is not None else whole["size"]
    level = (total - F.col("cap_before")) / (whole["weight"] - F.col("weight_before"))
    cut = steps.agg(F.max(level)).scalar()
    return steps.select("source", "source_size", "weight", F.least(cut * F.col("weight"), F.col("cap")).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        cycle: tuple[int, ...] = (1, 2, 3), max_passes: int = 3, budget: int | None = None,
        seed: str = "mix") -> DataFrame:
    """All rows of ``docs`` with the columns named in ``ADDED`` appended, each
    under a name that ``docs`` does not have (``fresh``), sorted globally by
    ``finish``: copies is how often the mix takes the document, taken = copies
    * size, finish the virtual time at which its last copy (or, if none is
    taken, its first) is through."""
    size, source_size, target, taken, copies, finish = fresh(docs, *ADDED)
    key, bucket, before, upto, weight, src, part, rows, sub, ahead, h1, h2, h3, h4, h5 = fresh(
        docs, "mix_key", "mix_bucket", "mix_before", "mix_upto", "mix_weight", "mix_src", "mix_part", "mix_rows", "mix_sub", "mix_ahead",
        "mix_h1", "mix_h2", "mix_h3", "mix_h4", "mix_h5")
    sized = docs.withColumn(size, F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long"))
    keyed = sized.withColumn(key, F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(col(id_col).cast("string"), F.lit("")),
                                                    col(size).cast("string"))))
    bits = max(0, math.ceil(math.log2(max(1, docs.count()) / BUCKET_ROWS)))
    dealt = keyed.withColumn(bucket, F.floor(F.conv(F.substring(col(key), 1, 8), 16, 10).cast("long") / F.lit(2 ** (32 - min(bits, 32)))))

    sums = cut_lineage(dealt.groupBy(col(source_col).alias("source"), col(bucket).alias("bucket")).agg(F.sum(col(size)).alias("n"), F.count(F.lit(1)).alias("rows")))
    per_source = targets(sums.groupBy("source").agg(F.sum("n").alias("source_size")), cycle, max_passes, budget)
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0))).alias("o") \
        .join(per_source.alias("s"), F.expr("o.source <=> s.source")) \
        .select(F.col("o.source").alias(src), F.col("o.bucket").alias(part), F.col("o.rows").alias(rows), F.col("o.before").alias(before),
                F.col("s.weight").alias(weight), F.col("s.source_size").alias(source_size), F.col("s.target").alias(target))
    inside = [col(src), col(part)]
    hot = sums.where(F.col("rows") > HOT_ROWS).select(F.col("source").alias(h1), F.col("bucket").alias(h2))
    if hot.limit(1).count():
        # rows that share id and size share the key: such a bucket is split by key and by the partition a row comes from
        dealt = cut_lineage(dealt.withColumn(sub, F.spark_partition_id()))
        in_hot = dealt.join(hot, col(source_col).eqNullSafe(col(h1)) & (col(bucket) == col(h2)), "left_semi")
        cells = in_hot.groupBy(col(source_col).alias(h1), col(bucket).alias(h2), col(key).alias(h3), col(id_col).alias(h4), col(sub).alias(h5)).agg(F.sum(col(size)).alias(ahead))
        ordered = Window.partitionBy(h1, h2).orderBy(h3, h4, h5).rowsBetween(Window.unboundedPreceding, -1)
        cells = cut_lineage(cells.withColumn(ahead, F.coalesce(F.sum(col(ahead)).over(ordered), F.lit(0))))
        dealt = dealt.join(cells, col(source_col).eqNullSafe(col(h1)) & (col(bucket) == col(h2)) & (col(key) == col(h3)) & col(id_col).eqNullSafe(col(h4))
                           & (col(sub) == col(h5)), "left")
        inside += [F.when(col(ahead).isNotNull(), F.struct(col(key), col(id_col), col(sub)))]
    else:
        dealt = dealt.withColumn(ahead, F.lit(0))
    upto_here = Window.partitionBy(*inside).orderBy(col(key), col(id_col)).rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.join(offsets, col(source_col).eqNullSafe(col(src)) & (col(bucket) == col(part))) \
        .withColumn(upto, col(before) + F.coalesce(col(ahead), F.lit(0)) + F.sum(col(size)).over(upto_here))
    # copy e of a document ends after e * source_size + upto words of its source
    count = sum((F.when(F.lit(2) * (F.lit(e) * col(source_size) + col(upto)) - col(size) <= F.lit(2.0) * col(target), 1).otherwise(0)
                 for e in range(max_passes)), F.lit(0))
    return placed.withColumn(copies, F.when(col(size) > 0, count).otherwise(F.lit(0))) \
        .withColumn(taken, col(copies) * col(size)) \
        .withColumn(finish, (F.greatest(col(copies) - 1, F.lit(0)) * col(source_size) + col(upto)) / col(weight)) \
        .select(*[col(c) for c in docs.columns], *[col(c) for c in (size, source_size, target, taken, copies, finish)]) \
        .orderBy(col(finish), col(id_col))
