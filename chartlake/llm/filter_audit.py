"""Filter interaction audit: what each filter removes in every order of filters.

A filter order is a path through the lattice of filter subsets, from the empty
set to all filters; its step applying filter f in state S is the edge S -> S + f.
Documents are first reduced to counts per (part, set of failed filters, flags),
so the lattice is walked over counts, not rows:

* forward and backward path counting gives the number of orders that reach each
  state and that leave it for the full set;
* an edge removes the documents that fail f and no filter of S.  Summed over all
  orders, a filter's removals (n! times its Shapley value) are the removals of
  its edges, each weighted by the orders reaching S times those leaving S + f;
* the report of an order reads its steps from the same edges.

Failure conditions (words are maximal runs of [^\\x20\\x09-\\x0D]): A under 100
words; B fewer than 80 distinct words per 100; C over 10 upper-case A-Z per 100
code points; D any of #$%&*|; E a smaller id has the same text, table-wide.

Defined results: null texts are empty; null parts count as the empty string; a
null id never fails E and makes no other row fail it, and has no labels; rows
that share an id are separate rows, equal texts among them fail E only against
a smaller id; an id with several label rows is good (toxic) if one of them says
so; an empty table gives no rows.  A text is held by one task, in pieces but for
its set of distinct words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.common import UPPER, col, pieces, text_or_empty
from chartlake.session import cut_lineage

#: All orders of the filters are reported, so their number is kept small (5,040 orders).
MAX_FILTERS = 7
_MARKS = re.compile(rb"[#$%&*|]")


def _text_fails(text: str) -> int:
    """Bits 0 to 3: the text fails A, B, C, D."""
    data = text.encode("utf-8", "surrogatepass")
    n, distinct = 0, set()
    for piece in pieces(data):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    upper = len(data) - len(data.translate(None, UPPER.encode()))
    return (n < 100) + 2 * (100 * len(distinct) < 80 * n) + 4 * (100 * upper > 10 * len(text)) + 8 * (_MARKS.search(data) is not None)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, part, digest, text) -> (id, part, digest, fails)"""
    for batch in batches:
        fails = pa.array((_text_fails(x.as_py()) for x in batch.column(3)), pa.int32(), size=batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], fails], names=["id", "part", "digest", "fails"])


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(id, part, fails) of every row: bit i of fails is set if filter i of ABCDE fails."""
    text = text_or_empty(text_col)
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"))
    schema = T.StructType([*rows.schema.fields[:3], T.StructField("fails", T.IntegerType())])
    judged = cut_lineage(rows.mapInArrow(_judged, schema))
    # written, so that the rows of a text with very many copies can be split in the join
    first = cut_lineage(judged.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return judged.join(first, "digest", "left").select("id", "part", (F.col("fails") + F.when(later, 16).otherwise(0)).alias("fails"))


def with_flags(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``failed`` with good and toxic (0 or 1) from the labels of its id."""
    flag = lambda name: F.max(F.when(col(name) == 1, 1).otherwise(0)).alias(name)
    known = cut_lineage(labels.select(col(id_col).alias("id"), "quality", "toxic").where("id is not null").groupBy("id").agg(flag("quality"), flag("toxic")))
    zero = F.lit(0)
    return failed.join(known, "id", "left").select("part", "fails", F.coalesce("quality", zero).alias("good"), F.coalesce("toxic", zero).alias("toxic"))


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """(orders reaching, orders leaving) every subset of ``n`` filters, subsets as bit sets."""
    full = (1 << n) - 1
    reach, leave = [1] + [0] * full, [0] * full + [1]
    for state in range(full + 1):  # every subset comes after those it contains
        for f in range(n):
            if not state >> f & 1:
                reach[state | 1 << f] += reach[state]
    for state in range(full, -1, -1):
        for f in range(n):
            if state >> f & 1:
                leave[state ^ 1 << f] += leave[state]
    return reach, leave


def audit(counted: DataFrame, filters: Sequence[str] = "ABCDE", flags: Sequence[tuple[str, str]] = (("good", "good_lost"), ("toxic", "toxic_lost"))) -> DataFrame:
    """The report: a row per part, order of ``filters`` and step.

    counted: (part, fails, a 0/1 column per flag), a row per document.  Work after
    the first aggregation depends on parts and filters only."""
    k = len(filters)
    if k > MAX_FILTERS:
        raise ValueError(f"at most {MAX_FILTERS} filters: all their orders are reported")
    spark = counted.sparkSession
    reach, leave = path_counts(k)
    edges = [(s, 1 << f, reach[s] * leave[s | 1 << f]) for s in range(1 << k) for f in range(k) if not s >> f & 1]
    steps = [(sum(1 << filters.index(x) for x in order[:i]), 1 << filters.index(letter), "".join(order), i + 1)
             for order in permutations(filters) for i, letter in enumerate(order)]

    counts = counted.groupBy("part", "fails", *[f for f, _ in flags]).agg(F.count(F.lit(1)).alias("n"))
    # every count meets every edge of the lattice, a list of k * 2^(k-1) entries
    lattice = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("paths")) for s, f, w in edges])
    met = counts.select("*", F.inline(lattice))
    fails, state, own, n = F.col("fails"), F.col("state"), F.col("filter"), F.col("n")
    hits = fails.bitwiseAND(own) != 0
    here = hits & (fails.bitwiseAND(state) == 0)

    def total(condition, of=n):
        return F.sum(F.when(condition, of).otherwise(0))

    edge = met.groupBy("part", "state", "filter", "paths").agg(
        total(fails.bitwiseAND(state.bitwiseOR(own)) == 0).alias("kept"), total(here).alias("removed"), total(hits & ~here).alias("redundant"),
        total(fails == own).alias("unique_fails"), *[total(here, n * F.col(f)).alias(name) for f, name in flags])
    shapley = edge.groupBy(F.col("part").alias("of_part"), F.col("filter").alias("of_filter")).agg(F.sum(F.col("paths") * F.col("removed")).alias("shapley"))
    paths = F.broadcast(spark.createDataFrame(steps, "at_state int, by_filter int, filter_order string, step int"))  # k * k! rows
    report = edge.join(shapley, (F.col("part") == F.col("of_part")) & (F.col("filter") == F.col("of_filter"))) \
        .join(paths, (F.col("state") == F.col("at_state")) & (F.col("filter") == F.col("by_filter")))
    return report.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *[name for _, name in flags], "shapley")
