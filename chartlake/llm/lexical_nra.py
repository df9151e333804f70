"""Ranked lexical search: NRA over impact-sorted lists.

Each task reads its documents' terms and makes inverted lists of them, a shard
of bounded size at a time; a list holds (document, impact) by falling impact.
For every query the lists of its terms are read sequentially, block by block and
all to the same depth.  What has been read of a document is the lower end of its
score; the upper end adds, for every list it was not met in, the last impact
read there.  New documents may enter until the last impacts together are below
the k-th best lower end; documents whose upper end is below it go.  Reading
ends when every document left has one possible score, so membership, ties and
scores are final.  The k best of the shards met so far set the bar for the next
ones; the k best of all tasks are ranked at the end.

Score: sum over the query's terms, repeats included, of w * ((10^9 * tf) div
(1000 * tf + 8 * m)), with w = floor(1000 ln((2N + 2) / (2 df + 1))), m = 25 +
((75 * n * N) div L); N documents with a term, L all their terms, n the terms of
the document, df the documents that hold the term, tf its occurrences there.
Terms are maximal runs of digits, ASCII letters and characters from U+0080 on,
A-Z lower-cased.

Bounds: queries are taken in blocks of at most ``BLOCK_TERMS`` distinct terms
(a larger single query is a block of its own: the distinct words of one text),
each block a pass over the documents; its terms are broadcast.  A task holds
one shard: at most ``SHARD`` documents and ``POSTINGS`` postings (one document more), and
fewer documents where queries have very many terms.

Defined results: null and empty texts have no terms and are never found or
counted; rows of one query id are one query with all their terms; a null id is
an id like others, ranked last among equal scores; rows that share a document
id are separate documents; ties go by id; scores of 0 are left out; a query
without terms and an empty table give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from chartlake.llm.common import col, pieces, remove_folder, shared_folder
from chartlake.session import cut_lineage

BLOCK_TERMS = 200_000
SHARD = 8192
POSTINGS = 2_000_000
#: Entries of the table (terms of a query) x (documents of a shard).
CELLS = 1 << 26
#: Entries of each list read in the first round; each round reads four times as many as the one before.
FIRST = 64

#: ASCII characters of terms, A-Z lower-cased; all others become blanks.
_TERM_BYTES = bytes((c + 32 if 65 <= c <= 90 else c) if 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_counts(text: str | None) -> Counter:
    """Terms of a whole text with their occurrences."""
    found: Counter = Counter()
    for piece in pieces((text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES)):
        found.update(piece.split())
    return found


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (id, term, n), a row per distinct term of a text"""
    for batch in batches:
        for i in range(batch.num_rows):
            found = term_counts(batch.column(1)[i].as_py())
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[i].as_py()] * len(found), batch.column(0).type), pa.array(list(found), pa.binary()),
                                                  pa.array(list(found.values()), pa.int64())], names=["id", "term", "n"])


def _doc_terms(vocabulary):
    """(id, text) -> (id, n, terms, tfs): terms of the vocabulary, by number"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = vocabulary.value
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column(1):
                found = term_counts(text.as_py())
                own = {known[t]: n for t, n in found.items() if t in known}
                sizes.append(found.total())
                terms.append(list(own))
                tfs.append(list(own.values()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                                             names=["id", "n", "terms", "tfs"])
    return run


class Shard:
    """Impact-sorted lists of some documents: postings are parallel arrays of (term, document, impact)."""

    def __init__(self, size: int, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray):
        order = np.lexsort((-impacts, terms))
        self.size, self.docs, self.impacts = size, docs[order], impacts[order]
        found, starts = np.unique(terms[order], return_index=True)
        self.lists = dict(zip(found.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True), strict=True))

    def search(self, query: list[tuple[int, int]], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, final scores) of all documents that reach both ``least``
        and the k-th best score; query: (term, weight) with weights above 0."""
        held = [(self.lists[t], w) for t, w in query if t in self.lists]
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = [(self.docs[a:b], self.impacts[a:b] * w) for (a, b), w in held]
        lower = np.zeros(self.size, np.int64)
        seen = np.zeros((len(lists), self.size), bool)
        last = np.array([x[0] for _, x in lists], np.int64)
        left, at, depth = None, 0, FIRST
        while True:
            for j, (docs, impacts) in enumerate(lists):
                if at < len(docs):
                    read = docs[at:at + depth]
                    lower[read] += impacts[at:at + depth]
                    seen[j, read] = True
                    last[j] = impacts[at + depth - 1] if at + depth < len(docs) else 0
            at, depth = at + depth, depth * 4
            met = np.flatnonzero(lower) if left is None else left
            bar = least
            if len(met) >= k:
                bar = max(bar, int(np.partition(lower[met], len(met) - k)[len(met) - k]))
            if left is None and last.sum() >= bar:
                continue  # a document not met so far may still get in
            upper = lower[met] + last @ ~seen[:, met]
            stay = upper >= bar
            left = met[stay]
            if (upper[stay] == lower[left]).all():
                return left, lower[left]


def _search(queries, sums: tuple[int, int], k: int, shard: int, id_type: pa.DataType, query_type: pa.DataType):
    """(id, n, terms, tfs) -> (query, id, score): the k best of the task's documents for every query"""
    n_docs, n_terms = sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, asked = queries.value
        best: list[list[tuple]] = [[] for _ in names]  # (-score, null id, id)

        def look_up(ids: list, sizes: list[int], terms: list[np.ndarray], tfs: list[np.ndarray]) -> None:
            counts = [len(x) for x in terms]
            m = np.array([25 + 75 * n * n_docs // n_terms for n in sizes], np.int64)
            docs = np.repeat(np.arange(len(ids)), counts)
            tf = np.concatenate(tfs)
            made = Shard(len(ids), np.concatenate(terms), docs, 1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
            for q, (query, top) in enumerate(zip(asked, best, strict=True)):
                least = -top[-1][0] if len(top) == k else 1
                found, scores = made.search(query, k, max(1, least))
                if len(found):
                    new = [(-s, ids[d] is None, ids[d]) for d, s in zip(found.tolist(), scores.tolist(), strict=True)]
                    best[q] = sorted(top + new, key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))[:k]

        ids, sizes, terms, tfs, held = [], [], [], [], 0
        for batch in batches:
            own = batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                if len(own[0][i]):
                    ids.append(batch.column(0)[i].as_py())
                    sizes.append(batch.column(1)[i].as_py())
                    terms.append(own[0][i].values.to_numpy())
                    tfs.append(own[1][i].values.to_numpy())
                    held += len(terms[-1])
                    if len(ids) >= shard or held >= POSTINGS:
                        look_up(ids, sizes, terms, tfs)
                        ids, sizes, terms, tfs, held = [], [], [], [], 0
        if ids:
            look_up(ids, sizes, terms, tfs)
        rows = [(names[q], x[2], -x[0]) for q, top in enumerate(best) for x in top]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (query_type, id_type, pa.int64()), strict=True)], names=["query", "id", "score"])

    return run


def _blocks(queries: DataFrame, block_terms: int) -> Iterator[list[tuple]]:
    """Lists of (query id, {term: occurrences}) with at most ``block_terms`` distinct terms together."""
    block, held = [], set()
    for row in queries.toLocalIterator():
        own = {bytes(x["term"]): x["n"] for x in row["terms"]}
        if block and len(held | own.keys()) > block_terms:
            yield block
            block, held = [], set()
        block.append((row["id"], own))
        held |= own.keys()
    if block:
        yield block


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", query_id_col: str = "item_id",
           query_text_col: str = "text", block_terms: int = BLOCK_TERMS, shard: int = SHARD) -> DataFrame:
    """(query id, rank, id, score) under the names of ``query_id_col`` and ``id_col``."""
    spark = docs.sparkSession
    id_field, query_field = docs.schema[id_col], queries.schema[query_id_col]
    asked = queries.select(col(query_id_col).alias("id"), col(query_text_col).cast("string").alias("text")) \
        .mapInArrow(_query_terms, T.StructType([T.StructField("id", query_field.dataType), T.StructField("term", T.BinaryType()), T.StructField("n", T.LongType())])) \
        .groupBy("id", "term").agg(F.sum("n").alias("n")).groupBy("id").agg(F.collect_list(F.struct("term", "n")).alias("terms"))
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    held = T.StructType([T.StructField("id", id_field.dataType), *T.StructType.fromDDL("n long, terms array<int>, tfs array<long>").fields])
    result = T.StructType([T.StructField("query", query_field.dataType), T.StructField("id", id_field.dataType), T.StructField("score", T.LongType())])
    found = spark.createDataFrame([], result)
    for block in _blocks(asked, block_terms):
        numbers = {t: i for i, t in enumerate(dict.fromkeys(t for _, own in block for t in own))}
        vocabulary = spark.sparkContext.broadcast(numbers)
        folder = shared_folder(spark, "terms")
        texts.mapInArrow(_doc_terms(vocabulary), held).write.parquet(folder)
        rows = spark.read.schema(held).parquet(folder)
        n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if n_docs:
            df = {r["term"]: r["n"] for r in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per term of the block
            weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
            weighted = [[(numbers[t], n * weight[numbers[t]]) for t, n in own.items() if weight.get(numbers[t], 0) > 0] for _, own in block]
            shared = spark.sparkContext.broadcast(([q for q, _ in block], weighted))
            size = max(64, min(shard, CELLS // max(1, max(map(len, weighted)))))
            run = _search(shared, (n_docs, n_terms), k, min(size, shard), to_arrow_type(id_field.dataType), to_arrow_type(query_field.dataType))
            found = found.unionByName(cut_lineage(rows.mapInArrow(run, result)))
        remove_folder(spark, folder)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k) \
        .select(F.col("query").alias(query_id_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
