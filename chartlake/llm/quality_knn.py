"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms are the shapes of a text, not its topics: trigrams of character classes
over the whole text, and bins of a few ratios (words that repeat the word
before, distinct words, digits, upper case, line and word lengths).  Weighted by
square root of frequency and inverse document frequency, the labelled rows give
a latent-semantic space by singular value decomposition; its labelled vectors
are broadcast and every document gets exact cosines with all of them, in
blocks of a matrix product.  The ``neighbours`` nearest vote with their
similarity.

The fit is bounded: at most ``MAX_LABELLED`` labelled rows (those with the
smallest hash of their id, so the choice does not depend on order; of the rows
that share an id the one with the smallest text), each a vector of ``DIM`` numbers, whatever the size of the corpus.

Labels, language, source and id are never inputs of a score.  Defined results:
null and empty texts have the one term "empty" and are scored like others;
without labelled rows every score is 0.5; with one class only it is that class
(a smoothed vote); null labels are ignored; repeated rows score alike; an empty
table gives no rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm import common
from chartlake.llm.common import col, fresh, pieces

MAX_LABELLED = 2048
DIM = 64
NEIGHBOURS = 15
#: Weight of the prior in a vote, in neighbours of similarity 1.
SMOOTHING = 0.25
#: Documents of one matrix product.
BLOCK = 1024

CLASSES = np.zeros(256, np.uint16)
for _k, _chars in enumerate(("", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t\r\x0b\x0c", "\n", ".,;", "!?",
                             "|", "-_=+", "\"'()[]{}", "#", "$%", "&", "*~^", "/\\:@<>")):
    CLASSES[list(_chars.encode())] = _k
CLASSES[128:] = 2
SHAPES = 16 ** 3
BINS = 16
RATIOS = 7
TERMS = SHAPES + BINS * RATIOS + 1
#: Distinct words at which a text counts as fully varied.
FULL = 2000


def _bin(x: float) -> int:
    """Sixteen steps from 0 to 1, finer towards 0."""
    return min(BINS - 1, int(BINS * max(0.0, min(1.0, x)) ** 0.5))


def terms(text: str) -> np.ndarray:
    """Square roots of term frequencies of a whole text."""
    out = np.zeros(TERMS, np.float32)
    data = text.encode("utf-8", "surrogatepass")
    n, repeated, distinct, last = 0, 0, set(), None
    for piece in pieces(data):
        words = piece.split()
        if words:
            n += len(words)
            repeated += sum(map(eq, words, words[1:])) + (words[0] == last)
            if len(distinct) < FULL:  # the ratio is at its end from there on
                distinct.update(words)
            last = words[-1]
    if not n:
        out[-1] = 1
        return out
    counts, shapes = np.zeros(16, np.int64), np.zeros(SHAPES, np.int64)
    for i in range(0, len(data), common.PIECE):
        c = CLASSES[np.frombuffer(data, np.uint8, min(common.PIECE + 2, len(data) - i), i)]
        counts += np.bincount(c[:common.PIECE], minlength=16)
        if len(c) >= 3:
            shapes += np.bincount((c[:-2] << 8) + (c[1:-1] << 4) + c[2:], minlength=SHAPES)
    if len(data) >= 3:
        out[:SHAPES] = np.sqrt(shapes / (len(data) - 2))
    letters = max(1, counts[1] + counts[2])
    ratios = (
        repeated / max(1, n - 1),
        len(distinct) / min(n, FULL),
        counts[3] / len(data),
        counts[1] / letters,
        min(1.0, len(data) / n / 32),
        min(1.0, (counts[5] + 1) / n),
        counts[7:].sum() / len(data),
    )
    for i, x in enumerate(ratios):
        out[SHAPES + i * BINS + _bin(x)] = 0.5
    return out


class Space:
    """The fitted model: idf, projection, labelled vectors and labels; ``rows`` is overwritten."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, dim: int, neighbours: int):
        self.neighbours = neighbours
        self.labels = labels.astype(np.float32)
        self.prior = float(labels.mean()) if len(labels) else 0.5
        if not len(rows):
            return
        df = (rows > 0).sum(0)
        self.idf = (np.log((1 + len(rows)) / (1 + df)) + 0.1).astype(np.float32)
        self.idf[df == 0] = 0
        weighted = rows  # the caller's matrix is used up, so that the driver holds it once
        weighted *= self.idf
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-12)
        # right singular vectors through the Gram matrix of the rows
        values, vectors = np.linalg.eigh((weighted @ weighted.T).astype(np.float64))
        best = np.argsort(values)[::-1][:dim]
        best = best[values[best] > 1e-9]
        self.projection = ((weighted.T @ vectors[:, best].astype(np.float32)) / np.sqrt(values[best]).astype(np.float32)).astype(np.float32)
        self.vectors = self._unit(weighted @ self.projection)

    def _weighted(self, rows: np.ndarray) -> np.ndarray:
        return self._unit(rows * self.idf)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Similarity-weighted votes of the nearest labelled vectors."""
        if not len(self.labels):
            return np.full(len(rows), 0.5)
        cosine = self._unit(self._weighted(rows) @ self.projection) @ self.vectors.T
        k = min(self.neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** 8
        votes = (weight * self.labels[near]).sum(1) + SMOOTHING * self.prior
        return votes / (weight.sum(1) + SMOOTHING)


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_labelled: int = MAX_LABELLED, dim: int = DIM, neighbours: int = NEIGHBOURS) -> Space:
    """labelled: (id_col, label_col).  Terms are counted on the executors; the
    driver gets at most ``max_labelled`` sparse rows of them."""
    label, own = F.col("label"), F.col("id")
    known = labelled.select(col(id_col).alias("id"), (col(label_col) > 0).cast("int").alias("label")).where(label.isNotNull() & own.isNotNull())
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    order = F.xxhash64(F.lit("fit"), own)
    chosen = known.orderBy(order, own).limit(max_labelled)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = [], []
            for text in batch.column(0):
                x = terms(text.as_py() or "")
                held = np.flatnonzero(x)
                at.append(held.astype(np.int16).tobytes())
                values.append(x[held].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.binary()), pa.array(values, pa.binary()), batch.column(1), batch.column(2)],
                                             names=["at", "x", "label", "id"])

    # rows that share an id count once, by their smallest text
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).join(chosen, "id") \
        .groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label")) \
        .select("text", "label", col("id").cast("string").alias("id")).mapInArrow(sparse, "at binary, x binary, label int, id string").collect()
    rows.sort(key=lambda r: (r["id"], r["at"], r["x"]))
    matrix = np.zeros((len(rows), TERMS), np.float32)
    for i, r in enumerate(rows):
        matrix[i, np.frombuffer(r["at"], np.int16)] = np.frombuffer(r["x"], np.float16)
    return Space(matrix, np.array([r["label"] for r in rows], np.float32), dim, neighbours)


def score(docs: DataFrame, space: Space, text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a score between 0 and 1 appended, and that column's name."""
    (name,) = fresh(docs, "score")
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(space, protocol=5))
    at = docs.columns.index(text_col)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Space = pickle.loads(shared.value)
        for whole in batches:
            for i in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(i, BLOCK)
                rows = np.stack([terms(x.as_py() or "") for x in batch.column(at)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(rows).astype(np.float64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(vote, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])), name


def held_out(id_column: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def keep_good(docs: DataFrame, labelled: DataFrame, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality", **fit_args) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, columns unchanged."""
    space = fit(docs, labelled.where(~held_out(col(id_col))), id_col, text_col, label_col, **fit_args)
    scored, name = score(docs, space, text_col)
    return scored.where(col(name) >= threshold).select(*[col(c) for c in docs.columns])
