"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds every run of words of the normalised test items.  A
document's words are streamed through it, which gives at each word the longest
run ending there that some item contains.  A run of ``window`` words marks the
words it covers; an item of fewer words is one window of its own, found as a
marked state on the suffix path of the current state.

The automaton is a broadcast of bounded size: the items are dealt into blocks
of at most ``BLOCK_WORDS`` words (an item larger than that comes in parts that
overlap by a window less a word), each block is one automaton and one pass over
the documents.  All passes but the last write only their hits, so a task holds
one automaton, however many there are, and no text is written.  A usual
benchmark is one block.

Words: A-Z lower-cased, then runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F].
Defined results: null and wordless texts have no words and are never hit; null
and wordless items have no window; items with equal ids count as one in the
list; repeated rows get the same result each; without items nothing is hit; an
empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.common import PIECE, col, content_key, fresh, lower_ascii, pieces, remove_folder, shared_folder, text_or_empty
from chartlake.session import cut_lineage

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Words of one automaton (about 100 MB in a Python worker at most).
BLOCK_WORDS = 200_000


def words(text: str) -> list[str]:
    return WORD.findall(lower_ascii(text))


def word_stream(text: str) -> Iterable[str]:
    """The words of a whole text, a piece at a time."""
    return words(text) if len(text) <= PIECE else (w for piece in pieces(text) for w in words(piece))


class Automaton:
    """Suffix automaton over words with, for each state, the items that end a window there."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window = window
        self.moves: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends = []
        for name, item in items:
            last, path = 0, []
            for w in item:
                last = self._extend(last, w)
                path.append(last)
            ends.append((name, len(item), path))
        self.items: dict[int, set[str]] = {}  # by the state that holds the window
        self.short: dict[int, int] = {}  # length of a short item, by its state
        for name, n, path in ends:
            if n >= window:
                for state in set(self._window_state(s) for s in path[window - 1:]):
                    self.items.setdefault(state, set()).add(name)
            elif n:
                state = path[-1]
                while self.length[self.link[state]] >= n:  # the state that holds the whole item
                    state = self.link[state]
                self.short[state] = n
                self.items.setdefault(state, set()).add(name)
        # states from which a short item is met on the suffix path, itself included
        self.near: dict[int, list[int]] = {}
        if self.short:
            for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
                own = [state] if state in self.short else []
                if met := own + self.near.get(self.link[state], []):
                    self.near[state] = met

    def _extend(self, last: int, w: str) -> int:
        moves, link, length = self.moves, self.link, self.length
        q = moves[last].get(w)
        if q is not None:  # another item went this way
            if length[q] == length[last] + 1:
                return q
            return self._split(last, w, q)
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and w not in moves[p]:
            moves[p][w] = new
            p = link[p]
        if p >= 0:
            q = moves[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: str, q: int) -> int:
        moves, link, length = self.moves, self.link, self.length
        twin = len(moves)
        moves.append(dict(moves[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = twin
        while p >= 0 and moves[p].get(w) == q:
            moves[p][w] = twin
            p = link[p]
        return twin

    def _window_state(self, state: int) -> int:
        """The state that holds the last ``window`` words of a longer run."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def scan(self, doc: Iterable[str]) -> tuple[int, list[list[int]], set[str]]:
        """The number of words, hit spans [first word, last word] in order, not
        overlapping, and the items met."""
        moves, link, length, window, near = self.moves, self.link, self.length, self.window, self.near
        spans: list[list[int]] = []
        met: set[str] = set()
        root = moves[0]
        state, n, i = 0, 0, -1
        for i, w in enumerate(doc):
            to = moves[state].get(w)
            if to is None:
                if state:
                    state = link[state]
                    while state >= 0 and w not in moves[state]:
                        state = link[state]
                    if state < 0:
                        state, n = 0, 0
                        continue
                    n = length[state] + 1
                    state = moves[state][w]
                elif w in root:
                    state, n = root[w], 1
                else:
                    continue
            else:
                state = to
                n += 1
            hit = 0
            if n >= window:
                hit = window
                met |= self.items[self._window_state(state)]
            elif near and state in near:
                for s in near[state]:
                    if self.short[s] <= n:
                        hit = max(hit, self.short[s])
                        met |= self.items[s]
            if n >= window and near and state in near:
                for s in near[state]:
                    met |= self.items[s]
            if hit:
                first = i - hit + 1
                if spans and first <= spans[-1][1] + 1:
                    spans[-1][1] = i
                    spans[-1][0] = min(spans[-1][0], first)
                    while len(spans) > 1 and spans[-2][1] + 1 >= spans[-1][0]:
                        a, b = spans[-2]
                        spans.pop()
                        spans[-1] = [min(a, first), max(b, i)]
                else:
                    spans.append([first, i])
        return i + 1, spans, met


def _merge(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_KEYED = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])
_HITS = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.string()))])


def _item_parts(text: str, size: int, window: int) -> Iterator[list[str]]:
    """The words of an item, in parts of at most ``size`` that overlap by
    ``window`` - 1 words, so that every window lies in one of them."""
    held: list[str] = []
    fresh_words = 0
    for w in word_stream(text):
        held.append(w)
        fresh_words += 1
        if len(held) == size:
            yield held
            held, fresh_words = held[size - window + 1:], 0
    if fresh_words:
        yield held


def _blocks(items: DataFrame, item_col: str, text_col: str, block_words: int, window: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Lists of (item id, words), each within the bound; an item that has no word
    is left out, one with more words than the bound comes in parts.

    Items are numbered by running word counts per hash group; only one block's
    items are on the driver at a time."""
    block_words = max(block_words, window)
    size = F.size(F.split(text_or_empty(text_col), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))  # at least the words
    total = items.agg(F.sum(size.cast("long"))).first()[0] or 0
    n = 1
    while total / n > block_words / 2 and n < total:  # mean fill of one half leaves room for uneven hashing
        n *= 2
    for b in range(n):
        part = items.where(F.pmod(F.xxhash64(col(item_col), col(text_col)), F.lit(n)) == b)
        held, count = [], 0
        for name, text in part.select(col(item_col).cast("string"), text_or_empty(text_col)).toLocalIterator():
            for w in _item_parts(text, block_words, window):
                if held and count + len(w) > block_words:
                    yield held
                    held, count = [], 0
                held.append((name or "", w))
                count += len(w)
        if held:
            yield held


#: What the blocks before found in a text.
FOUND = "array<struct<spans array<array<long>>, items array<string>>>"


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
              item_text_col: str = "text", window: int = 10, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with one struct column appended, and that column's name:
    n_words, spans (first and last hit word of each run), items (met, sorted).

    Every block of items is a pass over the documents; all but the last write
    only what they hit, by 128 bits of the text, which meets the documents
    once, before the last pass."""
    spark = docs.sparkSession
    hits, before, t1, t2, f1, f2 = fresh(docs, "hits", "hits_before", "text_h1", "text_h2", "found_h1", "found_h2")
    at = docs.columns.index(text_col)
    blocks = _blocks(items, item_col, item_text_col, block_words, window)
    block, folders = next(blocks, []), []
    for following in blocks:
        folders.append(_hits_only(docs, text_col, block, window))
        block = following
    rows = docs.withColumn(before, F.lit(None).cast(FOUND))
    if folders:
        k1, k2 = content_key(text_or_empty(text_col))
        found = cut_lineage(spark.read.parquet(*folders).groupBy("k1", "k2").agg(F.collect_set(F.struct("spans", "items")).alias(before))).toDF(f1, f2, before)
        for folder in folders:
            remove_folder(spark, folder)
        rows = docs.withColumn(t1, k1).withColumn(t2, k2).join(found, (col(t1) == col(f1)) & (col(t2) == col(f2)), "left") \
            .select(*[col(c) for c in docs.columns], col(before))
    shared = spark.sparkContext.broadcast(pickle.dumps(Automaton(block, window), protocol=5))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = pickle.loads(shared.value)
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                out = []
                for text, old in zip(batch.column(at), batch.column(batch.num_columns - 1), strict=True):
                    n_words, spans, met = automaton.scan(word_stream(text.as_py() or ""))
                    for x in old.as_py() or []:
                        spans += x["spans"]
                        met |= set(x["items"])
                    out.append({"n_words": n_words, "spans": _merge(spans), "items": sorted(met)})
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, _HITS)], names=[*batch.schema.names[:-1], hits])

    return rows.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(hits, HITS)])), hits


def _hits_only(docs: DataFrame, text_col: str, block: list, window: int) -> str:
    """A folder with (k1, k2, spans, items) of the texts that the block's items hit."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pickle.dumps(Automaton(block, window), protocol=5))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = pickle.loads(shared.value)
        for batch in batches:
            out = []
            for k1, k2, text in zip(*batch.columns, strict=True):
                _, spans, met = automaton.scan(word_stream(text.as_py()))
                if spans:
                    out.append({"k1": k1.as_py(), "k2": k2.as_py(), "spans": _merge(spans), "items": sorted(met)})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_KEYED)

    folder = shared_folder(spark, "hits")
    k1, k2 = content_key(text_or_empty(text_col))
    docs.select(k1.alias("k1"), k2.alias("k2"), text_or_empty(text_col).alias("text")) \
        .mapInArrow(scan, "k1 long, k2 long, spans array<array<long>>, items array<string>").write.parquet(folder)
    shared.destroy()
    return folder


def hit_counts(hits: str):
    """(words hit, items met, coverage) as columns of the struct that ``find_hits`` adds."""
    h = col(hits)
    n_hit = F.aggregate(h["spans"], F.lit(0).cast("long"), lambda s, x: s + x[1] - x[0] + 1)
    n_words = h["n_words"]
    return n_hit, F.size(h["items"]).cast("long"), F.when(n_words > 0, n_hit / n_words).otherwise(F.lit(0.0))


def without(text: str, runs: list[list[int]]) -> str:
    """A text without the runs of words [first, last], from the start of the first to the end of the last."""
    found = enumerate(WORD.finditer(lower_ascii(text)))
    kept, start = [], 0
    for first, last in runs:
        for i, word in found:
            if i == first:
                kept.append(text[start:word.start()])
            if i == last:
                start = word.end()
                break
    return "".join([*kept, text[start:]])


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, max_coverage: float = 0.5,
                  chars_col: str | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with every hit run cut out of its text (from its first to its
    last word); rows of which more than ``max_coverage`` of the words are hit
    go.  Other columns stay as they are, but for ``chars_col``, which is set
    anew for texts that were cut."""
    found, hits = find_hits(docs, items, text_col, item_col, item_text_col, window, block_words)
    n_hit, _, coverage = hit_counts(hits)
    left = found.where((n_hit == 0) | (coverage <= max_coverage))
    at = docs.columns.index(text_col)
    schema = left.schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1).field("spans").to_pylist()
            if not any(spans):
                yield batch
                continue
            texts = []
            for text, runs in zip(batch.column(at).to_pylist(), spans, strict=True):
                texts.append(without(text, runs) if runs else text)
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    done = left.mapInArrow(cut, schema)
    if chars_col:
        done = done.withColumn(chars_col, F.when(F.size(col(hits)["spans"]) > 0, F.length(col(text_col)).cast(docs.schema[chars_col].dataType))
                               .otherwise(col(chars_col)))
    return done.select(*[col(c) for c in docs.columns])
