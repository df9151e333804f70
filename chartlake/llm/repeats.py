"""Removal of repeated byte strings by bucket-pointer refinement.

Every byte covered by a ``length``-byte string that also starts anywhere else
(same document included) goes.  Texts are UTF-8 bytes; matches never cross
documents and are judged on the input.

* The initial buckets are those of q-grams (q = length / 4), by 64-bit names: the
  name of a string is made from the names of its parts.
* Of all q-grams a document keeps the smallest name of every window of
  ``length`` bytes (about one position in 150).  Equal strings keep equal names,
  so a string can repeat only if such a bucket holds two positions.  Buckets of
  one position end here, after a shuffle of one name and position per 150 bytes.
* The positions left bring their surroundings (every ``length``-byte string that
  contains the q-gram) to their bucket's task.  There the q-gram buckets of all
  their positions are refined by sorting on the bucket at the later offset, to 2q
  and then 4q bytes; each round uses the buckets that the round before has
  refined, and a string whose later part shares no bucket any more is done with.
  Strings that still share a bucket are compared byte by byte, so equal names
  of different strings remove nothing.  Equal surroundings count as one with a weight.
* A bucket of more than ``HOT`` positions is refined by Spark instead: one row
  per string, combined on the map side by 128 bits of names and joined back.

A text that occurs as a whole in several rows takes part once; its copies are
covered as a whole if they have ``length`` bytes.

Defined results: null is empty; texts shorter than ``length`` bytes neither lose
nor cover anything; repeated rows are copies; ids are never looked at; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.common import col, content_key, fresh, remove_folder, shared_folder, text_or_empty
from chartlake.session import cut_lineage

LENGTH = 400
#: Positions of a bucket that one task refines (700 bytes each).
HOT = 16_384
#: Bytes of surroundings refined together.
BATCH_BYTES = 4 << 20
#: Bytes of a text handled at a time when initial buckets are made.
SEGMENT = 1 << 20
ALL = (1 << 31) - 1

_rng = [np.random.Generator(np.random.PCG64(s)) for s in (400, 401)]
#: Two independent sets of names: positions of hot buckets are compared by both.
BYTE_NAMES = [r.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for r in _rng]
STEP = [r.integers(0, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for r in _rng]
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _refine(names: np.ndarray, offset: int, step: int, seed: int) -> np.ndarray:
    """Names of the strings that end ``offset`` bytes later: pairs of names, named again."""
    out = names[:-offset] * STEP[seed][step]
    out += names[offset:]
    out ^= out >> np.uint64(29)
    return out


def gram_names(data: np.ndarray, quarter: int = 25, seed: int = 0) -> np.ndarray:
    """Names of all (4 * quarter)-byte strings."""
    names, size, step = BYTE_NAMES[seed][data], 1, 0
    while size * 2 <= quarter:
        names = _refine(names, size, step, seed)
        size, step = size * 2, step + 1
    if size < quarter:
        names = _refine(names, quarter - size, step, seed)
    for k, offset in ((8, quarter), (9, 2 * quarter)):
        names = _refine(names, offset, k, seed)
    return names


def string_names(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Names of all ``length``-byte strings, refined from the q-gram names by those at later offsets."""
    q = length // 4
    half = _refine(gram_names(data, q // 4, seed), q, 10, seed)
    return _refine(half, 2 * q, 11, seed)


def _sliding(x: np.ndarray, width: int, pick, fill) -> np.ndarray:
    """pick (minimum or maximum) over each run of ``width`` values."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, fill, x.dtype)
    padded[:len(x)] = x
    rows = padded.reshape(blocks, width)
    ahead = pick.accumulate(rows, axis=1).ravel()
    back = pick.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, names, weights): at least one position in each window of
    ``length`` bytes whose q-gram has the window's smallest name.  Weight 2 marks
    names that were the smallest at several positions of this text."""
    q = length // 4
    width = length - q + 1
    found: dict[int, tuple[int, int]] = {}
    for start in range(0, max(1, len(data) - length + 1), SEGMENT):
        part = data[start:start + SEGMENT + length - 1]
        if len(part) < length:
            break
        names = gram_names(part, q // 4)
        names ^= names >> np.uint64(32)
        names *= STEP[0][12]
        names ^= names >> np.uint64(31)
        low = _sliding(names, width, np.minimum, TOP)
        edge = np.zeros(width - 1, np.uint64)
        at = np.flatnonzero(names == _sliding(np.concatenate([edge, low, edge]), width, np.maximum, 0))
        own = names[at]
        order = np.argsort(own, kind="stable")
        cuts = np.flatnonzero(np.diff(own[order])) + 1
        for a, b in zip([0, *cuts], [*cuts, len(order)], strict=True):
            places = at[order[a:b]]
            chosen, weight = places[:1].tolist(), 1 if b - a == 1 else 2
            k = 0
            while k < b - a - 1:  # the last one within reach, else the next one
                k = max(k + 1, int(np.searchsorted(places, places[k] + width, "right")) - 1)
                chosen.append(int(places[k]))
            name = int(own[order[a]])
            for p in chosen:
                old = found.get(start + p)
                found[start + p] = (name, max(weight, old[1] if old else 0))
    places = np.array(sorted(found), np.int64)
    return places, np.array([found[p][0] for p in places.tolist()], np.uint64), np.array([found[p][1] for p in places.tolist()], np.int32)


# ---------------------------------------------------------------- tasks


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _initial(length: int):
    """(text, t1, t2) -> (t1, t2, pos, h, w, first)"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                counts, pos, names, weights = np.zeros(batch.num_rows, np.int64), [], [], []
                for k, text in enumerate(batch.column(0)):
                    data = _bytes(text.as_py())
                    if len(data) >= length:
                        p, h, w = anchors(np.frombuffer(data, np.uint8), length)
                        counts[k] = len(p)
                        pos.append(p)
                        names.append(h)
                        weights.append(w)
                if not pos:
                    continue
                p = np.concatenate(pos)
                first = np.zeros(len(p), bool)
                first[np.cumsum(counts[counts > 0]) - counts[counts > 0]] = True
                keys = [np.repeat(batch.column(c).to_numpy(), counts) for c in (1, 2)]
                yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(keys[1]), pa.array(p.astype(np.int32)), pa.array(np.concatenate(names).view(np.int64)),
                                                  pa.array(np.concatenate(weights)), pa.array(first)], names=["t1", "t2", "pos", "h", "w", "first"])
    return run


def _surroundings(length: int, text_at: int, t1_at: int, t2_at: int, list_at: int):
    """Rows of texts with their positions -> (h, w, t1, t2, start, body); a text
    that follows an equal one in the task is not cut again."""
    reach = length - length // 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                own = (batch.column(t1_at)[i].as_py(), batch.column(t2_at)[i].as_py())
                if own == last:
                    continue
                last = own
                data = _bytes(batch.column(text_at)[i].as_py())
                for x in batch.column(list_at)[i].as_py():
                    start = max(0, x["pos"] - reach)
                    rows.append((x["h"], x["w"], *own, start, data[start:x["pos"] + length]))
                if len(rows) > 4096:
                    yield _packed(rows)
                    rows = []
        if rows:
            yield _packed(rows)

    return run


PLACES = "h long, w int, t1 long, t2 long, start int, body binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["h", "w", "t1", "t2", "start", "body"])


def _windows(bodies: list[bytes], length: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, body numbers, offsets) of all ``length``-byte strings of the bodies."""
    names, owner, offset = [], [], []
    for i in range(0, len(bodies), 4096):
        part = bodies[i:i + 4096]
        sizes = np.array([len(b) for b in part])
        counts = sizes - length + 1
        every = string_names(np.frombuffer(b"".join(part), np.uint8), length, seed)
        base = np.cumsum(sizes) - sizes
        inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        names.append(every[np.repeat(base, counts) + inside])
        owner.append(np.repeat(np.arange(i, i + len(part), dtype=np.int32), counts))
        offset.append(inside.astype(np.int32))
    return np.concatenate(names), np.concatenate(owner), np.concatenate(offset)


def _split(at: np.ndarray, key: np.ndarray, place: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``at`` sorted by ``key`` into buckets: (positions that share a
    bucket with another place, their buckets' numbers); the others are done with."""
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    runs = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    placed = place[at]
    shared = (np.minimum.reduceat(placed, runs) != np.maximum.reduceat(placed, runs)) | np.logical_or.reduceat(many[at], runs)
    sizes = np.diff([*runs, len(at)])
    return at[np.repeat(shared, sizes)], np.repeat(np.arange(shared.sum(), dtype=np.int64), sizes[shared])


def _check(data: bytes, at: np.ndarray, bucket: np.ndarray, owner: np.ndarray, place: np.ndarray, many: np.ndarray, length: int) -> np.ndarray:
    """Of positions with the same bucket, those whose strings do repeat, by their
    bytes: each is compared with the first of its bucket, neighbours that lie
    alike in one go; buckets with different strings are told apart one by one."""
    if not len(at):
        return at
    first = at[np.searchsorted(bucket, np.arange(bucket[-1] + 1))][bucket]
    order = np.argsort(at, kind="stable")
    at, first, bucket = at[order], first[order], bucket[order]
    breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(first) != 1) | (np.diff(owner[at]) != 0) | (np.diff(owner[first]) != 0)) + 1
    wrong: set[int] = set()
    for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(at)], strict=True):
        p, q, size = int(at[a]), int(first[a]), b - a - 1 + length
        if p != q and data[p:p + size] != data[q:q + size]:
            wrong.update(bucket[a:b].tolist())
    if not wrong:
        return at
    kept = [at[~np.isin(bucket, list(wrong))]]
    for k in wrong:
        own: dict[bytes, list[int]] = {}
        for p in at[bucket == k].tolist():
            own.setdefault(data[p:p + length], []).append(p)
        kept += [np.array(x, np.int64) for x in own.values() if len(set(place[x].tolist())) > 1 or many[x].any()]
    return np.sort(np.concatenate(kept))


def _repeated(rows: list[tuple], length: int) -> list[tuple]:
    """(t1, t2, start, end) of the repeated runs in whole buckets of rows (h, w, t1, t2, start, body)."""
    # bodies by content, each with the distinct places it stands at
    kind_of: dict[bytes, int] = {}
    places: list[dict] = []
    kinds: dict[int, int] = {}  # by bucket: its kind, -1 for more than one or a q-gram that repeats inside a text
    mine: list[list[int]] = []
    picked_rows: list[tuple] = []
    for x in rows:
        k = kind_of.setdefault(x[5], len(places))
        if k == len(places):
            places.append({})
            mine.append([])
            picked_rows.append(x)
        places[k][x[2:5]] = None
        mine[k].append(x[0])
        kinds[x[0]] = k if x[1] == 1 and kinds.get(x[0], k) == k else -1
    out: list[tuple] = [(*p, p[2] + len(picked_rows[k][5])) for k, at in enumerate(places) if len(at) > 1 for p in at]
    # buckets of one kind need no refinement
    left = [k for k, own in enumerate(mine) if any(kinds[h] < 0 for h in own)]
    if left:
        picked = [picked_rows[k] for k in left]
        sizes = np.array([len(x[5]) for x in picked])
        ends = np.cumsum(sizes)
        data = b"".join(x[5] for x in picked)
        owner = np.repeat(np.arange(len(picked), dtype=np.int32), sizes)
        texts = {t: i for i, t in enumerate(dict.fromkeys(x[2:4] for x in picked))}
        place = np.repeat(np.array([(texts[x[2:4]] << 32) + x[4] for x in picked], np.int64) - (ends - sizes), sizes) + np.arange(len(data))
        many = np.repeat(np.array([len(places[k]) > 1 for k in left]), sizes)
        room = np.repeat(ends, sizes) - np.arange(len(data))  # bytes up to the end of the body
        q = length // 4
        at = np.flatnonzero(room >= q)
        at, bucket = _split(at, gram_names(np.frombuffer(data, np.uint8), q // 4)[at], place, many)
        depth = q
        while depth < length and len(at):
            # the buckets of ``depth`` bytes are refined by those at the later offset, which are of the same round; a
            # string whose later part is in no bucket is done with
            later = np.full(len(data) + depth, -1, np.int64)
            later[at] = bucket
            stay = (room[at] >= 2 * depth) & (later[at + depth] >= 0)
            at, bucket = at[stay], bucket[stay]
            if len(at):
                at, bucket = _split(at, bucket * (int(later.max()) + 1) + later[at + depth], place, many)
            depth *= 2
        at = _check(data, at, bucket, owner, place, many, length)
        at = at[~many[at]]  # those are covered as a whole already
        if len(at):
            breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(owner[at]) != 0))
            for a, b in zip(at[np.concatenate([[0], breaks + 1])].tolist(), at[np.concatenate([breaks, [len(at) - 1]])].tolist(), strict=True):
                x, low = picked[owner[a]], int(place[a]) & 0xFFFFFFFF
                out.append((x[2], x[3], low, low + b - a + length))
    return out


def _refine_buckets(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BATCH_BYTES and row[0] != held[-1][0]:
                    yield from _runs(_repeated(held, length))
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held:
            yield from _runs(_repeated(held, length))

    return run


def _runs(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    if rows:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["t1", "t2", "a", "b"])


def _all_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1024):
                batch = whole.slice(i, 1024)
                bodies = batch.column("body").to_pylist()
                names, owner, offset = _windows(bodies, length)
                second = _windows(bodies, length, 1)[0]
                t1, t2, start = (batch.column(c).to_numpy() for c in ("t1", "t2", "start"))
                yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(second.view(np.int64)), pa.array(t1[owner]), pa.array(t2[owner]),
                                                  pa.array((start[owner] + offset).astype(np.int32))], names=["name", "second", "t1", "t2", "pos"])
    return run


def _cut(text_at: int, runs_at: int):
    """Appends n_bytes, spans (maximal removed runs) and kept (the other bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                sizes, spans, kept = [], [], []
                for text, runs in zip(batch.column(text_at), batch.column(runs_at), strict=True):
                    data = _bytes(text.as_py())
                    merged: list[list[int]] = []
                    for x in sorted(runs.as_py() or [], key=lambda x: x["a"]):
                        a, b = x["a"], min(x["b"], len(data))
                        if merged and a <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], b)
                        else:
                            merged.append([a, b])
                    out, at = [], 0
                    for a, b in merged:
                        out.append(data[at:a])
                        at = b
                    sizes.append(len(data))
                    spans.append(merged)
                    kept.append(b"".join([*out, data[at:]]))
                yield pa.RecordBatch.from_arrays([*batch.columns[:runs_at], pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary())],
                                                 names=[*batch.schema.names[:runs_at], "n_bytes", "spans", "kept"])
    return run


# ---------------------------------------------------------------- operator


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> tuple[DataFrame, str]:
    """``docs`` with one struct column appended, and that column's name:
    n_bytes, spans (removed runs as [start, end) in bytes), kept (binary)."""
    if length % 16:
        raise ValueError("length must be a multiple of 16")
    spark = docs.sparkSession
    t1, t2, f1, f2, found, result = fresh(docs, "text_h1", "text_h2", "found_h1", "found_h2", "found", "repeats")
    k1, k2 = content_key(text_or_empty(text_col))
    keyed = docs.withColumn(t1, k1).withColumn(t2, k2)

    # initial buckets
    folder = shared_folder(spark, "buckets")
    keyed.select(text_or_empty(text_col).alias("text"), col(t1).alias("t1"), col(t2).alias("t2")) \
        .mapInArrow(_initial(length), "t1 long, t2 long, pos int, h long, w int, first boolean").write.parquet(folder)
    initial = spark.read.schema("t1 long, t2 long, pos int, h long, w int, first boolean").parquet(folder)
    place = F.xxhash64("t1", "t2", "pos")
    shared = initial.groupBy("h").agg(F.min(place).alias("p1"), F.max(place).alias("p2"), F.max("w").alias("w2"), F.count(F.lit(1)).alias("n")) \
        .where("p1 != p2 or w2 > 1").select("h", (F.col("n") > hot).alias("hot"))
    shared = cut_lineage(shared)  # written, so that the skew join may split a hot bucket
    left = cut_lineage(initial.join(shared, "h").groupBy("t1", "t2", "hot").agg(F.collect_set(F.struct("pos", "h", "w")).alias("at")))
    copies = cut_lineage(initial.where("first").groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("t1", "t2"))
    remove_folder(spark, folder)

    # surroundings: the texts meet their positions by content, sorted, so that equal texts follow each other
    def surroundings(positions: DataFrame) -> DataFrame:
        chosen = positions.select(F.col("t1").alias(f1), F.col("t2").alias(f2), F.col("at").alias(found)).hint("merge")
        joined = keyed.join(chosen, (col(t1) == col(f1)) & (col(t2) == col(f2))).sortWithinPartitions(t1, t2)
        at = joined.columns.index
        return joined.mapInArrow(_surroundings(length, at(text_col), at(t1), at(t2), at(found)), PLACES)

    runs = surroundings(left.where("not hot")).repartition("h").sortWithinPartitions("h").mapInArrow(_refine_buckets(length), "t1 long, t2 long, a int, b int")
    if left.where("hot").limit(1).count():
        # every string of a hot bucket is a row; two names together (128 bits) at two places are repeated
        strings = cut_lineage(surroundings(left.where("hot")).select("t1", "t2", "start", "body").mapInArrow(_all_windows(length), "name long, second long, t1 long, t2 long, pos int"))
        twice = strings.groupBy("name", "second").agg(F.min(place).alias("p1"), F.max(place).alias("p2")).where("p1 != p2").select("name", "second")
        twice = cut_lineage(twice)  # written, so that the skew join may split a hot string
        runs = runs.unionByName(strings.join(twice, ["name", "second"], "left_semi").select("t1", "t2", F.col("pos").alias("a"), (F.col("pos") + length).alias("b")))
    runs = runs.unionByName(copies.select("t1", "t2", F.lit(0).alias("a"), F.lit(ALL).alias("b")))
    per_text = runs.groupBy(F.col("t1").alias(f1), F.col("t2").alias(f2)).agg(F.collect_list(F.struct("a", "b")).alias(found)).hint("merge")

    joined = keyed.join(per_text, (col(t1) == col(f1)) & (col(t2) == col(f2)), "left").select(*[col(c) for c in keyed.columns], col(found))
    added = T.StructType.fromDDL("n_bytes long, spans array<array<long>>, kept binary")
    names = fresh(docs, "n_bytes", "spans", "kept")
    schema = T.StructType([*keyed.schema.fields, *[T.StructField(n, f.dataType) for n, f in zip(names, added.fields, strict=True)]])
    cut = _cut(docs.columns.index(text_col), len(keyed.columns))

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut(batches):
            yield batch.rename_columns([*batch.schema.names[:-3], *names])

    done = joined.mapInArrow(renamed, schema)
    return done.select(*[col(c) for c in docs.columns],
                       F.struct(*[col(n).alias(f.name) for n, f in zip(names, added.fields, strict=True)]).alias(result)), result
