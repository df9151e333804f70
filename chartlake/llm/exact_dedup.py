"""Exact dedup against a history held in minimal perfect hash tables.

The history of distinct digests is split by digest into parts of bounded size.
A part is one row: a minimal perfect hash (levels of bit arrays; a key's slot
is the rank of its bit) and the slots, each with the full 32-byte digest, the
winner's locator (id and code points) and the size of its group.  A minimal
perfect hash maps strangers to slots too, so a lookup counts as a hit only if
the slot's digest equals the key byte by byte.  Keys that miss are grouped
among themselves and join the next history.

Each batch is first reduced to one row per digest (map-side combined), so a
digest with a third of all rows reaches its part as one row; the rows get
their group back by an equi-join, which the adaptive skew join may split.

Of equal texts the row with the most code points in the original text stays,
then the smallest id (nulls last).  Texts are equal when identical after
deleting every character of [\\x20\\x09-\\x0D]; null counts as empty.  Rows
equal in id and text are one document (``dedup`` keeps one of them).  An empty
table gives no rows.  Ids are integers, or texts that spell one; any other text id raises (ANSI casts).
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartlake.llm.common import BLANKS, col, fresh, partitions, text_or_empty
from chartlake.session import cut_lineage

#: Mean digests of a part (about 250 KB of slots); parts grow in number with the history, not in size.
PART_KEYS = 1 << 12
#: Bits per key in each level of the hash.
GAMMA = 2.0
SLOT = np.dtype([("digest", "V32"), ("id", "<i8"), ("has_id", "?"), ("cp", "<i8"), ("n", "<i8")])
TABLE = "part int, kind int, digest binary, id long, cp long, n long, bits binary, slots binary"
GROUPS = "digest binary, id long, cp long, n long"


def normalised(text):
    return F.translate(text, BLANKS, "")


# ---------------------------------------------------------------- the hash


def _hashes(keys: np.ndarray, level: int) -> np.ndarray:
    """A 64-bit hash of each 32-byte digest, another one for each level."""
    words = np.ascontiguousarray(keys).view("<u8").reshape(-1, 4)
    x = words[:, level % 4] ^ (words[:, (level + 1) % 4] * np.uint64(2 * level + 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class PerfectHash:
    """Levels of bit arrays: a key owns a bit in the first level where no other
    remaining key hits the same one; its slot is the rank of that bit."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.starts = np.cumsum([0] + [int(x.sum()) for x in levels])
        self.ranks = [np.cumsum(x, dtype=np.int64) - 1 for x in levels]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct V32 digests."""
        levels, left, level = [], keys, 0
        while len(left):
            m = max(64, math.ceil(GAMMA * len(left)))
            at = (_hashes(left, level) % np.uint64(m)).astype(np.int64)
            alone = np.bincount(at, minlength=m) == 1
            levels.append(alone)
            left = left[~alone[at]]
            level += 1
            if level > 200:
                raise ValueError("digests are not distinct")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where no level owns its bit."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            at = (_hashes(keys[left], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = self.starts[level] + self.ranks[level][at[hit]]
            left = left[~hit]
        return out

    def pack(self) -> bytes:
        return b"".join(struct.pack("<q", len(x)) + np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def unpack(cls, blob: bytes) -> PerfectHash:
        levels, i = [], 0
        while i < len(blob):
            (m,) = struct.unpack_from("<q", blob, i)
            size = (m + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(blob, np.uint8, size, i + 8))[:m].astype(bool))
            i += 8 + size
        return cls(levels)


# ---------------------------------------------------------------- tasks


def _fixed(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "V32")


def _records(batch: pa.RecordBatch) -> np.ndarray:
    out = np.zeros(batch.num_rows, SLOT)
    out["digest"] = _fixed(batch.column("digest"))
    ids = batch.column("id")
    out["has_id"] = ids.is_valid().to_numpy(zero_copy_only=False)
    out["id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out["cp"], out["n"] = batch.column("cp").to_numpy(), batch.column("n").to_numpy()
    return out


def _groups(slots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(slots), 1 << 14):
        x = slots[i:i + (1 << 14)]
        yield pa.RecordBatch.from_arrays([
            pa.array([d.tobytes() for d in x["digest"]], pa.binary()), pa.array(x["id"], mask=~x["has_id"]),
            pa.array(x["cp"]), pa.array(x["n"])], names=["digest", "id", "cp", "n"])


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """(part, rows) in order; batches hold whole runs of sorted parts."""
    for batch in batches:
        parts = batch.column("part").to_numpy()
        cuts = np.flatnonzero(np.diff(parts)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(parts)], strict=True):
            if b > a:
                yield int(parts[a]), batch.slice(a, b - a)


def _build_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(part: int, held: list[np.ndarray]) -> pa.RecordBatch:
        slots = np.concatenate(held)
        made = PerfectHash.build(slots["digest"])
        table = np.zeros(len(slots), SLOT)
        table[made.slots(slots["digest"])] = slots
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([made.pack()], pa.binary()),
                                           pa.array([table.tobytes()], pa.binary())], names=["part", "bits", "slots"])

    part, held = None, []
    for p, rows in _by_part(batches):
        if held and p != part:
            yield row(part, held)
            held = []
        part = p
        held.append(_records(rows))
    if held:
        yield row(part, held)


def _better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where record b wins over record a."""
    smaller = b["has_id"] & (~a["has_id"] | (b["id"] < a["id"]))
    return (b["cp"] > a["cp"]) | ((b["cp"] == a["cp"]) & smaller)


def _lookup_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part: its table row (kind 0, if the history has the part), then the
    batch's digests (kind 1).  Hits update their slot; misses pass through."""
    part, table, made = None, np.zeros(0, SLOT), None
    for p, rows in _by_part(batches):
        if p != part:
            yield from _groups(table)
            part, table, made = p, np.zeros(0, SLOT), None
        kinds = rows.column("kind").to_numpy()
        start = 0
        if kinds[0] == 0:
            made = PerfectHash.unpack(rows.column("bits")[0].as_py())
            table = np.frombuffer(rows.column("slots")[0].as_py(), SLOT).copy()
            start = 1
        new = _records(rows.slice(start))
        if not len(new):
            continue
        slot = made.slots(new["digest"]) if made else np.full(len(new), -1, np.int64)
        known = slot >= 0
        known[known] = table["digest"][slot[known]] == new["digest"][known]  # the byte check
        at, hit = slot[known], new[known]
        table["n"][at] += hit["n"]
        wins = _better(table[at], hit)
        for f in ("id", "has_id", "cp"):
            table[f][at[wins]] = hit[f][wins]
        yield from _groups(new[~known])
    yield from _groups(table)


# ---------------------------------------------------------------- operator


def digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, cp): the SHA-256 of the normalised text, the code points of the original."""
    text = text_or_empty(text_col)
    return docs.select(col(id_col).cast("long").alias("id"), F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("digest"),
                       F.length(text).cast("long").alias("cp"))


def best(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner and the number of rows."""
    first = F.max_by(F.struct("id", "cp"), F.struct(F.col("cp"), F.col("id").isNotNull().alias("has"), (-F.col("id")).alias("low")))
    return rows.groupBy("digest").agg(first.alias("w"), F.count(F.lit(1)).alias("n")) \
        .select("digest", "w.id", "w.cp", "n")


def _parted(groups: DataFrame, parts: int) -> DataFrame:
    part = F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(parts)).cast("int")
    return groups.select(part.alias("part"), F.lit(1).alias("kind"), "digest", "id", "cp", "n")


def build_history(groups: DataFrame, parts: int) -> DataFrame:
    """The history as rows (part, bits, slots), one per part."""
    return _parted(groups, parts).repartition("part").sortWithinPartitions("part") \
        .mapInArrow(_build_parts, "part int, bits binary, slots binary")


def add_batch(history: DataFrame, batch: DataFrame, parts: int) -> DataFrame:
    """History and batch (one row per digest) merged into groups (digest, id, cp, n)."""
    nothing = {c: F.lit(None).cast(t) for c, t in (("digest", "binary"), ("id", "long"), ("cp", "long"), ("n", "long"))}
    tables = history.withColumns({"kind": F.lit(0), **nothing}).select("part", "kind", "digest", "id", "cp", "n", "bits", "slots")
    rows = _parted(batch, parts).withColumns({"bits": F.lit(None).cast("binary"), "slots": F.lit(None).cast("binary")})
    return tables.unionByName(rows).repartition("part").sortWithinPartitions("part", "kind").mapInArrow(_lookup_parts, GROUPS)


def groups_of(rows: DataFrame, batches: int = 2) -> DataFrame:
    """All groups of ``rows`` (id, digest, cp): the rows arrive in ``batches``
    batches by hash of the id; each is looked up in the history of those before."""
    held = None
    distinct = rows.select("digest").distinct().count()
    parts = max(partitions(rows.sparkSession), math.ceil(distinct / PART_KEYS))
    for b in range(batches):
        own = best(rows.where(F.pmod(F.xxhash64("id", "cp"), F.lit(batches)) == b))
        held = own if held is None else add_batch(build_history(held, parts), own, parts)
    return held


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """One row per row of ``docs``: (id_col, keep_id, group_size, kept, text_sha256)."""
    rows = cut_lineage(digests(docs, id_col, text_col))
    groups = groups_of(rows, batches)
    found = rows.alias("r").join(groups.alias("g"), "digest")
    return found.select(F.col("r.id").alias(id_col), F.col("g.id").alias("keep_id"), F.col("g.n").alias("group_size"),
                        F.col("r.id").eqNullSafe(F.col("g.id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged, one per group.

    Rows equal in id and digest are first reduced to the longest (map-side
    combined); the winners then meet them by id and digest."""
    groups = groups_of(cut_lineage(digests(docs, id_col, text_col)), batches).select(F.col("id").alias("g_id"), F.col("digest").alias("g_digest"))
    digest, row = fresh(docs, "x_digest", "x_row")
    text = text_or_empty(text_col)
    one = docs.withColumn(digest, F.unhex(F.sha2(normalised(text).cast("binary"), 256))) \
        .groupBy(col(id_col).alias("x_id"), col(digest)) \
        .agg(F.max_by(F.struct(*[col(c) for c in docs.columns]), F.struct(F.length(text), text)).alias(row))
    return one.join(groups, F.col("x_id").cast("long").eqNullSafe(F.col("g_id")) & (col(digest) == F.col("g_digest")), "left_semi") \
        .select(*[F.col(f"`{row}`").getField(c).alias(c) for c in docs.columns])
