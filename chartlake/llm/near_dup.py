"""Near-duplicate classes by MinHash with sequential Bayesian verification.

1. Every document becomes its number of distinct word shingles, a 64-bit hash
   of that set and a MinHash signature.  Documents with equal sets are one
   node from here on, so large groups of copies cost one node each.
2. The signature's bands are exploded; nodes that share a band bucket are
   candidates.  Each bucket ties its members to its smallest node (a star, not
   all pairs), and the connected components of these ties are the candidate
   groups.
3. The sets and signatures of a group meet in one task.  A group larger than
   ``BLOCK_SHINGLES`` falls back into its band buckets (one of those with the
   same members), so texts that only chains of chance collisions tie together
   are not compared.  A bucket that is still larger is cut into blocks, and each
   pair of blocks is a task of its own.
   There a node's signature is compared with those of the nodes it
   is not yet linked to, a batch of hashes at a time; after each batch,
   nodes drop out whose posterior probability of a similarity of ``threshold``
   or more is below ``miss``.  Survivors are verified on the full shingle sets,
   and only links that join two parts are emitted: a spanning forest.
4. Connected components of the links are the classes.

Nothing of this passes through the driver.  Shingles are compared by 64-bit
hashes; sets that share their hash are told apart by a second one.

Words: A-Z lower-cased, runs of [^\\x20\\x09-\\x0D].  A document of fewer than
``width`` words has its whole sequence as one shingle; null, empty and blank
texts have an empty set and are linked with nothing.  Repeated rows are in one
class.  Null ids take part; a class's id is its smallest non-null id.  An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartlake.llm.common import col, components, fresh, lower_utf8, pieces, release
from chartlake.session import cut_lineage

HASHES, BAND = 128, 4
BANDS = HASHES // BAND
#: Hashes compared before each look at the posterior.
BATCH = 16
MISS = 1e-6
#: Shingles of one block (8 bytes each).
BLOCK_SHINGLES = 2_000_000
#: A node counts as so many shingles at least, which bounds the nodes of a block too.
NODE_SHINGLES = 64
#: Shingles hashed at a time (128 x 4 bytes each).
CHUNK = 2048

_rng = np.random.Generator(np.random.PCG64(20240229))
MULTIPLY = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
STEPS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    parts = [np.fromiter(map(xxhash.xxh3_64_intdigest, x.split()), np.uint64) for x in pieces(lower_utf8(text or ""))]
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    n = len(hashes)
    if not n:
        return hashes
    k = min(width, n)
    mixed = np.full(n - k + 1, np.uint64(k))  # a short sequence never equals a full shingle
    for i in range(k):
        mixed = _mix(mixed * STEPS[i] + hashes[i:n - k + 1 + i])
    return np.unique(mixed)


def signature(s: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    low = (s >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(low), CHUNK):
        np.minimum(out, (low[i:i + CHUNK, None] * MULTIPLY + ADD).min(0), out=out)
    return out


def _set_hash(members: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(members, seed) - (1 << 63)


def posterior_floor(threshold: float, miss: float, n: int) -> int:
    """The fewest matches among n hashes at which P(similarity >= threshold)
    is at least ``miss``, under a uniform prior.

    The posterior is a beta distribution with whole parameters, so its upper
    tail is a binomial sum: P = sum of C(n+1, j) t^j (1-t)^(n+1-j), j <= matches."""
    p, total, matches = (1 - threshold) ** (n + 1), 0.0, 0
    while matches <= n:
        total += p
        if total >= miss:
            return matches
        matches += 1
        p *= (n + 2 - matches) / matches * threshold / (1 - threshold)
    return n + 1


# ---------------------------------------------------------------- tasks


def _describe(width: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                n, sig, h1, h2 = [], [], [], []
                for text in batch.column(at):
                    s = shingles(text.as_py(), width)
                    n.append(len(s))
                    data = s.tobytes()
                    h1.append(_set_hash(data, 1))
                    h2.append(_set_hash(data, 2))
                    sig.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                                                  pa.array(sig, pa.binary())], names=["id", "n", "node", "check", "sig"])
    return run


def _shingle_rows(width: int):
    """(units, node, sig, text) with the text replaced by its shingle set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                sets = [shingles(x.as_py(), width).tobytes() for x in batch.column("text")]
                # rows that share an id with the node's row but have another set are left out
                own, other = (pa.array([_set_hash(x, seed) for x in sets], pa.int64()) for seed in (1, 2))
                made = pa.RecordBatch.from_arrays([batch.column("units"), batch.column("node"), batch.column("sig"), pa.array(sets, pa.binary())],
                                                  names=["units", "node", "sig", "members"])
                yield made.filter(pc.or_(pc.equal(own, batch.column("node")), pc.equal(other, batch.column("node"))))
    return run


class _Tile:
    """The nodes of one task, linked as they come out of verification."""

    def __init__(self, threshold: float, floors: list[int]):
        self.percent, self.floors = round(threshold * 100), floors

    def links(self, nodes: np.ndarray, sides: np.ndarray, sigs: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
        """Spanning links.  Between two blocks (sides 0 and 1) only pairs across count."""
        n = len(nodes)
        label = np.arange(n)
        sizes = np.array([len(s) for s in sets])
        order = np.argsort(nodes, kind="stable")
        across = sides.max() != sides.min()
        out = []
        for k, i in enumerate(order):
            left = order[k + 1:]
            left = left[label[left] != label[i]]
            if across:
                left = left[sides[left] != sides[i]]
            # sets of too different size cannot reach the threshold
            small, large = np.minimum(sizes[left], sizes[i]), np.maximum(sizes[left], sizes[i])
            left = left[100 * small >= self.percent * large]
            matches = np.zeros(len(left), np.int32)
            for b, floor in enumerate(self.floors):
                if not len(left):
                    break
                matches = matches + (sigs[left, b * BATCH:(b + 1) * BATCH] == sigs[i, b * BATCH:(b + 1) * BATCH]).sum(1)
                stay = matches >= floor
                left, matches = left[stay], matches[stay]
            for j in left[np.argsort(-matches, kind="stable")]:
                if label[i] == label[j]:
                    continue
                both = np.intersect1d(sets[i], sets[j], assume_unique=True).size
                if 100 * both >= self.percent * (sizes[i] + sizes[j] - both):
                    out.append((int(nodes[i]), int(nodes[j])))
                    label[label == label[j]] = label[i]
        return out


def _verify(threshold: float, miss: float):
    floors = [posterior_floor(threshold, miss, BATCH * (b + 1)) for b in range(HASHES // BATCH)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = _Tile(threshold, floors)
        held: list[tuple] = []
        now = None
        found: list[tuple[int, int]] = []

        def close():
            if len(held) > 1:
                nodes = np.array([x[0] for x in held])
                found.extend(tile.links(nodes, np.array([x[1] for x in held]), np.frombuffer(b"".join(x[2] for x in held), np.uint32).reshape(-1, HASHES),
                                        [np.frombuffer(x[3], np.uint64) for x in held]))
            held.clear()

        for batch in batches:
            for unit, tile_no, node, side, sig, members in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if (unit, tile_no) != now:
                    close()
                    now = (unit, tile_no)
                held.append((node, side, sig, members))
            if len(found) > 1 << 14:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])
                found = []
        close()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    return run


# ---------------------------------------------------------------- operator


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5) -> DataFrame:
    """(id, n, node, check, sig) per row; sig is null for an empty set.  Written once."""
    chosen = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return cut_lineage(chosen.mapInArrow(_describe(width, 1), f"id {kind}, n long, node long, check long, sig binary"))


def band_buckets():
    """The band buckets of a signature, one row each."""
    return F.explode(F.array(*[F.xxhash64(F.lit(b), F.substring("sig", 4 * BAND * b + 1, 4 * BAND)) for b in range(BANDS)])).alias("bucket")


def candidate_groups(nodes: DataFrame) -> DataFrame:
    """(node, grp) of all nodes that share a band bucket with another one."""
    members = nodes.select("node", band_buckets())
    heads = members.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last").select("bucket", "head")
    heads = cut_lineage(heads)  # written, so that the skew join may split a hot bucket of the members
    ties = members.join(heads, "bucket").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    return components(cut_lineage(ties)).select("node", F.col("root").alias("grp"))


def _blocks(block_shingles: int):
    return F.ceil(F.sum(F.greatest("n", F.lit(NODE_SHINGLES))) / F.lit(block_shingles)).cast("int").alias("blocks")


def candidate_units(members: DataFrame, block_shingles: int) -> DataFrame:
    """(id, node, sig, units): the units in which a node meets others, each a
    group or a band bucket with the number of its blocks.  A node has one unit,
    or in a large group at most ``BANDS``."""
    sized = cut_lineage(members.groupBy("grp").agg(_blocks(block_shingles)))
    grouped = members.join(sized, "grp")
    whole = grouped.where("blocks = 1").select("id", "node", "sig", F.array(F.struct(F.col("grp").alias("unit"), "blocks")).alias("units"))
    if not sized.where("blocks > 1").limit(1).count():
        return whole
    large = grouped.where("blocks > 1").select("id", "node", "sig", "n")
    held = cut_lineage(large.select("node", "n", band_buckets()))
    # buckets with the same members are one: two copies share most of theirs
    buckets = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("nodes"), _blocks(block_shingles), F.bit_xor(F.xxhash64("node")).alias("x1"),
                                         F.bit_xor(F.xxhash64(F.lit("second"), "node")).alias("x2")).where("nodes > 1")
    chosen = cut_lineage(buckets.groupBy("nodes", "x1", "x2", "blocks").agg(F.min("bucket").alias("bucket")).select("bucket", "blocks"))
    placed = held.join(chosen, "bucket").groupBy("node").agg(F.collect_list(F.struct(F.col("bucket").alias("unit"), "blocks")).alias("units"))
    return whole.unionByName(large.join(placed, "node").select("id", "node", "sig", "units"))


def distinct_sets(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, id, sig, n) per distinct set, and ``described`` with the nodes that
    these have.  Sets that share the first hash (among many billions some do) are
    told apart by the second: all but those of the smallest take it as their node."""
    def reduce(rows: DataFrame) -> DataFrame:
        return cut_lineage(rows.where(F.col("sig").isNotNull()).groupBy("node").agg(
            F.min("check").alias("check"), F.max("check").alias("check2"), F.min("id").alias("id"), F.first("sig").alias("sig"), F.max("n").alias("n")))

    nodes, shared = reduce(described), F.col("check") != F.col("check2")
    if nodes.where(shared).limit(1).count():
        clash = cut_lineage(nodes.where(shared).select("node", F.col("check").alias("least")))
        described = cut_lineage(described.join(clash, "node", "left").select(
            "id", "n", F.when(F.col("check") != F.col("least"), F.col("check")).otherwise(F.col("node")).alias("node"), "check", "sig"))
        nodes = reduce(described)
        if nodes.where(shared).limit(1).count():
            raise ValueError("two shingle sets share both of their hashes")
    return nodes.select("node", "id", "sig", "n"), described


def links(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, width: int, threshold: float, miss: float,
          block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(a, b): spanning links between nodes, verified on full sets."""
    wanted = candidate_units(cut_lineage(nodes.join(candidate_groups(nodes.select("node", "sig")), "node")), block_shingles)

    # each node's text: that of one row with its set (rows equal in id but not in text are told apart by the set)
    texts = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    joined = texts.join(wanted.withColumnRenamed("id", "want"), F.col("id").eqNullSafe(F.col("want"))) \
        .select("units", "node", "sig", "text") \
        .mapInArrow(_shingle_rows(width), "units array<struct<unit: long, blocks: int>>, node long, sig binary, members binary") \
        .select(F.inline("units"), "node", "sig", "members")
    own = F.pmod(F.xxhash64(F.lit("block"), F.col("node")), F.col("blocks")).cast("int")
    # block pairs (i, j), i <= j, as one number; a unit of one block is the single tile 0
    tiles = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        (F.least(F.col("own"), o) * F.col("blocks") + F.greatest(F.col("own"), o)).cast("long").alias("tile"),
        F.when(F.col("own") > o, 1).otherwise(0).alias("side")))
    dealt = joined.withColumn("own", own).select("unit", F.explode(tiles).alias("t"), "node", "sig", "members") \
        .select("unit", "t.tile", "node", "t.side", "sig", "members")
    return dealt.repartition("unit", "tile").sortWithinPartitions("unit", "tile", "node") \
        .mapInArrow(_verify(threshold, miss), "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.75,
                miss: float = MISS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per row of ``docs``: (id_col, n_shingles, component_id, kept)."""
    release(docs.sparkSession)
    nodes, described = distinct_sets(describe(docs, id_col, text_col, width))
    linked = cut_lineage(components(cut_lineage(links(docs, nodes, id_col, text_col, width, threshold, miss, block_shingles))))
    release(docs.sparkSession)
    placed = described.join(linked, "node", "left") \
        .select("id", "n", F.coalesce("root", "node").alias("class"), F.col("sig").isNotNull().alias("full"))
    full = placed.where("full")
    best = cut_lineage(full.groupBy("class").agg(F.min("id").alias("component_id")))
    out = full.join(best, "class").select("id", "n", "component_id") \
        .unionByName(placed.where("not full").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged: one of each class (the
    smallest id); of rows that share that id, one (by its text)."""
    groups = near_groups(docs, id_col, text_col, **settings)
    (keep,) = fresh(docs, "keep_id")
    stay = groups.where("kept").select(col(id_col).alias(keep)).distinct()
    return docs.join(stay, col(id_col).eqNullSafe(col(keep)), "left_semi")
