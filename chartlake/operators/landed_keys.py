"""Bloom filters of landed keys, as a pre-filter of anti-joins (SRC-8, JN-12).

Each landed file (or batch of files) gets a filter once, when it lands: rows
(of_file, block, bits), where a block is a bitmap of 32,768 bits.  A key has one
block and ``HASHES`` bits of it.  Filters of any files with the same number of
blocks are united by OR, so older files are not read again for a new one.

``anti_join`` broadcasts the united filter while it has at most
``BROADCAST_BLOCKS`` blocks of 4 KB (64 MB; some 50 million keys).  Rows with a bit that is not set are
new for certain and skip the join; only the others are shuffled to meet the
landed keys, exactly.  A larger filter is not used and all rows take the exact
join.  The result is that of a plain left anti-join in every case.

Defined results: a null key is never landed, so its rows stay; repeated rows
and keys are kept and counted as they are; an empty landed table keeps all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one block, fixed by Spark's bitmap functions.
BLOCK_BITS = 32_768
BITS_PER_KEY = 10
HASHES = 5
BROADCAST_BLOCKS = 16_384


def blocks_for(keys: int) -> int:
    """Blocks (a power of two) for an expected number of landed keys: about 1 percent false positives."""
    need = -(-keys * BITS_PER_KEY // BLOCK_BITS)
    return 1 << max(0, need - 1).bit_length()


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key and its bits in the block."""
    step = F.xxhash64(F.lit("bits"), key)
    low, high = step.bitwiseAND(F.lit(BLOCK_BITS - 1)), F.shiftright(step, 15).bitwiseAND(F.lit(BLOCK_BITS - 1)).bitwiseOR(F.lit(1))
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks)), [(low + high * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)]


def key_filters(landed: DataFrame, key: str, of_file: Column, blocks: int) -> DataFrame:
    """(of_file, blocks, block, bits): the filters of the landed files, combined on the map side."""
    block, bits = _places(F.col(key), blocks)
    return landed.where(F.col(key).isNotNull()) \
        .select(of_file.cast("string").alias("of_file"), block.alias("block"), F.explode(F.array(*bits)).alias("bit")) \
        .groupBy("of_file", "block").agg(F.bitmap_construct_agg("bit").alias("bits")) \
        .select("of_file", F.lit(blocks).alias("blocks"), "block", "bits")


def united(filters: DataFrame) -> DataFrame:
    """(block, bits): one filter for all files."""
    return filters.groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1


def with_maybe(rows: DataFrame, key: str, filters: DataFrame, blocks: int, name: str = "maybe") -> DataFrame:
    """``rows`` with a flag: false where the key is in no landed file for certain."""
    block, places = _places(F.col(key), blocks)
    found = united(filters).select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    all_set = places[0].isNotNull()
    for p in places:
        all_set = all_set & _is_set(F.col("_bits"), p)
    return rows.withColumn("_at", block).join(F.broadcast(found), F.col("_at") == F.col("_block"), "left") \
        .select(*[F.col(c) for c in rows.columns], F.coalesce(all_set, F.lit(False)).alias(name))


def anti_join(rows: DataFrame, landed: DataFrame, key: str, filters: DataFrame | None, blocks: int) -> DataFrame:
    """``rows`` whose key is not landed.  ``filters`` must hold every landed file."""
    keys = landed.select(key)
    if filters is None or blocks > BROADCAST_BLOCKS:
        return rows.join(keys, key, "left_anti")
    flagged = with_maybe(rows, key, filters, blocks, "_maybe")
    new = flagged.where(~F.col("_maybe")).drop("_maybe")
    return new.unionByName(flagged.where(F.col("_maybe")).drop("_maybe").join(keys, key, "left_anti").select(*rows.columns))
