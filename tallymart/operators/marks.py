"""Bitmaps of hashes, at most 8 MB, that tell rows which need a closer look from rows that do not.

A mark may be set by chance, when two hashes share a slot; it is never missing. So work on marked rows alone is exact as long as a
mark set by chance changes nothing but the amount of work.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BITS = 32_768    # of a bitmap, as the aggregate makes it
SLOTS = 1 << 26  # hash values that are told apart: 8 MB of bitmaps
PIECE = 64       # bytes of a bitmap that a row looks at


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def marks(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_piece, _bits): a bit for every hash of the keys that occurs, in pieces of ``PIECE`` bytes."""
    return _marks(df.select(key_hash(keys).alias("_hash")))


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Marks of the hashes that two rows or more have. A key without a mark occurs once; only hashes are shuffled."""
    return _marks(df.groupBy(key_hash(keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"))


def _marks(hashes: DataFrame) -> DataFrame:
    slot = F.col("_hash").bitwiseAND(F.lit(SLOTS - 1))
    maps = hashes.select(F.floor(slot / BITS).alias("map"), (slot % BITS).alias("at")).groupBy("map").agg(
        F.bitmap_construct_agg("at").alias("bits"))
    pieces = BITS // 8 // PIECE
    cut = maps.select("map", "bits", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("i"))
    return cut.select(
        (F.col("map") * pieces + F.col("i")).alias("_piece"),
        F.substring(F.col("bits"), F.col("i") * PIECE + 1, F.lit(PIECE)).alias("_bits"),
    ).filter(F.bitmap_count("_bits") > 0)


def marked(df: DataFrame, keys: Sequence[str], found: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: whether the hash of its keys has a mark. The marks are broadcast, no row is shuffled."""
    out = df.withColumn("_slot", key_hash(keys).bitwiseAND(F.lit(SLOTS - 1))).join(
        F.broadcast(found), F.floor(F.col("_slot") / (PIECE * 8)) == F.col("_piece"), "left")
    byte = F.substring(F.col("_bits"), F.floor(F.col("_slot") % (PIECE * 8) / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("_slot") % 8).cast("int"))
    return out.withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop("_slot", "_piece", "_bits")
