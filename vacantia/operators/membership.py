"""Rows that may be among others, by a bit map of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the map: 1,024 rows of 4 KB at most, however many keys there are.
BITS = 1 << 25


def key_bits(keys: DataFrame, key: str) -> DataFrame:
    """``bucket, bits``: a bit for the hash of every key, combined map-side."""
    place = _place(key)
    return keys.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )


def may_be_among(df: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """Rows whose key may be among those of :func:`key_bits`: all that are, and few others; none with a null key.

    The map has a fixed bound and is broadcast, so the rows stay where they are. With more keys than it has
    bits nearly all rows come through, which is right for what only saves work.
    """
    place = _place(key)
    marked = df.withColumns({"__bucket": F.bitmap_bucket_number(place), "__bit": F.bitmap_bit_position(place)})
    met = marked.join(F.broadcast(bits), F.col("__bucket") == F.col("bucket"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("__bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    set_there = F.getbit(byte, (F.col("__bit") % 8).cast("int")) == 1
    return met.filter(F.col(key).isNotNull() & set_there).select(*df.columns)


def _place(key: str):
    return F.pmod(F.xxhash64(key), F.lit(BITS)) + 1
