"""Keeping the rows of a large side that may have a partner in a small one, before any shuffle.

The keys of the small side set bits of a Bloom filter with one hash, kept as a table of bitmaps
of 4 KB each.  The table is at most ``bits`` / 8 bytes, two megabytes by default, whatever it was
made from, and is broadcast.  Rows whose bit is not set have no partner; few others pass while
the small side has fewer keys than a tenth of the bits.  More keys make it less useful, never wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24


def _place(columns: Sequence[str], bits: int) -> Column:
    """A number from 1 to bits.  Values are compared as text, so that both sides may differ in type."""
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in columns]), F.lit(bits)) + 1


def bloom_bitmaps(keys: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """(bucket, bitmap) rows of the filter over some key columns."""
    places = keys.select(_place(columns, bits).alias("place"))
    return places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bitmap")
    )


def possibly_among(
    rows: DataFrame, columns: Sequence[str], keys: DataFrame, key_columns: Sequence[str], bits: int = BITS
) -> DataFrame:
    """The rows that may have an equal in keys: all that have one, and few others."""
    bitmaps = bloom_bitmaps(keys, key_columns, bits)
    names = rows.columns
    bit = F.bitmap_bit_position("bloom_place")
    byte = F.substring("bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return (
        rows.withColumn("bloom_place", _place(columns, bits))
        .withColumn("bucket", F.bitmap_bucket_number("bloom_place"))
        .join(F.broadcast(bitmaps), "bucket")
        .where(F.getbit(value, (bit % 8).cast("int")) == 1)
        .select(*names)
    )
