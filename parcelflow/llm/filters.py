"""A bit table of keys: which rows may have a partner, at a fixed size for any input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the table (4 MB), which is what a task receives at most, however many keys there are.
FILTER_BITS = 1 << 25


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)) + 1


def seen_keys(keys: DataFrame, key: str) -> DataFrame:
    """The bit table of the values of ``key``: one row of 1,024 numbers of 32 bits for each 32,768 places."""
    place = _place(key)
    table = keys.groupBy(F.call_function("bitmap_bucket_number", place).alias("bucket")).agg(
        F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", place)).alias("bits")
    )
    number = lambda i: F.conv(F.hex(F.substring(F.col("bits"), i * 4 + 1, F.lit(4))), 16, 10).cast("long")
    return table.select("bucket", F.transform(F.sequence(F.lit(0), F.lit(1023)), number).alias("numbers"))


def maybe_seen(rows: DataFrame, key: str, seen: DataFrame) -> DataFrame:
    """Rows whose ``key`` may be in the bit table.  None that is goes missing; a few others pass."""
    place = _place(key)
    marked = rows.withColumn("bucket", F.call_function("bitmap_bucket_number", place)).join(F.broadcast(seen), "bucket")
    # bits count from the low end of each byte, bytes from the high end of each number
    bit = F.call_function("bitmap_bit_position", place).cast("int")
    at = (F.lit(3) - F.shiftright(bit, 3).bitwiseAND(F.lit(3))) * 8 + bit.bitwiseAND(F.lit(7))
    return marked.where(F.call_function("getbit", F.get("numbers", F.shiftright(bit, 5)), at) == 1).drop("bucket", "numbers")
