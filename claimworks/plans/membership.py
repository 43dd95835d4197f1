"""Which keys may be in a set that is too large to be copied: a bitmap of their hashes.

Every key of the set marks one bit.  Bitmaps of parts of the set are united bit by bit, so they are
built by partial aggregates, in buckets of 32,768 bits that rows look up by their own hash.  A key of the
set is always found; another one is found with a chance of about keys over bits.  Not more than
``MOST_BITS`` are kept, whatever the number of keys, so that the bitmap can always be copied: beyond, more
rows are taken to be in the set, which costs time and changes nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.plans.workspace import write_table

BUCKET_BITS = 32_768  # of Spark's bitmap functions (fixed value)
BITS_PER_KEY = 32
MOST_BITS = 2**28  # 32 MiB


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def key_bitmap(keys: DataFrame, key: str, count: int, most_bits: int = MOST_BITS) -> tuple[DataFrame, int]:
    """Bucket and bits of a set of ``count`` keys as a written table, and the number of bits."""
    wanted = min(max(count * BITS_PER_KEY, BUCKET_BITS), most_bits)
    bits = -(-wanted // BUCKET_BITS) * BUCKET_BITS
    bit = _bit(F.col(key), bits)
    marked = keys.select((bit / BUCKET_BITS).cast("long").alias("bucket"), (bit % BUCKET_BITS).alias("at"))
    return write_table(marked.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("marks")), "key-bitmap"), bits


def with_membership(rows: DataFrame, key: Column, bitmap: DataFrame, bits: int, flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether ``key`` may be in the set; false for null.  Nothing is shuffled."""
    bit = _bit(key, bits)
    looked_up = rows.withColumns({
        "_bucket": F.when(key.isNotNull(), (bit / BUCKET_BITS).cast("long")), "_bit": (bit % BUCKET_BITS).cast("int"),
    })
    buckets = bitmap.select(F.col("bucket").alias("_bucket"), F.col("marks").alias("_marks"))
    found = looked_up.join(F.broadcast(buckets), "_bucket", "left")
    # eight bits to a byte, the lowest first
    byte = F.conv(F.hex(F.substring("_marks", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(F.coalesce(byte, F.lit(0)), (F.col("_bit") % 8).cast("int")) == 1
    return found.withColumn(flag, F.coalesce(F.col("_marks").isNotNull() & marked, F.lit(False))).drop(
        "_bucket", "_bit", "_marks"
    )
