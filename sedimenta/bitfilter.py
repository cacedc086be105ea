"""A filter over the keys of a DataFrame, built and probed with Spark's bitmap functions.

It has no false negatives. Its size follows the number of keys, BITS_A_KEY for each, between one bucket and MOST_BITS (8 MiB),
so it can be sent to every task. From some 4 million keys on it fills: at 67 million keys, one bit for each, two rows of three
pass it that needn't, and far beyond all do. These go through the join that follows, so results stay exact and the cost tends
to one shuffle of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.files import written

#: Bits for each key, and the most bits of a filter.
BITS_A_KEY = 16
MOST_BITS = 1 << 26
#: Bits that Spark's bitmap functions keep in one bucket.
BUCKET_BITS = 32768


class KeyFilter:
    """The filter over a column of keys (computed once, as it is counted and read)."""

    def __init__(self, keys: DataFrame, key: str):
        keys = written(keys.select(F.xxhash64(key).alias("_h")), "filter-keys")
        self.bits = min(MOST_BITS, max(BUCKET_BITS, 1 << (BITS_A_KEY * keys.count() - 1).bit_length()))
        slot = F.pmod(F.col("_h"), F.lit(self.bits))
        at = keys.select((slot / BUCKET_BITS).cast("long").alias("_bucket"), (slot % BUCKET_BITS).alias("_bit"))
        #: MOST_BITS / BUCKET_BITS rows of 4 KiB at most.
        self.buckets = written(at.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "filter")

    def probed(self, rows: DataFrame, key: str | Column) -> DataFrame:
        """rows with _hit, false only if the key isn't among the filter's."""
        slot = F.pmod(F.xxhash64(key), F.lit(self.bits))
        out = rows.withColumn("_slot", slot).withColumn("_bucket", (F.col("_slot") / BUCKET_BITS).cast("long"))
        out = out.join(F.broadcast(self.buckets), "_bucket", "left")
        bit = F.col("_slot") % BUCKET_BITS
        byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) > 0, F.lit(False))
        return out.withColumn("_hit", hit).drop("_bucket", "_slot", "_bits")
