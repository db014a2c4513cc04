"""A large table cut down, before it is moved, to the keys that a small one may ask for.

The small table's keys become a Bloom filter: every key sets a few bits by its hashes, and one aggregate combines them to
64-bit words, in each task first. The words are broadcast to the large table's scan, which keeps the rows whose bits are
all set: every row that is asked for, and about one in a hundred others. An exact join follows. The number of words is
known before they are made, from a count of the keys; where there would be too many, the large table stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, hashes of a key, and bits at most: a quarter of a million words, for 1.6 million keys.
BITS, HASHES, MOST = 10, 4, 1 << 24


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), key), F.lit(bits).cast("bigint")) for k in range(HASHES)]


def bits_for(keys: int) -> int | None:
    """Bits of a filter for so many keys, a power of two; None where it would be too large to broadcast."""
    bits = 1 << max(6, (keys * BITS - 1).bit_length())
    return bits if bits <= MOST else None


def words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """The filter: (word, mask), at most ``bits`` / 64 rows."""
    places = keys.filter(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("p"))
    # one and the same bit may be set by many keys, so places are told apart before their bits are put together
    return places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("mask"))


def passing(rows: DataFrame, key: str, filter_: DataFrame, bits: int) -> DataFrame:
    """The rows of a table whose key may be one of the filter's: all that are, and few others. Null keys are none of them."""
    out, columns = rows, rows.columns
    small = F.broadcast(filter_.select(F.col("word").alias("_word"), F.col("mask").alias("_mask")))
    for place in _places(F.col(key), bits):
        out = out.filter(F.col(key).isNotNull()).withColumn("_p", place)
        hit = (F.shiftright("_p", 6) == F.col("_word")) & (F.expr("shiftrightunsigned(_mask, cast(_p % 64 as int)) & 1L") == 1)
        out = out.join(small, hit).select(*columns)
    return out


def asked_for(large: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """``large`` without most of the rows whose key ``small`` does not have; whole where the filter would be too large."""
    keys = small.select(key).distinct()
    bits = bits_for(keys.count())
    return large if bits is None else passing(large, key, words(keys, key, bits), bits)
