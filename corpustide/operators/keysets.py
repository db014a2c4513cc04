"""Exact sets of keys as bitmaps, merged a shard at a time and counted without a join.

A key with a platform number ('eis:' and digits) is a bit: its number's bucket of 32,768 and its place there. A set is a
row for each bucket that has any (4 KiB); keys of other kinds are rows of their own. Sets are made by one aggregate that
combines in each task, so a key that is named a billion times moves once from each; the union of sets is the same
aggregate over their rows. What two sets share, or one has beyond another, follows from the sizes of unions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest number that is kept as a bit; dense up to there, as the platform deals its numbers one after another.
MOST = 2**53


def keyset(keys: DataFrame, key: str = "key") -> DataFrame:
    """Rows (bucket, text, bits) of a table of keys: null keys are in no set, a key counts once however often it is named."""
    digits = F.regexp_extract(key, r"^eis:(0|[1-9][0-9]{0,15})$", 1)
    number = F.when(digits != "", digits).cast("bigint")
    number = F.when(number < MOST, number)
    rows = keys.filter(F.col(key).isNotNull()).select(number.alias("n"), F.when(number.isNull(), F.col(key)).alias("text"))
    bucket, place = F.bitmap_bucket_number(F.col("n")), F.bitmap_bit_position(F.col("n"))
    # texts take one bit of a row of their own, so that one aggregate makes both kinds
    rows = rows.select(bucket.alias("bucket"), "text", F.coalesce(place, F.lit(0).cast("bigint")).alias("place"))
    return rows.groupBy("bucket", "text").agg(F.bitmap_construct_agg("place").alias("bits"))


def union(*sets: DataFrame) -> DataFrame:
    """All keys of all sets, which may be of different shards or of earlier unions."""
    return reduce(DataFrame.unionByName, sets).groupBy("bucket", "text").agg(F.bitmap_or_agg("bits").alias("bits"))


def size(set_: DataFrame) -> Column:
    """How many keys: an aggregate over a set's rows."""
    return F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long")


def sizes(**sets: DataFrame) -> DataFrame:
    """One row: the size of each set, by its name."""
    named = [s.select(F.lit(name).alias("set"), "bits") for name, s in sets.items()]
    of = lambda name: F.coalesce(F.sum(F.when(F.col("set") == name, F.bitmap_count("bits"))), F.lit(0)).cast("long").alias(name)
    return reduce(DataFrame.unionByName, named).agg(*[of(name) for name in sets])


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (n): keys that both sets have."""
    return sizes(a=a, b=b, both=union(a, b)).select((F.col("a") + F.col("b") - F.col("both")).alias("n"))


def coverage(targets: DataFrame, excused: DataFrame, delivered: DataFrame) -> DataFrame:
    """One row: targets, delivered, excused (of the targets), unaccounted (targets neither excused nor delivered)."""
    settled = union(excused, delivered)
    row = sizes(targets=targets, delivered=delivered, e=excused, te=union(targets, excused), settled=settled, whole=union(targets, settled))
    return row.select(
        "targets", "delivered", (F.col("targets") + F.col("e") - F.col("te")).alias("excused"), (F.col("whole") - F.col("settled")).alias("unaccounted")
    )
