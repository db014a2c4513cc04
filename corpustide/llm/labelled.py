"""Labelled rows to learn from: a bounded sample, the same whatever the number of partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; rows where it is 1 are held out."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3))


def held_out(id_col: str) -> Column:
    """Null ids are never learned from, so they count as held out."""
    return F.coalesce(remainder(id_col) == 1, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, limit: int) -> DataFrame:
    """Rows (text, label) of at most ``limit`` labelled documents of each class, none of them held out.

    Which ones is decided by a hash of the id. Ids with labels other than 0 and 1, or with both, are left out. The
    list of ids that is broadcast has at most ``2 * limit`` rows.
    """
    clean = labels.select(
        F.col(id_col).cast("long").alias("doc"), F.col(label_col).cast("int").alias("label")
    ).filter(~held_out("doc") & F.col("label").isin(0, 1))
    single = clean.groupBy("doc").agg(F.min("label").alias("label"), F.max("label").alias("other")).filter("label = other").select("doc", "label")
    there = {r["label"]: r["n"] for r in single.groupBy("label").agg(F.count("*").alias("n")).collect()}
    place = F.shiftrightunsigned(F.xxhash64("doc"), 11) / F.lit(float(2**53))  # in [0, 1)

    def pick(y: int) -> DataFrame:
        # few rows beyond the limit ever meet: the first cut is by the share that fills it half again
        mine = single.filter((F.col("label") == y) & (place < 1.5 * limit / max(1, there.get(y, 0))))
        return mine.orderBy(place, "doc").limit(limit)

    ids = pick(0).unionByName(pick(1))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(ids), "doc").select("text", "label")
