"""An append-only journal that executors write to: segments named by batch, each whole or not there.

A batch's lines are one folder of JSON lines, written by tasks; Spark's marker says that it is whole. A batch that is
replayed finds its segment there and adds nothing; one that was broken off left a folder without a marker, which readers
pass over and the replay writes anew. Lines keep their batch and their place in it, so the last line of an id is known
whatever file it is in; lines that cannot be read are passed over. Compaction writes the last lines of all ids as a base
that takes the place of the segments before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed
from .delivery import Store

_LINE = "batch bigint, pos bigint, entry string"


def _whole(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Numbers of the segments, or bases, that are whole."""
    store = Store(spark, root)
    names = [n for n in store.names(kind) if n.isdigit()]
    return [int(n) for n in names if store.fs.exists(store.at(f"{kind}/{n}/_SUCCESS"))]


def append(rows: DataFrame, root: str, batch: int, pos: str = "pos") -> bool:
    """Write a batch's entries (an id, any columns, and ``pos``, their place) as its segment; False where it is there already.

    As a stream's sink: ``foreachBatch(lambda df, n: append(df, root, n))``.
    """
    spark = rows.sparkSession
    if batch in _whole(spark, root, "segments") or any(b >= batch for b in _whole(spark, root, "bases")):
        return False
    entry = F.to_json(F.struct(*[c for c in rows.columns if c != pos]))
    lines = rows.select(F.lit(batch).cast("bigint").alias("batch"), F.col(pos).cast("bigint").alias("pos"), entry.alias("entry"))
    lines.select(F.to_json(F.struct("batch", "pos", "entry")).alias("value")).write.mode("overwrite").text(f"{root}/segments/{batch:012d}")
    return True


def lines(spark: SparkSession, root: str) -> DataFrame:
    """(batch, pos, entry) of the latest base and of the segments after it, torn ones and torn lines left out."""
    bases = _whole(spark, root, "bases")
    after = max(bases, default=-1)
    at = [f"{root}/bases/{b:012d}" for b in bases if b == after] + [f"{root}/segments/{n:012d}" for n in _whole(spark, root, "segments") if n > after]
    if not at:
        return spark.createDataFrame([], _LINE)
    return spark.read.text(at).select(F.from_json("value", _LINE, {"mode": "PERMISSIVE"}).alias("l")).select("l.*").filter("pos is not null and batch is not null")


def last(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The journal's state: of each id its last entry, as columns of ``schema`` (which has ``id``)."""
    return keyed.replay(lines(spark, root).select(F.struct("batch", "pos").alias("line"), F.col("entry").alias("value")), schema=schema)


def compact(spark: SparkSession, root: str) -> int | None:
    """Put the last line of each id in place of all segments that are whole; the number of the base, or None where there is nothing to do.

    Segments are removed once the base is whole: a reader in between takes the base and passes over them. Entries without
    an id, which no state shows, go.
    """
    there = _whole(spark, root, "segments")
    if not there:
        return None
    upto = max(there)
    kept = keyed.last_per_key(lines(spark, root).withColumn("id", F.get_json_object("entry", "$.id")).filter("id is not null"), ["id"], ["batch", "pos"])
    kept.select(F.to_json(F.struct("batch", "pos", "entry")).alias("value")).write.mode("overwrite").text(f"{root}/bases/{upto:012d}")
    store = Store(spark, root)
    for kind, old in (("segments", lambda n: n <= upto), ("bases", lambda n: n < upto)):
        for name in store.names(kind):
            if name.isdigit() and old(int(name)):
                store.remove(f"{kind}/{name}")
    return upto
