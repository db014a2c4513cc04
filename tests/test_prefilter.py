"""A filter of the keys that are asked for: none of them is lost, few others stay, and the exact answer is the same."""

import hashlib

from pyspark.sql import functions as F

from corpustide.operators import prefilter, scans


def _digest(k):
    return hashlib.sha256(str(k).encode()).hexdigest()


def test_passing(spark):
    small = spark.createDataFrame([(_digest(k),) for k in range(500)] + [(None,), (_digest(3),)], "sha256 string")
    large = spark.range(60_000).select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("sha256"), "id").unionByName(spark.createDataFrame([(None, 9)], "sha256 string, id long"))
    kept = {r["id"] for r in prefilter.asked_for(large, small, "sha256").collect()}
    assert kept >= set(range(500)) and len(kept) < 500 + 60_000 * 0.03
    assert prefilter.asked_for(large, small.filter("false"), "sha256").count() == 0
    assert prefilter.asked_for(large.filter("false"), small, "sha256").count() == 0


def test_size():
    assert prefilter.bits_for(0) == 64 and prefilter.bits_for(100) == 1024 and prefilter.bits_for(1_600_000) == prefilter.MOST and prefilter.bits_for(2_000_000) is None


def test_too_many_keys(spark, monkeypatch):
    """Beyond the bound the table stays whole, and so is the answer."""
    monkeypatch.setattr(prefilter, "MOST", 64)
    large, small = spark.range(100).select(F.col("id").cast("string").alias("k")), spark.range(50).select(F.col("id").cast("string").alias("k"))
    assert prefilter.asked_for(large, small, "k").count() == 100


def test_cache(spark, tmp_path):
    queue = spark.createDataFrame([(k, _digest(k * 100)) for k in range(40)] + [(99, None)], "pos long, sha256 string")
    rows = spark.range(30_000).filter("id % 200 = 0 or id % 7 = 0")
    cache = rows.select(F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("sha256"), F.concat(F.lit("t"), "id").alias("text"), F.when(F.col("id") != 400, "{}").alias("provenance"))
    cache.write.parquet(str(tmp_path / "thecache"))
    hits, misses = scans.split_cached(queue, spark.read.parquet(str(tmp_path / "thecache")))
    there = {k for k in range(40) if (k * 100 % 200 == 0 or k * 100 % 7 == 0) and k != 4}
    assert {(r["pos"], r["text"]) for r in hits.collect()} == {(k, f"t{k * 100}") for k in there}
    assert {r["pos"] for r in misses.collect()} == {*range(40), 99} - there
    # what is moved of the cache is moved above the filter's joins
    again = scans.split_cached(queue, spark.read.parquet(str(tmp_path / "thecache")))[1]
    lines = again._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(k for k, line in enumerate(lines) if "thecache" in line)
    path, depth = [], len(lines[scan])
    for line in reversed(lines[: scan + 1]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            path, depth = [*path, line[at:]], at
    moved = next(k for k, node in enumerate(path) if "Exchange" in node)
    assert sum("BroadcastHashJoin" in node for node in path[:moved]) == prefilter.HASHES
