"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of seven bytes ends a chunk wherever it is block size - 1 modulo the block size; each chunk's own hash
gives one of 64 letters. The block size (3 times a power of two) follows the length, and falls while the signature is
short. A fingerprint is ``block size:letters:letters at twice the block size``. Two fingerprints are compared by
edit distance where their block sizes are equal or one step apart.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, releasing

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
SMALLEST, LETTERS, WINDOW = 3, 64, 7
_FACTOR = 0x2C1B3C6D
_LETTER = np.frombuffer(ALPHABET.encode(), dtype=np.uint8)


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last seven bytes at each byte (fewer at the start), 32 bits."""
    x = data.astype(np.uint32) + np.uint32(1)
    out = x.copy()
    factor = 1
    for k in range(1, min(WINDOW, len(x))):
        factor = factor * _FACTOR & 0xFFFFFFFF
        out[k:] += x[:-k] * np.uint32(factor)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x297A2D39)
    out ^= out >> np.uint32(16)
    return out


def _signature(prefix: Rolling, ends: np.ndarray, n: int, most: int) -> str:
    """Letters of the chunks that end at ``ends``; the last letter stands for all the rest."""
    ends = ends[: most - 1]
    stops = ends if len(ends) and ends[-1] == n else np.r_[ends, n]
    starts = np.r_[0, stops[:-1]]
    return _LETTER[(prefix.runs(starts, stops) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(text: str | None) -> str:
    """Fingerprint of the whole text in UTF-8; null counts as empty. Uses some 40 bytes of memory a byte of text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    n = len(data)
    if not n:
        return f"{SMALLEST}::"
    size = SMALLEST
    while size * LETTERS < n:
        size *= 2
    hashes = rolling(data)
    while True:
        ends = np.flatnonzero(hashes % np.uint32(size) == size - 1) + 1
        if size == SMALLEST or len(ends) >= LETTERS // 2:
            break
        size //= 2
    twice = ends[hashes[ends - 1] % np.uint32(2 * size) == 2 * size - 1]
    prefix = Rolling(data.astype(np.uint64) + np.uint64(1))
    return f"{size}:{_signature(prefix, ends, n, LETTERS)}:{_signature(prefix, twice, n, LETTERS // 2)}"


def indel_distance(a: str, b: str) -> int:
    """Insertions and deletions that turn ``a`` into ``b``: bit-parallel longest common subsequence."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = row & places.get(c, 0)
        row = (row + match | row - match) & full
    return len(a) + len(b) - 2 * (len(a) - row.bit_count())


def _likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    gram = min(WINDOW, max(1, min(len(a), len(b)) // 3))  # chance alone gives no run of as many letters
    have = {a[k : k + gram] for k in range(len(a) - gram + 1)}
    if not any(b[k : k + gram] in have for k in range(len(b) - gram + 1)):
        return 0.0
    return 1 - indel_distance(a, b) / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 where block sizes are more than a step apart."""
    if one == two:
        return 1.0
    (s1, a1, b1), (s2, a2, b2) = one.split(":"), two.split(":")
    x, y = int(s1), int(s2)
    if x == y:
        return max(_likeness(a1, a2), _likeness(b1, b2))
    if x == 2 * y:
        return _likeness(a1, b2)
    if y == 2 * x:
        return _likeness(b1, a2)
    return 0.0


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many (or all) from the start of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (part, head, place): each with the one after it; a part ends with the head of the next, which gives no row."""
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    held = None  # part, id, text, fingerprint of the row that waits for its next
    for batch in batches:
        rows = []
        for part, head, doc, text in zip(batch["part"], batch["head"], batch["doc"], batch["text"]):
            text = text or ""
            if head and held is None:
                continue
            print_ = fingerprint(text)
            if held is not None:
                _, d, t, f = held
                changed = edited(t, text)
                g = fingerprint(changed)
                rows.append((d, len(t), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), f, g, likeness(f, g), likeness(f, print_)))
            held = None if head else (part, doc, text, print_)
        out = pd.DataFrame(rows, columns=cols)
        out["doc_id"] = out["doc_id"].astype("Int64")
        yield out


def _parts(rows: DataFrame, n: int) -> DataFrame:
    """Adds ``part``: about ``n`` ranges of (doc, hash), numbered in their order.

    Ranges lie between approximate quantiles of doc. An id that fills several of them (nulls, which have one value, or a
    repeated id) gets as many ranges of the hash.
    """
    from pyspark.ml.feature import Bucketizer

    points = sorted(rows.approxQuantile("doc", [k / n for k in range(1, n)], 0.25 / n)) if n > 1 else []
    ends = sorted(set(points))
    exact = lambda x: abs(x) < 2**53 or x == -(2.0**63)  # noqa: E731  a double that stands for one id
    table, base = [], 0
    for k, value in enumerate([None, *ends]):
        hot = points.count(value) if value is not None and exact(value) and points.count(value) > 1 else 0
        table.append((float(k), base, hot, int(value) if hot else None))
        base += hot + 1
    ranges = rows.sparkSession.createDataFrame(table, "_k double, base int, hot int, value long")  # at most n rows
    numbered = Bucketizer(
        splits=[-math.inf, *ends, math.inf], inputCol="_place", outputCol="_k"
    ).transform(rows.withColumn("_place", F.col("doc").cast("double"))) if ends else rows.withColumn("_place", F.lit(0.0)).withColumn("_k", F.lit(0.0))
    place = (F.col("hash").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)  # of the hash, from 0 to 1
    within = F.when(F.col("doc") == F.col("value"), F.least(F.col("hot") - 1, F.floor(place * F.col("hot")).cast("int"))).otherwise(F.col("hot"))
    return numbered.join(F.broadcast(ranges), "_k").withColumn("part", F.col("base") + within).drop("_k", "_place", "base", "hot", "value")


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id, after the smallest the largest; rows of equal ids follow
    each other by a hash of their texts, null ids come last. Null texts count as empty; an empty table gives no
    rows, a single row is its own next; texts of any length are read whole. Other columns are not read.

    The texts move once: to ranges of ids, in order, each with the first row of the range that follows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("doc"), F.col(id_col).isNull().alias("void"),
        F.col(text_col).alias("text"), F.xxhash64(text_col).alias("hash")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _parts(rows, 8 * parts)
    # first row of each part, in the order of descending ids: a row for each part
    heads = rows.groupBy("part").agg(F.max(F.struct("doc", "hash")).alias("top")).select("part", "top.doc", "top.hash").collect()
    heads.sort(key=lambda r: -r["part"])
    after = [(heads[(k + 1) % len(heads)]["doc"], heads[(k + 1) % len(heads)]["hash"], r["part"]) for k, r in enumerate(heads)]
    nexts = F.broadcast(spark.createDataFrame(after, "doc long, hash long, part int"))
    tails = rows.drop("part").join(nexts, ["doc", "hash"]).select("part", F.lit(1).alias("head"), "doc", "hash", "void", "text")
    every = rows.select("part", F.lit(0).alias("head"), "doc", "hash", "void", "text").unionByName(tails)
    dealt = every.repartition(parts, "part").sortWithinPartitions("part", "head", F.desc("doc"), F.desc("hash"))
    dealt = dealt.select("part", "head", F.when(~F.col("void"), F.col("doc")).alias("doc"), "text")
    return dealt.mapInPandas(
        releasing(_compare),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def op3_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Every document, its edited text and its next document."""
    return fingerprint_neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet"))
