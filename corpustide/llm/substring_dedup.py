"""Exact substring deduplication by seed and extend.

Winnowing (the smallest hash of every run of ``window - seed + 1`` seeds is an anchor) puts at least one anchor of
``seed`` words into every window of ``window`` words, chosen by the window's content alone. So each window has one
canonical anchor, and equal windows have equal ones. An occurrence of an anchor stands for the region of all windows
that have it as theirs. Regions are joined on anchors:

* a region equal to one in a document with a smaller id is a repeat as it stands (copies meet here, one row each);
* what is left of an anchor with several different regions, one representative for each, is extended both ways:
  every window of it is looked up among the windows of the other representatives, by (anchor, place, hash).

Overlapping windows then merge into maximal repeats. Groups are only ever aggregated to their smallest document id,
never expanded into pairs, so the work grows with the occurrences, not with their square.

Identity of words and windows is that of 128 bits of hash (anchor and region or window).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASES, Rolling, WordHashes, mixed, releasing, sliding_min, stored

#: Bits of a seed's order key that hold its place, so that of equal hashes the rightmost wins; longer documents go in
#: segments of so many windows.
PLACE_BITS = 28
SEGMENT = 1 << 27


def _words(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`; bytes.split() splits at just these six characters."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def regions(hashes: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, ...]:
    """Of one document: anchor's hash, region's hash, first and last window, and anchor's place in the first window."""
    if len(hashes) < window:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    one, two = Rolling(hashes, BASES[0]), Rolling(hashes, BASES[1])
    seeds = one.windows(seed)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    windows = len(hashes) - window + 1
    at = np.empty(windows, dtype=np.int64)
    for low in range(0, windows, SEGMENT):
        some = seeds[low : min(low + SEGMENT, windows) + window - seed]
        keys = (some & ~mask) | (mask - np.arange(len(some), dtype=np.uint64))
        at[low : low + SEGMENT] = low + (mask - (sliding_min(keys, window - seed + 1) & mask)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], len(at)] - 1
    place = at[first] - first
    shape = (place * 1_000_003 + (last - first)).astype(np.uint64)
    return seeds[at[first]], mixed(two.runs(first, last + window) + shape * np.uint64(BASES[0])), first, last, place


def _find(window: int, seed: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, key, text in zip(batch["doc"], batch["key"], batch["text"]):
                anchor, region, first, last, place = regions(known.of(_words(text)), window, seed)
                if len(first):
                    rows.append((anchor.view(np.int64), region.view(np.int64), np.full(len(first), doc), np.full(len(first), key), first, last, place))
            cols = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 7
            yield pd.DataFrame(dict(zip(("anchor", "region", "doc", "key", "first", "last", "place"), cols)))

    return releasing(run)


def _extend(window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, key, text, spans in zip(batch["doc"], batch["key"], batch["text"], batch["spans"]):
                every = Rolling(known.of(_words(text)), BASES[1]).windows(window).view(np.int64)
                anchor, first, last, place = (np.array([s[k] for s in spans], dtype=np.int64) for k in ("anchor", "first", "last", "place"))
                size = last - first + 1
                step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                at = np.repeat(first, size) + step
                rows.append((np.repeat(anchor, size), np.repeat(place, size) - step, every[at], np.full(len(at), doc), np.full(len(at), key), at))
            cols = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 6
            yield pd.DataFrame(dict(zip(("anchor", "place", "hash", "doc", "key", "at"), cols)))

    return releasing(run)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, seed: int = 25) -> DataFrame:
    """Rows (doc, key, first, last): windows ``first`` to ``last`` of the document also start in one with a smaller id.

    ``key`` is a hash of the text, which tells apart rows that share an id. Rows with a null id neither repeat nor are
    repeated; null and short texts have no windows. Rows with equal ids are one document: no window repeats there.
    """
    from_docs = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")
    ).filter("doc is not null and text is not null")
    kinds = "anchor long, region long, doc long, key long, first long, last long, place long"
    found = stored(from_docs.mapInPandas(_find(window, seed), kinds), "anchors")
    shared = stored(
        found.groupBy("anchor").agg(
            F.min("doc").alias("lo"), F.max("doc").alias("hi"), (F.min("region") != F.max("region")).alias("several")
        ).filter("lo < hi").select("anchor", "several"),
        "shared"
    )
    found = stored(found.join(shared, "anchor"), "recurring")
    classes = stored(
        found.groupBy("anchor", "region").agg(
            F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.max("several").alias("several")
        ).filter("lo < hi or several").select("anchor", "region", "lo"),
        "classes"
    )
    known = stored(found.join(classes, ["anchor", "region"]), "known")
    whole = known.filter("doc > lo").select("doc", "key", "first", "last")
    spans = known.filter("doc = lo and several").groupBy("doc", "key").agg(F.collect_list(F.struct("anchor", "first", "last", "place")).alias("spans"))
    parts = stored(
        from_docs.join(spans, ["doc", "key"]).mapInPandas(_extend(window), "anchor long, place long, hash long, doc long, key long, at long"),
        "windows"
    )
    again = stored(
        parts.groupBy("anchor", "place", "hash").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("anchor", "place", "hash", "lo"),
        "again"
    )
    extended = parts.join(again, ["anchor", "place", "hash"]).filter("doc > lo").select("doc", "key", F.col("at").alias("first"), F.col("at").alias("last"))
    return whole.unionByName(extended)


def _cut(window: int, texts: bool):
    import hashlib

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept": [], "spans": []}
            for text, first, last in zip(batch["text"], batch["first"], batch["last"]):
                words = _words(text)
                spans: list[dict] = []
                kept = words
                if first is not None and len(first):
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, np.asarray(first, dtype=np.int64), 1)
                    np.add.at(edge, np.asarray(last, dtype=np.int64) + window, -1)
                    gone = np.r_[0, (np.cumsum(edge)[:-1] > 0).astype(np.int8), 0]
                    starts, ends = np.flatnonzero(np.diff(gone) == 1), np.flatnonzero(np.diff(gone) == -1)
                    spans = [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends)]
                    kept, at = [], 0
                    for a, b in zip(starts, ends):
                        kept += words[at:a]
                        at = b
                    kept += words[at:]
                joined = b" ".join(kept)
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                out["kept"].append(joined.decode("utf-8", "surrogatepass") if texts else None)
                out["spans"].append(spans)
            yield pd.DataFrame({"doc_id": batch["id"]} | out)

    return releasing(run)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, seed: int = 25, texts: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256, kept (text without repeats), spans (maximal repeats, in words).

    Null and empty texts have no words, and the SHA-256 of the empty string; null ids keep all their words; repeated
    rows each get a row; of equal passages the one in the smallest id stays. An empty table gives no rows; texts of any
    length are read whole, by one task each. Other columns of ``docs`` are not read. Without ``texts``, kept is null.
    """
    if not 1 <= seed < window:
        raise ValueError("seed must be shorter than window")
    found = repeats(docs, id_col, text_col, window, seed).groupBy("doc", "key").agg(
        F.collect_list("first").alias("first"), F.collect_list("last").alias("last")
    )
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    joined = rows.join(found, (rows["id"] == found["doc"]) & (rows["hash"] == found["key"]), "left").select("id", "text", "first", "last")
    return joined.mapInPandas(
        _cut(window, texts),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, spans array<struct<start: long, end: long>>"
    )


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Windows of 50 words over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs, texts=False).select("doc_id", "n_words", "n_removed", "kept_sha256")
