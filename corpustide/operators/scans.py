"""The queue of scans for character recognition, its cache, and the run over it."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values as V
from . import prefilter


class Quota(Exception):
    """A provider will answer no more today."""


def first_paths(files: DataFrame, order: list[str]) -> DataFrame:
    """(sha256, path): of a digest that several files have the first path."""
    return files.filter(F.coalesce("sha256", F.lit("")) != "").groupBy("sha256").agg(F.min_by("path", F.struct(*order)).alias("kept_path"))


def queue(
    gaps: DataFrame, paths: DataFrame, reasons: tuple[str, ...] = V.SCAN_REASONS, limit: int | None = None,
    size_limit: int | None = V.INLINE_LIMIT
) -> DataFrame:
    """Every gap (file, bytes, sha256, reason, path, pos) with ``send_path`` and, where it is not sent, ``skipped``; the first rule that holds decides.

    The run limit takes gaps in their order. Positions among those to send are counted by ranges, then within them.
    """
    ext = F.lower(F.regexp_extract(F.coalesce("file", F.lit("")), r"(\.[^./]*)$", 1))
    wanted = F.lit(False)
    for r in reasons:
        wanted = wanted | F.contains(F.coalesce("reason", F.lit("")), F.lit(r))
    rows = gaps.join(paths, "sha256", "left")
    rule = (
        F.when(ext.isin(*V.DRAWINGS), "drawing-not-sent")
        .when(~(wanted | ext.isin(*V.SCAN_IMAGES)), "reason-not-selected")
        .when(F.coalesce("sha256", F.lit("")) == "", "no-digest-to-cache-by")
        .when(F.coalesce("path", F.lit("")) != "", None)
        .when(F.col("kept_path").isNull(), "source-not-retained")
    )
    if size_limit is not None:
        rule = rule.when(F.coalesce("bytes", F.lit(0)) > size_limit, "too-large-for-inline-upload")
    out = rows.withColumn("skipped", rule)
    if limit is not None:
        bucket = F.floor(F.col("pos") / 10_000)
        sent = out.filter("skipped is null").select("pos", bucket.alias("_b"))
        before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        firsts = sent.groupBy("_b").agg(F.count("*").alias("n")).select("_b", before.alias("_first"))
        nth = sent.withColumn("_n", F.row_number().over(Window.partitionBy("_b").orderBy("pos"))).join(firsts, "_b").select("pos", (F.col("_first") + F.col("_n")).alias("_nth"))
        out = out.join(nth, "pos", "left").withColumn("skipped", F.when(F.col("_nth") > limit, "over-the-run-limit").otherwise(F.col("skipped"))).drop("_nth")
    path = F.when(F.col("skipped").isNull(), F.coalesce(F.nullif("path", F.lit("")), "kept_path"))
    return out.select("pos", "file", "bytes", "sha256", "reason", path.alias("send_path"), "skipped")


def split_cached(queued: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hits with their text, misses). The cache counts only where a digest has both text and provenance.

    The cache may be a thousand times the queue: only rows that the queue's digests may ask for are moved.
    """
    whole = prefilter.asked_for(cache.filter("text is not null and provenance is not null").select("sha256", "text"), queued, "sha256")
    return queued.join(whole, "sha256"), queued.join(whole.select("sha256"), "sha256", "left_anti")


class Provider(NamedTuple):
    """A reader: function from (bytes, path) to text; whether it needs a key; its model; the bytes it takes at most."""

    read: Callable[[bytes, str], str]
    keyed: bool = False
    model: str = ""
    ceiling: int | None = V.INLINE_LIMIT


#: Providers by name; a reader of one's own is added here, on every machine that runs tasks.
PROVIDERS: dict[str, Provider] = {}


def provider(name: str, environ: dict[str, str], key: str = "") -> Provider:
    """A provider by name; the error names what is missing, never a value."""
    if name not in PROVIDERS:
        raise KeyError(f"no provider {name!r}; there are: {', '.join(sorted(PROVIDERS)) or 'none'}")
    if PROVIDERS[name].keyed and not environ.get(key, "").strip():
        raise ValueError(f"{key} is not set")
    return PROVIDERS[name]


def prompt_digest(prompt: str) -> str:
    """What a result depends on besides the file and the model."""
    return hashlib.sha256(prompt.encode()).hexdigest()


def run(
    misses: DataFrame, reader: Callable[[bytes, str], str], load: Callable[[str], bytes], pause: float = 0.0,
    sleep: Callable[[float], None] = time.sleep
) -> DataFrame:
    """Read each row (sha256, send_path, pos) in order: sha256, outcome (read, empty, failed, deferred), text, error.

    One task, because a quota ends the run for all that follow; so rows are addresses, and ``load`` gives a file's bytes
    when its turn comes. An error of the reader, or of the load, skips its own file only. Between two calls it waits for
    ``pause`` seconds.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        spent, calls = False, 0
        for batch in batches:
            out = []
            for digest, path in zip(batch["sha256"], batch["send_path"]):
                outcome, text, error = "deferred", None, None
                if not spent:
                    if calls and pause:
                        sleep(pause)
                    calls += 1
                    try:
                        text = reader(load(path), path)
                        outcome = "read" if text.strip() else "empty"
                    except Quota as e:
                        spent, error = True, str(e)
                    except Exception as e:  # a provider may raise anything; its file is named, the run goes on
                        outcome, error = "failed", str(e)[:200]
                out.append((digest, outcome, text, error))
            yield pd.DataFrame(out, columns=["sha256", "outcome", "text", "error"]).astype(object)

    return misses.select("sha256", "send_path", "pos").coalesce(1).sortWithinPartitions("pos").mapInPandas(read, "sha256 string, outcome string, text string, error string")


def plan(queued: DataFrame, cache: DataFrame) -> DataFrame:
    """What a run would do with each gap, without calling anyone: adds ``step`` (skip, cached, call)."""
    hits, misses = split_cached(queued.filter("skipped is null"), cache)
    steps = hits.drop("text").withColumn("step", F.lit("cached")).unionByName(misses.withColumn("step", F.lit("call")))
    return steps.unionByName(queued.filter("skipped is not null").withColumn("step", F.lit("skip")))


def results(rows: DataFrame, name: str, model: str, prompt: str, at: Column) -> DataFrame:
    """Read texts as they are kept: sha256, text, provenance (JSON: provider, model, digest of the prompt, time). Only a read text is kept, each digest once."""
    about = F.to_json(F.struct(
        F.lit(name).alias("provider"), F.lit(model).alias("model"), F.lit(prompt_digest(prompt)).alias("prompt_sha256"),
        at.cast("string").alias("read_at")
    ))
    kept = rows.filter("outcome = 'read' and coalesce(sha256, '') <> ''").groupBy("sha256").agg(F.min("text").alias("text"))
    return kept.select("sha256", "text", about.alias("provenance"))


def totals(results: DataFrame) -> DataFrame:
    return results.agg(
        *[F.count_if(F.col("outcome") == k).alias(k) for k in ("read", "empty", "failed", "deferred")],
        F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("chars")
    )
