"""Text, JSON-lines, tab-separated and binary files as tables with their positions."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value): lines of one file in order. The file is read whole, as its lines count from its start."""
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))
    return rows.filter("value <> ''")


def read_journal(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Last state of each id in an append-only journal of JSON lines."""
    return keyed.replay(numbered_lines(spark, path), schema=schema)


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """(target, pos) of a target list."""
    lines = numbered_lines(spark, path)
    cleaned = F.trim(F.split_part(F.replace("value", F.lit("﻿"), F.lit("")), F.lit("#"), F.lit(1)))
    return lines.select(cleaned.alias("target"), F.col("line").alias("pos")).filter("target <> ''")


def read_resolutions(spark: SparkSession, path: str) -> DataFrame:
    """(asked, found) of a tab-separated list, without what found nothing."""
    return keyed.resolutions(spark.read.csv(path, sep="\t", schema="asked string, found string"))


def read_binary(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, content) of files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("bytes"), "content")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate files that driver and tasks share: below ``spark.checkpoint.dir``; without it a local session has one of its own."""
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir")
    if not at:
        master = conf.get("spark.master") or ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and tasks share")
        at = "file://" + tempfile.mkdtemp(prefix="corpustide-")
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def load_policy(source: str | None) -> dict[str, list[str]] | None:
    """A recall policy from JSON text or a path; whatever is wrong with it, there is no policy and nothing is left out."""
    if not source or not source.strip():
        return None
    try:
        text = source if source.lstrip().startswith("{") else open(source, encoding="utf-8").read()
        raw = json.loads(text)
    except (OSError, ValueError):
        return None
    recall = raw.get("recall_title_terms") if isinstance(raw, dict) else None
    if not recall:
        return None
    return {"recall": list(recall), "prefixes": list(raw.get("hard_exclude_prefixes") or ()), "excluded": list(raw.get("hard_exclude_title_terms") or ())}


def setting(name: str, environ: dict[str, str] | None = None) -> str:
    """A setting from the environment; the error names the variable, never a value."""
    value = (os.environ if environ is None else environ).get(name, "").strip()
    if not value:
        raise ValueError(f"{name} is not set")
    return value
