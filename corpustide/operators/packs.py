"""What a pack is written as: manifest, totals, facts and the archive of its originals; and tallies over its files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..sources import publish

#: A file in a record of the manifest, in the order of its columns.
FILE = ("filename", "original_name", "path", "size", "sha256", "duplicate")
ABOUT = ("id", "section", "title", "type_code", "publish_date")


def records(rows: DataFrame) -> DataFrame:
    """One row a record of a download (see :func:`corpustide.sources.fetch.fetch`): pid, the record's own columns, withheld, files in the order of their paths."""
    files = F.array_sort(F.collect_list(F.when(F.col("path").isNotNull(), F.struct(F.col("path"), *[F.col(c) for c in FILE if c != "path"]))))
    about = [F.max(c).alias(c) for c in ABOUT[1:]]
    found = rows.withColumnRenamed("record_id", "id") if "record_id" in rows.columns else rows
    return found.filter("id is not null").groupBy("pid", "id").agg(*about, F.bool_and("withheld").alias("withheld"), files.alias("files"))


def manifests(rows: DataFrame) -> DataFrame:
    """(pid, path, content): manifest.json of each pack, its records by id with their files, and those withheld."""
    one = F.struct(*ABOUT, "files")
    kept = lambda withheld: F.array_sort(F.collect_list(F.when(F.col("withheld") == withheld, one)))
    by = records(rows).groupBy("pid").agg(kept(False).alias("documents"), kept(True).alias("withheld_records"))
    return _document(by, "manifest.json", F.struct("pid", "documents", "withheld_records"))


def fetch_totals(files: DataFrame, keys: list[str]) -> DataFrame:
    """By ``keys``: records, files, distinct paths and bytes. files: record_id, path, size."""
    return files.groupBy(*keys).agg(
        F.count_distinct("record_id").alias("records"), F.count("*").alias("files"), F.count_distinct("path").alias("unique_files"),
        F.sum("size").alias("bytes")
    )


def summaries(files: DataFrame) -> DataFrame:
    """(pid, path, content): summary.json of each pack, with its totals and the records that each route gave."""
    routes = files.groupBy("pid", "method").agg(F.count_distinct("record_id").alias("n")).groupBy("pid").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("method", "n")))).alias("methods"))
    both = fetch_totals(files, ["pid"]).join(routes, "pid")
    return _document(both, "summary.json", F.struct("pid", "records", "files", "unique_files", "bytes", "methods"))


def procurements(facts: DataFrame) -> DataFrame:
    """(pid, path, content): procurement.json of each pack, all its facts."""
    return _document(facts, "procurement.json", F.struct(*facts.columns))


def _document(rows: DataFrame, name: str, content: Column) -> DataFrame:
    return rows.select(F.col("pid"), F.lit(name).alias("path"), F.encode(F.to_json(content, {"ignoreNullFields": "false"}), "utf-8").alias("content"))


def originals(files: DataFrame, documents: DataFrame) -> DataFrame:
    """The archive of each pack's originals (pid, sha256, members, content, ok): every stored path once, its manifest last. ``ok``: the members' checksums hold.

    files: pid, path, content (null for a duplicate, whose bytes stand under the first one's path).
    """
    stored = files.filter("content is not null").groupBy("pid", "path").agg(F.min("content").alias("content"))
    members = stored.select("pid", "path", "content").unionByName(documents.filter("path = 'manifest.json'").select("pid", "path", "content"))
    return publish.verified(publish.archives(members, last="manifest.json"))


def tally(rows: DataFrame) -> DataFrame:
    """Extracted rows by kind: n."""
    return rows.groupBy("kind").agg(F.count("*").alias("n"))


def note_samples(gaps: DataFrame, order: list[str], note: str = "note", source: str = "source") -> DataFrame:
    """By note: how many files carry it, and the first of them."""
    return gaps.groupBy(note).agg(F.count("*").alias("n"), F.min_by(source, F.struct(*order)).alias("sample"))


def delivered(files: DataFrame, path: str = "path") -> DataFrame:
    """Only files that are ever delivered: the named documents and lists, and texts under their keys. Originals and media stay where they are."""
    name = F.element_at(F.split(path, "/"), -1)
    return files.filter(name.isin(*V.DELIVERED_NAMES) | F.col(path).rlike("(^|/)doc/[0-9a-f]{16}\\.(md|structure\\.json)$"))
