"""First and last rows of a key, duplicates, and order-dependent steps, by an explicit position column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: an aggregate of structs, which combines before the shuffle."""
    return _edge(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return _edge(df, keys, order, F.min_by)


def _edge(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    whole = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(pick(whole, F.struct(*order)).alias("_row")).select("_row.*")


def duplicate_content(files: DataFrame, order: list[str], name: str = "filename", digest: str = "sha256") -> DataFrame:
    """Adds ``duplicate``: the same name and bytes came before."""
    w = Window.partitionBy(name, digest).orderBy(*order)
    return files.withColumn("duplicate", F.row_number().over(w) > 1)


def suffixed_names(files: DataFrame, order: list[str], section: str = "section", name: str = "filename", digest: str = "sha256") -> DataFrame:
    """Adds ``duplicate`` and ``stored_name``: a name taken in its section by other bytes gets ten digits of the digest."""
    marked = duplicate_content(files, order, name, digest)
    w = Window.partitionBy(section, name, "duplicate").orderBy(*order)
    taken = (F.row_number().over(w) > 1) & ~F.col("duplicate")
    ext = F.regexp_extract(F.col(name), r"(\.[^./]*)$", 1)
    stem = F.left(F.col(name), F.char_length(F.col(name)) - F.char_length(ext))
    marked = marked.withColumn("_own", F.when(taken, F.concat(stem, F.lit("-"), F.left(F.col(digest), F.lit(10)), ext)).otherwise(F.col(name)))
    first = F.first("_own").over(Window.partitionBy(name, digest).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn("stored_name", first).drop("_own")


def also_listed(entries: DataFrame, order: list[str], path: str = "path", record: str = "record_id") -> DataFrame:
    """Adds ``also_listed_under``: the first record that lists the same path, null for that one itself."""
    w = Window.partitionBy(path).orderBy(*order)
    return entries.withColumn("also_listed_under", F.when(F.row_number().over(w) > 1, F.first(record).over(w.rowsBetween(Window.unboundedPreceding, 0))))


def gap_audit(gaps: DataFrame, order: list[str], digest: str = "sha256", source: str = "source", size: str = "bytes") -> DataFrame:
    """One row for each unreadable file (by digest, else by source), with its place in the list: largest first, ties as found."""
    once = first_per_key(gaps.withColumn("_key", F.coalesce(F.nullif(F.col(digest), F.lit("")), F.col(source))), ["_key"], order).drop("_key")
    return once.orderBy(F.desc(size), *order)


def replay(journal: DataFrame, value: str = "value", schema: str = "id string", line: str = "line") -> DataFrame:
    """State of an append-only JSON journal: the last readable line of each id; torn and blank lines are skipped."""
    parsed = journal.select(F.col(line), F.from_json(F.col(value), schema, {"mode": "PERMISSIVE"}).alias("e")).filter("e.id is not null").select(line, "e.*")
    return last_per_key(parsed, ["id"], [line]).drop(line)


def resumable(journal: DataFrame, disk: DataFrame) -> DataFrame:
    """(id): journal entries that need not be fetched again: with one file at least, and all of them on disk at their size.

    journal: id, files (array of structs with path and size), as :func:`replay` gives it. disk: path, size.
    Paths meet by their SHA-256, 32 bytes however long they are.
    """
    path = lambda c: F.unhex(F.sha2(c, 256)).alias("_path")
    files = journal.select("id", F.explode("files").alias("f")).select("id", path("f.path"), "f.size")
    there = disk.select(path("path"), "size").groupBy("_path").agg(F.max("size").alias("there"))
    held = files.join(there, "_path", "left")
    return held.groupBy("id").agg(F.bool_and(F.coalesce(F.col("there") == F.col("size"), F.lit(False))).alias("whole")).filter("whole").select("id")


def resolutions(rows: DataFrame) -> DataFrame:
    """(asked, found) pairs without those that found nothing ('-')."""
    return rows.filter((F.col("found") != "-") & (F.col("found") != "") & (F.col("asked") != ""))


def assembled(rows: DataFrame, keys: list[str], order: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Texts of each key joined in order; empty ones left out."""
    parts = F.array_sort(F.collect_list(F.when(F.trim(F.coalesce(text, F.lit(""))) != "", F.struct(order, text))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p[text]), separator).alias("text"))


def walk_until_misses(ids: DataFrame, id_col: str, hit_col: str, misses: int = 40, limit: int | None = None, bucket: int = 100_000) -> DataFrame:
    """Hits of an ordered walk over consecutive ids that stops after a run of ``misses``, or ``limit`` hits.

    A miss stops the walk when the last hit before it (or the start) lies ``misses`` ids back, so only hits have to
    be put in order. Ids go by ranges of ``bucket``: each range's first and last hit stand for it, then each hit sees
    the one before it in its own range.
    """
    start = ids.agg(F.min(id_col)).first()[0]
    if start is None:
        return ids.select(F.col(id_col)).filter("false")
    hits = ids.filter(F.col(hit_col)).select(F.col(id_col).alias("_id"), F.floor((F.col(id_col) - F.lit(start)) / bucket).alias("_b"))
    ranges = hits.groupBy("_b").agg(F.max("_id").alias("_last"))
    before = ranges.select("_b", F.lag("_last").over(Window.partitionBy(F.lit(0)).orderBy("_b")).alias("_carried"))
    own = F.lag("_id").over(Window.partitionBy("_b").orderBy("_id"))
    gaps = hits.withColumn("_prev", own).join(before, "_b").withColumn("_prev", F.coalesce("_prev", "_carried", F.lit(start - 1)))
    stop = gaps.filter(F.col("_id") - F.col("_prev") > misses).agg(F.min("_id")).first()[0]
    found = hits.select(F.col("_id").alias(id_col))
    found = found if stop is None else found.filter(F.col(id_col) < stop)
    return found.orderBy(id_col).limit(limit) if limit is not None else found
