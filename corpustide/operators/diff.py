"""What moved between two states of a corpus: facts, records, documents and unreadable files, by item.

States are long tables keyed by item (pid) and child key. The rows of both sides are put under one another and grouped
by the keys, then the groups that moved by item; nothing is compared row by row in Python. No join stands between a
state and what is found in it, so where both sides lie in the same buckets of their items (see
:mod:`corpustide.operators.buckets`) no row of either is moved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import values as V


def both(previous: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, p, c): the two sides' other columns as structs, null where a side has no such key. Keys are distinct within a side."""
    values = [c for c in current.columns if c not in keys]
    # a field that is never null tells a row of nulls from none
    v = F.struct(F.lit(True).alias("there"), *values)
    of = lambda now: F.first(F.when(F.col("now") == now, F.col("v")), ignorenulls=True)
    found = _stacked(previous, current, keys, lambda now: [F.lit(now).alias("now"), v.alias("v")]).agg(of(False).alias("p"), of(True).alias("c"))
    return found.withColumnsRenamed({f"_{k}": k for k in keys})


def _stacked(previous: DataFrame, current: DataFrame, keys: list[str], values: Callable[[bool], list[Column]]) -> GroupedData:
    """Both sides' rows under one another, grouped by keys. The keys get names of their own first: a union is known to keep
    its sides' buckets where their columns come from projections, not where they carry their tables' names."""
    side = lambda df, now: df.select(*[F.col(k).alias(f"_{k}") for k in keys], *values(now))
    return side(previous, False).unionByName(side(current, True)).groupBy(*[f"_{k}" for k in keys])


def joined(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join by item as a merge at any size: both come grouped by item, so neither is moved again."""
    return left.join(right.hint("merge"), "pid", how)


def heads(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Items of ``current`` (pid, tool, parser, language) with what the comparison of each must know.

    ``translated`` and ``reparsed`` need both sides known; ``reextracted`` compares nulls too.
    """
    sides = both(previous, current, ["pid"]).filter("c is not null")
    moved = lambda name: F.coalesce(
        (F.col(f"p.{name}") != F.col(f"c.{name}")) & (F.col(f"p.{name}") != "") & (F.col(f"c.{name}") != ""), F.lit(False)
    )
    known = F.col("p").isNotNull()
    return sides.select(
        "pid", (~known).alias("new"), moved("language").alias("translated"), moved("parser").alias("reparsed"),
        (known & ~F.col("p.tool").eqNullSafe(F.col("c.tool"))).alias("reextracted"), F.col("p.language").alias("was_language"), F.col("c.language").alias("now_language"), F.col("c.tool").alias("tool"),
    )


def comparable(name: Column, translated: Column, reparsed: Column) -> Column:
    """Whether a fact can be compared: none after a new parser, none in the page's language after another one."""
    return F.when(reparsed, False).when(translated, ~name.isin(*V.LOCALIZED)).otherwise(True)


def fact_moves(previous: DataFrame, current: DataFrame, items: DataFrame) -> DataFrame:
    """Moved facts: pid, ord, field, was, now. Facts are long tables (pid, field, value as JSON text)."""
    sides = both(previous, current, ["pid", "field"]).select("pid", "field", F.col("p.value").alias("was"), F.col("c.value").alias("now"))
    moved = sides.filter(~F.col("was").eqNullSafe(F.col("now")))
    ord_ = F.array_position(F.array(*[F.lit(f) for f in V.FACTS]), F.col("field"))
    known = items.filter("not new").select("pid", "translated", "reparsed")
    return joined(moved, known).filter(comparable(F.col("field"), F.col("translated"), F.col("reparsed"))).select("pid", ord_.cast("int").alias("ord"), "field", "was", "now")


def long_facts(wide: DataFrame, pid: str = "pid", facts: tuple[str, ...] = V.FACTS) -> DataFrame:
    """Wide facts as a long table; values that are not text become JSON, so types stay apart; nulls stay."""
    kinds = dict(wide.dtypes)
    have = [f for f in facts if f in kinds]
    value = lambda f: F.col(f) if kinds[f] == "string" else F.when(F.col(f).isNotNull(), F.to_json(F.struct(F.col(f).alias("v"))))
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), value(f).alias("value")) for f in have]))
    return wide.select(F.col(pid).alias("pid"), pairs.alias("x")).select("pid", "x.field", "x.value")


def record_state(records: DataFrame, withheld: DataFrame | None = None) -> DataFrame:
    """Records keyed by (pid, id), files as a map from digest to name; a withheld record never overrides a published one.

    ``records``: pid, id, publish_date, title, type_code, section, files array<struct<sha256, original_name, filename>>, pos.
    """
    files = F.map_from_entries(F.array_distinct(F.transform(
        F.filter("files", lambda f: F.coalesce(f["sha256"], F.lit("")) != ""),
        lambda f: F.struct(f["sha256"], F.coalesce(F.nullif(f["original_name"], F.lit("")), f["filename"]))
    )))
    cols = ["pid", "id", "publish_date", "title", "type_code", "section", "withheld", "files"]
    out = records.withColumn("files", files).withColumn("withheld", F.lit(False)).withColumn("rank", F.lit(0))
    if withheld is not None:
        hidden = withheld.withColumn("files", F.create_map().cast("map<string,string>")).withColumn("withheld", F.lit(True)).withColumn("rank", F.lit(1))
        out = out.select(*cols, "rank").unionByName(hidden.select(*cols, "rank"))
    whole = F.struct(*[F.col(c) for c in cols])
    return out.groupBy("pid", "id").agg(F.min_by(whole, "rank").alias("r")).select("r.*")


def record_moves(previous: DataFrame, current: DataFrame, fields: tuple[str, ...] = V.RECORD_FIELDS) -> DataFrame:
    """Records added, removed and changed: pid, id, move, title, fields, files_added, files_removed, silent.

    ``silent``: the files moved and the publication date did not. File names come in the order of their digests.
    """
    sides = both(previous, current, ["pid", "id"])
    moved = [~F.col(f"p.{f}").eqNullSafe(F.col(f"c.{f}")) for f in fields]
    pairs = F.filter(
        F.array(*[F.when(
            m,
            F.struct(F.lit(f).alias("field"), F.col(f"p.{f}").cast("string").alias("was"), F.col(f"c.{f}").cast("string").alias("now"))
        ) for f, m in zip(fields, moved)]),
        lambda x: x.isNotNull()
    )
    names = lambda of, other: F.transform(
        F.array_sort(F.array_except(F.map_keys(f"{of}.files"), F.map_keys(f"{other}.files"))),
        lambda d: F.try_element_at(F.col(f"{of}.files"), d)
    )
    out = sides.select(
        "pid", "id",
        F.when(F.col("p").isNull(), "added").when(F.col("c").isNull(), "removed").otherwise("changed").alias("move"),
        F.coalesce("c.title", "p.title").alias("title"), pairs.alias("fields"), names("c", "p").alias("files_added"), names("p", "c").alias("files_removed"), (moved[0]).alias("_dated"),
    )
    touched = (F.size("files_added") > 0) | (F.size("files_removed") > 0)
    changed = out.filter((F.col("move") != "changed") | touched | (F.size("fields") > 0))
    is_changed = F.col("move") == "changed"
    empty = F.array().cast("array<string>")
    return changed.select(
        "pid", "id", "move", "title",
        F.when(is_changed, F.col("fields")).otherwise(F.array().cast("array<struct<field: string, was: string, now: string>>")).alias("fields"),
        F.when(is_changed, F.col("files_added")).otherwise(empty).alias("files_added"),
        F.when(is_changed, F.col("files_removed")).otherwise(empty).alias("files_removed"),
        (is_changed & touched & ~F.col("_dated")).alias("silent")
    )


def document_state(entries: DataFrame) -> DataFrame:
    """Extracted documents keyed by (pid, key); those listed twice or without text are left out, of one key the last stays."""
    read = entries.filter(F.col("also_listed_under").isNull() & (F.coalesce("markdown_path", F.lit("")) != ""))
    name = F.coalesce(F.nullif("original_file", F.lit("")), F.substring_index(F.coalesce("source", F.lit("")), "/", -1))
    out = read.select(
        "pid", C.document_key(F.col("original_sha256"), F.col("source")).alias("key"), name.alias("name"), "source", "section",
        F.col("record_title").alias("record"), F.nullif(F.col("record_id").cast("string"), F.lit("")).alias("record_id"),
        F.col("markdown_chars").alias("chars"), "pos"
    )
    values = [c for c in out.columns if c not in ("pid", "key", "pos")]
    return out.groupBy("pid", "key").agg(*[F.max_by(c, "pos").alias(c) for c in values])  # by column, so that those not asked for are never read


def unreadable_state(gaps: DataFrame) -> DataFrame:
    """Unreadable files keyed by their own digest, else by their name."""
    key = F.coalesce(F.nullif("sha256", F.lit("")), C.document_key(F.lit(""), F.col("file")))
    return gaps.select("pid", key.alias("key"), "file", "reason", "bytes").dropDuplicates(["pid", "key"])


def key_moves(previous: DataFrame, current: DataFrame) -> DataFrame:
    """By item: sorted keys added and removed, and the number kept. Both sides: pid, key, distinct."""
    return keys_of(previous, current).groupBy("pid").agg(
        F.array_sort(F.collect_list(F.when(F.col("now") & ~F.col("was"), F.col("key")))).alias("added"),
        F.array_sort(F.collect_list(F.when(F.col("was") & ~F.col("now"), F.col("key")))).alias("removed"),
        F.count_if(F.col("was") & F.col("now")).alias("carried_over"), F.count_if("now").alias("now"),
    )


def keys_of(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Rows (pid, key, was, now): on which sides each key is."""
    rows = _stacked(previous, current, ["pid", "key"], lambda now: [F.lit(now).alias("here")])
    return rows.agg(F.bool_or(~F.col("here")).alias("was"), F.bool_or("here").alias("now")).withColumnsRenamed({"_pid": "pid", "_key": "key"})


def diff(previous: dict[str, DataFrame], current: dict[str, DataFrame]) -> DataFrame:
    """One change record for each item of ``current``. States hold heads, facts, records, documents and unreadable.

    A new item has counts only: its lists are null, not empty.
    """
    items = heads(previous["heads"], current["heads"])
    facts = fact_moves(previous["facts"], current["facts"], items).groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("ord", "field", "was", "now"))).alias("facts"))
    move = lambda m: F.array_sort(F.collect_list(F.when(F.col("move") == m, F.col("id"))))
    whole = F.struct("id", "title", "fields", "files_added", "files_removed", "silent")
    records = record_moves(previous["records"], current["records"]).groupBy("pid").agg(
        move("added").alias("records_added"), move("removed").alias("records_removed"),
        F.array_sort(F.collect_list(F.when(F.col("move") == "changed", whole))).alias("records_changed")
    )
    docs = key_moves(previous["documents"], current["documents"]).withColumnsRenamed({
        "added": "documents_added", "removed": "documents_removed", "now": "n_documents"
    })
    gaps = key_moves(previous["unreadable"], current["unreadable"]).drop("carried_over").withColumnsRenamed({
        "added": "unreadable_added", "removed": "unreadable_removed", "now": "n_unreadable"
    })
    counts = current["records"].groupBy("pid").agg(F.count("*").alias("n_records"))
    out = items
    for part in (facts, records, docs, gaps, counts):
        out = joined(out, part, "left")
    lists = ["facts", "records_added", "records_removed", "records_changed", "documents_added", "documents_removed", "unreadable_added", "unreadable_removed"]
    kinds = dict(out.dtypes)
    for name in lists:
        out = out.withColumn(name, F.when(~F.col("new"), F.coalesce(name, F.array().cast(kinds[name]))))
    moved = F.lit(False)
    for name in lists:
        moved = moved | (F.size(name) > 0)
    skipped = F.when(F.col("reparsed"), F.array(*[F.lit(f) for f in sorted(V.FACTS)])).when(
        F.col("translated"), F.array(*[F.lit(f) for f in sorted(V.LOCALIZED)])
    ).otherwise(F.array().cast("array<string>"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return out.withColumn("status", F.when(F.col("new"), "new").when(moved, "changed").otherwise("unchanged")).select(
        "pid", "status", *[F.when(~F.col("new"), F.col(c)).alias(c) for c in ("reextracted", "reparsed", "translated")], "was_language", "now_language", "tool", *lists,
        F.when(~F.col("new"), skipped).alias("facts_not_compared"), F.when(~F.col("new"), F.coalesce("carried_over", F.lit(0))).alias("carried_over"), zero("n_records"), zero("n_documents"), zero("n_unreadable"),
    )


def refreshed(changes: DataFrame) -> DataFrame:
    """Change records whose items must be written again: moved, extracted anew or parsed anew."""
    return changes.filter((F.col("status") != "unchanged") | F.coalesce("reextracted", F.lit(False)) | F.coalesce("reparsed", F.lit(False)))


def documents_to_send(changes: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents (pid, key) to deliver: all of an item that is new or extracted anew, else what was added."""
    whole = (F.col("status") == "new") | F.coalesce("reextracted", F.lit(False))
    wanted = changes.select("pid", whole.alias("whole"), F.coalesce("documents_added", F.array().cast("array<string>")).alias("wanted"))
    return documents.select("pid", "key").join(wanted, "pid").filter(F.col("whole") | F.array_contains("wanted", F.col("key"))).select("pid", "key")


def sendable(previous: dict[str, DataFrame], current: dict[str, DataFrame]) -> DataFrame:
    """:func:`documents_to_send` straight from two states: of their tables only heads and documents are read."""
    items = heads(previous["heads"], current["heads"]).select("pid", (F.col("new") | F.col("reextracted")).alias("whole"))
    keys = keys_of(previous["documents"], current["documents"]).filter("now")
    return joined(keys, items).filter(F.col("whole") | ~F.col("was")).select("pid", "key")


def summary(changes: DataFrame) -> DataFrame:
    """One small row for each change record; of a new item only its documents."""
    old = F.col("status") != "new"
    n = lambda c: F.when(old, F.size(c)).alias(c)
    silent = F.when(old, F.size(F.filter("records_changed", lambda r: r["silent"]))).alias("silent_records")
    return changes.select(
        "pid", "status", F.when(~old, F.col("n_documents")).alias("documents"),
        F.when(old, F.col("reextracted")).alias("reextracted"), n("facts"), n("records_added"), n("records_changed"),
        n("documents_added"), n("documents_removed"), F.when(old, F.col("carried_over")).alias("carried_over"), silent
    )


def seen(runs: DataFrame) -> DataFrame:
    """first_seen, last_seen and last_change of each item over its runs (pid, date, seq, status), in the order they ran."""
    return runs.groupBy("pid").agg(
        F.min_by("date", "seq").alias("first_seen"), F.max_by("date", "seq").alias("last_seen"),
        F.max_by(F.when(F.col("status") != "unchanged", F.col("date")), F.when(F.col("status") != "unchanged", F.col("seq"))).alias("last_change")
    )
