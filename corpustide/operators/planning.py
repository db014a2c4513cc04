"""Targets, shards and balanced slices; reconciliation of independently processed shards into one day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import values as V
from .keyed import last_per_key


def coverage(records: DataFrame, expected: int, pages: int, key: str = "identifier", other: str = "externalId") -> DataFrame:
    """One row: expected, unique, pages, drift, proven. Rows with neither id count as one."""
    unique = records.agg(F.count_distinct(F.coalesce(F.nullif(key, F.lit("")), F.nullif(other, F.lit("")), F.lit(""))).alias("unique"))
    return unique.select(
        F.lit(expected).alias("expected"), "unique", F.lit(pages).alias("pages"),
        (F.lit(expected) - F.col("unique")).alias("drift"), (F.col("unique") == expected).alias("proven")
    )


def observed_coverage(records: DataFrame, expected: int, pages: int, path: str, order: list[str], key: str = "identifier", other: str = "externalId") -> DataFrame:
    """:func:`coverage`, measured in the pass that writes the records to ``path``, each once, where it came first by ``order``.

    The scan is read once: distinct records are counted as they are written, so no second scan proves the first. The
    row also has ``rows``, with repeats.
    """
    scanned, unique = Observation(), Observation()
    own = F.coalesce(F.nullif(F.col(key), F.lit("")), F.nullif(F.col(other), F.lit("")), F.lit(""))
    counted = records.observe(scanned, F.count("*").alias("rows")).withColumn("_key", own)
    once = counted.groupBy("_key").agg(F.min_by(F.struct(*records.columns), F.struct(*order)).alias("r")).select("r.*")
    once.observe(unique, F.count("*").alias("unique")).write.parquet(path)
    n, rows = unique.get["unique"], scanned.get["rows"]
    schema = "expected int, unique long, pages int, drift long, proven boolean, rows long"
    return records.sparkSession.createDataFrame([(expected, n, pages, expected - n, n == expected, rows)], schema)


def normalised_notices(records: DataFrame) -> DataFrame:
    """Register records (identifier, externalId, …) in the one shape that the rest knows."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return records.select(
        text("externalId").alias("id"), text("identifier").alias("uuid"), text("procurementIdentifier").alias("ref"), F.trim(text("name")).alias("title"), F.trim(text("organizationName")).alias("buyer"),
        text("organizationIdentifier").alias("buyer_reg"), F.substring(text("publicationDate"), 1, 10).alias("published"), F.col("date").alias("deadline"), C.register_amount(F.col("amount")).alias("value"),
        F.coalesce(F.nullif("currency", F.lit("")), F.lit("EUR")).alias("currency"), F.coalesce(
            "cpvCodes", F.array().cast("array<struct<code: string, caption: string>>")
        ).alias("cpv"), F.col("type").alias("notice_type"),
        F.col("procedureType").alias("procedure"), F.col("procedureLegalBasis").alias("legal_basis"), F.coalesce(F.col("euFund").cast("boolean"), F.lit(False)).alias("eu_fund"), F.concat(F.lit(V.NOTICE_PAGE), text("identifier")).alias("link"),
    )


def biddable(notices: DataFrame, kind: str = "notice_type") -> DataFrame:
    return notices.filter(F.col(kind).isin(*V.BIDDABLE))


def counts_by(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(name), F.lit("unknown")).alias(name)).agg(F.count("*").alias("n"))


def freshness(records: DataFrame, stamp: str, now: Column, ceiling: float = V.FRESHNESS_HOURS) -> DataFrame:
    """One row: newest publication, its lag in hours (one decimal), and whether it is stale. Stamps that are no time are ignored."""
    newest = records.agg(F.max(F.try_to_timestamp(F.col(stamp).cast("string"))).alias("newest"))
    lag = F.round((F.unix_micros(now.cast("timestamp")) - F.unix_micros("newest")) / F.lit(3.6e9), 1)
    return newest.select("newest", lag.alias("lag_hours"), (lag > ceiling).alias("stale"))


def window_bounds(days: int, end: Column) -> Column:
    """Struct (start, end) of a window of so many days, both ends included."""
    return F.struct(F.date_sub(end, max(days - 1, 0)).alias("start"), end.alias("end"))


def named_targets(lines: DataFrame, line: str = "value") -> DataFrame:
    """Targets of a list, one a line: no byte-order mark, no comments, no blanks."""
    text = F.trim(F.split_part(F.replace(F.col(line), F.lit("﻿"), F.lit("")), F.lit("#"), F.lit(1)))
    return lines.select(text.alias("target")).filter("target <> ''")


def targets(window: DataFrame, named: DataFrame, deduplicate_window: bool = True) -> DataFrame:
    """Window and named list together: target, key, uuid, pos, named. What the window found wins; the list repeats nothing.

    ``window``: target, uuid, pos. ``named``: target, pos. Without ``deduplicate_window`` two notices of one item are two targets.
    """
    found = window.withColumn("key", C.identity(F.col("target"))).filter("key is not null")
    if deduplicate_window:
        found = found.groupBy("key").agg(F.min_by(F.struct("target", "uuid", "pos"), "pos").alias("r")).select("key", "r.*")
    asked = named.withColumn("key", C.identity(F.col("target"))).filter("key is not null").groupBy("key").agg(F.min_by(F.struct("target", "pos"), "pos").alias("r")).select("key", "r.*")
    taken = found.select("key").unionByName(found.filter("uuid is not null").select(F.concat(F.lit("iub:"), F.lower("uuid")).alias("key"))).distinct()
    rest = asked.join(taken, "key", "left_anti")
    return found.select("target", "key", "uuid", "pos", F.lit(False).alias("named")).unionByName(rest.select(
        "target", "key", F.lit(None).cast("string").alias("uuid"), "pos", F.lit(True).alias("named")
    ))


def shard_loads(df: DataFrame, shards: int) -> DataFrame:
    """By shard: targets, weight, heavy ones. ``df``: key, weight."""
    return df.groupBy(C.shard_of(F.col("key"), shards).alias("shard")).agg(
        F.count("*").alias("targets"), F.sum("weight").alias("weight"), F.count_if(F.col("weight") > 1).alias("heavy")
    )


#: Items of one day that one task may balance; some bytes each.
MOST_ITEMS = 5_000_000


def balance(items: DataFrame, slices: int, pid: str = "pid", load: str = "chars", day: str | None = None) -> DataFrame:
    """Items by longest processing time: largest first (ties by pid), each to the least loaded slice, ties to the lowest.

    The rule is sequential, so the rows of one ``day`` (an id and a size for each item; all rows are one day without the
    column) go through one task with a heap, and days in parallel. A day of more than MOST_ITEMS is an error. Adds
    ``slice`` from 1.
    """
    import heapq

    def run(batches):
        import pandas as pd

        at, heap, seen = object(), [], 0
        for batch in batches:
            out = []
            for now, size in zip(batch["_day"], batch["_load"].tolist()):
                now = None if pd.isna(now) else now
                if now != at:
                    at, heap, seen = now, [(0, n) for n in range(1, slices + 1)], 0
                seen += 1
                if seen > MOST_ITEMS:
                    raise ValueError(f"a day has more than {MOST_ITEMS} items")
                total, n = heap[0]
                heapq.heapreplace(heap, (total + size, n))
                out.append(n)
            yield batch.drop(columns=["_day", "_load"]).assign(slice=pd.Series(out, index=batch.index, dtype="int32"))

    kinds = dict(items.dtypes)
    own = [pid, load, *([day] if day else [])]
    schema = ", ".join(f"`{c}` {'bigint' if c == load else kinds[c]}" for c in own) + ", slice int"
    rows = items.select(
        pid, F.col(load).cast("long").alias(load), *([day] if day else []),
        (F.col(day).cast("string") if day else F.lit("")).alias("_day"),
        F.coalesce(F.col(load).cast("long"), F.lit(0)).alias("_load")
    )
    parts = rows.repartition("_day") if day else rows.coalesce(1)
    return parts.sortWithinPartitions("_day", F.desc("_load"), pid).mapInPandas(run, schema)


def fresh_shards(indexes: DataFrame, run_id: str | None, shards: int) -> DataFrame:
    """Each expected shard as present, stale (of another run) or missing. ``indexes``: shard, run_id."""
    expected = indexes.sparkSession.range(1, shards + 1).select(F.col("id").cast("int").alias("shard"))
    other = F.lit(run_id).isNotNull() & F.col("run_id").isNotNull() & (F.col("run_id") != F.lit(run_id))
    state = F.when(~F.coalesce("here", F.lit(False)), "missing").when(F.coalesce(other, F.lit(False)), "stale").otherwise("present")
    return expected.join(indexes.select("shard", "run_id", F.lit(True).alias("here")), "shard", "left").select("shard", state.alias("state"))


def last_tenders(entries: DataFrame) -> DataFrame:
    """One entry for each item: of several shards' the last, by (shard, pos)."""
    return last_per_key(entries, ["pid"], ["shard", "pos"])


def unaccounted(accounts: DataFrame, resolved: DataFrame, delivered: DataFrame) -> DataFrame:
    """Targets that no shard delivered or excused: key. ``accounts``: key, outcome (target, failed, withdrawn); ``resolved``: asked, found, shard; ``delivered``: pid."""
    names = resolved.groupBy("asked").agg(F.max_by("found", "shard").alias("found"))
    named = accounts.join(names, accounts["key"] == names["asked"], "left").select(F.coalesce("found", "key").alias("key"), "outcome")
    asked = named.filter("outcome = 'target'").select("key").distinct()
    excused = named.filter("outcome in ('failed', 'withdrawn')").select("key")
    done = delivered.select(F.concat(F.lit("eis:"), F.col("pid").cast("string")).alias("key"))
    return asked.join(excused.unionByName(done).distinct(), "key", "left_anti")


def coverage_block(accounts: DataFrame, resolved: DataFrame, delivered: DataFrame) -> DataFrame:
    """One row: targets, delivered, excused (of those asked for), unaccounted."""
    names = resolved.groupBy("asked").agg(F.max_by("found", "shard").alias("found"))
    named = accounts.join(names, accounts["key"] == names["asked"], "left").select(F.coalesce("found", "key").alias("key"), "outcome")
    keys = named.groupBy("key").agg(
        F.bool_or(F.col("outcome") == "target").alias("asked"),
        F.bool_or(F.col("outcome").isin("failed", "withdrawn")).alias("excused")
    )
    done = delivered.select(F.concat(F.lit("eis:"), F.col("pid").cast("string")).alias("key"), F.lit(True).alias("done")).distinct()
    both = keys.join(done, "key", "full_outer")
    yes = lambda c: F.coalesce(c, F.lit(False))
    return both.agg(
        F.count_if(yes(F.col("asked"))).alias("targets"), F.count_if(yes(F.col("done"))).alias("delivered"),
        F.count_if(yes(F.col("asked") & F.col("excused"))).alias("excused"),
        F.count_if(yes(F.col("asked")) & ~yes(F.col("excused")) & ~yes(F.col("done"))).alias("unaccounted")
    )


def day_counts(tenders: DataFrame) -> DataFrame:
    """By status, unknown where there is none: tenders, documents, chars, unreadable."""
    return tenders.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(
        F.count("*").alias("tenders"), F.sum("documents").alias("documents"), F.sum("chars").alias("chars"),
        F.sum("unreadable").alias("unreadable")
    )


def delivery_tallies(changes: DataFrame, sent: DataFrame) -> DataFrame:
    """One row: new, changed, unchanged, documents sent and carried over; an item extracted anew carries nothing."""
    n = sent.groupBy("pid").agg(F.count("*").alias("sent"))
    kept = F.when(F.coalesce("reextracted", F.lit(False)), 0).otherwise(F.coalesce("carried_over", F.lit(0)))
    is_ = lambda s: F.count_if(F.col("status") == s).alias(s)
    return changes.join(n, "pid", "left").agg(
        is_("new"), is_("changed"), is_("unchanged"), F.coalesce(F.sum("sent"), F.lit(0)).alias("sent"),
        F.coalesce(F.sum(kept), F.lit(0)).alias("carried")
    )


def exit_code(done: int, failed: int) -> int:
    """0 if anything was done or nothing failed, else 1."""
    return 0 if done or not failed else 1


def collect_day(
    indexes: DataFrame, entries: DataFrame, accounts: DataFrame, resolved: DataFrame, run_id: str | None, shards: int, slices: int
) -> dict[str, DataFrame]:
    """One day from its shards: states, tenders with slices, counts by status, unaccounted targets, coverage, completeness.

    ``entries``: pid, shard, pos, status, title, documents, chars, unreadable; only rows of fresh shards count.
    """
    states = fresh_shards(indexes, run_id, shards)
    fresh = F.broadcast(states.filter("state = 'present'").select("shard"))  # one row a shard
    mine = lambda df: df.join(fresh, "shard", "left_semi")
    tenders = last_tenders(mine(entries).filter("coalesce(pid, '') <> ''"))
    own, names = mine(accounts), mine(resolved)
    lost = unaccounted(own, names, tenders)
    signs = states.select((F.col("state") == "present").alias("ok")).unionByName(lost.select(F.lit(False).alias("ok")))
    complete = signs.agg(F.coalesce(F.bool_and("ok"), F.lit(True)).alias("complete"))
    return {
        "states": states, "tenders": tenders.join(balance(tenders, slices).select("pid", "slice"), "pid"),
        "counts": day_counts(tenders), "unaccounted": lost, "coverage": coverage_block(own, names, tenders), "complete": complete
    }
