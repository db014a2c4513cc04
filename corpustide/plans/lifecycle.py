"""The three entry points end to end: discovery and download, delivery of what moved, one day from its shards."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import values as V
from ..operators import diff, extract, keyed, links, packs, pages, planning, scans
from ..sources import delivery as atomic
from ..sources import fetch as downloads
from ..sources import publish


class Incomplete(Exception):
    """A scan of the register gave fewer notices than the register said it has."""


class Empty(Exception):
    """A scan gave nothing."""


class Stale(Exception):
    """The register's newest notice is older than it may be."""


class Unverified(Exception):
    """A published archive differs from its digest or its checksums."""


class Unresolved(Exception):
    """A notice has no page on the platform, or the platform does not answer."""


#: Exit codes by what ended a run: fixed values, by command.
EXITS: dict[type[BaseException], int] = {
    Incomplete: 2, Empty: 3, Stale: 4, downloads.Refused: 2, downloads.Malformed: 2, scans.Quota: 3, Unverified: 2, Unresolved: 1
}


def exit_for(error: BaseException | None) -> int:
    """The exit code of a run: 0 where nothing ended it, 1 for what has no code of its own."""
    return 0 if error is None else next((code for kind, code in EXITS.items() if isinstance(error, kind)), 1)


def verify(archives: DataFrame) -> DataFrame:
    """The archives (see :func:`corpustide.sources.publish.verified`), or an error that names those that are not sound."""
    checked = publish.verified(archives)
    bad = [r["pid"] for r in checked.filter("not coalesce(ok, false)").select("pid").limit(20).collect()]  # named in the error
    if bad:
        raise Unverified(", ".join(map(str, bad)))
    return checked


def read_scans(
    gaps: DataFrame, files: DataFrame, cache: DataFrame, reader: scans.Provider, load: Callable[[str], bytes], name: str,
    prompt: str, at: Column, limit: int | None = None, pause: float = 0.0
) -> dict[str, DataFrame]:
    """Character recognition of what extraction could not read: the queue with what becomes of each gap, results to keep, and totals.

    files (sha256, path, pos): where the bytes of a gap are kept. cache (sha256, text, provenance): earlier results, which
    are not asked for again. The results are to be stored before they are used twice, as asking again costs again.
    """
    queued = scans.queue(gaps, scans.first_paths(files, ["pos"]), limit=limit, size_limit=reader.ceiling)
    misses = scans.split_cached(queued.filter("skipped is null"), cache)[1]
    once = keyed.first_per_key(misses, ["sha256"], ["pos"])
    read = scans.run(once, reader.read, load, pause)
    return {"plan": scans.plan(queued, cache), "read": read, "kept": scans.results(read, name, reader.model, prompt, at), "totals": scans.totals(read)}


def discover(records: DataFrame, expected: int, pages_read: int, now=None, policy: dict | None = None, notice_pages: DataFrame | None = None) -> DataFrame:
    """Biddable notices of a complete scan, in the common shape, without those outside the policy.

    With ``notice_pages`` (uuid, html; see :func:`corpustide.sources.fetch.notice_pages`) each has the ``url`` of its
    platform page, null where its page links to none.

    With ``now`` (a timestamp column) the scan must also be fresh. The policy comes before anything is downloaded.
    """
    proof = planning.coverage(records, expected, pages_read).first()
    if not proof["proven"]:
        raise Incomplete(f"{proof['unique']} of {expected}")
    if not expected:
        raise Empty("no notices")
    if now is not None and planning.freshness(records, "publicationDate", now).first()["stale"]:
        raise Stale("newest notice")
    once = keyed.first_per_key(
        records.withColumn("_key", F.coalesce(F.nullif("identifier", F.lit("")), F.nullif("externalId", F.lit("")), F.lit(""))),
        ["_key"], ["pos"]
    ).drop("_key")
    notices = planning.normalised_notices(planning.biddable(once, "type"))
    if notice_pages is not None:
        notices = links.with_links(notices, links.platform_links(notice_pages))
    if policy is None:
        return notices
    codes = C.codes(F.transform("cpv", lambda c: c["code"]))
    return notices.filter(~C.outside_scope(F.col("title"), codes, policy["recall"], policy["prefixes"], policy["excluded"]))


def overlap(window: DataFrame, named: DataFrame) -> int:
    """Targets of a named list that the window found as well."""
    keys = lambda df: df.select(C.identity(F.col("target")).alias("key")).distinct()
    return keys(named).join(keys(window), "key", "left_semi").count()


def batch(targets: DataFrame, transport: str, shard: int = 1, shards: int = 1, pause: float = V.PAUSE_CAP) -> dict[str, DataFrame]:
    """Download and extraction of a shard's targets (target, key, pid, url, done).

    Gives outcomes (target, outcome, error), records, files, facts, extracted rows and gaps. The download is cached to
    the shared folder by the caller where it is used more than once, as asking the platform again is no replay.
    """
    mine = targets.filter(C.take_shard(F.col("key"), shard, shards))
    rows = downloads.fetch(mine, transport, pause)
    return split(rows)


def split(rows: DataFrame) -> dict[str, DataFrame]:
    """Tables of a stored download (see :func:`corpustide.sources.fetch.fetch`)."""
    items = rows.filter(F.col("outcome").isin("done", "failed", "withdrawn"))
    files = rows.filter("outcome = 'file'")
    text = extract.extract(files.filter("content is not null").select("pid", "record_id", "path", "content"))
    gaps = text.filter("kind = 'unsupported'").select(
        "pid", F.col("source").alias("file"), "bytes", "sha256", F.col("note").alias("reason"),
        F.lit(None).cast("string").alias("path")
    )
    facts = pages.notices(items.filter("outcome = 'done'"), "pid")
    written = packs.manifests(rows).unionByName(packs.summaries(files)).unionByName(packs.procurements(facts))
    archives = packs.originals(files, written)
    return {
        "written": written, "originals": archives, "outcomes": items.select("target", "pid", "outcome", "error"),
        "records": rows.filter("outcome in ('file', 'record')").drop("content", "html"), "files": files, "facts": facts,
        "extracted": text, "gaps": gaps
    }


def account(outcomes: DataFrame, targets: DataFrame) -> DataFrame:
    """Accounts of a shard (key, outcome): what was asked, and what failed or was withdrawn."""
    named = outcomes.filter(F.col("outcome") != "done").join(targets.select("target", "key"), "target").select("key", "outcome")
    return targets.select("key", F.lit("target").alias("outcome")).unionByName(named)


def exit_code(outcomes: DataFrame) -> int:
    r = outcomes.agg(F.count_if(F.col("outcome") == "done").alias("done"), F.count_if(F.col("outcome") == "failed").alias("failed")).first()
    return planning.exit_code(r["done"], r["failed"])


def state(facts: DataFrame, records: DataFrame, entries: DataFrame, gaps: DataFrame, tool: str | None, parser: str | None) -> dict[str, DataFrame]:
    """The state of items that two runs are compared by: heads, facts, records, documents, unreadable."""
    heads = facts.select(
        "pid", F.lit(tool).cast("string").alias("tool"), F.lit(parser).cast("string").alias("parser"),
        C.page_language(F.col("fields")).alias("language")
    )
    return {
        "heads": heads, "facts": diff.long_facts(facts), "records": records, "documents": diff.document_state(entries),
        "unreadable": diff.unreadable_state(gaps)
    }


def deliver(previous: dict[str, DataFrame], current: dict[str, DataFrame], publishable: DataFrame | None = None) -> dict[str, DataFrame]:
    """What a run has to publish: change records, items to write again, documents to send, tallies.

    ``publishable`` (pid): only these items are looked at; without a list, all are.
    """
    if publishable is not None:
        current = {k: df.join(publishable, "pid", "left_semi") for k, df in current.items()}
        previous = {k: df.join(publishable, "pid", "left_semi") for k, df in previous.items()}
    changes = diff.diff(previous, current)
    send = diff.documents_to_send(changes, current["documents"])
    return {
        "changes": changes, "refreshed": diff.refreshed(changes), "send": send, "summary": diff.summary(changes),
        "tallies": planning.delivery_tallies(changes, send)
    }


def publish_delivery(root: str, run: str, delivery: dict[str, DataFrame], texts: DataFrame, seen: DataFrame, shard: int | None = None) -> None:
    """Publish what :func:`deliver` found, in order. texts (pid, key, path, content): all texts; only those to send are
    written, of items that are written again. seen (pid, first_seen, last_seen, last_change): every item of the run."""
    documents = texts.join(delivery["send"], ["pid", "key"], "left_semi").join(delivery["refreshed"].select("pid"), "pid", "left_semi")
    publish.publish(root, run, packs.delivered(documents).select("pid", "path", "content"), seen, delivery["summary"], delivery["changes"], shard)


def publish_whole(spark: SparkSession, root: str, run: str, delivery: dict[str, DataFrame], texts: DataFrame, seen: DataFrame, shard: int | None = None) -> dict:
    """As :func:`publish_delivery`, to any store and visible all at once (see :mod:`corpustide.sources.delivery`): the new version.
    What was delivered before and is not written again stays."""
    documents = texts.join(delivery["send"], ["pid", "key"], "left_semi").join(delivery["refreshed"].select("pid"), "pid", "left_semi")
    rows = packs.delivered(documents).select("pid", "path", "content")
    return atomic.deliver(spark, root, run, atomic.files_of(run, rows, seen, delivery["summary"], delivery["changes"], shard))


def index_entries(facts: DataFrame, entries: DataFrame, gaps: DataFrame, addresses: DataFrame) -> DataFrame:
    """One index row for each item: its facts in short, its documents with their addresses, and what could not be read."""
    key = C.document_key(F.col("original_sha256"), F.col("source"))
    docs = entries.filter(F.col("also_listed_under").isNull() & (F.coalesce("markdown_path", F.lit("")) != "")).withColumn("key", key).join(addresses, ["pid", "key"], "left")
    doc = F.struct(
        "pos", F.concat(F.lit("doc/"), "key", F.lit(".md")).alias("path"), F.substring_index("source", "/", -1).alias("name"),
        "source", "section", F.col("record_title").alias("record"), F.col("markdown_chars").alias("chars"), "download"
    )
    listed = docs.groupBy("pid").agg(F.array_sort(F.collect_list(doc)).alias("documents"))
    unread = gaps.groupBy("pid").agg(F.array_sort(F.collect_list(F.struct("file", "reason"))).alias("unreadable"))
    have = [c for c in (
        "title", "buyer", "buyer_reg", "deadline", "value", "currency", "cpv_main", "ref", "link", "iub_uuid", "procedure",
        "profile", "work_kind"
    ) if c in facts.columns]
    out = facts.select("pid", F.concat(F.lit("EIS:"), "pid").alias("key"), *have).join(listed, "pid", "left").join(unread, "pid", "left")
    empty = lambda c: F.coalesce(c, F.array().cast(dict(out.dtypes)[c])).alias(c)
    return out.select("pid", "key", *have, empty("documents"), empty("unreadable"))


def version_digest(paths: list[str]) -> str | None:
    """Twelve digits of what decides a result: the bytes of these files; None if one cannot be read."""
    h = hashlib.sha256()
    try:
        for p in paths:
            h.update(Path(p).read_bytes() + b"|")
    except OSError:
        return None
    return h.hexdigest()[:12]


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """Items whose publication ended: (pid, path, sha256) of each index that a state stands beside."""
    index = spark.read.json(f"{root}/*/index.json", schema="pid string, documents array<struct<path: string, sha256: string>>")
    ended = spark.read.json(f"{root}/*/state.json", schema="pid string, state string").select("pid").distinct()
    return index.join(ended, "pid", "left_semi").select("pid", F.explode("documents").alias("d")).select("pid", "d.path", "d.sha256")
