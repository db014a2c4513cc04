"""Queries over the ends of a run: shards and runs, lists, verified archives, addresses and windows. Their answers vary with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import values as V
from ..operators import planning
from ..sources import publish
from ..sources.files import scratch
from . import demo_views as D
from .catalogue import _STATES, query


@query("""SELECT CAST(s_suppkey + 1 AS INTEGER) AS shard, CASE s_nationkey % 4 WHEN 0 THEN 'present' WHEN 1 THEN 'stale' WHEN 2 THEN 'present' ELSE 'missing' END AS state FROM supplier""")
def shard_runs(spark, sf) -> DataFrame:
    """Each expected shard by what its index says: of this run, of another, of none (trusted), or not there. Suppliers are shards."""
    s = D.table(spark, sf, "supplier")
    run = F.when(F.col("s_nationkey") % 4 == 0, "now").when(F.col("s_nationkey") % 4 == 1, F.concat(F.lit("run"), F.col("s_nationkey").cast("string")))
    indexes = s.filter("s_nationkey % 4 < 3").select((F.col("s_suppkey") + 1).cast("int").alias("shard"), run.alias("run_id"))
    return planning.fresh_shards(indexes, "now", s.agg(F.max("s_suppkey")).first()[0] + 1)


@query(f"WITH {_STATES} SELECT pid, status, true AS listed FROM t WHERE CAST(substr(pid, 2) AS BIGINT) % 3 = 0 UNION ALL SELECT pid, status, false AS listed FROM t")
def publishable_changes(spark, sf):
    """Change records of the items on the list of those that ended well; and without a list, of all."""
    from . import lifecycle

    previous, current = D.states(spark, sf)
    listed = D.table(spark, sf, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("pid"))
    some = lifecycle.deliver(previous, current, listed)["changes"].select("pid", "status", F.lit(True).alias("listed"))
    return some.unionByName(lifecycle.deliver(previous, current)["changes"].select("pid", "status", F.lit(False).alias("listed")))


def _members(spark, sf) -> DataFrame:
    return D.table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("pid"), "c_nationkey",
        F.concat(F.lit("doc/"), F.col("c_custkey").cast("string")).alias("path"), F.col("c_name").alias("text")
    )


@query("""SELECT 'c' || c_nationkey AS pid, count(*) AS members, CASE WHEN c_nationkey % 3 = 0 OR count(*) FILTER (c_custkey % 10 = 7) = 0 THEN 1 ELSE 2 END AS digests FROM customer GROUP BY c_nationkey""")
def archive_versions(spark, sf):
    """How many archives there are of members that come in two orders, of some items with other contents the second time."""
    rows = _members(spark, sf)
    edited = F.when((F.col("c_nationkey") % 3 != 0) & F.col("path").endswith("7"), F.concat("text", F.lit("*"))).otherwise(F.col("text"))
    pack = lambda df, text, parts: publish.archives(df.repartition(parts, "path").select("pid", "path", F.encode(text, "utf-8").alias("content")))
    both = pack(rows, F.col("text"), 3).unionByName(pack(rows, edited, 5))
    return both.groupBy("pid").agg(F.max("members").alias("members"), F.count_distinct("sha256").cast("int").alias("digests"))


@query("SELECT 'c' || c_nationkey AS pid, count(*) AS members, c_nationkey % 4 = 0 AS ok FROM customer GROUP BY c_nationkey")
def damaged_archives(spark, sf):
    """Archives that came through a store which lost the end of some (and took the digest of what was left), changed a byte of others, and gave others another digest."""
    made = publish.archives(_members(spark, sf).select("pid", "path", F.encode("text", "utf-8").alias("content")))
    kind = F.substring("pid", 2, 9).cast("int") % 4
    half = (F.octet_length("content") / 2).cast("int")
    content = F.when(kind == 1, F.substring("content", F.lit(1), half)).when(
        kind == 2, F.concat(F.substring("content", F.lit(1), half), F.lit(b"?"), F.substring("content", half + 2, F.octet_length("content")))
    ).otherwise(F.col("content"))
    digest = F.when(kind == 3, F.sha2(F.col("pid").cast("binary"), 256)).when(kind == 1, F.sha2(content, 256)).otherwise(F.col("sha256"))
    return publish.verified(made.select("pid", "members", digest.alias("sha256"), content.alias("content"))).select("pid", "members", "ok")


@query(r"""SELECT page_id, trim(regexp_replace(url, '\s+', ' ', 'g')) || ' & ' || page_id AS label FROM pages""")
def page_labels(spark, sf):
    """A label's own words: what stands before its first element, entities decoded, without the colon."""
    number = F.col("page_id").cast("string")
    fragment = F.concat(F.lit(" \n"), "url", F.lit("\t&amp; "), number, F.lit(" :: <span>"), number, F.lit(":</span> tip"))
    return D.table(spark, sf, "pages").select("page_id", C.label_text(fragment).alias("label"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) - 6 AS week_start, CAST(o_orderdate AS DATE) AS week_end, CAST(o_orderdate AS DATE) AS day_start FROM orders""")
def window_days(spark, sf):
    """Windows of seven days and of none that end on a given day, both ends included."""
    end = F.col("o_orderdate").cast("date")
    week, none = planning.window_bounds(7, end), planning.window_bounds(0, end)
    return D.table(spark, sf, "orders").select("o_orderkey", week["start"].alias("week_start"), week["end"].alias("week_end"), none["start"].alias("day_start"))


@query(f"""SELECT page_id, CASE WHEN page_id % 7 < 3 THEN '{V.PLATFORM_PAGE}' || page_id END AS url, CASE WHEN page_id % 7 < 3 THEN CAST(page_id AS VARCHAR) END AS id FROM pages""")
def platform_urls(spark, sf):
    """Addresses in the platform's one form; those of other schemes, hosts and paths are none."""
    number = F.col("page_id").cast("string")
    forms = [
        ("https://www.eis.gov.lv/EKEIS/Supplier/Procurement/", ""), ("HTTPS://EIS.gov.lv/ekeis/supplier/procurement/", "/"),
        ("https://eis.gov.lv/EKEIS/Supplier/Procurement/", "?tab=2#top"), ("http://www.eis.gov.lv/EKEIS/Supplier/Procurement/", ""),
        ("https://www.eis.gov.lv.example/EKEIS/Supplier/Procurement/", ""), ("https://www.eis.gov.lv/EKEIS/Supplier/Procurement/", "/documents"), ("", "")
    ]
    raw = F.lit(None).cast("string")
    for k, (before, after) in enumerate(forms):
        raw = F.when(F.col("page_id") % len(forms) == k, F.concat(F.lit(before), number, F.lit(after))).otherwise(raw)
    return D.table(spark, sf, "pages").select("page_id", C.canonical_url(raw).alias("u")).select("page_id", "u.url", "u.id")


@query("""SELECT event_type AS type, count(*) AS n, count(*) AS written, (SELECT count(DISTINCT user_id) FROM events) AS "unique" FROM events GROUP BY 1""")
def harvest_files(spark, sf):
    """A scan's records and the row beside them, read back from their files: records by type, as counted and as written."""
    root = scratch(spark, "harvested")
    e = D.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("identifier"), F.lit(None).cast("string").alias("externalId"), F.col("event_type").alias("type"))
    publish.harvest(e, planning.coverage(e, 10, 1), root)
    # a map's keys are columns of the JSON; as a map they are read with a schema
    meta = spark.read.schema("unique long, by_type map<string, long>").json(f"{root}/meta").select("unique", F.explode("by_type").alias("type", "n"))
    written = spark.read.schema("type string").json(f"{root}/records").groupBy("type").agg(F.count("*").alias("written"))
    return meta.join(written, "type").select("type", "n", "written", "unique")


@query("""WITH o AS (SELECT o_orderkey, 't' || o_orderkey AS target, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'failed' ELSE 'withdrawn' END AS outcome FROM orders)
 SELECT outcome AS list, target, row_number() OVER (PARTITION BY outcome ORDER BY CASE WHEN outcome = 'done' THEN target END, o_orderkey) - 1 AS place FROM o
 UNION ALL SELECT 'resolved', target || chr(9) || 'eis:' || o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 FROM o WHERE o_orderkey % 3 = 0""")
def outcome_lists(spark, sf):
    """The lists that a run leaves, read back from their parts line by line: done sorted by name, the others as they came."""
    root = scratch(spark, "outcomes")
    o = D.table(spark, sf, "orders")
    outcome = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "failed").otherwise("withdrawn")
    found = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("eis:"), F.col("o_orderkey").cast("string")))
    publish.outcomes(o.select(F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("target"), outcome.alias("outcome"), found.alias("found"), F.col("o_orderkey").alias("pos")), root)
    out = None
    for name in ("done", "failed", "withdrawn", "resolved"):
        rows = publish.listed(spark, f"{root}/{name}").withColumn("list", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out.select("list", F.col("value").alias("target"), "place")
