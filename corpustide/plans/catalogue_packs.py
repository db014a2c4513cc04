"""Queries over files, downloads, scans of a register and reconciled days, each over whole tables; and the SQL of the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions import columns as C
from ..functions import values as V
from ..operators import extract, keyed, links, packs, planning, scans
from ..sources import fetch, files, publish, register
from ..streaming import runs
from . import demo_packs as P
from . import demo_views as D
from .catalogue import query

# ---------------------------------------------------------------- files into text

_TEXTS = """f AS (SELECT CAST(p_partkey AS VARCHAR) AS pid, p_partkey % 10 AS k, 'f/' || p_partkey || '.' || ['docx', 'xlsx', 'pptx', 'ifc', 'csv', 'edoc', 'dwg', 'md', 'pdf', 'rtf'][p_partkey % 10 + 1] AS path, p_name AS n, p_brand AS b, CAST(p_size AS VARCHAR) AS z FROM part),
 x AS (SELECT pid, path AS source, 'markdown' AS kind, '## ' || b || chr(10) || chr(10) || n || chr(10) || chr(10) || '### Tabula 1' || chr(10) || chr(10) || '| ' || b || ' | ' || n || ' |' AS text, NULL AS note, true AS sidecar FROM f WHERE k = 0
  UNION ALL SELECT pid, path, 'markdown', '## Lapa' || chr(10) || chr(10) || '| ' || n || ' |  | ' || z || ' |' || chr(10) || '| --- | --- | --- |' || chr(10) || '| =A1+1 |  |  |', NULL, false FROM f WHERE k = 1
  UNION ALL SELECT pid, path, 'markdown', '## Slaids 1' || chr(10) || chr(10) || n, NULL, false FROM f WHERE k = 2
  UNION ALL SELECT pid, path, 'markdown', '## Modeļa apzīmējumi (' || len(list_distinct([n, b, 'āx'])) || ' unikāli)' || chr(10) || chr(10) || array_to_string(list_transform(list_sort(list_distinct([n, b, 'āx'])), lambda s: '- ' || s), chr(10)), NULL, false FROM f WHERE k = 3
  UNION ALL SELECT pid, path, 'markdown', '| name | brand |' || chr(10) || '| --- | --- |' || chr(10) || '| ' || n || ' | ' || b || '\\|' || z || ' |', NULL, false FROM f WHERE k = 4
  UNION ALL SELECT pid, path || '/META-INF/s.xml', 'packaging', NULL, 'part of a signed container, not a document', false FROM f WHERE k = 5
  UNION ALL SELECT pid, path || '/mimetype', 'packaging', NULL, 'part of a signed container, not a document', false FROM f WHERE k = 5
  UNION ALL SELECT pid, path || '/a/in.zip/deep.md', 'markdown', n, NULL, false FROM f WHERE k = 5
  UNION ALL SELECT pid, path || '/b.txt', 'markdown', '```' || chr(10) || b || chr(10) || '```', NULL, false FROM f WHERE k = 5
  UNION ALL SELECT pid, path, 'unsupported', NULL, 'no deterministic text extraction for .dwg', false FROM f WHERE k = 6
  UNION ALL SELECT pid, path, 'unsupported', NULL, 'no text layer — a scan or a vector drawing', false FROM f WHERE k = 7
  UNION ALL SELECT pid, path, 'markdown', '## Lapa 1' || chr(10) || chr(10) || n, NULL, false FROM f WHERE k = 8
  UNION ALL SELECT pid, path, 'markdown', n || chr(10) || chr(10) || b, NULL, false FROM f WHERE k = 9)"""


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract(P.files(D.table(spark, sf, "part")))


@query(f"WITH {_TEXTS} SELECT pid, source, kind, text, note, length(text) AS chars, sidecar FROM x")
def extracted_files(spark, sf):
    """Office files, models, tables, nested archives and what can't be read, a pack for each part."""
    return _extracted(spark, sf).select("pid", "source", "kind", "text", "note", "chars", F.col("structure").isNotNull().alias("sidecar"))


@query(f"WITH {_TEXTS} SELECT count(*) AS entries, count(*) FILTER (kind = 'markdown') AS markdown, count(*) FILTER (kind = 'unsupported') AS unsupported, CAST(sum(length(text)) AS BIGINT) AS chars FROM x")
def extraction_totals(spark, sf):
    return extract.totals(_extracted(spark, sf))


@query(f"WITH {_TEXTS} SELECT kind, count(*) AS n FROM x GROUP BY kind")
def kind_tally(spark, sf):
    return packs.tally(_extracted(spark, sf))


@query(f"WITH {_TEXTS} SELECT pid, source, text, sidecar FROM x WHERE kind = 'markdown'")
def flattened_texts(spark, sf):
    """Texts under names from their content: each name is that of its key, and a sidecar goes with its text."""
    flat = extract.flattened(_extracted(spark, sf))
    named = flat.filter((F.col("path") == F.concat(F.lit("doc/"), "key", F.lit(".md"))) & F.col("key").rlike("^[0-9a-f]{16}$"))
    return packs.delivered(named).select("pid", "source", "text", F.col("structure").isNotNull().alias("sidecar"))


@query(f"WITH {_TEXTS}, m AS (SELECT pid, count(*) AS members, true AS ok, CAST(sum(length(text)) AS BIGINT) AS chars FROM x WHERE kind = 'markdown' GROUP BY pid) SELECT * FROM m")
def verified_archives(spark, sf):
    """Archives of each pack's texts: digest and members' checksums hold; beside them the texts' total."""
    texts = extract.flattened(_extracted(spark, sf))
    packed = publish.verified(publish.archives(texts.select("pid", "path", F.encode("text", "utf-8").alias("content"))))
    chars = texts.groupBy("pid").agg(F.sum(F.char_length("text")).alias("chars"))
    return packed.join(chars, "pid").select("pid", "members", "ok", "chars")


@query("""SELECT p_partkey, name, safe, plumbing, split_part(name, '.', -1) AS last FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'a/' || p_name || '.txt' WHEN 1 THEN '../' || p_name WHEN 2 THEN '/' || p_name WHEN 3 THEN 'c:/' || p_name WHEN 4 THEN 'META-INF/' || p_name ELSE 'a/..b/' || p_name END AS name,
 p_partkey % 6 IN (0, 4, 5) AS safe, p_partkey % 6 = 4 AS plumbing FROM part)""")
def member_names(spark, sf):
    """Which members of an archive stay inside it, and which are a container's own."""
    start = F.element_at(F.array(*[F.lit(x) for x in ("a/", "../", "/", "c:/", "META-INF/", "a/..b/")]), (F.col("p_partkey") % 6 + 1).cast("int"))
    rows = D.table(spark, sf, "part").select("p_partkey", F.concat(start, "p_name", F.when(F.col("p_partkey") % 6 == 0, ".txt").otherwise("")).alias("name"))
    return rows.select(
        "p_partkey", "name", C.safe_member(F.col("name")).alias("safe"), C.is_packaging(F.col("name")).alias("plumbing"),
        F.element_at(F.split("name", r"\."), -1).alias("last")
    )


@query("SELECT CAST(p_partkey AS VARCHAR) AS pid, '3' AS numid, 1 AS ilvl, 'paragraph' AS origin, substr(sha1(p_name), 1, 8) AS digest, '4' AS start, 'decimal' AS num_fmt, '%2.' AS lvl_text, true AS no_restart FROM part WHERE p_partkey % 10 = 0")
def numbering_sidecars(spark, sf):
    """The numbering that Word stores, beside the text of each document."""
    paragraph = "struct<`index`: int, numId: string, ilvl: int, `from`: string, digest: string>"
    level = "struct<start: string, numFmt: string, lvlText: string, lvlRestart: string>"
    read = F.from_json("structure", f"struct<paragraphs: array<{paragraph}>, numbering: map<string, struct<levels: map<string, {level}>>>>")
    rows = _extracted(spark, sf).filter("structure is not null").select("pid", read.alias("s")).select(
        "pid", F.explode("s.paragraphs").alias("p"), F.try_element_at("s.numbering", F.lit("3")).alias("n")
    )
    own = F.try_element_at("n.levels", F.lit("1"))
    return rows.select(
        "pid", F.col("p.numId").alias("numid"), "p.ilvl", F.col("p.from").alias("origin"), "p.digest", own["start"].alias("start"),
        own["numFmt"].alias("num_fmt"), own["lvlText"].alias("lvl_text"), own["lvlRestart"].isNull().alias("no_restart")
    )


@query("SELECT 'c' || c_nationkey AS pid, count(DISTINCT c_custkey) AS members, 1 AS digests FROM customer GROUP BY c_nationkey")
def archive_bytes(spark, sf):
    """Archives made of the same members in another order are the same, byte for byte."""
    rows = D.table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_nationkey").cast("string")).alias("pid"),
        F.concat(F.lit("doc/"), F.col("c_custkey").cast("string")).alias("path"), F.encode("c_name", "utf-8").alias("content")
    )
    both = publish.archives(rows).unionByName(publish.archives(rows.unionByName(rows.filter("path like '%1'")).repartition(5, "path")))
    return both.groupBy("pid").agg(F.max("members").alias("members"), F.count_distinct("sha256").cast("int").alias("digests"))


# ---------------------------------------------------------------- downloads


def _fetched(spark, sf) -> DataFrame:
    number = F.col("c_custkey").cast("string")
    rows = D.table(spark, sf, "customer").select(
        number.alias("target"), number.alias("pid"), F.concat(F.lit(V.PLATFORM_PAGE), number).alias("url"),
        F.array().cast("array<string>").alias("done")
    )
    # the stand-in asks for no single stream
    return fetch.fetch(rows, "corpustide.plans.demo_packs:Portal", pause=0.0, streams=int(spark.conf.get("spark.sql.shuffle.partitions")))


@query("""WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS pid FROM customer WHERE c_custkey % 7 <> 0)
 SELECT pid, '1' AS record_id, 'actual' AS section, 'zip' AS method, 'a.txt' AS filename, 'actual/a.txt' AS path, false AS duplicate, sha256('first ' || pid) AS sha256, strlen('first ' || pid) AS size FROM c
 UNION ALL SELECT pid, '1', 'actual', 'zip', 'b.txt', 'actual/b.txt', false, sha256('same'), 4 FROM c
 UNION ALL SELECT pid, '3', 'archive', 'files', 'b.txt', 'actual/b.txt', true, sha256('same'), 4 FROM c
 UNION ALL SELECT pid, '3', 'archive', 'files', 'a.txt', 'archive/a.txt', false, sha256('other ' || pid), strlen('other ' || pid) FROM c""")
def fetched_files(spark, sf):
    """Files of a download through both routes: a record's archive, else each file on its own; bytes met before are a duplicate."""
    return _fetched(spark, sf).filter("outcome = 'file'").select("pid", "record_id", "section", "method", "filename", "path", "duplicate", "sha256", "size")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS pid, CASE WHEN c_custkey % 7 = 0 THEN 'withdrawn' ELSE 'done' END AS outcome, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS withheld FROM customer""")
def fetch_outcomes(spark, sf):
    """How each target ended, and how many of its records the platform withholds."""
    # one pass over the download: asking the platform again would be no replay
    ended = F.max(F.when(F.col("outcome").isin("done", "failed", "withdrawn"), F.col("outcome")))
    by = _fetched(spark, sf).groupBy("target", "pid").agg(ended.alias("outcome"), F.count_if("withheld").cast("int").alias("withheld"))
    return by.select("pid", "outcome", "withheld")


@query("""SELECT 'eis:' || c_custkey AS key, 'target' AS outcome FROM customer UNION ALL SELECT 'eis:' || c_custkey, 'withdrawn' FROM customer WHERE c_custkey % 7 = 0""")
def shard_accounts(spark, sf):
    """What a shard was asked for, and what of it failed or was withdrawn."""
    from . import lifecycle

    c = D.table(spark, sf, "customer")
    targets = c.select(F.col("c_custkey").cast("string").alias("target"), F.concat(F.lit("eis:"), F.col("c_custkey").cast("string")).alias("key"))
    ended = F.when(F.col("c_custkey") % 7 == 0, "withdrawn").otherwise("done")
    return lifecycle.account(c.select(F.col("c_custkey").cast("string").alias("target"), ended.alias("outcome")), targets)


# ---------------------------------------------------------------- the register


@query("""WITH r AS (SELECT CAST(p_partkey AS VARCHAR) AS key, p_type AS type, CAST((row_number() OVER (ORDER BY p_partkey) - 1) // 500 AS INTEGER) AS page FROM part) SELECT key, type, page FROM r""")
def register_scan(spark, sf):
    """A paged scan, each record once, where it came first; pages repeat some records of the page before."""
    register.install(spark)
    rows = spark.read.format("register").option("transport", "corpustide.plans.demo_packs:register_page").option("from", sf).option("pause", "0").load()
    kind = F.from_json("record", "identifier string, type string")["type"]
    return keyed.first_per_key(rows, ["key"], ["pos"]).select("key", kind.alias("type"), "page")


_POLICY = {"recall": ["bolt", "gear", "Plate"], "prefixes": ["4"], "excluded": ["red"]}


@query("""WITH n AS (SELECT p_partkey, p_name AS title, CAST(p_size AS VARCHAR) AS code, p_size % 3 AS k, lower(p_name || ' ' || p_type) AS t FROM part)
 SELECT CAST(p_partkey AS VARCHAR) AS uuid, title FROM n WHERE k < 2 AND NOT contains(t, 'red') AND NOT starts_with(code, '4') AND (contains(t, 'bolt') OR contains(t, 'gear') OR contains(t, 'plate'))""")
def discovered(spark, sf):
    """Biddable notices of a whole scan that the policy leaves in; the scan is proven first."""
    from . import lifecycle

    none = F.lit(None).cast("string")
    p = D.table(spark, sf, "part")
    key = F.col("p_partkey").cast("string")
    cpv = F.array(F.struct(F.col("p_size").cast("string").alias("code"), F.lit("c").alias("caption")))
    kind = F.element_at(F.array(F.lit("competition"), F.lit("planning"), F.lit("result")), (F.col("p_size") % 3 + 1).cast("int"))
    raw = p.select(
        F.col("p_partkey").alias("pos"), key.alias("identifier"), none.alias("externalId"), none.alias("procurementIdentifier"),
        F.concat_ws(" ", "p_name", "p_type").alias("name"), F.col("p_name").alias("organizationName"),
        none.alias("organizationIdentifier"), F.lit("2026-01-01T10:00:00Z").alias("publicationDate"), none.alias("date"),
        none.alias("amount"), none.alias("currency"), cpv.alias("cpvCodes"), kind.alias("type"), none.alias("procedureType"),
        none.alias("procedureLegalBasis"), F.lit(None).cast("boolean").alias("euFund")
    )
    return lifecycle.discover(raw.unionByName(raw.filter("pos % 50 = 0")), p.count(), 1, policy=_POLICY).select("uuid", F.col("buyer").alias("title"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS target FROM orders WHERE o_orderkey % 5 < 3")
def named_list(spark, sf):
    """Targets of a list with a byte-order mark, comments and blanks."""
    k = F.col("o_orderkey").cast("string")
    line = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit("\ufeff"), k)).when(
        F.col("o_orderkey") % 5 == 1, F.concat(F.lit("  "), k, F.lit("  # why"))
    ).when(F.col("o_orderkey") % 5 == 2, k).when(F.col("o_orderkey") % 5 == 3, F.concat(F.lit("# "), k)).otherwise("   ")
    return planning.named_targets(D.table(spark, sf, "orders").select(line.alias("value")))


@query("""WITH r AS (SELECT 'u' || o_orderkey AS asked, CASE o_orderkey % 3 WHEN 0 THEN '-' WHEN 1 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS found FROM orders) SELECT asked, found FROM r WHERE found NOT IN ('-', '')""")
def resolutions(spark, sf):
    found = F.when(F.col("o_orderkey") % 3 == 0, "-").when(F.col("o_orderkey") % 3 == 1, F.col("o_orderkey").cast("string")).otherwise("")
    return keyed.resolutions(D.table(spark, sf, "orders").select(F.concat(F.lit("u"), F.col("o_orderkey").cast("string")).alias("asked"), found.alias("found")))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'a' || o_orderkey WHEN o_orderkey % 3 = 1 THEN 'b' || o_orderkey END AS uuid FROM orders""")
def target_uuids(spark, sf):
    """The register's id of each target: by the target itself, else by its page."""
    o = D.table(spark, sf, "orders")
    number = F.col("o_orderkey").cast("string")
    targets = o.select("o_orderkey", F.concat(F.lit("t"), number).alias("target"), F.concat(F.lit(V.PLATFORM_PAGE), number).alias("url"))
    by_target = o.filter("o_orderkey % 3 = 0").select(F.concat(F.lit("t"), number).alias("asked"), F.concat(F.lit("a"), number).alias("uuid"))
    by_url = o.filter("o_orderkey % 3 < 2").select(F.concat(F.lit(V.PLATFORM_PAGE), number).alias("asked"), F.concat(F.lit("b"), number).alias("uuid"))
    return links.register_uuids(targets, by_target.unionByName(by_url)).select("o_orderkey", "uuid")


@query("SELECT count(DISTINCT o_orderkey) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def overlap(spark, sf):
    """How many targets of a named list the window found as well."""
    from . import lifecycle

    named = D.table(spark, sf, "lineitem").select(F.concat(F.lit(V.PLATFORM_PAGE), F.col("l_orderkey").cast("string")).alias("target"))
    window = D.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("target"))
    return spark.range(1).select(F.lit(lifecycle.overlap(window, named)).cast("long").alias("n"))


@query("""SELECT p_partkey, 'p' || p_partkey AS key, CAST(('0x' || substr(sha256('p' || p_partkey), 1, 16))::UBIGINT % 3 + 1 AS INTEGER) = 2 AS mine, true AS alone, false AS beyond FROM part""")
def shard_choice(spark, sf):
    """Whether a key is in the second shard of three; of one shard everything is; beyond the last, nothing."""
    key = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    return D.table(spark, sf, "part").select(
        "p_partkey", key.alias("key"), C.take_shard(key, 2, 3).alias("mine"), C.take_shard(key, 1, 1).alias("alone"),
        C.take_shard(key, 4, 3).alias("beyond")
    )


@query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'lv' WHEN page_id % 4 = 1 THEN 'lv' WHEN page_id % 4 = 2 THEN 'en' END AS language, CASE WHEN page_id % 4 = 2 THEN url END AS status FROM pages")
def page_languages(spark, sf):
    """A page's language by its status label, and that field by its label."""
    lv, en = V.LANGUAGE_LABELS[0][1], V.LANGUAGE_LABELS[1][1]
    k = F.col("page_id") % 4
    fields = F.when(
        k == 0, F.create_map(F.lit(lv), F.lit(None).cast("string"), F.lit(en), F.lit(None).cast("string"))
    ).when(k == 1, F.create_map(F.lit(lv), F.lit(None).cast("string"))).when(k == 2, F.create_map(F.lit(en), F.col("url"))).otherwise(F.create_map(F.lit("x"), F.lit("y")))
    p = D.table(spark, sf, "pages").select("page_id", fields.alias("fields"))
    return p.select("page_id", C.page_language(F.col("fields")).alias("language"), C.field(F.col("fields"), "status").alias("status"))


# ---------------------------------------------------------------- days


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def notices_per_day(spark, sf):
    """Notices by day (UTC) and kind; the same plan runs on a stream."""
    return runs.per_day(D.table(spark, sf, "events"), "ts", "event_type")


def _streamed(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """What a stream says in update mode until its input is read, with the number of its batch."""
    out, at = files.scratch(spark, name), files.scratch(spark, "progress")
    write = lambda df, n: df.withColumn("batch", F.lit(n).cast("long")).write.mode("append").parquet(out)
    schema = StructType([*rows.schema.fields, StructField("batch", LongType())])
    rows.writeStream.outputMode("update").option("checkpointLocation", at).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.schema(schema).parquet(out)


def _events(spark, sf) -> DataFrame:
    """The events table as a stream of its files."""
    rows = spark.readStream.schema(D.table(spark, sf, "events").schema).parquet(f"{sf}/event[s].parquet")
    return rows.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))  # the table's times are UTC


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_days(spark, sf):
    """Notices by day and kind, counted over a stream with a watermark: of each window what was said last."""
    rows = _streamed(spark, runs.per_day(_events(spark, sf).withWatermark("ts", "40 days"), "ts", "event_type"), "days")
    return rows.groupBy("day", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query("SELECT DISTINCT user_id FROM events")
def stream_once(spark, sf):
    """Each key once over a stream that brings it again, while the watermark remembers it."""
    return _streamed(spark, runs.deduplicated(_events(spark, sf), "user_id", "ts", "60 days").select("user_id"), "once").select("user_id")


@query("""SELECT CAST(user_id AS VARCHAR) AS pid, CAST(min_by(CAST(ts AS DATE), event_id) AS VARCHAR) AS first_seen, CAST(max_by(CAST(ts AS DATE), event_id) AS VARCHAR) AS last_seen,
 CAST(max_by(CAST(ts AS DATE), event_id) FILTER (WHERE event_type <> 'view') AS VARCHAR) AS last_change FROM events GROUP BY user_id""")
def stream_seen(spark, sf):
    """The state of each item over a stream of runs."""
    e = _events(spark, sf).select(
        F.col("user_id").cast("string").alias("pid"), F.to_utc_timestamp("ts", F.current_timezone()).cast("date").cast("string").alias("date"),
        F.col("event_id").alias("seq"), F.when(F.col("event_type") == "view", "unchanged").otherwise("changed").alias("status")
    )
    last = lambda c: F.max_by(c, "batch").alias(c)
    return _streamed(spark, runs.seen(e), "seen").groupBy("pid").agg(last("first_seen"), last("last_seen"), last("last_change"))


#: Events of the table for one part of each of its files.
EVENTS = 1_000_000

#: Events in seven files: five of six days each, every tenth event two files later than its own time.
_FILES = """f AS (SELECT *, least((day(ts) - 1) // 6, 4) + CASE WHEN event_id % 10 = 3 THEN 2 ELSE 0 END AS file FROM events)"""


def _put_files(spark: SparkSession, sf: str, at: str, which: range = range(7)) -> DataFrame:
    """Some of seven files of the events table below a folder, in the order that they came, some events late; and a stream of them, one a batch.

    A large table's file is a number of parts, the same for all, so that no task writes or reads a whole one.
    """
    e = D.table(spark, sf, "events")
    file = F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4)) + F.when(F.col("event_id") % 10 == 3, 2).otherwise(0)
    rows = e.withColumn("ts", F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()))
    parts = e.count() // EVENTS + 1
    for k in which:  # a stream takes files by the time at which they were written
        one = rows.filter(file == k)
        (one.coalesce(1) if parts == 1 else one.repartition(parts, "event_id")).write.mode("append").parquet(at)
        there = len(spark.read.schema(rows.schema).parquet(at).inputFiles())
        for _ in range(there, parts * (k + 1)):  # parts without rows are not written
            one.limit(0).coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", parts).parquet(at)


#: A batch drops days that ended before the watermark that held when the batch before it began: a day behind the newest event of all files before that.
_LATE = f"""{_FILES}, m AS (SELECT file, max(max(ts)) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 1 DAY AS mark FROM f GROUP BY file),
 l AS (SELECT f.*, CAST(ts AS DATE) AS day, coalesce(CAST(ts AS DATE) + INTERVAL 1 DAY <= date_trunc('millisecond', mark), false) AS late FROM f JOIN m USING (file))"""


@query(f"WITH {_LATE} SELECT day, event_type, count(*) AS n FROM l WHERE NOT late GROUP BY 1, 2")
def stream_late_days(spark, sf):
    """Events by day and kind over a stream of several files, a day's patience: those that come later are not counted."""
    rows = _streamed(spark, runs.per_day(_put_files(spark, sf, files.scratch(spark, "late")).withWatermark("ts", "1 day"), "ts", "event_type"), "late-days")
    return rows.groupBy("day", "event_type").agg(F.max_by("n", "batch").alias("n"))


@query(f"WITH {_LATE} SELECT CAST(file AS BIGINT) AS batch, count(DISTINCT (day, event_type)) AS dropped FROM l WHERE late GROUP BY 1")
def stream_dropped(spark, sf):
    """What each batch of the same stream dropped as too late, from the stream's progress: rows of days and kinds, summed before they meet the state."""
    told = runs.Dropped()
    spark.streams.addListener(told)
    try:
        _streamed(spark, runs.per_day(_put_files(spark, sf, files.scratch(spark, "dropped")).withWatermark("ts", "1 day"), "ts", "event_type"), "dropped-days")
        told.ended.wait(60)
    finally:
        spark.streams.removeListener(told)
    return spark.createDataFrame([(b, n) for b, n in told.by_batch.items() if n], "batch long, dropped long")


@query(f"""WITH r AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events WHERE event_id % 10 <> 3),
 s AS (SELECT *, count(*) FILTER (before IS NULL OR date_trunc('millisecond', ts) > date_trunc('millisecond', before) + INTERVAL 48 HOUR) OVER (PARTITION BY user_id ORDER BY event_id) AS spell FROM r)
 SELECT CAST(user_id AS VARCHAR) AS pid, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_seen, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_seen, CAST(max_by(CAST(ts AS DATE), event_id) FILTER (WHERE event_type <> 'view') AS VARCHAR) AS last_change,
  epoch_ms(max(ts)) + 48 * 3600000 < (SELECT epoch_ms(max(ts)) FROM r) AS forgotten FROM (SELECT *, max(spell) OVER (PARTITION BY user_id) AS latest FROM s) WHERE spell = latest GROUP BY user_id""")
def stream_forgotten(spark, sf):
    """Items over a stream of several files that ended and was started again; an item not seen for two days leaves the state."""
    import datetime

    source, at, out = (files.scratch(spark, name) for name in ("forgotten", "progress", "forgotten-rows"))
    write = lambda df, n: df.withColumn("batch", F.lit(n).cast("long")).write.mode("append").parquet(out)
    for which in (range(3), range(3, 7)):  # the second stream goes on from the first one's state
        events = _put_files(spark, sf, source, which).filter("event_id % 10 <> 3")
        rows = runs.seen_lately(
            events.select(
                F.col("user_id").cast("string").alias("pid"), F.to_utc_timestamp("ts", F.current_timezone()).cast("date").cast("string").alias("date"),
                F.col("event_id").alias("seq"), F.when(F.col("event_type") == "view", "unchanged").otherwise("changed").alias("status"), F.col("ts").alias("stamp")
            ),
            datetime.timedelta(days=2)
        )
        rows.writeStream.outputMode("update").option("checkpointLocation", at).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
    told = spark.read.schema(StructType([*rows.schema.fields, StructField("batch", LongType())])).parquet(out)
    # a batch in which an item comes and goes says both
    return told.groupBy("pid").agg(F.max_by(F.struct("first_seen", "last_seen", "last_change", "forgotten"), F.struct("batch", "forgotten")).alias("r")).select("pid", "r.*")


@query("SELECT * FROM (VALUES (1, 'present'), (2, 'stale'), (3, 'present'), (4, 'missing')) t(shard, state)")
def shard_states(spark, sf):
    """Each expected shard as present, stale or missing; an index without a run counts as present."""
    rows = D.table(spark, sf, "region").filter("r_regionkey < 3").select(
        (F.col("r_regionkey") + 1).cast("int").alias("shard"),
        F.when(F.col("r_regionkey") == 0, "now").when(F.col("r_regionkey") == 1, "old").alias("run_id")
    )
    return planning.fresh_shards(rows, "now", 4)


_DAY = """e AS (SELECT l_orderkey AS pid, l_suppkey % 4 + 1 AS shard, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS status, l_partkey AS pos, CAST(l_quantity AS BIGINT) AS chars FROM lineitem WHERE l_suppkey % 4 < 3),
 t AS (SELECT pid, max_by(status, (shard, pos, chars, coalesce(status, ''))) AS status, max_by(chars, (shard, pos, chars, coalesce(status, ''))) AS chars FROM (SELECT pid, shard, pos, chars, coalesce(status, 'unknown') AS status FROM e) GROUP BY pid)"""


def _day(spark, sf) -> dict[str, DataFrame]:
    l, o = D.table(spark, sf, "lineitem"), D.table(spark, sf, "orders")
    indexes = spark.createDataFrame([(1, "now"), (2, "now"), (3, None), (4, "old")], "shard int, run_id string")
    chars, status = F.col("l_quantity").cast("long"), F.coalesce(F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")), F.lit("unknown"))
    entries = l.select(
        F.col("l_orderkey").cast("string").alias("pid"), (F.col("l_suppkey") % 4 + 1).cast("int").alias("shard"),
        F.struct(F.col("l_partkey"), chars.alias("c"), status.alias("s")).alias("pos"),
        F.when(status != "unknown", status).alias("status"), F.lit(1).cast("long").alias("documents"), chars.alias("chars"),
        F.lit(0).cast("long").alias("unreadable")
    )
    key = F.concat(F.lit("eis:"), F.col("o_orderkey").cast("string"))
    accounts = o.select(F.lit(1).alias("shard"), key.alias("key"), F.lit("target").alias("outcome"))
    none = spark.createDataFrame([], "shard int, asked string, found string")
    return planning.collect_day(indexes, entries, accounts, none, "now", 4, 3)


@query(f"WITH {_DAY} SELECT status, count(*) AS tenders, CAST(count(*) AS BIGINT) AS documents, CAST(sum(chars) AS BIGINT) AS chars, CAST(0 AS BIGINT) AS unreadable FROM t GROUP BY status")
def collected_day(spark, sf):
    """A day from its shards, the last entry of each item; a stale shard's do not count."""
    return _day(spark, sf)["counts"]


@query(f"WITH {_DAY} SELECT 'eis:' || o_orderkey AS key FROM orders WHERE o_orderkey NOT IN (SELECT pid FROM t)")
def collected_lost(spark, sf):
    """Targets of a day that no fresh shard delivered."""
    return _day(spark, sf)["unaccounted"]


# ---------------------------------------------------------------- scans and delivery


@query("""SELECT count(*) FILTER (p_size % 4 = 0) AS read, count(*) FILTER (p_size % 4 = 1) AS empty, count(*) FILTER (p_size % 4 = 2) AS failed, count(*) FILTER (p_size % 4 = 3) AS deferred, CAST(sum(CASE WHEN p_size % 4 = 0 THEN length(p_name) ELSE 0 END) AS BIGINT) AS chars FROM part""")
def scan_totals(spark, sf):
    outcome = F.element_at(F.array(*[F.lit(x) for x in ("read", "empty", "failed", "deferred")]), (F.col("p_size") % 4 + 1).cast("int"))
    return scans.totals(D.table(spark, sf, "part").select(outcome.alias("outcome"), F.when(F.col("p_size") % 4 == 0, F.col("p_name")).alias("text")))


@query("SELECT 'c' || o_custkey AS pid, 'file:///d1/' || min(o_orderkey) AS uri, CAST(sum(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey END) AS BIGINT) AS chars FROM orders GROUP BY o_custkey")
def entry_sizes(spark, sf):
    """Address and characters of index entries; documents whose length is not known count nothing."""
    doc = F.struct(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey")).alias("chars"))
    by = D.table(spark, sf, "orders").groupBy(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("pid")).agg(
        F.collect_list(doc).alias("documents"), F.min("o_orderkey").cast("string").alias("item")
    )
    return by.select("pid", C.item_uri(F.lit("d1"), F.col("item")).alias("uri"), C.entry_chars(F.col("documents")).alias("chars"))


@query("""SELECT path FROM (SELECT CASE p_partkey % 4 WHEN 0 THEN p_partkey || '/manifest.json' WHEN 1 THEN p_partkey || '/doc/' || substr(sha256(CAST(p_partkey AS VARCHAR)), 1, 16) || '.md' WHEN 2 THEN p_partkey || '/original/a.pdf' ELSE p_partkey || '/media/b.png' END AS path, p_partkey FROM part) WHERE p_partkey % 4 < 2""")
def delivered_names(spark, sf):
    """What is ever delivered of a pack's files."""
    k, text = F.col("p_partkey") % 4, F.col("p_partkey").cast("string")
    name = F.when(k == 0, "/manifest.json").when(
        k == 1, F.concat(F.lit("/doc/"), F.substring(F.sha2(text, 256), 1, 16), F.lit(".md"))
    ).when(k == 2, "/original/a.pdf").otherwise("/media/b.png")
    return packs.delivered(D.table(spark, sf, "part").select(F.concat(text, name).alias("path")))


@query("""WITH d AS (SELECT o_custkey AS c, o_orderkey AS k, sha256('f' || o_orderkey) AS h, 'a/' || o_orderkey || '.pdf' AS source FROM orders),
 n AS (SELECT c, count(*) FILTER (k % 5 <> 0) AS documents, count(*) FILTER (k % 5 = 0) AS unreadable, min(CASE WHEN k % 5 <> 0 THEN 'doc/' || substr(sha256(h || chr(10) || source), 1, 16) || '.md' END) AS first FROM d GROUP BY c)
 SELECT 'c' || c_custkey AS pid, 'EIS:c' || c_custkey AS key, c_name AS title, coalesce(documents, 0) AS documents, coalesce(unreadable, 0) AS unreadable, first FROM customer LEFT JOIN n ON c = c_custkey""")
def index_rows(spark, sf):
    """One index row for each item: its documents with their addresses, and what could not be read."""
    from . import lifecycle

    o = D.table(spark, sf, "orders").withColumn("pid", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    facts = D.table(spark, sf, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("pid"), F.col("c_name").alias("title"))
    source = F.concat(F.lit("a/"), F.col("o_orderkey").cast("string"), F.lit(".pdf"))
    none = F.lit(None).cast("string")
    entries = o.filter("o_orderkey % 5 <> 0").select(
        "pid", F.sha2(F.concat(F.lit("f"), F.col("o_orderkey").cast("string")), 256).alias("original_sha256"),
        source.alias("source"), F.lit("actual").alias("section"), none.alias("record_title"), none.alias("also_listed_under"),
        source.alias("markdown_path"), F.lit(1).alias("markdown_chars"), F.col("o_orderkey").alias("pos")
    )
    gaps = o.filter("o_orderkey % 5 = 0").select("pid", source.alias("file"), F.lit("conversion failed").alias("reason"))
    rows = lifecycle.index_entries(facts, entries, gaps, spark.createDataFrame([], "pid string, key string, download string"))
    return rows.select(
        "pid", "key", "title", F.size("documents").cast("long").alias("documents"),
        F.size("unreadable").cast("long").alias("unreadable"),
        F.array_min(F.transform("documents", lambda d: d["path"])).alias("first")
    )


@query("SELECT 'c' || c_custkey AS pid, 'new' AS status FROM customer WHERE c_custkey % 3 = 0")
def publishable_only(spark, sf):
    """Only items on the list of those that ended well are delivered; the others keep what they had."""
    from . import lifecycle

    previous, current = D.states(spark, sf)
    listed = D.table(spark, sf, "customer").filter("c_custkey % 3 = 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("pid"))
    nothing = {k: df.filter("false") for k, df in previous.items()}
    return lifecycle.deliver(nothing, current, listed)["changes"].select("pid", "status")


@query("SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(DISTINCT o_custkey) AS BIGINT) AS items FROM orders")
def journal_lines(spark, sf):
    """A journal of one JSON line a record, read back: every line, and the last of each item."""
    o = D.table(spark, sf, "orders")
    journal = o.select(
        F.col("o_orderkey").alias("line"),
        F.to_json(F.struct(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderstatus").alias("state"))).alias("value")
    )
    both = journal.agg(F.count("*").alias("lines"))
    items = keyed.replay(journal, schema="id string, state string").agg(F.count("*").alias("items"))
    return both.withColumn("_one", F.lit(1)).join(items.withColumn("_one", F.lit(1)), "_one").select("lines", "items")


