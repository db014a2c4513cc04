"""Stand-ins for the entities of a document corpus, made of the driver's tables.

Items are the ``source`` values of documents, records are orders, files line items, the journal and run log events.
Two states of the same table differ by edits that a digest decides (a hex digit of the row's own), so that every
branch of the comparison is reached. Every row is in one state at least.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def digit(x: Column, n: int = 1) -> Column:
    return F.substring(F.sha2(x.cast("string"), 256), n, 1)


def items(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(previous, current) heads of the items: pid, tool, parser, language."""
    pids = table(spark, sf_dir, "documents").select(F.col("source").alias("pid")).distinct()
    flip = lambda n, digits, a, b: F.when(digit(F.col("pid"), n).isin(*digits), b).otherwise(a)
    previous = pids.filter(~digit(F.col("pid"), 4).isin("0", "1")).select(
        "pid", F.lit("t1").alias("tool"), F.lit("p1").alias("parser"), F.lit("lv").alias("language")
    )
    current = pids.select(
        "pid", flip(3, "01234567", "t1", "t2").alias("tool"), flip(2, "0123", "p1", "p2").alias("parser"),
        flip(1, "0123", "lv", "en").alias("language")
    )
    return previous, current


def extracted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(previous, current) extracted documents in the shape of a normalised manifest."""
    d = table(spark, sf_dir, "documents")
    first = F.sha2("text", 256)

    def shape(rows: DataFrame, sha: Column) -> DataFrame:
        return rows.select(
            F.col("source").alias("pid"), sha.alias("original_sha256"),
            F.concat(F.lit("a/"), F.col("doc_id").cast("string")).alias("path"), F.col("doc_id").alias("pos"),
            F.col("lang").alias("section"), F.char_length("text").cast("long").alias("markdown_chars")
        ).select(
            "pid", "original_sha256", F.col("path").alias("source"), "pos", "section", F.lit(None).cast("string").alias("original_file"), F.lit(None).cast("string").alias("record_title"), F.lit(None).cast("string").alias("record_id"), F.lit(None).cast("string").alias("also_listed_under"), F.col("path").alias("markdown_path"), "markdown_chars"
        )

    known = d.filter(~digit(F.col("source"), 4).isin("0", "1"))
    previous = shape(known.filter(F.substring(first, 1, 1) != "0"), first)
    edited = F.when(F.substring(first, 1, 1) == "7", F.sha2(F.concat("text", F.lit(".")), 256)).otherwise(first)
    current = shape(d.filter((F.substring(first, 1, 1) != "f") | digit(F.col("source"), 4).isin("0", "1")), edited)
    return previous, current


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable files, of parts: file, bytes, sha256, reason, path, source, pos."""
    p = table(spark, sf_dir, "part")
    ext = F.element_at(F.array(*[F.lit(x) for x in (".pdf", ".jpg", ".dwg", ".zip", ".docx")]), (F.pmod("p_size", F.lit(5)) + 1).cast("int"))
    reason = F.when(F.col("p_size") < 20, "no text layer — a scan or a vector drawing").when(F.col("p_size") < 40, "conversion failed: damaged").otherwise("no deterministic text extraction")
    digest = F.when(digit(F.col("p_partkey")) == "0", "").otherwise(F.sha2(F.concat("p_name", "p_brand"), 256))
    return p.select(
        F.concat("p_name", ext).alias("file"), (F.col("p_size").cast("long") * 400_000).alias("bytes"), digest.alias("sha256"), reason.alias("reason"), F.when(
            digit(F.col("p_partkey"), 2) == "1", F.concat(F.lit("unpacked/"), F.col("p_partkey").cast("string"))
        ).alias("path"), F.col("p_name").alias("source"), F.col("p_partkey").alias("pos")
    )


#: Line items of one bucket of :func:`kept`.
LINES = 100_000


def kept(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Orders by their customers (pid), each with its line items as downloaded, and the number of buckets they lie in.

    A table in the shared scratch folder, written once by an application for a folder of tables: whatever compares states
    of items reads it where it lies. Numbers are kept, digests are taken of them when they are asked for, as a digest is
    longer than all that it is of. Buckets hold about as many rows at any size.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _KEPT:
        o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
        count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), l.count() // LINES + 1)
        line = F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
        by = l.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity").repartition(count, "l_orderkey").groupBy("l_orderkey").agg(F.collect_list(line).alias("lines"))
        own = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus").repartition(count, "o_orderkey")
        rows = own.join(by, own["o_orderkey"] == by["l_orderkey"], "left").select(
            F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("pid"), "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", "lines"
        )
        name = f"kept_{uuid.uuid4().hex}"
        rows.repartition(count, "pid").write.bucketBy(count, "pid").option("path", scratch(spark, "kept")).option("compression", "zstd").format("parquet").saveAsTable(name)
        _KEPT[place] = (name, count)
    name, count = _KEPT[place]
    return spark.table(name), count


_KEPT: dict[tuple[str, str], tuple[str, int]] = {}


def _digest(line: Column) -> Column:
    """A line item's own digest."""
    return F.sha2(F.concat_ws("-", F.col("o_orderkey"), line["l_partkey"], line["l_suppkey"], line["l_linenumber"]), 256)


def records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(previous, current) records, of orders and their line items: pid, id, publish_date, title, type_code, section, withheld, files (map)."""
    file = lambda x: F.struct(_digest(x).alias("d"), F.concat(F.lit("f"), x["l_linenumber"].cast("string")).alias("n"))
    files = F.array_distinct(F.array_sort(F.transform("lines", file)))
    rows = kept(spark, sf_dir)[0].select(
        "pid", "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus", digit(F.col("o_orderkey")).alias("digit"),
        F.coalesce(files, F.array().cast("array<struct<d: string, n: string>>")).alias("fs")
    )
    key = F.col("digit")

    def shape(df: DataFrame, date: Column, title: Column, keep: Column) -> DataFrame:
        return df.select(
            "pid", F.col("o_orderkey").cast("string").alias("id"), date.alias("publish_date"), title.alias("title"), F.col("o_orderpriority").alias("type_code"), F.when(F.col("o_orderstatus") == "F", "archive").otherwise("actual").alias("section"), F.lit(False).alias("withheld"), F.map_from_entries(F.filter("fs", keep)).alias("files")
        )

    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    previous = shape(rows.filter(key != "0"), day, F.col("o_orderpriority"), lambda f: f["d"].substr(1, 1) != "3")
    current = shape(
        rows.filter(key != "f"), F.when(key == "7", F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd")).otherwise(day),
        F.when(key == "8", F.concat("o_orderpriority", F.lit("!"))).otherwise(F.col("o_orderpriority")),
        lambda f: f["d"].substr(1, 1) != "4"
    )
    return previous, current


def facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(previous facts, current facts, previous heads, current heads), of customers: wide facts as text."""
    c = table(spark, sf_dir, "customer").withColumn("pid", F.concat(F.lit("c"), F.col("c_custkey").cast("string")))
    d = lambda n: digit(F.col("c_custkey"), n)
    base = dict(
        title=F.col("c_name"), status=F.col("c_mktsegment"), value=F.format_string("%.2f", "c_acctbal"),
        buyer=F.concat(F.lit("n"), F.col("c_nationkey").cast("string")), deadline=F.lit(None).cast("string")
    )
    edits = dict(
        title=F.when(d(1) == "1", F.concat("c_name", F.lit("*"))).otherwise(base["title"]),
        status=F.when(d(1).isin("2", "1"), F.lower("c_mktsegment")).otherwise(base["status"]),
        deadline=F.when(d(2) == "2", "2026-01-01"), buyer=F.when(d(2) == "3", None).otherwise(base["buyer"])
    )
    wide = lambda cols: c.select("pid", *[v.alias(k) for k, v in cols.items()])
    old = c.select("pid", F.lit("t1").alias("tool"), F.lit("p1").alias("parser"), F.when(d(3) == "0", None).otherwise(F.lit("lv")).alias("language"))
    new = c.select(
        "pid", F.lit("t1").alias("tool"), F.when(d(4).isin("0", "1"), "p2").otherwise("p1").alias("parser"),
        F.when(d(3).isin("0", "1", "2", "3"), "en").otherwise("lv").alias("language")
    )
    return wide(base), wide(base | edits), old, new


#: Tables of :func:`states` that lie in the buckets of :func:`kept`.
DEALT = ("records", "documents", "unreadable")


def states(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(previous, current) whole states, of customers: heads, facts, records (orders), documents and unreadable files (line items).

    A customer whose digest has 0 in its fifth place is new, one with 0 or 1 in its sixth was extracted by another tool.
    """
    wide_was, wide_now, old, new = facts(spark, sf_dir)
    records_was, records_now = records(spark, sf_dir)
    key = lambda pid: F.substring(pid, 2, 20)  # noqa: E731  the customer's number, which the digests are of
    known = lambda df: df.filter(digit(key(F.col("pid")), 5) != "0")
    items_now = new.withColumn("tool", F.when(digit(key(F.col("pid")), 6).isin("0", "1"), "t2").otherwise("t1"))
    line = lambda x: F.struct(  # noqa: E731  one digest a line, though filters ask for it again and again
        _digest(x).alias("d"), F.concat(F.lit("a/"), F.col("o_orderkey").cast("string"), F.lit("/"), x["l_linenumber"].cast("string")).alias("source"),
        (x["l_quantity"] > 45).alias("unread"), x["l_quantity"].cast("long").alias("n")
    )
    lines = kept(spark, sf_dir)[0].select("pid", F.explode_outer(F.transform("lines", line)).alias("x")).filter("x is not null").select("pid", "x.*")
    at = lambda k: F.substring("d", k, 1)

    def side(heads: DataFrame, wide: DataFrame, recs: DataFrame, gone: str, fixed: str, cut) -> dict[str, DataFrame]:
        from ..operators import diff

        mine = cut(lines.filter(at(2) != gone))
        entries = mine.filter(~F.col("unread") | (at(3) == fixed)).select(
            "pid", F.col("d").alias("original_sha256"), "source", F.lit("actual").alias("section"),
            F.lit(None).cast("string").alias("original_file"), F.lit(None).cast("string").alias("record_title"),
            F.lit(None).cast("string").alias("record_id"), F.lit(None).cast("string").alias("also_listed_under"),
            F.col("source").alias("markdown_path"), F.col("n").alias("markdown_chars"), F.lit(0).alias("pos")
        )
        gaps_ = mine.filter(F.col("unread") & (at(3) != fixed)).select(
            "pid", F.col("source").alias("file"), F.col("n").alias("bytes"), F.when(at(4) != "0", F.col("d")).alias("sha256"),
            F.lit("conversion failed").alias("reason")
        )
        return {
            "heads": cut(heads), "facts": diff.long_facts(cut(wide)), "records": cut(recs),
            "documents": diff.document_state(entries), "unreadable": diff.unreadable_state(gaps_)
        }

    return side(old, wide_was, records_was, "1", "x", known), side(items_now, wide_now, records_now, "2", "0", lambda df: df)
