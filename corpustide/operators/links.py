"""From a register's notices and named targets to the platform's pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import values as V


def platform_links(notices: DataFrame, uuid: str = "uuid", page: str = "html") -> DataFrame:
    """(uuid, url): the platform page that each notice's own page links to first; a notice without a link has no row.

    A notice whose page was read several times counts once, by the smallest platform id.
    """
    found = notices.select(
        F.lower(F.trim(F.col(uuid))).alias("uuid"), C.platform_id(F.col(page)).cast("long").alias("pid")
    ).filter("uuid is not null and pid is not null")
    return found.groupBy("uuid").agg(F.min("pid").alias("pid")).select("uuid", F.concat(F.lit(V.PLATFORM_PAGE), F.col("pid").cast("string")).alias("url"))


def with_links(notices: DataFrame, links: DataFrame, uuid: str = "uuid") -> DataFrame:
    """Notices with the ``url`` of their platform page, null where none is known."""
    known = links.select(F.col("uuid").alias("_uuid"), "url")
    return notices.join(known, F.lower(F.trim(F.col(uuid))) == F.col("_uuid"), "left").drop("_uuid")


def linked(notices: DataFrame) -> DataFrame:
    """Only notices with a platform page: the others have nothing to fetch."""
    return notices.filter(F.coalesce("url", F.lit("")) != "")


def notice_uuid(target: Column) -> Column:
    """The register's id in a target, bare or within a notice's address, in lower case."""
    return F.nullif(F.lower(F.regexp_extract(target, r"([0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})", 1)), F.lit(""))


def target_urls(targets: DataFrame, links: DataFrame, target: str = "target") -> DataFrame:
    """Targets with ``url``: a platform id or address gives the platform's page, a register id the page that its notice links to, anything else null."""
    asked = F.trim(F.col(target))
    own = F.when(asked.rlike("^[0-9]+$"), F.concat(F.lit(V.PLATFORM_PAGE), asked)).otherwise(C.canonical_url(asked)["url"])
    known = links.select(F.col("uuid").alias("_uuid"), F.col("url").alias("_url"))
    rows = targets.withColumn("_asked", notice_uuid(asked)).withColumn("_own", own)
    # only targets that need a notice are joined: the others' ids are null, and nulls would all go to one task
    asks = F.col("_asked").isNotNull() & F.col("_own").isNull()
    found = rows.filter(asks).join(known, F.col("_asked") == F.col("_uuid"), "left").drop("_uuid").unionByName(rows.filter(~asks).withColumn("_url", F.lit(None).cast("string")))
    return found.withColumn("url", F.coalesce("_own", "_url")).drop("_asked", "_own", "_url")


def register_uuids(targets: DataFrame, found: DataFrame) -> DataFrame:
    """Targets (target, url) with the register's id (``uuid``) that discovery gave for the target itself, else for its page.

    found: asked (a target or an address), uuid. Of an asked one that is there several times the smallest id counts.
    """
    known = found.filter("uuid is not null").groupBy("asked").agg(F.min("uuid").alias("uuid"))
    by_target = known.select(F.col("asked").alias("target"), F.col("uuid").alias("_by_target"))
    by_url = known.select(F.col("asked").alias("url"), F.col("uuid").alias("_by_url"))
    rows = targets.join(by_target, "target", "left").join(by_url, "url", "left")
    return rows.withColumn("uuid", F.coalesce("_by_target", "_by_url")).drop("_by_target", "_by_url")
