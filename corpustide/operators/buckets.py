"""States as bucketed tables, so that comparing a day with the day before moves the new day's rows only.

Each table of a state is written once in a fixed number of buckets of its item, sorted by item and child key. The next
day's rows are dealt out the same way, as one shuffle of what is new; from there on the comparison groups both sides by
item, bucket by bucket, and the old state is read where it lies. What a day finds can be written as the next state
without another shuffle, as it is dealt out already.

The rows of one item lie in one bucket and are compared as sorted streams, which spill; only what moved is put together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import scratch

#: Child keys of a state's tables.
KEYS = {"heads": [], "facts": ["field"], "records": ["id"], "documents": ["key"], "unreadable": ["key"]}
ITEM = "pid"
_AUTO = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def dealt(state: dict[str, DataFrame], buckets: int, there: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The tables of a state dealt to ``buckets`` partitions of their items, as bucketed tables are; those ``there`` are so already."""
    return {name: df if name in there else df.repartition(buckets, ITEM) for name, df in state.items()}


def save(state: dict[str, DataFrame], name: str, buckets: int, path: str | None = None, there: tuple[str, ...] = ()) -> None:
    """Write a state's tables as ``<name>_<table>``, each bucket one file, below ``path`` or in the shared scratch folder.

    Digests are the larger part of a state, in hexadecimal digits: zstd takes half of them, which snappy leaves.
    """
    for kind, df in dealt(state, buckets, there).items():
        spark = df.sparkSession
        at = f"{path.rstrip('/')}/{kind}" if path else scratch(spark, f"state-{kind}")
        before = spark.conf.get(_AUTO)
        spark.conf.set(_AUTO, "false")  # a task reads one bucket of what is there, and writes that one
        try:
            rows = df.write.bucketBy(buckets, ITEM).sortBy(ITEM, *KEYS[kind]).option("path", at).option("compression", "zstd")
            rows.format("parquet").saveAsTable(f"{name}_{kind}")
        finally:
            spark.conf.set(_AUTO, before)


def attach(spark: SparkSession, schema: dict[str, str], name: str, path: str, buckets: int) -> None:
    """Name the tables that an earlier application saved below ``path``, where the catalog does not outlive it. schema: DDL of each table."""
    for kind, ddl in schema.items():
        by = ", ".join([ITEM, *KEYS[kind]])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_{kind} ({ddl}) USING parquet CLUSTERED BY ({ITEM}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path.rstrip('/')}/{kind}'")


def load(spark: SparkSession, name: str, kinds: tuple[str, ...] = tuple(KEYS)) -> dict[str, DataFrame]:
    return {kind: spark.table(f"{name}_{kind}") for kind in kinds}


def buckets_of(spark: SparkSession, name: str) -> int:
    """The number of buckets that a state was saved in."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}_heads").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def new_name(prefix: str = "state") -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def drop(spark: SparkSession, name: str) -> None:
    """Forget the names of a state's tables; their files stay for their folder's own clean-up."""
    for kind in KEYS:
        spark.sql(f"DROP TABLE IF EXISTS {name}_{kind}")
