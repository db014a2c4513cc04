"""Deliveries that are visible whole or not at all, on any store that Spark writes to.

A delivery goes in two phases. First Spark's tasks stage its files, step by step, as rows of tables below a folder of the
run's own, which no reader looks into; a task that is lost is run again, and only what its last attempt wrote counts, by
Spark's own commit. Then the manifest is staged likewise: the entries that stay from the delivery before, and the new ones.
At last one small version file is moved into place through Hadoop's file system, under a number that nobody has taken.
Readers go by the highest version: before the move they see the old delivery whole, after it the new one. Files of items
that did not move are not written again; their entries name the run that wrote them.

A run that fails clears its stage. What a killed driver left is unknown to readers, and :func:`clear` removes it.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ENTRY = "step string, pid string, path string, sha256 string, bytes bigint, run string"
FILE = "pid string, path string, content binary, sha256 string"
#: Rows of a staged file, at most: a file's documents are read together.
ROWS = 10_000


class Superseded(Exception):
    """Another delivery became visible since this one began; nothing of this one is."""


class Store:
    """A folder, by Hadoop's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        conf = spark._jsc.hadoopConfiguration()
        home = self.jvm.org.apache.hadoop.fs.Path(self.root)
        self.fs = home.getFileSystem(conf)
        self.files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.at(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.at(folder)))

    def remove(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.at(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def put_new(self, name: str, text: str, stage: str) -> bool:
        """Write beside, then move to a name that must be free; False where it is not."""
        self.fs.mkdirs(self.at(name).getParent())
        out = self.fs.create(self.at(stage), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        none = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            self.files.rename(self.at(stage), self.at(name), none)
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            return False
        return True


def latest(spark: SparkSession, root: str) -> dict | None:
    """The version that readers see: number, run, runs (whose files its entries name), entries, bytes; None before the first."""
    store = Store(spark, root)
    numbers = [n for n in store.names("versions") if n.endswith(".json")]
    return json.loads(store.read(f"versions/{numbers[-1]}")) if numbers else None


def entries(spark: SparkSession, root: str, version: dict | None = None) -> DataFrame:
    """The manifest (step, pid, path, sha256, bytes, run) of a version, the latest by default; empty before the first."""
    version = version or latest(spark, root)
    if version is None:
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).parquet(f"{root.rstrip('/')}/manifests/{version['run']}")


def contents(spark: SparkSession, root: str, version: dict | None = None) -> DataFrame:
    """The manifest's entries with their content, read from the runs that wrote them. ``whole``: the content has the entry's digest."""
    version = version or latest(spark, root)
    listed = entries(spark, root, version)
    if version is None:
        return listed.withColumn("content", F.lit(None).cast("binary")).withColumn("whole", F.lit(True))
    # the folders of a run and its steps are columns
    staged = spark.read.schema(f"{FILE}, run string, step string").option("basePath", f"{root.rstrip('/')}/stage").parquet(
        *[f"{root.rstrip('/')}/stage/run={run}" for run in version["runs"]]
    )
    found = listed.join(staged.select("run", "step", "pid", "path", "content"), ["run", "step", "pid", "path"], "left")
    return found.withColumn("whole", F.coalesce(F.sha2("content", 256) == F.col("sha256"), F.lit(False)))


def deliver(
    spark: SparkSession, root: str, run: str, steps: list[tuple[str, DataFrame]], keep: DataFrame | None = None,
    between: Callable[[str], None] | None = None
) -> dict:
    """Deliver files (pid, path, content), step by step, on top of the latest version. Returns the new version.

    ``keep`` (pid, path): entries of the latest version that stay; without it all stay. An entry that a step writes again
    is replaced. ``run`` must be new. ``between`` is called with the name of each step that has ended. Whatever fails, the
    latest version stays what it was, and this run's stage is cleared; a delivery that another one overtook is an error.
    """
    root, before, store = root.rstrip("/"), latest(spark, root), Store(spark, root)
    if f"run={run}" in store.names("stage"):
        raise ValueError(f"run {run} has been staged before")
    try:
        for step, files in steps:
            rows = files.select(F.col("pid").cast("string").alias("pid"), "path", F.col("content").cast("binary").alias("content"))
            rows = rows.withColumn("sha256", F.sha2("content", 256))
            rows.write.option("maxRecordsPerFile", ROWS).parquet(f"{root}/stage/run={run}/step={step}")
            if between:
                between(step)
        new = spark.createDataFrame([], ENTRY)
        if steps:
            staged = spark.read.schema(f"{FILE}, step string").option("basePath", f"{root}/stage/run={run}").parquet(f"{root}/stage/run={run}")
            new = staged.select("step", "pid", "path", "sha256", F.octet_length("content").cast("long").alias("bytes"), F.lit(run).alias("run"))
        old = entries(spark, root, before)
        if keep is not None:
            old = old.join(keep.select("pid", "path"), ["pid", "path"], "left_semi")
        whole = old.join(new.select("pid", "path"), ["pid", "path"], "left_anti").unionByName(new)
        # counted in the pass that writes
        tally = Observation()
        counted = whole.observe(tally, F.count("*").alias("entries"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        counted.write.parquet(f"{root}/manifests/{run}")
        runs = [r["run"] for r in spark.read.schema(ENTRY).parquet(f"{root}/manifests/{run}").select("run").distinct().collect()]  # a name for each run
        if between:
            between("manifest")
        number = before["number"] + 1 if before else 1
        version = {"number": number, "run": run, "runs": sorted(runs), "entries": tally.get["entries"], "bytes": tally.get["bytes"]}
        if not store.put_new(f"versions/{number:012d}.json", json.dumps(version), f"stage/run={run}/version.json"):
            raise Superseded(f"version {number} is there already")
        return version
    except BaseException:
        store.remove(f"stage/run={run}")
        store.remove(f"manifests/{run}")
        raise


def clear(spark: SparkSession, root: str, versions: int = 1) -> list[str]:
    """Remove what none of the last ``versions`` versions names: stages that were left, files and manifests of older runs. Not while a delivery is under way."""
    store = Store(spark, root)
    numbers = [n for n in store.names("versions") if n.endswith(".json")][-versions:]
    live = [json.loads(store.read(f"versions/{n}")) for n in numbers]
    runs, manifests = {r for v in live for r in v["runs"]}, {v["run"] for v in live}
    gone = [f"stage/{n}" for n in store.names("stage") if n.removeprefix("run=") not in runs]
    gone += [f"manifests/{n}" for n in store.names("manifests") if n not in manifests]
    gone += [f"versions/{n}" for n in store.names("versions") if n not in numbers]
    for name in gone:
        store.remove(name)
    return gone


def files_of(
    state: str, documents: DataFrame, seen: DataFrame | None = None, runs: DataFrame | None = None, changes: DataFrame | None = None,
    shard: int | None = None
) -> list[tuple[str, DataFrame]]:
    """The steps of a publication as files, in their order: documents (pid, path, content), each item's index and state, what was
    seen and the run's record of each item, the shard's index, the change records, the day's marker."""
    to_json = lambda *cols: F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    at = lambda name: F.concat(F.col("pid").cast("string"), F.lit(f"/{name}"))
    place = "" if shard is None else f"shard-{shard}/"
    listed = documents.select("pid", F.struct("path", F.sha2("content", 256).alias("sha256")).alias("d")).groupBy("pid").agg(F.array_sort(F.collect_list("d")).alias("documents"))
    items = documents.select("pid").distinct()
    steps = [
        ("1-documents", documents.select("pid", F.concat(at(""), "path").alias("path"), "content")),
        ("2-index", listed.select("pid", at("index.json").alias("path"), to_json("pid", "documents").alias("content"))),
        ("3-state", items.select("pid", at("state.json").alias("path"), to_json("pid", F.lit(state).alias("state")).alias("content")))
    ]
    for name, rows, path in (("4-seen", seen, "seen.json"), ("5-run", runs, f"runs/{state}.json")):
        if rows is not None:
            steps.append((name, rows.select("pid", at(path).alias("path"), to_json(*rows.columns).alias("content"))))
    if changes is not None:
        steps.append(("6-changes", changes.select("pid", F.concat(F.lit(f"{place}changes/"), F.col("pid").cast("string"), F.lit(".json")).alias("path"), to_json(*changes.columns).alias("content"))))
    day = documents.sparkSession.createDataFrame([("", f"{place}day.json", json.dumps({"state": state, "shard": shard}))], "pid string, path string, content string")
    return [*steps, ("7-day", day)]
