"""Helpers shared by the training-data operators: shared storage, word hashing, rolling hashes, components."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd multipliers of the two polynomial hashes (modulo 2**64), and of the final mixing.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
MIX = 0xBF58476D1CE4E5B9


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, one of our own if all tasks run in this process (tests); on a cluster that is an error, as other
    machines would not see a local folder.
    """
    conf = spark.sparkContext.getConf()
    at = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = conf.get("spark.master") or ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="corpustide-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """These column names, each made longer until ``df`` has none like it (Spark does not tell case apart)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(name: str) -> Column:
    """The column of this name, whatever it is: dots and backticks in it are part of the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def all_of(df: DataFrame) -> list[Column]:
    """All columns of ``df``, by name."""
    return [named(c) for c in df.columns]


#: Rows that go to a Python worker at once while a table is stored: their buffers count beside the JVM's heap.
ROWS_AT_ONCE = 2000


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches to Python workers have ROWS_AT_ONCE rows at most meanwhile; the session's setting is put back."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), ROWS_AT_ONCE) if int(before) > 0 else ROWS_AT_ONCE))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and survives the loss of any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str, order: list[Column], at: str = "at") -> DataFrame:
    """Stored: ``df`` with its rows numbered 0, 1, 2... by ``order``, a task numbering only its own range.

    Rows that tie in all of ``order`` stand in any order, fixed once the table is stored. A row for each written
    partition, its count, goes through the driver.
    """
    part, first = free_names(df, "_part", "_first")
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), name)
    placed = placed.withColumn(part, F.shiftright(at, 33))
    sizes, firsts, before = sorted(tuple(r) for r in placed.groupBy(part).count().collect()), [], 0
    for k, n in sizes:
        firsts.append((k, before - (k << 33)))
        before += n
    spark = df.sparkSession
    offsets = spark.createDataFrame(firsts, f"{part} long, {first} long")
    return placed.join(F.broadcast(offsets), part).withColumn(at, F.col(at) + F.col(first)).drop(part, first)


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side of a sort-merge join, at any size: the plan of a small run is then that of a large one."""
    return df.hint("merge")


def releasing(run: Callable) -> Callable:
    """``run``, a function over batches, that gives unused memory back to the system at its end.

    Workers stay for the tasks that follow, and with them what the allocators keep: beside a JVM that then needs its
    whole heap that can be too much for the executor.
    """

    @functools.wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pyarrow.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim:
            trim(0)

    return wrapped


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered; forgets all when ``limit`` words are held, so memory is bounded."""

    limit = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finish a polynomial hash, so that all its bits depend on all its input."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(MIX)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Polynomial hashes of any run of a sequence, from prefix sums modulo 2**64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, values: np.ndarray, base: int = BASES[0]):
        n = len(values)
        self.up, self.down = self.powers(base, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:n], out=self.sums[1:])

    @classmethod
    def powers(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        got = cls._powers.get(base)
        if got is None or len(got[0]) < n:
            size = max(4096, 1 << (n - 1).bit_length())
            pair = []
            for b in (base, pow(base, -1, 1 << 64)):
                out = np.full(size, b, dtype=np.uint64)
                out[0] = 1
                pair.append(np.multiply.accumulate(out))
            got = cls._powers[base] = (pair[0], pair[1])
        return got

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each run [start, end)."""
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, length: int) -> np.ndarray:
        """Hash of each run of ``length``."""
        n = len(self.sums) - length
        return mixed((self.sums[length:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, dtype=np.uint64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, in log2(width) passes."""
    if len(x) < width:
        return x[:0]
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component), component being the smallest node reachable.

    Hook to the smallest label in the neighbourhood, then jump pointers, until nothing moves; each round is a few
    joins of stored tables, so that skewed hubs can be split, and no graph ever reaches the driver.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        hooked = stored(labels.join(near, "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component")), "labels")
        jump = hooked.select(F.col("node").alias("component"), F.col("component").alias("next"))
        jumped = stored(hooked.join(jump, "component", "left").select("node", "before", F.coalesce("next", "component").alias("component")), "labels")
        moved = jumped.filter("before <> component").limit(1).count()
        labels = jumped.select("node", "component")
        if not moved:
            return labels
