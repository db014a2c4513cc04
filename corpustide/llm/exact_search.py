"""Exact top-k search by inner product with vector-approximation files.

Vectors become integers, floor(scale * x). The table is stored once in blocks of vectors: their ids, the approximation
(the number of one of 16 cells for each component, four bits; the edges are quantiles of the whole table), and the
exact vectors beside it. Queries are stored in blocks as well; neither ever passes through the driver.

The first scan reads the approximations alone: cells bound every score from below and above, and the kth highest lower
bound over the whole table is a score that each query is sure to reach. The second scan reads exact vectors, only where
the upper bound reaches that score, in the order of the upper bounds, until the kth best score so far is no lower than
the next bound; the kth best is carried from block to block. Each task leaves its k best for every query.

The blocks of the table are dealt to parts; a copy of every block of queries goes to each part, and meets the blocks
there one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import merged, stored

CELLS = 16
#: Queries of a block, and vectors of a block.
QUERIES, ROWS = 256, 1024
#: The largest integer up to which float64 sums of integers are exact.
EXACT = 2**53


class Edges:
    """Cells of each component: edges [dimension, CELLS - 1], and the least and largest value of each cell."""

    def __init__(self, edges: np.ndarray, least: np.ndarray, most: np.ndarray):
        self.edges = edges
        self.low = np.concatenate([least[:, None], edges], axis=1)
        self.high = np.concatenate([edges, most[:, None]], axis=1)
        self.largest = float(np.abs(np.concatenate([least, most])).max(initial=0))

    def cells(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(rows.shape, dtype=np.uint8)
        for d in range(rows.shape[1]):
            out[:, d] = np.searchsorted(self.edges[d], rows[:, d], side="right")
        return out

    def bounds(self, queries: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the scores [query, row]."""
        dims = np.arange(cell.shape[1])
        low, high = self.low[dims, cell], self.high[dims, cell]
        plus, minus = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
        below, above = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
        if not self.safe(queries):  # rounded sums: widen them
            slack = max(np.abs(above).max(initial=0), np.abs(below).max(initial=0)) * 1e-9 + 1
            below, above = below - slack, above + slack
        return below, above

    def safe(self, queries: np.ndarray) -> bool:
        return float(np.abs(queries).max(initial=0)) * self.largest * max(1, queries.shape[1]) < EXACT


def packed(cell: np.ndarray) -> bytes:
    """Two cells a byte."""
    flat = cell.ravel()
    if len(flat) % 2:
        flat = np.append(flat, np.uint8(0))
    return (flat[::2] << 4 | flat[1::2]).tobytes()


def unpacked(data: bytes, rows: int, dimension: int) -> np.ndarray:
    pairs = np.frombuffer(data, dtype=np.uint8)
    return np.stack([pairs >> 4, pairs & 15], axis=1).ravel()[: rows * dimension].reshape(rows, dimension)


def _blocks(size: int, edges: Edges | None):
    """Blocks of ``size`` rows: ids, exact vectors (64-bit), and cells where ``edges`` are given."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        vectors: list[np.ndarray] = []

        def block() -> pd.DataFrame:
            exact = np.array(vectors, dtype=np.int64).reshape(len(ids), -1)
            cells = packed(edges.cells(exact.astype(np.float64))) if edges else b""
            return pd.DataFrame({"ids": [np.array(ids, dtype=np.int64).tobytes()], "cells": [cells], "exact": [exact.tobytes()]})

        for batch in batches:
            for i, v in zip(batch["id"].tolist(), batch["v"]):
                ids.append(i)
                vectors.append(np.asarray(v, dtype=np.int64))
                if len(ids) == size:
                    yield block()
                    ids, vectors = [], []
        if ids:
            yield block()

    return run


def _vectors(ids: bytes, exact: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, dtype=np.int64)
    return numbers, np.frombuffer(exact, dtype=np.int64).reshape(len(numbers), -1)


def _sure(edges: Edges, k: int):
    """First scan, of pairs of a block of queries and one of approximations: for each query the k highest lower bounds of those that follow one another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best = None, np.zeros((0, k))

        def said() -> pd.DataFrame:
            return pd.DataFrame({"qb": at, "pos": np.arange(len(best)), "lows": [x[np.isfinite(x)].tolist() for x in best]})

        for batch in batches:
            for qb, q_ids, q_exact, ids, cells in zip(batch["qb"], batch["q_ids"], batch["q_exact"], batch["ids"], batch["cells"]):
                own, queries = _vectors(q_ids, q_exact)
                if qb != at:
                    if at is not None:
                        yield said()
                    at, best = qb, np.full((len(own), k), -np.inf)
                numbers = np.frombuffer(ids, dtype=np.int64)
                below = edges.bounds(queries.astype(np.float64), unpacked(cells, len(numbers), queries.shape[1]))[0]
                below[own[:, None] == numbers[None, :]] = -np.inf
                both = np.concatenate([best, below], axis=1)
                best = -np.partition(-both, k - 1, axis=1)[:, :k]
        if at is not None:
            yield said()

    return run


class Best:
    """The k best rows so far of each query of a block, as (-score, id)."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, sure: np.ndarray, edges: Edges, k: int):
        self.ids, self.exact, self.sure, self.edges, self.k = ids, queries, sure, edges, k
        self.queries = queries.astype(np.float64)
        self.safe = edges.safe(self.queries)
        self.rows: list[list[tuple[int, int]]] = [[] for _ in ids]

    def take(self, ids: np.ndarray, cell: np.ndarray, exact: np.ndarray) -> None:
        """Read those rows of a block whose upper bounds reach what is sure, and go on until the next one is too low."""
        above = self.edges.bounds(self.queries, cell)[1]
        above[self.ids[:, None] == ids[None, :]] = -np.inf
        whole = exact.astype(np.float64)
        for n, best in enumerate(self.rows):
            kth = max(self.sure[n], float(-best[self.k - 1][0])) if len(best) >= self.k else self.sure[n]
            mine = np.flatnonzero((above[n] >= kth) & (above[n] > -np.inf))
            mine = mine[np.argsort(-above[n, mine], kind="stable")]
            at = 0
            while at < len(mine):
                if len(best) >= self.k and above[n, mine[at]] < -best[self.k - 1][0]:
                    break
                some = mine[at : at + 16]
                if self.safe:
                    scores = (whole[some] @ self.queries[n]).astype(np.int64).tolist()
                else:
                    scores = [sum(int(a) * int(b) for a, b in zip(exact[r], self.exact[n])) for r in some]
                best = sorted(best + [(-s, int(ids[r])) for s, r in zip(scores, some)])[: self.k]
                at += len(some)
            self.rows[n] = best

    def found(self) -> pd.DataFrame:
        return pd.DataFrame([(int(q), i, -s) for q, rows in zip(self.ids, self.rows) for s, i in rows], columns=["query_id", "vec_id", "score"], dtype="int64")


def _read(edges: Edges, k: int):
    """Second scan, of pairs of a block of queries and one of the table: the k best of those that follow one another."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, best = None, None
        for batch in batches:
            for qb, q_ids, q_exact, sure, ids, cells, exact in zip(*[batch[c] for c in ("qb", "q_ids", "q_exact", "sure", "ids", "cells", "exact")]):
                if qb != at:
                    if best is not None:
                        yield best.found()
                    at, best = qb, Best(*_vectors(q_ids, q_exact), np.asarray(sure, dtype=np.float64), edges, k)
                numbers, vectors = _vectors(ids, exact)
                best.take(numbers, unpacked(cells, len(numbers), vectors.shape[1]), vectors)
        if best is not None:
            yield best.found()

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    block: int = ROWS, query_block: int = QUERIES
) -> DataFrame:
    """Each query's k best vectors other than its own id's: query_id, rank (from 1), vec_id, score.

    Null ids and vectors, and vectors with null or non-finite components, take no part; a vector is held only against
    those of its own length; empty ones score 0. Fewer candidates than k are all returned. Rows that repeat an id are
    each a candidate; of queries that repeat an id the one with the smallest vector counts. Ties go to the smaller id.
    Empty tables give no rows. Vectors of any length are read whole, ``block`` at a time. Other columns are not read.
    Scores must fit 64 bits.
    """
    spark = vectors.sparkSession

    def whole(df: DataFrame) -> DataFrame:
        fine = ~F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        rows = df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(fine)
        # 256 * x in double, as asked for; the floor of a double within 64 bits
        return rows.select(
            F.col(id_col).cast("long").alias("id"),
            F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v")
        ).withColumn("n", F.size("v"))

    rows, asked = stored(whole(vectors), "vectors"), whole(queries)
    asked = stored(asked.groupBy("n", "id").agg(F.min("v").alias("v")), "queries")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = "ids binary, cells binary, exact binary"
    found = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for n in [r["n"] for r in asked.select("n").distinct().sort("n").collect()]:  # a row for each length of vectors
        mine, own = rows.filter(F.col("n") == n).select("id", "v"), asked.filter(F.col("n") == n).select("id", "v")
        spread = mine.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(
            F.percentile_approx(F.col("x").cast("double"), [c / CELLS for c in range(1, CELLS)], 200).alias("e"),
            F.min("x").alias("least"), F.max("x").alias("most")
        ).sort("d").collect()  # a row for each component
        if n and not spread:
            continue
        edges = Edges(
            np.array([r["e"] for r in spread]).reshape(n, CELLS - 1), np.array([r["least"] for r in spread], dtype=np.float64),
            np.array([r["most"] for r in spread], dtype=np.float64)
        )
        table = stored(mine.mapInPandas(_blocks(block, edges), kinds).withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(parts))), "approximations")
        blocks = own.mapInPandas(_blocks(query_block, None), kinds).select(
            F.monotonically_increasing_id().alias("qb"), F.col("ids").alias("q_ids"), F.col("exact").alias("q_exact")
        )
        blocks = stored(blocks, "query-blocks")

        def meet(asking: DataFrame, cols: list[str]) -> DataFrame:
            everywhere = asking.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
            return merged(everywhere).join(merged(table.select("part", *cols)), "part").drop("part")

        lows = meet(blocks, ["ids", "cells"]).mapInPandas(_sure(edges, k), "qb long, pos int, lows array<double>")
        every = F.sort_array(F.flatten(F.collect_list("lows")), asc=False)  # at most k from each part
        sure = lows.groupBy("qb", "pos").agg(every.alias("l")).select("qb", "pos", F.coalesce(F.get("l", F.lit(k - 1)), F.lit(float("-inf"))).alias("sure"))
        sure = sure.groupBy("qb").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "sure"))), lambda x: x["sure"]).alias("sure"))
        asking = stored(blocks.join(sure, "qb"), "asking")
        found = found.unionByName(meet(asking, ["ids", "cells", "exact"]).mapInPandas(_read(edges, k), "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").filter(F.col("rank") <= k)


def op7_exact_search(spark, sf_dir: str) -> DataFrame:
    """Queries are the vectors whose id is divisible by 50; candidates all but the query's own."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


OP7_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
     r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5
"""
