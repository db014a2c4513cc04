"""Quality by regularised quadratic discriminant analysis over transformed document statistics.

Each class has a mean and a covariance, the latter shrunk to that of both classes and to a sphere; their Cholesky
factors are computed once and kept as inverses, so a score is two triangular products: the difference of the two
Mahalanobis log-densities, and of the logarithms of the priors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, sample

#: Labelled rows of each class to learn from at most.
SAMPLE = 10_000
FEATURES = (
    "words", "word length", "spread of word length", "distinct words", "upper case", "digits", "sentence marks", "other marks",
    "line breaks", "distinct lines", "entropy", "short words", "runs of marks"
)
_KIND = np.zeros(256, dtype=np.int8)
for _k, _chars in enumerate(
    (
        bytes(range(65, 91)), bytes(range(48, 58)), b".,;:!?'\"-()",
        bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in b".,;:!?'\"-()"), b"\n", b"\x20\t\r\x0b\x0c"
    ),
    1
):
    _KIND[np.frombuffer(_chars, dtype=np.uint8)] = _k


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of the whole text: logarithms of counts, logits of shares. Null counts as empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    codes = np.frombuffer(data, dtype=np.uint8)
    n = max(1, len(codes))
    words = data.split()
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    kinds = _KIND[codes]
    share = np.bincount(kinds, minlength=7) / n
    every = np.bincount(codes, minlength=256)
    p = every[every > 0] / n
    lines = data.split(b"\n")
    marks = (kinds == 3) | (kinds == 4)
    runs = float((marks[1:] & marks[:-1]).sum()) / n if len(codes) > 1 else 0.0
    logit = lambda x: np.log((x + 0.001) / (1.001 - x))
    return np.array([
        np.log1p(len(words)), np.log1p(sizes.mean()), np.log1p(sizes.std()), logit(len(set(words)) / max(1, len(words))), logit(share[1]), logit(share[2]), logit(share[3]), logit(share[4]), logit(share[5]),
        logit(len(set(lines)) / len(lines)), float(-(p * np.log2(p)).sum()) if len(p) else 0.0, logit(float((sizes <= 3).mean())), logit(min(1.0, runs)),
    ])


class Discriminant:
    """Two Gaussian classes over standardised statistics."""

    def __init__(self, x: np.ndarray, y: np.ndarray, to_pooled: float = 0.3, to_sphere: float = 0.1, prior: float | None = None):
        self.centre, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.centre) / self.scale
        self.means = [z[y == k].mean(axis=0) for k in (0, 1)]
        own = [np.cov(z[y == k].T, bias=True) if (y == k).sum() > 1 else np.eye(z.shape[1]) for k in (0, 1)]
        n = np.array([(y == 0).sum(), (y == 1).sum()], dtype=float)
        pooled = (own[0] * n[0] + own[1] * n[1]) / n.sum()
        self.inverse, self.log_density = [], []
        share = float(n[1] / n.sum()) if prior is None else prior
        for k in (0, 1):
            s = (1 - to_pooled) * own[k] + to_pooled * pooled
            s = (1 - to_sphere) * s + to_sphere * max(1e-3, float(np.trace(s)) / len(s)) * np.eye(len(s))
            factor = np.linalg.cholesky(s)
            self.inverse.append(np.linalg.inv(factor))
            self.log_density.append(float(np.log((1 - share, share)[k]) - np.log(np.diag(factor)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        z = (x - self.centre) / self.scale
        g = [self.log_density[k] - 0.5 * (((z - self.means[k]) @ self.inverse[k].T) ** 2).sum(axis=1) for k in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(g[1] - g[0], -40, 40)))


class Constant:
    """Where a class has no labelled row: everything is of the other one."""

    def __init__(self, value: float):
        self.value = value

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def chosen(x: np.ndarray, y: np.ndarray, prior: float, folds: int = 5) -> Discriminant:
    """Shrinkage by cross-validation on the sample (log-likelihood of the labels)."""
    fold = np.arange(len(y)) % folds
    weight = np.where(y == 1, prior / max(1e-9, y.mean()), (1 - prior) / max(1e-9, 1 - y.mean()))
    best, found = -np.inf, (0.3, 0.1)
    for a in (0.1, 0.3, 0.6):
        for b in (0.02, 0.1, 0.3):
            total = 0.0
            for f in range(folds):
                train = fold != f
                if len(np.unique(y[train])) < 2:
                    continue
                p = np.clip(Discriminant(x[train], y[train], a, b, prior).score(x[~train]), 1e-6, 1 - 1e-6)
                total += float((weight[~train] * np.where(y[~train] == 1, np.log(p), np.log(1 - p))).sum())
            if total > best:
                best, found = total, (a, b)
    return Discriminant(x, y, *found, prior)


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"label": batch["label"], "x": [statistics(t).tolist() for t in batch["text"]]})


def learn(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    limit: int = SAMPLE
) -> Discriminant | Constant:
    """Discriminant from at most ``limit`` labelled rows of each class; priors from all labels that may be learned from.

    Where a class has no row, everything is of the other one; without any, of class 1. Null texts count as empty; rows
    that repeat an id are rows of their own; other columns are not read.
    """
    rows = sample(docs, labels, label_col, id_col, text_col, limit).mapInPandas(_statistics, "label int, x array<double>").collect()
    y = np.array([r["label"] for r in rows], dtype=int)
    if len(np.unique(y)) < 2:
        return Constant(float(y[0]) if len(y) else 1.0)
    x = np.array([r["x"] for r in rows])
    order = np.lexsort((*x.T[::-1], y))  # the same folds however rows arrive
    share = labels.filter(~held_out(id_col) & F.col(label_col).isin(0, 1)).agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    return chosen(x[order], y[order], min(0.99, max(0.01, float(share))))


def score_quality(docs: DataFrame, model: Discriminant | Constant, id_col: str = "doc_id", text_col: str = "text", at: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Null texts count as empty; null ids as held out.

    Equal texts score alike, rows that repeat each get a row, an empty table gives none, texts of any length are read
    whole, and other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = model.score(np.array([statistics(t) for t in batch["text"]])) if len(batch) else np.zeros(0)
            yield batch[["doc_id", "held_out"]].assign(score=score, predicted=(score >= at).astype("int32"))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_quality(docs: DataFrame, model: Discriminant | Constant, text_col: str = "text", at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model scores ``at`` or more; same columns, whatever their names. Null texts count as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([statistics(t) for t in texts])) if len(texts) else np.zeros(0))

    return docs.filter(score(F.col(text_col)) >= at)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    """All documents, with a discriminant learned from labels.quality."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_quality(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
