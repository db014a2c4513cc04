"""The pipeline's stages, each against a plain version on its own input; and all of them in a row."""

import re
import zlib
from collections import Counter, defaultdict

import brute
import corpus_pipeline as pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpustide.llm import quality, queries, secret_scan
from corpustide.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def _rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def test_quality_stage(spark, docs):
    kept = pipeline.quality_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    model = quality.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [i for i, t, _ in _rows(docs) if model.score(np.array([quality.statistics(t)]))[0] >= 0.5]
    assert sorted(r[0] for r in _rows(kept)) == sorted(want) and 0 < len(want) < docs.count()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [i for i, _, _ in _rows(docs) if labels.get(i) == 1]
    assert len(set(clean) - set(want)) <= 0.05 * len(clean)


def test_near_duplicates_stage(spark, docs):
    more = docs.unionByName(docs.limit(5)).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None).cast("long")))
    kept = pipeline.near_duplicates_stage(spark, more, SF)
    assert kept.columns == docs.columns
    want = [i for i, _, c, _ in brute.jaccard([(i, t) for i, t, _ in _rows(docs)], 5, 80, 100) if i == c]
    assert sorted(r[0] for r in _rows(kept) if r[0] is not None) == sorted(want)
    assert sum(r[0] is None for r in _rows(kept)) == 3


def test_near_duplicates_stage_repeated_ids(spark, docs):
    """Rows of one id with texts that do not link all stay; of repeated and of linked ones the first does."""
    long = " ".join(f"w{k}" for k in range(100))
    rows = [
        (1, "one text of its own here", "b"), (1, "another that is not like it", "a"), (1, "another that is not like it", "c"),
        (2, long, "a"), (2, long + " end", "a"), (3, long, "a"), (4, None, "a"), (4, None, "a"), (4, "", "a")
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = pipeline.near_duplicates_stage(spark, df, SF).collect()
    got = sorted((r["doc_id"], r["text"] or str(r["text"]), r["source"]) for r in kept if r["doc_id"] != 2)
    assert got == [(1, "another that is not like it", "a"), (1, "one text of its own here", "b"), (4, "", "a"), (4, "None", "a")]
    assert [r["text"].startswith(long) for r in kept if r["doc_id"] == 2] == [True]


def _masked(rows):
    kinds = [(n, re.compile(p, re.A), g, least) for n, p, g, least in secret_scan.KINDS]
    spans = {}
    for i, text, source in rows:
        spans[i] = [(m.start(), m.end(), m.group(g), source) for _, p, g, least in kinds for m in p.finditer(text) if len(m.group(g)) >= least]
    owners = defaultdict(set)
    for found in spans.values():
        for _, _, v, s in found:
            owners[v].add(s)
    out = {}
    for i, text, _ in rows:
        at, made = 0, ""
        for a, b, v, _ in sorted(spans[i]):
            if len(owners[v]) < secret_scan.OWNERS:
                if a >= at:
                    made += text[at:a] + "[SECRET]"
                at = max(at, b)
        out[i] = made + text[at:]
    return out


def test_secrets_stage(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = pipeline.secrets_stage(spark, docs, SF)
    assert out.columns == docs.columns
    got = {i: t for i, t, _ in _rows(out)}
    assert got == _masked(_rows(docs)) and any("[SECRET]" in t for t in got.values())


def test_mixing_stage(spark, docs):
    out = pipeline.mixing_stage(spark, docs, SF)
    assert out.columns == docs.columns
    times = Counter(_rows(out))
    assert set(times) == set(_rows(docs)) and max(times.values()) <= 5
    assert sum(times.values()) >= docs.count()


def test_packing_stage(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    ids = {i: np.array(t.encode(text, add_special_tokens=False).ids + [2], dtype="<u4") for i, text, _ in _rows(docs)}
    used = defaultdict(int)
    for r in pipeline.packing_stage(spark, docs, SF).collect():
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
        used[r["sequence_id"]] += r["length"]
    assert sum(used.values()) == sum(map(len, ids.values())) and max(used.values()) <= 1024


def test_odd_rows(spark):
    """Every stage on nulls, empty, long and repeated rows, with columns that have its helpers' names."""
    long = " ".join(f"w{k % 977}x{k}" for k in range(9000))
    plain = "The harbour office closes early on market days, and the ferry waits for nobody after nine. " * 3
    rows = [
        (1, plain, "a"), (1, plain, "a"), (1, plain + "Other ends follow here.", "b"), (2, None, "a"), (3, "", None),
        (None, plain, None), (None, None, "a"), (4, long, "a"), (5, long, "b"), (6, plain + " password=hunter2hunter2", "c")
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = [
        "lang", "n_chars", "_keep", "_nth", "_node", "_spans", "_hash", "_key", "_same", "_times", "doc", "size", "grams", "score",
        "key", "label", "node", "component_id", "order", "digest", "a.b", "text.x", "tick`s"
    ]
    df = df.select("*", *[F.lit(f"own {n}").alias(n) for n in names]).repartition(3)
    none = spark.read.parquet(f"{SF}/labels.parquet").filter("false")
    kept = quality.keep_quality(df, quality.learn(df, none))
    assert kept.count() == len(rows)
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        assert all(r[n] == f"own {n}" for r in out.collect() for n in names), name
    first = pipeline.near_duplicates_stage(spark, df, SF).collect()
    assert sorted((r["doc_id"] or 0, len(r["text"] or "")) for r in first if r["doc_id"] != 1 and r["doc_id"] != 6) == [(0, 0), (0, len(plain)), (2, 0), (3, 0), (4, len(long))]
    assert {len(r["text"]) for r in first if r["doc_id"] == 1} and len({r["text"] for r in first if r["doc_id"] == 1}) == sum(r["doc_id"] == 1 for r in first)
    secrets = {(r["doc_id"], r["text"]) for r in pipeline.secrets_stage(spark, df, SF).collect()}
    assert secrets == {(i, t.replace("password=hunter2hunter2", "[SECRET]") if t else t) for i, t, _ in rows}
    mixed = Counter((r["doc_id"], r["text"], r["source"]) for r in pipeline.mixing_stage(spark, df, SF).collect())
    assert set(mixed) == set(rows)
    packed = pipeline.packing_stage(spark, df, SF).collect()
    assert sum(r["piece"] == 0 for r in packed) == len(rows)


def test_whole(spark, docs):
    """Each stage works on what the one before kept."""
    now = docs
    for name, stage in pipeline.STAGES:
        now = stored(stage(spark, now, SF), "test-stage")
    assert sorted(map(
        tuple, pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    )) == sorted(map(tuple, now.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))
    empty = docs.filter("false")
    for name, stage in pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    answer = con.execute(queries.ORACLES[name])
    at = [[d[0] for d in answer.description].index(c) for c in cols]
    assert sorted(str([r[c] for c in cols]) for r in df.collect()) == sorted(str([r[k] for k in at]) for r in answer.fetchall())
