"""A training-data pipeline in five stages, each written as Parquet and read again as the next one's documents.

Every stage but the last returns the columns of ``documents``, and any others that it was given, whatever their names;
an empty table gives an empty one. Texts are read whole, at any length. No SQL can express the trained classifier, the prefix
trees and the linear program, so ORACLE_SQL is None, and tests hold the stages against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpustide.llm import jaccard_join, mixing, packing, quality, secret_scan
from corpustide.llm.common import all_of, free_names, merged, stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant, learned from the labels of ``docs``, scores 0.5 or more.

    Null and empty texts score as texts without words. Each row counts by its text alone, so rows that repeat, or have
    no id, stay or go alike. Without labels of both classes, all are of the one there is (good, if there is none).
    """
    return quality.keep_quality(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that link at 0.8 on shingles of five words, the one with the smallest id.

    Documents without words, and rows without an id, link with nothing and stay. Rows that repeat both id and text are
    one document, of which the first by all columns stays; rows of one id with different texts are documents of their own.
    """
    keep, nth, node = free_names(docs, "_keep", "_nth", "_node")
    known = docs.filter("doc_id is not null")
    if known.groupBy("doc_id").count().filter("count > 1").isEmpty():
        found = jaccard_join.jaccard_components(known, n=5, threshold=0.8)
        first = stored(found.filter("doc_id = component_id").select(F.col("doc_id").alias(keep)), "keep")
        kept = known.join(merged(first), known["doc_id"] == F.col(keep), "left_semi")
    else:
        digest = F.sha2("text", 256)
        same = Window.partitionBy("doc_id", digest).orderBy(F.to_json(F.struct(*all_of(docs))))
        rows = stored(
            known.withColumn(nth, F.row_number().over(same)).filter(F.col(nth) == 1).drop(nth).withColumn(node, F.monotonically_increasing_id()),
            "rows"
        )
        found = jaccard_join.jaccard_components(rows, id_col=node, n=5, threshold=0.8).select(F.col("doc_id").alias(node), F.col("component_id").alias(keep))
        order = F.struct("doc_id", digest.alias("digest"), F.col(node).alias("node"))
        first = rows.select(node, order.alias(nth)).join(found, node).groupBy(keep).agg(F.min(nth).alias(nth))
        kept = rows.join(merged(stored(first.select(F.col(f"{nth}.node").alias(node)), "keep")), node, "left_semi").select(*all_of(docs))
    return kept.unionByName(docs.filter("doc_id is null"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with live-looking secrets masked; values that several sources share are examples and stay.

    Null texts stay null; a null source is one source, without a name. Rows that repeat each stay.
    """
    return secret_scan.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, those of small sources repeated up to four times: entropy half way to the largest.

    Documents without words (null, empty) are taken once; a null source is one source, without a name; rows that
    repeat are each taken equally often, to within one.
    """
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens: rows of their own, with the columns of the packing query.

    Null and empty texts are one piece, of the end token alone. Rows that repeat, or have no id, are documents of their own.
    """
    import public_tokenizers

    return packing.pack(docs, str(public_tokenizers.path("byte_bpe_50k.json")), ids=False).drop("ids")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("secret scans", secrets_stage),
    ("mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
