"""Importance resampling towards a target's distribution, from position tables of n-grams.

A document's words are posexploded to a table of places; window functions of one document put the following words
beside each, for runs of every order; runs are hashed to buckets and counted over the corpus and over the target. A
bucket's gain is the logarithm of how much likelier the target is to hold it; gains are joined back to the runs and
summed by document. A document's weight with Gumbel noise of its id is its score, and the highest scores are drawn:
a sample without replacement in proportion to the likelihood ratios.

Places are cut into stretches that also hold the first words of the next one, so that no window is larger than a
stretch, however long a document is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named, numbered, stored

#: Words of a stretch; buckets are broadcast (16 bytes each), so their number is bounded.
STRETCH, MOST_BUCKETS = 4096, 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A to Z; null: none."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    # what lies between words is cut away: Spark copies the whole text for each match that it extracts
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def positions(texts: DataFrame, keys: list[str], text_col: str, orders: int) -> DataFrame:
    """A row (keys, words, bucket input ``gram``) for each run of 1 to ``orders`` words; ``first`` marks runs of one word.

    A row without words stays as one whose gram is null. ``keys`` must tell rows apart where ``orders`` is over 1.
    """
    table = texts.select(*[named(k) for k in keys], F.posexplode_outer(words_of(named(text_col))).alias("pos", "word"))
    if orders == 1:
        return table.select(*[named(k) for k in keys], F.col("word").alias("gram"), F.lit(True).alias("first"))
    # the first words of a stretch also end the one before, as words that only follow others
    own, tail = F.floor(F.col("pos") / STRETCH), F.pmod(F.col("pos"), F.lit(STRETCH)) < orders - 1
    both = F.array(F.struct(own.alias("stretch"), F.lit(True).alias("own")), F.struct((own - 1).alias("stretch"), F.lit(False).alias("own")))
    table = table.withColumn("at", F.explode(F.when(tail & (own > 0), both).otherwise(F.slice(both, 1, 1)))).select("*", "at.stretch", "at.own").drop("at")
    window = Window.partitionBy(*[named(k) for k in keys], "stretch").orderBy("pos")
    for k in range(1, orders):
        table = table.withColumn(f"next{k}", F.lead("word", k).over(window))
    grams = [F.struct(F.col("word").alias("gram"), F.lit(True).alias("first"))]
    for k in range(1, orders):
        run = F.when(F.col(f"next{k}").isNotNull(), F.concat_ws(" ", "word", *[F.col(f"next{j}") for j in range(1, k + 1)]))
        grams.append(F.struct(run.alias("gram"), F.lit(False).alias("first")))
    kept = F.filter(F.array(*grams), lambda g: g["first"] | g["gram"].isNotNull())
    return table.filter("own").select(*[named(k) for k in keys], F.explode(kept).alias("g")).select(*[named(k) for k in keys], "g.gram", "g.first")


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(gram.cast("binary")), F.lit(buckets)).cast("int")


def bucket_counts(texts: DataFrame, text_col: str, orders: int, buckets: int) -> DataFrame:
    """Rows (bucket, n): runs of all texts in each bucket that has any; summed by task before the shuffle."""
    rows = texts.select(F.monotonically_increasing_id().alias("uid"), named(text_col).alias("text"))
    grams = positions(rows, ["uid"], "text", orders).filter("gram is not null")
    return grams.groupBy(bucket_of(F.col("gram"), buckets).alias("bucket")).agg(F.count("*").alias("n"))


def gains(docs: DataFrame, target: DataFrame, doc_text: str = "text", target_text: str = "text", orders: int = 1, buckets: int = 10000) -> DataFrame:
    """Stored rows (bucket, gain) of the buckets that ``docs`` has: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))), ``buckets`` rows at most."""
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets must be between 1 and {MOST_BUCKETS}")
    here = stored(bucket_counts(docs, doc_text, orders, buckets), "buckets")
    there = stored(bucket_counts(target, target_text, orders, buckets).withColumnRenamed("n", "t"), "buckets")
    total, goal = (float(x.agg(F.sum(c)).first()[0] or 0) for x, c in ((here, "n"), (there, "t")))
    t, s = F.coalesce("t", F.lit(0)).cast("double"), F.col("n").cast("double")
    gain = F.floor(1000 * F.log((t + 1) * F.lit(total + buckets) / ((s + 1) * F.lit(goal + buckets)))).cast("long")
    return stored(here.join(there, "bucket", "left").select("bucket", gain.alias("gain")), "gains")


def noise(id_: Column, seed: str) -> Column:
    """floor(1000 Gumbel) of the id: -ln(-ln((h + 0.5) / 2**32)), h being 32 bits of a digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", orders: int = 1,
    buckets: int = 10000, percent: int = 10, least_words: int = 20, seed: str = "2024"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features (runs of 1 to ``orders`` words, repeats counted), weight, score, rank, hash.

    Of the rows with ``least_words`` words or more, ``percent`` in a hundred are drawn, rounded down: the highest scores,
    ties to the smaller id, then the smaller hash of the text. ``rank`` is 1, 2, 3... of those drawn, null of others. Null and
    empty texts have no features and weigh 0; a null id comes after all others; rows that repeat are drawn one by one. An
    empty target is one without words; empty ``docs`` give no rows. Texts are read whole; other columns are not read.
    """
    table = gains(docs, target, text_col, target_text, orders, buckets)
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), named(id_col).cast("long").alias("doc"), F.xxhash64(named(text_col)).alias("hash"), named(text_col).alias("text")
    )
    grams = positions(rows, ["uid", "doc", "hash"], "text", orders).withColumn("bucket", bucket_of(F.col("gram"), buckets))
    summed = grams.join(F.broadcast(table), "bucket", "left").groupBy("uid", "doc", "hash").agg(
        F.count("gram").alias("n_features"), F.count_if(F.col("first") & F.col("gram").isNotNull()).alias("words"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight")
    )
    scored = stored(summed.withColumn("score", F.col("weight") + noise(F.col("doc"), seed)), "scored")
    enough = scored.filter(F.col("words") >= least_words)
    # each task numbers its own range of scores, so no task sorts all of them
    placed = numbered(enough, "by-score", [F.desc("score"), F.asc_nulls_last("doc"), F.asc("hash"), F.asc("uid")])
    draw = percent * enough.count() // 100
    placed = placed.withColumn("rank", F.when(F.col("at") < draw, F.col("at") + 1)).drop("at")
    out = placed.unionByName(scored.filter(F.col("words") < least_words).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("doc").alias("doc_id"), "n_features", "weight", "score", "rank", "hash")


def drawn_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that :func:`resample` draws, with all their columns, whatever their names. Rows that repeat both id and text stay or go together."""
    drawn = resample(docs, target, id_col, text_col, **how).filter("rank is not null").select(F.struct(F.col("doc_id").alias("doc"), "hash").alias("drawn")).distinct()
    key = F.struct(named(id_col).cast("long").alias("doc"), F.xxhash64(named(text_col)).alias("hash"))
    return docs.join(drawn, key.doc.eqNullSafe(F.col("drawn.doc")) & (key.hash == F.col("drawn.hash")), "left_semi")


def op12_resampling(spark, sf_dir: str) -> DataFrame:
    """All documents towards the benchmark's words."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("hash")


OP12_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     e AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     dw AS (SELECT doc_id, unnest(w) AS word FROM d), tw AS (SELECT unnest(w) AS word FROM e),
     polynomial AS (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v FROM range(256) r(b))),
     bytes AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM tw)),
     crc AS (SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, length(x), 2), lambda i: CAST('0x' || x[i + 1 : i + 2] AS BIGINT))), lambda c, b: xor(t[CAST(xor(c & 255, b) AS INT) + 1], c // 256))) % 10000 AS bucket FROM bytes, polynomial),
     s AS (SELECT bucket, count(*) AS s FROM dw JOIN crc USING (word) GROUP BY 1), t AS (SELECT bucket, count(*) AS t FROM tw JOIN crc USING (word) GROUP BY 1),
     n AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::DOUBLE AS big, coalesce((SELECT sum(t) FROM t), 0)::DOUBLE AS goal),
     g AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (big + 10000) / ((s::DOUBLE + 1) * (goal + 10000)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (bucket), n),
     m AS (SELECT doc_id, count(*) AS n, sum(gain) AS weight FROM dw JOIN crc USING (word) JOIN g USING (bucket) GROUP BY 1),
     q AS (SELECT d.doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('2024:' || coalesce(d.doc_id::VARCHAR, ''))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN m USING (doc_id)),
     r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY n_features >= 20) * 10 // 100 AS draw FROM q)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= draw THEN place END AS rank FROM r
"""
