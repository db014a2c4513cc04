"""Temperature mixing of sources to target weights, in DataFrame functions only.

A source's weight is its share of all tokens to the power of an exponent between 0 (all alike) and 1 (as they are).
The exponent is bisected, many ways a round, to the flattest mix whose entropy does not exceed its target and whose
most repeated source stays within the repetition limit. Each source then gets its weight's part of the budget as
whole permutations of its documents and the start of one more, cut where its budget ends; blocks cut across all
sources at the same fractions of their budgets, so every block has the mix's weights.

Running sums over a permutation go by ranges of its hash, some hundred rows each, and those by coarser ranges, as many
as a coarse one has fine ones, whose totals are summed first: no source, however large, is sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import all_of, free_names, named, stored

#: Ways and rounds of the search: the exponent is found to about 1e-7.
WAYS, ROUNDS = 32, 5
#: Rows of a fine range, about.
RANGE = 100
#: Largest exponent tried.
STEEPEST = 64.0


def count_tokens(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+`."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def measure(shares: DataFrame, exponents: list[float], readings: float | None = None) -> list[tuple[float, float, float]]:
    """(exponent, entropy, repetition) for each exponent; repetition is of the source that is read most often. shares: column p.

    With ``readings``, the budget as a multiple of all tokens, each source is read its weight's part of that; without, as
    often as it is while the largest source is read once.
    """
    largest = F.lit(shares.agg(F.max("p")).first()[0])
    x = shares.select("p", F.explode(F.array(*[F.lit(float(a)) for a in exponents])).alias("a"))
    read = F.exp((F.col("a") - 1) * F.log(F.col("p") / (largest if readings is None else F.lit(1.0))))
    x = x.select("a", F.log("p").alias("l"), F.exp(F.col("a") * F.log("p")).alias("q"), read.alias("r"))
    rows = x.groupBy("a").agg(F.sum("q").alias("z"), F.sum(F.col("q") * F.col("l")).alias("s"), F.max("r").alias("r")).collect()  # a row for each exponent
    return sorted((r["a"], math.log(r["z"]) - r["a"] * r["s"] / r["z"], r["r"] if readings is None else r["r"] / r["z"] * readings) for r in rows)


def find_exponent(
    shares: DataFrame, entropy: float | None, repetition: float | None, flatten: float = 0.5, readings: float | None = None
) -> float:
    """Smallest exponent that keeps to both bounds: between 0 and 1, or above 1 for an entropy below the present one.

    Without ``entropy``, its target lies ``flatten`` of the way from the present one to the largest. ``readings`` as in
    :func:`measure`. Bounds that no exponent up to STEEPEST keeps to are an error that says which one.
    """
    low, high = 0.0, 1.0
    ends = measure(shares, [low, high], readings)
    if entropy is None:
        entropy = ends[1][1] + flatten * (ends[0][1] - ends[1][1])

    def fits(m: tuple[float, float, float]) -> bool:
        return m[1] <= entropy + 1e-9 and (repetition is None or m[2] <= repetition + 1e-9)

    if fits(ends[0]):
        return low
    top = ends[1]
    while not fits(top):
        # from 1 on a larger exponent lowers the entropy only, and reads the largest source more often
        if top[1] <= entropy + 1e-9:
            raise ValueError(f"no exponent keeps every source to {repetition} readings: at {top[0]} one is read {top[2]:.6g} times")
        if top[0] >= STEEPEST:
            raise ValueError(f"no exponent up to {STEEPEST} has an entropy of {entropy} or less: at {top[0]} it is {top[1]:.6g}")
        low, high = high, high * 2
        top = measure(shares, [high], readings)[0]
    for _ in range(ROUNDS):
        step = (high - low) / WAYS
        good = [m[0] for m in measure(shares, [low + step * k for k in range(1, WAYS)], readings) if fits(m)]
        high = min(good, default=high)
        low = max(low, high - step)
    found = round(high, 6)
    return found if fits(measure(shares, [found], readings)[0]) else high


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", entropy: float | None = None,
    repetition: float | None = 4.0, budget: int | None = None, blocks: int = 64, seed: int = 17
) -> DataFrame:
    """One row per document taken and time it is taken: doc_id, source, n_tokens, epoch, offset (tokens of its source
    before it), block, weight, budget (of its source), exponent, and hash of the text.

    Without ``budget`` the largest source is read once, so nothing is left out. With one (tokens, of all sources together)
    ``repetition`` bounds the readings of every source within it, the last one begun counting in part. An ``entropy`` or
    ``repetition`` that no exponent can keep to is an error (a budget of ten times all tokens reads some source ten times
    or more, whatever the mix). A document is taken while its source's
    budget holds all of it. Documents without tokens (null, empty) cost nothing and are taken once; null sources are
    one source, with an empty name. Rows that repeat are documents of their own, an empty table gives no rows. Other
    columns are not read.
    """
    rows = stored(
        docs.select(
            named(id_col).cast("long").alias("doc"), F.xxhash64(named(text_col)).alias("hash"),
            F.coalesce(named(source_col).cast("string"), F.lit("")).alias("source"), count_tokens(named(text_col)).alias("n")
        ),
        "tokens"
    )
    totals = rows.groupBy("source").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("docs")).filter("total > 0")
    whole = rows.agg(F.sum("n")).first()[0] or 0
    empty = rows.filter("n = 0").select("doc", "hash", "source", "n", F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("offset"), F.lit(0).alias("block"))
    totals = stored(totals.withColumn("p", F.col("total") / F.lit(float(max(1, whole)))), "totals")
    exponent = find_exponent(totals, entropy, repetition, readings=None if budget is None else budget / whole) if whole else 1.0
    power = totals.withColumn("q", F.exp(F.lit(exponent) * F.log("p")))
    z, top_total, top_power = power.agg(F.sum("q"), F.max("total"), F.max("q")).first()
    every = budget if budget is not None else (top_total or 0) * (z or 1) / (top_power or 1)
    sources = power.withColumn("weight", F.col("q") / F.lit(z or 1.0)).withColumn("budget", F.round(F.col("weight") * F.lit(float(every))).cast("long"))
    sources = sources.withColumn("ranges", F.ceil(F.sqrt(F.col("docs") / RANGE)).cast("long"))
    sources = stored(sources.select("source", "total", "weight", "budget", "ranges"), "sources")

    times = F.floor(F.col("budget") / F.col("total")).cast("int") + F.when(F.col("budget") % F.col("total") > 0, 1).otherwise(0)
    taken = rows.filter("n > 0").join(sources, "source").filter(times > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), times - 1)))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "epoch", "doc", "hash"), 11) / F.lit(float(2**53))  # in [0, 1)
    fine = F.floor(F.col("place") * F.col("ranges") * F.col("ranges")).cast("long")
    taken = taken.withColumn("place", place).withColumn("fine", fine).withColumn("coarse", F.floor(F.col("fine") / F.col("ranges")))
    taken = stored(taken.select("doc", "hash", "source", "n", "epoch", "total", "budget", "place", "coarse", "fine"), "taken")
    sums = stored(taken.groupBy("source", "epoch", "coarse", "fine").agg(F.sum("n").alias("n")), "sums")

    def before(rows: DataFrame, keys: list[str], by: list[str], name: str) -> DataFrame:
        so_far = F.sum("n").over(Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1))
        return rows.withColumn(name, F.coalesce(so_far, F.lit(0)))

    keys = ["source", "epoch", "coarse"]
    outer = before(sums.groupBy(*keys).agg(F.sum("n").alias("n")), keys[:2], ["coarse"], "outer").drop("n")
    firsts = before(sums, keys, ["fine"], "inner").drop("n").join(outer, keys)
    firsts = stored(firsts.select(*keys, "fine", (F.col("outer") + F.col("inner")).alias("first")), "firsts")
    placed = before(taken, [*keys, "fine"], ["place", "doc", "hash"], "within").join(firsts, [*keys, "fine"])
    offset = F.col("epoch") * F.col("total") + F.col("first") + F.col("within")
    placed = placed.withColumn("offset", offset.cast("long")).filter(F.col("offset") + F.col("n") <= F.col("budget"))
    block = F.floor(F.col("offset") * F.lit(float(blocks)) / F.col("budget")).cast("int")
    out = placed.select("doc", "hash", "source", "n", "epoch", "offset", block.alias("block")).unionByName(empty)
    out = out.join(sources.select("source", "weight", "budget"), "source", "left")
    return out.select(
        F.col("doc").alias("doc_id"), "source", F.col("n").alias("n_tokens"), "epoch", "offset", "block",
        F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("budget", F.lit(0).cast("long")).alias("budget"),
        F.lit(exponent).alias("exponent"), "hash"
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs``, each as many times as the mix takes it; same columns, whatever their names. See :func:`mix`.

    The mix tells rows apart by id, text and source, nulls being values of their own; of rows that repeat in all three
    each is taken the same number of times, to within one. Rows without words are taken once. An empty table gives no rows.
    """
    key_, same_, times_, nth_ = free_names(docs, "_key", "_same", "_times", "_nth")
    key = F.struct(
        named(id_col).cast("long").alias("doc"), F.xxhash64(named(text_col)).alias("hash"),
        F.coalesce(named(source_col).cast("string"), F.lit("")).alias("source")
    )
    taken = mix(docs, id_col, text_col, source_col, **how).groupBy(F.struct(F.col("doc_id").alias("doc"), "hash", "source").alias("key")).agg(F.count("*").alias("taken"))
    there = docs.select(key.alias("key")).groupBy("key").agg(F.count("*").alias("rows"))
    each = taken.join(there, "key").select(
        F.col("key").alias(same_), F.round(F.col("taken") / F.col("rows")).cast("int").alias(times_)
    ).filter(F.col(times_) > 0)
    rows = docs.withColumn(key_, key)
    joined = rows.join(each, [F.col(f"{key_}.{k}").eqNullSafe(F.col(f"{same_}.{k}")) for k in ("doc", "hash", "source")])
    return joined.withColumn(nth_, F.explode(F.sequence(F.lit(1), F.col(times_)))).select(*all_of(docs))


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents: entropy half way to the largest, no source more than four times, the largest source once."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("hash")
