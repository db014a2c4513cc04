"""Secret scan by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by patterns, with their places in code points. Each candidate value is then counted over the
whole corpus by distinct repositories and owners: a value that several owners hold in several repositories is an
example that is copied around. One that few owners hold looks live, in however many repositories of theirs; so does
one that many owners share in few repositories, as it has not spread beyond those.

Places come from cutting the text at the matches: the pieces between them and the matches alternate, so running sums
of their lengths give the starts, at any number of matches and length of text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, named, stored

#: Kinds in their order: pattern of a match; group of its value; fewest characters of the value. Fixed values; the
#: first three are the base kinds. Hex and access-key matches are runs, so asking for the length in the pattern
#: finds the same ones as dropping short runs.
KINDS = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\x09-\x0D\x20]*", 0, 1),
    ("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}=*", 0, 1),
    ("prefixed", r"(?:gh[oprsu]|github_pat|glpat|xox[abprs])[_-][A-Za-z0-9_-]{16,}", 0, 1),
]
BASE = 3
#: Values held by as many owners or more, and in as many repositories or more, are examples.
OWNERS, REPOSITORIES = 3, 3
_SPAN = "struct<start: bigint, rank: int, stop: bigint, value: string>"


def _spans(text: Column, rank: int) -> Column:
    """Kept spans of one kind, in order: array of (start, rank, stop, value)."""
    _, pattern, group, least = KINDS[rank]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    value = (lambda m: F.regexp_extract(m, pattern, group)) if group else (lambda m: m)

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.char_length(pair["gap"])
        stop = start + F.char_length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"), value(pair["match"]).alias("value"))
        return F.struct(stop.cast("bigint").alias("at"), F.concat(acc["spans"], F.array(span.cast(_SPAN))).alias("spans"))

    def later(at: Column, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct((s["start"] + at).alias("start"), s["rank"].alias("rank"), (s["stop"] + at).alias("stop"), s["value"].alias("value")).cast(_SPAN))

    pairs = F.zip_with(matches, F.slice(gaps, 1, F.size(matches)), lambda m, g: F.struct(g.alias("gap"), m.alias("match")))
    none = F.array().cast(f"array<{_SPAN}>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))
    walked = folded(
        pairs, lambda part: F.aggregate(part, start, step), start,
        lambda acc, part: F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["spans"], later(acc["at"], part["spans"])).alias("spans"))
    )["spans"]
    return F.when(text.rlike(pattern), F.filter(walked, lambda s: F.char_length(s["value"]) >= least)).otherwise(none)


def folded(items: Column, inner: Callable[[Column], Column], start: Column, outer: Callable[[Column, Column], Column]) -> Column:
    """An array folded in two levels: parts of about the square root of its size, then what they gave. An array that
    grows by one with every step is copied at every step, so n of them cost n to the power of 1.5 this way, not n squared."""
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items)))).cast("int")
    parts = F.transform(F.sequence(F.lit(0), (F.greatest(F.size(items), F.lit(1)) - 1).cast("int"), width), lambda k: inner(F.slice(items, k + 1, width)))
    return F.aggregate(parts, start, outer)


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["stop"])), ",")


def candidates(docs: DataFrame, id_col: str, text_col: str, repo_col: str, owner_col: str) -> DataFrame:
    """Stored: uid (a number for each input row), doc, hash (of the text), repo, owner, spans."""
    text = F.coalesce(named(text_col), F.lit(""))
    spans = F.array_sort(F.concat(*[_spans(text, k) for k in range(len(KINDS))]))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"), named(id_col).cast("long").alias("doc"),
        F.sha2(named(text_col), 256).alias("hash"), F.coalesce(named(repo_col).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(named(owner_col).cast("string"), F.lit("")).alias("owner"), spans.alias("spans")
    )
    return stored(rows, "candidates")


def ownership(found: DataFrame) -> DataFrame:
    """Of each candidate value (by SHA-256): distinct repositories and owners, over the whole corpus."""
    values = found.select("repo", "owner", F.explode("spans").alias("s")).select(F.sha2("s.value", 256).alias("value"), "repo", "owner").distinct()
    return values.groupBy("value").agg(F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners"))


def _verdicts(found: DataFrame, owners: int, repositories: int) -> DataFrame:
    """Spans with what holds their values: uid, span, repos, owners, live."""
    counts = stored(ownership(found), "ownership")
    spans = found.select("uid", F.explode("spans").alias("span")).withColumn("value", F.sha2("span.value", 256))
    return spans.join(counts, "value").select("uid", "span", "repos", "owners", ((F.col("owners") < owners) | (F.col("repos") < repositories)).alias("live"))


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str = "source",
    owners: int = OWNERS, repositories: int = REPOSITORIES
) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, live_spans, held_by.

    ``held_by`` has, for each of ``spans`` in their order, the distinct repositories and owners of its value. Null texts
    count as empty, null repositories and owners as one that is unnamed. Values of ``owners`` distinct owners or more in
    ``repositories`` distinct repositories or more are examples, others live. Rows that repeat an id each get a row, an
    empty table gives none, texts of any length are read whole. Other columns are not read.
    """
    found = candidates(docs, id_col, text_col, repo_col, owner_col)
    judged = _verdicts(found, owners, repositories).groupBy("uid").agg(
        F.array_sort(F.collect_list(F.when(F.col("live"), F.col("span")))).alias("live"),
        F.count_if(~F.col("live")).alias("n_example"),
        F.array_sort(F.collect_list(F.struct("span", "repos", "owners"))).alias("held")
    )
    of = lambda k: F.size(F.filter("spans", lambda s: s["rank"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["rank"] < BASE)
    out = found.join(judged, "uid", "left")
    return out.select(
        F.col("doc").alias("doc_id"), of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        F.coalesce(F.size("live").cast("long"), F.lit(0).cast("long")).alias("n_live"), F.coalesce("n_example", F.lit(0)).cast("long").alias("n_example"), F.coalesce(_listed(F.col("live")), F.lit("")).alias("live_spans"),
        F.coalesce(
            F.transform("held", lambda h: F.struct(h["repos"].alias("repos"), h["owners"].alias("owners"))),
            F.array().cast("array<struct<repos: bigint, owners: bigint>>")
        ).alias("held_by"),
    )


def redact_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str = "source",
    owners: int = OWNERS, repositories: int = REPOSITORIES, mark: str = "[SECRET]"
) -> DataFrame:
    """The rows of ``docs`` with every live-looking secret replaced by ``mark``; examples stay. Same columns, whatever their names.

    Null texts stay null, texts without secrets as they are; rows that repeat, and rows without an id, are each kept.
    Where spans of several kinds overlap, one mark takes the place of all. An empty table gives no rows.
    """
    spans_, hash_, clean_, chunks_, kept_ = free_names(docs, "_spans", "_hash", "_clean", "_chunks", "_kept")
    any_kind = "|".join(f"(?:{k[1]})" for k in KINDS)
    has = F.coalesce(named(text_col).rlike(any_kind), F.lit(False))
    marked = docs.filter(has)
    found = candidates(marked, id_col, text_col, repo_col, owner_col)
    live = _verdicts(found, owners, repositories).filter("live").groupBy("uid").agg(F.array_sort(F.collect_list("span")).alias("live"))
    # spans and verdicts follow from the text alone, so one row for each distinct text is enough
    keyed = stored(
        found.join(live, "uid").select("hash", "live").dropDuplicates(["hash"]), "live"
    ).select(F.col("hash").alias(hash_), F.col("live").alias(spans_))
    redacted = marked.join(keyed, F.sha2(named(text_col), 256) == F.col(hash_), "left")
    # columns of their own: within a function over an array an expression is worked out again for each element
    redacted = redacted.withColumn(chunks_, F.when(F.col(spans_).isNotNull(), chunked(named(text_col)))).withColumn(kept_, kept_between(F.coalesce(F.col(spans_), F.array().cast(f"array<{_SPAN}>"))))
    clean = F.when(F.col(spans_).isNull(), named(text_col)).otherwise(masked(named(text_col), F.col(chunks_), F.col(kept_), mark))
    return docs.filter(~has).unionByName(redacted.withColumn(clean_, clean).select(*[F.col(clean_).alias(c) if c == text_col else named(c) for c in docs.columns]))


#: Characters of a chunk that texts are cut into, so that a place in a long one is found without reading it from its start.
CHUNK = 1000


def chunked(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def kept_between(spans: Column) -> Column:
    """Of spans (start, stop; by start): ``kept``, the stretch before each, from the farthest stop so far to its start (its
    stop lies before its start where the span begins within another), and ``at``, where the last stretch begins."""
    kind = "struct<start: bigint, stop: bigint>"
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{kind}>").alias("kept"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.struct(acc["at"].alias("start"), s["start"].alias("stop")).cast(kind)
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.concat(acc["kept"], F.array(gap)).alias("kept"))

    def later(at: Column, gaps: Column) -> Column:
        return F.transform(gaps, lambda g: F.struct(F.greatest(g["start"], at).alias("start"), g["stop"].alias("stop")).cast(kind))

    return folded(
        spans, lambda part: F.aggregate(part, none, step), none,
        lambda acc, part: F.struct(F.greatest(acc["at"], part["at"]).alias("at"), F.concat(acc["kept"], later(acc["at"], part["kept"])).alias("kept"))
    )


def masked(text: Column, chunks: Column, kept: Column, mark: str) -> Column:
    """A text of which only what :func:`kept_between` gives is left, with ``mark`` after each stretch but the last."""

    def between(start: Column, stop: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        some = F.array_join(F.slice(chunks, first + 1, F.floor(stop / CHUNK).cast("int") - first + 1), "")
        return F.substr(some, (start - first * CHUNK + 1).cast("int"), (stop - start).cast("int"))

    pieces = F.transform(F.filter(kept["kept"], lambda g: g["stop"] >= g["start"]), lambda g: F.concat(between(g["start"], g["stop"]), F.lit(mark)))
    return F.concat(F.array_join(pieces, ""), between(kept["at"], F.char_length(text)))


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Every document; repositories and owners are the sources."""
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("held_by")
