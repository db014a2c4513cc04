"""Exact n-gram Jaccard self-join by prefix trees, and the components of its links.

1. Each document becomes the set of its n-gram hashes, put in one global order (rare before frequent, then by hash).
   A bounded list of grams that repeat within batches of the input stands for "frequent"; it only orders, so it can be
   cut at any size without a change of results. Documents with equal sets collapse to one, by aggregation.
2. Two sets of a link share ``l`` or more of the first ``|x| - ceil(t |x|) + l`` grams of each (prefix filter), as
   long as ``l`` is no more than ``ceil(t |x|)``, which any link of x shares. The sets that share a gram follow its
   smallest document, the pivot: so one row per set and pivot, not per gram. As a link has ``l`` shared grams to
   offer, each set may forgo some of its own and still meet all its partners: it leaves the pivots that the fewest of
   its grams lead to, and a set of which fewer grams recur than any link must share has no partner.
3. A pivot's sets are split by size band (linked sets are in the same band or the next) and, beyond a bound on a
   block's grams, into blocks; every pair of blocks that can hold a link meets once, in a group of bounded size.
   Where all sets of a group follow a smaller pivot too, they meet there, and the group is passed over; a pivot that
   is a near copy of another joins its group beforehand.
4. The sets of a group are first compared by bitmaps of one bit a gram, the parity of the grams that fall on it: two
   sets differ by as many grams as their bitmaps by bits at least, so a set whose bitmap is too far from all others
   in its group has no link there. Only the others' texts are read again and their sets brought together.
5. In a group the sets of one block form a radix trie. It is walked once for all sets of the other block: a node
   adds its run of grams to the overlaps of all of them, and a subtree is left when no overlap can still suffice by
   what remains. Links leave as a forest on the block's sets, never as all pairs.
6. Components come from hooking and pointer jumping over stored tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BASES, Rolling, WordHashes, components, merged, mixed, releasing, stored

#: Most entries in the list of frequent grams (8 bytes each): it only orders the grams.
FREQUENT = 65_536
#: Grams of a block at most, and sets of a block at most.
BLOCK_GRAMS, BLOCK_SETS = 400_000, 1024
#: Bytes of a batch of sets, about.
BATCH = 8 << 20
#: Smaller pivots of a set that go with its bitmap; all that remain go with the set itself.
SMALLEST = 4
#: Bytes of the table of which probe holds which gram, so that many probes walk the trie at once.
TABLE = 1 << 26
#: ASCII upper case to lower case, as bytes.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def gram_hashes(text: str | None, n: int, known: WordHashes) -> np.ndarray:
    """Distinct hashes of the n-grams of words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; fewer words are one gram."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = known.of(words)
    if len(words) < n:
        return mixed(Rolling(hashes).runs(np.array([0]), np.array([len(words)])) + np.uint64(len(words)))
    return np.unique(Rolling(hashes).windows(n))


def _frequent(n: int, least: int = 3, most: int = 4_000_000):
    """Grams that are in ``least`` of some thousand documents that follow one another (``most`` grams in all), with their number there."""

    def counted(sets: list[np.ndarray]) -> pd.DataFrame:
        every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        sets.clear()
        every.sort()
        starts = every[: max(0, len(every) - least + 1)]
        gram = np.unique(starts[every[least - 1 :] == starts])
        count = np.searchsorted(every, gram, side="right") - np.searchsorted(every, gram)
        return pd.DataFrame({"gram": gram.view(np.int64), "n": count})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        sets: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in batch["text"].drop_duplicates():
                sets.append(gram_hashes(text, n, known))
                held += len(sets[-1])
            if held >= most:
                yield counted(sets)
                held = 0
        yield counted(sets)

    return releasing(run)


def frequent_grams(texts: DataFrame, n: int) -> np.ndarray:
    """At most FREQUENT grams, sorted: those of the highest counts, down to the last level of counts that fits whole.

    The driver sees a histogram of the counts' levels first, and then just the grams above the level it chose.
    """
    counts = stored(
        texts.select("text").mapInPandas(_frequent(n), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).filter("n >= 8").withColumn("level", F.floor(F.log2("n") * 8).cast("int")),
        "frequent"
    )
    level, held = None, 0
    for r in sorted(counts.groupBy("level").agg(F.count("*").alias("c")).collect(), reverse=True):
        held += r["c"]
        if held > FREQUENT:
            break
        level = r["level"]
    if level is None:
        return np.zeros(0, dtype=np.uint64)
    return np.sort(counts.filter(F.col("level") >= level).select("gram").toPandas()["gram"].to_numpy(dtype=np.int64).view(np.uint64))


def ordered(grams: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Grams in the global order: those not in ``frequent`` (sorted) first, each part by hash."""
    if not len(frequent) or not len(grams):
        return grams
    at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
    often = frequent[at] == grams
    return np.concatenate([grams[~often], grams[often]])


def forgone(size: int, t: Fraction) -> int:
    """Grams that a set of this size may forgo; grows with the size.

    What both sets of a link forgo is at most ``t / 2`` of the larger one's size, so less than the ``ceil(t size)``
    grams that they share, at any threshold.
    """
    return int(min((1 - t) / 4, t * t / (2 * (1 + t))) * size)


def extra(size: int, t: Fraction) -> int:
    """Grams that the prefixes of a link share at least: more than both sets forgo, as the other has ``size / t`` at most."""
    return forgone(size, t) + forgone(int(size / t), t) + 1


def least_shared(size: int, t: Fraction) -> int:
    """Grams that the prefixes of any link of a set of this size share: its partner has ``t size`` at least."""
    return forgone(size, t) + forgone(math.ceil(t * size), t) + 1


def _prefix(size: int, t: Fraction) -> int:
    return min(size, size - math.ceil(t * size) + extra(size, t)) if size else 0


#: Bits of a set's bitmap at least and at most.
BITS = (64, 1 << 15)


def parity(grams: np.ndarray) -> bytes:
    """Bitmap of a set: a power of two of bits, one for each gram or more within BITS; each the parity of the grams that fall on it."""
    bits = min(BITS[1], max(BITS[0], 1 << max(0, len(grams) - 1).bit_length()))
    return np.packbits((np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def far_apart(one: list[bytes], two: list[bytes], sizes_one: np.ndarray, sizes_two: np.ndarray, t: Fraction) -> np.ndarray:
    """Matrix: True where bitmaps differ by more bits than linked sets of these sizes do by grams."""
    bits = 8 * min(map(len, one + two))

    def signs(maps: list[bytes]) -> np.ndarray:
        # folding a bitmap gives the parities of fewer bits
        folded = np.stack([np.unpackbits(np.frombuffer(x, dtype=np.uint8)).reshape(-1, bits).sum(axis=0) & 1 for x in maps])
        return 1 - 2 * folded.astype(np.float32)

    differ = (bits - signs(one) @ signs(two).T) / 2
    return differ * (t.denominator + t.numerator) > (t.denominator - t.numerator) * (sizes_one[:, None] + sizes_two[None, :]).astype(np.float64)


def _summaries(n: int, t: Fraction, frequent: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            size, one, two, prefix, least, forgo, bits = [], [], [], [], [], [], []
            for text in batch["text"]:
                grams = gram_hashes(text, n, known)
                size.append(len(grams))
                with np.errstate(over="ignore"):
                    one.append(int(grams.sum(dtype=np.uint64).view(np.int64)) if len(grams) else 0)
                    two.append(int(mixed(grams * np.uint64(BASES[1])).sum(dtype=np.uint64).view(np.int64)) if len(grams) else 0)
                prefix.append(ordered(grams, frequent)[: _prefix(len(grams), t)].view(np.int64))
                least.append(least_shared(len(grams), t))
                forgo.append(forgone(len(grams), t))
                bits.append(parity(grams))
            yield pd.DataFrame({"doc": batch["doc"], "size": size, "one": one, "two": two, "least": least, "forgo": forgo, "bits": bits, "prefix": prefix})

    return releasing(run)


def band(size: int, t: Fraction) -> int:
    """Size band: sets x <= y of a link have y <= x / t, so their bands are equal or neighbours."""
    return int(math.log(size) / math.log(1 / float(t)) + 1e-9) if size else -1


def _blocks(n: int, frequent: np.ndarray):
    """A row for each group that a document's set meets in: places are (pivot, low band, low block, high band, high block)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            out: list[tuple] = []
            held = 0  # bytes
            for doc, text, places, pivots, copies in zip(batch["doc"], batch["text"], batch["places"], batch["pivots"], batch["copies"]):
                grams = ordered(gram_hashes(text, n, known), frequent).tobytes()
                for p in places:
                    out.append((p["pivot"], p["b1"], p["k1"], p["b2"], p["k2"], doc, p["second"], copies, pivots, grams))
                    held += len(grams) + 200
                    if held >= BATCH:
                        yield pd.DataFrame(out, columns=BLOCK_COLS)
                        out, held = [], 0
            yield pd.DataFrame(out, columns=BLOCK_COLS)

    return releasing(run)


#: A group: pivot, and band and block of both sides.
KEYS = ["pivot", "b1", "k1", "b2", "k2"]
BLOCK_COLS = [*KEYS, "doc", "second", "copies", "pivots", "grams"]
BLOCK_KINDS = "pivot long, b1 int, k1 int, b2 int, k2 int, doc long, second boolean, copies long, pivots array<long>, grams binary"


def trie_overlaps(stored_sets: list[np.ndarray], probes: list[np.ndarray], frequent: np.ndarray, t: Fraction, run: int = 32) -> np.ndarray:
    """Matrix [stored, probe]: True where the Jaccard likeness is ``t`` or more. All sets in the global order."""
    grams, inverse = np.unique(np.concatenate(stored_sets), return_inverse=True)
    place = np.empty(len(grams), dtype=np.int64)  # a gram's place in the global order
    place[np.searchsorted(grams, ordered(grams, frequent))] = np.arange(len(grams))
    sizes = np.array([len(x) for x in stored_sets])
    codes = np.split(place[inverse], np.cumsum(sizes)[:-1])
    order = sorted(range(len(codes)), key=lambda i: codes[i].astype(">u4").tobytes())
    linked = np.zeros((len(codes), len(probes)), dtype=bool)
    at_once = max(8, min(1024, TABLE // max(1, len(grams))))
    for start in range(0, len(probes), at_once):
        some = probes[start : start + at_once]
        has = np.zeros((len(grams), len(some)), dtype=np.uint8)
        for k, probe in enumerate(some):
            at = np.minimum(np.searchsorted(grams, probe), len(grams) - 1)
            has[place[at[grams[at] == probe]], k] = 1
        _walk(codes, order, sizes, has, np.array([len(x) for x in some]), t, run, linked[:, start : start + at_once])
    return linked


def _walk(
    codes: list[np.ndarray], order: list[int], sizes: np.ndarray, has: np.ndarray, probe_sizes: np.ndarray, t: Fraction, run: int,
    linked: np.ndarray
) -> None:
    """Walk the trie of ``codes`` (sorted by ``order``) once for all probes, and mark ``linked``."""

    def need(sets: list[int], probes: np.ndarray) -> np.ndarray:
        # an overlap o suffices if o >= t / (1 + t) * (x + y); in integers
        return -((-t.numerator * (sizes[sets][:, None] + probe_sizes[probes][None, :])) // (t.numerator + t.denominator))

    # A node: the sets order[a:b], which agree on their first ``depth`` grams; probes that may still suffice, and
    # their overlaps with those grams
    todo = [(0, len(order), 0, np.arange(len(probe_sizes)), np.zeros(len(probe_sizes), dtype=np.int64))]
    while todo:
        a, b, depth, probes, overlap = todo.pop()
        here = order[a:b]
        rest = sizes[here] - depth
        left = probe_sizes[probes] - overlap  # grams of a probe that may still match
        enough = need(here, probes)
        alive = (overlap[None, :] + np.minimum(rest[:, None], left[None, :]) >= enough).any(axis=0)
        if not alive.any():
            continue
        ended = [k for k, i in enumerate(here) if sizes[i] == depth]
        for k in ended:
            linked[here[k], probes] = overlap >= enough[k]
        a += len(ended)  # in sorted order, a set that ends here stands first
        if a == b:
            continue
        if 2 * np.count_nonzero(alive) < len(probes):
            probes, overlap = probes[alive], overlap[alive]
        first, last = codes[order[a]], codes[order[b - 1]]
        common = min(len(first), len(last), depth + run)
        differ = np.flatnonzero(first[depth:common] != last[depth:common])
        shared = int(differ[0]) if len(differ) else common - depth
        if shared:
            todo.append((a, b, depth + shared, probes, overlap + _rows(has, first[depth : depth + shared], probes).sum(axis=0)))
            continue
        heads = np.array([codes[i][depth] for i in order[a:b]])
        cuts = np.r_[0, np.flatnonzero(heads[1:] != heads[:-1]) + 1, len(heads)]
        counts = _rows(has, heads[cuts[:-1]], probes)
        todo += [(a + int(x), a + int(y), depth + 1, probes, overlap + counts[k]) for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:]))]


def _rows(has: np.ndarray, grams: np.ndarray, probes: np.ndarray) -> np.ndarray:
    return has[grams] if len(probes) == has.shape[1] else has[grams[:, None], probes[None, :]]


def forest(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix, the smallest node of its component."""
    label = np.arange(len(linked))
    new = linked.any(axis=1)
    for k in np.flatnonzero(new).tolist():
        if not new[k]:
            continue
        near = np.array([k])
        new[k] = False
        while len(near):  # k is the smallest node of its component
            reached = linked[near].any(axis=0) & new
            near = np.flatnonzero(reached)
            new[near] = False
            label[near] = k
    return label


def _all_share(lower: list[np.ndarray]) -> bool:
    """Whether all these arrays of distinct pivots have one in common."""
    if not all(map(len, lower)):
        return False
    return int(np.unique(np.concatenate(lower), return_counts=True)[1].max()) == len(lower)


def _meet_before(lower: list[np.ndarray]) -> np.ndarray:
    """Matrix: True where two sets share one of their ``lower`` pivots."""
    n = len(lower)
    pivots, inverse, count = np.unique(np.concatenate(lower), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(x) for x in lower])
    several = np.flatnonzero(count > 1)
    column = np.full(len(pivots), -1)
    column[several] = np.arange(len(several))
    met = np.zeros((n, n), dtype=bool)
    for start in range(0, len(several), 1024):
        mine = (column[inverse] >= start) & (column[inverse] < start + 1024)
        held = np.zeros((n, 1024), dtype=np.float32)
        held[owner[mine], column[inverse[mine]] - start] = 1
        some = held.any(axis=1)
        met[np.ix_(some, some)] |= held[some] @ held[some].T > 0
    return met


def _links(t: Fraction, frequent: np.ndarray):
    """Links within each group of a partition sorted by group: rows (a, b, 0) of a forest, and (a, a, n) of the number of documents that a links with.

    A pair counts in one group only, that of the smallest pivot which both of its sets follow.
    """

    def group(rows: pd.DataFrame) -> list[np.ndarray]:
        rows = rows.drop_duplicates(["doc", "second", "grams"])
        docs, copies = rows["doc"].to_numpy(), rows["copies"].to_numpy()
        one, two = _sides(rows)
        if not len(one):
            return [docs[:0]] * 3
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["grams"]]
        linked = np.zeros((len(sets), len(sets)), dtype=bool)
        linked[np.ix_(one, two)] = trie_overlaps([sets[k] for k in one], [sets[k] for k in two], frequent, t)
        linked |= linked.T
        label = forest(linked)
        moved = np.flatnonzero(label != np.arange(len(label)))
        degree = np.zeros(len(docs), dtype=np.int64)
        some = np.flatnonzero(linked.any(axis=1))
        if len(moved):
            pairs = linked[np.ix_(some, some)] & (docs[some][:, None] != docs[some][None, :])
            lower = _lower(rows)
            pairs &= ~_meet_before([lower[k] for k in some])
            degree[some] = pairs @ copies[some].astype(np.float64)
        counted = np.flatnonzero(degree)
        return [np.r_[docs[moved], docs[counted]], np.r_[docs[label[moved]], docs[counted]], np.r_[np.zeros(len(moved), np.int64), degree[counted]]]

    return _grouped(group, ["a", "b", "n"])


def _grouped(group, columns: list[str]):
    """Apply ``group`` (rows to one array for each column) to the groups of a partition that is sorted by KEYS."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            rows = pd.concat(held, ignore_index=True) if len(held) > 1 else batch
            keys = rows[KEYS].to_numpy()
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1]
            found = [group(rows.iloc[x:y]) for x, y in zip(cuts[:-1], cuts[1:])]
            held = [rows.iloc[cuts[-1] :]]
            if found:
                yield pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*found)))))
        if held:
            yield pd.DataFrame(dict(zip(columns, group(pd.concat(held, ignore_index=True)))))

    return releasing(run)


def _sides(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Places of a group's rows that are compared with each other: a block with another, or with itself.

    Nothing where one side is empty, or where all sets follow a smaller pivot too.
    """
    second = rows["second"].to_numpy(dtype=bool)
    one, two = np.flatnonzero(~second), np.flatnonzero(second)
    b1, k1, b2, k2 = rows[KEYS[1:]].iloc[0]
    if b1 == b2 and k1 == k2:
        two = one  # where the second of two blocks is empty, there is nothing to compare
    if not len(one) or not len(two) or len(rows) < 2 or _all_share(_lower(rows)):
        return one[:0], two[:0]
    return one, two


def _lower(rows: pd.DataFrame) -> list[np.ndarray]:
    """The pivots below the group's own that each set follows."""
    pivot = rows["pivot"].iloc[0]
    return [np.unique(x[x < pivot]) for x in map(np.asarray, rows["pivots"])]


def _near(t: Fraction):
    """Of each group, the sets that the bitmaps leave a possible partner: doc and place."""
    columns = ["doc", *KEYS, "second"]

    def group(rows: pd.DataFrame) -> list[np.ndarray]:
        one, two = _sides(rows)
        if not len(one):
            return [rows[c].to_numpy()[:0] for c in columns]
        docs, size, bits = rows["doc"].to_numpy(), rows["size"].to_numpy(), rows["bits"].tolist()
        may = ~far_apart([bits[k] for k in one], [bits[k] for k in two], size[one], size[two], t)
        may &= docs[one][:, None] != docs[two][None, :]
        kept = np.union1d(one[may.any(axis=1)], two[may.any(axis=0)])
        return [rows[c].to_numpy()[kept] for c in columns]

    return _grouped(group, columns)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float | Fraction = 0.8) -> DataFrame:
    """One row per input row: doc_id, n_shingles (size of the set), class_id (smallest id with the same set),
    component_id (smallest id reachable by links), n_links (documents it links with; all texts of a repeated id count).

    Documents link when their Jaccard likeness is ``threshold`` or more. Null texts, and texts without words, have an
    empty set and link with nothing. A text of fewer than ``n`` words is one gram. Rows with a null id link with
    nothing, and have a null component. Rows that repeat an id are one node, which links by any of its texts. An empty
    table gives no rows. Texts of any length are read whole; a set of more grams than a block holds has a block of four.
    Identity of grams is that of 64-bit hashes, of sets 128 bits. Other columns are not read.
    """
    spark = docs.sparkSession
    t = Fraction(str(threshold)) if isinstance(threshold, float) else Fraction(threshold)
    if not 0 < t < 1:
        raise ValueError("threshold must be between 0 and 1")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    frequent = frequent_grams(texts, n)

    sets = stored(
        texts.mapInPandas(_summaries(n, t, frequent), "doc long, size long, one long, two long, least int, forgo int, bits binary, prefix array<long>"),
        "sets"
    )
    same = ["size", "one", "two"]
    classes = stored(sets.filter("size > 0 and doc is not null").groupBy(*same).agg(F.min("doc").alias("rep"), F.max("doc").alias("other")), "classes")
    some = sets.filter("size > 0 and doc is not null")
    members = stored(some.drop("prefix", "bits").join(merged(classes.select(*same, "rep")), same).select("doc", "size", "rep", "least", "forgo"), "members")
    # a gram leads to its smallest document, if it is in another one too: an aggregate that combines before its shuffle,
    # and a join whose larger partitions can be split
    held = some.select("doc", F.explode("prefix").alias("gram"))
    pivots = stored(held.groupBy("gram").agg(F.min("doc").alias("pivot"), F.max("doc").alias("last")).filter("pivot < last").select("gram", "pivot"), "pivots")
    led = stored(held.join(merged(pivots), "gram").groupBy("doc", "pivot").agg(F.count("*").alias("n")), "led")
    led = led.join(merged(members.filter("doc = rep").dropDuplicates(["doc", "size"])), "doc")
    by_doc = Window.partitionBy("doc", "size")
    led = led.withColumn("all", F.sum("n").over(by_doc)).withColumn(
        "left", F.sum("n").over(by_doc.orderBy("n", F.desc("pivot")).rowsBetween(Window.unboundedPreceding, 0))
    )
    led = stored(led, "weighed")
    # Copies that lack some of the first pivot's grams would be led to others by these, and the group would meet many
    # times over. A pivot that half of its own recurring grams lead to another joins that one's group, in two steps
    parents = led.filter("pivot < doc and 2 * n >= all").groupBy("doc").agg(F.max_by("pivot", F.struct("n", -F.col("pivot"))).alias("parent")).select(F.col("doc").alias("pivot"), "parent")
    parents = stored(parents, "parents")
    further = parents.select(F.col("pivot").alias("parent"), F.col("parent").alias("beyond"))
    parents = stored(parents.join(merged(further), "parent", "left").select("pivot", F.coalesce("beyond", "parent").alias("parent")), "parents")
    step = math.log(1 / float(t))
    meets = led.filter("all >= least and left > forgo").select("doc", "size", "pivot").join(merged(parents), "pivot", "left")
    meets = meets.select("doc", "size", F.coalesce("parent", "pivot").alias("pivot")).distinct()
    meets = stored(meets.withColumn("band", F.floor(F.log(F.col("size")) / F.lit(step) + F.lit(1e-9)).cast("int")), "meets")

    # Blocks of a pivot's band: as many as keep each within its bounds
    bound = F.greatest(F.lit(4), F.least(F.lit(BLOCK_SETS), F.floor(F.lit(BLOCK_GRAMS) / F.exp((F.col("band") + 1) * step)))).cast("int")
    bands = stored(meets.groupBy("pivot", "band").agg(F.count("*").alias("c")).withColumn("k", F.ceil(F.col("c") / bound).cast("int")), "bands")
    own = F.pmod(F.xxhash64("doc"), F.col("k")).cast("int")
    at = stored(meets.join(merged(bands), ["pivot", "band"]).withColumn("own", own), "at")
    up = bands.select("pivot", (F.col("band") - 1).alias("band"), F.col("k").alias("k_up"))
    down = bands.select("pivot", (F.col("band") + 1).alias("band"), F.col("k").alias("k_down"))
    at = at.join(stored(up, "up"), ["pivot", "band"], "left")
    at = stored(at, "at").join(stored(down, "down"), ["pivot", "band"], "left")

    def place(b1, k1, b2, k2, second):
        return F.struct(
            F.col("pivot").alias("pivot"), b1.cast("int").alias("b1"), k1.cast("int").alias("k1"), b2.cast("int").alias("b2"),
            k2.cast("int").alias("k2"), second.alias("second")
        )

    every = lambda k: F.sequence(F.lit(0), k - 1)
    none = F.array().cast("array<struct<pivot: long, b1: int, k1: int, b2: int, k2: int, second: boolean>>")
    b, o = F.col("band"), F.col("own")
    same_band = F.transform(every(F.col("k")), lambda j: place(b, F.least(o, j), b, F.greatest(o, j), o > j))
    above = F.when(F.col("k_up").isNotNull(), F.transform(every(F.coalesce("k_up", F.lit(1))), lambda j: place(b, o, b + 1, j, F.lit(False)))).otherwise(none)
    below = F.when(
        F.col("k_down").isNotNull(),
        F.transform(every(F.coalesce("k_down", F.lit(1))), lambda j: place(b - 1, j, b, o, F.lit(True)))
    ).otherwise(none)
    # of a lone set in its band without neighbours nothing is to be compared
    alone = (F.col("c") == 1) & F.col("k_up").isNull() & F.col("k_down").isNull()
    met = at.filter(~alone).select("doc", "pivot", F.concat(same_band, above, below).alias("places"))
    met = stored(met.groupBy("doc").agg(F.flatten(F.collect_list("places")).alias("places"), F.collect_set("pivot").alias("pivots")), "places")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    grouped = lambda df: df.repartition(parts, *KEYS).sortWithinPartitions(*KEYS)
    bitmaps = some.select("doc", "size", "bits").join(merged(met), "doc").select("doc", "size", "bits", "pivots", F.explode("places").alias("p"))
    # the few smallest of a set's pivots show most of the groups that meet elsewhere too
    bitmaps = bitmaps.select(
        "p.*", "doc", "size", "bits",
        F.slice(F.array_sort(F.filter("pivots", lambda x: x < F.col("p.pivot"))), 1, SMALLEST).alias("pivots")
    )
    near = stored(grouped(bitmaps).mapInPandas(_near(t), "doc long, pivot long, b1 int, k1 int, b2 int, k2 int, second boolean"), "near")
    copies = members.select("doc", "rep").distinct().groupBy(F.col("rep").alias("doc")).agg(F.count("*").alias("copies"))
    # two sets that link keep the smallest pivot they share, so that later ones know that they have met
    near = near.groupBy("doc").agg(F.collect_set(F.struct(*KEYS, "second")).alias("places")).withColumn(
        "pivots", F.array_distinct(F.transform("places", lambda p: p["pivot"]))
    )
    places = stored(near.join(merged(copies), "doc"), "near-places")
    keyed = texts.join(merged(places), "doc").mapInPandas(_blocks(n, frequent), BLOCK_KINDS)
    links = grouped(keyed).mapInPandas(_links(t, frequent), "a long, b long, n long")
    links = stored(links, "links")
    twice = members.filter("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b")).join(
        members.groupBy("doc").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi").select(F.col("doc").alias("a")),
        "a", "left_semi"
    )
    found = components(stored(links.filter("n = 0").select("a", "b").unionByName(twice).distinct(), "links"))
    degrees = links.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n")).join(
        copies.select(F.col("doc").alias("rep"), "copies"), "rep", "full_outer"
    )
    degrees = stored(degrees.select("rep", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links")), "degrees")

    final = members.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "doc", "size", "rep", F.coalesce("component", "rep").alias("component")
    )
    final = final.join(degrees, "rep")
    nothing = sets.filter("size = 0 or doc is null").select(
        "doc", "size", F.col("doc").alias("rep"), F.col("doc").alias("component"), F.lit(0).cast("long").alias("links")
    )
    return final.unionByName(nothing).select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("rep").alias("class_id"), F.col("links").alias("n_links")
    )


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Shingles of three words, likeness of 0.9 or more, over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs, n=3, threshold=0.9)
