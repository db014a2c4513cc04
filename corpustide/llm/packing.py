"""Best-fit sequence packing by the configuration linear program over the length histogram.

A configuration is a multiset of lengths that fits one sequence. The program asks for the fewest sequences whose
configurations cover the histogram. It is solved by multiplicative weights: each length has a weight that falls as it
is covered, the weights price the lengths, and a knapsack dynamic program over the capacity finds the dearest
configurations, until every length is covered. The fractional solution is rounded, and the program is solved and
rounded again for what that leaves; the last few pieces are packed largest first, each sequence being completed by
the best fit, where that takes fewer sequences.

Only the histogram (at most ``capacity`` numbers) reaches the driver. Pieces find their place from their rank among
those of their length: ranks come from salted groups and their prefix counts, so no length is gathered in one task.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import releasing, stored

#: The pre-tokenizer's pattern: fixed value, part of the vocabulary's public definition.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with other characters than these, or a special token, go to the tokenizer as a whole: for the rest this
#: process and the tokenizer agree on the classes of characters.
PLAIN = "[^\\x00-\\x1b\\x20-\\u024f\\u2010-\\u2027\\u2030-\\u205e]|<\\|"


class Ids:
    """Ids (little-endian 32-bit) of a text, those that the tokenizer file gives.

    Its merges stand in the order of their ids, so they are also ranks, and plain texts go through the faster
    implementation of the same algorithm (tests hold it against the tokenizers library); all others go to that library.
    """

    def __init__(self, path: str):
        import json
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.odd = re.compile(PLAIN).search
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, merges = file["model"]["vocab"], file["model"]["merges"]
        special = {t["content"] for t in file["added_tokens"]}
        joined = ["".join(m.split(" ") if isinstance(m, str) else m) for m in merges]
        usual = file["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True
        } and not file.get("normalizer")
        self.fast = None
        if usual and [vocabulary[m] for m in joined] == list(range(256, 256 + len(joined))):
            shown = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or 174 <= c <= 255]  # bytes that stand for themselves
            hidden = [c for c in range(256) if c not in shown]
            byte = {chr(c): c for c in shown} | {chr(256 + n): c for n, c in enumerate(hidden)}
            ranks = {bytes(byte[c] for c in token): n for token, n in vocabulary.items() if token not in special}
            self.fast = tiktoken.Encoding("fast", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def encode(self, text: str) -> bytes:
        if self.fast is None or self.odd(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return self.fast(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def _pieces(path: str, capacity: int, end: int, ids: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Ids(path)
        last = int(end).to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc"], batch["text"]):
                data = known.encode(text or "") + last
                n = len(data) // 4
                first = n % capacity or capacity
                start = 0
                for k, stop in enumerate(range(first, n + 1, capacity)):
                    part = data[4 * start : 4 * stop]
                    rows.append((doc, k, start, stop - start, zlib.crc32(part), part if ids else None))
                    start = stop
            out = pd.DataFrame(rows, columns=["doc", "piece", "start", "length", "ids_crc32", "ids"])
            out["doc"] = out["doc"].astype("Int64")
            yield out

    return releasing(run)


def knapsack(prices: np.ndarray, capacity: int, noise: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Knapsack by dynamic programming. prices: [capacity + 1], 0 where there is no length.

    Gives for each capacity the best value, the length taken last, and the largest capacity up to it where one is
    taken. Each step's prices rise by up to ``noise``, another amount for each capacity and length, so that of
    configurations of about one value different lengths find different ones.
    """
    low = int(np.flatnonzero(prices)[0])
    best, took = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    turned = np.zeros(capacity + 1)  # best, from the end
    shake = rng.random(3 * capacity)
    starts = rng.integers(0, 2 * capacity - 1, capacity + 1).tolist()
    own, rise = prices[low:], ((prices > 0) * noise)[low:]
    for c in range(low, capacity + 1):
        n = c - low + 1
        value = turned[capacity - c + low : capacity + 1] + own[:n]
        if noise:
            value += shake[starts[c] : starts[c] + n] * rise[:n]
        k = int(value.argmax())
        if value[k] > best[c - 1]:
            best[c], took[c] = value[k], k + low
        else:
            best[c] = best[c - 1]
        turned[capacity - c] = best[c]
    return best, took, np.maximum.accumulate(np.where(took > 0, np.arange(capacity + 1), 0))


def through(lengths: np.ndarray, took: np.ndarray, at: np.ndarray, capacity: int) -> list[list[int]]:
    """The dearest configuration through each length, which stands first in it."""
    out = [[int(x)] for x in lengths]
    room = at[capacity - lengths]
    live = np.flatnonzero(room)
    while len(live):
        items = took[room[live]]
        for k, x in zip(live.tolist(), items.tolist()):
            out[k].append(x)
        room[live] = at[room[live] - items]
        live = live[room[live] > 0]
    return out


Configuration = tuple[tuple[int, int], ...]


def fractional(
    demand: np.ndarray, capacity: int, rng: np.random.Generator, keep: float = 0.9, least: float = 0.01, reach: float = 0.75,
    rate: float = 0.25
) -> tuple[dict[Configuration, float], float]:
    """Multiplicative weights on the configuration program: configurations ((length, count), …) with their multiplicity, and a lower bound.

    A length's price is its share of the capacity times its weight, and its weight falls by the same factor as the
    share of its demand that is left, to the power of ``rate``. Rounds lower what may be left of any length by the
    factor ``keep``, at last to nothing: lengths that have more left are covered by the dearest configuration through
    them, as far as no other length in it falls below ``reach`` of the round's share. So every length ends covered
    exactly, and none runs out long before the others. No configuration holds more of a length than there is.
    Some hundred knapsacks of ``capacity`` squared steps each are solved on the driver, however many pieces there are:
    seconds for a capacity of 1024, about a minute for 8192.
    """
    lengths = np.flatnonzero(demand)
    have, wanted = demand.astype(float), demand.tolist()
    left = [float(x) for x in wanted]
    found: dict[Configuration, float] = {}
    bound, solved, most = 0.0, 0, 1.0
    while most > 0:
        most = most * keep if most * keep > least else 0.0
        low = most * reach
        while True:
            share = np.array(left)[lengths] / have[lengths]
            late = lengths[share > most + 1e-9]
            if not len(late):
                break
            weighted, prices = np.zeros(capacity + 1), np.zeros(capacity + 1)
            weighted[lengths] = lengths / capacity * np.clip(share, 1e-6, 1.0) ** rate
            open_ = lengths[share > low + 1e-9]
            prices[open_] = weighted[open_]
            if solved % 20 == 0:  # the dearest configuration at any prices bounds the program
                bound = max(bound, float(weighted @ have) / float(knapsack(weighted, capacity, 0.0, rng)[0][capacity]))
            best, took, at = knapsack(prices, capacity, 0.03 / capacity, rng)
            solved += 1
            configurations = through(late, took, at, capacity)
            for k in np.argsort(-(prices[late] + best[capacity - late]), kind="stable").tolist():
                first = configurations[k][0]
                if left[first] <= most * wanted[first] + 1e-9:
                    continue  # another one has covered it meanwhile
                counts = {x: min(n, wanted[x]) for x, n in Counter(configurations[k]).items()}
                step = (left[first] - most * wanted[first]) / counts[first]
                for x, n in counts.items():
                    if x != first:
                        step = min(step, (left[x] - low * wanted[x]) / n)
                if step <= 1e-9:
                    continue
                key = tuple(sorted(counts.items()))
                found[key] = found.get(key, 0.0) + step
                for x, n in counts.items():
                    left[x] -= step * n
    return found, bound


def _complete(left: np.ndarray, room: int) -> list[int]:
    """Lengths that fill ``room`` best: exactly by one or by two if that can be, else the largest that fits, again and again."""
    out: list[int] = []
    left = left.copy()
    while room > 0:
        have = np.flatnonzero(left[: room + 1])
        if not len(have):
            break
        if left[room]:
            out.append(room)
            break
        other = room - have
        pair = have[(left[other] > 0) & ((other != have) | (left[have] > 1))]
        if len(pair):
            out += [int(pair[-1]), int(room - pair[-1])]
            break
        top = int(have[-1])
        out.append(top)
        left[top] -= 1
        room -= top
    return out


Plan = list[tuple[dict[int, int], int]]


def _greedy(left: np.ndarray, capacity: int) -> Plan:
    """Configurations that hold what is left exactly: largest first, each completed by the best fit. Empties ``left``."""
    out: Plan = []
    while left.any():
        top = int(np.flatnonzero(left)[-1])
        left[top] -= 1
        items = [top, *_complete(left, capacity - top)]
        left[top] += 1
        values, counts = np.unique(items, return_counts=True)
        times = int((left[values] // counts).min())
        out.append(({int(a): int(b) for a, b in zip(values, counts)}, times))
        left[values] -= times * counts
    return out


def _rounded(found: dict[Configuration, float], left: np.ndarray, capacity: int, share: float = 0.75) -> Plan:
    """Configurations of a fractional solution, taken from ``left``: all rounded down, then of those that are no emptier
    than the mean the ones with the largest remainders rounded up, until ``share`` of what rounding down left is placed."""
    out: Plan = []
    size = {k: sum(x * n for x, n in k) for k in found}
    fullness = sum(found[k] * size[k] for k in found) / sum(found.values())

    def take(key: Configuration, times: int) -> int:
        times = min(times, *(int(left[x]) // n for x, n in key))
        if times > 0:
            out.append((dict(key), times))
            for x, n in key:
                left[x] -= times * n
        return max(0, times) * sum(n for _, n in key)

    for key in sorted(found, key=lambda k: (-size[k], -found[k], k)):
        take(key, int(found[key] + 1e-6))
    wanted = share * left.sum()
    upwards = sorted(found, key=lambda k: (-(found[k] % 1), -size[k], k))
    for some in ([k for k in upwards if size[k] >= fullness - 1e-9], upwards):  # the fuller ones alone, if any of them still fits
        done = 0
        for key in some:
            if done >= wanted:
                break
            done += take(key, 1)
        if done:
            break
    return out


def configurations(histogram: dict[int, int], capacity: int) -> Plan:
    """Configurations ({length: count}, multiplicity) that hold the histogram exactly. See :func:`solve`."""
    return solve(histogram, capacity)[0]


def solve(histogram: dict[int, int], capacity: int) -> tuple[Plan, dict[str, float]]:
    """The plan, and figures of it: pieces below capacity, those placed by the program, its value and lower bound.

    The program is solved and rounded, then again for what rounding left, until nothing is. After each time the rest
    could also be packed greedily; of these plans that of the fewest sequences is kept, the latest of equals.
    """
    rng = np.random.default_rng(7)
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    whole: Plan = []
    if left[capacity]:
        whole.append(({capacity: 1}, int(left[capacity])))
        left[capacity] = 0
    pieces = int(left.sum())
    about: dict[str, float] = {"pieces": pieces, "placed": 0, "value": 0.0, "bound": 0.0}
    plan: Plan = []
    best, fewest = plan, math.inf
    while left.any():
        found, bound = fractional(left, capacity, rng, *((0.6, 0.05) if plan else (0.9, 0.01)))  # coarser for the rest
        if not plan:
            about |= {"value": sum(found.values()), "bound": bound}
        plan = plan + _rounded(found, left, capacity)
        rest = _greedy(left.copy(), capacity)
        sequences = sum(times for _, times in plan) + sum(times for _, times in rest)
        if sequences <= fewest:
            best, fewest = plan + rest, sequences
            about["placed"] = pieces - int(left.sum())
    return whole + best, about


def layout(plan: list[tuple[dict[int, int], int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, its slots in the order of the plan: last rank (exclusive), count in the configuration, first sequence, offset."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    base = 0
    for counts, times in plan:
        offset = 0
        for length, n in counts.items():
            rows.setdefault(length, []).append((n * times, n, base, offset))
            offset += n * length
        base += times
    out = {}
    for length, slots in rows.items():
        size, n, first, offset = (np.array(x, dtype=np.int64) for x in zip(*slots))
        out[length] = (np.cumsum(size), size, n, first, offset)
    return out


def _place(slots: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for at in np.unique(length):
                mine = np.flatnonzero(length == at)
                ends, size, n, first, start = slots[int(at)]
                k = np.searchsorted(ends, rank[mine], side="right")
                inside = rank[mine] - (ends[k] - size[k])
                sequence[mine] = first[k] + inside // n[k]
                offset[mine] = start[k] + inside % n[k] * at
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return releasing(run)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end: int = 2, ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, ids (little-endian 32-bit; null without ``ids``).

    A document is its ids by ``tokenizer`` (a file of the tokenizers library) and ``end``; null and empty texts are
    ``end`` alone. Documents longer than ``capacity`` are cut into pieces of that length, the first taking the
    remainder. Rows are documents of their own even where ids repeat or are null; other columns are not read. An
    empty table gives no rows.
    """
    kinds = "doc long, piece int, start long, length long, ids_crc32 long, ids binary"
    pieces = stored(
        docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).mapInPandas(_pieces(tokenizer, capacity, end, ids), kinds),
        "pieces"
    )
    histogram = {int(r["length"]): int(r["n"]) for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    slots = layout(configurations(histogram, capacity), capacity)
    # A length's pieces are dealt to coarse groups, and those to fine ones of some hundreds of rows; the sums before a
    # group are over the square root of their number, at each level
    groups = max(1, math.isqrt(max(histogram.values(), default=0) // 400) + 1)
    dealt = F.xxhash64("doc", "piece", "ids_crc32")
    salted = pieces.withColumn("coarse", F.pmod(dealt, F.lit(groups))).withColumn("fine", F.pmod(F.shiftrightunsigned(dealt, 32), F.lit(groups)))
    sizes = stored(salted.groupBy("length", "coarse", "fine").agg(F.count("*").alias("n")), "sizes")

    def before(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
        so_far = F.sum("n").over(Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1))
        return rows.withColumn(f"before_{by}", F.coalesce(so_far, F.lit(0))).drop("n")

    outer = before(sizes.groupBy("length", "coarse").agg(F.sum("n").alias("n")), ["length"], "coarse")
    firsts = stored(before(sizes, ["length", "coarse"], "fine").join(outer, ["length", "coarse"]), "firsts")
    keys = ["length", "coarse", "fine"]
    within = F.row_number().over(Window.partitionBy(*keys).orderBy("doc", "piece", "ids_crc32", "start"))
    rank = F.col("before_coarse") + F.col("before_fine") + F.col("within") - 1
    ranked = salted.withColumn("within", within).join(firsts, keys).select("doc", "piece", "start", "length", "ids_crc32", "ids", rank.alias("rank"))
    placed = ranked.mapInPandas(_place(slots), f"{kinds}, sequence_id long, offset long")
    return placed.select(F.col("doc").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids")


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents into sequences of 1024 tokens of the 50k byte-level vocabulary."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, str(public_tokenizers.path("byte_bpe_50k.json")), ids=False).drop("ids")
