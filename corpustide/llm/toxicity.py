"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Five transducers are composed into one machine. The first reads words and writes classes (insult, likely insult,
threat, target, negation, report, other); the second finds threats that reach a target; the third insults at a target,
before or after them; the fourth what a negation reaches; the fifth what is reported speech, to the end of the clause.
The machine runs once over each clause that holds an insult or a threat; what it emits are matched patterns, never
isolated words, and each has a weight. A document's score is the logistic of the weights times the logarithm of one
plus the pattern's number, so no match is left out of count; likely insults also count by their share of all words.

The lexicon grows from labelled rows: of words and stems that are far more frequent in toxic documents, those are
taken that explain toxic documents which the ones taken before explain little; a second, less strict pass finds likely
insults, of which one alone says little. The weights are fitted on the same rows, from general ones.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import held_out, sample

#: Fixed word lists of the grammar, in English, French, German and Spanish: general knowledge, not learned.
INSULTS = frozenset("idiot moron imbecile scumbag crétin imbécile dummkopf trottel idiota estúpido".split())
THREATS = frozenset("kill hurt destroy beat stab shoot strangle murder tuer frapper détruire töten schlagen umbringen vernichten matar golpear destruir".split())
TARGETS = frozenset("you your yours you're u he she him her they them these those this tu toi te vous il elle ils du dich dir dein ihr euch sie er tú ti usted él ella ellos".split())
NEGATIONS = frozenset("not never no nobody isn't aren't wasn't weren't don't doesn't didn't won't ne pas jamais aucun nicht kein keine nie niemals nunca jamás".split())
REPORTS = frozenset("said says wrote writes called calls quoted reported claimed alleged dit écrit affirme sagte sagt schrieb nannte dijo dice escribió llamó".split())

OTHER, INSULT, LIKELY, THREAT, TARGET, NEGATION, REPORT, DIRECT, AIMED, THREATENED, NEGATED, REPORTED = range(12)
#: What the machine emits, and the pattern that it counts for; an insult that turns out to be aimed is no longer bare.
PATTERNS = ("insult at a target", "bare insult", "threat at a target", "negated", "reported", "likely insult", "share of likely insults")
#: Weights before fitting, intercept first.
PRIOR = np.array([-4.0, 7.0, 6.0, 7.0, 0.5, 1.0, 1.0, 1.0])
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
#: Rows of each class to learn from at most.
SAMPLE = 10_000


#: Lengths of stems; a stem is written with a star.
STEMS = (4, 5, 6, 7)
#: A candidate must be so many times as frequent in toxic rows as in clean ones; and one for a likely insult.
STRICT, LOOSE = 20, 4
#: What a row still counts for with each candidate that explains it, as a factor.
FADE = 0.65


def features(text: str | None) -> set[str]:
    """Words and stems of a text."""
    words = set(WORD.findall((text or "").lower()))
    return words.union(*[{w[:n] + "*" for w in words if len(w) > n} for n in STEMS])


class Transducer:
    """Finite-state transducer: arcs[state, symbol] = (next state, symbols written). A symbol without an arc is written
    as it is, and leads to ``rest[state]``. State 0 is the start."""

    def __init__(self, arcs: dict[tuple[int, int], tuple[int, tuple[int, ...]]], rest: list[int]):
        self.arcs, self.rest = arcs, rest

    def step(self, state: int, symbol: int) -> tuple[int, tuple[int, ...]]:
        return self.arcs.get((state, symbol)) or (self.rest[state], (symbol,))

    def __call__(self, symbols: Iterable[int]) -> list[int]:
        state, out = 0, []
        for symbol in symbols:
            state, written = self.step(state, symbol)
            out += written
        return out


def compose(one: Transducer, two: Transducer, alphabet: Iterable[int] = range(12)) -> Transducer:
    """The transducer that writes what ``two`` makes of what ``one`` writes: states are the pairs that can be reached."""
    number, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    alphabet = list(alphabet)
    for pair in todo:
        for symbol in alphabet:
            first, passed = one.step(pair[0], symbol)
            second, out = pair[1], []
            for x in passed:
                second, written = two.step(second, x)
                out += written
            if (first, second) not in number:
                number[first, second] = len(number)
                todo.append((first, second))
            arcs[number[pair], symbol] = (number[first, second], tuple(out))
    return Transducer(arcs, [0] * len(number))


#: Words that a threat, a target, an insult and a negation reach over.
REACH = 4


def _threats() -> Transducer:
    """A threat waits for a target within reach; states count down."""
    arcs = {(k, THREAT): (REACH, (THREAT,)) for k in range(REACH + 1)}
    arcs |= {(k, TARGET): (0, (THREATENED, TARGET)) for k in range(1, REACH + 1)}
    return Transducer(arcs, [max(0, k - 1) for k in range(REACH + 1)])


def _targets() -> Transducer:
    """An insult after a target is direct; one before it is aimed when the target comes. States: words for which a target
    is near, and for which an insult waits."""
    wide = REACH + 1
    state = lambda near, waits: near * wide + waits
    arcs, rest = {}, []
    for near in range(wide):
        for waits in range(wide):
            here, less = state(near, waits), (max(0, near - 1), max(0, waits - 1))
            rest.append(state(*less))
            arcs[here, TARGET] = (state(REACH, 0), (AIMED, TARGET) if waits else (TARGET,))
            arcs[here, INSULT] = (state(less[0], 0), (DIRECT,)) if near else (state(0, REACH), (INSULT,))
    return Transducer(arcs, rest)


def _negations() -> Transducer:
    """A negation turns insults and threats of the next words; a target that comes then aims nothing. States: words
    that it still reaches, and whether the last insult was negated."""
    reach = REACH - 1
    state = lambda left, turned: 2 * left + turned
    arcs, rest = {}, []
    for left in range(reach + 1):
        for turned in (0, 1):
            here, less = state(left, turned), max(0, left - 1)
            rest.append(state(less, turned))
            arcs[here, NEGATION] = (state(reach, turned), (NEGATION,))
            for x in (INSULT, DIRECT, THREAT):
                arcs[here, x] = (state(less, 1), (NEGATED,)) if left else (state(0, 0), (x,))
            for x in (AIMED, THREATENED):
                arcs[here, x] = (here, ()) if turned else (here, (x,))
    return Transducer(arcs, rest)


def _reports() -> Transducer:
    """What follows a reporting verb is reported, to the end of the clause."""
    arcs = {(0, REPORT): (1, (REPORT,)), (1, AIMED): (1, ())}
    arcs |= {(1, x): (1, (REPORTED,)) for x in (INSULT, DIRECT, THREATENED)}
    return Transducer(arcs, [0, 1])


class Lexicon:
    """The first transducer: from words to classes. It has one state; its arcs are words, and stems that words begin with."""

    def __init__(self, insults: Iterable[str], likely: Iterable[str] = ()):
        self.insults, self.likely = frozenset(insults), frozenset(likely)
        stems = lambda words, n: frozenset(w[:-1] for w in words if w[-1] == "*" and len(w) == n + 1)
        self.stems = [(n, kind, some) for kind, words in ((INSULT, self.insults), (LIKELY, self.likely)) for n in STEMS if (some := stems(words, n))]
        lists = ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (LIKELY, self.likely), (THREAT, THREATS), (INSULT, self.insults))
        self.classes = {w: kind for kind, words in lists for w in words}
        self.known: dict[str, int] = {}

    def __call__(self, word: str) -> int:
        kind = self.known.get(word)
        if kind is None:
            kind = self.classes.get(word)
            if kind is None:
                kind = next((kind for n, kind, some in self.stems if len(word) > n and word[:n] in some), OTHER)
            if len(self.known) >= 200_000:
                self.known.clear()
            self.known[word] = kind
        return kind


#: The four transducers of classes as one machine. The lexicon, which is learned, is composed with it word by word.
MACHINE = compose(compose(compose(_threats(), _targets()), _negations()), _reports())
_HOT = frozenset((INSULT, LIKELY, THREAT))


def clauses(text: str) -> Iterator[list[str]]:
    clause: list[str] = []
    for token in TOKEN.findall(text.lower()):
        if token in ".!?;:\n":
            if clause:
                yield clause
            clause = []
        else:
            clause.append(token)
    if clause:
        yield clause


class Grammar:
    """Lexicon, machine and weights."""

    def __init__(self, insults: Iterable[str], likely: Iterable[str] = (), weights: np.ndarray = PRIOR):
        self.lexicon = Lexicon(insults, likely)
        self.weights = weights

    def counts(self, text: str) -> np.ndarray:
        """Of each pattern, the number of matches in a text; at last likely insults in a hundred words (of fifty at least)."""
        out = np.zeros(len(PATTERNS))
        written: Counter = Counter()
        n = 0
        for clause in clauses(text):
            n += len(clause)
            symbols = list(map(self.lexicon, clause))
            if not _HOT.isdisjoint(symbols):
                written.update(MACHINE(symbols))
        out[:6] = (
            written[DIRECT] + written[AIMED], written[INSULT] - written[AIMED], written[THREATENED], written[NEGATED],
            written[REPORTED], written[LIKELY]
        )
        out[6] = 100 * written[LIKELY] / max(50, n)
        return out

    def score(self, text: str | None) -> float:
        z = self.weights[0] + float(self.weights[1:] @ squashed(self.counts(text or "")))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def squashed(counts: np.ndarray) -> np.ndarray:
    """What the weights are for: logarithms of the numbers, and the share as it is."""
    out = np.log1p(counts)
    out[..., 6] = counts[..., 6]
    return out


def fit(x: np.ndarray, y: np.ndarray, pull: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton's method, drawn to PRIOR; weights of patterns stay positive.

    Rows of the rarer class count for more, by the root of the ratio of the classes.
    """
    x = np.c_[np.ones(len(x)), squashed(x)]
    toxic = max(1e-6, min(1 - 1e-6, float(y.mean())))
    much = np.where(y == 1, np.sqrt((1 - toxic) / toxic), 1.0) if toxic < 0.5 else np.where(y == 1, 1.0, np.sqrt(toxic / (1 - toxic)))
    w = PRIOR.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (much * (p - y)) + pull * (w - PRIOR)
        hessian = (x * (much * p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
        w[1:] = np.maximum(w[1:], 0.0)
    return w


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    count: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            count[int(label)].update(features(text))
    words = list(count[1].keys() | count[0].keys())
    for k in range(0, len(words), 20_000):
        some = words[k : k + 20_000]
        yield pd.DataFrame({"word": pd.Series(some, dtype=object), "toxic": [count[1][w] for w in some], "clean": [count[0][w] for w in some]})


def least_gain(toxic: int) -> float:
    """What a word must explain at least to be taken: rows, of so many toxic ones."""
    return max(2.5, 0.015 * toxic)


def lexicon(words: list[str], clean: np.ndarray, sets: list[tuple[np.ndarray, int]], total: tuple[int, int], strict: float = STRICT) -> list[str]:
    """Greedy cover of toxic rows. words: candidates; clean: clean rows that hold each; sets: for each distinct set of
    candidates in a toxic row, their places in ``words`` and the number of such rows; total: rows of each label.
    It ends by itself: each candidate takes the part 1 - FADE of 1.5 % of the toxic rows' count at least.

    Each candidate that explains a row lessens what the row still counts for, so stems go before their inflections,
    and words that merely belong to copied documents find those explained.
    """
    has: list[list[int]] = [[] for _ in words]
    for k, (places, _) in enumerate(sets):
        for w in places.tolist():
            has[w].append(k)
    left = np.array([float(n) for _, n in sets])
    gain = np.zeros(len(words))
    for places, n in sets:
        gain[places] += n
    loss = strict * clean * total[1] / max(1, total[0])
    open_ = np.ones(len(words), dtype=bool)
    least = least_gain(total[1])
    taken: list[str] = []
    while open_.any():
        net = np.where(open_, gain - loss, -np.inf)
        # sums of equal rows may differ in their last digits
        top = max(np.flatnonzero(net >= net.max() - 1e-9).tolist(), key=lambda w: (len(words[w]), words[w]))
        if net[top] < least - 1e-9:
            break
        word, mine = words[top], set(has[top])
        taken.append(word)
        left[has[top]] *= FADE
        for k in has[top]:
            gain[sets[k][0]] -= left[k] * (1 / FADE - 1)
        stem = word.rstrip("*")
        for w in np.flatnonzero(open_).tolist():
            other = words[w].rstrip("*")
            if w == top or (other.startswith(stem) or stem.startswith(other)) and mine.issuperset(has[w]):
                open_[w] = False  # it would add nothing
    return taken


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = SAMPLE) -> Grammar:
    """Grammar from at most ``limit`` labelled rows of each class; the general one where a class has none.

    Null and empty texts have no words; rows that repeat an id are rows of their own; other columns are not read.
    """
    rows = sample(docs, labels, label_col, id_col, text_col, limit)
    words = rows.mapInPandas(_word_counts, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = (totals.get(0, 0), totals.get(1, 0))
    if not all(total):
        return Grammar(INSULTS)
    # what explains a word's toxic rows only lessens, so one that starts below the least gain is never taken
    net = F.col("toxic") - F.lit(LOOSE * total[1] / total[0]) * F.col("clean")
    found = words.filter(net >= least_gain(total[1]) - 1e-6).orderBy("word").toPandas()
    place = {w: k for k, w in enumerate(found["word"])}

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            some = [np.array(sorted(place[w] for w in features(t) if w in place), dtype="<i4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"places": pd.Series(some, dtype=object)})

    # of the toxic rows alone, each distinct set once: 4 bytes for each candidate in it
    sets = rows.filter("label = 1").select("text").mapInPandas(present, "places binary").groupBy("places").agg(F.count("*").alias("n")).orderBy("places").collect()
    have = [(np.frombuffer(r["places"], dtype="<i4"), r["n"]) for r in sets]
    known, clean = found["word"].tolist(), found["clean"].to_numpy(dtype=float)
    insults = lexicon(known, clean, have, total)
    likely = [w for w in lexicon(known, clean, have, total, LOOSE) if w not in insults]
    grammar = Grammar(INSULTS.union(insults), likely)

    def matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "counts": [grammar.counts(t or "").tolist() for t in batch["text"]]})

    pairs = rows.mapInPandas(matched, "label int, counts array<double>").collect()
    grammar.weights = fit(np.array([r["counts"] for r in pairs]), np.array([r["label"] for r in pairs], dtype=float))
    return grammar


def score_toxicity(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text", at: float = 0.7) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Null and empty texts match nothing; null ids count as held out.

    Equal texts score alike, rows that repeat each get a row, an empty table gives none, texts of any length are read
    whole, and other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            score = np.array([grammar.score(t) for t in batch["text"]], dtype=float)
            yield batch[["doc_id", "held_out"]].assign(score=score, predicted=(score >= at).astype("int32"))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """All documents, with a grammar learned from labels.toxic."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
