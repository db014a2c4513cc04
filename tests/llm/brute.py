"""Plain versions of the operators' contracts, for small inputs."""

import hashlib
import re
from collections import defaultdict

SPACE = re.compile(rb"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split((text or "").encode("utf-8", "surrogatepass")) if w]


def substring_dedup(docs, window=50):
    """docs: list of (id, text). Rows (id, n_words, n_removed, sha256)."""
    first = {}
    for i, text in docs:
        w = words(text)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None and (key not in first or i < first[key]):
                first[key] = i
    out = []
    for i, text in docs:
        w = words(text)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def grams(text, n):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def jaccard(docs, n, num, den):
    """docs: list of (id, text) with distinct ids. Rows (id, set size, component, links)."""
    sets = {i: grams(t, n) for i, t in docs}
    index = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            index[g].add(i)
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = defaultdict(int)
    for i, s in sets.items():
        both = defaultdict(int)
        for g in s:
            for j in index[g]:
                both[j] += 1
        for j, c in both.items():
            if j > i and den * c >= num * (len(s) + len(sets[j]) - c):
                a, b = root(i), root(j)
                links[i] += 1
                links[j] += 1
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), root(i), links[i]) for i, s in sets.items()]


BASE = [
    ("assign", re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 1, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
]


def secrets(text):
    """(n_assign, n_access, n_hex, sha256 of the base spans)."""
    spans, counts = [], []
    for k, (_, pattern, group, least) in enumerate(BASE):
        found = [m for m in pattern.finditer(text or "") if len(m.group(group)) >= least]
        counts.append(len(found))
        spans += [(m.start(), k, m.end()) for m in found]
    said = ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*counts, hashlib.sha256(said.encode()).hexdigest())


def indel(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] if x == y else 1 + min(before[j], row[j - 1])
    return row[-1]


def aimed(clause, insult, target, reach):
    """(insults with a target, those without): one within reach before it, or the first to come within reach if no other insult comes between."""
    with_, without = 0, 0
    for k, x in enumerate(clause):
        if x != insult:
            continue
        before = target in clause[max(0, k - reach) : k]
        after = clause[k + 1 : k + 1 + reach]
        upto = after[: after.index(target)] if target in after else None
        if before or upto is not None and insult not in upto:
            with_ += 1
        else:
            without += 1
    return with_, without


def threatened(clause, threat, target, reach):
    """Targets that a threat within reach meets first."""
    found = 0
    for k, x in enumerate(clause):
        since = clause[:k]
        while target in since:
            since = since[since.index(target) + 1 :]
        found += x == target and threat in since[-reach:]
    return found


def negated_reported(clause, insult, negation, report, reach):
    """Insults that a negation reaches, and the others after a reporting verb. An insult ends what does not reach it."""
    negated = reported = 0
    for k, x in enumerate(clause):
        if x == insult:
            if negation in clause[max(0, k - reach) : k]:
                negated += 1
            elif report in clause[:k]:
                reported += 1
    return negated, reported


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _chunk_letter(data):
    value = 0
    for k, x in enumerate(data):
        value += (x + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64)
    value &= (1 << 64) - 1
    value ^= value >> 31
    value = value * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
    value ^= value >> 29
    return LETTERS[value >> 58]


def fingerprint(text):
    """Block size, letters, letters at twice the block size: chunks end where the hash of the last seven bytes says so."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return "3::"
    size = 3
    while size * 64 < len(data):
        size *= 2
    marks = []
    for i in range(len(data)):
        h = 0
        for j in range(min(7, i + 1)):
            h += (data[i - j] + 1) * pow(0x2C1B3C6D, j, 1 << 32)
        h &= 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x297A2D39 & 0xFFFFFFFF
        marks.append(h ^ h >> 16)
    while size > 3 and sum(h % size == size - 1 for h in marks) < 32:
        size //= 2

    def letters(block, most):
        out, at = "", 0
        for i, h in enumerate(marks):
            if h % block == block - 1 and len(out) < most - 1:
                out += _chunk_letter(data[at : i + 1])
                at = i + 1
        return out + _chunk_letter(data[at:]) if at < len(data) else out

    return f"{size}:{letters(size, 64)}:{letters(2 * size, 32)}"


def likeness(one, two):
    if one == two:
        return 1.0
    (x, *a), (y, *b) = one.split(":"), two.split(":")

    def of(p, q):
        if p == q:
            return 1.0
        if not p or not q:
            return 0.0
        n = min(7, max(1, min(len(p), len(q)) // 3))
        if not {p[k : k + n] for k in range(len(p) - n + 1)} & {q[k : k + n] for k in range(len(q) - n + 1)}:
            return 0.0
        return 1 - indel(p, q) / (len(p) + len(q))

    x, y = int(x), int(y)
    return max(of(a[0], b[0]), of(a[1], b[1])) if x == y else of(a[0], b[1]) if x == 2 * y else of(a[1], b[0]) if y == 2 * x else 0.0


def statistics(text):
    """The quality statistics of a text, character by character."""
    import math

    data = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(data))
    sizes = [len(w) for w in words(text)] or [0]
    mean = sum(sizes) / len(sizes)
    spread = math.sqrt(sum((x - mean) ** 2 for x in sizes) / len(sizes))
    sentence = set(b".,;:!?'\"-()")
    upper = sum(65 <= c <= 90 for c in data)
    digits = sum(48 <= c <= 57 for c in data)
    marks = [c in sentence or 33 <= c <= 126 and not chr(c).isalnum() for c in data]
    entropy = -sum(k / n * math.log2(k / n) for c in set(data) if (k := data.count(c)))
    lines = data.split(b"\n")

    def logit(x):
        return math.log((x + 0.001) / (1.001 - x))

    own = words(text)
    return [
        math.log1p(len(own)), math.log1p(mean), math.log1p(spread), logit(len(set(own)) / max(1, len(own))), logit(upper / n), logit(digits / n), logit(sum(c in sentence for c in data) / n),
        logit(sum(m and c not in sentence for m, c in zip(marks, data)) / n), logit(data.count(10) / n), logit(len(set(lines)) / len(lines)), entropy, logit(sum(x <= 3 for x in sizes) / len(sizes)), logit(sum(a and b for a, b in zip(marks, marks[1:])) / n),
    ]


def discriminant(x, y, to_pooled, to_sphere, prior):
    """Posterior of class 1 for two Gaussians with shrunk covariances, by inverse and determinant."""
    import numpy as np

    z = (x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6)
    own = [np.cov(z[y == k].T, bias=True) for k in (0, 1)]
    pooled = sum(own[k] * (y == k).sum() for k in (0, 1)) / len(y)
    log = []
    for k in (0, 1):
        s = (1 - to_pooled) * own[k] + to_pooled * pooled
        s = (1 - to_sphere) * s + to_sphere * np.trace(s) / len(s) * np.eye(len(s))
        d = z - z[y == k].mean(axis=0)
        log.append(np.log((1 - prior, prior)[k]) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    return 1 / (1 + np.exp(np.clip(log[0] - log[1], -40, 40)))
