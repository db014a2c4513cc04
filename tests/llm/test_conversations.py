"""Conversation repair, importance resampling and chat formatting against plain versions, and on awkward rows."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpustide.llm import chat_format, conversation_repair, queries, resampling

SF = "/root/testdata/sf0.001"
ROLES = {"s": "system", "u": "user", "a": "assistant"}


# -- plain versions


def cheapest(kinds):
    """(cost, audit) by enumeration of states with a heap: kinds are (initial, must, truncated)."""
    heap, seen = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(kinds) and state in (0, 3):
            return cost, audit
        to = {"u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "s": {0: 1}}
        for role in "ua":
            if state in to[role]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, to[role][state]))
        if i < len(kinds):
            initial, must, truncated = kinds[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state))
            if not must:
                for role in {"u", "a", initial}:
                    if state in to.get(role, {}):
                        heapq.heappush(heap, (cost + 5 * truncated + (role != initial), audit + ("K" if role == initial else "R"), i + 1, to[role][state]))
    raise AssertionError("no way through")


def repaired(rows):
    """Report and lines of one conversation: rows (turn, role, text), nulls in any."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    seen, kinds, tally = set(), [], Counter()
    for _, role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
        seen.add((role, text))
        tally[fault] += 1
        kinds.append((role[:1] or "-", fault in ("blank", "duplicate"), fault == "truncated"))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
    cost, audit = cheapest(kinds)
    out, i, last = [], 0, None
    for e in audit:
        role, text = (rows[i][1], rows[i][2]) if e in "KR" else (None, "")
        i += e != "I"
        if e == "D":
            continue
        role = role if e == "K" else "assistant" if last == "u" else "user"
        last = role[0]
        out.append(f"{role}:{text}")
    return (gaps, tally["blank"], tally["duplicate"], tally["truncated"], illegal, cost, audit), out


def damage(rows):
    out, dropped = defaultdict(list), {r[0] for r in rows}
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        for _ in range(0 if fault == 0 else 2 if fault == 3 else 1):
            out[conv].append((turn, "user" if fault == 4 else role, text))
    return out, dropped


def importance(docs, target, orders=1, buckets=10000, percent=10, least=20, seed="2024"):
    def grams(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(resampling._UPPER, resampling._LOWER)))
        return len(words), [" ".join(words[i : i + k]) for k in range(1, orders + 1) for i in range(len(words) - k + 1)]

    def bucket(g):
        return zlib.crc32(g.encode()) % buckets

    s, t = (Counter(bucket(g) for x in texts for g in grams(x)[1]) for texts in ([d[1] for d in docs], target))
    big, goal = sum(s.values()), sum(t.values())
    out = []
    for doc, text in docs:
        n, gs = grams(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big + buckets) / ((s[b] + 1) * (goal + buckets)))) for b in map(bucket, gs))
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def _sorted(rows):
    return sorted((tuple(r) for r in rows), key=str)


# -- op11


def test_op11(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    kept, everyone = damage(rows)
    want = []
    for conv in everyone:
        report, lines = repaired(kept[conv]) if conv in kept else ((0,) * 6 + ("",), [])
        want.append((conv, *report, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    assert _sorted(queries.QUERIES["op11_conversation_repair"](spark, SF).collect()) == _sorted(want)


@pytest.fixture(scope="module")
def odd_chats():
    rng, rows = random.Random(5), []
    says = ["Yes.", "No", "", " \t\n", "Yes.", "a\\b!", "é?", "long " * 3000 + ".", None, "x. "]
    for conv in [1, 2, 3, None, *range(10, 40)]:
        for _ in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 5, -4]), rng.choice(["user", "assistant", "system", None, "", "u", "tool", "User"]), rng.choice(says)))
    rows += [(50, 1, "user", "Same.")] * 700 + [(51, None, None, None)] + [(52, 1, "", "x.")]
    return rows


NAMES = "conv_id long, turn int, role string, text string"


def _clashing(df):
    for name in ("conv", "at", "nth", "n", "first", "kind", "node", "parts", "digest", "hash", "place", "uid", "doc", "bucket", "gram", "weight", "written", "a.b", "fault"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def test_op11_odd_rows(spark, odd_chats):
    report, turns = conversation_repair.repair(_clashing(spark.createDataFrame(odd_chats, NAMES)))
    by = defaultdict(list)
    for conv, *rest in odd_chats:
        by[conv].append(tuple(rest))
    said = defaultdict(list)
    for r in turns.collect():
        said[r["conv_id"]].append((r["at"], r["nth"], f"{r['role']}:{r['text']}"))
    got = {r[0]: tuple(r)[1:] for r in report.collect()}
    assert set(got) == set(by)
    for conv, rows in by.items():
        want, lines = repaired(rows)
        assert got[conv] == want and [x[2] for x in sorted(said[conv])] == lines
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    digests = {r["conv"]: r["digest"] for r in conversation_repair.digests(turns).collect()}
    lines = {k: repaired(rows)[1] for k, rows in by.items()}
    assert digests == {"" if k is None else f"={k}": hashlib.sha256("\n".join(x).encode()).hexdigest() for k, x in lines.items() if x}
    empty = conversation_repair.repair(spark.createDataFrame([], NAMES))
    assert [x.count() for x in empty] == [0, 0]


def test_op11_long_conversation(spark, monkeypatch):
    """A conversation of many stretches, in several partitions, comes out as if folded at once."""
    rng = random.Random(8)
    rows = [(7, k, rng.choice(list(ROLES.values())), rng.choice(["a.", "b", f"t{k}.", f"t{k}", ""])) for k in range(3000)]
    rows += [(8, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(600)]
    monkeypatch.setattr(conversation_repair, "FAN", 16)
    report, turns = conversation_repair.repair(spark.createDataFrame(rows, NAMES).repartition(5))
    got = {r[0]: tuple(r)[1:] for r in report.collect()}
    lines = [r["line"] for r in turns.filter("conv_id = 7").orderBy("at", "nth").select(F.concat("role", F.lit(":"), "text").alias("line")).collect()]
    want, said = repaired([r[1:] for r in rows if r[0] == 7])
    assert got[7] == want and lines == said
    assert got[8] == (0, 0, 0, 0, 0, 0, "K" * 600)


def test_op11_product():
    """The product is associative on what turns make, and powers are repeated products."""
    turns, rng = list(conversation_repair.TURNS.values()), random.Random(3)
    for _ in range(60):
        x, y, z = (rng.choice(turns) for _ in range(3))
        assert conversation_repair.times(conversation_repair.times(x, y), z) == conversation_repair.times(x, conversation_repair.times(y, z))
    for kinds in itertools.product(["u", "a~", "s", "-!", "-"], repeat=4):
        m = conversation_repair.one()
        for k in kinds:
            m = conversation_repair.times(m, conversation_repair.TURNS[k])
        assert conversation_repair.best_of(m) == cheapest([(k[0], "!" in k, "~" in k) for k in kinds])
    assert conversation_repair.power(turns[4], 5) == conversation_repair.times(conversation_repair.power(turns[4], 2), conversation_repair.power(turns[4], 3))


# -- op12


def test_op12(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    assert _sorted(queries.QUERIES["op12_resampling"](spark, SF).collect()) == _sorted(importance(docs, target))


ODD = [(1, "Ab c"), (2, None), (3, ""), (4, " \n"), (5, "É é x1 ! " * 40), (5, "É é x1 ! " * 40), (None, "w " * 30), (None, None), (6, "z"), (7, "a b " * 9000), *[(k, f"a{k % 3} b c d{k} " * 8) for k in range(20, 60)]]


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_op12_odd_rows(spark, monkeypatch, orders):
    """Runs of several words, across the stretches that windows are cut into."""
    monkeypatch.setattr(resampling, "STRETCH", 5)
    target = ["a b c", None, "", "d21 É é"]
    docs = _clashing(spark.createDataFrame(ODD, "doc_id long, text string"))
    goal = _clashing(spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id int, text string"))
    out = resampling.resample(docs, goal, orders=orders, buckets=500, percent=30, least_words=4)
    want = importance(ODD, target, orders, 500, 30, 4)
    assert _sorted(out.select("doc_id", "n_features", "weight", "score", "rank").collect()) == _sorted(want)
    drawn = resampling.drawn_documents(docs, goal, orders=orders, buckets=500, percent=30, least_words=4)
    assert drawn.columns == docs.columns
    assert {r["doc_id"] for r in drawn.collect()} == {w[0] for w in want if w[4]}


def test_op12_empty(spark):
    docs, none = spark.createDataFrame(ODD, "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(none, docs).count() == 0
    assert _sorted(resampling.resample(docs, none).drop("hash").collect()) == _sorted(importance(ODD, []))
    with pytest.raises(ValueError):
        resampling.gains(docs, docs, buckets=1 << 30)


# -- op13


def _told(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_op13(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
    by = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: r[:2]):
        by[conv].append((role, text or ""))
    got = {r["conv_id"]: r for r in queries.QUERIES["op13_chat_format"](spark, SF).collect()}
    assert set(got) == set(by)
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (len(turns), _told(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def _parsed(formatted):
    """Turns by a scan over characters: another reading of the grammar."""
    turns, at = [], 0
    while at < len(formatted):
        assert formatted.startswith("### ", at)
        colon = formatted.index(": ", at + 4)
        role = formatted[at + 4 : colon]
        for char, code in reversed(chat_format.CODES):
            role = role.replace(code, char)
        at, text, slashes = colon + 2, "", 0
        while True:
            control = next((c for c in ("### ", "</turn>") if formatted.startswith(c, at)), None)
            if control and not slashes:
                assert control == "</turn>" and text.endswith("\n") and formatted.startswith("</turn>\n", at)
                turns.append((role, text[:-1]))
                at += len("</turn>\n")
                break
            if control:
                text, at, slashes = text[:-1] + control, at + len(control), 0
                continue
            slashes = slashes + 1 if formatted[at] == "\\" else 0
            text, at = text + formatted[at], at + 1
    return turns


def test_op13_odd_rows(spark):
    bits = ["### ", "</turn>", "</turn>\n", "\\", "\\\\", ": ", "\n", "user", "Assistant", "#", "</turn", " ", "%25", "\U0001f600", "###"]
    rng, rows = random.Random(11), []
    for conv in range(150):
        for turn in range(rng.randint(1, 5)):
            role = rng.choice(["user", "assistant", "system", None, "", "".join(rng.choices(bits, k=3))])
            rows.append((conv, turn, role, rng.choice([None, "", "".join(rng.choices(bits, k=rng.randint(1, 9)))])))
    rows += [(None, None, "assistant", "x"), (None, 3, "user", "y"), (900, 1, "assistant", "same"), (900, 1, "assistant", "same"), (901, 0, "assistant", "### " * 20000)]
    chats = chat_format.format_chats(_clashing(spark.createDataFrame(rows, NAMES)))
    by = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        by[conv].append((role or "", text or ""))
    back = {r["conv_id"]: r for r in chat_format.read_back(chats).collect()}
    assert set(back) == set(by)
    for conv, turns in by.items():
        r = back[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == turns
        if conv != 901:
            assert _parsed(r["formatted"]) == turns
        assert r["loss"] == [t for role, t in turns if role == "assistant"] and len(r["loss_spans"]) == len(r["loss"])
        for span, text in zip(r["loss_spans"], r["loss"]):
            written = r["formatted"][span["start"] : span["stop"]]
            assert r["formatted"][span["stop"] :].startswith("\n</turn>\n") and re.sub(r"\\(\\*(?:### |</turn>))", r"\1", written) == text
    assert chat_format.format_chats(spark.createDataFrame([], NAMES)).count() == 0


def test_op13_clean_text_stays(spark):
    """What holds nothing to escape is written as it stands; a tampered output is not read back."""
    df = spark.createDataFrame([(1, 0, "user", "a \\ b: c\n"), (1, 1, "assistant", "### x")], NAMES)
    chats = chat_format.format_chats(df)
    assert chats.first()["formatted"] == "### user: a \\ b: c\n\n</turn>\n### assistant: \\### x\n</turn>\n"
    bad = chats.withColumn("formatted", F.replace("formatted", F.lit("\\###"), F.lit("\\\\###")))
    with pytest.raises(Exception, match="not read back"):
        chat_format.read_back(bad).collect()
