"""Repair of conversation structure by a min-plus matrix scan.

What may stand after another turn is an automaton of four states: nothing yet, after a system, a user, or an assistant
turn. Each turn is a 4x4 matrix whose entry (p, q) is the cheapest way to take it from state p to state q, as (cost,
audit): the audit has the initials of the edits, D(elete), K(eep), R(erole), I(nsert). The closure of insertions is
multiplied in front of each. The product takes for min the smaller pair and for plus the sum of costs with the audits
joined. It is associative: of two equal costs over the same turns neither audit is the start of the other (what it
had more would be insertions, which cost), so what comes after cannot change which is less.

Turns are numbered in order, each task its own range; stretches of them are folded, then groups of stretches, and so
on, until each conversation has one matrix: the tree goes over conversations that fill many partitions as over short
ones. Its best entry's audit is handed down the same tree, each node giving its parts theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, numbered, releasing, stored

#: Costs, and how many nodes of the tree are folded at once.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FAN = 256
#: States, and where a turn of each initial leads from where.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
LEADS = {"s": ((NOTHING, SYSTEM),), "u": ((NOTHING, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
ENDS = (NOTHING, ASSISTANT)
FITTING = ("su", "ua", "au")

Matrix = list  # 16 entries (cost, audit) or None, row by row


def one() -> Matrix:
    return [(0, "") if p == q else None for p in range(4) for q in range(4)]


def add(m: Matrix, p: int, q: int, entry: tuple[int, str]) -> None:
    if m[4 * p + q] is None or entry < m[4 * p + q]:
        m[4 * p + q] = entry


def times(x: Matrix, y: Matrix) -> Matrix:
    out: Matrix = [None] * 16
    for i in range(0, 16, 4):
        for k in range(4):
            a = x[i + k]
            if a is None:
                continue
            for j in range(4):
                b = y[4 * k + j]
                if b is None:
                    continue
                cost, best = a[0] + b[0], out[i + j]
                if best is None or cost < best[0]:
                    out[i + j] = (cost, a[1] + b[1])
                elif cost == best[0]:
                    audit = a[1] + b[1]
                    if audit < best[1]:
                        out[i + j] = (cost, audit)
    return out


def power(x: Matrix, n: int) -> Matrix:
    out = None
    while n:
        if n & 1:
            out = x if out is None else times(out, x)
        x, n = (times(x, x) if n > 1 else x), n >> 1
    return out or one()


def _closure() -> Matrix:
    """Any number of insertions; two lead from any state to any that can be reached at all."""
    m = one()
    for role in "ua":
        for p, q in LEADS[role]:
            add(m, p, q, (INSERT, "I"))
    return times(m, m)


CLOSURE = _closure()


def _turn(initial: str, must: bool, truncated: bool) -> Matrix:
    """Insertions, then one turn."""
    m: Matrix = [None] * 16
    for p in range(4):
        add(m, p, p, (DELETE, "D"))
    if not must:
        more = TRUNCATED if truncated else 0
        for p, q in LEADS.get(initial, ()):
            add(m, p, q, (KEEP + more, "K"))
        for role in "ua":
            for p, q in LEADS[role]:
                add(m, p, q, (REROLE + more, "R"))
    return times(CLOSURE, m)


#: By what a turn is: its initial (- for any other), ! where it must go, and ~ where it is truncated.
TURNS = {i + f: _turn(i, f == "!", f == "~") for i in "sua-" for f in ("", "!", "~")}
REPEATS = TURNS["-!"]

_ENTRY = pyarrow.struct([("cost", pyarrow.int64()), ("audit", pyarrow.string())])
_NODE = pyarrow.schema([
    ("conv", pyarrow.string()), ("node", pyarrow.int64()), ("n", pyarrow.int64()), ("illegal", pyarrow.int64()), ("head", pyarrow.string()), ("tail", pyarrow.string()),
    ("m", pyarrow.list_(_ENTRY)), ("parts", pyarrow.list_(pyarrow.struct([("node", pyarrow.int64()), ("n", pyarrow.int64())]))),
])
_ENTRY_DDL = "struct<cost: bigint, audit: string>"
NODE = f"conv string, node bigint, n bigint, illegal bigint, head string, tail string, m array<{_ENTRY_DDL}>, parts array<struct<node: bigint, n: bigint>>"
PART = "conv string, node bigint, audit string, outs bigint"
EDIT = "conv string, at bigint, nth bigint, edit string, role string, turn string, kept string, digest string"


def _join(parts: list[dict]) -> dict:
    """Neighbours in order, as one: turns, pairs that do not fit, outer initials, matrix."""
    out = dict(parts[0])
    for p in parts[1:]:
        out["n"] += p["n"]
        out["illegal"] += p["illegal"] + (out["tail"] + p["head"] not in FITTING)
        out["tail"], out["m"] = p["tail"], times(out["m"], p["m"])
    return out


def _leaf(item: dict) -> dict:
    """Equal rows of one turn: the first as it is, the others to be deleted."""
    initial, n = item["kind"][0], item["n"]
    m = TURNS[item["kind"]]
    return {"n": n, "illegal": n - 1, "head": initial, "tail": initial, "m": times(m, power(REPEATS, n - 1)) if n > 1 else m}


def _folded(leaves: bool):
    def run(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                parts = row["parts"]
                if leaves:
                    whole = _join([_leaf(p) for p in parts])
                    whole["parts"] = None
                else:
                    for p in parts:
                        p["m"] = [e and (e["cost"], e["audit"]) for e in p["m"]]
                    whole = _join(parts)
                    whole["parts"] = [{"node": p["node"], "n": p["n"]} for p in parts]
                whole["m"] = [e and {"cost": e[0], "audit": e[1]} for e in whole["m"]]
                out.append(whole | {"conv": row["conv"], "node": row["node"]})
            yield pyarrow.RecordBatch.from_pylist(out, schema=_NODE)

    return releasing(run)


def best_of(m: Matrix) -> tuple[int, str]:
    """The cheapest way from nothing to a whole conversation, insertions at its end included."""
    whole = times(m, CLOSURE)
    return min(whole[4 * NOTHING + q] for q in ENDS if whole[4 * NOTHING + q] is not None)


def _best(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
    schema = pyarrow.schema([("conv", pyarrow.string()), ("node", pyarrow.int64()), ("cost", pyarrow.int64()), ("audit", pyarrow.string())])
    for batch in batches:
        found = [best_of([e and (e["cost"], e["audit"]) for e in m]) for m in batch.column("m").to_pylist()]
        costs, audits = pyarrow.array([f[0] for f in found], pyarrow.int64()), pyarrow.array([f[1] for f in found], pyarrow.string())
        yield pyarrow.RecordBatch.from_arrays([batch.column("conv"), batch.column("node"), costs, audits], schema=schema)


def _cut(audit: str, sizes: list[int]) -> list[str]:
    """An audit as its parts' audits: insertions go with the turn after them, those at the end with the last."""
    out, at = [], 0
    for k, n in enumerate(sizes):
        begin = at
        if k == len(sizes) - 1:
            at = len(audit)
        while n and at < len(audit):
            n -= audit[at] != "I"
            at += 1
        out.append(audit[begin:at])
    return out


def _handed(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            outs = row["outs"]
            for part, audit in zip(row["parts"], _cut(row["audit"], [p["n"] for p in row["parts"]])):
                out.append({"conv": row["conv"], "node": part["node"], "audit": audit, "outs": outs})
                outs += len(audit) - audit.count("D")
        yield pyarrow.RecordBatch.from_pylist(out, schema=pyarrow.schema([("conv", pyarrow.string()), ("node", pyarrow.int64()), ("audit", pyarrow.string()), ("outs", pyarrow.int64())]))


def _edits(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
    """A row for each turn of the result: where it stands, its edit, its new role (null: kept), and what its text is found by."""
    schema = pyarrow.schema([(n, pyarrow.int64() if k == "bigint" else pyarrow.string()) for n, k in (x.split() for x in EDIT.split(", "))])
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            outs, items = row["outs"], row["parts"]
            for item, audit in zip(items, _cut(row["audit"], [i["n"] for i in items])):
                for nth, edit in enumerate(audit):
                    if edit == "D":
                        continue
                    # outs counts from 1 where a conversation keeps a system turn, so that users stand at even places
                    role = None if edit == "K" else ("user", "assistant")[outs % 2]
                    new = {"conv": row["conv"], "at": item["at"], "nth": nth, "edit": edit, "role": role}
                    out.append(new | ({} if edit == "I" else {"turn": item["turn"], "kept": item["role"], "digest": item["digest"]}))
                    outs += 1
        yield pyarrow.RecordBatch.from_pylist(out, schema=schema)


def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("-"))


def _key(col: Column) -> Column:
    """A text for a value, and an empty one for a null."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def _rows(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = F.coalesce(named(role_col), F.lit(" ")), F.coalesce(named(text_col), F.lit(" "))
    return conversations.select(
        _key(named(conv_col)).alias("conv"), named(turn_col).cast("long").alias("turn"), role.alias("role"), F.sha2(text, 256).alias("digest"), text.alias("text")
    )


def faults(rows: DataFrame) -> DataFrame:
    """Equal rows as one: conv, turn, role, digest, n, and flags blank, cut (truncated), first (no earlier one says the same)."""
    text, seen = F.col("text"), r"[^\x20\x09-\x0D]"
    blank = ~text.rlike(seen)
    cut = ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z") & ~blank
    once = rows.select("conv", "turn", "role", "digest", blank.alias("blank"), cut.alias("cut")).groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count("*").alias("n"))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    firsts = once.groupBy("conv", "role", "digest").agg(F.min(place).alias("earliest"))
    return once.join(firsts, ["conv", "role", "digest"]).withColumn("first", F.col("earliest") == place).drop("earliest")


def repair(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Two tables: a report of each conversation, and the turns of the repaired ones.

    Report: conv_id, gaps (turn numbers that are missing between the smallest and the largest), blank, duplicate,
    truncated (each row by its first fault), illegal (neighbours whose initials are not su, ua or au), cost, audit.
    Turns: conv_id, at and nth (their order), edit (K, R, I), role, text.

    The result's initials are ``(s?(ua)+)?``. Keeping a turn costs 0, another role 1, deleting it 2 (which blank and
    duplicate turns need), inserting an empty one 5, and a truncated turn that stays 5 more; of equal costs the audit that
    is least in ASCII is taken. Rows go by turn, nulls first; rows of one turn by role, then by the digest of their text;
    rows that repeat are duplicates after the first. Null roles and texts are one space; rows without a conversation
    are one, with a null id; an empty role has no initial, so it is never kept. A conversation whose turns are all deleted
    has no rows in the second table; an empty table gives none in either. Other columns are not read.

    A conversation's audit is one value, so it is held in memory whole, some eleven times while the tree's top is folded.
    """
    rows = _rows(conversations, conv_col, turn_col, role_col, text_col)
    known = stored(faults(rows), "faults")
    # the rest of a conversation's tallies need no order
    count = lambda when, n: F.sum(F.when(when, n).otherwise(0))
    dup = ~F.col("blank")
    tallies = known.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"), count(F.col("blank"), F.col("n")).alias("blank"),
        count(dup, F.col("n") - F.col("first").cast("long")).alias("duplicate"), count(F.col("cut") & F.col("first"), F.lit(1)).alias("truncated")
    )
    flag = F.when(F.col("blank") | ~F.col("first"), "!").when(F.col("cut"), "~").otherwise("")
    placed = numbered(
        known.select("conv", "turn", "role", "digest", "n", F.concat(_initial(F.col("role")), flag).alias("kind")), "turns", [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    )
    item = F.struct("at", "n", "kind", F.col("turn").cast("string").alias("turn"), "role", "digest")
    blocks = stored(placed.withColumn("node", F.floor(F.col("at") / FAN)).groupBy("conv", "node").agg(F.array_sort(F.collect_list(item)).alias("parts")), "blocks")
    levels = [stored(blocks.mapInArrow(_folded(True), NODE), "fold")]
    while not levels[-1].groupBy("conv").count().filter("count > 1").isEmpty():
        # at most FAN parts in a group
        part = F.struct(*[c for c in levels[-1].columns if c not in ("conv", "parts")])
        above = levels[-1].withColumn("up", F.floor(F.col("node") / FAN)).groupBy("conv", F.col("up").alias("node")).agg(F.array_sort(F.collect_list(part)).alias("parts"))
        levels.append(stored(above.mapInArrow(_folded(False), NODE), "fold"))
    best = stored(levels[-1].mapInArrow(_best, "conv string, node bigint, cost bigint, audit string"), "best")
    # the number of turns kept is odd where the first of them is a system turn
    odd = F.char_length(F.replace("audit", F.lit("D"), F.lit(""))) % 2
    handed = best.select("conv", "node", "audit", odd.cast("long").alias("outs"))
    for level in reversed(levels[1:]):
        handed = stored(level.select("conv", "node", "parts").join(handed, ["conv", "node"]).mapInArrow(releasing(_handed), PART), "handed")
    edits = blocks.join(handed, ["conv", "node"]).mapInArrow(releasing(_edits), EDIT)

    texts = rows.groupBy("conv", F.col("turn").cast("string").alias("turn"), F.col("role").alias("kept"), "digest").agg(F.first("text").alias("text"))
    kept = edits.filter("edit <> 'I'").join(texts, [edits["conv"] == texts["conv"], edits["turn"].eqNullSafe(texts["turn"]), edits["kept"] == texts["kept"], edits["digest"] == texts["digest"]])
    kept = kept.select(edits["conv"], "at", "nth", "edit", F.coalesce("role", edits["kept"]).alias("role"), "text")
    turns = kept.unionByName(edits.filter("edit = 'I'").select("conv", "at", "nth", "edit", "role", F.lit("").alias("text")))
    report = tallies.join(levels[-1].select("conv", "illegal"), "conv").join(best.drop("node"), "conv")
    kind = conversations.select(named(conv_col)).schema[0].dataType
    back = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(kind).alias("conv_id")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (
        report.select(back, *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], "audit"),
        turns.select(back, "at", "nth", "edit", "role", "text")
    )


def _digests(batches: Iterator[pyarrow.RecordBatch]) -> Iterator[pyarrow.RecordBatch]:
    """SHA-256 of each conversation's lines, read as they come in order: one row for each, nothing is held whole."""
    import hashlib

    schema = pyarrow.schema([("conv", pyarrow.string()), ("digest", pyarrow.string())])
    conv = state = None
    for batch in batches:
        out = []
        for c, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist()):
            if state is None or c != conv:
                if state is not None:
                    out.append({"conv": conv, "digest": state.hexdigest()})
                conv, state = c, hashlib.sha256()
            else:
                state.update(b"\n")
            state.update(line.encode())
        yield pyarrow.RecordBatch.from_pylist(out, schema=schema)
    if state is not None:
        yield pyarrow.RecordBatch.from_pylist([{"conv": conv, "digest": state.hexdigest()}], schema=schema)


def digests(turns: DataFrame) -> DataFrame:
    """conv (a key of the id), digest: SHA-256 of ``role:text`` of all turns in order, one to a line. A digest has to be taken from
    the first turn to the last, so a conversation's turns stream through one task, sorted."""
    lines = turns.select(_key(F.col("conv_id")).alias("conv"), "at", "nth", F.concat("role", F.lit(":"), "text").alias("line"))
    return lines.repartition("conv").sortWithinPartitions("conv", "at", "nth").select("conv", "line").mapInArrow(releasing(_digests), "conv string, digest string")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, with faults by a digest of id and turn: rows dropped, emptied, cut off, repeated, given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("fault"))
    rows = rows.filter("fault <> 0").withColumn("role", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")))
    rows = rows.withColumn("text", F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    times_ = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", "role", "text", F.explode(times_).alias("nth")).drop("nth")


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """All conversations, damaged, and what it takes to repair them."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    report, turns = repair(damaged(rows))
    report = report.join(digests(turns).select("conv", F.col("digest").alias("sha")), _key(F.col("conv_id")) == F.col("conv"), "left").drop("conv")
    everyone = rows.select(F.col("conv_id").alias("id")).distinct()
    out = everyone.join(report, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(
        F.col("id").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


OP11_SQL = r"""
WITH RECURSIVE polynomial AS (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS v FROM range(256) r(b))),
     k AS (SELECT *, hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS x FROM conversations),
     f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                  xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, length(x), 2), lambda i: CAST('0x' || x[i + 1 : i + 2] AS BIGINT))), lambda c, b: xor(t[CAST(xor(c & 255, b) AS INT) + 1], c // 256))) % 20 AS fault FROM k, polynomial),
     d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                  unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy FROM f WHERE fault <> 0),
     o AS (SELECT *, row_number() OVER w AS i, lag(role[1]) OVER w AS before,
                  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS empty, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open
           FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
     c AS (SELECT *, empty OR again AS must, NOT empty AND NOT again AND open AS trunc FROM o),
     tally AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (empty) AS blank, count(*) FILTER (again AND NOT empty) AS duplicate, count(*) FILTER (trunc) AS truncated,
                      count(*) FILTER (i > 1 AND before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM c GROUP BY conv_id),
     ins(p, q, cost, s) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 5, 'I'), (1, 2, 5, 'I'), (3, 2, 5, 'I'), (2, 3, 5, 'I'), (0, 3, 10, 'II'), (1, 3, 10, 'II')),
     step(role, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
     edit AS (SELECT conv_id, i, st.p, st.q, CASE WHEN c.role[1] = st.role THEN 0 ELSE 1 END + CASE WHEN trunc THEN 5 ELSE 0 END AS cost, CASE WHEN c.role[1] = st.role THEN 'K' ELSE 'R' END AS s FROM c JOIN step st ON c.role[1] = st.role OR st.role <> 's' WHERE NOT must
              UNION ALL SELECT conv_id, i, p, p, 2, 'D' FROM c, range(4) r(p)),
     whole AS (SELECT edit.conv_id, edit.i, ins.p, edit.q, ins.cost + edit.cost AS cost, ins.s || edit.s AS s FROM edit JOIN ins ON ins.q = edit.p),
     run AS (SELECT conv_id, 0::BIGINT AS i, 0 AS st, {'cost': 0, 'audit': ''} AS best FROM tally
             UNION ALL SELECT run.conv_id, any_value(whole.i), whole.q, min({'cost': run.best.cost + whole.cost, 'audit': run.best.audit || whole.s}) FROM run JOIN whole ON whole.conv_id IS NOT DISTINCT FROM run.conv_id AND whole.i = run.i + 1 AND whole.p = run.st GROUP BY run.conv_id, whole.q),
     fin AS (SELECT run.conv_id, min({'cost': run.best.cost + ins.cost, 'audit': run.best.audit || ins.s}) AS best FROM run JOIN tally ON run.conv_id IS NOT DISTINCT FROM tally.conv_id AND run.i = tally.n JOIN ins ON ins.p = run.st WHERE ins.q IN (0, 3) GROUP BY run.conv_id),
     chars AS (SELECT conv_id, j, best.audit[j] AS e FROM (SELECT conv_id, best, unnest(range(1, length(best.audit) + 1)) AS j FROM fin)),
     num AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY j) AS i, count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id ORDER BY j) AS m, count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id) % 2 AS odd FROM chars),
     made AS (SELECT num.conv_id, j, CASE WHEN e = 'K' THEN c.role WHEN (m + odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE c.text END AS line
              FROM num LEFT JOIN c ON e <> 'I' AND c.conv_id IS NOT DISTINCT FROM num.conv_id AND c.i = num.i WHERE e <> 'D'),
     sha AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY j)) AS h FROM made GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN tally ON a.conv_id IS NOT DISTINCT FROM tally.conv_id LEFT JOIN fin ON a.conv_id IS NOT DISTINCT FROM fin.conv_id LEFT JOIN sha ON a.conv_id IS NOT DISTINCT FROM sha.conv_id
"""
