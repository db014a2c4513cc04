"""Comparison of two states: each branch, and what must hold of any pair."""

from pyspark.sql import functions as F

from corpustide.functions import values as V
from corpustide.operators import diff

HEADS = "pid string, tool string, parser string, language string"
FACTS = "pid string, field string, value string"
RECORDS = "pid string, id string, publish_date string, title string, type_code string, section string, withheld boolean, files map<string,string>"
KEYS = "pid string, key string"


def _state(spark, heads, facts=(), records=(), documents=(), unreadable=()):
    make = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    return {
        "heads": make(heads, HEADS), "facts": make(facts, FACTS), "records": make(records, RECORDS),
        "documents": make(documents, KEYS), "unreadable": make(unreadable, KEYS)
    }


def _one(spark, before, after):
    return {r["pid"]: r for r in diff.diff(before, after).collect()}


def _record(pid, rid, date="d1", title="t", files=None):
    return (pid, rid, date, title, "A", "actual", False, files or {})


def test_new_has_counts_and_no_lists(spark):
    after = _state(spark, [("a", "t", "p", "lv")], records=[_record("a", "1")], documents=[("a", "k1"), ("a", "k2")])
    r = _one(spark, _state(spark, []), after)["a"]
    assert r["status"] == "new" and r["documents_added"] is None and r["facts"] is None and r["reextracted"] is None
    assert (r["n_records"], r["n_documents"], r["n_unreadable"]) == (1, 2, 0)
    assert [x["key"] for x in diff.documents_to_send(diff.diff(_state(spark, []), after), after["documents"]).orderBy("key").collect()] == ["k1", "k2"]


def test_same_state_is_unchanged(spark):
    state = _state(
        spark, [("a", "t", "p", None)], [("a", "title", "x"), ("a", "value", None)], [_record("a", "1", files={"s": "n"})],
        [("a", "k")], [("a", "u")]
    )
    changes = diff.diff(state, state)
    r = changes.collect()[0]
    assert r["status"] == "unchanged" and r["carried_over"] == 1 and not r["reextracted"] and r["facts_not_compared"] == []
    assert diff.refreshed(changes).count() == 0 and diff.documents_to_send(changes, state["documents"]).count() == 0


def test_translated_reparsed_reextracted(spark):
    names = ["lang", "parser", "tool", "known"]
    before = _state(
        spark, [("lang", "t", "p", "lv"), ("parser", "t", "p", "lv"), ("tool", None, "p", "lv"), ("known", "t", None, None)],
        [(n, f, "x") for n in names for f in ("title", "deadline")]
    )
    after = _state(
        spark, [("lang", "t", "p", "en"), ("parser", "t", "q", "lv"), ("tool", "t", "p", "lv"), ("known", "t", "p", "en")],
        [(n, f, "y") for n in names for f in ("title", "deadline")]
    )
    got = _one(spark, before, after)
    moved = {n: [f["field"] for f in got[n]["facts"]] for n in names}
    assert moved == {"lang": ["title"], "parser": [], "tool": ["title", "deadline"], "known": ["title", "deadline"]}
    assert got["lang"]["facts_not_compared"] == sorted(V.LOCALIZED) and got["parser"]["facts_not_compared"] == sorted(V.FACTS)
    assert got["tool"]["reextracted"] and not got["lang"]["reextracted"] and got["parser"]["status"] == "unchanged"
    assert {r["pid"] for r in diff.refreshed(diff.diff(before, after)).collect()} == set(names)


def test_records(spark):
    before = _state(
        spark, [("a", "t", "p", "lv")],
        records=[_record("a", "1", files={"s1": "f"}), _record("a", "2"), _record("a", "3", files={"s1": "f"}), _record("a", "4")]
    )
    after = _state(
        spark, [("a", "t", "p", "lv")],
        records=[_record("a", "1", files={"s2": "f"}), _record("a", "3", "d2", files={"s9": "z", "s0": "y"}), _record("a", "4", title="u"), _record("a", "5")]
    )
    r = _one(spark, before, after)["a"]
    assert (r["records_added"], r["records_removed"]) == (["5"], ["2"])
    by = {x["id"]: x for x in r["records_changed"]}
    assert by["1"]["silent"] and not by["3"]["silent"] and not by["4"]["silent"]
    assert by["3"]["files_added"] == ["y", "z"] and by["3"]["files_removed"] == ["f"]
    assert [(f["field"], f["was"], f["now"]) for f in by["4"]["fields"]] == [("title", "t", "u")]
    s = diff.summary(diff.diff(before, after)).collect()[0]
    assert s["silent_records"] == 1 and s["records_changed"] == 3


def test_withheld_never_overrides(spark):
    kinds = "pid string, id string, publish_date string, title string, type_code string, section string, files array<struct<sha256: string, original_name: string, filename: string>>"
    shown = spark.createDataFrame([("a", "1", "d", "t", "A", "actual", [("s", None, "f"), (None, "x", "y")])], kinds)
    hidden = spark.createDataFrame([("a", "1", "d", "t", "A", "actual", []), ("a", "2", "d", "t", "A", "actual", [])], kinds)
    got = {r["id"]: r for r in diff.record_state(shown, hidden).collect()}
    assert not got["1"]["withheld"] and got["1"]["files"] == {"s": "f"} and got["2"]["withheld"]


def test_seen_follows_the_order_of_runs(spark):
    runs = spark.createDataFrame(
        [("a", "2026-01-02", 1, "new"), ("a", "2026-01-03", 2, "unchanged"), ("a", "2026-01-01", 3, "unchanged")],
        "pid string, date string, seq long, status string"
    )
    r = diff.seen(runs).collect()[0]
    assert (r["first_seen"], r["last_seen"], r["last_change"]) == ("2026-01-02", "2026-01-01", "2026-01-02")


def test_document_state(spark):
    kinds = "pid string, original_sha256 string, source string, section string, original_file string, record_title string, record_id string, also_listed_under string, markdown_path string, markdown_chars long, pos long"
    rows = [
        ("a", "s", "d/x.pdf", "actual", None, "r", "7", None, "m", 5, 1),
        ("a", "s", "d/x.pdf", "actual", None, "r", "7", "7", "m", 5, 2),
        ("a", "s", "d/y.pdf", "actual", "o.zip", "r", "", None, "m", 6, 3),
        ("a", "s", "d/z.pdf", "actual", None, "r", "7", None, None, None, 4)
    ]
    got = sorted(((r["name"], r["record_id"], r["chars"]) for r in diff.document_state(spark.createDataFrame(rows, kinds)).collect()))
    assert got == [("o.zip", None, 6), ("x.pdf", "7", 5)]
    assert diff.unreadable_state(spark.createDataFrame(
        [("a", "", "f", "r", 1), ("a", "s", "g", "r", 2)], "pid string, sha256 string, file string, reason string, bytes long"
    )).filter(F.col("key") == "s").count() == 1
