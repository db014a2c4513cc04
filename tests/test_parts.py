"""Scalars, keyed steps, planning, pages, scans, sources and sinks on small rows."""

import hashlib
import heapq
import io
import json
import os
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpustide.functions import columns as C
from corpustide.functions import values as V
from corpustide.operators import keyed, pages, planning, scans
from corpustide.sources import files, publish, register


def _values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema + ", _n int").orderBy("_n").select(column).collect()]


def _each(spark, texts, column):
    return _values(spark, [(t, n) for n, t in enumerate(texts)], "x string", column)


def test_money(spark):
    got = _each(spark, ["63100.00 EUR", "63 100,50", "5", "", None, "par vienu", " 5", "1,234.50", "10."], C.money(F.col("x")))
    assert got == [63100.0, 63100.5, 5.0, None, None, None, None, 1.234, 10.0]


def test_identity_and_shards(spark):
    got = _each(spark, ["179550", V.PLATFORM_PAGE + "12", "AB-C", "  ", None], C.identity(F.col("x")))
    assert got == ["eis:179550", "eis:12", "iub:ab-c", None, None]
    keys = [f"eis:{k}" for k in range(300)]
    got = _each(spark, keys, C.shard_of(F.col("x"), 4))
    assert got == [int.from_bytes(hashlib.sha256(k.encode()).digest()[:8], "big") % 4 + 1 for k in keys]
    taken = [sum(x) for x in zip(*[_each(spark, keys, C.take_shard(F.col("x"), s, 4).cast("int")) for s in (1, 2, 3, 4)])]
    assert set(taken) == {1}
    assert not any(_each(spark, keys[:3], C.take_shard(F.col("x"), 5, 4))) and all(_each(spark, keys[:3], C.take_shard(F.col("x"), 1, 1)))


def test_scope(spark):
    rows = [
        ("Road works", ["45000"], 0), ("Green roof", ["45000"], 1), (None, ["45000"], 2), ("Green roof", ["99"], 3),
        ("green salmon", ["1"], 4), ("", [], 5), ("other", ["99", "1"], 6)
    ]
    got = _values(spark, rows, "t string, c array<string>", C.outside_scope(F.col("t"), F.col("c"), ["green"], ["99"], ["salmon"]))
    assert got == [True, False, False, True, True, False, True]
    assert _values(spark, rows, "t string, c array<string>", C.outside_scope(F.col("t"), F.col("c"), [], ["99"], [])) == [False] * 7


def test_small_scalars(spark):
    long = "ā" * 90 + ".pdf"
    assert _each(spark, ["a/b:c.txt", long, "...", "x" * 80], C.slug(F.col("x"))) == [
        "a_b_c.txt", "ā" * 67 + "~" + hashlib.sha1(long.encode()).hexdigest()[:8] + ".pdf", "file", "x" * 80
    ]
    assert _each(spark, ["a/b", "../a", "/a", "a/..\\b", "c:/x", "a..b"], C.safe_member(F.col("x"))) == [True, False, False, False, False, True]
    assert _each(spark, ["0", "", None, "12.5", "x", "0.0"], C.register_amount(F.col("x"))) == [None, None, None, 12.5, None, 0.0]
    assert _each(
        spark,
        [
            "https://www.eis.gov.lv/EKEIS/Supplier/Procurement/7", "http://www.eis.gov.lv/EKEIS/Supplier/Procurement/7",
            "https://evil/EKEIS/Supplier/Procurement/7"
        ],
        C.canonical_url(F.col("x"))["id"]
    ) == ["7", None, None]
    assert _each(spark, ["Firm, reģ. numurs: 400", "Firm", None], C.split_buyer(F.col("x"))["reg"]) == ["400", None, None]
    assert _each(spark, ["Name&#257;:: <b>tip</b>", None], C.label_text(F.col("x"))) == ["Nameā", ""]
    assert _each(spark, ["a<br>&amp; b"], C.html_text(F.col("x"))) == ["a & b"]
    got = _values(spark, [(0, 0), (10 * 1024 * 1024, 1), (1024 * 1024, 2)], "n long", C.pause_for(F.col("n")))
    assert got == [0.75, 5.0, 1.25]
    at = spark.sql("select date'2026-01-10' as d").select(planning.window_bounds(3, F.col("d")).alias("w")).first()["w"]
    assert str(at["start"]) == "2026-01-08"


def test_entities_that_were_cut(spark):
    cut = ["&quot a &copy b &quotx; &amp c &ampx; &quot;d&quot; &#257; &#257 &amp;lt; &NotEqualTilde; &nosuch;", None]
    assert _each(spark, cut, C.html_text(F.col("x"), closed=True)) == ["&quot a &copy b &quotx; & c &x; \"d\" ā &#257 &lt; ≂̸ &nosuch;", ""]
    assert _each(spark, cut[:1], C.html_text(F.col("x"))) == ['" a © b "x; & c &x; "d" ā ā &lt; ≂̸ &nosuch;']


PAGE = """<html><script>var __RequestVerificationToken=1; var ActualDocuments_items = [{"Id": 5, "Title": " One [x]", "TypeTitle": "k"}, {"Id": 6, "Title": "", "DocumentTitle": {"Title": "Two"}}];
var HistoricalDocuments_items = [{"Id": 5, "Title": "old"}, {"Id": 7, "Title": "Three", "DocumentLinkTypeCode": "Z"}];</script>
<label title="%s <div>help</div>" for="Name">Iepirkuma nosaukums: <i>tip</i></label><div class="x field-block y">Road &amp; <b>bridge</b></div>
<label for="Contact">Kontaktpersona</label><div class="field-block">A. Person</div>
<label for="SubjectDescription_EstimatedContractValue">V</label><div class="field-block">63 100,00 <span>EUR</span></div>
<label for="OrganizerId">B</label><div class="field-block">Firm, reģ. numurs: 400</div>
<label for="Lone">Lone</label>
<label for="SubjectDescription_CpvAdditionalIdList">CPV papildkods</label><div class="field-block">CpvAdditionals_items = [{"Title": "45 [a]"}, {"Title": "71"}, {"Title": "45 [a]"}]; more</div>
<label for="Name">Iepirkuma nosaukums</label><div class="field-block">second</div></html>""" % ("a" * 20_000)


def test_page(spark):
    df = spark.createDataFrame(
        [(1, PAGE), (2, "nothing"), (3, None), (4, "Pieeja liegta / Access Denied"), (5, "Pārbaude pret robotiem")],
        "pid long, html string"
    )
    assert [r[0] for r in df.orderBy("pid").select(C.page_class(F.col("html"))).collect()] == ["published", "other", "other", "denied", "robot"]
    rows = pages.notices(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["pid"], r["title"], r["value"], r["buyer"], r["buyer_reg"]) == ("1", "Road & bridge", 63100.0, "Firm", "400")
    assert r["cpv_additional"] == ["45 [a]", "71"] and r["fields"]["CPV papildkods"] == "45 [a]; 71" and r["register_check"] == "unverified" and r["unconfirmed"]
    assert not any("Person" in v or "Kontakt" in k for k, v in r["fields"].items()) and "Lone" not in r["fields"]
    docs = [(d["doc_id"], d["title"], d["section"], d["link_type"]) for d in pages.documents(df).orderBy("pos").collect()]
    assert docs == [("5", "One [x]", "actual", "PRCDOC"), ("6", "Two", "actual", "PRCDOC"), ("7", "Three", "archive", "Z")]


def test_embedded_array(spark):
    cases = ["x = [1, 2]; y", "x = {'a': 1}", "x = {\"a\": 1}", "x = ['a']", "x = [1, 2", "none", None, "xx = [9]; x=[3]"]
    got = _each(spark, cases, pages.embedded_array(F.col("x"), "x", "string"))
    assert got[0] == ["1", "2"] and got[7] == ["3"] and got[1:7] == [[]] * 6
    with pytest.raises(Exception, match="cannot be read"):
        _each(spark, ["x = [1, 2"], pages.embedded_array(F.col("x"), "x", "string", strict=True))
    assert _each(spark, ["y = 1"], pages.embedded_array(F.col("x"), "x", "string", strict=True)) == [[]]


def test_journal(spark, tmp_path):
    path = tmp_path / "journal.jsonl"
    publish.append_journal(str(path), [{"id": "1", "title": "a"}, {"id": "2", "title": "b"}, {"id": "1", "title": "c"}])
    with open(path, "a") as f:
        f.write('\n{"id": "3", "tit')
    got = sorted((r["id"], r["title"]) for r in files.read_journal(spark, str(path), "id string, title string").collect())
    assert got == [("1", "c"), ("2", "b")]


def test_lists_and_policy(spark, tmp_path):
    (tmp_path / "targets.txt").write_text("﻿# head\n12 # one\n\nAB\n", encoding="utf-8")
    assert [r["target"] for r in files.read_targets(spark, str(tmp_path / "targets.txt")).orderBy("pos").collect()] == ["12", "AB"]
    (tmp_path / "resolved.tsv").write_text("iub:a\teis:1\niub:b\t-\n")
    assert [tuple(r) for r in files.read_resolutions(spark, str(tmp_path / "resolved.tsv")).collect()] == [("iub:a", "eis:1")]
    assert files.load_policy('{"recall_title_terms": ["x"], "hard_exclude_prefixes": ["9"]}') == {"recall": ["x"], "prefixes": ["9"], "excluded": []}
    assert [files.load_policy(x) for x in (None, "", "{bad", "/no/such/file", "{}")] == [None] * 5
    with pytest.raises(ValueError) as e:
        files.setting("PLACE", {"PLACE": "  "})
    assert "PLACE" in str(e.value)


def test_targets(spark):
    window = spark.createDataFrame([("10", "U-1", 0), ("11", None, 1), (V.PLATFORM_PAGE + "10", None, 2)], "target string, uuid string, pos long")
    named = spark.createDataFrame([("u-1", 0), ("12", 1), ("12", 2), ("11", 3), (" ", 4)], "target string, pos long")
    got = sorted((r["key"], r["named"]) for r in planning.targets(window, named).collect())
    assert got == [("eis:10", False), ("eis:11", False), ("eis:12", True)]
    assert planning.targets(window, named, deduplicate_window=False).count() == 4


@given(st.lists(st.integers(0, 50), min_size=1, max_size=40), st.integers(1, 5))
@settings(max_examples=5, deadline=None)
def test_balance(spark, loads, slices):
    rows = [(f"p{n:03d}", x) for n, x in enumerate(loads)]
    heap, want = [(0, s) for s in range(1, slices + 1)], {}
    for pid, x in sorted(rows, key=lambda r: (-r[1], r[0])):
        total, s = heapq.heappop(heap)
        want[pid] = s
        heapq.heappush(heap, (total + x, s))
    df = spark.createDataFrame(rows, "pid string, chars long")
    assert {r["pid"]: r["slice"] for r in planning.balance(df, slices).collect()} == want
    two = df.withColumn("day", F.lit("d1")).unionByName(df.withColumn("day", F.lit("d2"))).repartition(3)
    assert {(r["day"], r["pid"]): r["slice"] for r in planning.balance(two, slices, day="day").collect()} == {(d, p): s for d in ("d1", "d2") for p, s in want.items()}


def test_day(spark):
    indexes = spark.createDataFrame([(1, "r"), (2, None), (3, "old")], "shard int, run_id string")
    entries = spark.createDataFrame(
        [("1", 1, 0, "new", 2, 10, 0), ("2", 1, 1, None, 1, 30, 1), ("1", 2, 0, "changed", 3, 20, 0), ("9", 3, 0, "new", 1, 1, 0)],
        "pid string, shard int, pos int, status string, documents long, chars long, unreadable long"
    )
    accounts = spark.createDataFrame(
        [(1, "iub:a", "target"), (1, "eis:2", "target"), (2, "eis:5", "target"), (2, "eis:6", "target"), (2, "eis:6", "failed")],
        "shard int, key string, outcome string"
    )
    resolved = spark.createDataFrame([(2, "iub:a", "eis:1")], "shard int, asked string, found string")
    day = planning.collect_day(indexes, entries, accounts, resolved, "r", 4, 2)
    assert {r["shard"]: r["state"] for r in day["states"].collect()} == {1: "present", 2: "present", 3: "stale", 4: "missing"}
    assert {r["pid"]: (r["status"], r["slice"]) for r in day["tenders"].collect()} == {"1": ("changed", 2), "2": (None, 1)}
    assert [r["key"] for r in day["unaccounted"].collect()] == ["eis:5"]
    assert tuple(day["coverage"].first()) == (4, 2, 1, 1) and not day["complete"].first()[0]
    assert {r["status"]: r["tenders"] for r in day["counts"].collect()} == {"changed": 1, "unknown": 1}


def test_walk(spark):
    import random

    r = random.Random(4)
    live = {k for k in range(100, 400) if r.random() < 0.3}
    df = spark.createDataFrame([(k, k in live) for k in range(100, 400)], "id long, hit boolean")
    for misses in (2, 4, 8, 40):
        want, run, k = [], 0, 100
        while run < misses and k < 400:
            run = 0 if k in live else run + 1
            want += [k] if k in live else []
            k += 1
        for bucket in (7, 1000):
            assert [x[0] for x in keyed.walk_until_misses(df, "id", "hit", misses, bucket=bucket).orderBy("id").collect()] == want


def test_scan_queue(spark):
    rows = [
        ("a.dwg", 1, "s1", "no text layer", None), ("b.pdf", 1, "s2", "failed", None), ("c.JPG", 1, None, "x", None),
        ("d.pdf", 99 << 20, "s3", "no text layer", "unpacked/d"), ("e.pdf", 1, "s4", "no text layer", None),
        ("f.pdf", 99 << 20, "s5", "no text layer", None), ("g.pdf", 1, "s5", "no text layer", None),
        ("h.pdf", 1, "s5", "no text layer", None)
    ]
    gaps = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "file string, bytes long, sha256 string, reason string, path string, pos long")
    paths = scans.first_paths(spark.createDataFrame([("s5", "p2", 2), ("s5", "p1", 1)], "sha256 string, path string, n int"), ["n"])
    got = [(r["skipped"], r["send_path"]) for r in scans.queue(gaps, paths, limit=2).orderBy("pos").collect()]
    assert got == [
        ("drawing-not-sent", None), ("reason-not-selected", None), ("no-digest-to-cache-by", None), (None, "unpacked/d"),
        ("source-not-retained", None), ("too-large-for-inline-upload", None), (None, "p1"), ("over-the-run-limit", None)
    ]


def _read(content, path):
    if path == "quota":
        raise scans.Quota("spent")
    if path == "bad":
        raise ValueError("damaged")
    return content.decode()


def _load(path):
    return {"ok": b"text", "blank": b" ", "more": b"more"}.get(path, b"")


def test_scan_run(spark):
    rows = [("a", "ok", 0), ("b", "bad", 1), ("c", "blank", 2), ("d", "quota", 3), ("e", "more", 4)]
    out = scans.run(spark.createDataFrame(rows, "sha256 string, send_path string, pos long"), _read, _load)
    got = {r["sha256"]: r["outcome"] for r in out.collect()}
    assert got == {"a": "read", "b": "failed", "c": "empty", "d": "deferred", "e": "deferred"}
    assert tuple(scans.totals(out).first()) == (1, 1, 1, 2, 5)


def test_read_scans(spark):
    """Queue, cache, run and results as one: what the cache has is not asked for, a digest is asked for once."""
    from corpustide.plans import lifecycle

    rows = [("a.pdf", "s1", "ok"), ("b.pdf", "s1", "ok"), ("c.pdf", "s2", "more"), ("d.pdf", "s3", "blank"), ("e.dwg", "s4", "ok")]
    gaps = spark.createDataFrame(
        [(f, 10, d, V.NO_TEXT, p, n) for n, (f, d, p) in enumerate(rows)],
        "file string, bytes long, sha256 string, reason string, path string, pos long"
    )
    files = spark.createDataFrame([], "sha256 string, path string, pos long")
    cache = spark.createDataFrame([("s2", "known", "{}"), ("s3", "torn", None)], "sha256 string, text string, provenance string")
    done = lifecycle.read_scans(gaps, files, cache, scans.Provider(_read, model="m"), _load, "p", "read it", F.lit("2026-01-01"))
    assert {r["file"]: r["step"] for r in done["plan"].collect()} == {"a.pdf": "call", "b.pdf": "call", "c.pdf": "cached", "d.pdf": "call", "e.dwg": "skip"}
    kept = done["kept"].collect()
    assert [(r["sha256"], r["text"]) for r in kept] == [("s1", "text")] and json.loads(kept[0]["provenance"])["model"] == "m"
    assert tuple(done["totals"].first())[:4] == (1, 1, 0, 0)
    scans.PROVIDERS["own"] = scans.Provider(_read, keyed=True)
    try:
        with pytest.raises(ValueError):
            scans.provider("own", {}, "OWN_KEY")
        with pytest.raises(KeyError):
            scans.provider("other", {})
        assert scans.provider("own", {"OWN_KEY": "x"}, "OWN_KEY").read is _read
    finally:
        del scans.PROVIDERS["own"]


def test_exits(spark):
    from corpustide.plans import lifecycle

    assert [lifecycle.exit_for(e) for e in (
        None, lifecycle.Incomplete(), lifecycle.Empty(), lifecycle.Stale(), scans.Quota(), register.Refused(), ValueError()
    )] == [0, 2, 3, 4, 3, 2, 1]
    packed = publish.archives(spark.createDataFrame([("p", "a.md", b"x")], "pid string, path string, content binary"))
    assert lifecycle.verify(packed).count() == 1
    with pytest.raises(lifecycle.Unverified, match="p"):
        lifecycle.verify(packed.withColumn("sha256", F.lit("0")))


def test_publish_delivery(spark, tmp_path):
    """Only items that moved are written again, and of them only documents to send; all have their last look."""
    from corpustide.plans import lifecycle

    register.install(spark)
    delivery = {
        "send": spark.createDataFrame([("p1", "k" * 16), ("p2", "m" * 16)], "pid string, key string"),
        "refreshed": spark.createDataFrame([("p1",)], "pid string"),
        "summary": spark.createDataFrame([("p1", "changed"), ("p2", "unchanged")], "pid string, status string"),
        "changes": spark.createDataFrame([("p1", "changed"), ("p2", "unchanged")], "pid string, status string"),
    }
    name = lambda k: f"doc/{'0123456789abcdef' if k else 'fedcba9876543210'}.md"
    texts = spark.createDataFrame(
        [("p1", "k" * 16, name(1), b"one"), ("p1", "l" * 16, name(0), b"old"), ("p2", "m" * 16, name(1), b"two"), ("p1", "k" * 16, "original/a.pdf", b"pdf")],
        "pid string, key string, path string, content binary"
    )
    seen = spark.createDataFrame([("p1", "d1"), ("p2", "d0")], "pid string, last_seen string")
    lifecycle.publish_delivery(str(tmp_path), "r1", delivery, texts, seen)
    assert sorted(str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*") if f.is_file() and not f.name.startswith((".", "_", "part-"))) == [
        "day.json", f"p1/{name(1)}", "p1/index.json", "p1/runs/r1.json", "p1/seen.json", "p1/state.json", "p2/runs/r1.json",
        "p2/seen.json"
    ]


def _page(n, start, end):
    records = [{"identifier": f"u{k}", "type": "competition"} for k in range(n * 3, min(n * 3 + 3, 7))]
    return records, 7, 3


def _walk_page(pid):
    return f"page {pid}" if pid % 2 else None


def test_sources(spark, tmp_path):
    register.install(spark)
    df = spark.read.format("register").option("transport", "test_parts:_page").option("pause", "0").load()
    assert [r["key"] for r in df.orderBy("pos").collect()] == [f"u{k}" for k in range(7)]
    assert planning.coverage(df.select(F.col("key").alias("identifier"), F.lit(None).cast("string").alias("externalId")), 7, 3).first()["proven"]
    calls = []

    def flaky(*a, **k):
        calls.append(1)
        if len(calls) < 3:
            raise ValueError
        return io.BytesIO(b"{}")

    class Body(io.BytesIO):
        headers = {"A": "b"}

    waits = []
    assert register.get_json(
        "http://x", open_url=lambda *a, **k: flaky() and Body(b'{"a": 1}'), sleep=waits.append
    ) == ({"a": 1}, {"A": "b"}) and waits == [0.4, 0.8]
    with pytest.raises(register.Refused):
        register.fetch_page(lambda u: "Pieeja liegta / Access Denied", "u", sleep=lambda s: None)
    with pytest.raises(RuntimeError):
        register.fetch_page(lambda u: "", "u", sleep=lambda s: None)
    data = publish.archive([("a", b"1")])
    assert register.record_archive(lambda u: data, "u") == [("a", b"1")]
    assert [register.record_archive(lambda u, d=d: d, "u") for d in (b"", b"<html>", b"PK-bad", publish.archive([]))] == [None] * 4


def test_long_scan():
    """A scan goes on to its total, past 200 pages; a register that only repeats itself is an error."""
    page = lambda n: ([{"identifier": str(k)} for k in range(2 * n, 2 * n + 2)], 903, 2)
    found = list(register.scan_pages(page, sleep=lambda s: None))
    assert len({r["identifier"] for _, r in found}) >= 903 and found[-1][0] == 451
    with pytest.raises(RuntimeError, match="2 of 3"):
        list(register.scan_pages(lambda n: ([{"identifier": "a"}, {"identifier": "b"}], 3, 2), stalled=5, sleep=lambda s: None))


def test_archives_and_publication(spark, tmp_path):
    one = publish.archive([("b", b"2"), ("index.json", b"{}"), ("a", b"1"), ("a", b"again")])
    assert one == publish.archive([("a", b"1"), ("index.json", b"{}"), ("b", b"2")])
    assert zipfile.ZipFile(io.BytesIO(one)).namelist() == ["a", "b", "index.json"]
    assert publish.ranges(5) == [(0, 5)] and publish.ranges(25 << 20)[-1] == (20 << 20, 25 << 20)
    register.install(spark)
    rows = spark.createDataFrame(
        [("p1", "doc/x.md", b"x"), ("p1", "doc/y.md", b"y"), ("p2", "doc/z.md", b"z")], "pid string, path string, content binary"
    ).repartition(3)
    packed = publish.archives(rows)
    assert {r["pid"]: r["members"] for r in publish.verified(packed).filter("ok").collect()} == {"p1": 2, "p2": 1}
    assert publish.verified(packed.withColumn("sha256", F.lit("0"))).filter("ok").count() == 0
    seen = spark.createDataFrame(
        [("p1", "d1", "d2", "d2"), ("p2", "d1", "d2", "d2"), ("p3", "d0", "d2", "d0")],
        "pid string, first_seen string, last_seen string, last_change string"
    )
    runs = spark.createDataFrame([("p1", "changed"), ("p2", "new"), ("p3", "unchanged")], "pid string, status string")
    for _ in range(2):  # a replay writes the same
        publish.publish(str(tmp_path), "s1", rows, seen, runs, runs, shard=2)
        index = json.loads((tmp_path / "p1/index.json").read_text())
        assert [d["path"] for d in index["documents"]] == ["doc/x.md", "doc/y.md"]
        assert (tmp_path / "p2/doc/z.md").read_bytes() == b"z" and json.loads((tmp_path / "shard-2/day.json").read_text()) == {"state": "s1", "shard": 2}
    # an item that did not move has its last look and the run's record, and nothing else
    assert sorted(str(f.relative_to(tmp_path)) for f in (tmp_path / "p3").rglob("*.json")) == ["p3/runs/s1.json", "p3/seen.json"]
    assert [r["pid"] for r in spark.read.json(f"file://{tmp_path}/shard-2/index-s1").orderBy("pid").collect()] == ["p1", "p2"]
    assert spark.read.json(f"file://{tmp_path}/shard-2/changes-s1").count() == 3


def test_publication_order(spark, tmp_path, monkeypatch):
    """A publication that breaks off leaves no file of a later step: no state without its index, no marker without all."""
    register.install(spark)
    rows = spark.createDataFrame([("p1", "doc/x.md", b"x")], "pid string, path string, content binary")
    steps = ["documents", "index", "state", "shard index", "marker"]
    real, real_lines, real_put = publish._put_all, publish._lines, publish.put
    for broken in range(len(steps)):
        root, done = tmp_path / str(broken), []

        def step(name, call):
            if len(done) == broken:
                raise RuntimeError(name)
            done.append(name)
            call()

        monkeypatch.setattr(publish, "_put_all", lambda files, at: step("files", lambda: real(files, at)))
        monkeypatch.setattr(publish, "_lines", lambda r, path: step("lines", lambda: real_lines(r, path)))
        monkeypatch.setattr(publish, "put", lambda path, data: step("marker", lambda: real_put(path, data)))
        with pytest.raises(RuntimeError):
            publish.publish(str(root), "s1", rows)
        have = [(root / f).exists() for f in ("p1/doc/x.md", "p1/index.json", "p1/state.json", "index-s1/_SUCCESS", "day.json")]
        assert have == [k < broken for k in range(5)]


def test_harvest(spark, tmp_path):
    records = spark.createDataFrame([("a", "competition"), ("b", None), ("c", "competition")], "identifier string, type string")
    publish.harvest(records, planning.coverage(records.withColumn("externalId", F.lit(None).cast("string")), 3, 1), f"file://{tmp_path}")
    meta = spark.read.json(f"file://{tmp_path}/meta").first()
    assert meta["proven"] and meta["unique"] == 3 and meta["by_type"].asDict() == {"competition": 2, "unknown": 1}
    assert spark.read.json(f"file://{tmp_path}/records").count() == 3


def _walk_live(pid):
    return f"page {pid}" if pid < 240 and pid % 3 == 0 else None


def test_walk_stream(spark, tmp_path):
    """A stream over ids goes on after a restart where its checkpoint says, reads none twice, and ends after a run of misses."""
    register.install(spark)
    got = {}  # by batch, as one that was broken off before it was committed runs again

    def start():
        pages = spark.readStream.format("walk").options(transport="test_parts:_walk_live", start="1", batch="20", misses="40").load()
        return pages.writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(lambda df, n: got.update({n: [r["pid"] for r in df.collect()]})).start()

    import time

    for _ in range(2):  # broken off in the middle
        q, before, end = start(), len(got), time.time() + 60
        while len(got) < before + 2 and time.time() < end:
            time.sleep(0.05)
        q.stop()
        assert len(got) > before
    q = start()
    q.processAllAvailable()
    q.stop()
    read = [pid for n in sorted(got) for pid in got[n]]
    assert read == list(range(1, len(read) + 1)) and 240 + 38 <= len(read) <= 300
    q = start()  # a walk that has ended reads nothing more
    q.processAllAvailable()
    q.stop()
    assert [pid for n in sorted(got) for pid in got[n]] == read


def test_walk_replays_a_batch():
    """The offset holds all that a walk knows: the same one gives the same rows, and a range is read again as it was."""
    reader = register.WalkReader({"transport": "test_parts:_walk_live", "start": "5", "batch": "50", "misses": "40", "end": "70"})
    rows, end = reader.read(reader.initialOffset())
    rows = list(rows)
    again = register.WalkReader({"transport": "test_parts:_walk_live", "start": "1", "batch": "7"})
    assert [p for p, _ in rows] == list(range(5, 55)) and end["id"] == 55 and list(again.readBetweenOffsets({"id": 5}, end)) == rows
    assert [p for p, _ in reader.read(end)[0]] == list(range(55, 70)) and list(reader.read({"id": 100, "hit": 60})[0]) == []
    assert reader.read({"id": 100, "hit": 60})[1] == {"id": 100, "hit": 60}


def test_forgotten_items(spark, tmp_path):
    """An item leaves the state when its time is up, and is new when it comes again, in whatever batches."""
    import datetime

    from corpustide.streaming import runs

    day = lambda n: datetime.datetime(2026, 1, n)
    one = [("a", "d1", 1, "new", day(1)), ("b", "d1", 2, "new", day(1))]
    two = [("b", "d9", 3, "unchanged", day(9)), ("c", "d20", 4, "new", day(20))]
    three = [("a", "d21", 5, "unchanged", day(21)), ("c", "d21", 4, "changed", day(21))]
    schema = "pid string, date string, seq long, status string, stamp timestamp"
    for k, batches in enumerate(([one, two, three], [one + two + three])):
        got, at = {}, str(tmp_path / f"in{k}")
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(at)
            q = runs.seen_lately(spark.readStream.schema(schema).parquet(at), datetime.timedelta(days=5)).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / f"cp{k}"))
            seen = []
            q.foreachBatch(lambda df, n: seen.extend(df.collect())).trigger(availableNow=True).start().awaitTermination()
            for r in sorted(seen, key=lambda r: r["forgotten"]):
                got[r["pid"]] = tuple(r)[1:]
        assert got == {"a": ("d21", "d21", None, False), "b": ("d9", "d9", None, True), "c": ("d20", "d20", "d20", False)}


def test_items_in_groups(spark, tmp_path):
    """Items of a group share one row of state and one timer: each leaves when its own time is past, in any zone; the number of groups stays."""
    import datetime

    from corpustide.streaming import runs

    schema = "pid string, date string, seq long, status string, stamp timestamp"
    at = lambda day, ms=0: datetime.datetime(2026, 1, day, 0, 0, 0, ms * 1000, datetime.timezone.utc)
    one = [(f"p{n}", "d1", n, "new", at(1, n)) for n in range(50)]
    zone, told = spark.conf.get("spark.sql.session.timeZone"), []

    def go_on(rows: list, groups: int):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = runs.seen_lately(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), datetime.timedelta(days=5), groups=groups)
        q = stream.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
        q = q.foreachBatch(lambda df, n: told.extend(df.collect())).start()
        q.awaitTermination()
        return q.lastProgress["stateOperators"][0]["numRowsTotal"]

    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert go_on(one, 4) <= 4
        told.clear()
        go_on([("p7", "d3", 60, "changed", at(3))], 4)
        assert [tuple(r) for r in told] == [("p7", "d1", "d3", "d3", False)]
        told.clear()
        go_on([("q", "d6", 61, "new", at(6, 20))], 4)  # the watermark is just when p20's time is up
        assert sorted(r["pid"] for r in told if r["forgotten"]) == sorted(f"p{n}" for n in range(20) if n != 7)
        assert [tuple(r) for r in told if not r["forgotten"]] == [("q", "d6", "d6", "d6", False)]
        with pytest.raises(Exception, match="4 groups"):
            go_on([("p7", "d7", 62, "new", at(7))], 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_files_in_parts(spark, tmp_path, monkeypatch):
    """Each of the seven files of events is as many parts, also one with too few rows for that, and a stream takes one file a batch."""
    import datetime

    from corpustide.plans import catalogue_packs

    monkeypatch.setattr(catalogue_packs, "EVENTS", 25)
    rows = [(n, datetime.datetime(2024, 1, 1 + n // 7, 12), n, "view", 1.0, None) for n in range(90)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    stream = catalogue_packs._put_files(spark, str(tmp_path), str(tmp_path / "out"))
    assert len(spark.read.parquet(str(tmp_path / "out")).inputFiles()) == 7 * 4
    got = {}
    q = stream.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
    q.foreachBatch(lambda df, n: got.update({n: sorted(r["event_id"] for r in df.select("event_id").collect())})).start().awaitTermination()
    file = lambda n: min(n // 7 // 6, 4) + (2 if n % 10 == 3 else 0)
    assert got == {k: [n for n in range(90) if file(n) == k] for k in range(7)}


def test_streams(spark, tmp_path):
    from corpustide.streaming import runs

    schema = "pid string, date string, seq long, status string"
    first = spark.createDataFrame([("a", "d1", 1, "new"), ("b", "d1", 2, "new")], schema)
    second = spark.createDataFrame([("a", "d2", 3, "unchanged"), ("b", "d3", 4, "changed")], schema)
    first.coalesce(1).write.parquet(str(tmp_path / "in"))
    got = {}
    q = runs.seen(spark.readStream.schema(schema).parquet(str(tmp_path / "in"))).writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(
        lambda df, n: got.update({r["pid"]: (r["first_seen"], r["last_seen"], r["last_change"]) for r in df.collect()})
    ).start()
    q.processAllAvailable()
    second.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q.processAllAvailable()
    q.stop()
    assert got == {"a": ("d1", "d2", "d1"), "b": ("d1", "d3", "d3")}
    notices = spark.createDataFrame(
        [("u1", "2026-01-01 10:00:00", "x"), ("u1", "2026-01-01 10:00:00", "x"), ("u2", "2026-01-01 11:00:00", "x")],
        "key string, ts string, kind string"
    ).withColumn("ts", F.to_timestamp("ts"))
    notices.coalesce(1).write.parquet(str(tmp_path / "n"))
    stream = runs.deduplicated(spark.readStream.schema(notices.schema).parquet(str(tmp_path / "n")), "key", "ts")
    q = stream.writeStream.format("memory").queryName("once").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("once").count() == 2
    assert runs.per_day(notices.distinct(), "ts", "kind").collect()[0]["n"] == 2


class Portal:
    """A platform of three items: one whole, one that refuses, one whose page breaks off."""

    def page(self, url):
        if url == "2":
            return "Pieeja liegta / Access Denied"
        if url == "3":
            return '__RequestVerificationToken ActualDocuments_items = [{"Id": 1'
        return '__RequestVerificationToken ActualDocuments_items = [{"Id": 1, "Title": "A"}, {"Id": 2, "Title": "B"}, {"Id": 3, "ShowDownloadIcon": false}]; HistoricalDocuments_items = [{"Id": 4}, {"Id": 9}]; <label for="Name">Name</label><div class="field-block">T</div>'

    def archive(self, pid, record):
        return {"1": publish.archive([("a.txt", b"one"), ("b.txt", b"two")]), "4": publish.archive([("a.txt", b"other")])}.get(record["id"], b"<html>")

    def list(self, pid, record):
        return [{"name": "a.txt"}, {"name": "sub/a.txt"}]

    def file(self, pid, record, entry):
        return b"one" if entry["name"] == "a.txt" else b"new"


def test_fetch_to_delivery(spark):
    from corpustide.plans import lifecycle

    rows = [(f"eis:{n}", f"eis:{n}", str(n), str(n), ["9"]) for n in (1, 2, 3)]
    targets = spark.createDataFrame(rows, "target string, key string, pid string, url string, done array<string>")
    run = lifecycle.batch(targets, "test_parts:Portal", pause=0.0)
    outcomes = {r["pid"]: r["outcome"] for r in run["outcomes"].collect()}
    assert outcomes == {"1": "done", "2": "withdrawn", "3": "failed"} and lifecycle.exit_code(run["outcomes"]) == 0
    got = sorted((r["record_id"], r["path"], r["duplicate"], r["method"]) for r in run["files"].collect())
    one, two = hashlib.sha256(b"new").hexdigest()[:10], None
    assert got == [
        ("1", "actual/a.txt", False, "zip"), ("1", "actual/b.txt", False, "zip"), ("2", f"actual/a-{one}.txt", False, "files"),
        ("2", "actual/a.txt", True, "files"), ("4", "archive/a.txt", False, "zip")
    ]
    assert two is None and run["records"].filter("withheld").count() == 1 and run["facts"].first()["title"] == "T"
    assert run["extracted"].filter("kind = 'markdown'").count() == 4
    written = {(r["pid"], r["path"]): json.loads(bytes(r["content"])) for r in run["written"].collect()}
    manifest = written["1", "manifest.json"]
    assert [d["id"] for d in manifest["documents"]] == ["1", "2", "4"] and len(manifest["withheld_records"]) == 1
    assert [f["path"] for f in manifest["documents"][0]["files"]] == ["actual/a.txt", "actual/b.txt"]
    assert written["1", "summary.json"]["methods"] == {"zip": 2, "files": 1} and written["1", "procurement.json"]["title"] == "T"
    kept = {r["pid"]: (r["members"], r["ok"], zipfile.ZipFile(io.BytesIO(bytes(r["content"]))).namelist()) for r in run["originals"].collect()}
    assert kept["1"] == (5, True, [*sorted(["actual/a.txt", f"actual/a-{one}.txt", "actual/b.txt", "archive/a.txt"]), "manifest.json"])
    assert sorted((r["key"], r["outcome"]) for r in lifecycle.account(run["outcomes"], targets).collect()) == [
        ("eis:1", "target"), ("eis:2", "target"), ("eis:2", "withdrawn"), ("eis:3", "failed"), ("eis:3", "target")
    ]
    entries = run["extracted"].filter("kind = 'markdown'").select(
        "pid", "original_sha256", "source", F.lit("actual").alias("section"), F.lit(None).cast("string").alias("original_file"),
        F.lit(None).cast("string").alias("record_title"), "record_id", F.lit(None).cast("string").alias("also_listed_under"),
        F.col("source").alias("markdown_path"), F.col("chars").alias("markdown_chars"), F.lit(0).alias("pos")
    )
    records = spark.createDataFrame(
        [],
        "pid string, id string, publish_date string, title string, type_code string, section string, withheld boolean, files map<string,string>"
    )
    now = lifecycle.state(run["facts"], records, entries, run["gaps"], "t", "p")
    before = {k: df.filter("false") for k, df in now.items()}
    assert [r["status"] for r in lifecycle.deliver(before, now)["changes"].collect()] == ["new"]
    same = lifecycle.deliver(now, now)
    assert same["changes"].first()["status"] == "unchanged" and same["send"].count() == 0
    assert lifecycle.deliver(now, now, targets.filter("pid = '2'").select("pid"))["changes"].count() == 0
    index = lifecycle.index_entries(run["facts"], entries, run["gaps"], spark.createDataFrame([], "pid string, key string, download string")).first()
    assert len(index["documents"]) == 4 and index["unreadable"] == [] and index["key"] == "EIS:1"


class Waits:
    """A platform whose pages say which process was asked."""

    def page(self, url):
        return f'__RequestVerificationToken ActualDocuments_items = [{{"Id": {os.getpid()}, "ShowDownloadIcon": false}}]; HistoricalDocuments_items = []; <label for="Name">Name</label><div>T</div>'


def test_fetch_streams(spark):
    """Many targets come in few batches, in as many tasks as the platform allows, and are asked once each."""
    from corpustide.plans import catalogue_packs
    from corpustide.sources import fetch

    targets = spark.range(1000).selectExpr("cast(id as string) target", "cast(id as string) pid", "cast(id as string) url", "cast(array() as array<string>) done")
    four = fetch.fetch(targets, "test_parts:Waits", pause=0.0, streams=4)
    assert four.rdd.getNumPartitions() == 4 and fetch.fetch(targets, "test_parts:Waits", pause=0.0).rdd.getNumPartitions() == 1
    assert four.filter("outcome = 'done'").select("pid").distinct().count() == 1000 == four.filter("withheld").count()
    one = fetch.fetch(targets.limit(300), "test_parts:Waits", pause=0.0).select("outcome")
    assert one.mapInPandas(lambda bs: (b.head(1).assign(outcome=str(len(b))) for b in bs), "outcome string").first()["outcome"] == "600"
    plan = catalogue_packs.fetch_outcomes(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1


def test_targets_without_ids_stay_apart(spark):
    """Targets that name no notice are not joined: their nulls would all meet in one task."""
    from corpustide.operators import links

    uuid = "0000abcd-0000-0000-0000-00000000000"
    targets = spark.range(800).select(F.when(F.col("id") < 4, F.concat(F.lit(uuid), F.col("id").cast("string"))).when(F.col("id") % 2 == 0, F.col("id").cast("string")).otherwise("x").alias("target"))
    known = spark.createDataFrame([(f"{uuid}1", "u1"), (f"{uuid}3", "u3")], "uuid string, url string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = links.target_urls(targets.repartition(4), known)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        rows = {r["target"]: r["url"] for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert max(sizes) < 400 and sum(sizes) == 800
    assert rows[f"{uuid}1"] == "u1" and rows[f"{uuid}0"] is None and rows["10"] == V.PLATFORM_PAGE + "10" and rows["x"] is None


def test_resumable_by_digest(spark):
    """Paths meet by their digests, however long; an entry without a path is not whole."""
    long = "actual/" + "x" * 500
    journal = spark.createDataFrame([("a", [(long, 1), ("b", 2)]), ("c", [("b", 3)]), ("d", [(None, 1)]), ("e", [("gone", 1)])], "id string, files array<struct<path: string, size: long>>")
    disk = spark.createDataFrame([(long, 1), ("b", 1), ("b", 2), (None, 1)], "path string, size long")
    got = keyed.resumable(journal, disk)
    assert [r["id"] for r in got.collect()] == ["a"]
    assert "hashpartitioning(_path" in got._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=9), st.binary(max_size=300)), max_size=6), st.integers(0, 2000), st.integers(0, 255))
def test_archives_are_plain(members, at, byte):
    """Small archives have zipfile's bytes without its work, and no damage passes that zipfile finds."""
    members = [(name.encode("utf-8", "ignore").decode(), data) for name, data in members]
    made, plain = publish.archive(members, last="z"), publish.PLAIN
    try:
        publish.PLAIN = 0  # all through zipfile
        assert made == publish.archive(members, last="z")
    finally:
        publish.PLAIN = plain
    assert publish.sound(made) and (publish._plainly_sound(made) or any("\0" in name for name, _ in members))
    harmed = bytearray(made)
    harmed[at % len(made)] = byte
    try:
        tested = zipfile.ZipFile(io.BytesIO(harmed)).testzip() is None
    except Exception:
        tested = False
    assert publish.sound(bytes(harmed)) == tested and not publish.sound(made[: len(made) // 2])


def test_archives_in_one_task(spark):
    """Packs follow one another in a task, without a call to Python for each; every pack is its own archive."""
    rows = [(f"p{k}", f"doc/{n}", bytes([k, n])) for k in range(50) for n in range(3)] + [("p7", "doc/1", bytes([7, 1]))]
    made = publish.archives(spark.createDataFrame(rows, "pid string, path string, content binary"))
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().executedPlan().toString()
    got = {r["pid"]: r for r in made.collect()}
    assert len(got) == 50 and all(r["members"] == 3 and r["sha256"] == hashlib.sha256(bytes(r["content"])).hexdigest() for r in got.values())
    assert bytes(got["p7"]["content"]) == publish.archive([(f"doc/{n}", bytes([7, n])) for n in range(3)])


def test_texts_are_handed_on():
    """A task hands long texts on before a batch of files has been read whole."""
    from corpustide.operators import extract

    long = [{"pid": str(k), "text": "x" * (3 << 20)} for k in range(7)]
    assert [len(f) for f in extract.frames(iter(long))] == [3, 3, 1] and [len(f) for f in extract.frames(iter([{"pid": "a"}] * 5), 2)] == [2, 2, 1]


def test_discovery(spark):
    from corpustide.plans import lifecycle

    kinds = "pos int, identifier string, externalId string, procurementIdentifier string, name string, organizationName string, organizationIdentifier string, publicationDate string, date string, amount string, currency string, cpvCodes array<struct<code: string, caption: string>>, type string, procedureType string, procedureLegalBasis string, euFund boolean"
    row = lambda n, uid, title, kind: (
        n, uid, None, None, title, None, None, "2026-01-01T10:00:00Z", None, "0", None, [("45000", "c")], kind, None, None, None
    )
    df = spark.createDataFrame(
        [row(0, "a", " Green ", "competition"), row(1, "b", "Other", "planning"), row(2, "c", "Green", "result"), row(3, "a", "Green again", "competition")],
        kinds
    )
    assert [r["title"] for r in lifecycle.discover(df, 3, 1, policy={"recall": ["green"], "prefixes": [], "excluded": []}).collect()] == ["Green"]
    assert lifecycle.discover(df, 3, 1, F.lit("2026-01-02 09:00:00")).count() == 2
    with pytest.raises(lifecycle.Incomplete):
        lifecycle.discover(df, 4, 1)
    with pytest.raises(lifecycle.Stale):
        lifecycle.discover(df, 3, 1, F.lit("2026-01-09 09:00:00"))
    with pytest.raises(lifecycle.Empty):
        lifecycle.discover(df.filter("false"), 0, 1)
    named = spark.createDataFrame([("eis:1",), ("5",)], "target string")
    assert lifecycle.overlap(spark.createDataFrame([("5",)], "target string"), named) == 1
    assert lifecycle.version_digest([__file__]) and lifecycle.version_digest(["/no/such"]) is None


def test_requests():
    from corpustide.sources import fetch

    answers, waits = [(429, {"Retry-After": "90"}, b""), (503, {}, b""), (200, {}, b'{"a": 1}')], []
    assert fetch.read_json(lambda: answers.pop(0), sleep=waits.append) == {"a": 1} and waits == [60.0, 2.0]
    assert fetch.read_json(lambda: (404, {}, b"")) is None and fetch.read_json(lambda: (200, {}, b"{torn")) is None
    with pytest.raises(RuntimeError):
        fetch.read_json(lambda: (403, {}, b""))
    parts, states = [], [200, 409, 200, 200]
    assert fetch.upload(b"x" * 25, lambda r, d: (parts.append((r, len(d))), states.pop(0))[1], single=5, chunk=10, sleep=lambda s: None) == 4
    assert parts == [((0, 10), 10), ((10, 20), 10), ((10, 20), 10), ((20, 25), 5)]
    with pytest.raises(RuntimeError):
        fetch.upload(b"x", lambda r, d: 400)
    assert fetch.pause_for(0) == 0.75 and fetch.pause_for(1 << 30) == 5.0 and fetch.pause_for(5, cap=0) == 0
