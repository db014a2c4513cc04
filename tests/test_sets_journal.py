"""Sets of keys as bitmaps, journals in segments, and coverage measured while writing."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from corpustide.operators import keysets, planning
from corpustide.sources import journal


def _keys(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "key string")


def test_sets_against_python(spark):
    rng = random.Random(2)
    pool = [f"eis:{n}" for n in [0, 1, 32767, 32768, 32769, 65536, 10**15, 2**53 - 1, 2**53, 2**53 + 1, 10**17, 7, 8]]
    pool += ["eis:07", "eis:", "eis:x", "iub:a", "iub:A", "iub:", "", "eis:-1", *[f"eis:{rng.randint(0, 10**6)}" for _ in range(60)]]
    for _ in range(4):
        a, b, c = ([rng.choice([*pool, None]) for _ in range(rng.randint(0, 120))] for _ in range(3))
        x, y, z = (keysets.keyset(_keys(spark, k).repartition(3)) for k in (a, b, c))
        sa, sb, sc = (set(k) - {None} for k in (a, b, c))
        assert keysets.sizes(x=x, y=y, u=keysets.union(x, y, z)).first().asDict() == {"x": len(sa), "y": len(sb), "u": len(sa | sb | sc)}
        assert keysets.overlap(x, y).first()["n"] == len(sa & sb)
        row = keysets.coverage(x, y, z).first().asDict()
        assert row == {"targets": len(sa), "delivered": len(sc), "excused": len(sa & sb), "unaccounted": len(sa - sb - sc)}


def test_sets_in_any_order_of_shards(spark):
    keys = [f"eis:{k * 37 % 90001}" for k in range(3000)] + [f"iub:{k}" for k in range(50)]
    parts = [keysets.keyset(_keys(spark, keys[k::4])) for k in range(4)]
    left = keysets.union(keysets.union(parts[0], parts[1]), keysets.union(parts[2], parts[3]))
    right = keysets.union(parts[3], keysets.union(parts[2], keysets.union(parts[1], parts[0])))
    assert sorted(map(str, left.collect())) == sorted(map(str, right.collect()))
    assert left.agg(keysets.size(left).alias("n")).first()["n"] == len(set(keys))
    empty = keysets.keyset(_keys(spark, []))
    assert keysets.coverage(empty, empty, empty).first().asDict() == {"targets": 0, "delivered": 0, "excused": 0, "unaccounted": 0}


SCHEMA = "id string, v long"


def _entries(spark, *rows):
    return spark.createDataFrame([(i, v, k) for k, (i, v) in enumerate(rows)], "id string, v long, pos long")


def _state(spark, root):
    return {r["id"]: r["v"] for r in journal.last(spark, root, SCHEMA).collect()}


def test_journal(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    assert _state(spark, root) == {} and journal.compact(spark, root) is None
    assert journal.append(_entries(spark, ("a", 1), ("b", 1), ("a", 2), (None, 9)).repartition(3), root, 0)
    assert journal.append(_entries(spark, ("b", 5)), root, 1)
    assert not journal.append(_entries(spark, ("b", 6)), root, 1) and _state(spark, root) == {"a": 2, "b": 5}
    # a segment that was broken off is passed over, then written anew by the replay
    journal.append(_entries(spark, ("a", 7)), root, 2)
    (Path(tmp_path) / "log/segments/000000000002/_SUCCESS").unlink()
    assert _state(spark, root) == {"a": 2, "b": 5}
    assert journal.append(_entries(spark, ("a", 8)), root, 2) and _state(spark, root) == {"a": 8, "b": 5}
    # torn lines
    torn = spark.createDataFrame([('{"batch": 3, "pos": 0, "entry": "{\\"id\\": \\"a\\", \\"v\\"',), ("",), ("x",)], "value string")
    torn.write.text(f"{root}/segments/000000000003")
    assert _state(spark, root) == {"a": 8, "b": 5}
    assert journal.compact(spark, root) == 3 and journal.compact(spark, root) is None
    assert _state(spark, root) == {"a": 8, "b": 5} and journal.lines(spark, root).count() == 2
    assert not journal.append(_entries(spark, ("b", 0)), root, 1)  # what a base holds is not added again
    journal.append(_entries(spark, ("b", 9), ("c", 1)), root, 4)
    assert journal.compact(spark, root) == 4 and _state(spark, root) == {"a": 8, "b": 9, "c": 1}
    assert sorted(p.name for p in (Path(tmp_path) / "log").glob("*/*")) == ["000000000004"]


def test_journal_of_a_stream(spark, tmp_path):
    """A stream that is started again from its checkpoint adds each batch once."""
    root, at = f"file://{tmp_path}/log", str(tmp_path / "in")
    for k in range(3):
        _entries(spark, ("a", k), (f"id{k}", k)).coalesce(1).write.mode("append").parquet(at)
        rows = spark.readStream.schema("id string, v long, pos long").parquet(at)
        sink = lambda df, n: journal.append(df, root, n)
        rows.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    for name in ("2", ".2.crc"):
        (Path(tmp_path) / "cp/commits" / name).unlink()  # the last batch was not committed, so it comes again
    rows.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert _state(spark, root) == {"a": 2, "id0": 0, "id1": 1, "id2": 2} and journal.lines(spark, root).count() == 6


def test_observed_coverage(spark, tmp_path):
    rows = spark.createDataFrame(
        [(3, "a", None, "late"), (1, "a", "x", "first"), (2, None, "b", "b"), (4, "", "b", "again"), (5, None, None, "none"), (6, "", "", "none2")],
        "pos int, identifier string, externalId string, v string"
    )
    got = planning.observed_coverage(rows, 3, 2, str(tmp_path / "out"), ["pos"]).first().asDict()
    assert got == {"expected": 3, "unique": 3, "pages": 2, "drift": 0, "proven": True, "rows": 6}
    assert {r["v"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"first", "b", "none"}
    plain = planning.coverage(rows, 4, 2).first().asDict()
    again = planning.observed_coverage(rows, 4, 2, str(tmp_path / "out2"), ["pos"]).first().asDict()
    assert {k: again[k] for k in plain} == plain and not again["proven"]
    none = planning.observed_coverage(rows.filter(F.lit(False)), 0, 1, str(tmp_path / "none"), ["pos"]).first()
    assert none["unique"] == 0 and none["rows"] == 0 and none["proven"]
