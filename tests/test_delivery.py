"""Deliveries: whole or not at all, whatever fails between two steps."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpustide.sources import delivery

KINDS = "pid string, path string, content binary"


def _files(spark, **files):
    return spark.createDataFrame([(p.split("_")[0], p, c.encode()) for p, c in files.items()], KINDS)


def _seen(spark, root):
    rows = delivery.contents(spark, root).collect()
    assert all(r["whole"] for r in rows)
    return {r["path"]: (bytes(r["content"]).decode(), r["run"]) for r in rows}


def test_new_on_top_of_old(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    assert delivery.latest(spark, root) is None and _seen(spark, root) == {}
    v = delivery.deliver(spark, root, "r1", [("docs", _files(spark, a_1="x", a_2="y")), ("index", _files(spark, a_i="[1]"))])
    assert (v["number"], v["entries"], v["bytes"], v["runs"]) == (1, 3, 5, ["r1"])
    v = delivery.deliver(spark, root, "r2", [("docs", _files(spark, a_2="z", b_1="q"))])
    assert _seen(spark, root) == {"a_1": ("x", "r1"), "a_2": ("z", "r2"), "a_i": ("[1]", "r1"), "b_1": ("q", "r2")}
    # what stays is not written again
    staged = spark.read.parquet(f"{root}/stage/run=r2")
    assert sorted(r["path"] for r in staged.select("path").collect()) == ["a_2", "b_1"]
    keep = spark.createDataFrame([("a", "a_1")], "pid string, path string")
    delivery.deliver(spark, root, "r3", [], keep=keep)
    assert _seen(spark, root) == {"a_1": ("x", "r1")}
    assert set(delivery.clear(spark, root)) >= {"stage/run=r2", "manifests/r1", "manifests/r2", "versions/000000000001.json"}
    assert _seen(spark, root) == {"a_1": ("x", "r1")} and delivery.clear(spark, root) == []
    with pytest.raises(ValueError):
        delivery.deliver(spark, root, "r1", [])


def test_a_task_dies_between_two_steps(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    delivery.deliver(spark, root, "r1", [("docs", _files(spark, a_1="x")), ("index", _files(spark, a_i="1"))])
    before = _seen(spark, root)
    dying = _files(spark, a_i="2", b_i="3").withColumn("content", F.when(F.col("pid") == "b", F.raise_error(F.lit("killed")).cast("binary")).otherwise(F.col("content")))
    during = []
    with pytest.raises(Exception, match="killed"):
        delivery.deliver(spark, root, "r2", [("docs", _files(spark, a_1="new", b_1="b")), ("index", dying)], between=lambda step: during.append((step, _seen(spark, root))))
    assert during == [("docs", before)] and _seen(spark, root) == before
    assert not (tmp_path / "out/stage/run=r2").exists() and not (tmp_path / "out/manifests/r2").exists()
    delivery.deliver(spark, root, "r2", [("docs", _files(spark, a_1="new"))])
    assert _seen(spark, root) == {"a_1": ("new", "r2"), "a_i": ("1", "r1")}


def test_a_driver_killed_before_the_move(spark, tmp_path, monkeypatch):
    """Nothing is cleared then, and readers still see the old delivery, until somebody clears what was left."""
    root = f"file://{tmp_path}/out"
    delivery.deliver(spark, root, "r1", [("docs", _files(spark, a_1="x"))])

    def killed(step):
        if step == "manifest":
            raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(delivery.Store, "remove", lambda self, name: None)
        with pytest.raises(KeyboardInterrupt):
            delivery.deliver(spark, root, "r2", [("docs", _files(spark, a_1="y"))], between=killed)
    assert (tmp_path / "out/manifests/r2").exists() and _seen(spark, root) == {"a_1": ("x", "r1")}
    assert set(delivery.clear(spark, root)) == {"stage/run=r2", "manifests/r2"} and _seen(spark, root) == {"a_1": ("x", "r1")}


def test_one_of_two_at_a_time(spark, tmp_path):
    """The one that began first and ends last is refused, and what the other delivered stays."""
    root = f"file://{tmp_path}/out"

    def other(step):
        if step == "docs":
            delivery.deliver(spark, root, "fast", [("docs", _files(spark, a_1="fast"))])

    with pytest.raises(delivery.Superseded):
        delivery.deliver(spark, root, "slow", [("docs", _files(spark, a_1="slow"))], between=other)
    assert _seen(spark, root) == {"a_1": ("fast", "fast")} and not (tmp_path / "out/stage/run=slow").exists()


def test_damage_is_seen(spark, tmp_path):
    root = f"file://{tmp_path}/out"
    delivery.deliver(spark, root, "r1", [("docs", _files(spark, a_1="x"))])
    spark.createDataFrame([("a", "a_1", b"forged", "0")], delivery.FILE).write.mode("overwrite").parquet(f"{root}/stage/run=r1/step=docs")
    assert [r["whole"] for r in delivery.contents(spark, root).collect()] == [False]


def test_steps_of_a_publication(spark, tmp_path):
    root, docs = f"file://{tmp_path}/out", _files(spark, a_1="x", a_2="y", b_1="z")
    seen = spark.createDataFrame([("a", "d1", None)], "pid string, first_seen string, last_change string")
    order = []
    steps = delivery.files_of("r1", docs, seen, seen.select("pid"), seen.select("pid"), shard=2)
    delivery.deliver(spark, root, "r1", steps, between=order.append)
    assert order == ["1-documents", "2-index", "3-state", "4-seen", "5-run", "6-changes", "7-day", "manifest"]
    got = _seen(spark, root)
    assert [d["path"] for d in json.loads(got["a/index.json"][0])["documents"]] == ["a_1", "a_2"]
    assert json.loads(got["a/seen.json"][0]) == {"pid": "a", "first_seen": "d1", "last_change": None}
    assert json.loads(got["shard-2/day.json"][0]) == {"state": "r1", "shard": 2} and got["a/a_1"][0] == "x"
    assert set(Path(f"{tmp_path}/out").iterdir()) == {tmp_path / "out" / n for n in ("stage", "manifests", "versions")}
