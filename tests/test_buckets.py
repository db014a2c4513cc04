"""States in buckets: the same answer, and nothing of the old state is moved."""

import re

from pyspark.sql import functions as F

from corpustide.operators import buckets, diff
from corpustide.plans import catalogue, demo_views

SF = "/root/testdata/sf0.001"


def moved_above(df, table):
    """Exchanges that stand above each scan of a table whose name holds ``table``."""
    path, out = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        node = line.lstrip(" :+-")
        if node:
            depth = len(line) - len(node)
            path = [x for x in path if x[0] < depth] + [(depth, node)]
            if "FileScan" in node and table in node:
                out.append([n for _, n in path if re.match("(Broadcast)?Exchange", n)])
    return out


def _rows(df):
    return sorted(str(r) for r in df.collect())


def test_no_row_of_the_old_state_moves(spark):
    for name, scans in (("docs_to_send", 2), ("change_summary", 5)):
        found = moved_above(catalogue.QUERIES[name](spark, SF), "yesterday_")
        assert len(found) >= scans and not any(found), name


def test_same_as_without_buckets(spark, tmp_path):
    previous, current = demo_views.states(spark, SF)
    name = buckets.new_name()
    buckets.save(previous, name, 3, str(tmp_path))
    assert buckets.buckets_of(spark, name) == 3
    kept, dealt = buckets.load(spark, name), buckets.dealt(current, 3)
    assert _rows(diff.diff(kept, dealt)) == _rows(diff.diff(previous, current))
    assert _rows(diff.sendable(kept, dealt)) == _rows(diff.documents_to_send(diff.diff(previous, current), current["documents"]))
    # another application finds the tables by their place
    again = buckets.new_name()
    ddl = {kind: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) for kind, df in kept.items()}
    buckets.attach(spark, ddl, again, str(tmp_path), 3)
    found = diff.sendable(buckets.load(spark, again), dealt)
    assert _rows(found) == _rows(diff.sendable(kept, dealt)) and not any(moved_above(found, again))
    buckets.drop(spark, again)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(again)]


def test_today_becomes_yesterday(spark, tmp_path):
    """A day's state is stored as it was dealt out; against itself nothing moves."""
    _, current = demo_views.states(spark, SF)
    name = buckets.new_name()
    buckets.save(buckets.dealt(current, 4), name, 4, str(tmp_path))
    kept = buckets.load(spark, name)
    changes = diff.diff(kept, kept)
    assert changes.filter("status <> 'unchanged'").count() == 0 and diff.sendable(kept, kept).count() == 0
    assert not any(moved_above(changes, name))


def test_rows_of_nulls_and_empty_states(spark):
    """A row whose values are all null is there; an empty side makes all new, or nothing."""
    kinds = "pid string, field string, value string"
    heads = "pid string, tool string, parser string, language string"
    a, none = spark.createDataFrame([("a", "title", None)], kinds), spark.createDataFrame([], kinds)
    items = spark.createDataFrame([("a", None, None, None)], heads)
    assert diff.both(a, a, ["pid", "field"]).filter("p is not null and c is not null").count() == 1
    got = diff.heads(items, items).collect()[0]
    assert not got["new"] and not got["reextracted"]
    assert diff.heads(spark.createDataFrame([], heads), items).collect()[0]["new"]
    assert diff.heads(items, spark.createDataFrame([], heads)).count() == 0
    assert diff.fact_moves(none, a, diff.heads(items, items)).count() == 0  # null before and after
    assert diff.key_moves(none.select("pid", F.col("field").alias("key")), a.select("pid", F.col("field").alias("key"))).collect()[0]["added"] == ["title"]


def test_lines_are_moved_once(spark):
    """Both states read the line items where they were dealt to, and a stored state has the columns that are compared."""
    for name in ("publishable_only", "publishable_changes", "docs_to_send"):
        found = moved_above(catalogue.QUERIES[name](spark, SF), "kept_")
        assert found and not any(found), name
    name, _ = catalogue._STORED[spark.sparkContext.applicationId, SF]
    assert spark.table(f"{name}_documents").columns == ["pid", "key"]
    assert demo_views.kept(spark, SF)[1] >= 4


def test_packs_are_not_moved(spark):
    """What is put into an archive of originals, and its manifest, are read where they lie by pack: nothing is exchanged above the stored rows."""
    plan = catalogue.QUERIES["original_archives"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert "Exchange" not in catalogue.QUERIES["pack_manifests"](spark, SF)._jdf.queryExecution().executedPlan().toString()
