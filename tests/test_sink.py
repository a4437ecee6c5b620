"""A table of batches."""

import pytest
from pyspark.sql import functions as F

from linkloom.operators import dedupe, report
from linkloom.streaming import sink


def ids(df):
    return sorted((r["batch"], r["x"]) for r in df.collect())


def test_readers_see_whole_batches(spark, tmp_path, monkeypatch):
    own = str(tmp_path / "t")
    assert sink.read(spark, own, "x long").count() == 0
    rows = lambda *xs: spark.createDataFrame([(x,) for x in xs], "x long")
    sink.write(rows(1, 2), own, 0)
    reader = sink.read(spark, own, "x long")
    enter = sink._enter
    monkeypatch.setattr(sink, "_enter", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        sink.write(rows(3, 4), own, 1)  # written, but not entered
    assert ids(sink.read(spark, own, "x long")) == [(0, 1), (0, 2)]
    monkeypatch.setattr(sink, "_enter", enter)
    for _ in range(2):  # it comes again, and again
        sink.write(rows(3, 4), own, 1)
        assert ids(sink.read(spark, own, "x long")) == [(0, 1), (0, 2), (1, 3), (1, 4)]
    assert ids(reader) == [(0, 1), (0, 2)] and ids(sink.read(spark, own, "x long", before=1)) == [(0, 1), (0, 2)]
    sink.compact(spark, own, "x long")
    sink.write(rows(5), own, 2)
    sink.write(rows(3, 4), own, 1)  # is in the compacted files
    want = [(0, 1), (0, 2), (1, 3), (1, 4), (2, 5)]
    assert ids(sink.read(spark, own, "x long")) == want and ids(reader) == [(0, 1), (0, 2)]
    assert sink.vacuum(spark, own) == 0
    assert sink.vacuum(spark, own, 0) == 5 and ids(sink.read(spark, own, "x long")) == want


def test_many_batches_as_few_files(spark, tmp_path):
    own = str(tmp_path / "t")
    for k in range(25):
        sink.write(spark.range(k, k + 1).coalesce(1).withColumnRenamed("id", "x"), own, k)
        if k % 10 == 9:
            sink.compact(spark, own, "x long")
    found = sink.read(spark, own, "x long")
    assert len(found.inputFiles()) == 6 and ids(found) == [(k, k) for k in range(25)] and ids(sink.read(spark, own, "x long", before=12)) == [(k, k) for k in range(12)]


def test_a_large_tree_is_not_moved(spark, tmp_path):
    """Only targets are shuffled, and what is left is what a plain anti-join leaves."""
    known = spark.range(5000).select((F.col("id") % 3).alias("session_id"), F.concat(F.lit("u"), F.col("id") % 700).alias("uri"))
    targets = spark.range(900).select((F.col("id") % 4).alias("session_id"), F.concat(F.lit("u"), "id").alias("uri"), F.col("id").alias("page_id"))
    tree = dedupe.save_tree(known, "known_tree", 4, str(tmp_path / "tree"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = dedupe.unknown(targets, tree)
        plan = found._jdf.queryExecution().executedPlan().toString()
        rows = sorted(tuple(r) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert rows == sorted(tuple(r) for r in dedupe.unknown(targets, known).collect()) and 0 < len(rows) < 900
    spark.sql("drop table known_tree")


def test_sketches_can_be_merged_later(spark):
    """Rolled up from sketches of two parts, counts are those of both together."""
    rows = [(s, p, f"h{p % 3}.com", f"http://h{p % 3}.com/{'ab'[k % 2]}/x{k}") for s in range(2) for p in range(300) for k in range(3)]
    df = spark.createDataFrame(rows, "session_id long, page_id long, host string, resolved string")
    parts = report.sketched(df.where("page_id < 200")).unionByName(report.sketched(df.where("page_id >= 100 and page_id < 300")))
    found = {tuple(r[c] for c in (*report.LEVELS, "level")): r["n_pages"] for r in report.rolled_up(parts).collect()}
    assert len(found) == 2 * 3 * 2 + 2 * 3 + 2 + 1
    for key, n in {(None, None, None, 3): 300, (0, None, None, 2): 300, (1, "h2.com", None, 1): 100, (0, "h0.com", "/b/", 0): 100}.items():
        assert abs(found[key] - n) <= 0.05 * n
    assert [r["f"] for r in spark.createDataFrame([(u,) for u in ("http://h/a/b", "http://h", "http://h/", "http://h/a", "http://h?x/y", "http://h/a/")], "u string").select(report.folder(F.col("u")).alias("f")).collect()] == ["/a/", "", "/", "/", "", "/a/"]
