"""Large queues."""

from pyspark.sql import functions as F

from linkloom import graph
from linkloom.operators import dedupe


def test_a_session_of_600_000_asks_is_one_task(spark, monkeypatch):
    """Without parts and rounds, which write a table for each of dozens of steps; each page asks for ten of the next addresses and keeps two."""
    monkeypatch.setattr(graph, "components", None)
    monkeypatch.setattr(dedupe, "components", None)
    monkeypatch.setattr(dedupe, "_in_rounds", None)
    asks = spark.range(60_000).select(F.lit(0).cast("long").alias("session_id"), F.col("id").alias("page_id"), F.posexplode(F.sequence("id", F.col("id") + 9)).alias("place", "a"))
    came = dedupe.queued(asks.withColumn("resolved", F.concat(F.lit("http://h/"), "a")), 2)
    want, at = set(), 0  # what is left begins after what the pages before took
    for page in range(60_000):
        for a in [a for a in range(max(page, at), page + 10)][:2]:
            want.add((page, f"http://h/{a}"))
            at = a + 1
    assert {(r["page_id"], r["resolved"]) for r in came.collect()} == want


def test_many_small_sessions_share_a_task(spark):
    """A group is no call of its own: its rows come in batches, which begin and end anywhere."""
    asks = spark.range(400).select((F.col("id") % 100).alias("session_id"), F.col("id").alias("page_id"), F.posexplode(F.sequence("id", F.col("id") + 900, F.lit(100))).alias("place", "a"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        came = dedupe.queued(asks.withColumn("resolved", F.concat(F.lit("http://h/"), "a")), 3)
        found = sorted((r["session_id"], r["page_id"], int(r["resolved"][9:])) for r in came.collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    # a session's first page takes its first three; each further one goes on where the one before stopped
    assert found == sorted((s, s + 100 * k, s + 100 * (3 * k + i)) for s in range(100) for k in range(4) for i in range(3))
    assert "FlatMapGroups" not in came._jdf.queryExecution().toString()
