"""Which page brings in which new address.

Pages come in order of page_id. A page brings in its addresses in the order in which they were found: what an earlier page of the
session brought in and what is known already doesn't count, and after `most` new ones it stops. What it leaves
over may come in by a later page.

That order is a queue by nature, but only pages with more than `most` addresses (full ones) ever leave any over. Any other page
brings in all that is left of its own; so an address is there from the first such page on, and full pages can only bring it
in before. What full pages fight for is all that needs a queue. It's worked out within tasks: of a whole session where that is
small enough, else of each connected component of full pages and their addresses. A component that is too large for a task is
worked out by joins, in rounds: each address asks the earliest page that hasn't turned it down, and each
page keeps the first `most` that ask; turned down once, an address never comes back to that page.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.graph import components
from linkloom.storage import discard, materialize
from linkloom.workers import sparing

#: Rows of a queue that a task holds at most, as numbers: some 100 bytes each.
HELD = 4_000_000


def unknown(targets: DataFrame, site_nodes: DataFrame) -> DataFrame:
    """Targets whose uri isn't known in their session. site_nodes: session_id, uri; if it is a table of save_tree(), only targets are shuffled."""
    return targets.join(site_nodes.select("session_id", "uri"), ["session_id", "uri"], "left_anti")


def save_tree(site_nodes: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Writes what is known as a table in buckets of (session_id, uri), sorted, for a tree that is larger than what is looked up in it.

    Each run then brings its targets to the buckets, rather than the tree to them; take about as many buckets as a run has partitions.
    """
    known = site_nodes.select("session_id", "uri").distinct().repartition(buckets, "session_id", "uri")
    writer = known.write.bucketBy(buckets, "session_id", "uri").sortBy("session_id", "uri").format("parquet")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return site_nodes.sparkSession.table(table)


def first_pages(targets: DataFrame, scope: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """One row for each session and address: where it was found first."""
    order = F.min_by(F.struct(*(c for c in targets.columns if c not in (*scope, "resolved"))), F.struct("page_id", "place")).alias("first")
    return targets.groupBy(*scope, "resolved").agg(order).select(*scope, "resolved", "first.*")


def capped(targets: DataFrame, most: int, scope: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """The rows of targets that come in, each address once a session (or whatever else `scope` says)."""
    page = [*scope, "page_id"]
    targets = materialize(targets, "targets")  # the search behind it is dear, its links are few
    asked = targets.groupBy(*page, "resolved").agg(F.min("place").alias("place"))
    full = materialize(asked.groupBy(*page).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(*page), "full-pages")
    if full.isEmpty():
        return targets.join(first_pages(asked, scope), [*page, "resolved", "place"], "left_semi")
    sure = materialize(first_pages(asked.join(full, page, "left_anti"), scope), "sure")
    by = sure.select(*scope, "resolved", F.col("page_id").alias("_sure"))
    fought = asked.join(full, page, "left_semi").join(by, [*scope, "resolved"], "left").where("_sure is null or page_id < _sure").drop("_sure")
    won = materialize(queued(fought, most, scope), "won")
    came = won.unionByName(sure.join(won, [*scope, "resolved"], "left_anti"))
    return targets.join(came, [*page, "resolved", "place"], "left_semi")


def queued(asked: DataFrame, most: int, scope: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """The rows (scope, page_id, resolved, place) that come in by the queue alone. asked: each page and address once."""
    page = [*scope, "page_id"]
    no = F.row_number().over(Window.partitionBy(*page).orderBy("place", "resolved"))
    numbers = materialize(asked.groupBy(*scope, "resolved").agg(F.count(F.lit(1)).alias("_n")).select(*scope, "resolved", F.monotonically_increasing_id().alias("_address")), "addresses")
    ranked = materialize(asked.select(*page, "resolved", "place").withColumn("no", no).join(numbers, [*scope, "resolved"]), "queue")
    large = ranked.groupBy(*scope).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HELD).select(*scope)
    large = materialize(large, "large-queues")
    if large.isEmpty():
        return _within_tasks(ranked.withColumn("_group", F.xxhash64(*scope)), most, scope)
    small = ranked.join(large, list(scope), "left_anti").withColumn("_group", F.xxhash64(*scope))
    own = ranked.join(large, list(scope), "left_semi").withColumn("_page", F.xxhash64(F.lit("page"), *page))
    # nodes that are one by chance make a component larger, and nothing else
    parts = components(own.select(F.col("_page").alias("a"), F.xxhash64(F.lit("address"), *scope, "resolved").alias("b")))
    placed = materialize(own.join(parts.select(F.col("node").alias("_page"), F.col("root").alias("_group")), "_page").drop("_page"), "queue-parts")
    crowds = materialize(placed.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HELD).select("_group"), "large-parts")
    solved = _within_tasks(small.unionByName(placed.join(crowds, "_group", "left_anti")), most, scope)
    if crowds.isEmpty():
        return solved
    return solved.unionByName(_in_rounds(placed.join(crowds, "_group", "left_semi").drop("_group", "no", "_address"), most, scope))


def _within_tasks(ranked: DataFrame, most: int, scope: tuple[str, ...]) -> DataFrame:
    """The queue of each _group of ranked rows, in one task, which gets no text: addresses are numbers there.

    A task goes through its groups one after another, in batches; it holds the addresses that came in the group that it is in."""
    row = [*scope, "page_id", "no"]

    def queue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, there, taken = None, set(), 0
        for batch in batches:
            came, columns = array("q"), (batch.column(c).to_pylist() for c in ("_group", "no", "_address"))
            for i, (g, n, a) in enumerate(zip(*columns, strict=True)):
                if g != group:
                    group, there = g, set()
                if n == 1:  # a page begins
                    taken = 0
                if taken < most and a not in there:
                    there.add(a)
                    taken += 1
                    came.append(i)
            yield batch.select(row).take(pa.array(np.frombuffer(came, np.int64)))

    sorted_ = ranked.select(*row, "_address", "_group").repartition("_group").sortWithinPartitions("_group", *row)
    came = sorted_.mapInArrow(sparing(queue), ranked.select(*row).schema)
    return ranked.join(came, row, "left_semi").select(*scope, "page_id", "resolved", "place")


def _in_rounds(asked: DataFrame, most: int, scope: tuple[str, ...]) -> DataFrame:
    """The queue of rows that no task could hold."""
    page, refused = [*scope, "page_id"], None
    while True:
        left = asked if refused is None else asked.join(refused, [*page, "resolved"], "left_anti")
        rank = F.row_number().over(Window.partitionBy(*page).orderBy("place", "resolved"))
        ranked = materialize(first_pages(left, scope).withColumn("rank", rank), "ranked")
        over = ranked.where(F.col("rank") > most).select(*page, "resolved")
        if over.isEmpty():
            return ranked.select(*page, "resolved", "place")
        done = [ranked] if refused is None else [ranked, refused]
        refused = materialize(over if refused is None else refused.unionByName(over), "refused")
        discard(*done)
