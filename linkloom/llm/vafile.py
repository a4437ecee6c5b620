"""Exact top-k inner products by vector-approximation files.

Equal vectors make up a class, with the smallest of their ids. Classes are written down twice: exactly, and as a file of cells, one byte
for each component, in blocks with the cells' ends. For a query, a cell gives a vector's score up to a radius that all
vectors of a block share. A scan of the cells alone gives each query the vectors whose highest possible score is no less
than the k-th best of the lowest possible ones. Of these, exact vectors are read in the order of their bounds: first the k
best, then those that may still reach the k-th exact score. Ties go to the smaller id.

Queries come in blocks too. Both are dealt to a grid, rows of query blocks and columns of cell blocks, and joined by equal places, so each
block of queries meets each block of cells once; a task holds a block of either and what it has found. Exact vectors are read in two steps, not one by one.

Cases: vectors that are null, or hold null, NaN or infinite components, take no part, neither do null ids.
Vectors of other lengths than the query's aren't compared with it. A query's own rows are those with its id.
Repeated query rows with the same vector are answered once, with another vector each on its own; other repeated rows count
each. A score beyond the range of a long is null and comes last. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import grid, materialize

#: Queries, and vectors, of a block.
QUERY_BLOCK, DATA_BLOCK = 2048, 4096
#: Cells of a component.
CELLS = 256
#: Candidates that a task holds for all of its queries before it sends them on.
HELD = 1_000_000


def quantised(column: str, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component; null if a vector takes no part."""
    x = F.transform(F.col(column), lambda v: v.cast("double"))
    fine = F.col(column).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.when(fine, F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")))


def classes(data: DataFrame, k: int) -> DataFrame:
    """key, v, ids: each different vector with its smallest ids, enough for any query: 2k, and no id more than k times. data: id, v."""
    each = data.withColumn("_nth", F.row_number().over(Window.partitionBy("v", "id").orderBy("id"))).where(F.col("_nth") <= k)
    first = each.withColumn("_nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("_nth") <= 2 * k)
    return first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.xxhash64("v").alias("key"), "v", "ids")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(length, first columns, vectors) of rows (some columns of longs, v) in blocks of one length."""
    held: dict[int, list] = {}
    rows = 0
    for batch in batches:
        lengths = batch.column(batch.num_columns - 1).value_lengths().to_numpy()
        flat, ends = batch.column(batch.num_columns - 1).flatten().to_numpy(), np.cumsum(lengths)
        for n in np.unique(lengths).tolist():
            own = np.flatnonzero(lengths == n)
            for at in range(0, len(own), size):
                some = own[at : at + size]
                held.setdefault(n, []).append(([batch.column(i).to_numpy()[some] for i in range(batch.num_columns - 1)], flat[(ends[some] - n)[:, None] + np.arange(n)].reshape(len(some), n)))
                rows += len(some)
                if rows >= size:
                    yield from _flushed(held, size)
                    rows = 0
    yield from _flushed(held, size)


def _flushed(held: dict[int, list], size: int) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    for n, parts in held.items():
        columns, vectors = [np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True)], np.concatenate([p[1] for p in parts])
        for at in range(0, len(vectors), size):
            yield n, [c[at : at + size] for c in columns], vectors[at : at + size]
    held.clear()


def cells_of(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each component's cell, the lowest value of its cell 0, and how many values a cell has, by component."""
    low, high = block.min(axis=0), block.max(axis=0)
    width = (high.astype(np.uint64) - low.astype(np.uint64)) // np.uint64(CELLS) + np.uint64(1)  # unsigned: no span is too wide
    return ((block.astype(np.uint64) - low.astype(np.uint64)) // width).astype(np.uint8), low, width.astype(np.int64)


def _cell_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (key, only id or null as -1 with a flag, v) as blocks."""
    for n, (keys, sole, owned), block in _blocks(batches, DATA_BLOCK):
        cells, low, width = cells_of(block)
        yield pa.RecordBatch.from_pylist([{"n": n, "keys": keys.tobytes(), "sole": sole.tobytes(), "owned": owned.tobytes(), "cells": cells.tobytes(), "low": low.tobytes(), "width": width.tobytes()}], schema=_CELLS)


_CELLS = pa.schema([("n", pa.int64()), *((c, pa.binary()) for c in ("keys", "sole", "owned", "cells", "low", "width"))])
CELL_FILE = "n long, keys binary, sole binary, owned binary, cells binary, low binary, width binary"
_ASKED = pa.schema([("asked_n", pa.int64()), ("block", pa.int64()), ("ids", pa.binary()), ("nos", pa.binary()), ("queries", pa.binary())])


def _query_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for n, (ids, nos), block in _blocks(batches, QUERY_BLOCK):
        name = int.from_bytes(hashlib.blake2b(ids.tobytes() + nos.tobytes(), digest_size=7).digest())  # only tells blocks apart in a task
        yield pa.RecordBatch.from_pylist([{"asked_n": n, "block": name, "ids": ids.tobytes(), "nos": nos.tobytes(), "queries": block.tobytes()}], schema=_ASKED)


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The middle of where each query's scores (rows) with each vector (columns) are, and how far they are from it at most, by query."""
    q = queries.astype(np.float64)
    middle = (q * width) @ cells.T.astype(np.float64) + (q @ (low + (width - 1) / 2))[:, None]
    radius = np.abs(q) @ ((width - 1) / 2)
    # what rounding may add
    size = np.abs(q) @ (np.abs(low) + width * CELLS)
    return middle, radius + size * (1e-15 * (queries.shape[1] + 8))


class Found:
    """The vectors that may be among the k best of each query of a block, of those seen so far."""

    def __init__(self, k: int, n: int):
        self.k, self.least, self.held = k, np.full((n, k), -np.inf), []  # the k best lowest scores

    def add(self, ids: np.ndarray, queries: np.ndarray, keys: np.ndarray, sole: np.ndarray, owned: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> None:
        middle, radius = bounds(queries, cells, low, width)
        middle[(ids[:, None] == sole[None, :]) & owned[None, :].astype(bool)] = -np.inf  # nothing but the query itself
        n = min(self.k, middle.shape[1])
        best = np.partition(middle, middle.shape[1] - n, axis=1)[:, middle.shape[1] - n :] - radius[:, None]
        self.least = np.sort(np.concatenate([self.least, best], axis=1), axis=1)[:, -self.k :]
        q, v = np.nonzero((middle + radius[:, None] >= self.least[:, :1]) & (middle > -np.inf))
        self.held.append((q, keys[v], middle[q, v] - radius[q], middle[q, v] + radius[q]))

    def rows(self) -> tuple[np.ndarray, ...]:
        q, keys, lowest, highest = (np.concatenate(c) for c in zip(*self.held, strict=True))
        some = highest >= self.least[q, 0]
        return q[some], keys[some], lowest[some], highest[some]


def _search(k: int):
    """Streams pairs of a block of cells and a block of queries: candidates of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, Found]] = {}

        def sent() -> Iterator[pa.RecordBatch]:
            for ids, nos, own in found.values():
                q, keys, lowest, highest = own.rows()
                own.held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[q], nos[q], keys, lowest, highest)], names=["query_id", "query_no", "key", "lowest", "highest"])
            found.clear()

        held = 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                n = row["n"].as_py()
                raw = lambda name, kind: np.frombuffer(row[name].as_buffer(), kind)  # noqa: E731, B023
                ids, keys = raw("ids", np.int64), raw("keys", np.int64)
                at = (n, row["block"].as_py())
                if at not in found:
                    found[at] = (ids.copy(), raw("nos", np.int64).copy(), Found(k, len(ids)))
                own = found[at][2]
                own.add(ids, raw("queries", np.int64).reshape(len(ids), n), keys, raw("sole", np.int64), raw("owned", np.int8), raw("cells", np.uint8).reshape(len(keys), n), raw("low", np.int64), raw("width", np.int64))
                held += len(own.held[-1][0])
                if held > HELD:
                    for *_, each in found.values():  # what later blocks have shown to be too low goes
                        each.held = [each.rows()] if each.held else []
                    held = sum(len(h[0]) for *_, each in found.values() for h in each.held)
                    if held > HELD // 2:
                        yield from sent()
                        held = 0
        yield from sent()

    return run


def top_k(df: DataFrame, k: int = 5, every: int = 50, id: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, its k best among all other rows."""
    data = df.select(F.col(id).cast("long").alias("id"), quantised(vector, scale).alias("v")).where("id is not null and v is not null")
    exact = materialize(classes(data, k), "exact-vectors")
    one = F.array_min("ids") == F.array_max("ids")
    sole = exact.select("key", F.col("ids")[0].alias("sole"), one.cast("byte").alias("owned"), "v")
    cells = materialize(sole.mapInArrow(_cell_file, CELL_FILE), "cells")
    asked = materialize(data.where(F.col("id") % every == 0).distinct().select("id", F.xxhash64("v").alias("no"), "v"), "queries")  # an id may have several vectors
    blocks = materialize(asked.mapInArrow(_query_file, "asked_n long, block long, ids binary, nos binary, queries binary"), "query-blocks")
    met = grid(blocks, cells, F.col("block"), F.xxhash64("keys")).where("n = asked_n")
    seen = materialize(met.mapInArrow(_search(k), "query_id long, query_no long, key long, lowest double, highest double"), "candidates").dropDuplicates(["query_id", "query_no", "key"])
    own = Window.partitionBy("query_id", "query_no")
    # each task has sent a few rows a query; the k-th best lowest score of all tells which of them may still count
    ranked = seen.withColumn("nth", F.row_number().over(own.orderBy(F.desc("lowest"), "key")))
    least = F.max(F.when(F.col("nth") == k, F.col("lowest"))).over(own)
    may = materialize(ranked.withColumn("least", least).where("least is null or highest >= least").withColumn("nth", F.row_number().over(own.orderBy(F.desc("highest"), "key"))).select("query_id", "query_no", "key", "highest", "nth"), "candidates-left")
    named = asked.select(F.col("id").alias("query_id"), F.col("no").alias("query_no"), F.col("v").alias("q"))
    read = lambda some: _scores(some, exact, named)
    first = materialize(read(may.where(F.col("nth") <= k)), "scores")
    # of a query with k scores at least, the k-th: what can't reach it isn't read
    rank = F.row_number().over(Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id"))
    sure = first.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", "query_no", F.col("score").alias("sure"))
    rest = may.where(F.col("nth") > k).join(sure, ["query_id", "query_no"], "left").where("sure is null or highest >= sure")
    found = first.unionByName(read(rest.select("query_id", "query_no", "key")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scores(some: DataFrame, exact: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, query_no, vec_id, score of candidates (query_id, query_no, key), from their exact vectors."""
    both = some.select("query_id", "query_no", "key").join(exact, "key").join(queries, ["query_id", "query_no"]).where(F.size("v") == F.size("q"))
    score = F.aggregate(F.zip_with("v", "q", lambda a, b: F.try_multiply(a, b)), F.lit(0).cast("long"), lambda a, x: F.try_add(a, x))
    ids = F.filter("ids", lambda x: x != F.col("query_id"))
    return both.select("query_id", "query_no", score.alias("score"), F.explode(ids).alias("vec_id")).select("query_id", "query_no", "vec_id", "score")
