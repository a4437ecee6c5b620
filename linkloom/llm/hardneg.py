"""Hard negatives by a vector-approximation file.

Rows that agree in label and vector make up a class. Of each class the file has the cell of each component, one byte, in
blocks. For an anchor, a table gives what each cell of each component adds to the score at least; looked up and
added up, they bound the scores of all of a block from below, and from above by a width that the block shares. Exact vectors
are read only of classes that, by these bounds, may be among the first in one of the anchor's windows of scores.

The file is scanned twice: for positives (the same label; the window is all scores), and for negatives (another
label; a window for each positive, from `low` to `high` percent of its score). Of what surely lies in a window, the k-th
highest lower bound tells what else may count: first within a task, then over all of them.

Blocks of anchors and blocks of cells are dealt to a grid: rows i of anchors, columns j of cells, joined by equal (i, j), so that each
block of anchors meets each block of cells once; a task holds one of either and what it has found.

Cases: rows with a null id, label or vector, or with null, NaN or infinite components, take no part. Vectors of other lengths than the
anchor's aren't compared with it. An anchor's own rows are those with its id. An id with several vectors or labels is an
anchor with each on its own; equal anchor rows are one. Other repeated rows count each. Scores beyond a long
count as out of all windows. A positive without negatives has no rows. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import grid, materialize, split_join
from linkloom.llm.vafile import CELLS, _blocks, cells_of, quantised

#: Anchors, and classes, of a block; anchors that are looked up at once.
ANCHOR_BLOCK, DATA_BLOCK, AT_ONCE = 512, 4096, 16
#: Candidates that a task holds before it sends them on.
HELD = 500_000
#: No window reaches beyond.
WIDEST = 2**63 - 1


def classes(rows: DataFrame, k: int) -> DataFrame:
    """key, label, v, ids: each different (label, vector) with enough of its smallest ids for any anchor: 2k, and no id more than k times."""
    each = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("label", "v", "id").orderBy("id"))).where(F.col("_nth") <= k)
    first = each.withColumn("_nth", F.row_number().over(Window.partitionBy("label", "v").orderBy("id"))).where(F.col("_nth") <= 2 * k)
    return first.groupBy("label", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(F.xxhash64("label", "v").alias("key"), "label", "v", "ids")


_CELLS = pa.schema([("n", pa.int64()), ("part", pa.int64()), *((c, pa.binary()) for c in ("keys", "labels", "sole", "owned", "cells", "low", "width"))])
CELL_FILE = "n long, part long, keys binary, labels binary, sole binary, owned binary, cells binary, low binary, width binary"
_ASKED = pa.schema([("asked_n", pa.int64()), ("block", pa.int64()), *((c, pa.binary()) for c in ("ids", "nos", "own_labels", "lows", "highs", "queries"))])
ANCHOR_FILE = "asked_n long, block long, ids binary, nos binary, own_labels binary, lows binary, highs binary, queries binary"
FOUND = "anchor_id long, anchor_no long, w int, key long, lowest double, highest double, sure boolean"


def _name(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"".join(parts), digest_size=7).digest())


def _cell_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (key, label, an id, whether it is the only one, v) as blocks."""
    for n, (keys, *rest), block in _blocks(batches, DATA_BLOCK):
        cells, low, width = cells_of(block)
        columns = {c: x.tobytes() for c, x in zip(("keys", "labels", "sole", "owned", "cells", "low", "width"), (keys, *rest, np.ascontiguousarray(cells.T), low, width), strict=True)}
        yield pa.RecordBatch.from_pylist([{"n": n, "part": _name(columns["keys"])} | columns], schema=_CELLS)


def _anchor_file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (id, number, label, ends of its windows, v) as blocks. A window that ends before it begins is none."""
    for n, (ids, nos, labels, *ends), block in _blocks(batches, ANCHOR_BLOCK):
        lows, highs = (np.ascontiguousarray(np.stack(ends[i::2], axis=1)) for i in (0, 1))
        row = {"asked_n": n, "block": _name(ids.tobytes(), nos.tobytes())}
        yield pa.RecordBatch.from_pylist([row | {c: x.tobytes() for c, x in zip(("ids", "nos", "own_labels", "lows", "highs", "queries"), (ids, nos, labels, lows, highs, block), strict=True)}], schema=_ASKED)


def tables(queries: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each cell of each component adds to each query's score at least (components, queries, cells); how much more all
    may add up to, by query; what rounding may change, by query."""
    q = queries.astype(np.float64)
    least = low[:, None] + width[:, None] * np.arange(CELLS, dtype=np.float64)  # lowest value of each cell
    more = width - 1.0
    lookup = q.T[:, :, None] * least[:, None, :] + np.minimum(q * more, 0).T[:, :, None]
    slack = (np.abs(q) @ (np.abs(low.astype(np.float64)) + width * float(CELLS))) * (1e-15 * (queries.shape[1] + 8))
    return lookup, np.abs(q) @ more, slack


def bounds(queries: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lowest and highest score that each query (rows) may have with each vector (columns). cells: components by vectors."""
    lookup, more, slack = tables(queries, low, width)
    lowest = np.zeros((len(queries), cells.shape[1]))
    part = np.empty_like(lowest)
    for table, own in zip(lookup, cells, strict=True):
        lowest += np.take(table, own, axis=1, out=part, mode="clip")
    lowest -= slack[:, None]
    return lowest, lowest + (more + 2 * slack)[:, None]


class Found:
    """The classes that may be among the first k of each window of a block of anchors, of those seen so far."""

    def __init__(self, k: int, ids: np.ndarray, nos: np.ndarray, labels: np.ndarray, lows: np.ndarray, highs: np.ndarray):
        self.k, self.ids, self.nos, self.labels = k, ids, nos, labels
        self.lows, self.highs = lows.astype(np.float64), highs.astype(np.float64)
        self.open = lows <= highs
        self.slack = 1e-12 * np.maximum(np.abs(self.lows), np.abs(self.highs))
        self.least = np.full((*lows.shape, k), -np.inf)  # lower bounds of the k best that surely lie in a window
        self.held: list[tuple[np.ndarray, ...]] = []

    def add(self, queries: np.ndarray, same: bool, keys: np.ndarray, labels: np.ndarray, sole: np.ndarray, owned: np.ndarray, cells: np.ndarray, low: np.ndarray, width: np.ndarray) -> int:
        n, added = min(self.k, len(keys)), 0
        for at in range(0, len(queries), AT_ONCE):
            own = slice(at, min(at + AT_ONCE, len(queries)))
            lowest, highest = bounds(queries[own], cells, low, width)
            allowed = (self.labels[own, None] == labels[None, :]) == same
            allowed &= ~((self.ids[own, None] == sole[None, :]) & owned[None, :].astype(bool))  # nothing but the anchor itself
            for w in np.flatnonzero(self.open[own].any(axis=0)).tolist():
                low_end, high_end, slack = (x[own, w, None] for x in (self.lows, self.highs, self.slack))
                is_open = allowed & self.open[own, w, None]
                sure = is_open & (lowest >= low_end + slack) & (highest <= high_end - slack)
                best = np.partition(np.where(sure, lowest, -np.inf), len(keys) - n, axis=1)[:, len(keys) - n :]
                self.least[own, w] = np.sort(np.concatenate([self.least[own, w], best], axis=1), axis=1)[:, -self.k :]
                may = is_open & (highest >= np.maximum(low_end - slack, self.least[own, w, :1])) & (lowest <= high_end + slack)
                q, v = np.nonzero(may)
                if len(q):
                    self.held.append((q + at, np.full(len(q), w), keys[v], lowest[q, v], highest[q, v], sure[q, v]))
                    added += len(q)
        return added

    def rows(self) -> tuple[np.ndarray, ...]:
        if not self.held:
            return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.float64, np.float64, bool))
        q, w, keys, lowest, highest, sure = (np.concatenate(c) for c in zip(*self.held, strict=True))
        some = highest >= self.least[q, w, 0]
        return tuple(x[some] for x in (q, w, keys, lowest, highest, sure))


def _search(k: int, same: bool):
    """Streams pairs of a block of anchors and a block of cells: candidates of each window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Found] = {}
        held = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for own in found.values():
                q, w, keys, lowest, highest, sure = own.rows()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own.ids[q], own.nos[q], w.astype(np.int32), keys, lowest, highest, sure)], names=["anchor_id", "anchor_no", "w", "key", "lowest", "highest", "sure"])
            found.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(j)[i] for j, name in enumerate(batch.schema.names)}
                n = row["n"].as_py()
                raw = lambda name, kind=np.int64: np.frombuffer(row[name].as_buffer(), kind)  # noqa: E731, B023
                block, keys = row["block"].as_py(), raw("keys")
                if block not in found:
                    ids = raw("ids").copy()
                    found[block] = Found(k, ids, raw("nos").copy(), raw("own_labels").copy(), *(raw(c).reshape(len(ids), -1) for c in ("lows", "highs")))
                own = found[block]
                held += own.add(raw("queries").reshape(len(own.ids), n), same, keys, raw("labels"), raw("sole"), raw("owned", np.int8), raw("cells", np.uint8).reshape(n, len(keys)), raw("low"), raw("width"))
                if held > HELD:
                    for each in found.values():  # what later blocks have shown not to count goes
                        each.held = [each.rows()]
                    held = sum(len(each.held[0][0]) for each in found.values())
                    if held > HELD // 2:
                        yield from sent()
                        held = 0
        yield from sent()

    return run


def _met(anchors: DataFrame, cells: DataFrame) -> DataFrame:
    """Each block of anchors with each block of cells of its vectors' length."""
    return grid(anchors, cells, F.col("block"), F.col("part")).where("n = asked_n").drop("part", "asked_n")


def _candidates(anchors: DataFrame, cells: DataFrame, k: int, same: bool) -> DataFrame:
    """anchor_id, anchor_no, w, key: what may be among the first k of each window."""
    blocks = materialize(anchors.mapInArrow(_anchor_file, ANCHOR_FILE), "anchor-blocks")
    seen = materialize(_met(blocks, cells).mapInArrow(_search(k, same), FOUND), "negative-candidates").dropDuplicates(["anchor_id", "anchor_no", "w", "key"])
    own = Window.partitionBy("anchor_id", "anchor_no", "w")
    # each task has sent a few rows a window; the k-th best of all tells which may still count
    nth = F.row_number().over(own.orderBy(F.desc("sure"), F.desc("lowest"), "key"))
    least = F.max(F.when((F.col("nth") == k) & F.col("sure"), F.col("lowest"))).over(own)
    return seen.withColumn("nth", nth).withColumn("least", least).where("least is null or highest >= least").select("anchor_id", "anchor_no", "w", "key")


def _scored(some: DataFrame, exact: DataFrame, anchors: DataFrame) -> DataFrame:
    """anchor_id, anchor_no, w, own_label, id, label, score of candidates, from their exact vectors. A class may be many anchors' candidate."""
    named = anchors.select(F.col("id").alias("anchor_id"), F.col("no").alias("anchor_no"), F.col("label").alias("own_label"), F.col("v").alias("q"))
    read = split_join(materialize(some, "negatives-left"), exact, "key", "anchor_id").join(named, ["anchor_id", "anchor_no"]).where(F.size("v") == F.size("q"))
    score = F.aggregate(F.zip_with("v", "q", lambda a, b: F.try_multiply(a, b)), F.lit(0).cast("long"), lambda a, x: F.try_add(a, x))
    each = read.select("anchor_id", "anchor_no", "w", "own_label", "label", score.alias("score"), F.explode(F.filter("ids", lambda x: x != F.col("anchor_id"))).alias("id"))
    return each.where("score is not null")


def hard_negatives(df: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 5, low: int = 80, high: int = 100, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Anchors: ids divisible by `every`."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), quantised(vector, scale).alias("v")).where("id is not null and label is not null and v is not null")
    exact = materialize(classes(rows, max(n_positives, n_negatives)), "exact-classes")
    one = F.array_min("ids") == F.array_max("ids")
    cells = materialize(exact.select("key", "label", F.col("ids")[0].alias("sole"), one.cast("byte").alias("owned"), "v").mapInArrow(_cell_file, CELL_FILE), "class-cells")
    anchors = materialize(rows.where(F.col("id") % every == 0).distinct().select("id", F.xxhash64("label", "v").alias("no"), "label", "v"), "anchors")

    widest = anchors.select("id", "no", "label", F.lit(-WIDEST).alias("low0"), F.lit(WIDEST).alias("high0"), "v")
    own = Window.partitionBy("anchor_id", "anchor_no")
    near = _scored(_candidates(widest, cells, n_positives, True), exact, anchors).where("label = own_label")
    first = near.withColumn("w", F.row_number().over(own.orderBy(F.desc("score"), "id")) - 1).where(F.col("w") < n_positives)
    positives = materialize(first.select("anchor_id", "anchor_no", "w", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    def end(percent: int, w: int, none: int, up: bool) -> Column:
        share = F.col("positive_score").cast("decimal(38,0)") * percent / F.lit(100).cast("decimal(38,0)")
        rounded = (F.ceil(share) if up else F.floor(share)).cast("decimal(38,0)")
        inside = F.greatest(F.least(rounded, F.lit(WIDEST).cast("decimal(38,0)")), F.lit(-WIDEST).cast("decimal(38,0)")).cast("long")
        return F.coalesce(F.max(F.when(F.col("w") == w, inside)), F.lit(none))

    ends = [c for w in range(n_positives) for c in (end(low, w, 1, True).alias(f"low{w}"), end(high, w, 0, False).alias(f"high{w}"))]
    windows = positives.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_no").alias("no")).agg(*ends)
    asked = anchors.join(windows, ["id", "no"]).select("id", "no", "label", *(f"{e}{w}" for w in range(n_positives) for e in ("low", "high")), "v")
    far = _scored(_candidates(asked, cells, n_negatives, False), exact, anchors).where("label <> own_label")
    both = far.select("anchor_id", "anchor_no", "w", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(positives, ["anchor_id", "anchor_no", "w"])
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    inside = both.where((wide("positive_score") * low <= wide("negative_score") * 100) & (wide("negative_score") * 100 <= wide("positive_score") * high))
    rank = F.row_number().over(Window.partitionBy("anchor_id", "anchor_no", "w").orderBy(F.desc("negative_score"), "negative_id"))
    return inside.withColumn("rank", rank).where(F.col("rank") <= n_negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
