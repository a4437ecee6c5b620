"""Mixing sources to target weights by min-cost flow.

Documents are summed up by membership pattern (the set of sources that they are in). Words flow from patterns
to the sources' quotas. Each pass over a pattern has its capacity, and the r-th pass costs r - 1 a word, so
repetition is convex and used last. Sources that share no pattern, directly or through others, don't meet in the
flow; so each component of sources is a network of its own, and components are solved by tasks side by side. No number of
sources or patterns is too many; only the patterns of one component must fit a task.

What flows out of a pattern is some whole passes over its documents and a rest. The rest goes to documents in
the order of a seeded hash of all their columns; the document at the border gives the words that still lack. The border is
found by descending the hash 8 bits at a time, each time with sums of 256 ranges a pattern, until few rows are left beside it, so
neither a hot source nor many equal rows are put in order in one task.

Targets are a water level: a source gets its weight times a level that all share, at most so many times its own size. The
level is found by sums over the table of sources.

Cases: a null text has no words; documents without words or without sources give none; a null source is a
source of its own and comes last; repeated rows count each (of rows that are equal in all columns any may be the one at the border);
an empty table gives no rows; further columns stay, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import materialize, n_words
from linkloom.llm.graph import components

#: Bits of a step down the hash, and rows beside the border that one task puts in order.
BITS, FEW = 8, 1000
#: Bits of each of a row's two hashes.
HALF = 56


class Flow:
    """Min-cost flow by potentials: all shortest ways of one length are filled at once. Arcs come in pairs; arc ^ 1 is the way back."""

    def __init__(self, n: int):
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int = 0) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def _distances(self, source: int, level: list[int]) -> list[float]:
        best: list[float] = [float("inf")] * len(self.out)
        best[source], heap = 0, [(0, source)]
        while heap:
            d, x = heapq.heappop(heap)
            if d > best[x]:
                continue
            for e in self.out[x]:
                y, there = self.to[e], d + self.cost[e] + level[x] - level[self.to[e]]
                if self.room[e] and there < best[y]:
                    best[y] = there
                    heapq.heappush(heap, (there, y))
        return best

    def _fill(self, source: int, sink: int, level: list[int]) -> None:
        """Sends what goes along arcs without reduced cost, by the fewest arcs first."""
        tight = lambda x, e: self.room[e] and self.cost[e] + level[x] == level[self.to[e]]
        while True:
            steps, queue = {source: 0}, [source]
            for x in queue:
                for e in self.out[x]:
                    if tight(x, e) and self.to[e] not in steps:
                        steps[self.to[e]] = steps[x] + 1
                        queue.append(self.to[e])
            if sink not in steps:
                return
            next_, way, x = dict.fromkeys(steps, 0), [], source
            while True:
                if x == sink:
                    n = min(self.room[e] for e in way)
                    for e in way:
                        self.room[e] -= n
                        self.room[e ^ 1] += n
                    first = next(i for i, e in enumerate(way) if not self.room[e])
                    x = self.to[way[first] ^ 1]
                    del way[first:]
                    continue
                while next_[x] < len(self.out[x]):
                    e = self.out[x][next_[x]]
                    if tight(x, e) and steps.get(self.to[e]) == steps[x] + 1:
                        break
                    next_[x] += 1
                if next_[x] < len(self.out[x]):
                    way.append(self.out[x][next_[x]])
                    x = self.to[way[-1]]
                elif way:
                    x = self.to[way.pop() ^ 1]
                    next_[x] += 1
                else:
                    break

    def run(self, source: int, sink: int) -> None:
        level = [0] * len(self.out)
        while True:
            best = self._distances(source, level)
            if best[sink] == float("inf"):
                return
            reached = max(b for b in best if b < float("inf"))
            level = [p + min(b, reached) for p, b in zip(level, best, strict=True)]
            self._fill(source, sink, level)


def route(sizes: dict[str, int], members: dict[str, list[str]], wanted: dict[str, int], passes: int = 3) -> dict[str, int]:
    """Words that each pattern gives. members: the sources of each pattern; wanted: by source."""
    patterns, sources = sorted(sizes), sorted(wanted)
    place = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    net = Flow(2 + len(patterns) + len(sources))
    given = {}
    for i, p in enumerate(patterns):
        given[p] = [net.arc(0, 2 + i, sizes[p], r) for r in range(passes)]
        for s in members[p]:
            if s in place:
                net.arc(2 + i, place[s], passes * sizes[p])
    for s in sources:
        net.arc(place[s], 1, wanted[s])
    net.run(0, 1)
    return {p: sum(net.room[e ^ 1] for e in arcs) for p, arcs in given.items()}


def pattern_of(members: Column) -> Column:
    return F.to_json(F.array_sort(F.array_distinct(members)))


def _members(pattern: str) -> Column:
    """The patterns of a pattern's sources, each alone."""
    return F.transform(F.from_json(pattern, "array<string>"), lambda s: F.to_json(F.array(s)))


def routed(sizes: DataFrame, quotas: DataFrame, passes: int) -> DataFrame:
    """pattern, size, given: what each pattern gives. sizes: pattern, size; quotas: source (its own pattern), quota."""
    met = sizes.select("pattern", F.explode(_members("pattern")).alias("source"))
    shared = met.where("pattern <> source")
    if shared.isEmpty():
        own = lambda df, c: df.withColumn("component", F.col(c))
    else:
        roots = components(shared.select(F.col("pattern").alias("a"), F.col("source").alias("b")))
        own = lambda df, c: df.join(roots.withColumnRenamed("node", c), c, "left").withColumn("component", F.coalesce("root", c))
    none = F.array().cast("array<string>")
    rows = own(sizes, "pattern").select("component", F.lit(0).alias("kind"), F.col("pattern").alias("name"), F.col("size").alias("n"), _members("pattern").alias("members"))
    rows = rows.unionByName(own(quotas, "source").select("component", F.lit(1).alias("kind"), F.col("source").alias("name"), F.col("quota").alias("n"), none.alias("members")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sizes, members, wanted = None, {}, {}, {}

        def solved() -> pa.RecordBatch:
            given = route(sizes, members, wanted, passes)
            return pa.RecordBatch.from_arrays([pa.array(list(given), pa.string()), pa.array([sizes[p] for p in given], pa.int64()), pa.array(list(given.values()), pa.int64())], names=["pattern", "size", "given"])

        for batch in batches:
            for component, kind, name, n, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if component != now:
                    if sizes:
                        yield solved()
                    now, sizes, members, wanted = component, {}, {}, {}
                if kind == 0:
                    sizes[name], members[name] = n, own
                else:
                    wanted[name] = n
        if sizes:
            yield solved()

    return rows.repartition("component").sortWithinPartitions("component", "kind", "name").mapInArrow(run, "pattern string, size long, given long")


def _rows(df: DataFrame, members: Column, size: str, seed: int) -> tuple[DataFrame, list[str]]:
    """df's columns as _column_0 and so on, with pattern, _n (the size) and the hashes _u and _v; and the names of the columns."""
    plain = [c for c in df.columns if c not in ("pattern", "taken")]
    own = df.select(*(F.col(f"`{c}`").alias(f"_column_{i}") for i, c in enumerate(plain)), pattern_of(members).alias("pattern"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_n"))
    hashed = [f.name for f in own.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    part = lambda *c: F.shiftrightunsigned(F.xxhash64(F.lit(seed), *c), 64 - HALF)
    # _v tells equal rows apart, the same from here on
    return materialize(own.select("*", part(*hashed).alias("_u"), part(F.monotonically_increasing_id()).alias("_v")), "mix-rows"), plain


def mix(df: DataFrame, members: Column, quotas: DataFrame, size: str = "size", seed: int = 7, passes: int = 3) -> DataFrame:
    """df with pattern and taken, the words that the mix takes of each document, repeats counted. Columns of df with these names give way.

    members: an array of the sources that a document is in; quotas: source (as in members), quota (whole words).
    """
    docs, names = _rows(df, members, size, seed)
    return _mixed(docs, names, quotas, passes)


def _mixed(docs: DataFrame, names: list[str], quotas: DataFrame, passes: int) -> DataFrame:
    sizes = materialize(docs.groupBy("pattern").agg(F.sum("_n").alias("size")), "mix-patterns")
    given = materialize(routed(sizes, quotas.select(F.to_json(F.array("source")).alias("source"), F.col("quota").cast("long").alias("quota")), passes), "mix-given")
    times = F.when(F.col("size") > 0, F.least(F.lit(passes), F.floor(F.col("given") / F.col("size")))).otherwise(0).cast("long")
    plan = materialize(given.select("pattern", times.alias("_whole"), (F.col("given") - times * F.col("size")).alias("_rest")), "mix-plan")
    border = _border(docs.select("pattern", "_n", "_u", "_v"), plan.where("_rest > 0"))
    # small tables of sums; Spark broadcasts them if they are small enough, else joins by a shuffle
    placed = docs.join(plan, "pattern").join(border, "pattern", "left")
    here = _prefix(F.col("_level"))
    inside = F.coalesce(here == F.col("_at"), F.lit(False))
    more = F.when(here < F.col("_at"), F.col("_n")).otherwise(0)
    before = F.sum("_n").over(Window.partitionBy("pattern").orderBy("_u", "_v").rowsBetween(Window.unboundedPreceding, -1))
    part = F.greatest(F.lit(0), F.least(F.col("_n"), F.col("_left") - F.coalesce(before, F.lit(0))))
    taken = lambda x: (F.col("_whole") * F.col("_n") + x).cast("long").alias("taken")
    columns = [F.col(f"_column_{i}").alias(c) for i, c in enumerate(names)]
    return placed.where(~inside).select(*columns, "pattern", taken(more)).unionByName(placed.where(inside).select(*columns, "pattern", taken(part)))


def _prefix(level: Column) -> Column:
    """The first BITS * level bits of the hash: those of _u, then those of _v."""
    cut = lambda c, bits: F.call_function("shiftright", F.col(c), F.greatest(F.lit(0), F.least(F.lit(HALF), HALF - bits)).cast("int"))
    return F.struct(cut("_u", level * BITS).alias("u"), cut("_v", level * BITS - HALF).alias("v"))


def _border(docs: DataFrame, open_: DataFrame) -> DataFrame:
    """pattern, _level, _at, _left: the range of hashes where each pattern's rest ends, and what it takes of it. docs: pattern, _n, _u, _v."""
    none = F.struct(F.lit(0).cast("long").alias("u"), F.lit(0).cast("long").alias("v"))
    now = materialize(open_.select("pattern", none.alias("_at"), F.col("_rest").alias("_left")), "border")
    done, levels = None, 2 * HALF // BITS
    for level in range(1, levels + 1):
        inside = docs.join(now, "pattern").where(_prefix(F.lit(level - 1)) == F.col("_at"))
        ranges = inside.groupBy("pattern", "_left", _prefix(F.lit(level)).alias("next")).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("rows"))
        upto = F.sum("n").over(Window.partitionBy("pattern").orderBy("next").rowsBetween(Window.unboundedPreceding, 0))  # 256 rows a pattern at most
        first = ranges.withColumn("upto", upto).where("upto >= _left and upto - n < _left")
        found = materialize(first.select("pattern", F.lit(level).alias("_level"), F.col("next").alias("_at"), (F.col("_left") - F.col("upto") + F.col("n")).alias("_left"), "rows"), "border")
        few = (F.col("rows") <= FEW) | F.lit(level == levels)
        done = found.where(few).drop("rows") if done is None else done.unionByName(found.where(few).drop("rows"))
        now = found.where(~few).select("pattern", "_at", "_left")  # these few rows are read again by what comes after
        if now.isEmpty():
            break
    return done


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, size, target of sources (source, size): all words by weight, at most `most` times a source's own; the excess goes to the others."""
    spark = sizes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    ordered = sizes.repartitionByRange(parts, F.col("source").isNull(), "source").sortWithinPartitions(F.col("source").isNull(), "source")
    numbered = materialize(ordered.select("source", "size", place.alias("place")), "sources")
    part = F.shiftright("place", 33)
    counts = sorted(map(tuple, numbered.groupBy(part.alias("part")).count().collect()))  # a row a partition
    starts, at = [], 0
    for p, n in counts:
        starts.append((p, at))
        at += n
    start = F.element_at(F.create_map(*(F.lit(x).cast("long") for pair in starts for x in pair)), part) if starts else F.lit(0)
    index = start + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (index % len(weights) + 1).cast("int"))
    own = materialize(numbered.select("source", "size", weight.alias("weight")), "weights")
    total = own.agg(F.sum("size").alias("n")).first()["n"] or 0
    above = F.lit(False)
    rest, share, seen = total, 0, None
    while True:  # the level only rises, and each round that changes it takes a source more to its limit
        sums = own.agg(F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)).alias("share"), F.coalesce(F.sum(F.when(above, most * F.col("size"))), F.lit(0)).alias("full"), F.count(F.when(above, 1)).alias("n")).first()
        if sums["n"] == seen:
            break
        rest, share, seen = total - sums["full"], sums["share"], sums["n"]
        if not share:
            break
        above = F.lit(rest).cast("double") * F.col("weight") / F.lit(share) > most * F.col("size")
    level = F.lit(float(rest)) * F.col("weight") / F.lit(max(1, share))
    return own.select("source", "size", F.when(above, (most * F.col("size")).cast("double")).otherwise(level).alias("target"))


def mix_sources(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), seed: int = 7, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, source (and `keep`, but for columns of these names); each source's share goes by weight."""
    keep = tuple(c for c in keep if c not in ("doc_id", "size", "source_size", "target", "taken", "source"))
    asked = documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_text"), *(F.col(f"`{c}`").alias(f"_kept_{i}") for i, c in enumerate(keep)))
    docs, names = _rows(asked, F.array("source"), "size", seed)
    source = F.col(f"_column_{names.index('source')}").alias("source")
    sizes = materialize(docs.groupBy(source).agg(F.sum("_n").alias("size")), "source-sizes")
    wanted = materialize(targets(sizes, weights), "targets")
    mixed = _mixed(docs, names, wanted.select("source", F.round("target").alias("quota")), 3)
    own = wanted.select(F.to_json(F.array("source")).alias("pattern"), F.col("size").alias("source_size"), "target")
    return mixed.join(own, "pattern").select("doc_id", "size", "source_size", "target", "taken", "source", *(F.col(f"_kept_{i}").alias(c) for i, c in enumerate(keep)))
