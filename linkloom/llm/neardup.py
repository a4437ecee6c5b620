"""Near-duplicates by an LSH forest, confirmed on full sets of word shingles.

Words are runs without white space, with A-Z in lower case. A text's set holds its shingles of `width` words, or
all of its words as one if they are fewer. Equal sets make up a class, of which one goes on.

A class has a MinHash signature for each tree, of DEPTH 16-bit values. Each tree puts all signatures in order.
Neighbours whose common prefix is as long as their region's depth are candidates. A region is what shares
SPARSE values; one of few rows keeps that depth, a larger one takes DENSE, a very large one DEPTH. Candidates
connect classes to families. As a chain of neighbours connects all rows of a region, no pairs are listed.

Sets are compared exactly within a family, in groups of a bounded weight. A family that fits one group is compared in
full. A larger one is first put in the order of some trees and compared group by group, which connects most of what is
linked in time linear in its size. What is left is compared between these clusters only: clusters are cut into
blocks, and each pair of blocks that don't belong to the same cluster is one piece of work. So a family of any
number of copies of one text costs no more than its size, families are spread over tasks, and whether two texts are
linked never depends on an estimate. Only a pair that shares no region in any tree is missed: trees are as many
as make that rarer than one in 100,000 at the least similarity, even in the largest regions.

Sets hold 64-bit hashes of shingles, so two texts differ from their sets only if such hashes collide. A row is known by its
doc_id, which may be null, and the hash of its text.

Cases: null and empty texts have an empty set and are linked with nothing; equal texts are one component; a component's
id is its smallest doc_id, ignoring nulls; repeated rows stay; an empty table gives no rows; further columns
are ignored. A row whose doc_id is null isn't kept if its component has any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import bound_batches, discard, materialize, shielded, sparing
from linkloom.llm.graph import components

DEPTH, SPARSE, DENSE = 8, 5, 6
#: Rows of a region up to which its depth is SPARSE, and DENSE.
FEW, MANY = 32, 4096
MISSED = 1e-5
#: Weight of a group of sets that are compared in a task, and of a set besides its shingles.
BLOCK, EACH = 50_000, 200
#: Trees by whose order a large family is compared first.
ORDERS = 3
#: Characters of texts that are held at once.
BATCH_CHARS = 2_000_000
#: Columns of a matrix product.
COLUMNS = 8192
REMEMBERED = 300_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = xxhash.xxh64_intdigest(word)
        if len(word) < 64:
            self[word] = found
        return found


_WORDS = _Words()


def _forget_words() -> None:
    _WORDS.clear()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted set of a text's shingles, as 64-bit hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = _mixed(total + hashes[i : i + n] + np.uint64(i))
    return np.unique(total)


def trees_for(percent: int) -> int:
    return ceil(log(MISSED) / log(1 - (percent / 100) ** DEPTH))


class Signer:
    def __init__(self, trees: int):
        random = np.random.Generator(np.random.PCG64(1))
        n = trees * DEPTH
        self.a = random.integers(0, 2**31, n, np.uint32) * np.uint32(2) + np.uint32(1)
        self.b = random.integers(0, 2**32, n, np.uint32)
        self.c = random.integers(0, 2**31, n, np.uint32) * np.uint32(2) + np.uint32(1)

    def sign(self, hashes: np.ndarray) -> bytes:
        """DEPTH big-endian 16-bit values for each tree."""
        low = np.full(len(self.a), 2**32 - 1, np.uint32)
        narrow = (hashes >> np.uint64(32)).astype(np.uint32)
        for at in range(0, len(narrow), 1024):
            np.minimum(low, (narrow[at : at + 1024, None] * self.a + self.b).min(axis=0), out=low)
        return ((low * self.c) >> np.uint32(16)).astype(">u2").tobytes()


def _texts(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[list[list]]:
    """Columns of some rows at a time, of about BATCH_CHARS characters. text: the place of the texts."""
    for whole in batches:
        sizes = pc.fill_null(pc.binary_length(whole.column(text)), 0).to_pylist()
        at = total = 0
        for i, n in enumerate(sizes, 1):
            total += n
            if total >= BATCH_CHARS or i - at == 256 or i == len(sizes):
                yield [c.to_pylist() for c in whole.slice(at, i - at).columns]
                at, total = i, 0


def signatures(docs: DataFrame, width: int, trees: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, key (of the set; null if empty), signature. docs: doc_id, text, text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(trees)
        for ids, texts, hashes in _texts(batches, 1):
            sets = [shingles(t, width) for t in texts]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            signed = [signer.sign(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array(signed, pa.binary())], names=["doc_id", "text_hash", "n_shingles", "key", "signature"])

    return docs.mapInArrow(sparing(run, _forget_words), "doc_id long, text_hash long, n_shingles long, key binary, signature binary")


def _common(a: bytes, b: bytes) -> int:
    """Values that two signatures share from the start."""
    n = 0
    while n < DEPTH and a[2 * n : 2 * n + 2] == b[2 * n : 2 * n + 2]:
        n += 1
    return n


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between neighbours of sorted (tree, signature, key), and this part's first and last rows."""
    part, edges, ends = TaskContext.get().partitionId(), [], []
    region: list[tuple[bytes, bytes]] = []  # the first rows of a region
    tree, before, rows = None, None, 0

    def close() -> None:
        depth = SPARSE if rows <= FEW else DENSE
        for (s, k), (t, m) in zip(region, region[1:], strict=False):
            if k != m and _common(s, t) >= depth:
                edges.append((k, m))
        region.clear()

    def made() -> pa.RecordBatch:
        table = [(a, b, None, None, None) for a, b in edges] + [(k, None, part, t, s) for t, s, k in ends]
        edges.clear()
        ends.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*table, strict=True), (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary()), strict=True)], names=["a", "b", "part", "tree", "signature"])

    for batch in batches:
        for t, s, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if before is None:
                ends.append((t, s, k))
            if before is None or t != tree or s[: 2 * SPARSE] != before[0][: 2 * SPARSE]:
                close()
                tree, rows = t, 0
            rows += 1
            if rows <= MANY:
                region.append((s, k))
            else:
                if region:  # very large: only the full depth counts
                    edges.extend((k1, k2) for (s1, k1), (s2, k2) in zip(region, region[1:], strict=False) if k1 != k2 and s1 == s2)
                    region.clear()
                if before[0] == s and before[1] != k:
                    edges.append((before[1], k))
            before = (s, k)
        if edges:
            yield made()
    if before is not None:
        close()
        ends.append((tree, *before))
        yield made()


def candidate_edges(classes: DataFrame, trees: int) -> DataFrame:
    """a, b: keys of neighbouring classes in some tree."""
    spark = classes.sparkSession
    each = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), F.substring("signature", t * (2 * DEPTH) + 1, F.lit(2 * DEPTH)).alias("s")))
    rows = classes.select("key", F.explode(each).alias("e")).select("e.tree", F.col("e.s").alias("signature"), "key")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "tree", "signature", "key").sortWithinPartitions("tree", "signature", "key")
    found = materialize(ordered.mapInArrow(sparing(_neighbours), "a binary, b binary, part int, tree int, signature binary"), "neighbours")
    ends = found.where("part is not null").select("part", "tree", "signature", "a").collect()  # two rows a part
    ends.sort(key=lambda r: (r["tree"], bytes(r["signature"]), bytes(r["a"])))
    across = [(bytes(x["a"]), bytes(y["a"])) for x, y in zip(ends, ends[1:], strict=False) if x["tree"] == y["tree"] and x["part"] != y["part"] and x["a"] != y["a"] and _common(bytes(x["signature"]), bytes(y["signature"])) >= SPARSE]
    return found.where("part is null").select("a", "b").unionByName(spark.createDataFrame(across, "a binary, b binary"))


def linked(sets_a: list[np.ndarray], sets_b: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of a are linked with which of b, as a matrix of booleans."""
    na, nb = (np.array(list(map(len, s))) for s in (sets_a, sets_b))
    if len(sets_a) * len(sets_b) <= 64:
        common = np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in sets_b] for x in sets_a])
    else:
        values, place = np.unique(np.concatenate([*sets_a, *sets_b]), return_inverse=True)
        owner = np.repeat(np.arange(len(na) + len(nb)), np.concatenate([na, nb]))
        in_a = np.zeros(len(values), bool)
        in_b = np.zeros(len(values), bool)
        in_a[place[: na.sum()]] = True
        in_b[place[na.sum() :]] = True
        number = np.cumsum(in_a & in_b) - 1  # of the columns that count
        kept = (in_a & in_b)[place]
        column, owner = number[place[kept]], owner[kept]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        common = np.zeros((len(na), len(nb)), np.float64)
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            part = slice(*np.searchsorted(column, [at, at + COLUMNS]))
            dense = np.zeros((len(na) + len(nb), COLUMNS), np.float32)
            dense[owner[part], column[part] - at] = 1
            common += dense[: len(na)] @ dense[len(na) :].T
    return 100 * common >= percent * (na[:, None] + nb[None, :] - common)


def _forest(keys: list[bytes], a: np.ndarray, b: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Some of the links, which connect all that the links connect."""
    root = list(range(len(keys)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[p] = q
            found.append((keys[x], keys[y]))
    return found


def _found(rows: list[tuple[int, bytes, bytes]], percent: int) -> list[tuple[bytes, bytes]]:
    """Links of (block, key, set): within the block if there is one only, else between the first and the other."""
    first = rows[0][0]
    a = [(k, np.frombuffer(s, np.uint64)) for b, k, s in rows if b == first]
    b = [(k, np.frombuffer(s, np.uint64)) for x, k, s in rows if x != first]
    if not b:
        x, y = np.nonzero(linked([s for _, s in a], [s for _, s in a], percent))
        return _forest([k for k, _ in a], x[x < y], y[x < y])
    x, y = np.nonzero(linked([s for _, s in a], [s for _, s in b], percent))
    return _forest([k for k, _ in a + b], x, y + len(a))


def _compare(percent: int, most: float = float("inf")):
    """Streams sorted (group..., block, key, set) and compares each group, in parts of a weight of `most`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, weight, out = None, [], 0, []
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                for *group, b, k, s in zip(*(c.to_pylist() for c in whole.slice(at, 64).columns), strict=True):
                    if group != now or weight >= most:
                        out += _found(rows, percent) if len(rows) > 1 else []
                        now, rows, weight = group, [], 0
                    rows.append((b, k, s))
                    weight += len(s) // 8 + EACH
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["a", "b"])
                out = []
        out += _found(rows, percent) if len(rows) > 1 else []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], names=["a", "b"])

    return run


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """key, family, large, signature, set of texts (text, key, family, large, signature), where the text is one that the key is of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _texts(batches, 0):
            out = []
            for text, key, family, large, signature in zip(*columns, strict=True):
                s = shingles(text, width).tobytes()
                if hashlib.blake2b(s, digest_size=16).digest() == key:
                    out.append((key, family, large, signature, s))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.binary(), pa.bool_(), pa.binary(), pa.binary()), strict=True)], names=["key", "family", "large", "signature", "set"])

    return texts.select("text", "key", "family", "large", "signature").mapInArrow(sparing(run, _forget_words), "key binary, family binary, large boolean, signature binary, set binary")


PAIR = "a binary, b binary"


def _between(sets: DataFrame, weights: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Links between clusters (node, root) of the same large family. sets: key, family, set; weights: key, family, weight.

    Clusters of a block's weight and more are cut into blocks of their own, smaller ones are mixed by a hash. Pairs of
    blocks of the same cluster are left out, and families with one cluster altogether.
    """
    in_ = weights.join(clusters.select(F.col("node").alias("key"), "root"), "key", "left").select("key", "family", "weight", F.coalesce("root", "key").alias("cluster"))
    own = materialize(in_, "clusters")
    sums = materialize(own.groupBy("family", "cluster").agg(F.sum("weight").alias("weight")), "cluster-weights")
    blocks = F.when(F.col("weight") >= BLOCK, F.ceil(F.col("weight") / BLOCK).cast("int"))
    mixed = F.ceil(F.sum(F.when(F.col("weight") < BLOCK, F.col("weight"))) / BLOCK).cast("int")
    whole = sums.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.coalesce(mixed, F.lit(0)).alias("mixed"), F.coalesce(F.sum(blocks), F.lit(0)).cast("int").alias("others"))
    left = materialize(whole.where("n > 1"), "families-left")
    # a row for each of the heavy clusters, of which a family has as many as blocks at most
    before = F.sum("blocks").over(Window.partitionBy("family").orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1))
    heavy = sums.withColumn("blocks", blocks).where("blocks is not null").withColumn("before", F.coalesce(before, F.lit(0)).cast("int"))
    places = sums.select("family", "cluster").join(left, "family").join(heavy.select("family", "cluster", "blocks", "before"), ["family", "cluster"], "left")
    places = materialize(places, "cluster-places")
    dealt = own.join(places, ["family", "cluster"])
    block = F.when(F.col("blocks").isNull(), F.pmod(F.xxhash64("cluster"), F.col("mixed"))).otherwise(F.col("mixed") + F.col("before") + F.pmod(F.xxhash64("key"), F.col("blocks"))).cast("int")
    start = F.col("mixed") + F.col("before")
    all_ = F.sequence(F.lit(0), F.col("mixed") + F.col("others") - 1)
    partners = F.when(F.col("blocks").isNull(), all_).otherwise(F.filter(all_, lambda x: (x < start) | (x >= start + F.col("blocks"))))
    asked = materialize(dealt.select("key", block.alias("block"), partners.alias("partners")), "blocks")
    each = sets.join(asked, "key").select("family", "block", "key", "set", F.explode("partners").alias("other"))
    pairs = each.select("family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "key", "set")
    # a group of (i, j) with rows of one block only has nothing to compare unless i = j
    tagged = pairs.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "block", "key")
    found = materialize(tagged.mapInArrow(sparing(_compare(percent)), PAIR), "links-between")
    discard(own, sums, left, places, asked)
    return found


def links(documents: DataFrame, classes: DataFrame, width: int, percent: int, trees: int) -> DataFrame:
    """a, b: keys of classes that are linked, enough of them to connect all that is. documents: no_id, id, text_hash, text."""
    spark = documents.sparkSession
    families = components(candidate_edges(classes, trees))
    weight = (F.col("n_shingles") + EACH).alias("weight")
    members = materialize(families.select(F.col("node").alias("key"), F.col("root").alias("family")).join(classes.select("key", "no_id", "id", "text_hash", "signature", weight), "key"), "members")
    large = materialize(members.groupBy("family").agg(F.sum("weight").alias("all")).where(F.col("all") > BLOCK).select("family", F.lit(True).alias("large")), "large-families")
    marked = members.join(large, "family", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    texts = documents.join(marked, ["no_id", "id", "text_hash"])
    sets = materialize(_sets(texts, width).dropDuplicates(["key"]), "sets")  # a row may be there several times
    small = sets.where("not large").select("family", F.lit(0).alias("block"), "key", "set").repartition("family").sortWithinPartitions("family", "key")
    found = materialize(small.mapInArrow(sparing(_compare(percent)), PAIR), "links")
    if large.isEmpty():
        discard(members, large, sets)
        return found
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = sets.where("large")
    orders = F.array(*(F.struct(F.lit(t).alias("tree"), F.substring("signature", t * 2 * DEPTH + 1, 2 * DEPTH).alias("s")) for t in range(min(ORDERS, trees))))
    ordered = heavy.select("family", "key", "set", F.explode(orders).alias("o")).select("family", "o.tree", "o.s", F.lit(0).alias("block"), "key", "set")
    ordered = ordered.repartitionByRange(n, "family", "tree", "s", "key").sortWithinPartitions("family", "tree", "s", "key").drop("s")
    first = materialize(ordered.mapInArrow(sparing(_compare(percent, BLOCK)), PAIR), "links-in-order")
    weights = members.join(large, "family").select("key", "family", "weight")
    rest = _between(heavy.select("key", "family", "set"), weights, components(first), percent)
    discard(members, large, sets)
    return found.unionByName(first).unionByName(rest)


def resolve(documents: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per document with words: doc_id, text_hash, n_shingles, root, component_id. And those without: doc_id, text_hash."""
    bound_batches(documents.sparkSession)
    trees = trees_for(percent)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    signed = materialize(signatures(docs, width, trees), "signatures")
    full = signed.where("key is not null")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")
    classes = full.groupBy("key").agg(F.min(row).alias("row"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")).select("key", "row.*", "n_shingles", "signature")
    texts = docs.select(row.alias("row"), "text").select("row.*", "text")
    found = components(links(texts, classes, width, percent, trees))
    firsts = materialize(full.groupBy("key").agg(F.min("doc_id").alias("first_id")).join(found.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")), "roots")
    ids = materialize(firsts.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")  # written, so that a join with a large component can be split
    by_key = materialize(firsts.join(ids, "root").select("key", "root", "component_id"), "components")
    discard(firsts, ids)
    return full.join(by_key, "key").select("doc_id", "text_hash", "n_shingles", "root", "component_id"), signed.where("key is null").select("doc_id", "text_hash")


def near_duplicates(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept. Linked: 100 * |common| >= percent * |all|."""
    full, empty = resolve(documents, width, percent)
    out = full.select("doc_id", "n_shingles", "component_id").unionByName(empty.select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id")))
    return out.select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicate(documents: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """documents, of each component the one with the smallest doc_id (then hash of its text). Of rows that agree in both, one."""
    hidden, back = shielded(documents, ("doc_id", "text"))
    full, empty = resolve(hidden, width, percent)
    best = full.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("m")).select("m.doc_id", "m.text_hash")
    stay = best.unionByName(empty).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    docs = hidden.withColumn("_hash_of_text", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash_of_text") == F.col("_hash"))
    return back(docs.join(stay, same, "left_semi").dropDuplicates(["doc_id", "_hash_of_text"]))
