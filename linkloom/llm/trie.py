r"""A trie of conversation prefixes, rolled up by pointer jumping.

A turn is known by a digest of its role and text. A prefix is known by sums, over its turns, of numbers hashed from each
turn's digest and its depth, so a running sum over a conversation's turns gives the digests of all its prefixes; no
conversation is ever gathered. Nodes are the distinct digests, each with its parent's: these are the edges.

What a node's whole subtree adds up to is found by doubling. After round k each node has the sum of its descendants at
distances below 2^k, and points to its ancestor at distance 2^k: adding what those that point to it have doubles
the distance, and so does taking the pointer's own pointer. A trie of depth d takes log2(d) rounds.

Running sums go by range parts: each part sums for itself, and a conversation that lies in several parts gets what the parts before have. So a
conversation of any length is dealt over tasks. The ids that end at a node are joined in parts as well, and then hashed as a stream.

Cases: rows with a null conv_id take no part; null role or text counts as empty; turns come by (turn, digest), null turns
first; repeated rows are turns of their own; an empty table has no nodes; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import discard, materialize, split_join

#: Conversations of a block of so many ids begin like its first, by up to this many turns less one.
BLOCK, HEADS = 100, 6
LANES = 4
#: Bytes of joined ids that are handed on at once.
TEXT = 1 << 20


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running(df: DataFrame, key: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """df with running sums within each key, however many rows it has. Rows that agree in key and order are dealt to one task."""
    parts = materialize(df.repartitionByRange(_partitions(df), key, *order).withColumn("_part", F.spark_partition_id()), "running")
    before = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = Window.partitionBy(key)
    totals = parts.groupBy("_part", key).agg(*(F.sum(c).alias(f"_{n}") for n, c in sums.items())).withColumn("_parts", F.count(F.lit(1)).over(each)).where("_parts > 1")
    earlier = each.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("_part", key, *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums))  # two keys a part at most
    both = parts.withColumns({n: F.sum(c).over(before) for n, c in sums.items()}).join(F.broadcast(carried), ["_part", key], "left")
    return both.withColumns({n: F.col(n) + F.coalesce(f"_{n}", F.lit(0)) for n in sums}).drop("_part", *(f"_{n}" for n in sums))


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest, chars: what is needed of each turn."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.length(text).cast("long").alias("chars"))


def rebuilt(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, chars of all turns, all ids): each conversation begins like the first of its block, by h turns, h from a hash of its id."""
    placed = materialize(running(own, "conv_id", [F.asc_nulls_first("turn"), F.asc("digest")], {"pos": F.lit(1)}), "placed")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = (F.col("conv_id") - F.col("conv_id") % BLOCK).alias("base")
    heads = materialize(placed.where((F.col("conv_id") % BLOCK == 0) & (F.col("pos") < HEADS)).select(F.col("conv_id").alias("base"), "pos", "digest", "chars"), "heads")
    there = heads.groupBy("base").agg(F.max("pos").alias("there"))
    ids = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", base, h.alias("h"))
    ids = materialize(ids.join(there, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0)))), "conversations")
    begun = ids.join(heads, "base").where("pos <= h").select("conv_id", F.col("pos").alias("depth"), "digest", "chars")
    rest = split_join(placed.where(F.col("pos") > h), ids.select("conv_id", "h", "taken"), "conv_id", "pos")
    return begun.unionByName(rest.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "digest", "chars")), ids.select("conv_id")


def _lanes() -> list[Column]:
    """Numbers hashed from a turn's digest and depth."""
    hashed = F.sha2(F.concat_ws(":", F.col("depth").cast("string"), "digest"), 256)
    return [F.conv(F.substring(hashed, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(LANES)]


def _key(depth: Column, lanes: list[Column]) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat_ws(",", depth.cast("string"), *(x.cast("string") for x in lanes)), 256)), 1, 16)


ROOT = hashlib.sha256(",".join(["0"] * (LANES + 1)).encode()).digest()[:16]


def prefixes(members: DataFrame) -> DataFrame:
    """conv_id, depth, chars, key, parent of each turn's prefix. members: conv_id, depth, digest, chars."""
    names = [f"lane{i}" for i in range(LANES)]
    own = members.select("conv_id", "depth", "chars", *(x.alias(f"{n}_own") for n, x in zip(names, _lanes(), strict=True)))
    summed = running(own, "conv_id", [F.asc("depth")], {n: F.col(f"{n}_own") for n in names})
    before = [F.col(n) - F.col(f"{n}_own") for n in names]
    return summed.select("conv_id", "depth", "chars", _key(F.col("depth"), [F.col(n) for n in names]).alias("key"), _key(F.col("depth") - 1, before).alias("parent"))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (key, conv_id) in order: a key's ids as text, in pieces that follow each other."""
    key, first, ids, size = None, None, [], 0

    def piece() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"key": key, "first": first, "ids": ",".join(ids)}], schema=pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))

    for batch in batches:
        for k, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (k != key or size > TEXT):
                yield piece()
                ids, size = [], 0
            if not ids:
                key, first = k, i
            ids.append(str(i))
            size += len(ids[-1]) + 1
    if ids:
        yield piece()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (key, first, ids) in order: SHA-256 of each key's ids."""
    key, digest, done = None, None, []
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    for batch in batches:
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if k != key:
                if digest is not None:
                    done.append({"key": key, "ends_sha256": digest.hexdigest()})
                key, digest = k, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
            done = []
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "ends_sha256": digest.hexdigest()}], schema=schema)


def ends(last: DataFrame) -> DataFrame:
    """key, ends_sha256: the ids that end at each node, ascending. last: key, conv_id."""
    n = _partitions(last)
    texts = last.repartitionByRange(n, "key", "conv_id").sortWithinPartitions("key", "conv_id").select("key", "conv_id").mapInArrow(_joined, "key binary, first long, ids string")
    return texts.repartition(n, "key").sortWithinPartitions("key", "first").mapInArrow(_hashed, "key binary, ends_sha256 string")


def rolled_up(nodes: DataFrame, sums: tuple[str, ...]) -> DataFrame:
    """nodes (key, parent, depth and more), with each of `sums` added up over a node's subtree. The root has no parent and depth 0."""
    state = materialize(nodes.withColumn("_up", F.col("parent")), "trie")
    deepest = state.agg(F.max("depth")).first()[0] or 0
    far = 1
    while far <= deepest:
        given = state.where("_up is not null").groupBy(F.col("_up").alias("key")).agg(*(F.sum(c).alias(f"_{c}") for c in sums))
        added = state.join(given, "key", "left").withColumns({c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in sums}).drop(*(f"_{c}" for c in sums))
        far *= 2
        above = F.col("depth") >= far
        done = added.where(~above).withColumn("_up", F.lit(None).cast("binary"))
        if far <= deepest:  # many nodes may have one ancestor in common
            pointers = state.select(F.col("key").alias("_up"), F.col("_up").alias("_next"))
            moved = split_join(materialize(added.where(above), "trie-added"), pointers, "_up", "key")
            done = done.unionByName(moved.withColumn("_up", F.col("_next")).drop("_next"))
        before, state = state, materialize(done, "trie")
        discard(before)
    return state.drop("_up")


def trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    members, ids = rebuilt(turns(conversations))
    rows = materialize(prefixes(members), "prefixes")
    root = F.lit(ROOT)
    grouped = rows.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").cast("long").alias("depth"), F.max("parent").alias("parent"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"))
    top = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    top = top.select(root.alias("key"), "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("parent"), "n_convs", F.lit(0).cast("long").alias("chars"))
    nodes = materialize(grouped.unionByName(top), "nodes")
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    weighed = counted.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("chars")})
    whole = rolled_up(weighed, ("n_leaves", "saved_tokens"))
    last = rows.groupBy("conv_id").agg(F.max(F.struct("depth", "key")).alias("l")).select("conv_id", F.col("l.key").alias("key"))
    ended = ends(ids.join(last, "conv_id", "left").select(F.coalesce("key", root).alias("key"), "conv_id"))
    full = materialize(whole.join(ended, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest()))), "trie-nodes")
    named = split_join(full.where("parent is not null"), full.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent", "key")
    out = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return named.select(*out).unionByName(full.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*out))
