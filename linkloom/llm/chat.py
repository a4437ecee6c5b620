r"""Chat formatting over a prefix tree.

A conversation becomes one segment for each turn: `<turn>### role:\ntext</turn>\n`. Within texts and roles a
backslash goes before each `\`, `<` and `#` (in roles also `:`), so no control string can occur in them, and
dropping those backslashes gives the text again.

A segment is encoded to tokens in three parts, its head, its text and its close, so that the text's tokens are its own. No text
stands for a special token of the vocabulary.

Conversations that share initial turns share those nodes of a tree. A node's key is a hash of its parent's key,
role and text. Sorted by the keys on their paths, conversations come in depth-first order of the tree: each
adds, as one branch, the turns that it doesn't share with the one before it. All branches make up one
layout, in which each shared token stands once. A branch carries its start in the layout, the position id
of its first token (which counts the tokens before it in its own conversation), its loss spans, and
the intervals of the layout that its ancestors take; a token attends to these and to its own branch up to
itself. No branch, tree or hot first turn needs to fit a task: only one conversation does.

Units are tokens of the vocabulary. Cases: null text or role counts as empty; turns come by (turn, role, text), nulls first;
repeated rows are turns of their own; rows with a null conv_id make up one conversation; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.llm.bpe import Codec, codec
from linkloom.llm.common import materialize, shared_dir, split_join

KEY = 16
OPEN, BETWEEN, CLOSE = "<turn>### ", ":\n", "</turn>\n"
_TEXT, _ROLE, _ESCAPED = re.compile(r"[\\<#]"), re.compile(r"[\\<#:]"), re.compile(r"\\(.)", re.S)
_SEGMENT = re.compile(r"<turn>### ((?:[^\\:]+|\\.)*):\n((?:[^\\<]+|\\.)*)</turn>\n", re.S)

PATHS = "conv_id long, leaf binary, path binary, lengths array<int>, tokens array<int>, loss array<struct<start:int,end:int>>"
BRANCHES = "leaf binary, start long, position long, first_turn int, tokens array<int>, loss array<struct<start:int,end:int>>, ancestors array<struct<start:long,end:long>>"


def escape(text: str, pattern: re.Pattern = _TEXT) -> str:
    return pattern.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def segment(role: str, text: str, own: Codec) -> tuple[np.ndarray, tuple[int, int]]:
    """A turn's tokens, and where its text is among them if the model learns it (else an empty span)."""
    head, body, close = (own.encode(x, special=False) for x in (OPEN + escape(role, _ROLE) + BETWEEN, escape(text), CLOSE))
    return np.concatenate([head, body, close]), (len(head), len(head) + len(body)) if role == "assistant" else (-1, -1)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of all turns of a formatted conversation."""
    turns, at = [], 0
    for found in _SEGMENT.finditer(formatted):
        if found.start() != at:
            raise ValueError("text outside of turns")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError("text outside of turns")
    return turns


def _rows(batches: Iterator[pa.RecordBatch], size: int = 200) -> Iterator[list[dict]]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size).to_pylist()


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_INTERVALS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _spec(spark: SparkSession, vocabulary: str):
    with open(vocabulary, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())  # a vocabulary: bounded


def paths(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """Each conversation's way down the tree (the keys of its nodes, one after the other) and its segments."""
    spec = _spec(conversations.sparkSession, vocabulary)
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        for rows in _rows(batches):
            out, tokens = [], []
            for row in rows:
                key, keys, lengths, loss = b"", [], [], []
                for turn in row["turns"]:
                    role, text = turn["role"].encode(), turn["text"].encode()
                    key = hashlib.blake2b(key + len(role).to_bytes(8) + role + text, digest_size=KEY).digest()
                    keys.append(key)
                    made, (start, end) = segment(turn["role"], turn["text"], own)
                    tokens.append(made)
                    lengths.append(len(made))
                    loss.append({"start": start, "end": end})
                out.append((row["conv_id"], key, b"".join(keys), lengths, loss))
            ids, leaves, ways, lengths, loss = zip(*out, strict=True)
            sizes = np.cumsum([0, *map(sum, lengths)]).astype(np.int32)
            flat = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([np.zeros(0, np.int32), *tokens])))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(leaves, pa.binary()), pa.array(ways, pa.binary()), pa.array(lengths, pa.list_(pa.int32())), flat, pa.array(loss, _SPANS)], names=["conv_id", "leaf", "path", "lengths", "tokens", "loss"])

    return whole.mapInArrow(run, PATHS)


def _shared(a: bytes, b: bytes) -> int:
    """How many nodes two paths share."""
    most = min(len(a), len(b)) // KEY
    if a[: most * KEY] == b[: most * KEY]:
        return most
    low, high = 0, most
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * KEY] == b[: mid * KEY] else (low, mid - 1)
    return low


class Walk:
    """Goes through sorted paths. Of the path before, nodes are kept as (start of its branch, its end)."""

    def __init__(self, path: bytes = b"", nodes: list[tuple[int, int]] = (), at: int = 0):
        self.path, self.nodes, self.at = path, list(nodes), at

    def step(self, path: bytes, lengths: list[int]) -> tuple[int, int]:
        """(number of nodes shared with the path before, start of the new branch)"""
        shared, start = _shared(self.path, path), self.at
        del self.nodes[shared:]
        for n in lengths[shared:]:
            self.at += n
            self.nodes.append((start, self.at))
        self.path = path
        return shared, start


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (path, lengths)."""
    walk, first, head = Walk(), None, []
    for rows in _rows(batches):
        for row in rows:
            lengths = row["lengths"]
            if first is None:
                first, head = row["path"], lengths
            walk.step(row["path"], lengths)
    if first is not None:
        yield pa.RecordBatch.from_pylist([{"part": TaskContext.get().partitionId(), "first": first, "head": head, "last": walk.path, "total": walk.at, "starts": [a for a, _ in walk.nodes], "ends": [b for _, b in walk.nodes]}])


def _begins(summaries: list) -> dict[int, tuple[bytes, list[tuple[int, int]], int]]:
    """For each part: the path before it, where that path's shared nodes are, and the layout's length so far."""
    found, path, nodes, at = {}, b"", [], 0
    for s in sorted(summaries, key=lambda s: s["part"]):
        shared = _shared(path, bytes(s["first"]))
        found[s["part"]] = (path[: shared * KEY], nodes[:shared], at)
        skipped = sum(s["head"][:shared])
        ends = [(at + max(0, a - skipped), at + b - skipped) for a, b in zip(s["starts"], s["ends"], strict=True)]
        # nodes of the first path that were there before the part stay where they are
        same = min(shared, _shared(bytes(s["first"]), bytes(s["last"])))
        path, nodes, at = bytes(s["last"]), nodes[:same] + ends[same:], at + s["total"] - skipped
    return found


def branches(leaves: DataFrame) -> DataFrame:
    """The depth-first layout of distinct paths (leaf, path, lengths, tokens, loss): a row for each branch."""
    spark = leaves.sparkSession
    shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = leaves.repartitionByRange(n, "path").sortWithinPartitions("path").checkpoint()  # the parts must not change
    summaries = ordered.select("path", "lengths").mapInArrow(_summary, "part long, first binary, head array<long>, last binary, total long, starts array<long>, ends array<long>").collect()  # a row a part
    begins = spark.sparkContext.broadcast(_begins(summaries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = None
        for batch in batches:
            if not batch.num_rows:
                continue
            walk = walk or Walk(*begins.value[TaskContext.get().partitionId()])
            flat, ends = batch.column(3).flatten().to_numpy(), np.cumsum(batch.column(3).value_lengths().to_numpy())
            rows, tokens = [], []
            for leaf, path, lengths, loss, end in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), ends.tolist(), strict=True):
                shared, start = walk.step(path, lengths)
                ancestors: list[dict] = []
                for a, b in walk.nodes[:shared]:
                    if ancestors and ancestors[-1]["start"] == a:
                        ancestors[-1]["end"] = b
                    else:
                        ancestors.append({"start": a, "end": b})
                learned, at = [], 0
                for n, span in zip(lengths[shared:], loss[shared:], strict=True):
                    if span["start"] >= 0:
                        learned.append({"start": at + span["start"], "end": at + span["end"]})
                    at += n
                tokens.append(flat[end - at : end])
                rows.append((leaf, start, sum(lengths[:shared]), shared, learned, ancestors))
            leaves, starts, positions, firsts, learned, ancestors = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.binary()), pa.array(starts, pa.int64()), pa.array(positions, pa.int64()), pa.array(firsts, pa.int32()), _lists(tokens), pa.array(learned, _SPANS), pa.array(ancestors, _INTERVALS)], names=["leaf", "start", "position", "first_turn", "tokens", "loss", "ancestors"])

    return ordered.mapInArrow(run, BRANCHES)


def format_conversations(conversations: DataFrame, vocabulary: str) -> tuple[DataFrame, DataFrame]:
    """(branches of the layout, the leaf at which each conversation ends). vocabulary: path of a tokenizers file, read on the driver."""
    found = materialize(paths(conversations, vocabulary), "chat-paths")
    leaves = found.groupBy("leaf").agg(*(F.first(c).alias(c) for c in ("path", "lengths", "tokens", "loss")))  # equal in a group
    return materialize(branches(leaves), "chat-branches"), found.select("conv_id", "leaf")


def read_back(layout: DataFrame) -> DataFrame:
    """leaf, pieces: each distinct conversation, put together from the layout by its attention intervals."""
    own = F.struct("start", (F.col("start") + F.size("tokens")).alias("end"))
    pieces = layout.select("leaf", F.posexplode(F.concat("ancestors", F.array(own))).alias("no", "piece")).select("leaf", "no", F.col("piece.start").alias("start"), (F.col("piece.end") - F.col("piece.start")).cast("int").alias("n"))
    # a first turn may be that of a good part of all conversations
    both = split_join(pieces, layout.select("start", "tokens", F.col("loss").alias("spans")), "start", "leaf")
    cut = both.select("leaf", F.struct("no", F.slice("tokens", F.lit(1), F.col("n")).alias("tokens"), F.filter("spans", lambda s: s["end"] <= F.col("n")).alias("spans")).alias("p"))
    return cut.groupBy("leaf").agg(F.sort_array(F.collect_list("p")).alias("pieces"))


def digests(conversations: DataFrame, vocabulary: str) -> DataFrame:
    """Per conversation: what is read back from the layout, as counts and hex digests."""
    layout, members = format_conversations(conversations, vocabulary)
    spec = _spec(conversations.sparkSession, vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        text_of = lambda ids: own.decode(ids.astype(np.int64))[0].tobytes().decode()
        for batch in batches:
            if not batch.num_rows:
                continue
            pieces = batch.column(1).flatten()
            tokens, spans = pieces.field("tokens"), pieces.field("spans").to_pylist()
            flat, ends = tokens.flatten().to_numpy(), np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy())])
            out, first = [], 0
            for leaf, n in zip(batch.column(0).to_pylist(), batch.column(1).value_lengths().to_pylist(), strict=True):
                formatted = text_of(flat[ends[first] : ends[first + n]])
                turns = parse(formatted)
                learned = "".join(unescape(text_of(flat[ends[i] + s["start"] : ends[i] + s["end"]])) for i in range(first, first + n) for s in spans[i])
                text = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append({"leaf": leaf, "n_turns": len(turns), "turns_sha256": hashlib.sha256(text.encode()).hexdigest(), "loss_chars": len(learned), "loss_sha256": hashlib.sha256(learned.encode()).hexdigest(), "formatted_chars": len(formatted)})
                first += n
            yield pa.RecordBatch.from_pylist(out)

    found = materialize(read_back(layout).mapInArrow(run, "leaf binary, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"), "chat-digests")
    # equal conversations have one leaf
    return split_join(members, found, "leaf", "conv_id").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
