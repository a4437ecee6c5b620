"""Exact byte-level BPE in linear time, and decoding by an offset table.

A piece of text is walked from left to right. An Aho-Corasick automaton over the vocabulary gives the
longest token at each place. It is taken if it may stand after the token before it, which a walk down
the two tokens' merges decides; otherwise its next shorter prefix is tried, and when none is left the
token before it is given up. A place that was given up is never entered again, so the time is linear.

Cases: a null text counts as empty; an empty text has no ids and decodes to an empty text; repeated
rows are encoded each; further columns are kept as they are, but a column that is named like the one to add
(in any case) gives way to it.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import bound_batches

#: The parts of the byte-level pattern, for whole Unicode and for texts below U+0250.
CONTRACTIONS = r"'s|'t|'re|'ve|'m|'ll|'d"
FULL = (r"\p{L}", r"\p{N}", r"\p{White_Space}")
LATIN = (r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0")
LATIN_ONLY = re.compile(r"[\x00-ɏ]*\Z")
#: Pieces that a worker remembers, in each of two generations.
REMEMBERED = 200_000
#: Texts that are held at once, in characters.
BATCH_CHARS = 4_000_000


def _pattern(letter: str, number: str, space: str) -> str:
    return f" ?[{letter}]+|{CONTRACTIONS}| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, as character: byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Memory(dict):
    """Encoded pieces as bytes of 32-bit ids. The older half goes when the younger is full; long pieces aren't kept."""

    def __init__(self, encode):
        self.encode, self.old = encode, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = array("i", self.encode(piece.encode())).tobytes()
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        if len(piece) < 64:
            self[piece] = found
        return found


class Codec:
    """Tables of one vocabulary. spec: the text of a tokenizers file with a byte-level BPE model."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        letters = byte_alphabet()
        vocab: dict[str, int] = data["model"]["vocab"]
        self.size = max([*vocab.values(), *(x["id"] for x in data["added_tokens"])]) + 1
        self.bytes = [b""] * self.size
        for word, i in vocab.items():
            self.bytes[i] = bytes(letters[c] for c in word)
        self.specials = {x["content"]: x["id"] for x in data["added_tokens"]}
        for content, i in self.specials.items():
            self.bytes[i] = content.encode()
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}
        self.order = [-1] * self.size  # of the merge that makes a token; -1: a byte
        self.made: dict[int, int] = {}
        for k, merge in enumerate(data["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.rank[pair] = k
            if whole not in self.halves:
                self.halves[whole], self.order[whole] = pair, k
        self.lengths = [len(b) for b in self.bytes]
        self.pairs: dict[int, bool] = {}
        self.offsets, self.blob = np.cumsum([0, *self.lengths]).astype(np.int32), np.frombuffer(b"".join(self.bytes), np.uint8)
        self._find()
        self.full, self.latin = regex.compile(_pattern(*FULL)), re.compile(_pattern(*LATIN))
        self.known = Memory(self.encode_piece)

    def _find(self) -> None:
        """The automaton, and each token's longest shorter prefix, over the tokens that merging their own bytes gives."""
        able: dict[int, bool] = {}
        for token in sorted((i for i, b in enumerate(self.bytes) if b and i not in self.specials.values()), key=lambda i: self.order[i]):
            pair = self.halves.get(token)
            able[token] = pair is None or able[pair[0]] and able[pair[1]] and self.compatible(*pair, self.order[token])
        by_bytes = {self.bytes[i].decode("latin-1"): i for i, ok in able.items() if ok}
        self.prefix = [-1] * self.size
        self.automaton = ahocorasick.Automaton()
        for word, i in by_bytes.items():
            self.automaton.add_word(word, i)
            self.prefix[i] = next((by_bytes[word[:n]] for n in range(len(word) - 1, 0, -1) if word[:n] in by_bytes), -1)
        self.automaton.make_automaton()

    def compatible(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether merging the bytes of both gives just these two, looking only at merges before `below`.

        No merge across the border may come earlier than those that built the two edges it would touch.
        On the way down, the half built later is opened first. A merge across of the same order as one
        inside the left token comes after that one, of the same order as one inside the right token before it.
        """
        limit = len(self.rank) if below is None else below
        while True:
            across = self.rank.get((left, right))
            if across is not None and across < limit:
                return False
            a, b = self.order[left], self.order[right]
            if a < 0 and b < 0:
                return True
            if a > b:
                limit, left = min(limit, a), self.halves[left][1]
            else:
                limit, right = min(limit, b + 1), self.halves[right][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        text, last = piece.decode("latin-1"), len(piece)
        longest, lengths, known = self.automaton.iter_long, self.lengths, self.pairs
        if last > 60:  # the library copies the text at each call
            longest = self._longest(text).__getitem__
        tokens: list[int] = []
        starts: list[int] = []
        closed: set[int] = set()
        at, before = 0, -1
        token = longest(0) if last > 60 else next(longest(text))[1]
        while True:
            end = at + lengths[token]
            if end not in closed:
                fits = before < 0 or known.get(pair := before << 20 | token)
                if fits is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    fits = known[pair] = self.compatible(before, token)
                if fits:
                    tokens.append(token)
                    if end == last:
                        return tokens
                    starts.append(at)
                    at, before = end, token
                    token = longest(end) if last > 60 else next(longest(text, end))[1]
                    continue
            token = self.prefix[token]
            while token < 0:  # nothing fits here
                closed.add(at)
                token, at = self.prefix[tokens.pop()], starts.pop()
                before = tokens[-1] if tokens else -1

    def _longest(self, text: str) -> list[int]:
        """The longest token at each place."""
        found = [-1] * len(text)
        for end, token in self.automaton.iter(text):
            found[end - self.lengths[token] + 1] = token
        return found

    def _ordinary(self, text: str) -> bytes:
        pieces = (self.latin if LATIN_ONLY.match(text) else self.full).findall(text)
        return b"".join(map(self.known.__getitem__, pieces))

    def encode(self, text: str, special: bool = True) -> np.ndarray:
        """special: whether the names of special tokens stand for these, or are text like any other."""
        if not special or self.special_pattern is None or not (hits := list(self.special_pattern.finditer(text))):
            return np.frombuffer(self._ordinary(text), np.int32)
        parts, at = [], 0
        for hit in hits:
            parts += [self._ordinary(text[at : hit.start()]), array("i", [self.specials[hit[0]]]).tobytes()]
            at = hit.end()
        return np.frombuffer(b"".join([*parts, self._ordinary(text[at:])]), np.int32)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids one after the other, and where each id's bytes end among them."""
        first = self.offsets[ids]
        n = self.offsets[ids + 1] - first
        ends = np.cumsum(n, dtype=np.int64)
        if not len(ids):
            return np.zeros(0, np.uint8), ends
        step = np.ones(int(ends[-1]), np.int32)  # from each byte's place in the table to the next one's
        step[0] = first[0]
        step[ends[:-1]] = first[1:] - first[:-1] - n[:-1] + 1
        return self.blob[np.cumsum(step, dtype=np.int32, out=step)], ends


_CODECS: dict[str, Codec] = {}


def codec(spec: str) -> Codec:
    """One per worker and vocabulary."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(spec)
    return _CODECS[key]


def _slices(batch: pa.RecordBatch, size: list[int]) -> Iterator[pa.RecordBatch]:
    at = total = 0
    for i, n in enumerate(size):
        total += n
        if total >= BATCH_CHARS:
            yield batch.slice(at, i + 1 - at)
            at, total = i + 1, 0
    if at < len(size):
        yield batch.slice(at)


def _room(df: DataFrame, name: str, read: str) -> DataFrame:
    """df without columns named like the one to add, but for the one that is read."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower() or c == read))


def _encoded(own: Codec, texts: pa.Array) -> pa.ListArray:
    found = [own.encode(x or "") for x in texts.to_pylist()]
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))


def _decoded(own: Codec, ids: pa.ListArray) -> pa.Array:
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    data, ends = own.decode(ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(lengths)])]
    raw = data.tobytes()
    return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)], pa.string())


def _text_slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    return _slices(batch, pc.fill_null(pc.utf8_length(batch.column(at)), 0).to_pylist())


def _id_slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    return _slices(batch, [5 * n for n in pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_pylist()])


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", keep_text: bool = True) -> DataFrame:
    """df with the token ids of a column of texts. vocabulary: path of a tokenizers file, read on the driver."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary: bounded
    df = _room(df, ids, text)
    at = df.columns.index(text)
    keep_text = keep_text and ids.lower() != text.lower()
    schema = T.StructType([f for f in df.schema.fields if keep_text or f.name != text] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        for whole in batches:
            for batch in _text_slices(whole, at):
                kept = [c for i, c in enumerate(batch.columns) if keep_text or i != at]
                yield pa.RecordBatch.from_arrays([*kept, _encoded(own, batch.column(at))], names=schema.names)

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """df with the texts of a column of token ids; null ids count as none. Bytes that are no UTF-8 become U+FFFD."""
    with open(vocabulary, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())
    df = _room(df, text, ids)
    at = df.columns.index(ids)
    keep_ids = text.lower() != ids.lower()
    schema = T.StructType([f for f in df.schema.fields if keep_ids or f.name != ids] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        for whole in batches:
            for batch in _id_slices(whole, at):
                kept = [c for i, c in enumerate(batch.columns) if keep_ids or i != at]
                yield pa.RecordBatch.from_arrays([*kept, _decoded(own, batch.column(at))], names=schema.names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, vocabulary: str, keep_text: bool = True) -> DataFrame:
    """decode(encode(df)) of a column named text, with the columns ids and decoded: one worker a task has the tables and does both."""
    bound_batches(df.sparkSession)
    with open(vocabulary, encoding="utf-8") as file:
        spec = df.sparkSession.sparkContext.broadcast(file.read())
    df = _room(_room(df, "ids", "text"), "decoded", "text")
    at = df.columns.index("text")
    schema = T.StructType([f for f in df.schema.fields if keep_text or f.name != "text"] + [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(spec.value)
        for whole in batches:
            for batch in _text_slices(whole, at):
                kept = [c for i, c in enumerate(batch.columns) if keep_text or i != at]
                coded = pa.RecordBatch.from_arrays([*kept, _encoded(own, batch.column(at))], names=schema.names[:-1])
                for part in _id_slices(coded, len(kept)):
                    yield pa.RecordBatch.from_arrays([*part.columns, _decoded(own, part.column(len(kept)))], names=schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, vocabulary: str) -> DataFrame:
    """Per document: n_tokens, and hex digests of its ids and of the text that they decode to."""
    coded = round_trip(df.select("doc_id", "text"), vocabulary, keep_text=False)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


__all__ = ["Codec", "codec", "decode", "digests", "encode", "round_trip"]
