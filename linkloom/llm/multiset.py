"""Homomorphic multiset hash of a text's paragraphs, as DataFrame functions only.

A paragraph (a line) is hashed to a wide vector, and a text's fingerprint is the sum of its paragraphs' vectors,
each lane modulo a power of two. So the order of paragraphs doesn't matter, and a paragraph is put in or
taken out by adding or subtracting its own fingerprint. A vector has
  1023 lanes of 16 bits, three to a long, drawn from the paragraph's SHA-256: these decide equality; and
  128 lanes of 30 bits, two to a long, with a count: each piece of a paragraph (up to four words, or up to a
  punctuation mark; of a run of more than 32 characters, so many at a time) adds one to the lanes where its hash has a bit set.
  As plus or minus one these are a sketch, whose cosine estimates how alike the pieces of two texts are, with a standard
  error of 0.09 at most (one over the root of 128).

Documents are put in order by ranges of (id, hash of the text), as many as four for each shuffle partition, so that neither more documents nor an
id that many rows share makes a range larger than others. Only rows that are equal in both are in one range.

Cases: a null text counts as empty, which has one empty paragraph; equal fingerprints are alike by 1; otherwise a
text without pieces is like none. The document after the last is the first one. Null ids come after all
others; rows with the same id come by the hash of their text. Repeated rows stay, an empty table gives no
rows, and further columns are ignored.
"""

from __future__ import annotations

import json
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.common import text_or_empty

PIECE = r"(?:[^\s.,;:!?|]{1,32}+[ \t]++){0,3}\S{1,32}+"


def _each(value: int, stride: int, fields: int) -> int:
    """A long with the same value in each of its fields."""
    return sum(value << (stride * i) for i in range(fields))


#: Longs of the wide part, and the bits of its lanes; three to a long.
WIDE, LANE = 341, 2**16
WIDE_FULL, WIDE_MORE = _each(LANE - 1, 21, 3), _each(LANE, 21, 3)
#: Hashes of a piece, the longs of each hash's lanes, and how far these count; two to a long.
HASHES, WORDS, FIELD = 2, 32, 2**30
ONES, FULL, MORE = _each(1, 32, 2), _each(FIELD - 1, 32, 2), _each(FIELD, 32, 2)
#: Documents in a range of ids at least, and ranges for each shuffle partition at most.
RANGE, RANGES = 500, 4


def _planes(hashes: Column) -> Column:
    """array<struct<ones, twos, fours>>: seven hashes at a time, how often each bit is set in them, as three bits of a number."""
    xor = lambda *xs: reduce(lambda a, b: a.bitwiseXOR(b), xs)
    carry = lambda a, b, c: a.bitwiseAND(b).bitwiseOR(c.bitwiseAND(a.bitwiseXOR(b)))
    at = lambda g, k: F.coalesce(F.get(hashes, 7 * g + k), F.lit(0).cast("long"))
    seven = F.transform(F.sequence(F.lit(0), F.floor(F.size(hashes) / 7).cast("int")), lambda g: F.struct(*(at(g, k).alias(f"h{k}") for k in range(7))))

    def first(x: Column) -> Column:
        a, b = [x[f"h{k}"] for k in range(3)], [x[f"h{k}"] for k in range(3, 6)]
        return F.struct(xor(*a).alias("s"), carry(*a).alias("c"), xor(*b).alias("t"), carry(*b).alias("d"), x["h6"].alias("h"))

    def second(x: Column) -> Column:
        return F.struct(xor(x["s"], x["t"], x["h"]).alias("ones"), x["c"].alias("c"), x["d"].alias("d"), carry(x["s"], x["t"], x["h"]).alias("e"))

    def third(x: Column) -> Column:
        return F.struct(x["ones"].alias("ones"), xor(x["c"], x["d"], x["e"]).alias("twos"), carry(x["c"], x["d"], x["e"]).alias("fours"))

    return F.transform(F.transform(F.transform(seven, first), second), third)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with struct(wide array<long>, n long, lanes array<long>)."""
    digests = F.transform(F.split(F.col(text), "\n"), lambda p: F.sha2(p, 256))
    pieces = F.regexp_extract_all(F.col(text), F.lit(PIECE), F.lit(0))
    zero = F.lit(0).cast("long")
    # generators between the steps keep Spark from working the arrays out once for each lane
    parts = df.select("*", F.explode(F.array(F.struct(digests.alias("d"), pieces.alias("p")))).alias("_parts"))
    hashed = F.transform(F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda s: F.transform("_parts.p", lambda p: F.xxhash64(s, p)))
    parts = parts.select(*df.columns, F.col("_parts.d").alias("_digests"), F.explode(F.array(F.struct(hashed.alias("h")))).alias("_hashed"))

    def wide(i: Column) -> Column:
        return F.aggregate("_digests", zero, lambda a, d: (a + F.xxhash64(i, d).bitwiseAND(F.lit(WIDE_FULL))).bitwiseAND(F.lit(WIDE_FULL)))

    def lanes(hashes: Column) -> Column:
        bit = lambda h, i: F.call_function("shiftright", h, i).bitwiseAND(F.lit(ONES))
        added = lambda a, x, i: a + bit(x["ones"], i) + 2 * bit(x["twos"], i) + 4 * bit(x["fours"], i)
        own = lambda planes: F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda i: F.aggregate(planes, zero, lambda a, x: added(a, x, i), lambda a: a.bitwiseAND(F.lit(FULL))))
        return F.element_at(F.transform(F.array(_planes(hashes)), own), 1)

    n = (F.size(F.col("_hashed.h")[0]) % FIELD).cast("long")
    made = F.struct(F.transform(F.sequence(F.lit(0), F.lit(WIDE - 1)), wide).alias("wide"), n.alias("n"), F.flatten(F.transform("_hashed.h", lanes)).alias("lanes"))
    return parts.select(*df.columns, F.explode(F.array(made)).alias(name))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of a's paragraphs with b's put in (1) or taken out (-1)."""
    both = lambda c, more, full: F.zip_with(a[c], b[c], lambda x, y: (x + y if sign > 0 else x + F.lit(more) - y).bitwiseAND(F.lit(full)))
    return F.struct(both("wide", WIDE_MORE, WIDE_FULL).alias("wide"), F.pmod(a["n"] + sign * b["n"], F.lit(FIELD)).cast("long").alias("n"), both("lanes", MORE, FULL).alias("lanes"))


def as_text(f: Column) -> Column:
    """All of a fingerprint, as numbers joined by commas."""
    return F.array_join(F.concat(f["wide"], F.array(f["n"]), f["lanes"]).cast("array<string>"), ",")


def sketch(f: Column) -> Column:
    """struct(digest, n, lanes): what two texts are held against each other by. digest: SHA-256 of the whole fingerprint."""
    return F.struct(F.sha2(as_text(f), 256).alias("digest"), f["n"].alias("n"), f["lanes"].alias("lanes"))


def signed(f: Column) -> Column:
    """The lanes as sums of plus and minus one."""
    one = lambda x: (F.pmod(2 * x.bitwiseAND(F.lit(FIELD - 1)) - f["n"] + FIELD // 2, F.lit(FIELD)) - FIELD // 2).cast("double")
    return F.concat(F.transform(f["lanes"], one), F.transform(f["lanes"], lambda x: one(F.shiftright(x, 32))))


def likeness(a: Column, b: Column, va: Column, vb: Column) -> Column:
    """From 0 to 1, of two sketches. va, vb: signed() of both."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, p: s + p)
    size = F.sqrt(dot(va, va)) * F.sqrt(dot(vb, vb))
    return F.when(a["digest"] == b["digest"], F.lit(1.0)).when(size > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(va, vb) / size))).otherwise(F.lit(0.0))


PLACE = "struct<none:boolean,id:bigint,hash:bigint>"


def _search(place: Column, bounds: list[tuple[bool, int, int]]) -> tuple[Column, Column]:
    """How many of the sorted bounds are no larger than a place, and the last of these (null if none); found in two steps."""
    step = max(1, ceil(len(bounds) ** 0.5))
    rows = [dict(zip(("none", "id", "hash"), b, strict=True)) for b in bounds]
    constant = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    reached = lambda xs: F.size(F.filter(xs, lambda b: b <= place))
    if not rows:
        return F.lit(0), F.lit(None).cast(PLACE)
    coarse = reached(constant(rows[::step], f"array<{PLACE}>"))
    chunk = F.get(constant([rows[i : i + step] for i in range(0, len(rows), step)], f"array<array<{PLACE}>>"), F.greatest(coarse - 1, F.lit(0)))
    fine = reached(chunk)
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine), F.when(coarse > 0, F.get(chunk, fine - 1))


def _place(id: str, order: str) -> Column:
    return F.struct(F.col(id).isNull().alias("none"), F.coalesce(F.col(id), F.lit(0)).cast("long").alias("id"), F.col(order).alias("hash"))


def cuts(df: DataFrame, id: str, order: str) -> list[tuple[bool, int, int]]:
    """Where the ranges of df begin."""
    keys = df.select(_place(id, order).alias("p"))
    n = max(1, min(RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil(df.count() / RANGE)))
    # the least place of each part of the keys put in order: n rows
    found = keys.repartitionByRange(n, "p").groupBy(F.spark_partition_id()).agg(F.min("p").alias("p")).select("p.*").collect()
    return sorted(tuple(r) for r in found)


def with_next(df: DataFrame, id: str, order: str, columns: list[str], bounds: list[tuple[bool, int, int]]) -> DataFrame:
    """df with next_<column>: the values of the row after it by id, then `order` (a hash); after the last row comes the first.

    bounds: cuts() of df. Each range gets, besides its own rows, a copy of the first row of the range after it, so that no row needs another range.
    """
    place = _place(id, order)
    first, last = bounds[:1], max(0, len(bounds) - 1)
    own, reached = _search(place, bounds[1:])
    copies = F.when(place == reached, F.array(own - 1)).otherwise(F.array().cast("array<int>"))
    if first:
        start = F.struct(*(F.lit(x).cast(t).alias(c) for x, t, c in zip(first[0], ("boolean", "long", "long"), ("none", "id", "hash"), strict=True)))
        copies = F.concat(copies, F.when(place == start, F.array(F.lit(last))).otherwise(F.array().cast("array<int>")))
    both = F.concat(F.array(F.struct(own.alias("range"), F.lit(False).alias("copy"))), F.transform(copies, lambda b: F.struct(b.alias("range"), F.lit(True).alias("copy"))))
    dealt = df.select(*df.columns, F.explode(both).alias("_at"))
    w = Window.partitionBy("_at.range").orderBy(F.col("_at.copy"), F.asc_nulls_last(id), order)
    led = dealt.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in columns))
    return led.where("not _at.copy").drop("_at")


def edits(documents: DataFrame) -> DataFrame:
    """Per document: the fingerprints of its text and its edited text, as digests, and how alike they and the next document's are.

    Edited: the last quarter of the code points gives way to as many from the start of the next document.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    docs = docs.withColumn("h", F.xxhash64("text"))
    # what goes through the shuffle is the sketch, not the wide part
    marked = with_fingerprint(docs, "text", "f").select("doc_id", "text", "h", sketch(F.col("f")).alias("f"))
    led = with_next(marked, "doc_id", "h", ["text", "f"], cuts(docs, "doc_id", "h"))
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - quarter), F.coalesce(F.col("next_text"), F.lit("")).substr(F.lit(1), quarter))
    both = with_fingerprint(led.select("doc_id", "f", "next_f", n.cast("long").alias("n_chars"), edited.alias("edited")), "edited", "g").withColumn("g", sketch(F.col("g")))
    lanes = both.select("*", F.explode(F.array(F.struct(*(signed(F.col(c)).alias(c) for c in ("f", "g", "next_f"))))).alias("v"))
    return lanes.select(
        "doc_id", "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.col("f.digest").alias("fingerprint"),
        F.col("g.digest").alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g"), F.col("v.f"), F.col("v.g")).alias("near_edited"),
        F.coalesce(likeness(F.col("f"), F.col("next_f"), F.col("v.f"), F.col("v.next_f")), F.lit(0.0)).alias("near_next"),
    )
