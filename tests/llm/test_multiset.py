import hashlib
import math
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from linkloom.llm import multiset


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return multiset.with_fingerprint(df, "text", "f")


def test_a_multiset(spark):
    a, b = "one two three\nfour five", "six seven, eight"
    df = prints(spark, [f"{a}\n{b}", f"{b}\n{a}", a, b, f"{a}\n{a}", "", "\n"])
    f = {r["i"]: r["s"] for r in df.select("i", multiset.as_text(F.col("f")).alias("s")).collect()}
    assert f[0] == f[1] and len(set(f.values())) == 6
    rows = df.groupBy().pivot("i", list(range(7))).agg(F.first("f"))
    both = multiset.combine(F.col("2"), F.col("3"))
    out = rows.select(multiset.as_text(both).alias("put"), multiset.as_text(multiset.combine(both, F.col("3"), -1)).alias("out"), multiset.as_text(multiset.combine(F.col("3"), F.col("0"), -1)).alias("less"), multiset.as_text(multiset.combine(multiset.combine(F.col("3"), F.col("0"), -1), F.col("0"))).alias("back")).first()
    assert out["put"] == f[0] and out["out"] == f[2] and out["back"] == f[3] and out["less"] != f[3]


def cosine(a, b):
    if a == b:
        return 1.0
    a, b = (Counter(re.findall(r"(?:[^\s.,;:!?|]{1,32}+[ \t]++){0,3}\S{1,32}+", t)) for t in (a, b))
    size = math.sqrt(sum(n * n for n in a.values()) * sum(n * n for n in b.values()))
    return sum(n * b[x] for x, n in a.items()) / size if size else 0.0


def test_edits_by_brute_force(spark):
    texts = {i: f"paragraph {i} has words\n" * (i % 4) + f"and {i} 😀 more, of them; all told." * (i % 9) for i in range(40)}
    off = []
    texts |= {50: "", 51: "x", 52: "y" * 30_000, 53: texts[5]}
    rows = [(i, t, 0) for i, t in texts.items()] + [(60, None, 0)]
    for n in (3, 500):
        multiset.RANGE, before = n, multiset.RANGE
        try:
            found = {r["doc_id"]: r for r in multiset.edits(spark.createDataFrame(rows, "doc_id long, text string, f int").repartition(4)).collect()}
        finally:
            multiset.RANGE = before
        order = sorted(i for i, _, _ in rows)
        own = {i: t or "" for i, t, _ in rows}
        for k, i in enumerate(order):
            text, after = own[i], own[order[(k + 1) % len(order)]]
            c = len(text) // 4
            edited = text[: len(text) - c] + after[:c]
            r = found[i]
            assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest(), i
            assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            assert (r["fingerprint"] == r["edited_fingerprint"]) == (text == edited) and (text != edited or r["near_edited"] == 1)
        assert found[5]["fingerprint"] == found[53]["fingerprint"]
        for k, i in enumerate(order):  # the sketch is near the cosine of the pieces' numbers
            text, after = own[i], own[order[(k + 1) % len(order)]]
            c = len(text) // 4
            for other, near in ((text[: len(text) - c] + after[:c], "near_edited"), (after, "near_next")):
                assert abs(found[i][near] - cosine(text, other)) < 0.35, i
            off += [abs(found[i][near] - cosine(text, other))]
    assert sum(off) / len(off) < 0.06


def test_edges(spark):
    schema = "doc_id long, text string"
    assert multiset.edits(spark.createDataFrame([], schema)).count() == 0
    one = multiset.edits(spark.createDataFrame([(1, "abcdefgh")], schema)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1
    twice = multiset.edits(spark.createDataFrame([(1, "aaaa"), (1, "aaaa"), (1, "bbbb"), (None, "c")], schema)).collect()
    assert len(twice) == 4
    nulls = multiset.edits(spark.createDataFrame([(None, "abcd"), (None, "efgh")], schema)).collect()
    assert len(nulls) == 2


def test_wide_lanes_by_definition(spark):
    """Sums of what is drawn from each paragraph's SHA-256, lane by lane; one character more changes about all of them."""
    texts = ["one two\nthree\none two", "one two\nthree\none twO", ""]
    found = {r["i"]: r["f"]["wide"] for r in prints(spark, texts).collect()}
    lanes = lambda x: [x >> (21 * k) & 0xFFFF for k in range(3)]
    for i, t in enumerate(texts):
        want = [[0] * 3 for _ in range(multiset.WIDE)]
        for p in t.split("\n"):
            digest = hashlib.sha256(p.encode()).hexdigest()
            for k in range(multiset.WIDE):
                first = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), seed=42)
                drawn = lanes(xxhash.xxh64_intdigest(digest.encode(), seed=first))
                want[k] = [(a + b) % 2**16 for a, b in zip(want[k], drawn, strict=True)]
        assert [lanes(x) for x in found[i]] == want
    assert sum(a != b for a, b in zip(found[0], found[1], strict=True)) >= multiset.WIDE - 1


def test_one_id_for_many_rows(spark):
    """Ranges are cut within an id, and within those without one."""
    rows = [(7, f"text {i}") for i in range(300)] + [(None, f"no id {i}") for i in range(300)] + [(i, f"t {i}") for i in range(5)] + [(7, "text 1")] * 3
    multiset.RANGE, before = 20, multiset.RANGE
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found = multiset.edits(df).collect()
        marked = df.select("doc_id", "text", F.xxhash64("text").alias("h"))
        led = multiset.with_next(marked, "doc_id", "h", ["text", "doc_id"], multiset.cuts(marked, "doc_id", "h")).collect()
    finally:
        multiset.RANGE = before
    order = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["h"]), r["text"]) for r in led)
    after = {}
    for (_, a), (_, b) in zip(order, [*order[1:], order[0]], strict=True):
        after.setdefault(a, []).append(b)
    assert len(found) == len(rows) and {a: sorted(b) for a, b in after.items()} == {t: sorted(r["next_text"] for r in led if r["text"] == t) for t in after}


def test_long_texts(spark):
    """Many equal pieces don't wrap; a text without spaces has pieces too."""
    texts = [(1, "word, " * 400_000), (2, "ab" * 20_000), (3, "")]
    found = {r["doc_id"]: r for r in multiset.edits(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found[1]["near_edited"] > 0.7 and found[2]["near_edited"] > 0.7 and found[1]["near_next"] < 0.4
