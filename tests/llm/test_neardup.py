import random

import numpy as np

from linkloom.llm import neardup
from linkloom.llm.graph import components


def shingle_set(text, width=5):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < width else frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, percent):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        r = find(i)
        least[r] = k if least.get(r) is None else least[r] if k is None else min(k, least[r])
    return sorted(((k, len(sets[i]), least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows)), key=str)


def family(dice, n_words, copies, changes):
    base = [f"w{dice.randrange(5000)}" for _ in range(n_words)]
    for _ in range(copies):
        own = list(base)
        for _ in range(dice.randrange(changes + 1)):
            own[dice.randrange(n_words)] = f"x{dice.randrange(10**6)}"
        yield " ".join(own)


def test_by_brute_force(spark, monkeypatch):
    dice = random.Random(6)
    texts = [t for n, c, k in ((150, 60, 5), (40, 20, 2), (12, 10, 1), (300, 30, 12)) for t in family(dice, n, c, k)] + [" ".join(f"v{dice.randrange(10**5)}" for _ in range(dice.randrange(60))) for _ in range(80)]
    texts += [None, "", " \t\n", "a b", "A  b\t", "a b c", "É é", "É É", "z " * 30_000] + texts[:5]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (0, texts[0]), (0, "other text with the same id as one before it")]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string").repartition(3)
    for percent, block in ((85, neardup.BLOCK), (80, 2000)):
        monkeypatch.setattr(neardup, "BLOCK", block)
        found = sorted((tuple(r) for r in neardup.near_duplicates(df, percent=percent).collect()), key=str)
        assert found == brute(rows, percent)
    kept = neardup.deduplicate(df, percent=80)
    assert kept.columns == df.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    pairs = [(shingle_set(a[1]), shingle_set(b[1])) for i, a in enumerate(left) for b in left[:i]]
    assert not any(a and b and 100 * len(a & b) >= 80 * len(a | b) for a, b in pairs)
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_near_copies_without_an_id(spark):
    """Texts that occur with a null id only are compared like others, and connect what is near them."""
    words = [f"n{i}" for i in range(100)]
    one, bridge, two = words, [*words[:98], "x", "y"], [*words[2:98], "x", "y", "z", "u"]
    far = [f"f{i}" for i in range(60)]
    rows = [(1, " ".join(one)), (None, " ".join(bridge)), (None, " ".join(bridge)), (2, " ".join(two)), (None, " ".join(far)), (None, " ".join([*far[:-1], "end"])), (3, "no other like it")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute(rows, 90)
    assert (2, 96, 1, False) in expected and (None, 96, 1, False) in expected
    assert sorted((tuple(r) for r in neardup.near_duplicates(df, percent=90).collect()), key=str) == expected
    left = sorted((r["doc_id"] or 0, r["text"].split()[0]) for r in neardup.deduplicate(df, percent=90).collect())
    assert left == [(0, "f0"), (1, "n0"), (3, "no")]


def test_one_id_with_many_texts(spark):
    """Rows are told apart by id and text, so near copies under one id, and under none, are found among others."""
    dice = random.Random(3)
    rows = [(7, " ".join(f"t{i}w{j}" for j in range(20))) for i in range(700)]
    rows += [(7 if i % 2 else None, t) for i, t in enumerate(family(dice, 200, 60, 3))] + [(3, t) for t in family(dice, 200, 5, 3)] + rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in neardup.near_duplicates(df, percent=85).collect()), key=str) == brute(rows, 85)


def test_large_family(spark):
    """A region of more than MANY rows, compared in many groups: no near copy is lost, and the two kinds stay apart."""
    dice = random.Random(2)
    base = [f"w{i}" for i in range(60)]
    other = [*base[:45], *(f"o{i}" for i in range(15))]  # some regions are shared, no link is
    rows = []
    for i in range(neardup.MANY + 1500):
        own = list(other if i % 8 == 0 else base)
        own[-1 - dice.randrange(2)] = f"x{i}"
        rows.append((i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(df, percent=85).collect()
    assert all(r["component_id"] == (0 if r["doc_id"] % 8 == 0 else 1) for r in found) and len(found) == len(rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f", 1, 2, 3), (2, "a b c d e f", 4, 5, 6)], "doc_id long, text string, _hash int, _id int, _hash_of_text int")
    assert [tuple(r) for r in neardup.deduplicate(df).collect()] == [(1, "a b c d e f", 1, 2, 3)]


def test_linked_both_ways():
    random_ = np.random.default_rng(1)
    sets = [np.unique(random_.integers(0, 400, 60).astype(np.uint64)) for _ in range(12)] + [np.arange(50, dtype=np.uint64)] * 2
    many = neardup.linked(sets, sets, 10)
    few = np.array([[neardup.linked([a], [b], 10)[0, 0] for b in sets] for a in sets])
    assert (many == few).all() and many.any() and not many.all()


def test_dense_regions():
    """Very large regions: neighbours that agree in full stay together."""
    import pyarrow as pa
    from pyspark import TaskContext

    rows = [(0, b"\0" * 12 + (i % 3).to_bytes(4), i.to_bytes(16)) for i in range(neardup.MANY + 500)]
    rows.sort()
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["tree", "signature", "key"])
    TaskContext._taskContext, before = type("Context", (), {"partitionId": lambda self: 0})(), TaskContext._taskContext
    try:
        out = [r for b in neardup._neighbours(iter([batch])) for r in b.to_pylist()]
    finally:
        TaskContext._taskContext = before
    assert len([r for r in out if r["part"] is None]) == len(rows) - 3 and len([r for r in out if r["part"] is not None]) == 2


def test_components(spark):
    dice = random.Random(8)
    edges = [(dice.randrange(300), dice.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(1000, 1200)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
