import math
import random

import numpy as np

from linkloom.llm import vafile


def brute(rows, k, every):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    data = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and fine(v)]
    out = []
    for q, v in sorted(set((i, v) for i, v in data if i % every == 0)):
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in data if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_by_brute_force(spark, monkeypatch):
    dice = random.Random(9)
    rows = [(i, [dice.choice([0.0, 0.5, -0.25, dice.uniform(-1, 1)]) for _ in range(6)]) for i in range(400)]
    rows += [(i, [0.5] * 6) for i in range(400, 460)]  # ties
    rows += [(500, None), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [math.nan] * 6), (650, [math.inf] * 6), (700, [1.0, 2.0]), (701, [3.0, 4.0]), (750, []), (None, [0.1] * 6), (50, rows[50][1]), (100, [9.0] * 6), (800, [30000.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    want = brute([(i, v and [x and float(np.float32(x)) for x in v]) for i, v in rows], 5, 50)
    for size, block in ((vafile.QUERY_BLOCK, vafile.DATA_BLOCK), (3, 40)):
        monkeypatch.setattr(vafile, "QUERY_BLOCK", size)
        monkeypatch.setattr(vafile, "DATA_BLOCK", block)
        monkeypatch.setattr(vafile, "HELD", 1_000_000 if size > 3 else 20)
        assert sorted(tuple(r) for r in vafile.top_k(df).collect()) == want
    assert vafile.top_k(df.limit(0)).count() == 0
    few = vafile.top_k(df.where("vec_id in (0, 1)")).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few] == [(0, 1, 1)]


def test_many_equal_vectors(spark):
    """One vector many times over, one id many times over, and near copies of a vector."""
    dice = random.Random(4)
    base = [dice.uniform(-1, 1) for _ in range(8)]
    rows = [(i, base) for i in range(0, 3000)] + [(4000, base)] * 40 + [(4050, [2 * x for x in base])] * 30
    rows += [(5000 + i, [x + dice.uniform(-0.01, 0.01) for x in base]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    want = brute([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 5, 50)
    assert sorted(tuple(r) for r in vafile.top_k(df).collect()) == want


def test_scores_beyond_a_long(spark):
    rows = [(0, [3e38, 3e38]), (50, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [-3e38, 3e38])]
    found = vafile.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found} >= {(50, 1, 1, 11 * 65536), (50, 2, 0, None), (50, 3, 2, None)} and len(found) == 6


def test_bounds_hold():
    random_ = np.random.default_rng(3)
    for scale in (3, 200, 10**7, 2**62):
        block = random_.integers(-scale, scale, (1500, 16))
        cells, low, width = vafile.cells_of(block)
        assert cells.dtype == np.uint8
        middle, radius = vafile.bounds(block[:40], cells, low, width)
        exact = block[:40].astype(object) @ block.T.astype(object)
        assert (np.abs(exact - middle.astype(object)) <= radius[:, None] * (1 + 1e-9)).all()


def test_few_exact_vectors_are_read(spark):
    """The scan of the cells leaves a small part of all vectors to be read."""
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    data = [(r["vec_id"], np.floor(256 * np.array(r["embedding"], float)).astype(np.int64)) for r in df.collect()]
    ids, block = np.array([i for i, _ in data]), np.stack([v for _, v in data])
    found = vafile.Found(5, 4)
    asked = np.flatnonzero(ids % 50 == 0)[:4]
    found.add(ids[asked], block[asked], np.arange(len(ids)), ids, np.ones(len(ids), np.int8), *vafile.cells_of(block))
    q, keys, _, _ = found.rows()
    assert len(q) < 0.1 * 4 * len(ids)
    for i in range(4):
        scores = sorted((-int(block[j] @ block[asked[i]]), ids[j], j) for j in range(len(ids)) if ids[j] != ids[asked[i]])[:5]
        assert {j for *_, j in scores} <= set(keys[q == i].tolist())
