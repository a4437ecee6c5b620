import math
import random

import numpy as np
import pytest

from linkloom.llm import hardneg, vafile

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, n=5, low=80):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    data = [(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows if i is not None and label is not None and fine(v)]
    out = []
    for a, own, v in set(d for d in data if d[0] % every == 0):
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, label) for i, label, w in data if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scored if x[2] == own][:n]:
            inside = [(t, i) for t, i, label in scored if label != own and low * -s <= 100 * -t <= 100 * -s][:n]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(inside)]
    return sorted(out)


def came(df):
    return sorted(tuple(r) for r in df.collect())


def test_by_brute_force(spark, monkeypatch):
    dice = random.Random(7)
    base = [[dice.uniform(-1, 1) for _ in range(6)] for _ in range(6)]
    near = lambda: [x + dice.uniform(-0.3, 0.3) for x in dice.choice(base)]
    rows = [(i, near(), i % 3) for i in range(500)]
    rows += [(i, base[0], i % 4) for i in range(500, 640)]  # ties
    rows += [(700, None, 1), (800, [1.0, None] * 3, 1), (900, [math.nan] * 6, 1), (1000, [math.inf] * 6, 1), (1100, near(), None), (1200, [1.0, 2.0], 0), (1201, [1.0, 2.0], 0), (1202, [0.9, 2.0], 1), (None, near(), 1), (1300, [], 1)]
    rows += [(100, near(), 1), (200, *rows[200][1:]), (301, *rows[301][1:]), (301, *rows[301][1:]), (1400, [0.0] * 6, 1), (1500, [-x for x in base[0]], 2)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], f"{SCHEMA}, score double").repartition(4)
    want = brute(rows)
    assert len(want) > 50
    for blocks, held in (((512, 4096, 16), 500_000), ((3, 40, 2), 30)):
        for name, value in zip(("ANCHOR_BLOCK", "DATA_BLOCK", "AT_ONCE"), blocks, strict=True):
            monkeypatch.setattr(hardneg, name, value)
        monkeypatch.setattr(hardneg, "HELD", held)
        assert came(hardneg.hard_negatives(df)) == want
    assert hardneg.hard_negatives(df.limit(0)).count() == 0
    assert came(hardneg.hard_negatives(df, low=50, n_negatives=2, every=70)) == [r for r in brute(rows, 70, 5, 50) if r[2] <= 2]


def test_one_vector_many_times(spark):
    """A third of all rows have one vector, under two labels; a hot anchor's class is read by all its anchors."""
    dice = random.Random(5)
    base = [dice.uniform(-1, 1) for _ in range(8)]
    rows = [(i, base, i // 50 % 2) for i in range(1200)] + [(2000 + i, [x + dice.uniform(-0.05, 0.05) for x in base], i % 3) for i in range(600)]
    assert came(hardneg.hard_negatives(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_scores_beyond_a_long(spark):
    rows = [(0, [3e38, 3e38], 0), (1, [3e38, 3e38], 0), (2, [1.0, 1.0], 0), (3, [1.0, 2.0], 1), (100, [1.0, 2.0], 0), (101, [2.0, 2.0], 0), (102, [2.0, 1.9], 1)]
    found = came(hardneg.hard_negatives(spark.createDataFrame(rows, SCHEMA)))
    assert (100, 101, 1, 102, 6 * 65536, 2 * 65536 + 512 * math.floor(256 * float(np.float32(1.9)))) in found and all(a == 100 and p not in (0, 1) for a, p, *_ in found)


@pytest.mark.parametrize("scale", [3, 200, 10**7, 2**62])
def test_bounds_hold(scale):
    random_ = np.random.default_rng(3)
    block = random_.integers(-scale, scale, (1000, 16))
    cells, low, width = vafile.cells_of(block)
    lowest, highest = hardneg.bounds(block[:20], np.ascontiguousarray(cells.T), low, width)
    exact = block[:20].astype(object) @ block.T.astype(object)
    assert (exact >= lowest.astype(object)).all() and (exact <= highest.astype(object)).all()
    assert scale != 200 or (highest - lowest).max() < 16 * 200 * 3  # a cell holds a value or two


def test_no_cross_join(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    blocks = spark.createDataFrame([], hardneg.ANCHOR_FILE)
    plan = hardneg._met(blocks, spark.createDataFrame([], hardneg.CELL_FILE))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and df.count()
