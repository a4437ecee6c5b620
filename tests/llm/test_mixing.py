import itertools
import random
import re

from pyspark.sql import functions as F

from linkloom.llm import mixing


def targets(sizes, weights=(1, 2, 3), most=3):
    """By rounds: all words by weight; what is above the limit gets it, the rest is shared again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    found, left, total = {}, list(order), sum(sizes.values())
    while left:
        rest, share = total - sum(found.values()), sum(weight[s] for s in left)
        above = [s for s in left if rest * weight[s] / share > most * sizes[s]]
        if not above:
            return found | {s: rest * weight[s] / share for s in left}
        found |= {s: float(most * sizes[s]) for s in above}
        left = [s for s in left if s not in found]
    return found


def test_targets(spark):
    dice = random.Random(1)
    cases = [{"a": 100, "b": 100, None: 100}, {"a": 90, "b": 1, "c": 1}, {"a": 0}, {}, {None: 7}, {"é": 5, "z": 5, "Z": 500, "": 1, "\U0001f600": 3, "\uffff": 4}]
    cases += [{f"s{i}": int(dice.paretovariate(0.5)) for i in range(60)} for _ in range(2)]
    for sizes in cases:
        df = spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(3)
        found = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        want = targets(sizes)
        assert found.keys() == want.keys() and all(abs(found[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want), sizes


def test_flow_by_enumeration():
    cost = lambda n, size: sum(r * max(0, min(size, n - r * size)) for r in range(3))
    for sizes, wanted in (((2, 2, 1), {"a": 4, "b": 3}), ((1, 3, 2), {"a": 5, "b": 8}), ((2, 1, 2), {"a": 0, "b": 20})):
        sizes = dict(zip("pqr", sizes, strict=True))
        given = mixing.route(sizes, {"p": ["a"], "q": ["a", "b"], "r": ["b", "other"]}, wanted)
        best = (0, 0)
        for x in itertools.product(*(range(3 * n + 1) for n in sizes.values())):
            only_a, both, only_b = x
            lack = max(0, wanted["a"] - only_a) + max(0, wanted["b"] - only_b)
            if only_a <= wanted["a"] and only_b <= wanted["b"] and both <= lack:
                best = min(best, (-sum(x), sum(cost(n, s) for n, s in zip(x, sizes.values(), strict=True))))
        assert (-sum(given.values()), sum(cost(given[p], sizes[p]) for p in sizes)) == best


def docs(spark):
    rows = [(i, "w " * (i % 7), None if i % 5 == 4 else f"s{i % 5}", 1) for i in range(300)]
    rows += [(1000, None, "s0", 1), (1001, "", "s9", 1), (1002, "w" * 20_000 + "\tx", "s1", 1), (3, "w " * 3, "s3", 1), (None, "w w", "s2", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")


def test_mix(spark):
    rows, df = docs(spark)
    found = mixing.mix_sources(df).collect()
    assert len(found) == len(rows)
    size = {}
    for _, text, source, _ in rows:
        size[source] = size.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    wanted = targets(size)
    taken = dict.fromkeys(size, 0)
    for r in found:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - wanted[r["source"]]) < 1e-6 and 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in size)
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_taken_row_by_row(spark):
    """Whole passes over a source, and then its documents in the order of their hashes: none is passed over for a later one."""
    rows, df = docs(spark)
    found = mixing.mix_sources(df, keep=("text",))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id", "source", "size", F.xxhash64("text"), "text", F.to_json(F.array("source")), "size"), 64 - mixing.HALF)
    by = {}
    for r in found.withColumn("u", u).collect():
        by.setdefault(r["source"], []).append((r["u"], r["size"], r["taken"], r["target"]))
    for own in by.values():
        left = round(own[0][3])
        total = sum(n for _, n, _, _ in own)
        whole = left // total if total else 0
        left -= whole * total
        for _, n, taken, _ in sorted(own):
            assert taken == whole * n + min(n, left)
            left -= min(n, left)


def test_equal_rows_and_many_sources(spark):
    """One id, and equal rows, many times over; and more sources than any table on the driver would hold for long."""
    rows = [(7, "a b c", "hot")] * 4000 + [(None, f"a b {i}", "hot") for i in range(2000)] + [(i, "x y", f"s{i:05}") for i in range(25_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix_sources(df)
    sums = {r["source"]: r for r in found.groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()}
    want = targets({"hot": 18_000} | {f"s{i:05}": 2 for i in range(25_000)})
    assert len(sums) == 25_001 and all(abs(r["t"] - want[s]) < 1e-6 and abs(r["n"] - r["t"]) <= 1 and r["over"] <= 0 for s, r in sums.items())
    assert found.count() == len(rows)


def test_overlapping_sources(spark):
    df = spark.createDataFrame([(i, 10, ["a", "b"] if i % 3 == 0 else ["a"] if i % 3 == 1 else [], i) for i in range(90)] + [(100 + i, 5, ["c", None], 0) for i in range(10)], "doc_id long, size long, members array<string>, _at int")
    quotas = spark.createDataFrame([("a", 450), ("b", 400), (None, 60), ("zero", 5)], "source string, quota long")
    found = mixing.mix(df, df["members"], quotas).collect()
    assert len(found) == 100 and set(found[0].asDict()) == {"doc_id", "size", "members", "_at", "pattern", "taken"}
    by = {}
    for r in found:
        by[r["pattern"]] = by.get(r["pattern"], 0) + r["taken"]
    assert by == {"[]": 0, '["a"]': by['["a"]'], '["a","b"]': 850 - by['["a"]'], '["c",null]': 60} and by['["a","b"]'] >= 400
    # no word is repeated more often than need be: 450 + 400 of 300 + 300, at most 2 passes over either
    assert all(n <= 600 for p, n in by.items())
