import random
from collections import Counter

import numpy as np
import xxhash

from linkloom.llm import kneser
from linkloom.llm.common import materialize

TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "ça va", "the cat"]


def brute(texts):
    """p(gram) for grams of the highest order, by the definition."""
    n = kneser.ORDER
    tables = {n: Counter()}
    for t in texts:
        raw = bytes(n - 1) + t.encode()
        tables[n].update(raw[i : i + n] for i in range(len(raw) - n + 1))
    for k in range(n - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    off = {}
    for k, c in tables.items():
        n1, n2, n3, n4 = (sum(v == i for v in c.values()) for i in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 else 0.5
        r = lambda a, b: a / b if b else 0.5
        own = (1 - 2 * y * r(n2, n1), 2 - 3 * y * r(n3, n2), 3 - 4 * y * r(n4, n3))
        off[k] = [min(max(d, 0.05), i - 0.05) for i, d in enumerate(own, 1)]

    def p(g):
        if not g:
            return 1 / 256
        k = len(g)
        after = {h: c for h, c in tables[k].items() if h[:-1] == g[:-1]}
        if not after:
            return p(g[1:])
        total = sum(after.values())
        d = lambda c: off[k][min(c, 3) - 1]
        return (max(after[g] - d(after[g]), 0) if g in after else 0) / total + sum(map(d, after.values())) / total * p(g[1:])

    return p


def packed(g):
    return int.from_bytes(g, "big")


def test_probabilities_by_definition(spark, monkeypatch):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    p = brute(TEXTS)
    asked = [bytes(a) for a in (b"the c", b"the d", b"e cat", b"zzzzz", b"xthe ", b"\x00\x00\x00\x00t", b"n the", "aça".encode() + b" ")]
    model = kneser.Model(materialize(kneser.counts(df), "test"))
    costs = {r["gram"]: r["nats"] for r in model.costs(spark.createDataFrame([(packed(g[-kneser.ORDER :]),) for g in asked], "gram long")).collect()}
    assert all(np.isclose(np.exp(-costs[packed(g[-kneser.ORDER :])]), p(g[-kneser.ORDER :]), rtol=1e-4) for g in asked)
    texts = [*TEXTS, "", None, "the bird sat", "the cat"] * 3
    own = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, _kept_0 string, _chunk int")
    for size in (kneser.CHUNK, 20):  # one chunk, and many
        monkeypatch.setattr(kneser, "CHUNK", size)
        scored = kneser.score(own, model, keep=("doc_id", "text", "_kept_0", "_chunk")).collect()
        assert sorted(r["doc_id"] for r in scored) == list(range(len(texts))) and all(r["_kept_0"] == "x" and r["_chunk"] == 1 and r["text"] == texts[r["doc_id"]] for r in scored)
        for r in scored:
            raw = bytes(kneser.ORDER - 1) + (r["text"] or "").encode()
            want = -sum(np.log(p(raw[i : i + kneser.ORDER])) for i in range(len(raw) - kneser.ORDER + 1))
            assert np.isclose(r["nats"], want, rtol=1e-4) and r["n_bytes"] == len((r["text"] or "").encode())
    assert np.isclose(sum(p(b"the " + bytes([b])) for b in range(256)), 1)


def test_rows(spark):
    good = [(i, f"the quiet river ran past the old stone mill {i % 17} and the miller slept", "en" if i % 2 else None) for i in range(200)]
    odd = [(500, None, "en"), (501, "", "en"), (502, "#@!% ^^&& **(( ))" * 40, "en"), (503, "QQXZ!! ZXQQ!! " * 3000, "fr"), (3, good[3][1], "en"), (None, good[5][1], "en")]
    df = spark.createDataFrame(good + odd, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(160)] + [(1, 1, 0), (None, 1, 0), (502, 0, 0)], "doc_id long, quality int, toxic int")
    found = kneser.classify(df, labels, keep=("doc_id", "text")).collect()
    assert len(found) == len(good + odd)
    assert {r["doc_id"] for r in found if r["rejected"]} == {500, 501, 502, 503}
    assert all(r["perplexity"] is None for r in found if not r["text"])
    none = kneser.classify(df, labels.limit(0)).collect()
    assert {r["doc_id"] for r in none if r["rejected"]} == {500, 501} and all(r["perplexity"] is None for r in none)
    assert kneser.classify(df.limit(0), labels).count() == 0


def test_thresholds_by_brute_force(spark):
    """`rejected` again, by plain Python from the perplexities' definition: halves, means by language, quantiles, margin."""
    dice = random.Random(5)
    words = {"en": "the river and stone mill ran past old quiet".split(), "de": "der fluss und stein lief an alten stillen".split()}
    rows = [(i, " ".join(dice.choice(words[lang]) for _ in range(dice.randrange(3, 40))), lang) for i in range(160) for lang in [dice.choice(["en", "de"])]]
    rows += [(200 + i, "".join(chr(dice.randrange(33, 126)) for _ in range(60 * (i + 1))), "en") for i in range(4)] + [(300, "the river", "fr"), (301, None, "en"), (302, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), int(i % 7 == 0)) for i in range(160)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in kneser.classify(df, labels, quantile=0.9).collect()}
    trusted = [(t, lang) for i, t, lang in rows if i < 160 and i % 5 and i % 7]

    def half(t):
        first = xxhash.xxh64_intdigest((3).to_bytes(4, "little"), seed=42)
        x = xxhash.xxh64_intdigest(t.encode(), seed=first)
        return (x - 2**64 if x >= 2**63 else x) % 2

    p = brute([t for t, _ in trusted if half(t) == 0])

    def nats(t):
        raw = bytes(kneser.ORDER - 1) + t.encode()
        return -sum(np.log(p(raw[i : i + kneser.ORDER])) for i in range(len(raw) - kneser.ORDER + 1)), len(t.encode())

    judged = [(lang, *nats(t)) for t, lang in trusted if half(t) == 1]
    mean = lambda own: sum(a for _, a, _ in own) / sum(n for _, _, n in own)
    means = {lang: mean([x for x in judged if x[0] == lang]) for lang in ("en", "de")}
    drawn = lambda a, n, m: (a + kneser.PRIOR * m) / (n + kneser.PRIOR)
    cut = lambda xs: sorted(xs)[int(np.ceil(0.9 * len(xs))) - 1]
    costs = [(lang, drawn(a, n, means[lang])) for lang, a, n in judged]
    least = {lang: cut([c for x, c in costs if x == lang]) for lang in means}
    for i, t, lang in rows:
        if not t:
            assert found[i]["rejected"] and found[i]["perplexity"] is None
            continue
        a, n = nats(t)
        most = least.get(lang, cut([c for _, c in costs])) + kneser.MARGIN
        assert found[i]["rejected"] == (drawn(a, n, means.get(lang, mean(judged))) > most)
        assert found[i]["rejected"] == (found[i]["drawn_perplexity"] > found[i]["threshold"])
        assert np.isclose(found[i]["perplexity"], np.exp(a / n), rtol=1e-4) and np.isclose(found[i]["threshold"], np.exp(most), rtol=1e-4)
    assert {i for i, r in found.items() if r["rejected"]} >= {200, 201, 202, 203, 301, 302}
