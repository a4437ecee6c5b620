import itertools
import zlib

import numpy as np
import xxhash
from pyspark.sql import functions as F

from linkloom.llm import crf

ROWS = [(t, lang) for i in range(40) for t, lang in ((f"the river and the stone were with them {'abc'[i % 3]}ing", "en"), (f"der fluss und die steine waren mit ihnen {'abc'[i % 3]}ung", "de"))]


def test_forward_backward_by_enumeration():
    random = np.random.default_rng(1)
    lengths = np.array([3, 1, 4])
    scores, moves, start = random.normal(size=(8, 3)), random.normal(size=(3, 3)), random.normal(size=3)
    post, pairs, log_z = crf.forward_backward(scores, lengths, moves, start)
    at, total, want, want_pairs = 0, 0.0, np.zeros((8, 3)), np.zeros((3, 3))
    for n in lengths:
        weights = {}
        for way in itertools.product(range(3), repeat=int(n)):
            weights[way] = np.exp(start[way[0]] + sum(scores[at + i, k] for i, k in enumerate(way)) + sum(moves[a, b] for a, b in zip(way, way[1:], strict=False)))
        z = sum(weights.values())
        total += np.log(z)
        for way, w in weights.items():
            for i, k in enumerate(way):
                want[at + i, k] += w / z
            for a, b in zip(way, way[1:], strict=False):
                want_pairs[a, b] += w / z
        at += n
    assert np.allclose(post, want) and np.allclose(pairs, want_pairs) and np.isclose(log_z, total)


def test_code_switching():
    model = crf.fit(ROWS)
    assert model.moves[0, 0] > model.moves[0, 1] and model.moves[1, 1] > model.moves[1, 0]
    post, words = crf.label_words(model, ["the river and the stone der fluss und die steine", None, "123"], crf.Memory(model))
    labels = [model.labels[k] for k in post[0].argmax(axis=1)]
    assert labels == ["en"] * 5 + ["de"] * 5 and words[1] == words[2] == [] and len(post[2]) == 0


def test_rows(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate(ROWS)] + [(900, None, "en", "x"), (901, "", None, "x"), (902, "42 !", "de", "x"), (904, "½ ② ³ Ⅷ ①", None, "x"), (903, "und die steine " * 5000, None, "x"), (None, "the stone", None, "x"), (903, "the", None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    found = crf.languages(df).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    by = {(r["doc_id"], r["n_words"]): r for r in found}
    assert [by[k, 0]["lang_pred"] for k in (900, 901, 902, 904)] == ["und"] * 4 and by[903, 15_000]["lang_pred"] == "de" and by[None, 2]["lang_pred"] == "en"
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert sorted(map(str, found)) == sorted(map(str, crf.languages(df.repartition(3)).collect()))
    assert {r["lang_pred"] for r in crf.languages(df.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}
    assert crf.languages(df.limit(0)).count() == 0


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = crf.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in both) >= 0.97 * len(both)


def test_letters_and_marks():
    assert crf.words_of("½ ② ³ Ⅷ ① 42 _") == [] and crf.words_of("a½b") == ["a", "b"]
    assert crf.words_of("cafe\u0301s na\u0308ive \u0301x हिन्दी") == ["cafe\u0301s", "na\u0308ive", "x", "हिन्दी"]
    assert crf.words_of("été_ñandú1Ǆx") == ["été", "ñandú", "Ǆx"]
    import unicodedata

    assert all((crf.LATIN_WORDS.match(chr(c)) is not None) == unicodedata.category(chr(c)).startswith("L") for c in range(0x250))
    word = "ab" * 500 + "q" + "cd" * 500
    assert {"bqc", "abq"[1:], "w:" + word} <= set(crf.word_features(word))


def test_sample_is_bounded(spark):
    """However many rows share an id or a text; each language has its texts, however many languages there are."""
    rows = [(None if i % 2 else 7, f"text {i % 900}", "en") for i in range(3000)] + [(i, "the same", "de") for i in range(2000)] + [(i, f"word {i}", f"l{i % 60}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = crf.sample(df, F.lit(True), 40)
    by = {k: sum(lang == k for _, lang in found) for _, k in found}
    assert len(by) == 62 and len(set(found)) == len(found) and by.pop("de") == 1 and set(by.values()) == {crf.LEAST}
    assert found == crf.sample(df.repartition(3), F.lit(True), 40)
    assert len(crf.sample(df, F.lit(True), 620)) == 1 + 61 * 10


def test_long_texts_are_drawn_from():
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(15_000)]
    found = crf.words_of(crf.drawn(" ".join(words)))
    assert len(found) == crf.WORDS_EACH // crf.PIECE * crf.PIECE and found[: crf.PIECE] == words[: crf.PIECE] and found[-crf.PIECE :] == words[-crf.PIECE :]
    assert crf.drawn(" ".join(words[:6000])) == " ".join(words[:6000])


def test_many_languages(spark):
    """Languages with few and short texts are learned too, all of them."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda k, i: letters[k % 26] + letters[k // 26] + letters[(7 * k + i) % 26] + "aeiou"[i % 5] + letters[k // 26]
    for n, texts, size in ((130, 16, 12), (150, 3, 4)):
        rows = [(k * 100 + j, " ".join(word(k, i * j + i) for i in range(1, size + 1)), f"l{k:03}") for k in range(n) for j in range(texts)]
        found = {r["doc_id"]: (r["lang_pred"], r["held_out"]) for r in crf.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
        known = {lang for i, _, lang in rows if not found[i][1]}
        right = [found[i][0] == lang for i, _, lang in rows if lang in known and found[i][1]]
        assert {lang for i, (lang, _) in found.items()} >= known and sum(right) >= 0.9 * len(right)


def test_languages_by_brute_force(spark):
    """The query's own way again, by plain Python: the sample, features by name, and forward-backward word by word."""
    rows = [(i, t, lang) for i, (t, lang) in enumerate(ROWS)] + [(200 + i, f"{a} {b}", None) for i, (a, b) in enumerate(itertools.product([ROWS[0][0], "und die", "42", "x" * 90], [ROWS[1][0], "the", ""]))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in crf.languages(df).collect()}
    learned = [(t, lang) for i, t, lang in rows if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2]

    def order(t):
        u = xxhash.xxh64_intdigest(t.encode(), seed=42)
        first = xxhash.xxh64_intdigest((11).to_bytes(4, "little"), seed=42)
        signed = lambda x: x - 2**64 if x >= 2**63 else x
        return signed(xxhash.xxh64_intdigest(u.to_bytes(8, "little"), seed=first)), signed(u)

    model = crf.fit([(t, lang) for lang in sorted({x for _, x in learned}) for t in sorted({t for t, x in learned if x == lang}, key=order)[:200]])
    for i, text, _ in rows:
        words = ["".join(g) for alpha, g in itertools.groupby(text, str.isalpha) if alpha]
        scores = []
        for w in words:
            names = [*crf.word_features(w), *(f"lex:{k}" for k in range(len(model.labels)) if model.lexicon.get(w.lower(), 0) >> k & 1)]
            scores.append(sum(model.weights[xxhash.xxh32_intdigest(n) % crf.BUCKETS] for n in names) / len(names) ** 0.5)
        forward, backward = [], [np.zeros(len(model.labels))]
        for s in scores:
            before = model.start if not forward else np.logaddexp.reduce(forward[-1][:, None] + model.moves, axis=0)
            forward.append(before + s)
        for s in scores[:0:-1]:
            backward.append(np.logaddexp.reduce(model.moves + (s + backward[-1])[None, :], axis=1))
        if not words:
            assert found[i]["lang_pred"] == "und" and found[i]["score"] == 0
            continue
        posts = np.array([f + b - np.logaddexp.reduce(f + b) for f, b in zip(forward, backward[::-1], strict=True)])
        mean = np.exp(posts).mean(axis=0)
        assert found[i]["lang_pred"] == model.labels[int(mean.argmax())] and abs(found[i]["score"] - mean.max()) < 1e-9 and found[i]["n_words"] == len(words)
