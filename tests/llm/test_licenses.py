from linkloom.llm import licenses


def scan(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, p string")
    return {r["doc_id"]: r for r in licenses.summary(df).collect()}


def test_families(spark):
    asked = [(f, t) for f, texts in licenses.TEXTS.items() for t in texts] + [(f, c.format(n)) for f, names in licenses.NAMES.items() for n in names for c in ("Licensed under the {}.", "SPDX-License-Identifier: {}")]
    found = scan(spark, [f"Some words here.\n{t}\nMore of them." for _, t in asked])
    assert [(found[i]["licences"], t) for i, (_, t) in enumerate(asked)] == [(f"1:{f}", t) for f, t in asked]
    assert all(found[i]["n_paragraphs"] == 3 for i in range(len(asked)))


def test_held_out():
    """Of templates that weren't learned from: hardly ever a wrong family, and most of them found."""
    report = licenses.held_out_report()
    families = {k: v for k, v in report.items() if k != licenses.UNKNOWN}
    asked, right, wrong = (sum(v[i] for v in families.values()) for i in range(3))
    assert report[licenses.UNKNOWN][0] == report[licenses.UNKNOWN][1] == 3 * len(licenses.HELD_OTHERS)
    assert wrong <= 0.01 * asked and right >= 0.7 * asked


def test_unseen_carriers(spark):
    """Known names in sentences that weren't learned from, and sentences that only sound like a licence."""
    asked = [(f, c.format(n)) for f, names in licenses.NAMES.items() for n in names for c in licenses.HELD_CARRIERS]
    found = scan(spark, [t for _, t in asked] + list(licenses.HELD_OTHERS))
    right = sum(found[i]["licences"] == f"0:{f}" for i, (f, _) in enumerate(asked))
    assert right >= 0.97 * len(asked)
    assert all(found[i]["n_licences"] in (0, 1) and found[i]["licences"] in ("", f"0:{f}") for i, (f, _) in enumerate(asked) if f != "lgpl")
    assert all(found[len(asked) + i]["n_licences"] == 0 for i in range(len(licenses.HELD_OTHERS)))


def test_altered_and_others(spark):
    others = ["The driver renewed a license.", "Copyright is a hard subject to teach in schools", "license " * 5000, "No such word."]
    altered = ["a text. licensed under the apache license version 2.0 and more words follow here", "RELEASED UNDER THE MIT LICENSE!!"]
    found = scan(spark, [*others, *altered, None, ""])
    assert [found[i]["n_licences"] for i in range(8)] == [0, 0, 0, 0, 1, 1, 0, 0]
    assert [found[4]["licences"], found[5]["licences"]] == ["0:apache-2.0", "0:mit"]
    assert [found[i]["n_candidates"] for i in (3, 6, 7)] == [0, 0, 0] and found[6]["n_paragraphs"] == 1


def test_notices_without_the_usual_words(spark):
    asked = {"All rights reserved.": "proprietary", "GPLv3": "gpl-3.0", "CC BY 4.0": "cc-by", "Released under MIT": "mit", "under CC BY-SA 4.0": "cc-by-sa", "MIT License": "mit", "(c) 2020 Some One. All rights reserved.": "proprietary"}
    found = scan(spark, [*asked, "Hat mit allen gesprochen", "All tables are reserved by the company."])
    assert [found[i]["licences"] for i in range(len(asked) + 2)] == [*(f"0:{f}" for f in asked.values()), "", ""]


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights"""


def test_wrapped_notices(spark):
    import textwrap

    asked = [(f, textwrap.fill(t, width)) for f, texts in licenses.TEXTS.items() for t in texts for width in (40, 60, 76) if len(t) > 2 * width]
    assert len(asked) > 40
    found = scan(spark, [f"Some words here.\n\n{t}\n\nMore of them." for _, t in asked])
    assert [(asked[i], found[i]["licences"].split(":")[-1], found[i]["n_licences"]) for i in range(len(asked))] == [(a, a[0], 1) for a in asked]
    texts = [f"A file.\n{MIT}\nint main", "# Licensed under the\n# MIT license.\nimport x\n\nAll rights\nreserved.", "Licensed under\n\nthe terms of", "license\n" * 3000]
    found = scan(spark, texts)
    assert found[0]["n_licences"] == 1 and found[0]["licences"] in ("1:mit", "2:mit")
    assert [found[i]["licences"] for i in (1, 2, 3)] == ["1:mit,4:proprietary", "", ""] and found[1]["n_paragraphs"] == 6


def plainly(text):
    """The scan of one text, by plain Python: every line and every group of lines that `licenses` looks at."""
    lines = (text or "").split("\n")
    words = [licenses.words_of(x) for x in lines]
    hit = [bool(set(w) & set(licenses.anchors())) for w in words]
    asked = [(i, i, words[i]) for i in range(len(lines)) if hit[i]]
    for i in range(len(lines)):
        for m in licenses.TOGETHER:
            own = words[i : i + m]
            if len(own) == m and any(hit[i : i + m]) and all(own) and sum(map(len, own[1:-1])) <= licenses.BETWEEN:
                asked.append((i, i + m - 1, [*own[0][-licenses.EDGE :], *(w for x in own[1:-1] for w in x), *own[-1][: licenses.EDGE]]))
    said = [(a, b, *licenses.judge(w, licenses.model())) for a, b, w in asked]
    taken, out = {}, []
    for a, b, family, p, _ in sorted((x for x in said if x[2] != licenses.UNKNOWN), key=lambda x: (-x[4], x[1] - x[0], x[0])):
        if not any(i in taken for i in range(a, b + 1)):
            if family not in [taken.get(i) for i in range(a - licenses.NEAR, b + licenses.NEAR + 1)]:
                out.append((a, family, p))
            taken |= dict.fromkeys(range(a, b + 1), family)
    unknown = sum(a == b and family == licenses.UNKNOWN and a not in taken for a, b, family, _, _ in said)
    return len(lines), len(out) + unknown, sorted(out)


def test_documents_by_brute_force(spark):
    """All documents of a table, against plain Python; where licence lines are, they are found."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r["doc_id"]: r for r in licenses.summary(docs).collect()}
    lines = 0
    for r in docs.select("doc_id", "text").collect():
        n, candidates, out = plainly(r["text"])
        own = found[r["doc_id"]]
        assert (own["n_paragraphs"], own["n_candidates"], own["licences"]) == (n, candidates, ",".join(f"{a}:{f}" for a, f, _ in out))
        assert not out or abs(own["p"] - min(p for *_, p in out)) < 1e-5
        lines += len(out)
    assert lines >= 40


def test_anchors_lose_nothing():
    """What a template holds besides the anchors is less than what must be found of it."""
    for text in (t for texts in licenses.templates().values() for t in texts):
        grams = set(licenses.n_grams(licenses.words_of(text)))
        assert sum(not set(g.split()) & set(licenses.anchors()) for g in grams) < licenses.needed(len(grams))


def test_hash_as_spark_has_it(spark):
    words = ["license", "é x", "", "cc by nc"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.selectExpr(f"pmod(xxhash64(w), {licenses.BUCKETS})").collect()] == [licenses.bucket(w) for w in words]


def test_empty_and_repeated(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License.")] * 3 + [(None, None)], "doc_id long, text string")
    assert licenses.summary(df.limit(0)).count() == 0 and licenses.summary(df).count() == 4
