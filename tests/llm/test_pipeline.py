import re

import corpus_pipeline
from linkloom.llm import kneser, secrets
from tests.llm.test_mixing import targets
from tests.llm.test_neardup import shingle_set

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9000, None, "en", "src0", 0), (9001, "", "en", "src0", 0), (9002, None, None, None, None)], docs.schema)
    docs = docs.unionByName(odd).selectExpr("*", "'kept' as perplexity", "doc_id as taken", "text as decoded", "1 as spans")
    columns = docs.columns
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), f"test-{name}")
        at[name] = docs.collect()
        assert name == "tokens" or docs.columns == columns, name
    judged = {r["doc_id"]: r["rejected"] for r in kneser.classify(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert {r["doc_id"] for r in at["quality"]} == {k for k, bad in judged.items() if not bad}
    sets = [shingle_set(r["text"]) for r in at["near_dups"]]
    assert not any(100 * len(a & b) >= 80 * len(a | b) for i, a in enumerate(sets) for b in sets[:i] if a and b)
    lost = [r for r in at["quality"] if r["doc_id"] not in {x["doc_id"] for x in at["near_dups"]}]
    whole = [shingle_set(r["text"]) for r in at["quality"]]
    assert all(any(x is not s and 100 * len(s & x) >= 80 * len(s | x) for x in whole) for s in (shingle_set(r["text"]) for r in lost))
    before = {r["doc_id"]: r["text"] for r in at["near_dups"]}
    for r in at["secrets"]:
        assert not any(re.search(p.pattern, r["text"]) and any(len(m[p.group] or "") >= p.least for m in re.finditer(p.pattern, r["text"])) for p in secrets.RULES)
        assert ("[SECRET]" in r["text"]) == (r["text"] != before[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    assert len(at["secrets"]) == len(at["near_dups"])
    size, taken = {}, {}
    for rows, into in ((at["secrets"], size), (at["mixing"], taken)):
        for r in rows:
            into[r["source"]] = into.get(r["source"], 0) + len(r["text"].split())
    longest = max(len(r["text"].split()) for r in at["secrets"])
    assert all(abs(taken.get(s, 0) - t) <= longest for s, t in targets(size).items())
    assert len(at["tokens"]) == len(at["mixing"]) and all(r["round_trip"] for r in at["tokens"])


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
