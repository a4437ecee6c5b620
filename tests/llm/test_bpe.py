import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
CODEC = bpe.codec(open(PATH, encoding="utf-8").read())
PEER = Tokenizer.from_file(PATH)
PIECES = st.lists(st.one_of(st.text(max_size=12), st.sampled_from(["<|endoftext|>", " the", "'ll", "  ", "\x85", "\x1c\x1f", "Ⅷ½²", "ab" * 90, "\u0130", "中文", "😀"])), max_size=8)


@settings(max_examples=400, deadline=None)
@given(PIECES.map("".join))
def test_as_the_library_has_it(text):
    ids = CODEC.encode(text)
    assert ids.tolist() == PEER.encode(text, add_special_tokens=False).ids
    assert CODEC.decode(ids.astype(np.int64))[0].tobytes().decode() == text


def test_long_pieces_in_linear_time():
    for text in ("a" * 50_000, "ab" * 25_000, " " * 50_000):
        assert CODEC.encode(text).tolist() == PEER.encode(text, add_special_tokens=False).ids


def test_rows(spark):
    texts = ["one two", None, "", "one two", "x" * 30_000, "é <|endoftext|>\n"]
    df = spark.createDataFrame([(i, t, 5) for i, t in enumerate(texts)] + [(0, "one two", 5)], "doc_id long, text string, n_tokens int")
    found = {r["doc_id"]: r for r in bpe.digests(df, PATH).collect()}
    for i, t in enumerate(texts):
        ids = PEER.encode(t or "", add_special_tokens=False).ids
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.digests(df, PATH).count() == 7 and bpe.digests(df.limit(0), PATH).count() == 0
    assert bpe.encode(df, PATH).columns == ["doc_id", "text", "n_tokens", "ids"]
    clash = bpe.encode(df, PATH, ids="N_tokens")
    assert clash.columns == ["doc_id", "text", "N_tokens"] and clash.where("doc_id = 4").first()["N_tokens"] == PEER.encode(texts[4]).ids
    same = bpe.decode(bpe.encode(df, PATH, ids="text"), PATH, ids="text", text="text")
    assert same.columns == ["doc_id", "n_tokens", "text"] and {(r["doc_id"], r["text"]) for r in same.collect()} == {(i, t or "") for i, t in enumerate(texts)} | {(0, "one two")}


def test_broken_bytes(spark):
    df = spark.createDataFrame([([255 - 68],), (None,)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(df, PATH).collect()][1] == ""


def test_round_trip_in_one_pass(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = [(i, t, "x") for i, t in enumerate(["Hello  world", None, "", "<|endoftext|> é\n", "日本 " * 500] * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Decoded string")
    once = bpe.round_trip(df, PATH)
    assert once.columns == ["doc_id", "text", "ids", "decoded"]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, bpe.decode(bpe.encode(df, PATH), PATH).collect()))
    assert bpe.digests(df, PATH)._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    long = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) as t")
    sizes = long.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
    assert max(r["n"] for r in sizes.collect()) < 5_000_000
