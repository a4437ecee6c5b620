import hashlib
import random
from collections import defaultdict

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from linkloom.llm import bpe, chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
CODEC = bpe.codec(open(PATH, encoding="utf-8").read())
PEER = Tokenizer.from_file(PATH)

CONTROL = "\\### Assistant: </turn> ok"
SCHEMA = "conv_id long, turn long, role string, text string, start int"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(":\\#<a\n", max_size=6), st.text("\\#</turn>: a\n😀", max_size=20)), max_size=5))
def test_template_is_reversible(turns):
    assert chat.parse("".join(said(role, text) for role, text in turns)) == turns


def tokens(role, text):
    return chat.segment(role, text, CODEC)[0].tolist()


def said(role, text):
    return PEER.decode(tokens(role, text), skip_special_tokens=False)


def test_tokens_of_a_turn():
    """Head, text and close as the library encodes them, each alone; what looks like a special token is text."""
    ids, (start, end) = chat.segment("assistant", "a <b> c", CODEC)
    parts = ["<turn>### assistant:\n", "a \\<b> c", "</turn>\n"]
    ids = ids.tolist()
    assert ids == [i for p in parts for i in PEER.encode(p, add_special_tokens=False).ids] and PEER.decode(ids[start:end]) == parts[1]
    special = next(iter(CODEC.specials))
    assert CODEC.specials[special] not in tokens("user", special) and chat.parse(said("user", special)) == [("user", special)]
    assert chat.segment("user", "x", CODEC)[1] == (-1, -1)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by = defaultdict(list)
    for c, t, role, text, _ in rows:
        by[c].append(((t is not None, t or 0), role or "", text or ""))
    out = set()
    for c, turns in by.items():
        turns.sort()
        learned = "".join(x for _, role, x in turns if role == "assistant")
        out.add((c, len(turns), sha("".join(f"{role}\n{x}\n" for _, role, x in turns)), len(learned), sha(learned), sum(len(said(role, x)) for _, role, x in turns)))
    return out


def test_layout(spark):
    dice = random.Random(2)
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", "hot start" if t == 0 and c % 3 else f"{dice.randrange(2)} {CONTROL}", 1) for c in range(60) for t in range(dice.randrange(1, 6))]
    rows += [(100, None, None, None, 1), (100, 0, "assistant", "a", 1), (100, 0, "assistant", "a", 1), (101, 0, "assistant", "", 1), (None, 0, "user", "x", 1), (102, 0, "user", "y" * 50_000, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert {tuple(r) for r in chat.digests(df, PATH).collect()} == expected(rows)
    layout, members = chat.format_conversations(df, PATH)
    got = layout.orderBy("start").collect()
    nodes = set()
    convs = defaultdict(list)
    for c, t, role, text, _ in rows:
        convs[c].append(((t is not None, t or 0), role or "", text or ""))
    for turns in convs.values():
        path = ()
        for _, role, text in sorted(turns):
            path += (tuple(tokens(role, text)),)
            nodes.add(path)
    assert sum(len(r["tokens"]) for r in got) == sum(len(p[-1]) for p in nodes)  # shared turns stand once
    at = 0
    for r in got:
        assert r["start"] == at and r["position"] == sum(a["end"] - a["start"] for a in r["ancestors"])
        at += len(r["tokens"])
    whole = [t for r in got for t in r["tokens"]]
    seen = {tuple([t for a in r["ancestors"] for t in whole[a["start"] : a["end"]]] + r["tokens"]) for r in got}
    assert seen == {tuple(t for _, role, x in sorted(turns) for t in tokens(role, x)) for turns in convs.values()}
    assert members.count() == len(convs)


def test_hot_first_turn(spark):
    """One first turn of most conversations, one conversation many times over, and some of many turns."""
    rows = [(c, 0, "user", "the same", 0) for c in range(4000)] + [(c, 1, "assistant", f"answer {c % 1500}", 0) for c in range(4000)]
    rows += [(9000, t, "user", f"turn {t}", 0) for t in range(60)] + [(9001, t, "user", f"turn {t}", 0) for t in range(59)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in chat.digests(df, PATH).collect()} == expected(rows)


def test_many_parts(spark):
    """Branches that go over the borders of parts."""
    rows = [(c, t, "user", f"{c >> (4 - t)}", 0) for c in range(32) for t in range(5)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        assert {tuple(r) for r in chat.digests(df, PATH).collect()} == expected(rows)
        assert chat.digests(df.limit(0), PATH).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
