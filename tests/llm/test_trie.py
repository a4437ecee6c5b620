import hashlib
import random
import zlib
from collections import defaultdict

from linkloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Every node by a plain walk over all prefixes."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [t for *_, t in sorted(ts)] for c, ts in convs.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(c / 100) * 100
        whole[c] = own.get(c - base, [])[:h] + own[c][h:]
    nodes = defaultdict(lambda: {"members": set(), "ends": []})
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])]["members"].add(c)
        nodes[tuple(ts)]["ends"].append(c)
    children = defaultdict(int)
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, n in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(n["members"]) - 1) * (len(p[-1][1]) if p else 0)
    return sorted(
        (min(n["members"]), len(p), min(nodes[p[:-1]]["members"]) if p else None, len(n["members"]), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(n["ends"]))).encode()).hexdigest()) for p, n in nodes.items()
    )


def key(r):
    return tuple(x if x is not None else -(10**9) for x in r)


def came(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_by_brute_force(spark):
    dice = random.Random(3)
    texts = ["a", "b", "ä\nß", "", None, "long " * 50]
    rows = [(c, t, dice.choice(["user", "assistant", None]), dice.choice(texts[:3] if t < 3 else texts)) for c in [*range(0, 40), *range(100, 130), *range(205, 212), -3, -100, -105] for t in range(dice.randrange(1, 9))]
    rows += [(7, None, "user", "first"), (None, 0, "user", "x"), (300, 5, "user", "twice"), (300, 5, "user", "twice"), (301, 1, "user", "only")]
    rows += [(400, t, "user", f"t{t % 3}") for t in range(20)] + [(c, t, "user", f"t{t % 3}") for c in (401, 402, 403) for t in range(12)]  # deep, and alike
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{SCHEMA}, depth int, key string").repartition(5)
    assert came(trie.trie(df)) == sorted(brute(rows), key=key)


def test_few_rows(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)).count() == 0
    rows = [(102, 0, "user", None)]  # takes its turns from a conversation that isn't there, so it has none if it takes any
    assert came(trie.trie(spark.createDataFrame(rows, SCHEMA))) == sorted(brute(rows), key=key)


def test_long_conversation_is_dealt_out(spark):
    """A conversation that lies in several parts has the same running sums; a common end is hashed in pieces."""
    rows = [(1, t, "user", f"{t}") for t in range(140)] + [(c, 0, "user", "same") for c in range(2000, 5000, 100)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert came(trie.trie(df)) == sorted(brute(rows), key=key)


def test_ids_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "TEXT", 20)
    last = spark.createDataFrame([(bytes([i % 3]), i) for i in range(-50, 400)], "key binary, conv_id long")
    found = {bytes(r["key"]): r["ends_sha256"] for r in trie.ends(last).collect()}
    assert found == {bytes([k]): hashlib.sha256(",".join(str(i) for i in range(-50, 400) if i % 3 == k).encode()).hexdigest() for k in range(3)}
