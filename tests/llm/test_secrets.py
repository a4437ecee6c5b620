import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from linkloom.llm import secrets

PARTS = ["token=", 'Password: "', "secret", "api_key:", "APIKEY = ", "passwd", "abcdef", "ab12", "=", ":", " ", "\n", "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef01234567", "ff", "é😀", "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890", "eyJabcdefgh.abcdefgh1.abcdefgh2", "eyJ", "eyJabcdefgh", ".", "-----END RSA PRIVATE KEY-----", "sk_live_" + "a1" * 9, "AIza" + "x" * 35]


def spans(text):
    out = []
    for no, r in enumerate(secrets.RULES):
        out += [(m.start(), no, m.end()) for m in re.finditer(r.pattern, text) if len(m[r.group] or "") >= r.least]
    return sorted(out)


def joined(own):
    return ",".join(f"{secrets.RULES[no].kind}:{a}:{b}" for a, no, b in own)


def test_by_brute_force(spark):
    dice = random.Random(3)
    texts = ["".join(dice.choice(PARTS) for _ in range(dice.randrange(14))) for _ in range(300)]
    texts += [None, "", "token=token:abcdefgh", "AKIA" * 4 + "AKIA", "x" * 40_000 + "token=abcdefgh", "token=abcdefgh " * 300, "eyJabcdefgh.eyJabcdefgh.zz eyJabcdefgh.eyJabcdefgh.eyJabcdefgh.z"]
    rows = [(i, t, 7) for i, t in enumerate(texts)] + [(0, texts[0], 7), (None, "token=abcdefgh", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int")
    found = secrets.digests(df).collect()
    assert len(found) == len(rows)
    for r in found:
        text = "token=abcdefgh" if r["doc_id"] is None else texts[r["doc_id"]] or ""
        want = spans(text)
        base = [s for s in want if s[1] < secrets.BASE]
        assert r["spans"] == joined(want), text
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in base) for k in range(3))
    assert secrets.digests(df.limit(0)).count() == 0
    clean = secrets.scan(df).withColumn("t", secrets.redacted(F.col("text"), F.col("spans"))).collect()
    for r in clean:
        want, at = "", 0
        for a, b in ((s["start"], s["end"]) for s in r["spans"]):
            if a >= at:
                want += r["text"][at:a] + "[SECRET]"
            at = max(at, b)
        assert r["t"] == want + r["text"][at:]


def test_queries_hold_for_every_match():
    assert secrets.trigram_query(r"[0-9a-f]{24,}") is None and secrets.trigram_query("a.c|xyz") is None
    assert secrets.trigram_query("abc+d") == frozenset([frozenset(["abc"])]) or secrets.trigram_query("abc+d") is None
    assert secrets.trigram_query("(?:foo|bar)1?baz[0-9]") == frozenset([frozenset(["foo", "oo1", "o1b", "1ba", "baz"]), frozenset(["foo", "oob", "oba", "baz"]), frozenset(["bar", "ar1", "r1b", "1ba", "baz"]), frozenset(["bar", "arb", "rba", "baz"])])
    dice = random.Random(5)
    for _ in range(2000):
        text = "".join(dice.choice(PARTS) for _ in range(8))
        for r in secrets.RULES:
            query = secrets.trigram_query(r.pattern)
            if query and re.search(r.pattern, text):
                for held in (query, secrets.rarest(query)):
                    assert any(all(t in text.lower() for t in s) for s in held)


def test_keys_with_their_bodies(spark):
    body = "MIIEpAIBAAKCAQEA7\nq3Zk+/x0=\n"
    texts = [f"a -----BEGIN RSA PRIVATE KEY-----\n{body}-----END RSA PRIVATE KEY----- b", f"-----BEGIN PRIVATE KEY-----\n{body}", "-----BEGIN PRIVATE KEY----- is a header"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["t"] for r in secrets.scan(df).withColumn("t", secrets.redacted(F.col("text"), F.col("spans"))).collect()}
    assert found == {0: "a [SECRET] b", 1: "[SECRET]", 2: "[SECRET] is a header"}


def test_long_hostile_texts_in_linear_time(spark):
    spark.range(1).count()
    for text, n in (("eyJ" * 350_000, 0), ("eyJabcdefgh." * 80_000, 26_666), ("token=abcdef " * 100_000, 100_000), ("-----BEGIN PRIVATE KEY-----\n" * 40_000, 40_000), ("AKIA" * 250_000, 1), ("f" * 1_000_000, 1), ("secret" * 170_000, 0)):
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        begin = time.time()
        row = secrets.scan(df).withColumn("t", secrets.redacted(F.col("text"), F.col("spans"))).select(F.size("spans").alias("n"), F.sha2("t", 256).alias("t"), F.sha2(secrets.named(F.col("spans")), 256).alias("s")).first()
        assert time.time() - begin < 60, (text[:20], time.time() - begin)
        want = spans(text)
        clean, at = [], 0
        for a, _, b in want:
            if a >= at:
                clean += [text[at:a], "[SECRET]"]
            at = max(at, b)
        assert row["n"] == len(want) == n and row["s"] == hashlib.sha256(joined(want).encode()).hexdigest() and row["t"] == hashlib.sha256("".join([*clean, text[at:]]).encode()).hexdigest()


def test_kept_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "token=abcdefgh", 5, "x", 6)], "doc_id long, text string, key int, rules string, spans int")
    row = secrets.scan(df, keep=("key", "rules", "spans")).first()
    assert (row["key"], row["rules"]) == (5, "x") and [tuple(s) for s in row["spans"]] == [(0, 0, 14)]


def test_whole_keys(spark):
    """Keys with headers, of PGP, and in escaped texts leave nothing of their bodies."""
    body = "MIIEpAIBAAKCAQEA\nq83vEjRWeJCrze8=\n"
    head = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0123ABCD\n\n"
    texts = [
        f"a -----BEGIN RSA PRIVATE KEY-----\n{head}{body}-----END RSA PRIVATE KEY----- b",
        f"a -----BEGIN PGP PRIVATE KEY BLOCK-----\r\nVersion: GnuPG v2.1 (x)\r\nComment: mine, all: mine\r\n\r\n{body}=ab1Z\n-----END PGP PRIVATE KEY BLOCK----- b",
        "a " + f"-----BEGIN RSA PRIVATE KEY-----\n{head}{body}-----END RSA PRIVATE KEY-----".replace("\n", "\\n") + " b",
        "-----BEGIN PGP PUBLIC KEY BLOCK-----\nVersion: x\n",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["clean"] for r in secrets.scan(df).select("doc_id", secrets.redacted(F.col("text"), F.col("spans")).alias("clean")).collect()}
    assert found == {0: "a [SECRET] b", 1: "a [SECRET] b", 2: "a [SECRET] b", 3: texts[3]}
