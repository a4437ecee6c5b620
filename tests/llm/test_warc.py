import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.llm import warc
from linkloom.sources import warc as archives

SCHEMA = "page_id long, url string, html string"


def rows_of():
    dice = random.Random(2)
    long = ["<p>" + w * 300 for w in ("eins ", "zwei\r\n\r\nWARC/1.1\r\n", "drei\x1f\x8b", "ö")]
    rows = [(i, f"http://{dice.choice('abc')}.example.com/{dice.randrange(9)}#x{i}", dice.choice([*long, f"only {i} " * 200, "short", "", None])) for i in range(300)]
    rows += [(None, "http://a.example.com/", long[0]), (None, None, long[1]), (400, "no address", "n" * 999), (401, "HTTP://B.Example.com/ü /\r\nX: y", "n" * 999), (402, "", "m" * 1000), (403, "", "m" * 1000), (7, "http://a.example.com/again", long[0])]
    return rows + [rows[5], rows[5]]


def expected(rows):
    bodies = [(i, (h or "").encode()) for i, _, h in rows]
    last = {}
    for i, b in bodies:
        last[b] = max(last.get(b, -1), -1 if i is None else i)
    out = []
    for i, b in bodies:
        again = len(b) >= 1000 and last[b] >= 0 and i != last[b]
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last[b] if again else None))
    return out


def key(r):
    return tuple((x is not None, x or 0) if not isinstance(x, str) else (True, x) for x in r)


def test_round_trip(spark, tmp_path, monkeypatch):
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1) for r in rows], f"{SCHEMA}, body int").repartition(3)
    want = sorted(expected(rows), key=key)
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    found = warc.digests(df).collect()
    assert sorted((tuple(r[c] for c in columns) for r in found), key=key) == want
    monkeypatch.setattr(warc, "FEW", 0)  # too many repeated payloads to broadcast
    for name, value in (("STRETCH", 20), ("SAMPLED_EACH", 4), ("BLOCK", 7)):  # many stretches of small blocks
        monkeypatch.setattr(warc, name, value)
    index = warc.archive(df, str(tmp_path / "a")).orderBy("position").collect()
    assert sorted((tuple(r[c] for c in columns) for r in index), key=key) == want
    order = [(r["url_key"], r["captured_at"], r["page_id"] is not None, r["page_id"] or 0, r["payload_digest"], r["archive"], r["offset"]) for r in index]
    assert [r["position"] for r in index] == list(range(1, len(rows) + 1)) and order == sorted(order)
    seen = {}
    for r in index:
        seen[r["url_key"]] = seen.get(r["url_key"], 0) + 1
        assert r["nth"] == seen[r["url_key"]]
    # what the index points at is the record
    one = next(r for r in index if r["record_type"] == "response" and r["payload_bytes"] > 1000)
    with open(tmp_path / "a" / one["archive"], "rb") as file:
        file.seek(one["offset"])
        *_, block = next(archives.records(archives.files.LocalFileSystem().open_input_file(file.name), one["offset"], one["offset"] + one["length"]))
    assert hashlib.sha1(block.split(b"\r\n\r\n", 1)[1]).hexdigest() == one["payload_digest"]


def test_no_pages(spark):
    assert warc.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_one_address(spark, monkeypatch):
    """All captures are of one address, and each stretch goes on with its history."""
    for name, value in (("STRETCH", 20), ("SAMPLED_EACH", 4)):
        monkeypatch.setattr(warc, name, value)
    df = spark.range(200).select(F.col("id").alias("page_id"), F.lit("http://h.com/").alias("url"), F.lit("x").alias("html"))
    assert sorted((r["page_id"] + 1, r["position"], r["nth"]) for r in warc.digests(df).collect()) == [(i, i, i) for i in range(1, 201)]


@given(st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9))), max_size=9))
def test_loser_tree(runs):
    runs = [sorted(r) for r in runs]
    order = warc.merged(runs)
    assert [runs[r][i] for r, i in order] == sorted(x for r in runs for x in r)
    assert all(i == sum(1 for r2, j in order[:n] if r2 == r) for n, (r, i) in enumerate(order))
