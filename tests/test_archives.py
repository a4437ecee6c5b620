"""Archives as a source, a stream and a sink."""

import gzip
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkloom.plans.discover import discover
from linkloom.sources import pages, warc

BODIES = ["<a href='/ä'>", "x" * 5000, "", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc", "\x1f\x8b\x08\x00"]


def rows(first, n):
    return [(0, first + i, f"http://h.com/{first + i} x", "text/html; charset=latin-1", None, " m.map ", BODIES[i % len(BODIES)].encode("latin-1")) for i in range(n)]


SCHEMA = pages.RESPONSES.simpleString()[7:-1].replace("body:string", "body:binary")


def came(df):
    return sorted((r["page_id"], r["url"], r["content_type"], r["x_source_map"], bytes(r["body"])) for r in df.collect())


def wanted(given):
    return sorted((p, u.replace(" ", "%20"), t, x.strip(), b) for _, p, u, t, _, x, b in given)


def test_round_trip_in_ranges(spark, tmp_path):
    folder, given = str(tmp_path / "a"), rows(0, 120)
    warc.write_archives(warc.as_archived(spark.createDataFrame(given, SCHEMA).repartition(3)), folder, archiveBytes="2000")
    for size in ("100", "1500", "100000"):
        df = warc.read_archives(spark, folder, rangeBytes=size)
        assert came(warc.archived_responses(df)) == wanted(given)
    archives = df.select("archive").distinct().count()
    assert archives > 6 and df.where("status = 200").count() == 120
    parts = warc.read_archives(spark, folder, rangeBytes="100").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > archives


def test_a_lost_write_is_never_read(spark, tmp_path):
    folder = str(tmp_path / "a")
    with pytest.raises(Exception, match=r"(?s).*"):
        bad = spark.createDataFrame(rows(0, 50), SCHEMA).repartition(2).withColumn("page_id", F.when(F.col("page_id") == 49, F.raise_error(F.lit("lost"))).otherwise(F.col("page_id")))
        warc.write_archives(warc.as_archived(bad), folder)
    good = rows(100, 5)
    warc.write_archives(warc.as_archived(spark.createDataFrame(good, SCHEMA)), folder)
    assert came(warc.archived_responses(warc.read_archives(spark, folder))) == wanted(good)
    other = rows(200, 3)
    warc.write_archives(warc.as_archived(spark.createDataFrame(other, SCHEMA)), folder, mode="overwrite")
    assert came(warc.archived_responses(warc.read_archives(spark, folder))) == wanted(other)


def test_stream(spark, tmp_path):
    """Each run takes what has come since the last."""
    folder, out = str(tmp_path / "a"), str(tmp_path / "out")
    given = []
    for k in range(3):
        given += (new := rows(100 * k, 20))
        warc.write_archives(warc.as_archived(spark.createDataFrame(new, SCHEMA)), folder)
        found = warc.archived_responses(warc.stream_archives(spark, folder, rangeBytes="300"))
        query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "progress")).start(out)
        query.processAllAvailable()
        query.stop()
        assert came(spark.read.parquet(out)) == wanted(given)


def test_to_links(spark, tmp_path):
    folder = str(tmp_path / "a")
    body = "<a href='/größe'>"
    given = [(0, i, f"http://h{i}.com/", f"text/html; charset={c}", None, None, body.encode(c)) for i, c in enumerate(("utf-8", "iso-8859-1", "utf-16", "cp1252"))]
    warc.write_archives(warc.as_archived(spark.createDataFrame(given, SCHEMA)), folder)
    read = pages.decode_bytes(warc.archived_responses(warc.read_archives(spark, folder)), "body", "charset")
    assert sorted(r["resolved"] for r in discover(read.select(*pages.RESPONSES.names)).collect()) == [f"http://h{i}.com/größe" for i in range(4)]


def foreign(tmp_path, name, data):
    (tmp_path / "f").mkdir(exist_ok=True)
    (tmp_path / "f" / name).write_bytes(data)
    return str(tmp_path / "f")


def http(body, *headers):
    return warc.response_block(200, [("Content-Type", "text/html; Charset='UTF-8'"), *headers], body)


def test_archives_of_others(spark, tmp_path):
    """Plain and compressed, without an index, with codings of HTTP, other records and repeated fields."""
    kinds = [("info", b"software: x\r\n", "warcinfo"), ("a", http(b"plain", ("X", "1"), ("x", "2")), "response"), ("b", http(gzip.compress(b"zipped"), ("Content-Encoding", "gzip")), "response"), ("c", http(b"3\r\nabc\r\n2;x\r\nde\r\n0\r\n\r\n", ("Transfer-Encoding", "chunked")), "response")]
    kinds += [("d", http(b"not zipped", ("Content-Encoding", "gzip")), "response"), ("e", http(zlib.compress(b"flat"), ("Content-Encoding", "deflate")), "response"), ("f", b"GET / HTTP/1.1\r\n\r\n", "request")]
    records = [warc.record(kind, block, [("WARC-Record-ID", name), ("WARC-Target-URI", f"http://h/{name}")]) for name, block, kind in kinds]
    want = {"a": b"plain", "b": b"zipped", "c": b"abcde", "d": b"not zipped", "e": b"flat"}
    foreign(tmp_path, "1.warc", b"".join(records))
    foreign(tmp_path, "2.warc.gz", b"".join(map(gzip.compress, records)))
    folder = foreign(tmp_path, "3.warc.gz", gzip.compress(b"".join(records)))
    found = warc.read_archives(spark, folder).where("record_type = 'response'").collect()
    for archive in ("1.warc", "2.warc.gz", "3.warc.gz"):
        assert {r["record_id"]: bytes(r["body"]) for r in found if r["archive"] == archive} == want
    assert {r["charset"] for r in found} == {"utf-8"} and found[0]["headers"]["x"] == "1"
    alone = warc.read_archives(spark, f"{folder}/1.warc")
    assert alone.count() == len(records)


def test_a_broken_archive(spark, tmp_path):
    good = warc.record("response", http(b"x"), [])
    folder = foreign(tmp_path, "1.warc", good + b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort")
    with pytest.raises(Exception, match="cut short"):
        warc.read_archives(spark, folder).collect()
    found = warc.read_archives(spark, folder, mode="DROPMALFORMED").collect()
    assert [(r["offset"], r["error"]) for r in found] == [(0, None), (len(good), "a record is cut short")]


@settings(max_examples=50)
@given(st.lists(st.tuples(st.binary(max_size=60), st.booleans()), max_size=6))
def test_any_block(blocks):
    import io

    data, ends = b"", []
    for block, zipped in blocks:
        one = warc.record("resource", block, [("X", "y")])
        data += gzip.compress(one) if zipped else one
        ends.append(len(data))
    found = list(warc.records(io.BytesIO(data), 0, len(data)))
    assert [b for *_, b in found] == [b for b, _ in blocks] and [o + n for o, n, *_ in found] == ends
