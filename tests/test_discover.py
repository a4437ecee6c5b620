"""The whole way, in one go and as a stream."""

import random
import time

from pyspark.sql import functions as F

from linkloom import registry
from linkloom.operators import dedupe
from linkloom.operators.nodes import page_metrics
from linkloom.operators.quarantine import fine, held
from linkloom.options import Options
from linkloom.plans.discover import Metrics, discover
from linkloom.sources.pages import RESPONSES, decode_bytes, read_pages, stream_pages
from linkloom.storage import materialize
from linkloom.streaming import stream


def found(spark, rows, **more):
    return sorted((r["page_id"], r["resolved"], r["note"][:5]) for r in discover(spark.createDataFrame(rows, RESPONSES), **more).collect())


def page(i, body, session=0):
    return (session, i, f"http://h.com/p{i}", "text/html", None, None, body)


def test_new_addresses(spark):
    rows = [page(1, "<a href='/a'><a href='//o.com'><a href='/a#x'>"), page(2, "<a href='/a'><a href='/b'>"), page(3, "<a href='/a'>", 1)]
    assert found(spark, rows) == [(1, "http://h.com/a", "Disco"), (1, "http://o.com/", "[NEW "), (2, "http://h.com/b", "Disco"), (3, "http://h.com/a", "Disco")]
    assert [r[1] for r in found(spark, rows, options=Options(discover_subdomains=False))] == ["http://h.com/a", "http://h.com/b", "http://h.com/a"]
    known = spark.createDataFrame([(0, "http://h.com/a"), (0, "http://h.com/a")], "session_id long, uri string")
    assert [r[1] for r in found(spark, rows, site_nodes=known)] == ["http://o.com/", "http://h.com/b", "http://h.com/a"]


def _queue(pages, most):
    seen, out = set(), set()
    for p, links in sorted(pages.items()):
        new = list(dict.fromkeys(x for x in links if x not in seen))[:most]
        seen |= set(new)
        out |= {(p, x) for x in new}
    return out


def test_cap_is_a_queue(spark):
    dice = random.Random(4)
    for most in (1, 3):
        pages = {p: [f"u{dice.randrange(12)}" for _ in range(dice.randrange(9))] for p in range(12)}
        rows = [(0, p, x, (i,)) for p, links in pages.items() for i, x in enumerate(links)]
        df = spark.createDataFrame(rows, "session_id long, page_id long, resolved string, place struct<ord:int>")
        assert {(r["page_id"], r["resolved"]) for r in dedupe.capped(df, most).collect()} == _queue(pages, most)


def test_cap_of_all_pages(spark):
    sf_dir = "/root/testdata/sf0.001"
    links = materialize(registry._targets(spark, sf_dir).select("session_id", "page_id", "resolved", "place"), "links")
    sessions = {}
    for r in sorted(links.collect(), key=lambda r: (r["page_id"], r["place"], r["resolved"])):
        sessions.setdefault(r["session_id"], {}).setdefault(r["page_id"], []).append(r["resolved"])
    queue = lambda most: {(s, *row) for s, pages in sessions.items() for row in _queue(pages, most)}
    came = lambda df: {(r["session_id"], r["page_id"], r["resolved"]) for r in df.collect()}
    whole = came(registry.queries()["insert_cap_pages"](spark, sf_dir))
    assert whole == queue(Options().most_inserts) and max(p for _, p, _ in whole) >= 12
    assert came(dedupe.capped(links, 2)) == queue(2) != whole


def test_cap_of_a_page(spark):
    rows = [page(1, "".join(f"<a href='/x{i}'>" for i in range(230))), page(2, "".join(f"<a href='/x{i}'>" for i in range(230)))]
    counts = [sum(r[0] == p for r in found(spark, rows)) for p in (1, 2)]
    assert counts == [200, 30]


def test_stream_as_batch(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}.com/p", f"<a href='/a{i % 4}'><a href='http://h{(i + 1) % 3}.com/z'>") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    src, sink = str(tmp_path / "in"), str(tmp_path / "out")
    df.where("page_id < 6").coalesce(1).write.parquet(src)
    stream.start(stream_pages(spark, src), sink).awaitTermination()
    df.where("page_id >= 6").coalesce(1).write.mode("append").parquet(src)
    stream.start(stream_pages(spark, src), sink).awaitTermination()
    streamed = sorted(r["uri"] for r in stream.written(spark, sink).collect())
    assert streamed == sorted(r["uri"] for r in discover(read_pages(spark, src, Options())).collect())
    assert stream.seen(spark, sink).count() == len(streamed)
    assert not stream.on_event(spark, sink, 0, "node added") and stream.seen(spark, sink).count() == len(streamed)
    assert stream.on_event(spark, sink, 0, "site removed") and stream.seen(spark, sink).isEmpty()


def test_a_batch_that_comes_again(spark, tmp_path):
    """A batch that was written and comes again brings in the same, with its cap counted once."""
    sink, options = str(tmp_path / "out"), Options(most_inserts=3)
    links = lambda i, a, b: page(i, "".join(f"<a href='/x{n}'>" for n in range(a, b)))
    batches = [spark.createDataFrame([links(1, 0, 5)], RESPONSES), spark.createDataFrame([links(2, 0, 9), links(3, 4, 9)], RESPONSES)]
    state = lambda: sorted((r["page_id"], r["uri"]) for r in stream.written(spark, sink).collect())
    stream.append(batches[0], sink, options, batch_id=0)
    first = state()
    stream.append(batches[0], sink, options, batch_id=0)
    assert state() == first == [(1, f"http://h.com/x{n}") for n in range(3)]
    stream.append(batches[1], sink, options, batch_id=1)
    both = state()
    for _ in range(2):
        stream.append(batches[1], sink, options, batch_id=1)
        assert state() == both == first + [(2, f"http://h.com/x{n}") for n in (3, 4, 5)] + [(3, f"http://h.com/x{n}") for n in (6, 7, 8)]


def test_forgotten_by_one_session_only(spark, tmp_path):
    sink = str(tmp_path / "out")
    rows = [page(1, "<a href='/a'>", 0), page(2, "<a href='/a'>", 1)]
    df = spark.createDataFrame(rows, RESPONSES)
    stream.append(df, sink, Options(), batch_id=0)
    stream.append(df, sink, Options(), batch_id=1)
    assert stream.written(spark, sink).count() == 2
    assert stream.on_event(spark, sink, 1, "node removed")
    stream.append(df, sink, Options(), batch_id=2)
    assert sorted(r["page_id"] for r in stream.written(spark, sink).collect()) == [1, 2, 2]
    assert not stream.on_event(spark, sink, 0, "node selected")


def test_odd_rows_fail_alone(spark):
    """Addresses and bodies of any kind: what is odd brings in nothing or little, and the page beside it is as it would be alone."""
    odd = ["\x00\x01", "<a href=", "<a href='" + "(" * 5000, "%" * 3000, "\ud7ff\ue000 href='/\uffff'", "href='http://[::1]/x' href='http://[bad/' href='http://h:99999999999/'", "fetch('http://a b/')", "`${`" * 500]
    urls = ["http://[", "ht!tp://%%%", "", "nothing", "http://h.com:x/", "http://h.com/%zz", "//h.com", "http://"]
    rows = [(0, 1, "http://h.com/p", "text/html", None, None, "<a href='/good'>")] + [(0, 10 + 10 * i + j, u, "text/html", "\x00", ":", b) for i, u in enumerate(urls) for j, b in enumerate(odd)]
    out = discover(spark.createDataFrame(rows, RESPONSES)).collect()
    assert [r["resolved"] for r in out if r["page_id"] == 1] == ["http://h.com/good"]
    assert all(r["host"] and r["uri"].isascii() for r in out)
    df = spark.createDataFrame(rows, RESPONSES)
    bad, good = {r["page_id"]: (r["stage"], r["reason"]) for r in held(df).collect()}, {r["page_id"] for r in fine(df).collect()}
    assert good | set(bad) == {r[1] for r in rows} and not good & set(bad)
    assert {r[2] for r in rows if r[1] in bad} == {"http://[", "ht!tp://%%%", "", "nothing", "http://h.com:x/", "//h.com"} and set(bad.values()) == {("address", "not an address")}


def test_what_is_held_back(spark):
    rows = [(0, 1, "http://h/", "text/html", None, None, b"x", None), (0, 2, "http://h/", "text/html", None, None, b"x", "no-such"), (0, 3, "http://h/", "text/html", None, None, None, "no-such"), (0, 4, "http://o/", "text/html", None, None, b"x", "utf-16"), (0, 5, None, "text/html", None, None, b"x", ""), (0, 6, "http://h/", "text/plain", None, None, b"x", "rot13")]
    df = decode_bytes(spark.createDataFrame(rows, RESPONSES.simpleString()[7:-1].replace("body:string", "body:binary") + ",charset:string"), "body", "charset", "decode_error")
    scope = F.col("url") == "http://h/"
    assert {r["page_id"]: (r["stage"], r["reason"]) for r in held(df, scope).collect()} == {2: ("charset", "unknown charset no-such"), 3: ("gate", "no body"), 4: ("gate", "out of scope"), 5: ("gate", "no address"), 6: ("gate", "content type not searched")}
    assert [r["page_id"] for r in fine(df, scope).collect()] == [1] and fine(df).columns == df.columns
    broken = spark.createDataFrame([(0, 9, "http://h/", "text/html", None, None, "x", "cut short")], RESPONSES.simpleString()[7:-1] + ",error:string")
    assert [tuple(r)[3:] for r in held(broken).collect()] == [("archive", "cut short")]


def test_counts_on_the_way(spark, tmp_path):
    """What is counted on the way is what page_metrics counts, in a batch and over a stream."""
    own = registry.responses(spark, "/root/testdata/sf0.001")
    materialize(fine(own), "fine").createOrReplaceTempView("fine_pages")
    want = page_metrics(spark.table("fine_pages")).agg(F.count("page_id").alias("n_pages"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_candidates").alias("n_candidates")).first().asDict()
    counts = Metrics()
    discover(spark.table("fine_pages"), metrics=counts).write.format("noop").mode("overwrite").save()
    assert counts.get == want
    listener = stream.Counts()
    spark.streams.addListener(listener)
    src = str(tmp_path / "in")
    for k in range(2):
        own.where(F.col("page_id") % 2 == k).write.mode("append").parquet(src)
        stream.start(spark.readStream.schema(RESPONSES).parquet(src), str(tmp_path / "out"))
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    deadline = time.time() + 20
    while listener.total()["n_pages"] < want["n_pages"] and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(listener)
    total = listener.total()
    assert (total["n_pages"], total["n_bytes"]) == (want["n_pages"], want["n_bytes"]) and total["n_candidates"] >= want["n_candidates"]


def _asks(spark, rows):
    return spark.createDataFrame([(s, p, x, (i,)) for s, p, links in rows for i, x in enumerate(links)], "session_id long, page_id long, resolved string, place struct<ord:int>")


def test_cap_by_parts(spark, monkeypatch):
    """Queues too large for a task go by components, and too large components by rounds."""
    dice = random.Random(11)
    rows = [(s, p, list(dict.fromkeys(f"{p % 4}u{dice.randrange(14)}" for _ in range(dice.randrange(12))))) for s in range(2) for p in range(24)]
    rows += [(5, p, [f"c{p}", f"c{p + 1}"]) for p in range(6)]
    want = {(s, *row) for s in {r[0] for r in rows} for row in _queue({p: links for t, p, links in rows if t == s}, 3 if s < 5 else 3)}
    for held in (500_000, 60, 20, 0):
        monkeypatch.setattr(dedupe, "HELD", held)
        assert {(r["session_id"], r["page_id"], r["resolved"]) for r in dedupe.capped(_asks(spark, rows), 3).collect()} == want


def test_cap_of_a_chain(spark):
    """Pages that each pass an address on take as many jobs, however many they are."""

    def jobs(n):
        spark.sparkContext.setJobGroup(f"chain-{n}", "")
        rows = [(0, p, [f"a{p}", f"a{p + 1}"]) for p in range(n)]
        found = {(r["page_id"], r["resolved"]) for r in dedupe.capped(_asks(spark, rows).coalesce(2), 1).collect()}
        assert found == {(p, f"a{p}") for p in range(n)}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"chain-{n}"))

    assert jobs(10) == jobs(1000)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
