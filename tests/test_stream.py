"""A stream that remembers, against a plain replay of its events."""

import random

import pytest
from pyspark.sql import functions as F

from linkloom.sources.pages import stream_pages
from linkloom.streaming import stream

TARGETS = "session_id long, page_id long, url string, candidate string, place struct<pass:int,chunk_no:int,pattern_no:int,ord:int>, resolved string, host string, is_new_subdomain boolean, uri string"


class Run:
    """A sink with a stream of targets, batch by batch."""

    def __init__(self, spark, folder, most):
        self.spark, self.sink, self.pages, self.most = spark, str(folder / "sink"), str(folder / "pages"), most

    def feed(self, pages):
        """pages: (session, page, addresses)"""
        rows = [(s, p, f"http://h{s}.com/p", a, (0, 0, 0, i), a, "h", False, a) for s, p, links in pages for i, a in enumerate(links)]
        self.spark.createDataFrame(rows, TARGETS).coalesce(1).write.mode("append").parquet(self.pages)

    def go(self):
        stream.follow(self.spark.readStream.schema(TARGETS).parquet(self.pages), self.sink, self.most)

    def came(self):
        return sorted((r["session_id"], r["page_id"], r["resolved"]) for r in stream.written(self.spark, self.sink).collect())

    def state(self):
        return sorted((r["session_id"], r["resolved"]) for r in stream.remembered(self.spark, self.sink).collect())


class Replay:
    """What should come, event by event."""

    def __init__(self, most):
        self.most, self.seen, self.out = most, {}, []

    def batch(self, pages, control=()):
        events = [((-1 if at is None else at, 0, k), (s, event, a)) for k, (s, event, at, a) in enumerate(control)] + [((p, 1, 0), (s, p, links)) for s, p, links in pages]
        for (_, asks, _), (s, what, more) in sorted(events):
            seen = self.seen.setdefault(s, set())
            if asks:
                new = [a for a in dict.fromkeys(more) if a not in seen][: self.most]
                seen |= set(new)
                self.out += [(s, what, a) for a in new]
            elif what in stream.FORGETTING:
                seen.clear()
            elif what == stream.MARKING:
                seen.add(more)


@pytest.mark.parametrize("most", [2, 100])
def test_interleavings(spark, tmp_path, most):
    dice = random.Random(most)
    run, plain, page = Run(spark, tmp_path, most), Replay(most), 0
    for _ in range(4):
        pages = [(dice.randrange(2), page + i, [f"u{dice.randrange(15)}" for _ in range(dice.randrange(7))]) for i in range(8)]
        control = [(dice.randrange(2), dice.choice([*stream.FORGETTING, "node added", stream.MARKING]), dice.choice([None, page + 3, page + 6]), f"u{dice.randrange(15)}") for _ in range(3)]
        control = list({(s, at): (s, e, at, a) for s, e, at, a in control}.values())  # the order of events at one place is open
        page += 8
        run.feed(pages)
        for s, event, at, a in control:
            if event == stream.MARKING:
                stream.mark_seen(spark, run.sink, s, a, at)
            else:
                assert stream.on_event(spark, run.sink, s, event, at) == (event in stream.FORGETTING)
        run.go()
        plain.batch(pages, control)
        assert run.came() == sorted(plain.out)
    assert run.state() == sorted((s, a) for s, seen in plain.seen.items() for a in seen)


def test_a_batch_does_not_read_the_sink(spark, tmp_path):
    run = Run(spark, tmp_path, 10)
    run.feed([(0, 1, ["a", "b"])])
    run.go()
    path, fs = stream._path(spark, f"{run.sink}/nodes")
    fs.delete(path, True)
    run.feed([(0, 2, ["b", "c"])])
    run.go()
    assert run.came() == [(0, 2, "c")]


def test_a_batch_that_fails_comes_again(spark, tmp_path, monkeypatch):
    """It has written when it fails; what nobody could bring in is told once."""
    run, plain = Run(spark, tmp_path, 2), Replay(2)
    first, second = [(0, 1, ["a", "b", "c", "d"]), (0, 2, ["c", "x", "y"])], [(0, 3, ["d", "y", "a"])]
    run.feed(first)
    write = stream._write

    def fail(*given):
        write(*given)
        raise RuntimeError("lost")

    monkeypatch.setattr(stream, "_write", fail)
    with pytest.raises(Exception, match="lost"):
        run.go()
    monkeypatch.setattr(stream, "_write", write)
    run.go()
    plain.batch(first)
    assert run.came() == sorted(plain.out)
    run.feed(second)
    run.go()
    plain.batch(second)
    assert run.came() == sorted(plain.out) and (0, 3, "d") in plain.out


def test_many_batches_in_one_run(spark, tmp_path):
    """Files are taken one at a time, and what the first leaves over comes in with the second."""
    run, plain = Run(spark, tmp_path, 1), Replay(1)
    for k in range(3):
        pages = [(0, k, ["a", "b", f"c{k}"])]
        run.feed(pages)
        plain.batch(pages)
    stream.follow(spark.readStream.schema(TARGETS).option("maxFilesPerTrigger", 1).parquet(run.pages), run.sink, 1)
    assert run.came() == sorted(plain.out) == [(0, 0, "a"), (0, 1, "b"), (0, 2, "c2")]


def test_settings_stay(spark, tmp_path):
    name = next(iter(stream.ROCKS))
    before = spark.conf.get(name)
    run = Run(spark, tmp_path, 1)
    run.feed([(0, 1, ["a"])])
    run.go()
    assert spark.conf.get(name) == before
    assert spark.range(3).select(F.count("id")).first()[0] == 3


def test_a_stream_that_is_left(spark, tmp_path):
    """It ends with what has come by then, and so it does after an error; its listener goes too."""
    src, sink = str(tmp_path / "in"), str(tmp_path / "out")
    page = lambda i: spark.createDataFrame([(i, "http://h.com/", f"<a href='/a'><a href='/p{i}'>")], "page_id long, url string, html string").coalesce(1)
    page(1).write.parquet(src)
    with stream.Discovery(stream_pages(spark, src), sink) as running:
        running.query.processAllAvailable()
        assert running.forget(0) and not running.forget(0, "node added")
        page(2).write.mode("append").parquet(src)
        assert running.query.isActive
    assert not running.query.isActive
    assert sorted((r["page_id"], r["resolved"]) for r in stream.written(spark, sink).collect()) == [(1, "http://h.com/a"), (1, "http://h.com/p1"), (2, "http://h.com/a"), (2, "http://h.com/p2")]
    with pytest.raises(KeyError), stream.Discovery(stream_pages(spark, src), sink) as running:
        raise KeyError("x")
    assert not running.query.isActive


class Calls:
    """A map state that counts what it is asked."""

    def __init__(self, held=()):
        self.held, self.n = dict(held), 0

    def __getattr__(self, name):
        self.n += 1
        return {"containsKey": lambda k: k in self.held, "getValue": self.held.get, "removeKey": self.held.pop, "clear": self.held.clear, "updateValue": self.held.__setitem__}[name]


def test_a_batch_asks_its_state_little_however_often_it_forgets():
    event = lambda kind, at, address=None, forgets=False: dict.fromkeys(stream.Remember.KEPT) | {"kind": kind, "at": at, "page_id": at, "resolved": address, "forgets": forgets}
    rows = [event(stream.ASKED, p, f"u{i}") for p in range(300) for i in range(3)] + [event(stream.TOLD, p, None, True) for p in range(10, 300, 10)] + [event(stream.TOLD, 295, "u1"), event(stream.REFUSED, None, "u2")]
    own = stream.Remember()
    own.seen = Calls({("u0",): (0, False), ("u1",): (0, True), ("u2",): (0, False), ("old",): (0, False)})
    out = [(r["label"], r["page_id"], r["resolved"]) for r in own.handleInputRows((0, 0), iter(rows), None)]
    want = [(0, p, "u2") for p in range(10)] + [(p // 10, p, f"u{i}") for p in range(10, 300) for i in range(3) if not (p >= 295 and i == 1)]
    assert out == want
    assert own.seen.held == {("u0",): (290, False), ("u1",): (295, True), ("u2",): (290, False)}
    assert own.seen.n < 12


def test_what_was_asked_for_before_a_session_forgot_is_not_refused(spark, tmp_path):
    run, plain = Run(spark, tmp_path, 1), Replay(1)
    pages = [(0, 1, ["a", "b"]), (0, 5, ["c", "d"])]
    run.feed(pages)
    stream.on_event(spark, run.sink, 0, stream.FORGETTING[0], 3)
    run.go()
    plain.batch(pages, [(0, stream.FORGETTING[0], 3, None)])
    assert run.came() == sorted(plain.out) and run.state() == [(0, "c")]
    assert [r["resolved"] for r in spark.read.parquet(f"{run.sink}/refused").collect()] == ["d"]
