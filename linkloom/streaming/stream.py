"""The same discovery over a stream that remembers by keyed state, so that a batch costs what it brings, however much came before.

Events of three kinds meet in one stateful operator, dealt by session and by a bucket of the address, and are taken in event
order there: what pages ask for (at their page_id), control events (a session forgets its addresses, an address counts as seen; before the
page of their `at`), and addresses that all pages which asked for them in an earlier batch had to leave over. A session that forgets
does so in each of its buckets; so a session's state is dealt over many tasks, whatever its share of all rows.

The state of a bucket is a map of addresses. The operator lets through what asks for an address that isn't in it, and puts it there. A batch
of what it let through then goes through the cap for each page (`dedupe.capped`) into the sink. What nobody could bring in goes
to `refused`, which the same stream reads: the next batch takes it out of the map before anything else.

The sink's nodes are a table of batches (`sink`), which a batch that comes again after a failure writes anew, and of which readers see
whole batches only; every COMPACT_EACH batches they become few files. State and progress are in its checkpoint. Addresses are kept until their session forgets them, or for `forget_after_ms` of processing time.

`append` brings a batch into a sink without a stream and its state: it looks the sink up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues

from linkloom.operators.dedupe import capped, unknown
from linkloom.operators.extract import found_candidates, seen_links
from linkloom.operators.nodes import placeholder_nodes
from linkloom.operators.quarantine import fine
from linkloom.operators.targets import targets
from linkloom.options import Options
from linkloom.plans.discover import found_targets
from linkloom.storage import materialize
from linkloom.streaming import sink as batches

NODES = "session_id long, page_id long, method string, uri string, resolved string, host string, is_new_subdomain boolean, note string, entry_type string, source_url string"
CONTROL = "session_id long, at long, event string, resolved string, written_at timestamp"
#: Events of the address tree that make a session forget; others change nothing.
FORGETTING = ("node removed", "site removed")
MARKING = "seen"
#: Names of what is counted on the way.
PAGES, LINKS = "pages", "links"
#: Parts of a session's addresses. A checkpoint holds for the number with which it began.
BUCKETS = 64
#: After so many batches the sink's files are written together.
COMPACT_EACH = 100
REFUSED, TOLD, ASKED = 0, 1, 2
_PLACE = ("pass", "chunk_no", "pattern_no", "ord")
_ASK = "label int, session_id long, page_id long, url string, resolved string, host string, is_new_subdomain boolean, uri string, pass int, chunk_no int, pattern_no int, ord int"
_EVENT = f"bucket int, kind int, at long, forgets boolean, {_ASK.removeprefix('label int, ')}"
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _nodes(spark: SparkSession, sink: str, before: int | None = None) -> DataFrame:
    return batches.read(spark, f"{sink}/nodes", f"{NODES}, written_at timestamp", before)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    hadoop, fs = _path(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(hadoop) else spark.createDataFrame([], schema)


def written(spark: SparkSession, sink: str) -> DataFrame:
    return _nodes(spark, sink).drop("batch")


def seen(spark: SparkSession, sink: str, before: int | None = None) -> DataFrame:
    """session_id, uri of what counts as seen by the sink alone: written since its session last forgot, by batches before `before`."""
    told = _read(spark, f"{sink}/control", CONTROL).where(F.col("event").isin(*FORGETTING))
    last = told.groupBy("session_id").agg(F.max("written_at").alias("at"))
    return _nodes(spark, sink, before).join(last, "session_id", "left").where("at is null or written_at > at").select("session_id", "uri")


def remembered(spark: SparkSession, sink: str) -> DataFrame:
    """session_id, resolved of what is in the state of the sink's stream."""
    state = spark.read.format("statestore").option("stateVarName", "seen").load(f"{sink}/progress")
    return state.select("key.session_id", "user_map_key.resolved")


def _tell(spark: SparkSession, sink: str, session_id: int, at: int | None, event: str, resolved: str | None) -> None:
    one = spark.range(1).select(F.lit(session_id).cast("long").alias("session_id"), F.lit(at).cast("long").alias("at"), F.lit(event).alias("event"), F.lit(resolved).cast("string").alias("resolved"), F.current_timestamp().alias("written_at"))
    one.coalesce(1).write.mode("append").parquet(f"{sink}/control")


def on_event(spark: SparkSession, sink: str, session_id: int, event: str, at: int | None = None) -> bool:
    """Forgets a session's addresses if the event says so: before the page `at`, or before all that come with it."""
    if event not in FORGETTING:
        return False
    _tell(spark, sink, session_id, at, event, None)
    return True


def mark_seen(spark: SparkSession, sink: str, session_id: int, resolved: str, at: int | None = None) -> None:
    """An address counts as brought in from there on."""
    _tell(spark, sink, session_id, at, MARKING, resolved)


def append(batch: DataFrame, sink: str, options: Options, in_scope: Column | None = None, batch_id: int = 0) -> None:
    """Writes what a batch brings in; the same rows if it comes again."""
    spark = batch.sparkSession
    found = unknown(found_targets(batch, options, in_scope), seen(spark, sink, batch_id))
    _write(capped(found, options.most_inserts), sink, batch_id)


def _write(came: DataFrame, sink: str, batch_id: int) -> None:
    batches.write(placeholder_nodes(came).withColumn("written_at", F.current_timestamp()), f"{sink}/nodes", batch_id)


class Counts(StreamingQueryListener):
    """What the streams of a session look through and find, batch by batch: spark.streams.addListener(Counts()). A find that a page has twice counts twice."""

    def __init__(self):
        self.batches: dict[tuple[str, int], dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = {k: v for name in (PAGES, LINKS) for k, v in (event.progress.observedMetrics.get(name) or Row()).asDict().items()}
        if seen.get("n_pages"):
            self.batches[str(event.progress.runId), event.progress.batchId] = seen

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self) -> dict[str, int]:
        return {c: sum(b.get(c, 0) for b in self.batches.values()) for c in ("n_pages", "n_bytes", "n_candidates")}


class Remember(StatefulProcessor):
    """Lets through what asks for an address that isn't remembered, with the number of times that its session forgot before in this batch."""

    KEPT = tuple(c.split()[0] for c in _ASK.split(", ")[1:])

    def __init__(self, forget_after_ms: int | None = None):
        self.ttl = forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "resolved string", "at long, told boolean", self.ttl)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        least = -(1 << 63)
        order = lambda r: (r["kind"] != REFUSED, least if r["at"] is None else r["at"], r["kind"], *(r[c] or 0 for c in _PLACE), r["resolved"] or "")
        label, forgot = 0, False
        there: dict[str, bool] = {}  # whether an address was remembered when this batch began, or since its session forgot
        new: dict[str, tuple[int, bool]] = {}  # what the state gets once the batch has come: each call to it goes to the JVM and back
        for r in sorted(rows, key=order):
            address = r["resolved"]
            if r["forgets"]:
                label, forgot = label + 1, True
                there.clear()
                new.clear()
            elif r["kind"] == REFUSED:  # these come first
                value = self.seen.getValue((address,))
                if value is not None and not value[1]:
                    self.seen.removeKey((address,))
            elif r["kind"] == TOLD:
                new[address] = (r["at"] or 0, True)
                there[address] = True
            else:
                if address not in there:
                    there[address] = not forgot and self.seen.containsKey((address,))
                    if not there[address]:
                        new[address] = (r["at"] or 0, False)
                if not there[address]:
                    yield Row(label=label, **{c: r[c] for c in self.KEPT})
        if forgot:
            self.seen.clear()
        for address, value in new.items():
            self.seen.updateValue((address,), value)

    def close(self) -> None:
        pass


def _events(df: DataFrame, **columns: Column) -> DataFrame:
    """df as events; columns that it lacks are null."""
    own = [c.split() for c in _EVENT.split(", ")]
    return df.select(*((columns[n] if n in columns else F.col(n) if n in df.columns else F.lit(None)).cast(kind).alias(n) for n, kind in own))


def _bucket(resolved: str = "resolved") -> Column:
    return F.pmod(F.xxhash64(resolved), F.lit(BUCKETS))


def asks(found: DataFrame) -> DataFrame:
    """Targets as events."""
    return _events(found.select("*", *(F.col(f"place.{c}").alias(c) for c in _PLACE)), bucket=_bucket(), kind=F.lit(ASKED), at=F.col("page_id"), forgets=F.lit(False))


def told(control: DataFrame) -> DataFrame:
    """Control events as events: forgetting reaches each bucket of its session. Unknown events change nothing."""
    forgets = F.col("event").isin(*FORGETTING)
    every = F.when(forgets, F.sequence(F.lit(0), F.lit(BUCKETS - 1))).when((F.col("event") == MARKING) & F.col("resolved").isNotNull(), F.array(_bucket().cast("int")))
    dealt = control.select("session_id", "at", "resolved", forgets.alias("forgets"), F.explode(every).alias("bucket"))
    return _events(dealt, kind=F.lit(TOLD))


def remembering(events: DataFrame, forget_after_ms: int | None = None) -> DataFrame:
    """What asks for addresses that aren't remembered."""
    mode = "None" if forget_after_ms is None else "ProcessingTime"
    new = events.groupBy("session_id", "bucket").transformWithState(Remember(forget_after_ms), _ASK, "Append", mode)
    return new.withColumn("place", F.struct(*_PLACE)).drop(*_PLACE)


def _commit(sink: str, most: int) -> Callable[[DataFrame, int], None]:
    def run(batch: DataFrame, number: int) -> None:
        asked = materialize(batch, "asked")
        scope = ("session_id", "label")
        came = materialize(capped(asked, most, scope), "came")
        _write(came, sink, number)
        # addresses that nobody could bring in, since their session last forgot; what was asked for before it did is in no state any more
        last = asked.groupBy("session_id").agg(F.max("label").alias("_last")).withColumnRenamed("session_id", "_session")
        late = asked.select(*scope, "resolved").distinct().join(last, (F.col("session_id") == F.col("_session")) & (F.col("label") < F.col("_last")), "left_anti")
        left = late.join(came.select(*scope, "resolved"), [*scope, "resolved"], "left_anti").select("session_id", "resolved")
        if not left.isEmpty():
            left.write.mode("overwrite").parquet(f"{sink}/refused/batch={number}")
        if number % COMPACT_EACH == COMPACT_EACH - 1:
            batches.compact(batch.sparkSession, f"{sink}/nodes", f"{NODES}, written_at timestamp")

    return run


def _followed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of files of a folder that need not be there yet."""
    hadoop, fs = _path(spark, path)
    fs.mkdirs(hadoop)
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)


def follow(found: DataFrame, sink: str, most: int, forget_after_ms: int | None = None, until_done: bool = True) -> StreamingQuery:
    """A stream of targets into the sink, with its control events. Runs over all that is there, then ends; or goes on until stop() is called."""
    spark = found.sparkSession
    refused = _followed(spark, f"{sink}/refused", "session_id long, resolved string")
    events = asks(found).unionByName(told(_followed(spark, f"{sink}/control", CONTROL))).unionByName(_events(refused, bucket=_bucket(), kind=F.lit(REFUSED), forgets=F.lit(False)))
    before = {k: spark.conf.get(k, None) for k in ROCKS}
    for k, v in ROCKS.items():
        spark.conf.set(k, v)
    try:  # a stream keeps the settings that it began with
        query = remembering(events, forget_after_ms).writeStream.foreachBatch(_commit(sink, most)).option("checkpointLocation", f"{sink}/progress").start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if until_done:
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return query


def start(responses: DataFrame, sink: str, options: Options | None = None, in_scope: Column | None = None, site_nodes: DataFrame | None = None, forget_after_ms: int | None = None, until_done: bool = True) -> StreamingQuery:
    """A stream of responses into the sink; call it again for more. Its progress has what was looked through and found (see Counts)."""
    own = options or Options()
    found = seen_links(found_candidates(fine(responses, in_scope), own.parse_javascript, counter=PAGES), LINKS)
    found = targets(found, own.discover_subdomains)
    if site_nodes is not None:
        found = found.join(site_nodes.select("session_id", "uri"), ["session_id", "uri"], "left_anti")
    return follow(found, sink, own.most_inserts, forget_after_ms, until_done)


class Discovery:
    """A stream that runs until it is left, with its counts:

        with Discovery(stream_pages(spark, "pages/"), "sink/") as running:
            ...
            running.forget(session_id)
        running.counts.total()

    Leaving it finishes what has come by then, stops the stream and takes its listener from the session, also after an error.
    """

    def __init__(self, responses: DataFrame, sink: str, options: Options | None = None, in_scope: Column | None = None, site_nodes: DataFrame | None = None, forget_after_ms: int | None = None):
        self.spark, self.sink, self.counts, self.query = responses.sparkSession, sink, Counts(), None
        self._begin = lambda: start(responses, sink, options, in_scope, site_nodes, forget_after_ms, until_done=False)

    def __enter__(self) -> Discovery:
        self.spark.streams.addListener(self.counts)
        try:
            self.query = self._begin()
        except Exception:
            self.spark.streams.removeListener(self.counts)
            raise
        return self

    def forget(self, session_id: int, event: str = FORGETTING[0], at: int | None = None) -> bool:
        return on_event(self.spark, self.sink, session_id, event, at)

    def __exit__(self, failed, *_) -> None:
        try:
            if failed is None:
                self.query.processAllAvailable()
        finally:
            self.query.stop()
            self.spark.streams.removeListener(self.counts)
