"""WARC archives of pages, with an index merged from sorted runs.

Pages become records of archives: a response with its payload, or a revisit that names the response with the same payload.
Archives are read back in byte ranges. Each range's captures are a run, sorted by (URL key, time, page, digest, place) within its task. Runs
are cut at borders drawn from a sample of all keys, and each stretch between two borders is merged from all
runs by a loser tree: k sorted streams, log2(k) comparisons a capture. Stretches follow each other, so their captures in
order are the whole index; a prefix sum over stretches gives each its place in it, and each its place in its URL's history.

No two captures have the same full key, so a URL that a third of all captures share is dealt over many stretches.

The driver holds a sampled key for each SAMPLED_EACH captures and a row for each stretch; a task a stretch.

Cases: null html is an empty payload, null url an empty one. Payloads under `least` bytes are always responses. Of equal payloads every
row with the largest page_id is a response; a null page_id counts as the smallest, and where all are null all are responses.
Repeated rows are records of their own. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import bisect
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import materialize, shared_dir, split_join
from linkloom.sources.warc import read_archives, write_archives

#: Captures of a stretch, about, and captures for each key of the sample.
STRETCH, SAMPLED_EACH = 100_000, 10_000
#: Repeated payloads that are broadcast; more are joined by a shuffle.
FEW = 200_000
BLOCK = 5_000
EPOCH = 946_684_800

KEY = ("url_key", "captured_at", "page_id", "payload_digest", "archive", "offset")
_CAPTURE = "url_key string, captured_at string, page_id long, payload_digest string, archive string, offset long, length long, payload_bytes long, record_type string, refers_to long"
_NAMES = [c.split()[0] for c in _CAPTURE.split(", ")]
_STRUCT = pa.struct([(c.split()[0], {"string": pa.string(), "long": pa.int64()}[c.split()[1]]) for c in _CAPTURE.split(", ")])


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then path and query, in lower case: pages of a host stand together, and hosts of a domain."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), F.lit("(?s)#.*$"), F.lit(""))
    host = F.regexp_extract(bare, r"^[^:/?#]*://([^/?#]*)", 1)
    rest = F.regexp_replace(bare, F.lit(r"^[^:/?#]*://[^/?#]*"), F.lit(""))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), ","), F.lit(")"), rest)


def captured_at(page_id: Column) -> Column:
    """The time of a capture; pages have none, so it comes from their ids."""
    return F.date_format(F.timestamp_seconds(F.pmod(F.coalesce(page_id, F.lit(0)), F.lit(1_000_000_000)) + EPOCH), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def deduplicated(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, body, n, digest, original: the page whose response has a repeated payload, else null."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    sized = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("body")).withColumns({"n": F.octet_length("body").cast("long"), "digest": F.sha1("body"), "same": F.sha2("body", 256)})
    large = sized.where(F.col("n") >= least)
    groups = materialize(large.groupBy("same").agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("same", "original"), "repeated-payloads")
    if groups.count() <= FEW:
        both = sized.withColumn("same", F.when(F.col("n") >= least, F.col("same"))).join(F.broadcast(groups), "same", "left")
    else:
        all_ = large.groupBy("same").agg(F.max("page_id").alias("original"))
        both = split_join(large, all_, "same", "page_id").unionByName(sized.where(F.col("n") < least).withColumn("original", F.lit(None).cast("long")))
    again = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return both.select("page_id", "url", "body", "n", "digest", F.when(again, F.col("original")).alias("original"))


def as_records(rows: DataFrame) -> DataFrame:
    """Rows of deduplicated() as the archives' sink takes them."""
    revisit = F.col("original").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    fields = {
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), "digest"), "X-Payload-Bytes": F.col("n").cast("string"), "X-Page-ID": F.col("page_id").cast("string"),
        "WARC-Refers-To": F.when(revisit, name("original")), "WARC-Profile": F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
    }
    given = F.map_filter(F.create_map(*(x for k, v in fields.items() for x in (F.lit(k), v))), lambda _, v: v.isNotNull())
    return rows.select(
        "url", captured_at(F.col("page_id")).alias("date"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"), given.alias("fields"),
        F.lit(200).alias("status"), F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8")).alias("headers"), F.when(~revisit, F.col("body")).alias("body"),
    )


def captures(records: DataFrame) -> DataFrame:
    """What an index says of each record, as it stands in the archives."""
    response = F.col("record_type") == "response"
    field = lambda c: F.col("fields")[c]
    number = lambda c: F.expr(f"try_cast(fields['{c}'] as long)")
    return records.select(
        url_key(F.col("url")).alias("url_key"), F.col("date").alias("captured_at"), number("x-page-id").alias("page_id"),
        F.when(response, F.sha1("body")).otherwise(F.regexp_replace(field("warc-payload-digest"), "^sha1:", "")).alias("payload_digest"), "archive", "offset", "length",
        F.when(response, F.octet_length("body").cast("long")).otherwise(number("x-payload-bytes")).alias("payload_bytes"), "record_type",
        F.regexp_extract(field("warc-refers-to"), r"^<urn:page:(-?\d+)>$", 1).try_cast("long").alias("refers_to"),
    )


def _keys(columns: list[list]) -> list[tuple]:
    """Keys that compare as the index sorts: nulls first."""
    return [(k or "", t or "", p is not None, p or 0, d or "", a, o) for k, t, p, d, a, o in zip(*columns, strict=True)]


class LoserTree:
    """The least of the heads of k sorted runs. Each inner place keeps who lost there, so a new head plays log2(k) games."""

    def __init__(self, heads: list[tuple | None]):
        self.heads, k = list(heads), len(heads)
        self.losers = [0] * k
        won = [0] * k + list(range(k))
        for at in range(k - 1, 0, -1):
            a, b = won[2 * at], won[2 * at + 1]
            won[at], self.losers[at] = (a, b) if self.before(a, b) else (b, a)
        self.winner = won[1] if k > 1 else 0

    def before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and x <= y)

    def replace(self, head: tuple | None) -> None:
        """The winner's run goes on with this head; None if it has ended."""
        own, losers = self.winner, self.losers
        self.heads[own] = head
        at = (own + len(self.heads)) // 2
        while at:
            if self.before(losers[at], own):
                losers[at], own = own, losers[at]
            at //= 2
        self.winner = own


def merged(runs: list[list[tuple]]) -> list[tuple[int, int]]:
    """(run, place in it) of all items of sorted runs, in order."""
    tree, places, out = LoserTree([r[0] if r else None for r in runs]), [0] * len(runs), []
    while runs and tree.heads[tree.winner] is not None:
        run = tree.winner
        out.append((run, places[run]))
        places[run] += 1
        tree.replace(runs[run][places[run]] if places[run] < len(runs[run]) else None)
    return out


def _cut(borders: list[tuple]):
    """Streams (run, captures in order): blocks of a run between two borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = batch.column(0).to_pylist()
            keys = _keys([batch.column(batch.schema.get_field_index(c)).to_pylist() for c in KEY])
            starts, stretches, owners, upto = [], [], [], None
            for i, key in enumerate(keys):
                if not starts or runs[i] != owners[-1] or (upto is not None and key >= upto) or i - starts[-1] >= BLOCK:
                    at = bisect.bisect_right(borders, key)
                    upto = borders[at] if at < len(borders) else None
                    starts.append(i)
                    stretches.append(at)
                    owners.append(runs[i])
            own = pa.StructArray.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in _NAMES], fields=list(_STRUCT))
            blocks = pa.ListArray.from_arrays(pa.array([*starts, batch.num_rows], pa.int32()), own)
            yield pa.RecordBatch.from_arrays([pa.array(stretches, pa.int32()), pa.array(owners, pa.int32()), blocks], names=["stretch", "run", "captures"])

    return run


def _merge(group: pa.Table) -> pa.Table:
    """All blocks of a stretch as captures in order, with their number in it and among those of their URL in it."""
    owners, blocks = group.column("run").to_pylist(), group.column("captures").combine_chunks()
    if isinstance(blocks, pa.ChunkedArray):
        blocks = blocks.chunk(0)
    flat, offsets = blocks.flatten(), blocks.offsets.to_pylist()
    base = offsets[0]
    keys = _keys([flat.field(c).to_pylist() for c in KEY])
    by_run: dict[int, list[int]] = {}
    for i, owner in sorted(enumerate(owners), key=lambda x: keys[offsets[x[0]] - base]):  # a run's blocks in order
        by_run.setdefault(owner, []).extend(range(offsets[i] - base, offsets[i + 1] - base))
    places = list(by_run.values())
    order = [places[r][i] for r, i in merged([[keys[p] for p in own] for own in places])]
    nth, url, n = [], None, 0
    for p in order:
        n, url = (n + 1 if keys[p][0] == url else 1), keys[p][0]
        nth.append(n)
    taken = flat.take(pa.array(order))
    stretch = group.column("stretch")[0].as_py()
    return pa.table([pa.array([stretch] * len(order), pa.int32()), pa.array(range(len(order)), pa.int64()), pa.array(nth, pa.int64()), *(taken.field(c) for c in _NAMES)], names=["stretch", "no", "nth", *_NAMES])


def _begins(summaries: list) -> list[tuple[int, int, str | None, int]]:
    """(stretch, captures before it, the URL that the ones before end with, how many captures of it they have)"""
    found, at, url, n = [], 0, None, 0
    for s in sorted(summaries, key=lambda s: s["stretch"]):
        found.append((s["stretch"], at, url, n))
        at, url, n = at + s["n"], s["last"], s["tail"] + (n if s["first"] == s["last"] == url else 0)
    return found


def history(found: DataFrame) -> DataFrame:
    """captures() in order of the index: position (from 1), nth (capture of its URL, from 1), and the captures' columns."""
    spark = found.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = materialize(found.withColumn("run", F.spark_partition_id()).sortWithinPartitions(*(F.asc_nulls_first(c) for c in KEY)), "capture-runs")
    drawn = runs.where(F.pmod(F.xxhash64("archive", "offset"), F.lit(SAMPLED_EACH)) == 0).select(*KEY).collect()  # a key for SAMPLED_EACH captures
    sample = sorted(_keys([[r[c] for r in drawn] for c in KEY]))
    step = STRETCH // SAMPLED_EACH
    blocks = runs.select("run", *_NAMES).mapInArrow(_cut(sample[step - 1 :: step]), f"stretch int, run int, captures array<struct<{_CAPTURE.replace(' ', ':').replace(',:', ',')}>>")
    whole = materialize(blocks.repartition(n, "stretch").groupBy("stretch").applyInArrow(_merge, f"stretch int, no long, nth long, {_CAPTURE}"), "capture-index")
    sums = whole.groupBy("stretch").agg(F.count(F.lit(1)).alias("n"), F.min("url_key").alias("first"), F.max("url_key").alias("last"), F.max_by("nth", "no").alias("tail")).collect()  # a row a stretch
    begins = F.broadcast(spark.createDataFrame(_begins(sums), "stretch int, _before long, _url string, _n long"))
    placed = whole.join(begins, "stretch", "left")
    more = F.when(F.col("url_key") == F.col("_url"), F.col("_n")).otherwise(0)
    return placed.select((F.col("_before") + F.col("no") + 1).alias("position"), (F.col("nth") + more).alias("nth"), *_NAMES)


def archive(pages: DataFrame, folder: str, least: int = 1000) -> DataFrame:
    """Writes pages (page_id, url, html) as archives in a folder; returns their index."""
    write_archives(as_records(deduplicated(pages, least)), folder)
    return history(captures(read_archives(pages.sparkSession, folder)))


def digests(pages: DataFrame) -> DataFrame:
    """Per page: what the archives, read back, say of it."""
    folder = f"{shared_dir(pages.sparkSession)}/linkloom/archives-{uuid.uuid4().hex}"
    return archive(pages, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "position", "nth", "url_key", "captured_at")
