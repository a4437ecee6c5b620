"""Workers hold little at once, however large the batches that come."""

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from linkloom.sources import pages, warc
from linkloom.workers import BATCH_BYTES, pieces

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def largest(df):
    """Bytes of the largest batch that a worker gets of df."""

    def run(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max((b.nbytes for b in batches), default=0)])], names=["n"])

    return df.mapInArrow(run, "n long").agg(F.max("n")).first()[0]


def test_pieces_are_all_of_a_batch():
    batch = pa.RecordBatch.from_pydict({"x": ["a" * (i % 100) * 100 for i in range(2000)]})
    parts = list(pieces(batch, 100_000))
    assert len(parts) > 50 and pa.Table.from_batches(parts) == pa.Table.from_batches([batch])
    assert list(pieces(batch.slice(0, 0))) == [] and len(list(pieces(batch.slice(0, 3), 1))) == 3


def test_decoding_and_encoding_go_by_small_batches(spark):
    texts = spark.range(3000).repartition(1).select("id", F.repeat(F.lit("é"), 5000).alias("body"), F.lit("utf-16").alias("charset"))
    for make in (pages.encode_bytes, lambda df, b, c: pages.decode_bytes(df.withColumn(b, F.encode(b, "utf-16")), b, c)):
        spark.conf.unset(KEY)
        assert largest(make(texts, "body", "charset")) < 2 * BATCH_BYTES
    back = pages.decode_bytes(pages.encode_bytes(texts, "body", "charset"), "body", "charset")
    assert back.exceptAll(texts).isEmpty() and back.count() == 3000


def test_a_writer_holds_a_part_of_its_batch(tmp_path):
    bodies = [bytes([65 + i % 20]) * 20_000 for i in range(3000)]
    batch = pa.RecordBatch.from_pydict({"url": [f"http://h/{i}" for i in range(3000)], "body": bodies})
    writer = warc._Writer(str(tmp_path), 1 << 30, 1, False)
    tracemalloc.start()
    done = writer.write(iter([batch]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done.archives[0]["records"] == 3000 and most < 10_000_000
    writer.commit([done])
    ranges = warc._Folder({"path": str(tmp_path), "rangeBytes": "20000"})
    read = [b for r in ranges.ranges() for batch in ranges.batches(r) for b in batch.column("body").to_pylist()]
    assert sorted(read) == sorted(bodies)
