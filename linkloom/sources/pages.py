"""Responses to look through: pages, with what their headers say."""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.functions import constants as C
from linkloom.functions.text import CHARSETS
from linkloom.options import Options
from linkloom.workers import bound_batches, pieces, sparing

RESPONSES = T.StructType([
    T.StructField("session_id", T.LongType()), T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("content_type", T.StringType()), T.StructField("source_map", T.StringType()), T.StructField("x_source_map", T.StringType()),
    T.StructField("body", T.StringType()),
])


def read_pages(spark: SparkSession, path: str, options: Options | None = None) -> DataFrame:
    """A table (page_id, url, html) as responses without source-map headers. A scan of one split is spread over the threads."""
    pages = spark.read.parquet(path)
    return as_responses(pages.repartition(options.threads) if options else pages)


def stream_pages(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """The same as a stream of files; instead of dropping what is too much, it takes so many files at a time."""
    schema = "page_id long, url string, html string"
    return as_responses(spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path))


def as_responses(pages: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return pages.select(F.lit(0).cast("long").alias("session_id"), "page_id", "url", F.lit("text/html").alias("content_type"), none.alias("source_map"), none.alias("x_source_map"), F.col("html").alias("body"))


def decode_bytes(df: DataFrame, body: str, charset: str, failed: str | None = None) -> DataFrame:
    """df with a binary body decoded by the charset of its row, where F.decode doesn't know it.

    Unknown charsets, and null, count as UTF-8; bad bytes become U+FFFD. failed: a further column, which says where a charset is unknown.
    """
    at, by = df.columns.index(body), df.columns.index(charset)
    fields = [T.StructField(f.name, T.StringType()) if f.name == body else f for f in df.schema.fields]
    schema = T.StructType(fields if failed is None else [*fields, T.StructField(failed, T.StringType())])

    def known(name: str | None) -> bool:
        try:
            return codecs.lookup(name or "utf-8")._is_text_encoding
        except (LookupError, ValueError):
            return False

    def text(raw: bytes | None, name: str | None) -> str | None:
        return None if raw is None else raw.decode(name if name and known(name) else "utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            names = batch.column(by).to_pylist()
            texts = [text(r, n) for r, n in zip(batch.column(at).to_pylist(), names, strict=True)]
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            if failed is not None:
                columns.append(pa.array([None if known(n) else f"unknown charset {n}" for n in names], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    bound_batches(df.sparkSession)
    return df.mapInArrow(sparing(run), schema)


def encode_bytes(df: DataFrame, body: str, charset: str) -> DataFrame:
    """The other way: df with a text as bytes in the charset of its row; UTF-8 for charsets that are null or unknown, `?` for what they lack."""
    at, by = df.columns.index(body), df.columns.index(charset)
    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == body else f for f in df.schema.fields])

    def raw(text: str | None, name: str | None) -> bytes | None:
        if text is None:
            return None
        try:
            return text.encode(name or "utf-8", "replace")
        except LookupError:
            return text.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for b in batches for p in pieces(b)):
            found = [raw(t, n) for t, n in zip(batch.column(at).to_pylist(), batch.column(by).to_pylist(), strict=True)]
            columns = [pa.array(found, pa.binary()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    bound_batches(df.sparkSession)
    return df.mapInArrow(sparing(run), schema)


def searchable(content_type: Column) -> Column:
    """Content types whose name holds html, javascript, json, xml or css."""
    return F.coalesce(F.lower(content_type).rlike("|".join(C.CONTENT_TYPES)), F.lit(False))


def gated(responses: DataFrame, in_scope: Column | None = None) -> DataFrame:
    """Responses with an address, a body and a type worth searching, within the caller's scope."""
    fine = F.col("url").isNotNull() & F.coalesce(F.length("body") > 0, F.lit(False)) & searchable(F.col("content_type"))
    return responses.where(fine if in_scope is None else fine & F.coalesce(in_scope, F.lit(False)))


__all__ = ["CHARSETS", "RESPONSES", "as_responses", "decode_bytes", "encode_bytes", "gated", "read_pages", "searchable", "stream_pages"]
