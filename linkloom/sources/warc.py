"""Archives of responses: WARC files as a source, a stream and a sink.

    spark.dataSource.register(Archives)
    spark.read.format("warc").load("archives/")            # also spark.readStream
    df.write.format("warc").mode("append").save("archives/")

A row is a record: its place, its WARC fields, and of an HTTP response its status, headers, body as bytes and charset.

Each task writes archives of its own, a gzip member a record, with an index of offsets beside each. What was written counts
once a manifest names it, and that is written last, by the driver; so a reader sees whole writes only, and what an
attempt that was cut short has left behind is never read. A folder without manifests is read as it is: all *.warc and *.warc.gz files.

An archive with an index is read in byte ranges, which begin and end with records; others whole, by one task each. A stream's offset is the
name of the last manifest (or archive, in a folder without manifests): names must rise as they come, which those of manifests do.

Folders are where pyarrow's file systems reach: local, HDFS, S3 (also as s3a), Google's and Azure's stores.

Cases: a record that can't be parsed ends its archive with an error, which `mode` "DROPMALFORMED" turns into a row with only its
place and `error`. Bodies of unknown coding stay as they are. Fields that hold line ends are written with spaces instead.
"""

from __future__ import annotations

import bisect
import json
import re
import time
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from linkloom.workers import bound_batches, give_back, pieces

SCHEMA = (
    "archive string, offset long, length long, record_type string, record_id string, url string, date string, fields map<string,string>, "
    "status int, headers map<string,string>, charset string, body binary, error string"
)
_TEXTS = pa.map_(pa.string(), pa.string())
_ARROW = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()),
    ("fields", _TEXTS), ("status", pa.int32()), ("headers", _TEXTS), ("charset", pa.string()), ("body", pa.binary()), ("error", pa.string()),
])
#: Bytes of a range, of a batch of bodies, of one read, of an archive before the next one begins.
RANGE, BATCH, PIECE, ARCHIVE = 64 << 20, 4 << 20, 1 << 20, 1 << 30
MANIFESTS, END = "_manifests", b"\r\n\r\n"
_LINE_ENDS = re.compile(r"[\r\n]+")
_CHARSET = re.compile(r"""charset\s*=\s*["']?([^\s"';,]+)""", re.I)


def located(path: str) -> tuple[files.FileSystem, str]:
    """The file system of a path or address, and the path there."""
    address = re.sub(r"^file:/+", "file:///", path).replace("s3a://", "s3://", 1)
    return files.FileSystem.from_uri(address) if "://" in address else (files.LocalFileSystem(), address)


def listed(fs: files.FileSystem, folder: str) -> list[files.FileInfo]:
    return sorted((f for f in fs.get_file_info(files.FileSelector(folder, allow_not_found=True)) if f.is_file), key=lambda f: f.base_name)


# records


def lines(fields: list[tuple[str, str]]) -> bytes:
    return "".join(f"{k}: {_LINE_ENDS.sub(' ', v)}\r\n" for k, v in fields if v is not None).encode()


def record(record_type: str, block: bytes, fields: list[tuple[str, str | None]]) -> bytes:
    """A record; fields come after the type, before the length."""
    return b"WARC/1.1\r\n" + lines([("WARC-Type", record_type), *fields, ("Content-Length", str(len(block)))]) + b"\r\n" + block + END


def response_block(status: int, headers: list[tuple[str, str]], body: bytes) -> bytes:
    return f"HTTP/1.1 {status} -\r\n".encode() + lines(headers) + b"\r\n" + body


def _parsed_lines(head: bytes) -> dict[str, str]:
    """Lower-cased names and values; of equal names the first counts, a line that begins with a space goes on with the one before."""
    found: dict[str, str] = {}
    name = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            found[name] += " " + line.strip()
        elif ":" in line:
            key, value = line.split(":", 1)
            name = key.strip().lower()
            if name in found:
                name = None
            else:
                found[name] = value.strip()
    return found


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def http_parts(block: bytes) -> tuple[int | None, dict[str, str], bytes]:
    """Status, headers and body of an HTTP response, without its codings."""
    head, _, body = block.partition(END)
    first = head.split(b"\r\n", 1)[0].split(b" ")
    status = int(first[1]) if len(first) > 1 and first[1].isdigit() and len(first[1]) < 9 else None
    headers = _parsed_lines(head)
    try:
        if headers.get("transfer-encoding", "").lower() == "chunked":
            body = _unchunked(body)
        coding = headers.get("content-encoding", "").lower()
        if coding in ("gzip", "x-gzip", "deflate") and body:
            body = zlib.decompress(body, 47 if coding != "deflate" or body[:1] == b"\x78" else -15)
    except (ValueError, zlib.error):
        pass
    return status, headers, body


class _Source:
    """A file from one place to another, read piece by piece."""

    def __init__(self, file: pa.NativeFile, start: int, end: int):
        file.seek(start)
        self.file, self.left, self.held, self.at = file, end - start, b"", start

    def more(self) -> bool:
        piece = self.file.read(min(PIECE, self.left)) if self.left else b""
        self.held += piece
        self.left -= len(piece)
        return bool(piece)

    def take(self, n: int) -> bytes:
        parts, got = [], 0
        while got < n and (self.held or self.more()):
            part = self.held[: n - got]
            parts.append(part)
            self.held, got = self.held[len(part) :], got + len(part)
        self.at += got
        return b"".join(parts)

    def until(self, mark: bytes) -> bytes:
        """Up to the end of the first mark; what is left if there is none."""
        looked = 0
        while (found := self.held.find(mark, looked)) < 0:
            looked = max(0, len(self.held) - len(mark))
            if not self.more():
                return self.take(len(self.held))
        return self.take(found + len(mark))

    def member(self) -> bytes:
        """The content of the next gzip member."""
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            if not self.held and not self.more():
                raise ValueError("a gzip member has no end")
            piece, self.held = self.held, b""
            parts.append(z.decompress(piece))
            self.held = z.unused_data
            self.at += len(piece) - len(self.held)
        return b"".join(parts)


def _split(head: bytes) -> tuple[dict[str, str], int]:
    if not head.startswith(b"WARC/"):
        raise ValueError("no record begins here")
    fields = _parsed_lines(head)
    return fields, int(fields["content-length"])


def records(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of the records of a range."""
    source = _Source(file, start, end)
    while source.held or source.more():
        at = source.at
        if source.held[:1] == b"\x1f":
            whole, inner = source.member(), 0
            while inner < len(whole):
                split = whole.index(END, inner) + 4
                fields, n = _split(whole[inner:split])
                if len(whole) < split + n:
                    raise ValueError("a record is cut short")
                yield at, source.at - at, fields, whole[split : split + n]
                inner = split + n + len(END)
        elif source.held[:1] in (b"\r", b"\n"):
            source.take(1)
        else:
            fields, n = _split(source.until(END))
            block = source.take(n)
            if len(block) < n:
                raise ValueError("a record is cut short")
            source.take(len(END))
            yield at, source.at - at, fields, block


def _row(archive: str, offset: int, length: int, fields: dict[str, str], block: bytes) -> dict:
    row = dict.fromkeys(_ARROW.names) | {"archive": archive, "offset": offset, "length": length, "record_type": fields.get("warc-type"), "record_id": fields.get("warc-record-id"), "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "fields": list(fields.items())}
    if not block.startswith(b"HTTP/"):
        return row | {"body": block}
    status, headers, body = http_parts(block)
    charset = _CHARSET.search(headers.get("content-type", ""))
    return row | {"status": status, "headers": list(headers.items()), "body": body, "charset": charset and charset[1].lower()}


# source


@dataclass
class Range(InputPartition):
    archive: str
    start: int
    end: int
    indexed: bool


def _offsets(file: pa.NativeFile) -> array:
    """What an index holds, read piece by piece: 8 bytes for each record."""
    found, rest = array("q"), b""
    while piece := file.read(PIECE):
        *whole, rest = (rest + piece).split(b" ")
        found.extend(map(int, whole))
    found.extend(map(int, rest.split()))
    return found


class _Folder:
    """What is in a folder, by the names of its manifests, or its archives if it has none."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.most = int(options.get("rangeBytes", RANGE))
        self.strict = options.get("mode", "FAILFAST").upper() != "DROPMALFORMED"

    def parts(self, after: str = "", last: str | None = None) -> list[tuple[str, list[tuple[str, int, bool]]]]:
        """(name, [(archive, bytes, whether it has an index)])"""
        fs, root = located(self.path)
        wanted = lambda name: name > after and (last is None or name <= last)
        if fs.get_file_info(root).is_file:
            return [(root.rsplit("/", 1)[-1], [("", fs.get_file_info(root).size, False)])]
        manifests = [f for f in listed(fs, f"{root}/{MANIFESTS}") if f.base_name.endswith(".json")]
        if manifests:
            found = []
            for f in manifests:
                if wanted(f.base_name):
                    with fs.open_input_stream(f.path) as file:
                        found.append((f.base_name, [(a["archive"], a["bytes"], True) for a in json.loads(file.read())]))
            return found
        inside = listed(fs, root)
        names = {f.base_name for f in inside}
        return [(f.base_name, [(f.base_name, f.size, f"{f.base_name}.idx" in names)]) for f in inside if re.search(r"\.warc(\.gz)?$", f.base_name) and wanted(f.base_name)]

    def ranges(self, after: str = "", last: str | None = None) -> list[Range]:
        found = []
        for _, archives in self.parts(after, last):
            for archive, size, indexed in archives:
                step = self.most if indexed else max(size, 1)
                found += [Range(archive, at, min(at + step, size), indexed) for at in range(0, size, step)]
        return found

    def batches(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # what Spark reads where there are no partitions
            return
        try:
            yield from self._batches(part)
        finally:
            give_back()

    def _batches(self, part: Range) -> Iterator[pa.RecordBatch]:
        fs, root = located(self.path)
        path = f"{root}/{part.archive}" if part.archive else root
        start, end = part.start, part.end
        if part.indexed:
            with fs.open_input_stream(f"{path}.idx") as file:
                offsets = _offsets(file)  # and the end of the last record
            first = bisect.bisect_left(offsets, start)
            start, end = offsets[first] if first < len(offsets) else offsets[-1], offsets[min(bisect.bisect_left(offsets, end), len(offsets) - 1)]
        rows, size, at = [], 0, start
        with fs.open_input_file(path) as file:
            try:
                for offset, length, fields, block in records(file, start, end):
                    rows.append(_row(part.archive, offset, length, fields, block))
                    size, at = size + max(len(block), len(rows[-1]["body"])), offset + length
                    if size > BATCH or len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, size = [], 0
            except (ValueError, KeyError, zlib.error) as e:
                if self.strict:
                    raise ValueError(f"{path}, after byte {at}: {e}") from e
                rows.append(dict.fromkeys(_ARROW.names) | {"archive": part.archive, "offset": at, "error": str(e)})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)


class _Reader(DataSourceReader):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def partitions(self) -> list[InputPartition]:
        return self.folder.ranges()

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from self.folder.batches(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, folder: _Folder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        return {"after": max((name for name, _ in self.folder.parts()), default="")}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.folder.ranges(start["after"], end["after"])

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        yield from self.folder.batches(partition)


# sink


@dataclass
class _Written(WriterCommitMessage):
    archives: list[dict]


class _Writer(DataSourceArrowWriter):
    """Rows: url, date, record_type, and if there are such columns record_id, fields, status, headers, body."""

    def __init__(self, path: str, most: int, level: int, overwrite: bool):
        self.path, self.most, self.level, self.overwrite = path, most, level, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        try:
            return self._write(iterator)
        finally:
            give_back()

    def _write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, root = located(self.path)
        fs.create_dir(root, recursive=True)
        done: list[dict] = []
        file, name, offsets, at = None, "", array("q"), 0

        def closed() -> None:
            file.close()
            with fs.open_output_stream(f"{root}/{name}.idx") as index:
                index.write(" ".join(map(str, [*offsets, at])).encode())
            done.append({"archive": name, "bytes": at, "records": len(offsets)})

        for batch in (p for b in iterator for p in pieces(b)):
            for row in batch.to_pylist():
                if file is not None and at >= self.most:
                    closed()
                    file = None
                if file is None:
                    name, offsets, at = f"{uuid.uuid4().hex}.warc.gz", array("q"), 0
                    file = fs.open_output_stream(f"{root}/{name}", compression=None)
                z = zlib.compressobj(self.level, zlib.DEFLATED, 31)
                member = z.compress(self.made(row)) + z.flush()
                file.write(member)
                offsets.append(at)
                at += len(member)
        if file is not None:
            closed()
        return _Written(done)

    @staticmethod
    def made(row: dict) -> bytes:
        kind, url = row.get("record_type") or "response", row.get("url")
        fields = [("WARC-Record-ID", row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", row.get("date")), ("WARC-Target-URI", url and re.sub(r"\s", lambda m: "%%%02X" % ord(m[0]), url))]
        fields += [(k, v) for k, v in (row.get("fields") or []) if v is not None]
        block = row.get("body") or b""
        if row.get("status") is not None:
            block = response_block(row["status"], row.get("headers") or [], block)
            fields.append(("Content-Type", "application/http; msgtype=response"))
        return record(kind, block, fields)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, root = located(self.path)
        archives = [a for m in messages if m for a in m.archives]
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}.json"
        old = listed(fs, f"{root}/{MANIFESTS}") if self.overwrite else []
        fs.create_dir(f"{root}/{MANIFESTS}", recursive=True)
        with fs.open_output_stream(f"{root}/{MANIFESTS}/.{name}") as file:
            file.write(json.dumps(archives).encode())
        fs.move(f"{root}/{MANIFESTS}/.{name}", f"{root}/{MANIFESTS}/{name}")
        for f in old:
            fs.delete_file(f.path)

    def abort(self, messages: list[_Written | None]) -> None:
        fs, root = located(self.path)
        for archive in (a for m in messages if m for a in m.archives):
            for path in (f"{root}/{archive['archive']}", f"{root}/{archive['archive']}.idx"):
                fs.delete_file(path)


class Archives(DataSource):
    """Options: path; rangeBytes (of a range of an indexed archive); mode; archiveBytes and level (writing)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(_Folder(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(_Folder(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options["path"].rstrip("/"), int(self.options.get("archiveBytes", ARCHIVE)), int(self.options.get("level", 6)), overwrite)


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(Archives)
    return spark.read.format("warc").options(**options).load(path)


def stream_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(Archives)
    return spark.readStream.format("warc").options(**options).load(path)


def write_archives(df: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    df.sparkSession.dataSource.register(Archives)
    bound_batches(df.sparkSession)
    df.write.format("warc").mode(mode).options(**options).save(path)


def as_archived(responses: DataFrame, charset: str = "utf-8") -> DataFrame:
    """Responses (with a binary body) as records, which archived_responses() reads back. Their page_id and session are fields of the record."""
    headers = F.map_filter(F.create_map(F.lit("Content-Type"), F.col("content_type"), F.lit("SourceMap"), F.col("source_map"), F.lit("X-SourceMap"), F.col("x_source_map")), lambda _, v: v.isNotNull())
    fields = F.map_filter(F.create_map(F.lit("X-Page-ID"), F.col("page_id").cast("string"), F.lit("X-Session-ID"), F.col("session_id").cast("string")), lambda _, v: v.isNotNull())
    return responses.select("url", F.lit("response").alias("record_type"), F.lit(200).alias("status"), fields.alias("fields"), headers.alias("headers"), "body")


def archived_responses(records: DataFrame) -> DataFrame:
    """Records of responses as rows of a page table with binary bodies: session_id, page_id, url, content_type, source_map,
    x_source_map, body, charset, status. A record without an X-Page-ID gets one from its place."""
    own = records.where("record_type = 'response' and error is null")
    number = lambda name: F.expr(f"try_cast(fields['{name}'] as long)")
    place = F.xxhash64("archive", "offset")
    head = lambda name: F.col("headers")[name]
    return own.select(F.coalesce(number("x-session-id"), F.lit(0)).alias("session_id"), F.coalesce(number("x-page-id"), place).alias("page_id"), "url", head("content-type").alias("content_type"), head("sourcemap").alias("source_map"), head("x-sourcemap").alias("x_source_map"), "body", "charset", "status")
