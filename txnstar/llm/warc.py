"""Web archives: a PySpark data source for WARC files, and an archive of pages."""

from __future__ import annotations

import base64
import datetime as dt
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from txnstar.llm.frames import only, sized
from txnstar.sources.workdir import fresh_dir, materialise

SCHEMA = (
    "record_id string, record_type string, target_uri string, refers_to string,"
    " payload_digest string, payload_bytes bigint, payload binary"
)
# Columns that the headers of a record decide, and the header each one comes from.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "refers_to": "warc-refers-to",
    "payload_digest": "warc-payload-digest",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MIN_SHARED_BYTES = 1000
MAX_FILE_BYTES = 256 * 1024 * 1024
SPLIT_BYTES = 64 * 1024 * 1024
MANIFEST = "_records.json"
_BATCH_BYTES = 8 * 1024 * 1024
_HEAD = 4096


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store that ``uri`` names and the path in it, on the driver and in tasks alike."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


# ---- one record -------------------------------------------------------------------------


def _header_text(value: str) -> str:
    """A value that stays on its line: control characters in URL notation."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(row: dict, date: str) -> bytes:
    """A response or revisit record; a revisit has the HTTP head of its response alone."""
    payload = row["payload"] if row["payload"] is not None else b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['payload_bytes']}\r\n\r\n"
    ).encode()
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {row['record_id']}"]
    lines += [f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if row["target_uri"] is not None:
        lines.append(f"WARC-Target-URI: {_header_text(row['target_uri'])}")
    if row["refers_to"] is not None:
        lines += [f"WARC-Refers-To: {row['refers_to']}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response"]
    lines += [f"Content-Length: {len(http) + len(payload)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + http + payload + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    """``data`` as one gzip member that states its own length, so that readers can pass it.

    The extra field ``SL`` holds the bytes from the end of the member's header to its end, and
    those of ``data``.
    """
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    body += struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    extra = b"SL" + struct.pack("<HQQ", 16, len(body), len(data))
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body


def parse_headers(block: bytes) -> dict[str, str]:
    """Lower-case names to values; a line that starts with a blank continues the last one."""
    out: dict[str, str] = {}
    name = None
    for line in block.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if colon:
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _hex_digest(value: str | None) -> str | None:
    """``sha1:BASE32`` as bare hex; any other digest as it is written."""
    if value is None or not value.lower().startswith("sha1:"):
        return value
    code = value[5:]
    if len(code) == 40:
        return code.lower()
    try:
        return base64.b32decode(code.upper()).hex()
    except ValueError:
        return value


def columns_of(headers: dict[str, str]) -> dict[str, str | None]:
    row = {name: headers.get(header) for name, header in HEADERS.items()}
    row["payload_digest"] = _hex_digest(row["payload_digest"])
    return row


# ---- reading ----------------------------------------------------------------------------


class _Bytes:
    """Bytes of one record as they are asked for, from a file that is plain or compressed."""

    def __init__(self, file: pa.NativeFile, packed: bool):
        self.file, self.packed = file, packed
        self.buffer, self.unpacker = b"", None
        self.member_end: int | None = None

    def _more(self) -> bool:
        """Get some more of the uncompressed bytes; false at the end of the file."""
        if not self.packed:
            data = self.file.read(1 << 16)
            self.buffer += data
            return bool(data)
        if self.unpacker is None and not self._open_member():
            return False
        data = self.unpacker.unconsumed_tail or self.file.read(_HEAD)
        self.buffer += self.unpacker.decompress(data, 1 << 16)
        if self.unpacker.eof:
            self.file.seek(self.file.tell() - len(self.unpacker.unused_data))
            self.unpacker, self.member_end = None, None
            return True
        if not data:
            raise ValueError("a compressed record is cut off")
        return True

    def _open_member(self) -> bool:
        start = self.file.tell()
        head = self.file.read(12)
        if not head:
            return False
        self.member_end = None
        if head[3] & 4 and len(head) == 12:
            extra = self.file.read(struct.unpack("<H", head[10:])[0])
            if extra[:2] == b"SL" and not head[3] & ~4:
                self.member_end = self.file.tell() + struct.unpack("<Q", extra[4:12])[0]
        self.file.seek(start)
        self.unpacker = zlib.decompressobj(31)
        return True

    def until(self, end: bytes, most: int | None = None) -> bytes | None:
        """What comes before ``end``, which is taken too.

        None at the end of the file, or if the next ``most`` bytes do not hold it; then nothing
        is taken.
        """
        at = self.buffer.find(end)
        while at < 0:
            if most is not None and len(self.buffer) >= most:
                return None
            before = max(0, len(self.buffer) - len(end))
            if not self._more():
                return None
            at = self.buffer.find(end, before)
        if most is not None and at + len(end) > most:
            return None
        out, self.buffer = self.buffer[:at], self.buffer[at + len(end) :]
        return out

    def take(self, n: int) -> bytes:
        parts, got = [self.buffer], len(self.buffer)
        self.buffer = b""
        while got < n:
            if not self._more():
                raise ValueError("a record is cut off")
            parts.append(self.buffer)
            got += len(self.buffer)
            self.buffer = b""
        data = b"".join(parts)
        self.buffer = data[n:]
        return data[:n]

    def skip(self, n: int) -> None:
        """Pass ``n`` bytes and the end of the record, without decoding where that can be."""
        if self.member_end is not None:
            self.file.seek(self.member_end)
            self.buffer, self.unpacker, self.member_end = b"", None, None
            return
        if not self.packed and n > len(self.buffer):
            self.file.seek(self.file.tell() + n - len(self.buffer))
            self.buffer = b""
            return
        while n > len(self.buffer):
            n -= len(self.buffer)
            self.buffer = b""
            if not self._more():
                raise ValueError("a record is cut off")
        self.buffer = self.buffer[n:]


@dataclass
class Test:
    """A predicate on one header column."""

    column: str
    kind: str
    value: object = None

    def holds(self, row: dict) -> bool:
        found = row[self.column]
        if self.kind == "null":
            return found is None
        if found is None:
            return False
        if self.kind == "prefix":
            return found.startswith(self.value)
        return self.kind == "not null" or found in self.value


def as_test(condition: Filter) -> Test | None:
    """``condition`` as a test of headers, if it is one."""
    name = getattr(condition, "attribute", ())
    if len(name) != 1 or name[0] not in HEADERS:
        return None
    if isinstance(condition, EqualTo):
        return Test(name[0], "in", (condition.value,))
    if isinstance(condition, In):
        return Test(name[0], "in", tuple(condition.value))
    if isinstance(condition, StringStartsWith):
        return Test(name[0], "prefix", condition.value)
    if isinstance(condition, IsNotNull):
        return Test(name[0], "not null")
    if isinstance(condition, IsNull):
        return Test(name[0], "null")
    return None


def read_records(
    file: pa.NativeFile, packed: bool, tests: list[Test], columns: list[str]
) -> Iterator[dict]:
    """Rows of the records that pass ``tests``; bodies are decoded only if ``columns`` ask."""
    want_payload, want_size = "payload" in columns, "payload_bytes" in columns
    data = _Bytes(file, packed)
    while (block := data.until(b"\r\n\r\n")) is not None:
        block = block.lstrip(b"\r\n")
        if not block:  # the two ends of line after a record
            continue
        headers = parse_headers(block)
        row = columns_of(headers)
        stated = headers.get("content-length", "0")
        if not stated.isdecimal():  # a broken record ends where the next one begins
            data.until(b"\r\nWARC/")
            continue
        left = int(stated)
        if not all(test.holds(row) for test in tests):
            data.skip(left)
            continue
        http = None
        is_http = headers.get("content-type", "").startswith("application/http")
        if is_http and (want_payload or want_size) and left:
            head = data.until(b"\r\n\r\n", left)
            if head is not None:  # else what follows is no HTTP message, and has no payload
                left -= len(head) + 4
                http = parse_headers(head)
        body = http is not None and row["record_type"] == "response"
        if want_size:
            stated = http.get("content-length") if http else None
            row["payload_bytes"] = left if body else int(stated) if stated else None
        if want_payload:
            row["payload"] = data.take(left) if body or not is_http else None
            left = 0 if row["payload"] is not None else left
        data.skip(left)
        yield {name: row[name] for name in columns}


@dataclass
class WarcFiles(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    """Files are packed into partitions of about ``split_bytes``; a file is read by one task."""

    def __init__(self, path: str, schema: StructType, split_bytes: int):
        self.path, self.schema, self.split_bytes = path, schema, split_bytes
        self.tests: list[Test] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for condition in filters:
            test = as_test(condition)
            if test is None:
                yield condition
            else:
                self.tests.append(test)

    def partitions(self) -> list[WarcFiles]:
        store, root = file_system(self.path)
        infos = store.get_file_info(fs.FileSelector(root, recursive=True))
        names = [(i.path, i.size) for i in infos if i.path.endswith((".warc", ".warc.gz"))]
        manifests = [i.path for i in infos if i.base_name.endswith(MANIFEST)]
        if manifests:  # written here: only what a committed job lists is part of the archive
            listed, folders = set(), set()
            for path in manifests:
                with store.open_input_file(path) as file:
                    folder = path.rsplit("/", 1)[0]
                    folders.add(folder)
                    listed |= {f"{folder}/{n}" for n in json.loads(file.read())}
            # Other folders may hold archives that others wrote.
            names = [(p, s) for p, s in names if p in listed or p.rsplit("/", 1)[0] not in folders]
        parts: list[WarcFiles] = []
        room = 0
        for path, size in sorted(names):
            if not parts or size > room:
                parts.append(WarcFiles([]))
                room = self.split_bytes
            parts[-1].paths.append(path)
            room -= size
        return parts or [WarcFiles([])]

    def read(self, partition: WarcFiles) -> Iterator[pa.RecordBatch]:
        store, _ = file_system(self.path)
        kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        fields = {f.name: kinds.get(f.name, pa.string()) for f in self.schema}
        schema = pa.schema(list(fields.items()))
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for row in read_records(file, path.endswith(".gz"), self.tests, list(fields)):
                    rows.append(row)
                    held += 200 + len(row.get("payload") or b"")
                    if held > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema)


# ---- writing ----------------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Each task writes files of its own; the committed job's files are listed beside them."""

    def __init__(self, path: str, max_file_bytes: int, level: int, date: str):
        self.path, self.max_file_bytes, self.level, self.date = path, max_file_bytes, level, date

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if out is None or size >= self.max_file_bytes:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        place = f"{root}/{names[-1]}"
                        out, size = store.open_output_stream(place, compression=None), 0
                    member = gzip_member(record_bytes(row, self.date), self.level)
                    out.write(member)
                    size += len(member)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        names = [name for m in messages if m is not None for name in m.names]
        with store.open_output_stream(f"{root}/{uuid.uuid4().hex}{MANIFEST}") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, root = file_system(self.path)
        for name in [name for m in messages if m is not None for name in m.names]:
            store.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)`` and ``df.write.format("warc").save(path)``.

    Reading: give ``.schema()`` without ``payload`` to leave bodies undecoded. Filters on header
    columns (equality, ``isin``, prefix, NULL tests) are applied to a record's headers before
    anything else of it is decoded. Plain and compressed files can be read; a body that is not
    wanted is passed by a seek, in compressed files where records state their length, as those
    written here do. Option ``split_bytes``: compressed bytes of a partition.

    Writing takes the columns of ``SCHEMA`` and appends; a revisit has a NULL payload. Options
    ``max_file_bytes``, ``level`` (of compression) and ``date``.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        split = int(self.options.get("split_bytes", SPLIT_BYTES))
        return WarcReader(self.options["path"], schema, split)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are appended to; name a new folder instead of overwriting")
        date = self.options.get("date") or f"{dt.datetime.now(dt.UTC):%Y-%m-%dT%H:%M:%SZ}"
        most = int(self.options.get("max_file_bytes", MAX_FILE_BYTES))
        return WarcWriter(self.options["path"], most, int(self.options.get("level", 6)), date)


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known, with filters pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


# ---- an archive of pages ----------------------------------------------------------------


def _record_id(page: Column) -> Column:
    return F.format_string("<urn:page:%s>", page.cast("string"))


def _page_of(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")


def page_records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_SHARED_BYTES,
) -> DataFrame:
    """A record for each row of ``pages``, in the columns of ``SCHEMA``.

    Of records with equal payloads of at least ``min_bytes``, that with the greatest id is the
    response (rows that repeat it too), and the others revisit it. NULL html is empty. A row
    without an id has the record id ``<urn:page:null>``; a group without ids has responses
    only. Only payloads that repeat are matched across rows, by digest.
    """
    rows = only(pages, page=id_col, url=url_col, html=html_col).select(
        F.col("page").cast("bigint").alias("page"),
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    )
    size = F.octet_length("payload").cast("bigint")
    rows = rows.withColumns({"digest": F.sha1("payload"), "bytes": size})
    shared = (
        rows.filter(F.col("bytes") >= min_bytes)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.max("page").alias("_first"), F.count("*").alias("_n"))
        .filter("_n > 1 AND _first IS NOT NULL")
        .select("_digest", "_first")
    )
    shared = sized(materialise(shared, "shared"), 64)
    match = (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= min_bytes)
    joined = rows.join(shared, match, "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page").eqNullSafe(F.col("_first"))
    return joined.select(
        F.coalesce(_record_id(F.col("page")), F.lit("<urn:page:null>")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.when(revisit, _record_id(F.col("_first"))).alias("refers_to"),
        F.col("digest").alias("payload_digest"),
        F.col("bytes").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def write_archive(pages: DataFrame, path: str, **columns: str) -> None:
    register(pages.sparkSession)
    page_records(pages, **columns).write.format("warc").mode("append").save(path)


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    reader = spark.read.format("warc")
    if not payload:
        reader = reader.schema(SCHEMA.removesuffix(", payload binary"))
    return reader.load(path)


def archive_report(pages: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` as the archive says.

    The pages are archived in a new folder and read back: responses with their payloads, which
    are measured and digested anew; revisits by their headers alone.
    """
    spark = pages.sparkSession
    path = fresh_dir(spark, "warc")
    write_archive(pages, path)
    full = read_archive(spark, path).filter("record_type = 'response'")
    heads = read_archive(spark, path, payload=False).filter("record_type = 'revisit'")
    shape = lambda df, size, digest: df.select(
        _page_of(F.col("record_id")).alias("page_id"),
        size.alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        _page_of(F.col("refers_to")).alias("refers_to"),
    )
    measured = shape(full, F.octet_length("payload").cast("bigint"), F.sha1("payload"))
    return measured.union(shape(heads, F.col("payload_bytes"), F.col("payload_digest")))


ORACLE = """
    WITH p AS (
        SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (
        SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest
        FROM p),
    g AS (
        SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS latest FROM d)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 1000 AND page_id <> latest
            THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 1000 AND page_id <> latest THEN latest END AS refers_to
    FROM g"""
