"""WARC archives as a data source: planned by file, filtered by header.

``write_warc`` and ``read_warc`` use the source ``warc``. Files hold one gzip
member per record, each with the skip lengths of the WARC standard (annex on
compression) in its header, so a reader can go from record to record. It inflates
a record's headers first, tests the pushed-down predicates on them, and inflates
the rest only if the record is wanted with its payload. Members without skip
lengths and plain ``.warc`` files are read as well.

Paths are opened through ``pyarrow.fs``, on the executors too. A task writes files
of its own name; the manifest, written at commit, lists the files that count, so
leftovers of lost tasks are never read.
"""

from __future__ import annotations

import base64
import json
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql import types as T

from studylake.llm.shipping import ship
from studylake.session import materialize

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, "
    "payload_digest string, payload_bytes bigint, refers_to string, payload binary"
)
MANIFEST = "manifest.json"
_ROLL = 32 << 20
_SPLIT = 64 << 20
_BATCH = 4 << 20
#: Payloads below this are never revisits.
MIN_REVISIT = 1000

_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI",
    "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
_LENGTH = "WARC-Payload-Length"  # an extension field: bytes of the payload, also for revisits
_MEMBER = struct.Struct("<4sIBBH2sHII")  # a gzip header with one extra field, "sl"


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", " ").replace("\n", " ")


def encode_record(row: dict) -> bytes:
    """One record as bytes; a NULL field has no header, a revisit no payload."""
    payload = row["payload"] or b""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if row["record_type"] == "revisit" else http + payload
    fields = {name: row[column] for column, name in _HEADERS.items()}
    for name in ("WARC-Record-ID", "WARC-Refers-To"):
        fields[name] = fields[name] and f"<{fields[name]}>"
    if fields["WARC-Payload-Digest"]:
        packed = base64.b32encode(bytes.fromhex(fields["WARC-Payload-Digest"])).decode()
        fields["WARC-Payload-Digest"] = f"sha1:{packed}"
    if row["record_type"] == "revisit":
        fields["WARC-Profile"] = _PROFILE
    fields[_LENGTH] = None if row["payload_bytes"] is None else str(row["payload_bytes"])
    fields["Content-Type"] = "application/http; msgtype=response"
    fields["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in fields.items() if v is not None)
    return b"".join([_VERSION, lines.encode(), b"\r\n", block, b"\r\n\r\n"])


def compress_record(record: bytes) -> bytes:
    """A gzip member with skip lengths."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = _MEMBER.size + len(body) + 8
    head = _MEMBER.pack(b"\x1f\x8b\x08\x04", 0, 0, 255, 12, b"sl", 8, size, len(record) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def parse_headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def _fields(headers: dict[str, str]) -> dict:
    out = {column: headers.get(name.lower()) for column, name in _HEADERS.items()}
    for column in ("record_id", "refers_to"):
        out[column] = out[column] and out[column].strip("<>")
    digest = out["payload_digest"]
    if digest and digest.lower().startswith("sha1:"):
        value = digest[5:]
        out["payload_digest"] = value.lower() if len(value) == 40 else \
            base64.b32decode(value.upper()).hex()
    length = headers.get(_LENGTH.lower())
    out["payload_bytes"] = int(length) if length and length.isdigit() else None
    return out


@dataclass
class _Wanted:
    """Predicates on header fields, and the record types whose payload is decoded."""

    tests: list
    payload_of: frozenset[str] | None

    def accepts(self, fields: dict) -> bool:
        return all(test(fields) for test in self.tests)

    def payload(self, fields: dict) -> bool:
        return self.payload_of is None or fields["record_type"] in self.payload_of


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


class _Inflater:
    """The bytes of one gzip member, inflated as far as asked for."""

    def __init__(self, file, start: int, offset: int, bits: int):
        self.file, self.data = file, b""
        file.seek(start + offset)
        self.unpacker = zlib.decompressobj(bits)

    def until(self, done) -> bytes:
        while not done(self.data) and not self.unpacker.eof:
            packed = self.unpacker.unconsumed_tail or self.file.read(1 << 16)
            if not packed:
                self.data += self.unpacker.flush()
                break
            self.data += self.unpacker.decompress(packed, 1 << 18)
        return self.data

    def end(self) -> int:
        """The place after the member; inflates the rest."""
        while not self.unpacker.eof:
            packed = self.unpacker.unconsumed_tail or self.file.read(1 << 16)
            if not packed:
                break
            self.unpacker.decompress(packed, 1 << 18)
        return self.file.tell() - len(self.unpacker.unused_data)


def _headed(data: bytes) -> bool:
    return b"\r\n\r\n" in data


def read_gzip(file, size: int, wanted: _Wanted) -> Iterator[tuple[dict, bytes | None]]:
    """(fields, payload or None) of the wanted records of a file of gzip members."""
    at = 0
    while at < size:
        file.seek(at)
        head = file.read(_MEMBER.size)
        skips = len(head) == _MEMBER.size and head[3] == 4 and head[12:14] == b"sl"
        member = _Inflater(file, at, _MEMBER.size if skips else 0, -15 if skips else 31)
        start, _, _ = member.until(_headed).partition(b"\r\n\r\n")
        headers = parse_headers(start)
        fields = _fields(headers)
        if wanted.accepts(fields):
            if wanted.payload(fields):
                total = len(start) + 4 + int(headers.get("content-length", 0))
                data = member.until(lambda d, n=total: len(d) >= n)
                yield fields, _payload(headers, data[len(start) + 4:total])
            else:
                yield fields, None
        at = at + _MEMBER.unpack(head)[7] if skips else member.end()


def read_plain(file, size: int, wanted: _Wanted) -> Iterator[tuple[dict, bytes | None]]:
    """(fields, payload or None) of the wanted records of an uncompressed file."""
    at = 0
    while at < size:
        file.seek(at)
        data = b""
        while not _headed(data) and (more := file.read(1 << 12)):
            data += more
        start, mark, _ = data.partition(b"\r\n\r\n")
        if not mark:
            return
        headers = parse_headers(start)
        fields = _fields(headers)
        body, length = at + len(start) + 4, int(headers.get("content-length", 0))
        if wanted.accepts(fields):
            if wanted.payload(fields):
                file.seek(body)
                yield fields, _payload(headers, file.read(length))
            else:
                yield fields, None
        at = body + length + 4


def _test(found: ds.Filter):
    """A test on header fields, or None if the filter is not one."""
    name = found.attribute[0] if len(getattr(found, "attribute", ())) == 1 else None
    if name not in _HEADERS:
        return None
    if isinstance(found, ds.EqualTo):
        return lambda fields: fields[name] == found.value
    if isinstance(found, ds.In):
        values = set(found.value)
        return lambda fields: fields[name] in values
    if isinstance(found, ds.StringStartsWith):
        return lambda fields: (fields[name] or "").startswith(found.value)
    if isinstance(found, ds.IsNotNull):
        return lambda fields: fields[name] is not None
    return None


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.path = options["path"]
        self.split = int(options.get("split_bytes", _SPLIT))
        decoded = options.get("payload", "all")
        self.payload_of = None if decoded == "all" else frozenset(decoded.split(",")) - {"none"}
        self.filters: list = []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for found in filters:
            if _test(found) is None:
                yield found
            else:
                self.filters.append(found)

    def partitions(self) -> Sequence[ds.InputPartition]:
        """Whole files, together up to ``split_bytes``."""
        system, base = _opened(self.path)
        listed = system.get_file_info(fs.FileSelector(base))
        counted = next((f for f in listed if f.base_name == MANIFEST), None)
        if counted:
            with system.open_input_stream(counted.path) as file:
                names = set(json.loads(file.read()))
            listed = [f for f in listed if f.base_name in names]
        files = sorted((f.path, f.size) for f in listed
                       if f.base_name.endswith((".warc", ".warc.gz")))
        groups: list[list[tuple[str, int]]] = []
        room = 0
        for path, size in files:
            if not groups or size > room:
                groups.append([])
                room = self.split
            groups[-1].append((path, size))
            room -= size
        return [ds.InputPartition(g) for g in groups] or [ds.InputPartition([])]

    def read(self, partition: ds.InputPartition) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.path)
        wanted = _Wanted([_test(f) for f in self.filters], self.payload_of)
        kinds = _arrow_schema()
        rows, held = [], 0
        for path, size in partition.value:
            with system.open_input_file(path) as file:
                read = read_gzip if path.endswith(".gz") else read_plain
                for fields, payload in read(file, size, wanted):
                    rows.append(fields | {"payload": payload})
                    held += 500 + len(payload or b"")
                    if held >= _BATCH:
                        yield pa.RecordBatch.from_pylist(rows, kinds)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)


def _arrow_schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in SCHEMA.split(", "))])


@dataclass
class _Written(ds.WriterCommitMessage):
    names: list[str]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.packed = options.get("compression", "gzip") == "gzip"
        self.roll = int(options.get("roll_bytes", _ROLL))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, base = _opened(self.path)
        system.create_dir(base, recursive=True)
        names, file, size = [], None, 0
        try:
            for batch in iterator:
                for row in range(batch.num_rows):
                    record = encode_record(
                        {c: batch.column(c)[row].as_py() for c in batch.schema.names})
                    if self.packed:
                        record = compress_record(record)
                    if file is None:
                        names.append(f"{uuid.uuid4().hex}.warc{'.gz' if self.packed else ''}")
                        file, size = system.open_output_stream(
                            f"{base}/{names[-1]}", compression=None), 0
                    file.write(record)
                    size += len(record)
                    if size >= self.roll:
                        file.close()
                        file = None
        finally:
            if file is not None:
                file.close()
        return _Written(names)

    def commit(self, messages: list[_Written | None]) -> None:
        system, base = _opened(self.path)
        system.create_dir(base, recursive=True)
        names = sorted(n for m in messages if m for n in m.names)
        with system.open_output_stream(f"{base}/{MANIFEST}") as file:
            file.write(json.dumps(names).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        system, base = _opened(self.path)
        for name in (n for m in messages if m for n in m.names):
            system.delete_file(f"{base}/{name}")


class WarcSource(ds.DataSource):
    """The source ``warc``; see ``read_warc`` and ``write_warc`` for its options."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options)


def read_warc(
    spark: SparkSession, path: str, payload: str = "all", split_bytes: int = _SPLIT
) -> DataFrame:
    """The records under ``path``, one row each.

    ``payload`` names the record types whose payload is decoded, comma-separated,
    or is ``all`` or ``none``; other rows have a NULL payload. Filters on
    record_type, record_id, target_uri, date, payload_digest and refers_to
    (equality, IN, prefix, not NULL) are tested on the headers.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    ship(spark)
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", payload).option(
        "split_bytes", str(split_bytes)).load(path)


def write_warc(
    records: DataFrame, path: str, compression: str = "gzip", roll_bytes: int = _ROLL
) -> None:
    """Writes rows of ``SCHEMA`` as archives under ``path``, a folder of its own."""
    ship(records.sparkSession)
    records.sparkSession.dataSource.register(WarcSource)
    columns = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    records.select(columns).write.format("warc").mode("append").option(
        "compression", compression).option("roll_bytes", str(roll_bytes)).save(path)


def plan_records(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
    date: str = "1970-01-01T00:00:00Z", min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """Rows of ``SCHEMA`` for pages, equal payloads stored once.

    Of payloads that agree in digest and length and have at least ``min_revisit``
    bytes, those with the greatest key are responses and the others revisit it. A
    NULL html is an empty payload; a row without a key becomes a record named
    ``urn:page:null``, a response only if none of its copies has a key. Repeated rows of
    one key and payload are all written alike. Other columns are ignored.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "utf-8")
    found = pages.select(
        F.col(key).alias("key"), F.col(url).alias("target_uri"), payload.alias("payload"),
        F.sha1(payload).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"))
    same = ["payload_digest", "payload_bytes"]
    shared = materialize(
        found.filter(F.col("payload_bytes") >= min_revisit).groupBy(*same)
        .agg(F.max("key").alias("stored"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("n") > 1) & F.col("stored").isNotNull()).drop("n"))
    revisit = F.col("stored").isNotNull() & ~F.col("stored").eqNullSafe(F.col("key"))

    def name(column: str):
        return F.concat(F.lit("urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("null")))

    return found.join(shared, same, "left").select(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        name("key").alias("record_id"), "target_uri", F.lit(date).alias("date"), *same,
        F.when(revisit, name("stored")).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"))
