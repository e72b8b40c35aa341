"""Web archives (WARC 1.1) as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

Reading. The files are dealt to partitions by their sizes. Filters on record type, record id, url, digest and page number
are taken over by the source and tested on the headers of a record, which are parsed before anything else. The block
of a record that is filtered out, or whose payload nobody asked for (the ``payload`` column is not in the given schema),
is jumped over: by ``Content-Length`` in a plain file, and in a compressed one by the ``sl`` field that the standard
foresees in the gzip header of a record, so that it is not even inflated. A compressed record without that field is
inflated and thrown away.

Writing. A task writes files of bounded size under names of its own and reports them; the driver lists those of the
tasks that succeeded in ``_manifest``. What a lost or repeated task left behind is not in the list and never read.
A folder without a list (from elsewhere) is read as its ``.warc`` and ``.warc.gz`` files.

A record is a ``response`` with the payload behind an HTTP header, or a ``revisit`` whose HTTP header is all of its block and
which names the response by its record id. ``payload_bytes`` and ``payload_digest`` are those of the full payload in both.

Paths are local or of any file system that Arrow knows. NULL payload: empty. A NULL page number, url, record id or
reference is left out of the headers and comes back as NULL; line ends in a url are percent-encoded as HTTP requires. An empty
table gives archives without records. Columns the source does not know are ignored on writing.
"""

from __future__ import annotations

import base64
import binascii
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from io import SEEK_CUR, BufferedReader

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.types import StructType

from vitaspan.llm.common import by_value
from vitaspan.session import own_path

#: Columns of the source; a reader may ask for some of them.
SCHEMA = ("record_id string, record_type string, page_id long, url string, date string, payload_bytes long, payload_digest string, "
          "refers_to string, payload binary")
FILE_BYTES = 256 << 20
PARTITION_BYTES = 128 << 20
MANIFEST = "_manifest"
#: Payloads below this size are always kept whole.
MIN_REVISIT = 1000
#: Parts that rows of equal payloads are dealt to, so that many copies of one payload do not meet in one task.
SALTS = 16
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a local name or a URI; Hadoop's ``file:/x`` counts as local."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


# --- one record ------------------------------------------------------------------------------------

def record_head(fields: dict) -> tuple[bytes, bytes]:
    """WARC header and HTTP header of a record."""
    size, revisit = fields["payload_bytes"], fields["record_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {fields['record_type']}", f"WARC-Date: {fields.get('date') or DATE}"]
    for name, key in (("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to")):
        if fields.get(key) is not None:
            lines.append(f"{name}: <{fields[key]}>")
    if fields.get("url") is not None:
        lines.append("WARC-Target-URI: " + fields["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if fields.get("page_id") is not None:
        lines.append(f"X-Page-ID: {fields['page_id']}")
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += [f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(fields['payload_digest'])).decode()}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join([*lines, "", ""]).encode(), http


def gzip_member(head: bytes, payload: bytes, level: int = 1) -> bytes:
    """A record as a gzip member whose header names its compressed and plain size (the ``sl`` field)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(head) + deflate.compress(payload) + deflate.compress(b"\r\n\r\n") + deflate.flush()
    plain = len(head) + len(payload) + 4
    checksum = zlib.crc32(b"\r\n\r\n", zlib.crc32(payload, zlib.crc32(head)))
    # ten fixed bytes, the length of the extra fields (2), the field (4 + 8), the data, checksum and size (8)
    extra = b"sl" + struct.pack("<HII", 8, 24 + len(body) + 8, plain)
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body
            + struct.pack("<II", checksum, plain & 0xFFFFFFFF))


def parse_head(raw: bytes) -> dict[str, str]:
    """Header fields by their names in small letters."""
    out = {}
    for line in raw.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def hex_digest(value: str | None) -> str | None:
    """SHA-1 in hexadecimal letters from a digest field, which names it in base 32 or base 16."""
    if not value or not value.lower().startswith("sha1:"):
        return None
    text = value[5:]
    try:
        return bytes.fromhex(text).hex() if len(text) == 40 else base64.b32decode(text.upper()).hex()
    except (ValueError, binascii.Error):
        return None


# --- reading ---------------------------------------------------------------------------------------

class _Member:
    """The plain bytes of one gzip member, inflated as far as they are asked for."""

    def __init__(self, file: BufferedReader, skip: int | None):
        self.file, self.begin, self.skip = file, file.tell(), skip
        self.inflate, self.held = zlib.decompressobj(31), b""

    def more(self, n: int) -> bytes:
        """Up to ``n`` further plain bytes; none at the member's end."""
        while not self.inflate.eof:
            got = self.inflate.decompress(self.inflate.unconsumed_tail or self.file.read1(1 << 16), n)
            if got:
                return got
            if not self.inflate.unconsumed_tail and not self.inflate.eof and not self.file.peek(1):
                raise EOFError("the archive ends inside a record")
        return b""

    def leave(self) -> None:
        """Go to the next member."""
        if self.skip is not None:
            self.file.seek(self.begin + self.skip)
            return
        while self.more(1 << 20):
            pass
        self.file.seek(-len(self.inflate.unused_data), SEEK_CUR)


class _Plain:
    """The bytes of a record in a plain file."""

    def __init__(self, file: BufferedReader):
        self.file, self.next = file, None

    def more(self, n: int) -> bytes:
        return self.file.read1(n)

    def leave(self) -> None:
        self.file.seek(self.next)


def _skip_length(file: BufferedReader) -> int | None:
    """Compressed size of the gzip member that follows, if its header names it."""
    begin = file.tell()
    head = file.read(64)
    file.seek(begin)
    if len(head) < 12 or not head[3] & 4:
        return None
    end = 12 + struct.unpack_from("<H", head, 10)[0]
    at = 12
    while at + 4 <= min(end, len(head)):
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at:at + 2] == b"sl" and size == 8 and at + 12 <= len(head):
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + size
    return None


def _until(source, held: bytes, mark: bytes) -> tuple[bytes, bytes]:
    """Bytes up to the first ``mark``, and those behind it that were read as well."""
    while (at := held.find(mark)) < 0:
        got = source.more(1 << 12)
        if not got:
            raise EOFError("a header has no end")
        held += got
    return held[:at], held[at + len(mark):]


def records(file: BufferedReader, wanted, payload: bool) -> Iterator[dict]:
    """Records of an archive as columns; ``wanted`` judges one by its headers. Payloads come only if asked for."""
    while start := file.peek(1):
        if start[:1] in b"\r\n":
            file.read(1)
            continue
        packed = start[:1] == b"\x1f"
        source = _Member(file, _skip_length(file)) if packed else _Plain(file)
        begin = file.tell()
        raw, rest = _until(source, b"", b"\r\n\r\n")
        head = parse_head(raw)
        length = int(head.get("content-length", 0))
        if not packed:
            source.next = begin + len(raw) + 4 + length
        ident = {"record_id": "warc-record-id", "refers_to": "warc-refers-to"}
        page = head.get("x-page-id")
        out = {k: head[v].strip("<>") if v in head else None for k, v in ident.items()}
        out |= {"record_type": head.get("warc-type"), "page_id": int(page) if page else None, "url": head.get("warc-target-uri"),
                "date": head.get("warc-date"), "payload_digest": hex_digest(head.get("warc-payload-digest"))}
        if wanted(out):
            http_like = head.get("content-type", "").startswith("application/http")
            behind, size = 0, length
            if http_like and length:
                web, rest = _until(source, rest, b"\r\n\r\n")
                behind = len(web) + 4
                size = length - behind
                if out["record_type"] == "revisit":
                    size = int(parse_head(web).get("content-length", 0))
            out["payload_bytes"] = size
            if payload:
                parts, left = [rest[:length - behind]], length - behind - len(rest)
                while left > 0:
                    got = source.more(left)
                    if not got:
                        raise EOFError("a block is shorter than its header says")
                    parts.append(got)
                    left -= len(got)
                out["payload"] = None if out["record_type"] == "revisit" else b"".join(parts)
            yield out
        source.leave()


_TESTS = {EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
          LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b}
_IN_HEADER = {"record_id", "record_type", "page_id", "url", "date", "payload_digest", "refers_to"}


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, options: dict):
        self.path, self.fields = path, schema.fieldNames()
        self.most = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, type, object]] = []

    def pushFilters(self, filters):
        """Take over comparisons of header fields; Spark keeps the others."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name not in _IN_HEADER or type(f) not in (*_TESTS, IsNotNull):
                yield f
            elif type(f) is not IsNotNull:
                self.tests.append((name, type(f), set(f.value) if type(f) is In else f.value))
            else:
                self.tests.append((name, IsNotNull, None))

    def partitions(self):
        """Files one after the other, as many to a partition as stay within its size."""
        groups: list[list[str]] = [[]]
        held = 0
        for name, size in archives(self.path):
            if groups[-1] and held + size > self.most:
                groups.append([])
                held = 0
            groups[-1].append(name)
            held += size
        return [InputPartition(names) for names in groups]

    def _wanted(self, fields: dict) -> bool:
        # a comparison with NULL is not true
        return all(fields[n] is not None and (kind is IsNotNull or _TESTS[kind](fields[n], v)) for n, kind, v in self.tests)

    def read(self, partition):
        fs, _ = open_fs(self.path)
        for name in partition.value:
            with fs.open_input_file(name) as raw, BufferedReader(raw, 1 << 18) as file:
                for r in records(file, self._wanted, "payload" in self.fields):
                    yield tuple(r.get(c) for c in self.fields)


def listed(fs: pafs.FileSystem, folder: str) -> list[dict] | None:
    """Files of the writes that succeeded; None if the folder has no list."""
    if fs.get_file_info(f"{folder}/{MANIFEST}").type != pafs.FileType.File:
        return None
    with fs.open_input_stream(f"{folder}/{MANIFEST}") as f:
        return [json.loads(line) for line in f.read().decode().splitlines()]


def archives(path: str) -> list[tuple[str, int]]:
    """Archives under a path with their sizes."""
    fs, folder = open_fs(path)
    known = listed(fs, folder)
    if known is not None:
        return [(f"{folder}/{x['name']}", x["bytes"]) for x in known]
    info = fs.get_file_info(folder)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(folder, recursive=True))
    return sorted((x.path, x.size) for x in found if x.type == pafs.FileType.File and x.base_name.endswith((".warc", ".warc.gz")))


# --- writing ---------------------------------------------------------------------------------------

@dataclass
class Written(WriterCommitMessage):
    """Files of one task as (name, bytes, records)."""

    files: list[tuple[str, int, int]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, options: dict, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.packed = options.get("compression", "gzip") == "gzip"
        self.most = int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator):
        fs, folder = open_fs(self.path)
        fs.create_dir(folder, recursive=True)
        done: list[tuple[str, int, int]] = []
        rows = (fields for batch in iterator for fields in _fields(batch))
        row = next(rows, None)
        while row is not None:
            name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.packed else "")
            size = count = 0
            with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
                while row is not None and size < self.most:
                    head, http = record_head(row)
                    payload = b"" if row["record_type"] == "revisit" else row["payload"]
                    raw = gzip_member(head + http, payload) if self.packed else b"".join((head, http, payload, b"\r\n\r\n"))
                    out.write(raw)
                    size, count = size + len(raw), count + 1
                    row = next(rows, None)
            done.append((name, size, count))
        return Written(done)

    def commit(self, messages):
        fs, folder = open_fs(self.path)
        fs.create_dir(folder, recursive=True)
        before = listed(fs, folder) or []
        new = [{"name": n, "bytes": b, "records": c} for m in messages if m for n, b, c in m.files]
        with fs.open_output_stream(f"{folder}/{MANIFEST}.new") as f:
            f.write("\n".join(json.dumps(x) for x in (new if self.overwrite else before + new)).encode())
        fs.move(f"{folder}/{MANIFEST}.new", f"{folder}/{MANIFEST}")
        for x in before if self.overwrite else ():
            fs.delete_file(f"{folder}/{x['name']}")

    def abort(self, messages):
        fs, folder = open_fs(self.path)
        for name, _, _ in [f for m in messages if m for f in m.files]:
            fs.delete_file(f"{folder}/{name}")


def _fields(batch: pa.RecordBatch) -> Iterator[dict]:
    """Rows of a batch as record fields; what is not given is derived from the payload."""
    import hashlib

    known = [c for c in ("record_id", "record_type", "page_id", "url", "date", "payload_bytes", "payload_digest", "refers_to", "payload")
             if c in batch.schema.names]
    # a few rows at a time, so that long payloads do not pile up
    for low in range(0, len(batch), 64):
        for fields in batch.select(known).slice(low, 64).to_pylist():
            payload = fields.get("payload") or b""
            payload = payload.encode() if isinstance(payload, str) else payload
            fields["payload"] = payload
            fields["record_type"] = fields.get("record_type") or "response"
            if fields["record_type"] == "revisit" and (fields.get("payload_bytes") is None or fields.get("payload_digest") is None):
                raise ValueError("a revisit needs the size and the digest of its payload")
            if fields["record_type"] != "revisit":
                fields["payload_bytes"], fields["payload_digest"] = len(payload), hashlib.sha1(payload).hexdigest()
            yield fields


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema, self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], self.options, overwrite)


def register(spark: SparkSession) -> SparkSession:
    """Make the source known to the session and let it take filters over."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


# --- pages as archives -----------------------------------------------------------------------------

def page_urn(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), page_id.cast("string"))


def urn_page(urn: Column) -> Column:
    return F.substring_index(urn, ":", -1).cast("long")


def page_records(pages: DataFrame, min_revisit: int = MIN_REVISIT, salts: int = SALTS) -> DataFrame:
    """A record per row of ``pages`` (page_id, url, html).

    Of equal payloads of at least ``min_revisit`` bytes the one with the largest page_id is the response (all rows with that
    page_id, if it is repeated) and the others are revisits of it. Payloads count as equal if SHA-1 and SHA-256 are.
    Rows without page_id are never referred to; if all copies are such rows, they are all responses.
    """
    raw = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", raw.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    rows = rows.withColumn("same", F.when(F.col("payload_bytes") >= min_revisit, F.concat("payload_digest", F.sha2("payload", 256))))
    # payloads that occur again and the page that keeps theirs: summed within the tasks, then a row for each part
    again = rows.where(F.col("same").isNotNull()).groupBy("same").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("copies"))
    parts = F.explode(F.array([F.lit(i) for i in range(salts)])).alias("salt")
    again = again.where((F.col("copies") > 1) & F.col("keeper").isNotNull()).select("same", "keeper", parts)
    # so that many copies of one payload are dealt to several tasks, by their ids
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    joined = rows.join(again, ["same", "salt"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return joined.select(
        page_urn(F.col("page_id")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        "page_id", "url", "payload_bytes", "payload_digest", F.when(revisit, page_urn(F.col("keeper"))).alias("refers_to"),
        F.when(~revisit, F.col("payload")).alias("payload"))


def write_archives(records: DataFrame, path: str, **options) -> None:
    """Write records as archives in a new folder."""
    register(records.sparkSession)
    records.write.format("warc").mode("append").options(**options).save(path)


def read_archives(spark: SparkSession, path: str, columns: str = SCHEMA, **options) -> DataFrame:
    """Records of the archives under ``path``; payloads are only read if ``columns`` names them."""
    return register(spark).read.format("warc").schema(columns).options(**options).load(path)


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write a record per row of ``pages`` into archives (in the shared folder, without a ``path``) and read them back.

    Responses come with their payloads, size and digest computed from those; for revisits, whose payload is not there, they
    are those in the headers, and a scan for revisits jumps over all other blocks.
    """
    spark = pages.sparkSession
    path = path or own_path(spark, "archives")
    write_archives(page_records(pages), path)
    whole = read_archives(spark, path).where("record_type = 'response'").withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")})
    headers = ", ".join(x for x in SCHEMA.split(", ") if not x.startswith("payload binary"))
    again = read_archives(spark, path, headers).where("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    return whole.unionByName(again)


by_value(__name__)
