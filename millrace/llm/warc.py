"""WARC archives as a Spark data source: planned file by file, headers first, payloads only where they are wanted.

``spark.read.format("warc").schema(...).load(folder)`` plans one partition per
group of files, takes predicates on record type and headers into the reader, and
parses a record's headers before anything else. Every record is a gzip member of
its own whose extra field ``sl`` holds its stored length, so a record that is not
wanted, or whose payload no selected column needs, is stepped over undecoded.
Members without that field are decoded to find their end.

Files are reached with ``pyarrow.fs`` (local, HDFS and object stores) from the
workers; tables are read by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage

from millrace.llm.batches import written

# Names and line ends of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK, BLANK_LINE, RECORD_END = b"\r\n", b"\r\n\r\n", b"\r\n\r\n"

#: Column: WARC header that holds it.
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To", "content_type": "Content-Type", "content_length": "Content-Length",
}
SCHEMA = "record_id string, record_type string, target_uri string, date string, payload_digest string, refers_to string, content_type string, content_length bigint, headers map<string,string>, payload_bytes bigint, payload binary, computed_digest string, file string, offset bigint"
#: Columns that need the block of a record, and those that need the payload too.
OF_BLOCK, OF_PAYLOAD = {"payload_bytes", "payload", "computed_digest"}, {"payload", "computed_digest"}

#: Compressed bytes after which a new file begins, and which a partition gathers from small files.
FILE_BYTES = 128 << 20
#: Bytes read or decoded at once.
PIECE = 1 << 16


def base32_sha1(data: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def member(data: bytes, level: int = 5) -> bytes:
    """A gzip member with its stored length, and that of ``data``, in the extra field."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF) if total < 1 << 32 else b"sx" + struct.pack("<HII", 8, 0, 0)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def record(kind: str, record_id: str, uri: str | None, digest: str, payload: bytes, date: str, refers_to: str | None = None) -> bytes:
    """One record. A revisit holds the HTTP headers only, which give the payload's length."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if kind == "response":
        block += payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", "".join(uri.split())))
    fields.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + RECORD_END


def _bare(value: str) -> str:
    return value[1:-1] if value[:1] == "<" and value[-1:] == ">" else value


def parse_headers(head: bytes) -> dict[str, str]:
    """Header fields of a record; folded lines are joined, names keep their spelling."""
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    name = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            out[name] = value.strip()
    return out


class Member:
    """One gzip member of a seekable file, decoded only as far as asked."""

    def __init__(self, file, offset: int):
        file.seek(offset)
        self.file, self.offset, self.length = file, offset, None
        fixed = file.read(12)
        if len(fixed) < 12 or fixed[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"no gzip member at {offset}")
        if fixed[3] & 4:
            extra = file.read(struct.unpack("<H", fixed[10:12])[0])
            at = 0
            while at + 4 <= len(extra):
                size = struct.unpack("<H", extra[at + 2 : at + 4])[0]
                if extra[at : at + 2] == b"sl" and size == 8:
                    self.length = struct.unpack("<I", extra[at + 4 : at + 8])[0]
                at += 4 + size
        file.seek(offset)
        self._inflate, self._rest, self.decoded = zlib.decompressobj(31), b"", 0

    def read(self, size: int) -> bytes:
        """Up to ``size`` further decoded bytes; nothing at the member's end."""
        out = b""
        while not out and not self._inflate.eof:
            if not self._rest and not (piece := self.file.read(min(PIECE, max(size, 1024)))):
                raise ValueError(f"the member at {self.offset} is cut off")
            out = self._inflate.decompress(self._rest or piece, size)
            self._rest = self._inflate.unconsumed_tail
        self.decoded += len(out)
        return out

    def end(self) -> int:
        """Offset of the next member; by the stored length, else by decoding what is left."""
        if self.length is not None:
            return self.offset + self.length
        while self.read(PIECE):
            pass
        return self.file.tell() - len(self._inflate.unused_data)


class Wanted:
    """Predicates on record type and headers, tested before anything of a record's block is decoded."""

    KINDS = (EqualTo, EqualNullSafe, In, IsNull, IsNotNull, StringStartsWith, StringEndsWith, StringContains)

    def __init__(self):
        self.filters: list[Filter] = []

    @classmethod
    def takes(cls, f: Filter) -> bool:
        if isinstance(f, Not):
            return isinstance(f.child, (IsNull, IsNotNull)) and cls.takes(f.child)
        return isinstance(f, cls.KINDS) and ((len(f.attribute) == 1 and f.attribute[0] in HEADERS) or (len(f.attribute) == 2 and f.attribute[0] == "headers"))

    @staticmethod
    def _holds(f: Filter, value) -> bool:
        match f:
            case Not():
                return not Wanted._holds(f.child, value)
            case IsNull():
                return value is None
            case IsNotNull():
                return value is not None
            case EqualNullSafe():
                return value == f.value
            case EqualTo():
                return value is not None and value == f.value
            case In():
                return value is not None and value in f.value
            case StringStartsWith():
                return value is not None and value.startswith(f.value)
            case StringEndsWith():
                return value is not None and value.endswith(f.value)
            case StringContains():
                return value is not None and f.value in value
        raise TypeError(type(f))

    def fits(self, headers: dict[str, str]) -> bool:
        for f in self.filters:
            of = (f.child if isinstance(f, Not) else f).attribute
            if not self._holds(f, header_value(headers, of[0]) if len(of) == 1 else headers.get(of[1])):
                return False
        return True


def header_value(headers: dict[str, str], column: str):
    value = headers.get(HEADERS[column])
    if value is None:
        return None
    if column in ("record_id", "refers_to"):
        return _bare(value)
    if column == "payload_digest":
        return value.rpartition(":")[2]
    return int(value) if column == "content_length" else value


def records(file, size: int, name: str, columns: list[str], wanted: Wanted, count: dict | None = None) -> Iterator[dict]:
    """Wanted records of one file; ``count`` gets the members seen and the bytes decoded."""
    need_block, need_payload = bool(OF_BLOCK & set(columns)), bool(OF_PAYLOAD & set(columns))
    offset = 0
    while offset < size:
        m = Member(file, offset)
        data = b""
        while (cut := data.find(BLANK_LINE)) < 0:
            if not (more := m.read(1024)):
                raise ValueError(f"{name}: no headers at {offset}")
            data += more
        headers = parse_headers(data[:cut])
        if wanted.fits(headers):
            out = {c: header_value(headers, c) for c in columns if c in HEADERS} | {"headers": headers, "file": name, "offset": offset}
            if need_block:
                out |= _block(m, bytearray(data[cut + len(BLANK_LINE) :]), headers, need_payload, columns)
            yield {c: out.get(c) for c in columns}
        offset = m.end()
        if count is not None:
            count["members"], count["decoded"] = count.get("members", 0) + 1, count.get("decoded", 0) + m.decoded


def _block(m: Member, data: bytearray, headers: dict[str, str], need_payload: bool, columns: list[str]) -> dict:
    """Payload columns of a record. HTTP headers are read first; of a revisit they tell the payload's length."""
    length = int(headers.get("Content-Length", 0))

    def upto(size: int):
        while len(data) < size and (more := m.read(PIECE)):
            data.extend(more)

    start, said = 0, None
    if headers.get("Content-Type", "").startswith("application/http"):
        while (cut := data.find(BLANK_LINE)) < 0 and len(data) < length:
            before = len(data)
            upto(min(length, before + 1024))
            if len(data) == before:
                break
        if 0 <= cut < length:
            start = cut + len(BLANK_LINE)
            for line in bytes(data[:cut]).split(BREAK)[1:]:
                k, _, v = line.partition(b":")
                if k.strip().lower() == b"content-length" and v.strip().isdigit():
                    said = int(v)
    revisit = headers.get("WARC-Type") == "revisit"
    out = {"payload_bytes": said if revisit else length - start}
    if need_payload and not revisit:
        upto(length)
        payload = bytes(data[start:length])
        out["payload"] = payload
        if "computed_digest" in columns:
            out["computed_digest"] = base32_sha1(payload)
    return out


def _open(path: str):
    """File system and path of a folder; paths without a scheme are local."""
    return pa.fs.FileSystem.from_uri(path) if ":/" in path else (pa.fs.LocalFileSystem(), path)


@dataclass
class Files(InputPartition):
    """Files of one partition with their sizes."""

    files: list

    def __init__(self, files):
        self.files = files


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.path, self.columns, self.wanted = path, [f.name for f in schema.fields], Wanted()
        if unknown := [c for c in self.columns if c not in {x.split()[0] for x in SCHEMA.split(", ")}]:
            raise ValueError(f"no such columns: {unknown}")
        self.schema = pa.schema([(f.name, _TYPES[f.dataType.simpleString()]) for f in schema.fields])

    def pushFilters(self, filters):
        for f in filters:
            if Wanted.takes(f):
                self.wanted.filters.append(f)
            else:
                yield f

    def partitions(self):
        system, root = _open(self.path)
        found = system.get_file_info(pa.fs.FileSelector(root, recursive=False))
        files = sorted((f.path, f.size) for f in found if f.type == pa.fs.FileType.File and f.path.endswith(".warc.gz") and f.size)
        parts, now, held = [], [], 0
        for path, size in files:
            if now and held + size > FILE_BYTES:
                parts.append(Files(now))
                now, held = [], 0
            now.append((path, size))
            held += size
        return [*parts, Files(now)] if now or not parts else parts

    def read(self, partition):
        system, _ = _open(self.path)
        out, held = [], 0
        for path, size in partition.files:
            with system.open_input_file(path) as file:
                for row in records(file, size, path, self.columns, self.wanted):
                    out.append(row)
                    held += 512 + len(row.get("payload") or b"")
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist(out, self.schema)
                        out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, self.schema)


_TYPES = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "map<string,string>": pa.map_(pa.string(), pa.string())}


@dataclass
class Wrote(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, target_uri, payload_digest, payload, date, refers_to) to files of about ``FILE_BYTES``.

    A task writes under names of its own in a hidden folder; files get their
    place when all tasks have succeeded, so repeated tasks leave nothing behind.
    """

    def __init__(self, path: str):
        self.path, self.job = path, uuid.uuid4().hex

    def write(self, iterator):
        system, root = _open(self.path)
        hidden = posixpath.join(root, f"_writing-{self.job}")
        system.create_dir(hidden, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            columns = [batch.column(c) for c in ("record_type", "record_id", "target_uri", "payload_digest", "payload", "date", "refers_to")]
            for i in range(batch.num_rows):
                kind, key, uri, digest, payload, date, refers = (c[i].as_py() for c in columns)
                if out is None:
                    files.append(posixpath.join(hidden, f"part-{uuid.uuid4().hex}.warc.gz"))
                    out, size = system.open_output_stream(files[-1], compression=None), 0
                data = member(record(kind, key, uri, digest, payload or b"", date, refers))
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Wrote(files)

    def _done(self):
        system, root = _open(self.path)
        hidden = posixpath.join(root, f"_writing-{self.job}")
        if system.get_file_info(hidden).type == pa.fs.FileType.Directory:
            system.delete_dir(hidden)

    def commit(self, messages):
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        for m in messages:
            for file in m.files if m else ():
                system.move(file, posixpath.join(root, posixpath.basename(file)))
        self._done()

    def abort(self, messages):
        self._done()


class WarcSource(DataSource):
    """``format("warc")``; the option ``path`` names the folder."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make ``format("warc")`` known to the session and let it take predicates."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def pages_to_warc(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row of (page_id, url, html) in new archive files below ``path``.

    Payload: the html in UTF-8, null as empty. Of rows with equal payloads of at
    least ``least_bytes`` bytes the one with the smallest page_id (nulls last, then
    the order of the table) becomes a response, the others revisit it; shorter
    ones are all responses. Null and repeated ids keep a record each: the record
    id holds the page_id and the row's number. An empty table writes no record.
    Other columns are not read. Only payloads that come more than once are joined
    back, as one small row each, so large groups of copies need no one task.
    """
    spark = pages.sparkSession
    register(spark)
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = written(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), payload.alias("payload")).withColumns({"row": F.monotonically_increasing_id(), "sha": F.sha1("payload"), "bytes": F.octet_length("payload")}), "warc-pages")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    copies = rows.where(F.col("bytes") >= least_bytes).groupBy("sha").agg(F.count("*").alias("n"), F.min(order).alias("first")).where("n > 1")
    copies = written(copies.select(F.col("sha").alias("of"), "first.page_id", "first.row"), "warc-copies").withColumnsRenamed({"page_id": "first_page", "row": "first_row"})
    key = lambda page, row: F.concat(F.lit("urn:page:"), F.coalesce(F.col(page).cast("string"), F.lit("")), F.lit(":"), F.col(row).cast("string"))
    joined = rows.join(copies, (F.col("sha") == F.col("of")) & (F.col("bytes") >= least_bytes), "left")
    revisit = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row"))
    joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), key("page_id", "row").alias("record_id"), "target_uri", base32(F.col("sha")).alias("payload_digest"), "payload",
        F.lit(date).alias("date"), F.when(revisit, key("first_page", "first_row")).alias("refers_to"),
    ).write.format("warc").mode("append").save(path)


def base32(sha1_hex):
    """Base32 of a column of 40 hex digits: five digits are four letters."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    out = []
    for i in range(8):
        number = F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(letters), F.shiftright(number, 15 - 5 * k).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for k in range(4)]
    return F.concat(*out)


def page_of(record_id):
    """The page_id that a record id of :func:`pages_to_warc` holds; null if it was null."""
    digits = F.regexp_extract(record_id, r"^urn:page:(-?\d+):", 1)
    return F.when(digits != "", digits).cast("long")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the archives.

    Responses are decoded and their digest is computed from the payload that is
    read; revisits need their headers only, and their reading steps over the
    responses undecoded.
    """
    register(spark)
    responses = spark.read.format("warc").schema("record_id string, record_type string, payload_bytes bigint, computed_digest string").load(path).where("record_type = 'response'")
    revisits = spark.read.format("warc").schema("record_id string, record_type string, payload_bytes bigint, payload_digest string, refers_to string").load(path).where("record_type = 'revisit'")
    a = responses.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", F.col("computed_digest").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    b = revisits.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of(F.col("refers_to")).alias("refers_to"))
    return a.union(b)
