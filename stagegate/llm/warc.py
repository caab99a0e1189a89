"""WARC archives as a PySpark data source, read and written, and page archives without repeated payloads.

``spark.read.format("warc").load(folder)`` plans partitions of whole files,
parses record headers first, takes predicates on the record type and on header
columns into the scan, and decodes a payload only of records that pass (with
option ``payload`` = false, of none).  ``df.write.format("warc").save(folder)``
writes one gzip member per record; the folder's ``_SUCCESS`` names the files of
the tasks that were committed, so what a lost or repeated task left is not read.

Register it once per session with ``register(spark)``.
"""

from __future__ import annotations

import base64
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import shared_folder

SCHEMA = (
    "record_type string, record_id string, record_date string, target_uri string, refers_to string, "
    "payload_digest string, payload_length long, headers map<string,string>, http_headers map<string,string>, payload binary"
)
# Column -> WARC header
_HEADER = {"record_type": "warc-type", "record_id": "warc-record-id", "record_date": "warc-date", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ARROW = pa.schema([(c, pa.string()) for c in _HEADER] + [("payload_length", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("http_headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

_TESTS = {
    EqualTo: lambda x, v: x is not None and x == v,
    In: lambda x, v: x is not None and x in v,
    IsNotNull: lambda x, v: x is not None,
    IsNull: lambda x, v: x is None,
    GreaterThan: lambda x, v: x is not None and x > v,
    GreaterThanOrEqual: lambda x, v: x is not None and x >= v,
    LessThan: lambda x, v: x is not None and x < v,
    LessThanOrEqual: lambda x, v: x is not None and x <= v,
    StringStartsWith: lambda x, v: x is not None and x.startswith(v),
    StringEndsWith: lambda x, v: x is not None and x.endswith(v),
    StringContains: lambda x, v: x is not None and v in x,
}


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class Stream:
    """A file's decoded bytes; in plain files, bytes that nobody wants are passed over by seeking."""

    def __init__(self, raw, packed: bool):
        self.raw, self.packed, self.zip, self.buf, self.ended = raw, packed, None, b"", False

    def _more(self) -> bool:
        """Decode a further block; False at the end."""
        if not self.packed:
            x = self.raw.read(1 << 16)
            self.buf += x
            return bool(x)
        while True:
            if self.zip is None:
                self.zip = zlib.decompressobj(31)
            if self.zip.eof:  # the next member begins in what is left over
                left, self.zip = self.zip.unused_data.lstrip(b"\0"), zlib.decompressobj(31)
                x = self.zip.decompress(left) if left else b""
            else:
                block = self.raw.read(1 << 16)
                if not block:
                    return False
                x = self.zip.decompress(block)
            if x:
                self.buf += x
                return True

    def line(self) -> bytes | None:
        while (i := self.buf.find(b"\n")) < 0:
            if not self._more():
                rest, self.buf = self.buf, b""
                return rest or None
        out, self.buf = self.buf[:i], self.buf[i + 1 :]
        return out.rstrip(b"\r")

    def take(self, n: int) -> bytes:
        parts = [self.buf[:n]]
        got, self.buf = len(parts[0]), self.buf[n:]
        while got < n and self._more():
            parts.append(self.buf[: n - got])
            self.buf = self.buf[n - got :]
            got += len(parts[-1])
        return b"".join(parts)

    def skip(self, n: int) -> None:
        have = min(n, len(self.buf))
        self.buf, n = self.buf[have:], n - have
        if n and not self.packed:
            self.raw.seek(n, 1)
            return
        while n and self._more():
            have = min(n, len(self.buf))
            self.buf, n = self.buf[have:], n - have


def _fields(next_line) -> dict[str, str]:
    """Header lines up to an empty one; names in lower case, continued lines joined."""
    out: dict[str, str] = {}
    name = None
    while line := next_line():
        text = line.decode("utf-8", "replace")
        if text[:1] in " \t" and name:
            out[name] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _digest_hex(value: str | None) -> str | None:
    """``sha1:BASE32`` as bare lower-case hex; other forms as they are."""
    if value and value.lower().startswith("sha1:"):
        x = value[5:]
        if len(x) != 32:
            return x.lower()
        try:
            return base64.b32decode(x.upper()).hex()
        except ValueError:  # not base 32 after all
            return value
    return value


def _length(value: str | None) -> int | None:
    """A length that a header states, None if it is no number."""
    return int(value) if value is not None and value.isascii() and value.isdigit() else None


def records(stream: Stream, wanted, payloads: bool) -> Iterator[dict]:
    """The records whose header columns satisfy ``wanted``.

    A record whose Content-Length is no number has NULL ``payload_length`` and ``payload``; reading goes on with
    the next line that begins a record.  A digest that cannot be decoded stays as it is, and a record that the file's
    end cuts off has what is there of its payload.
    """
    while (line := stream.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        head = _fields(stream.line)
        length = _length(head.get("content-length", "0"))
        row = {c: head.get(h) for c, h in _HEADER.items()}
        row["payload_digest"] = _digest_hex(row["payload_digest"])
        if length is None:
            if wanted(row):
                yield row | {"payload_length": None, "headers": list(head.items()), "http_headers": None, "payload": None}
            continue
        if not wanted(row):
            stream.skip(length)
            continue
        http = None
        if head.get("content-type", "").lower().startswith("application/http"):
            if payloads:
                block = io.BytesIO(stream.take(length))
                block.readline()
                http = _fields(lambda: block.readline().rstrip(b"\r\n"))
                body = block.read()
            else:  # the HTTP header only
                block, left, at = [], length, -1
                while left and at < 0:
                    block.append(stream.take(min(left, 4096)))
                    left -= len(block[-1])
                    at = b"".join(block).find(b"\r\n\r\n")
                lines = io.BytesIO(b"".join(block)[: at if at >= 0 else None])
                lines.readline()
                http = _fields(lambda: lines.readline().rstrip(b"\r\n"))
                stream.skip(left)
                body = None
        elif payloads:
            body = stream.take(length)
        else:
            stream.skip(length)
            body = None
        row["payload_length"] = _length(http.get("content-length")) if http is not None else length
        row["headers"], row["http_headers"] = list(head.items()), list(http.items()) if http is not None else None
        row["payload"] = body if row["record_type"] != "revisit" else None
        yield row


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payload", "true").lower() != "false"
        self.bytes = int(options.get("maxpartitionbytes", 32 << 20))
        self.tests: list[tuple] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute if hasattr(f, "attribute") else ()
            if type(f) in _TESTS and len(column) == 1 and column[0] in _HEADER:
                self.tests.append((column[0], type(f), getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        """Whole files, together up to ``maxPartitionBytes``."""
        fs, root = pafs.FileSystem.from_uri(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            return [Files((self.path,))]
        sizes = {f.base_name: f.size for f in fs.get_file_info(pafs.FileSelector(root, recursive=False)) if f.type == pafs.FileType.File}
        if "_SUCCESS" in sizes:
            with fs.open_input_stream(f"{root}/_SUCCESS") as f:
                names = f.read().decode().split()
        else:
            names = [x for x in sizes if x.endswith((".warc", ".warc.gz"))]
        parts, room = [], 0
        for name in sorted(names):
            if not parts or sizes[name] > room:
                parts.append([])
                room = self.bytes
            parts[-1].append(f"{self.path.rstrip('/')}/{name}")
            room -= sizes[name]
        return [Files(tuple(p)) for p in parts] or [Files(())]

    def read(self, partition):
        def wanted(row: dict) -> bool:
            return all(_TESTS[kind](row[c], v) for c, kind, v in self.tests)

        rows, size = [], 0
        for path in partition.paths:
            fs, local = pafs.FileSystem.from_uri(path)
            with fs.open_input_file(local) as raw:
                packed = raw.read(2) == b"\x1f\x8b"
                raw.seek(0)
                for r in records(Stream(raw, packed), wanted, self.payloads):
                    rows.append(r)
                    size += len(r["payload"] or b"") + 500
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


@dataclass
class Written(WriterCommitMessage):
    names: tuple[str, ...]


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _one_line(x) -> str:
    return " ".join(str(x).split())


class WarcWriter(DataSourceArrowWriter):
    """Columns: record_type, record_id, record_date, target_uri, refers_to, payload_digest (hex SHA-1), payload_length, payload."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.most = int(options.get("maxfilebytes", 1 << 30))

    def write(self, iterator):
        fs, root = pafs.FileSystem.from_uri(self.path)
        names, out, size = [], None, 0

        def put(record: bytes) -> int:
            packer = zlib.compressobj(5, zlib.DEFLATED, 31)
            member = packer.compress(record) + packer.flush()
            out.write(member)
            return len(member)

        try:
            for b in iterator:
                for r in b.to_pylist():
                    if out is None or size > self.most:
                        if out is not None:
                            out.close()
                        fs.create_dir(root, recursive=True)
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = fs.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                        info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", r["record_date"]), ("Content-Type", "application/warc-fields")]
                        put(_record(info, b"format: WARC File Format 1.1\r\n"))
                    size += put(self._of(r))
        finally:
            if out is not None:
                out.close()
        return Written(tuple(names))

    @staticmethod
    def _of(r: dict) -> bytes:
        fields = [("WARC-Type", r["record_type"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["record_date"])]
        if r["target_uri"] is not None:
            fields.append(("WARC-Target-URI", _one_line(r["target_uri"])))
        fields.append(("WARC-Payload-Digest", f"sha1:{base64.b32encode(bytes.fromhex(r['payload_digest'])).decode()}"))
        if r["record_type"] == "revisit":
            fields += [("WARC-Refers-To", r["refers_to"]), ("WARC-Profile", _PROFILE)]
        fields.append(("Content-Type", "application/http;msgtype=response"))
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['payload_length']}\r\n\r\n".encode()
        return _record(fields, http + (r["payload"] or b""))

    def commit(self, messages):
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        try:  # appending: what stands there stays
            with fs.open_input_stream(f"{root}/_SUCCESS") as f:
                names = f.read().decode().split() + names
        except FileNotFoundError:
            pass
        with fs.open_output_stream(f"{root}/_SUCCESS") as f:
            f.write("\n".join(names).encode())

    def abort(self, messages):
        fs, root = pafs.FileSystem.from_uri(self.path)
        for m in messages:
            for n in m.names if m is not None else ():
                fs.delete_file(f"{root}/{n}")


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def archive_rows(pages: DataFrame, least_bytes: int = 1000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2024-01-01T00:00:00Z", salts: int = 16) -> DataFrame:
    """A WARC record per page; of equal payloads of ``least_bytes`` or more the one with the largest id is the response.

    NULL html is an empty payload.  A NULL id never is the largest.  Rows that repeat an
    id and a payload are alike: all responses or all revisits.  The representative of a
    payload is a partial aggregate; it meets the pages over ``salts`` keys for each payload,
    so that a payload that very many pages share spreads over tasks.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha1("payload")).withColumn("payload_length", F.octet_length("payload").cast("long"))
    large = rows.where(F.col("payload_length") >= least_bytes).groupBy("payload_digest", "payload_length")
    keep = large.agg(F.max("page_id").alias("keep"), F.count("*").alias("n")).where("n > 1 AND keep IS NOT NULL").drop("n")
    keep = keep.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = rows.withColumn("salt", F.coalesce(F.pmod(F.xxhash64("page_id"), F.lit(salts)).cast("int"), F.lit(0)))
    rows = rows.join(keep, ["payload_digest", "payload_length", "salt"], "left")
    again = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    return rows.select(
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        F.lit(date).alias("record_date"),
        "target_uri",
        F.when(again, urn(F.col("keep"))).alias("refers_to"),
        "payload_digest",
        "payload_length",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def write_and_read(pages: DataFrame, **options) -> DataFrame:
    """Archive ``pages`` in the shared folder and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest come from the payload itself for responses, from the headers for revisits.
    """
    spark = pages.sparkSession
    register(spark)
    folder = shared_folder(spark, "warc")
    archive_rows(pages, **options).write.format("warc").mode("append").save(folder)
    got = spark.read.format("warc").load(folder).where(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.regexp_extract(c, "urn:page:(-?[0-9]+)", 1).try_cast("long")
    response = F.col("record_type") == "response"
    return got.select(
        page("record_id").alias("page_id"),
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )
