"""Legacy ARC archives: writing, reading, and conversion to WARC.

ARC has two versions whose header lines differ; the version block that opens a
file says which one its records use:

    1: URL IP-address Archive-date Content-type Archive-length
    2: URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length

Records are read by their declared lengths only, never by searching for a
separator, from a decompressing stream, so one record at a time is in memory.
The converter synthesises what WARC needs and ARC lacks: record identifiers,
ISO timestamps, record types and SHA-256 digests.  Payloads that repeat become
``revisit`` records that refer to the record with the smallest key.

Archives are written by Spark's text writer, one gzip file per task with the
task's version block (ARC) or ``warcinfo`` record (WARC) first; its commit
protocol leaves no half-written file when an executor is lost.  A record's
terminator is the writer's line separator, so blocks must be UTF-8 text.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize, ship_package
from . import shared

# fixed values of the two formats
V1 = "URL IP-address Archive-date Content-type Archive-length"
V2 = "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "19960101000000"  # of records whose source has no date
KEY = "X-Record-Key"     # HTTP header that carries a record's key through both formats
CHUNK = 1 << 20
MAX_BROADCAST_GROUPS = 500_000


class Stream:
    """Sequential bytes of a file, gzip (any number of members) or plain."""

    def __init__(self, raw: bytes):
        self.raw, self.at, self.buf = memoryview(raw), 0, bytearray()
        self.gz = raw[:2] == b"\x1f\x8b"
        self.z = zlib.decompressobj(31) if self.gz else None

    def _more(self) -> bool:
        if not self.gz:
            part = self.raw[self.at: self.at + CHUNK]
            self.at += len(part)
            self.buf += part
            return bool(part)
        while True:
            data = self.z.unconsumed_tail
            if not data:
                data = bytes(self.raw[self.at: self.at + CHUNK // 8])
                self.at += len(data)
            if not data:
                return False
            out = self.z.decompress(data, CHUNK)
            if self.z.eof:
                self.at -= len(self.z.unused_data)
                self.z = zlib.decompressobj(31)
            if out:
                self.buf += out
                return True

    def take(self, n: int) -> bytes:
        """The next n bytes, fewer at the end."""
        while len(self.buf) < n and self._more():
            pass
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out

    def line(self) -> bytes | None:
        """The next line without its end; None at the end."""
        seen = 0
        while (cut := self.buf.find(b"\n", seen)) < 0:
            seen = len(self.buf)
            if not self._more():
                return bytes(self.take(seen)) if seen else None
        out = bytes(self.buf[:cut])
        del self.buf[: cut + 1]
        return out.removesuffix(b"\r")


# ------------------------------------------------------------ ARC

def field(value: str | None) -> str:
    """A header field: no white space or control characters; '-' for none."""
    return quote(value, safe="!#$%&'()*+,/:;=?@[]~-._|{}^`\"<>\\") if value else "-"


def http_block(key: str, payload: str) -> str:
    size = len(payload.encode())
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n{KEY}: {key}\r\n\r\n{payload}"


def version_block(version: int, name: str) -> str:
    body = f"{version} 0 {__name__}\n{V1 if version == 1 else V2}\n"
    head = f"filedesc://{name} 0.0.0.0 {DATE} text/plain"
    extra = "" if version == 1 else f" 200 - - 0 {name}"
    return f"{head}{extra} {len(body)}\n{body}"


def arc_record(version: int, url: str | None, key: str, payload: str, name: str) -> str:
    block = http_block(key, payload)
    size = len(block.encode())
    head = f"{field(url)} 0.0.0.0 {DATE} text/html"
    if version == 1:
        return f"{head} {size}\n{block}"
    check = hashlib.sha1(block.encode()).hexdigest()
    return f"{head} 200 {check} - 0 {name} {size}\n{block}"


def write_arc(df: DataFrame, path: str, version: int, key_col: str, url_col: str, payload_col: str) -> None:
    """One ARC file per task.  Null keys are written empty, null URLs as '-', null payloads empty."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = None
        for b in batches:
            out = []
            if name is None:
                name = f"{uuid.uuid4().hex}.arc.gz"
                out.append(version_block(version, name))
            for key, url, payload in zip(*(c.to_pylist() for c in b.columns)):
                out.append(arc_record(version, url, "" if key is None else str(key), payload or "", name))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    (df.select(F.col(key_col).cast("string"), url_col, payload_col).mapInArrow(run, "value string")
     .write.option("lineSep", "\n").option("compression", "gzip").text(path))


def arc_records(raw: bytes) -> Iterator[dict]:
    """Records of one ARC file after its version block."""
    s, version, offset = Stream(raw), 0, 0
    while (line := s.line()) is not None:
        if not line.strip():
            continue
        parts = line.decode("utf-8", "replace").split(" ")
        if line.startswith(b"filedesc://"):
            body = s.take(int(parts[-1]))
            version = int(body.split(b" ", 1)[0])
            if version not in (1, 2):
                raise ValueError(f"ARC version {version}")
            continue
        want = 5 if version == 1 else 10
        if not version or len(parts) < want or not parts[-1].isdigit():
            raise ValueError(f"ARC header line {line[:200]!r}")
        # a URL with spaces has more fields: all but the last ones are the URL
        url, rest = " ".join(parts[: len(parts) - want + 1]), parts[len(parts) - want + 1:]
        block = s.take(int(rest[-1]))
        yield {"version": version, "url": None if url == "-" else url, "ip": rest[0], "date": rest[1],
               "mime": rest[2], "number": offset, "block": block}
        offset += 1


def http_parts(block: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """(headers with their end, header fields, payload) of an HTTP response; without one, all is payload."""
    if not block.startswith(b"HTTP/"):
        return b"", {}, block
    head, mark, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in x)
    return head + mark, fields, payload


ARC_SCHEMA = ("key string, version int, url string, ip string, date string, mime string, number long, "
              "block binary, payload_bytes long, payload_digest string")


def read_arc(spark: SparkSession, *paths: str, blocks: bool = True) -> DataFrame:
    """Records of the ARC files under ``paths``, digests of the full payload included."""
    ship_package(spark)
    names = ["key", "version", "url", "ip", "date", "mime", "number", "block", "payload_bytes", "payload_digest"]
    types = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(),
             pa.int64(), pa.string()]

    def row(r: dict) -> tuple:
        _, fields, payload = http_parts(r["block"])
        return (fields.get(KEY) or None, r["version"], r["url"], r["ip"], r["date"], r["mime"], r["number"],
                r["block"] if blocks else None, len(payload), hashlib.sha256(payload).hexdigest())

    files = spark.read.format("binaryFile").load(list(paths)).select("content")
    return files.mapInArrow(lambda bs: _rows(bs, lambda raw: map(row, arc_records(raw)), names, types), ARC_SCHEMA)


def _rows(batches, read, names, types, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows that ``read`` yields for each file, in batches of about ``most`` bytes."""
    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*held), types)], names=names)

    for b in batches:
        for raw in b.column(0):
            held, size = [], 0
            for r in read(raw.as_py()):
                held.append(r)
                size += 200 + sum(len(x) for x in r if isinstance(x, (bytes, str)))
                if size >= most:
                    yield batch(held)
                    held, size = [], 0
            if held:
                yield batch(held)


# ------------------------------------------------------------ WARC

def iso(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z" if re.fullmatch(r"\d{14}", d) else iso(DATE)


def record_id(key: str | None, *parts) -> str:
    """The key's identifier; for records without one a name-based UUID of what is known about them."""
    return f"<urn:x-record:{key}>" if key is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr(parts))}>"


def warc_record(r: dict, refers_to: str | None) -> bytes:
    head, _, payload = http_parts(r["block"])
    kind = "revisit" if refers_to is not None else "response" if head else "resource"
    block = head if kind == "revisit" else r["block"]
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(r['key'], r['url'], r['date'], r['number'], r['payload_digest'])}",
        f"WARC-Date: {iso(r['date'])}", f"WARC-Target-URI: {r['url'] or 'urn:x-none'}", f"WARC-IP-Address: {r['ip']}",
        f"WARC-Payload-Digest: sha256:{r['payload_digest']}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}"]
    kind_of = "application/http; msgtype=response" if head else r["mime"]
    lines += [f"Content-Type: {kind_of}", f"Content-Length: {len(block)}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + block


def warc_info(name: str) -> str:
    body = "software: " + __name__ + "\r\nformat: WARC File Format 1.1\r\n"
    return "\r\n".join(["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
                        f"WARC-Date: {iso(DATE)}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields",
                        f"Content-Length: {len(body)}"]) + "\r\n\r\n" + body


def convert(spark: SparkSession, arc_paths: list[str], path: str, min_bytes: int = 100) -> None:
    """Converts the ARC files under ``arc_paths`` to WARC files under ``path``.

    Of records with a key and equal payloads of at least ``min_bytes`` the one
    with the smallest key (as a number, where keys are numbers) is the
    response, the others revisit it.  Smaller payloads and records without a
    key are responses.  A first pass over the archives finds the payloads that
    repeat (counted map-side); only those are joined to the second, which
    converts.  No payload is shuffled while the table of repeats is small
    enough to broadcast (counted).
    """
    ship_package(spark)
    seen = read_arc(spark, *arc_paths, blocks=False).where(F.col("key").isNotNull() & (F.col("payload_bytes") >= min_bytes))
    order = F.struct(F.expr("try_cast(key AS decimal(38,0))").alias("n"), F.col("key").alias("k"))
    first = (seen.groupBy("payload_digest").agg(F.count(F.lit(1)).alias("copies"), F.min(order)["k"].alias("refers_to"))
             .where("copies > 1").select("payload_digest", "refers_to"))
    first, _ = broadcast_if_small(materialize(first), MAX_BROADCAST_GROUPS, materialized=True)
    records = read_arc(spark, *arc_paths).join(first, "payload_digest", "left")
    refers = F.when(F.col("key").isNotNull() & (F.col("payload_bytes") >= min_bytes) & (F.col("key") != F.col("refers_to")),
                    F.col("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = None
        for b in batches:
            out = []
            if name is None:
                name = f"{uuid.uuid4().hex}.warc.gz"
                out.append(warc_info(name).encode())
            cols = {n: b.column(n).to_pylist() for n in b.schema.names}
            for i in range(b.num_rows):
                r = {n: c[i] for n, c in cols.items()}
                out.append(warc_record(r, r["refers_to"]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    # the cast keeps the bytes, and the text writer writes them as they are: blocks need not be UTF-8
    (records.withColumn("refers_to", refers).mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path))


def warc_records(raw: bytes) -> Iterator[dict]:
    """Header fields and block of every record of one WARC file."""
    s = Stream(raw)
    while (line := s.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"WARC version line {line[:200]!r}")
        fields = {}
        while line := s.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield {"fields": fields, "block": s.take(int(fields["content-length"]))}


def read_warc(spark: SparkSession, *paths: str) -> DataFrame:
    """Records of the WARC files under ``paths`` but for ``warcinfo``:
    (key, record_type, record_id, refers_to, target_uri, date, payload_bytes, payload_digest, block)."""
    ship_package(spark)
    names = ["key", "record_type", "record_id", "refers_to", "target_uri", "date", "payload_bytes", "payload_digest", "block"]
    types = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]

    def rows(raw: bytes) -> Iterator[tuple]:
        for r in warc_records(raw):
            f = r["fields"]
            if f["warc-type"] == "warcinfo":
                continue
            _, http, payload = http_parts(r["block"])
            size = int(http["Content-Length"]) if f["warc-type"] == "revisit" else len(payload)
            digest = f["warc-payload-digest"].removeprefix("sha256:")
            if f["warc-type"] != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"payload digest of {f['warc-record-id']}")
            refers = f.get("warc-refers-to", "")
            yield (http.get(KEY) or None, f["warc-type"], f["warc-record-id"],
                   refers.removeprefix("<urn:x-record:").removesuffix(">") or None, f.get("warc-target-uri"),
                   f["warc-date"], size, digest, r["block"])

    files = spark.read.format("binaryFile").load(list(paths)).select("content")
    return files.mapInArrow(
        lambda bs: _rows(bs, rows, names, types),
        "key string, record_type string, record_id string, refers_to string, target_uri string, date string, "
        "payload_bytes long, payload_digest string, block binary")


def archive(df: DataFrame, key_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
            min_bytes: int = 100) -> DataFrame:
    """A table's rows through ARC files of both versions, the converter and WARC files, read back.

    Null payloads are empty, null URLs have none, null keys come back null and
    are never revisits.  Repeated rows with one key and payload are that key's
    responses each.  Other columns are ignored; an empty table gives no record.
    """
    shared.require(df, key_col, url_col, payload_col)
    spark = df.sparkSession
    base = shared.shared_path(spark, "archives")
    old = F.crc32(F.coalesce(F.col(key_col).cast("string"), F.lit("")).cast("binary")) % 2 == 0
    for version, part in ((1, df.where(old)), (2, df.where(~old))):
        write_arc(part, f"{base}/arc-v{version}", version, key_col, url_col, payload_col)
    convert(spark, [f"{base}/arc-v1", f"{base}/arc-v2"], f"{base}/warc", min_bytes)
    return read_warc(spark, f"{base}/warc")
