"""Legacy ARC archives into WARC, with copies turned into revisits, and WARC archives read back.

Reading ARC: the version block of an archive names the fields of its header lines, five in version 1, ten in
version 2; the last one declares the length of the content, which is taken by count and not by looking for the next
header. Archives may be gzipped, as a whole or member by member.

Each ARC record becomes a WARC record: an id made from the archive's name and the record's offset, the date in ISO
form, a type (``warcinfo`` for the version block, ``response`` for HTTP, ``resource`` otherwise) and SHA-1 digests
of block and payload in base32. Of responses with equal payloads one stays a response and the others become
revisits of it, which keep their HTTP header and drop the payload.

Archives are bounded by ARCHIVE_BYTES (a larger record has one of its own), so a task holds few of them.
Files are written by Spark's text writer, one archive to a file, each ending in a zero byte, which gzip takes
as padding. They can be read with any tool for WARC; Spark names them ``.txt``.

A header line that cannot be parsed, or a length beyond the end, ends its archive with a record of type
``error`` that holds the rest as payload; nothing is skipped silently. Dates that are not 12 or 14 digits become
1970-01-01T00:00:00Z. Missing fields are ``-``. Empty and null archives hold no records. Repeated rows are
records of their own; ties in the order of revisits are decided by record id.
"""

from __future__ import annotations

import gzip
import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakerecon.llm.frames import cut, map_batches, small

ARCHIVE_BYTES = 4 << 20
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "archive string, offset long, url string, date string, content_type string, type string, record_id string, payload_digest string, payload_bytes long, head binary, payload binary"


def base32_sha1(data: bytes) -> str:
    return b32encode(sha1(data).digest()).decode()


def _plain(content: bytes) -> bytes:
    """Unzipped, whatever the number of members; zero bytes after a member are padding."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data.lstrip(b"\0")
    return b"".join(out) if out else content


def _split(content: bytes) -> tuple[bytes, bytes]:
    """HTTP header, with its closing blank line, and payload."""
    if not content.startswith(b"HTTP/"):
        return b"", content
    for mark in (b"\r\n\r\n", b"\n\n"):
        if (at := content.find(mark)) >= 0:
            return content[: at + len(mark)], content[at + len(mark) :]
    return content, b""


def _iso(date: str) -> str:
    if not re.fullmatch(r"\d{12}(\d\d)?", date):
        return "1970-01-01T00:00:00Z"
    date = date.ljust(14, "0")
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:]}Z"


def parse_arc(name: str, content: bytes) -> Iterator[dict]:
    """The records of one archive in RECORD's columns."""
    data = _plain(content)
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] in b"\r\n\0":
            at += 1
            continue
        begin, end = at, data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].decode("utf-8", "replace").rstrip("\r")
        parts = line.split(" ")
        length = int(parts[-1]) if re.fullmatch(r"\d{1,18}", parts[-1]) else -1
        known = fields or (FIELDS[2] if len(parts) == 10 else FIELDS[1])
        if end < 0 or length < 0 or len(parts) != len(known) or end + 1 + length > len(data):
            yield _record(name, begin, {}, b"", data[begin:], "error")
            return
        body = data[end + 1 : end + 1 + length]
        at = end + 1 + length
        values = dict(zip(known, parts, strict=True))
        if fields is None and line.startswith("filedesc:"):
            lines = body.decode("utf-8", "replace").split("\n")
            named = tuple(lines[1].split()) if len(lines) > 1 else ()
            fields = named if named and named[-1] == "Archive-length" else FIELDS[2 if body.startswith(b"2") else 1]
            yield _record(name, begin, values, b"", body, "warcinfo")
            continue
        head, payload = _split(body)
        yield _record(name, begin, values, head, payload, "response" if head else "resource")


def _record(name: str, offset: int, values: dict, head: bytes, payload: bytes, kind: str) -> dict:
    return {
        "archive": name,
        "offset": offset,
        "url": values.get("URL", "-"),
        "date": _iso(values.get("Archive-date", "")),
        "content_type": values.get("Content-type", "-"),
        "type": kind,
        "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>",
        "payload_digest": base32_sha1(payload),
        "payload_bytes": len(payload),
        "head": head,
        "payload": payload,
    }


def _field(text: str | None) -> str:
    """A value that can stand in a header line, where blanks divide fields."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "") or "-"


def pack(contents: DataFrame, name: str, version: int = 1, ip: str = "0.0.0.0", size: int = ARCHIVE_BYTES) -> DataFrame:
    """ARC archives (path, content) of the given version from rows (url, date, content_type, body)."""
    rows = contents.select("url", "date", "content_type", "body")

    def opened(path: str) -> list[bytes]:
        block = f"{version} 0 archive\n{' '.join(FIELDS[version])}\n\n".encode()
        extra = "" if version == 1 else f" 200 - - 0 {path}"
        return [f"filedesc://{path} {ip} 19700101000000 text/plain{extra} {len(block)}\n".encode(), block, b"\n"]

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        parts, used = [], 0
        for batch in batches:
            for url, date, kind, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                body, path = body or b"", f"{name}-v{version}-{task:06d}-{number:06d}.arc"
                if parts and used + len(body) > size:
                    yield _archive(path, parts)
                    parts, used, number = [], 0, number + 1
                    path = f"{name}-v{version}-{task:06d}-{number:06d}.arc"
                if not parts:
                    parts = opened(path)
                extra = "" if version == 1 else f" 200 {base32_sha1(body)} - {used} {path}"
                parts += [f"{_field(url)} {ip} {_field(date)} {_field(kind)}{extra} {len(body)}\n".encode(), body, b"\n"]
                used += len(body)
        if parts:
            yield _archive(f"{name}-v{version}-{task:06d}-{number:06d}.arc", parts)

    return map_batches(rows, run, "path string, content binary")


def _archive(path: str, parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([b"".join(parts)], pa.binary())], names=["path", "content"])


def _rows(found: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(found, schema)


_ARC = pa.schema(
    [(n, pa.int64() if k == "long" else pa.binary() if k == "binary" else pa.string()) for n, k in (x.strip().split(" ") for x in RECORD.split(","))]
)


def records(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of ARC archives (path, content), as Spark's ``binaryFile`` source gives them; without payloads, only what is known of them."""
    rows = archives.select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = list(parse_arc((name or "").rsplit("/", 1)[-1], content.as_py() or b""))
                if not payloads:
                    for x in found:
                        x["payload"] = None
                yield _rows(found, _ARC)

    return map_batches(rows, run, RECORD)


def decisions(known: DataFrame, order: Column, least_bytes: int = 0) -> DataFrame:
    """(record_id, refers_to, refers_url, refers_date) of the responses that become revisits.

    Of responses with equal payloads of at least ``least_bytes`` that with the largest ``order`` stays a response.
    """
    ours = known.filter((F.col("type") == "response") & (F.col("payload_bytes") >= least_bytes)).select(
        "payload_digest", F.struct(order.alias("order"), "record_id", "url", "date").alias("r")
    )
    first = ours.groupBy("payload_digest").agg(F.max("r").alias("f"), F.count("*").alias("n")).filter("n > 1").drop("n")
    met = ours.join(first, "payload_digest").filter("r.record_id <> f.record_id")
    return met.select(
        F.col("r.record_id").alias("record_id"), F.col("f.record_id").alias("refers_to"), F.col("f.url").alias("refers_url"), F.col("f.date").alias("refers_date")
    )


def _warc(r: dict) -> bytes:
    """One WARC record, as a gzip member."""
    kind = "revisit" if r["refers_to"] else {"error": "resource"}.get(r["type"], r["type"])
    head, payload = r["head"] or b"", r["payload"] or b""
    block = head if kind == "revisit" else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}"]
    if kind == "warcinfo":
        lines.append(f"WARC-Filename: {r['archive']}")
    else:
        lines += [f"WARC-Target-URI: {r['url']}", f"WARC-Payload-Digest: sha1:{r['payload_digest']}"]
    lines.append(f"WARC-Block-Digest: sha1:{base32_sha1(block)}")
    if kind == "revisit":
        lines += [
            f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {r['refers_to']}", f"WARC-Refers-To-Target-URI: {r['refers_url']}",
            f"WARC-Refers-To-Date: {r['refers_date']}", f"X-Payload-Length: {r['payload_bytes']}",
        ]
    mime = "application/http; msgtype=response" if head else "text/plain" if kind == "warcinfo" else r["content_type"]
    lines += [f"Content-Type: {mime}", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 1, mtime=0)


def write_warc(found: DataFrame, revisits: DataFrame, path: str, size: int = ARCHIVE_BYTES) -> None:
    """Write records as WARC archives below ``path``, those named in ``revisits`` as revisits."""
    rows = found.join(small(revisits), "record_id", "left")
    names = rows.columns

    def run(batches):
        parts, used = [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                record = _warc({n: c[i].as_py() for n, c in zip(names, columns, strict=True)})
                if parts and used + len(record) > size:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["value"])
                    parts, used = [], 0
                parts.append(record)
                used += len(record)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], names=["value"])

    archives = map_batches(rows, run, "value binary").select(F.col("value").cast("string").alias("value"))
    archives.write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


WARC = "record_id string, type string, date string, url string, refers_to string, payload_digest string, payload_bytes long, head binary, payload binary"
_WARC = pa.schema(
    [(n, pa.int64() if k == "long" else pa.binary() if k == "binary" else pa.string()) for n, k in (x.strip().split(" ") for x in WARC.split(","))]
)


def parse_warc(content: bytes) -> Iterator[dict]:
    """The records of one WARC archive. Digests of payloads that are present are computed, not believed."""
    data, at = _plain(content), 0
    while at < len(data):
        if data[at : at + 1] in b"\r\n\0":
            at += 1
            continue
        end = data.find(b"\r\n\r\n", at)
        lines = data[at : max(at, end)].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        length = fields.get("content-length", "")
        if not lines[0].startswith("WARC/") or not length.isdigit() or end + 4 + int(length) > len(data):
            raise ValueError(f"not a WARC record at byte {at}")
        block = data[end + 4 : end + 4 + int(length)]
        at = end + 4 + int(length)
        head, payload = _split(block)
        kind = fields.get("warc-type", "-")
        gone = kind == "revisit"
        yield {
            "record_id": fields.get("warc-record-id"),
            "type": kind,
            "date": fields.get("warc-date"),
            "url": fields.get("warc-target-uri"),
            "refers_to": fields.get("warc-refers-to"),
            "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if gone else base32_sha1(payload),
            "payload_bytes": int(fields.get("x-payload-length", 0)) if gone else len(payload),
            "head": head,
            "payload": None if gone else payload,
        }


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the WARC archives below ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                found = list(parse_warc(content.as_py()))
                if not payloads:
                    for x in found:
                        x["payload"] = None
                yield _rows(found, _WARC)

    return map_batches(files, run, WARC)


def http_header(head: str, name: str) -> Column:
    """The value of a header in a column of HTTP headers; null if it is not there."""
    return F.nullif(F.regexp_extract(F.col(head).cast("string"), rf"(?i)\r\n{re.escape(name)}: ([^\r\n]*)\r\n", 1), F.lit(""))


def convert(archives: DataFrame, order: Column, path: str, least_bytes: int = 0) -> None:
    """ARC archives (path, content) into WARC archives below ``path``. ``order`` speaks of RECORD's columns without the payload."""
    known = cut(records(archives, payloads=False).drop("payload"), "arc-records")
    write_warc(records(archives), cut(decisions(known, order, least_bytes), "arc-revisits"), path)
