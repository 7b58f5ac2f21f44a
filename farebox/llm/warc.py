"""WARC archives: writer and splittable reader (operator 7).

The writer makes one gzip member per record and lets Spark's text writer commit
the files: every member's last byte is zero (its size field's high byte; a
record of 16 MiB or more gets an empty member after it), that byte is left to
the line separator, and the files are plain concatenated members.  The reader
hands byte ranges of the files to tasks.  A task looks for gzip magic from its
range's start, accepts a candidate only if it decodes to a WARC header, owns
the records that start inside its range and reads the last one past its end.
Ranges come from Spark's own file listing and are packed into tasks.  Bytes
that belong to no readable record (a member that does not decode, a gap between
members) are damage: reading raises, or skips it and lists it (``damages``).
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.common import bound_batches, map_columns, materialize
from farebox.session import scratch_path

MIN_REVISIT_BYTES = 0
SPLIT_BYTES = 8 * 1024 * 1024
TASK_BYTES = 256 * 1024 * 1024   # ranges of a task, where there is enough to go round
_MAGIC = b"\x1f\x8b\x08"
_READ = 1 << 18
_EMPTY_MEMBER = zlib.compressobj(1, zlib.DEFLATED, 31).flush()
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC record; a revisit keeps the HTTP header (with the full payload's length) and drops the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if url is not None:  # line ends would end the header
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    """gzip member(s) of a record, ending in a zero byte."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    packed = packer.compress(raw) + packer.flush()
    return packed if packed[-1] == 0 else packed + _EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write a record per row of (page_id, url, html) under ``path``.

    Of the rows with equal payloads of ``min_revisit_bytes`` or more, those with the smallest page_id
    are responses and the others revisit it.  A null html is an empty payload; a null page_id
    sorts after all others.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    first = (rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"))
    rows = rows.join(materialize(first, "warc_first"), "digest", "left")

    def run(batch):
        out = []
        for page_id, url, payload, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first"))):
            revisit = first is not None and first != page_id
            out.append(member(record(page_id, url, payload, first, revisit))[:-1])
        return {"value": out}

    packed = map_columns(rows.select("page_id", "url", "payload", "first"), run, "value binary")
    packed.select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def task_count(total_bytes: int, cores: int, split_bytes: int = SPLIT_BYTES, task_bytes: int = TASK_BYTES) -> int:
    """Tasks that the ranges are dealt to: of ``task_bytes`` each, smaller while that leaves cores idle, never under a range."""
    return max(1, -(-total_bytes // max(split_bytes, min(task_bytes, total_bytes // max(1, 4 * cores)))))


def byte_ranges(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(uri, size, start, end) of the archives under ``path`` and its subfolders, from file metadata, dealt to tasks."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.col("path").alias("uri"), F.col("length").alias("size")).where("size > 0"))  # contents are not read
    total = files.agg(F.sum("size")).first()[0] or 0
    ranges = files.select("uri", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes))).alias("start"))
    return (ranges.withColumn("end", F.least(F.col("start") + split_bytes, "size"))
            .repartition(task_count(total, spark.sparkContext.defaultParallelism, split_bytes)))


_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(uri: str) -> str:
    """A Hadoop file URI as Arrow's file systems name it."""
    scheme, found, rest = uri.partition(":")
    return f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}" if found else uri


def _open(uri: str):
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(re.sub(r"^file:/*", "/", uri))
    system, path = fs.FileSystem.from_uri(arrow_uri(uri))
    return system.open_input_file(path)


def _inflate(source, at: int, header_only: bool) -> tuple[bytes, int] | None:
    """Decoded member at ``at`` and the offset after it; None if it is no WARC record.

    With ``header_only`` decoding stops at the end of the record's header.
    """
    unpacker, parts, pos, seen = zlib.decompressobj(31), [], at, b""
    while not unpacker.eof:
        source.seek(pos)
        chunk = source.read(4096 if header_only else _READ)
        if not chunk:
            return None
        try:
            parts.append(unpacker.decompress(chunk))
        except zlib.error:
            return None
        pos += len(chunk)
        if header_only:
            seen += parts[-1]
            if not b"WARC/1.".startswith(seen[:7]) or len(seen) >= 7 and not re.match(rb"WARC/1\.\d\r\n", seen[:12].ljust(12)):
                return None
            if b"\r\n\r\n" in seen and b"WARC-Type:" in seen:
                return seen, pos
    return (b"".join(parts), pos - len(unpacker.unused_data)) if not header_only else None


class Damage(NamedTuple):
    """Bytes of a file that belong to no readable record, from ``offset``."""
    uri: str
    offset: int
    reason: str


def scan_range(uri: str, start: int, end: int, size: int) -> Iterator[bytes | Damage]:
    """Records whose member starts in [start, end) of a file of ``size`` bytes, and the damage between and after them."""
    with _open(uri) as source:
        at, due = start, 0 if start == 0 else None      # due: where the next member must start, if that is known
        while at < end:
            source.seek(at)
            window = source.read(min(_READ, end - at) + len(_MAGIC) - 1)
            hit = window.find(_MAGIC)
            if hit < 0 or at + hit >= end:
                at += max(1, len(window) - len(_MAGIC) + 1)
                continue
            at += hit
            if _inflate(source, at, header_only=True) is None:
                at += 1
                continue
            if due is not None and at > due:
                yield Damage(uri, due, "bytes of no record")
            if (got := _inflate(source, at, header_only=False)) is None:
                yield Damage(uri, at, "record does not decode")
                due = None
                at += 1
                continue
            yield got[0]
            at = due = _past_empty(source, got[1])
        if due is not None and (due < end or due < size and _inflate(source, due, header_only=True) is None):
            yield Damage(uri, due, "bytes of no record")


def read_range(uri: str, start: int, end: int) -> Iterator[bytes]:
    """Records whose member starts in [start, end), damage skipped."""
    return (r for r in scan_range(uri, start, end, end) if isinstance(r, bytes))


def _past_empty(source, at: int) -> int:
    """The offset after empty members at ``at`` (the writer's and other tools' padding)."""
    while True:
        source.seek(at)
        head = source.read(64)
        unpacker = zlib.decompressobj(31)
        try:
            if not head.startswith(_MAGIC) or unpacker.decompress(head) or not unpacker.eof:
                return at
        except zlib.error:
            return at
        at += len(head) - len(unpacker.unused_data)


def parse(raw: bytes) -> dict:
    """Fields of a response or revisit record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["WARC-Type"] == "revisit"
    length = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1]) if revisit else len(payload)
    number = lambda name: int(m[1]) if (m := re.search(r"urn:page:(\d+|-\d+)>", fields.get(name, ""))) else None
    return {"page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload": None if revisit else payload,
            "payload_bytes": length, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32_sha1(payload)}


def read_archives(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True,
                  on_damage: str = "raise") -> DataFrame:
    """Records under ``path``: page_id, url, record_type, refers_to, payload_bytes, payload_digest and, if asked for, payload.

    Damage raises with file and offset; with ``on_damage="skip"`` the records
    around it come back, and :func:`damages` lists it.
    """
    if on_damage not in ("raise", "skip"):
        raise ValueError("on_damage is raise or skip")
    bound_batches(spark)
    names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"] + ["payload"] * with_payload
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * with_payload

    def told(held):
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], t) for n, t in zip(names, types)], names=names)

    def run(batches):
        for batch in batches:
            for given in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "end", "size"))):
                held, size = [], 0
                for raw in scan_range(*given):
                    if isinstance(raw, Damage):
                        if on_damage == "raise":
                            raise ValueError(f"{raw.uri} at {raw.offset}: {raw.reason}")
                        continue
                    held.append(parse(raw))
                    size += len(raw)
                    if size > 1 << 23:
                        yield told(held)
                        held, size = [], 0
                yield told(held)

    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return byte_ranges(spark, path, split_bytes).mapInArrow(run, schema + ", payload binary" * with_payload)


def damages(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(file, offset, reason): every place under ``path`` where bytes belong to no readable record."""
    bound_batches(spark)

    def run(batches):
        for batch in batches:
            for given in zip(*(batch.column(c).to_pylist() for c in ("uri", "start", "end", "size"))):
                found = [d for d in scan_range(*given) if isinstance(d, Damage)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d[i] for d in found], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))],
                    names=["file", "offset", "reason"])

    return byte_ranges(spark, path, split_bytes).mapInArrow(run, "file string, offset long, reason string").distinct()


def round_trip(pages: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back without payloads.

    One row per row of ``pages``; repeated rows give repeated records; rows with equal
    payloads and the smallest page_id are all responses; other columns are ignored; an
    empty table gives no rows.
    """
    path = scratch_path(pages.sparkSession, "llm", "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path, split_bytes, with_payload=False)
