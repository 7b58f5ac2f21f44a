"""Token files in directly addressable codes (operator 11).

An id is cut into chunks from its low bits up.  Level k holds chunk k of every
id that has one, packed at a fixed width, and a bitmap telling which of them
continue on level k+1; a rank directory over the bitmap gives the place there.
Any token, or any run of tokens, is read by following those places: no block
is decoded.

A file is a sequence of segments written by one task, each of whole documents
in ascending order with its own levels, document directory and checksum.  The
files are written by Spark's text writer (its committer makes lost tasks
safe), whose line separator follows each segment.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from farebox.llm.common import bound_batches, materialize
from farebox.llm.words import word_encoder
from farebox.session import scratch_path

MAGIC = b"FBDAC001"
SEGMENT_IDS = 1 << 21    # a segment ends with the document that reaches it
FILE_SEGMENTS = 16
CELL_BITS = 21           # positions are matched to segments by cells of 2^21 ids
BLOCK = 512              # bits per entry of a rank directory
_HEAD = struct.Struct("<8sIIQQQB")   # magic, part, number in part, bytes, documents, ids, levels
_SLICE = 1 << 17
ENCODE_ROWS = 4096       # documents encoded together, of BATCH_BYTES at most


def choose_widths(lengths: np.ndarray) -> list[int]:
    """Chunk widths (low bits first) of least total size for ``lengths[b]`` ids of ``b`` bits, by dynamic programming."""
    top = max(1, int(np.flatnonzero(lengths).max()) if lengths.any() else 1)
    above = [int(lengths[b + 1:].sum()) if b else int(lengths.sum()) for b in range(top)]  # ids reaching past b bits
    best: dict[int, tuple[int, list[int]]] = {top: (0, [])}
    for at in range(top - 1, -1, -1):
        options = []
        for w in range(1, min(16, top - at) + 1):
            flag = 1 if at + w < top else 0
            options.append((above[at] * (w + flag) + best[at + w][0], [w, *best[at + w][1]]))
        best[at] = min(options)
    return best[0][1]


def _pack(values: np.ndarray, width: int) -> bytes:
    shifts = np.arange(width - 1, -1, -1, dtype=np.uint32)
    return b"".join(np.packbits(((values[at:at + _SLICE, None] >> shifts) & 1).astype(np.uint8)).tobytes()
                    for at in range(0, len(values), _SLICE))


class Level:
    """One level: packed chunks, continuation bitmap (none on the last) and its rank directory."""

    def __init__(self, n: int, width: int, chunks: bytes, bitmap: bytes | None, ranks: bytes | None):
        self.n, self.width = n, width
        self.chunks = np.frombuffer(chunks, np.uint8)
        self.bitmap = None if bitmap is None else np.frombuffer(bitmap, np.uint8)
        self.ranks = None if ranks is None else np.frombuffer(ranks, "<u4")

    def chunk_run(self, a: int, b: int) -> np.ndarray:
        w, first = self.width, a * self.width // 8
        bits = np.unpackbits(self.chunks[first:-(-b * w // 8)])[a * w - 8 * first:][:(b - a) * w].reshape(-1, w)
        return bits @ (np.uint32(1) << np.arange(w - 1, -1, -1, dtype=np.uint32))

    def chunk_at(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.width
        byte = bit >> 3
        last = len(self.chunks) - 1
        window = np.zeros(len(at), np.uint64)
        for k in range(3):
            window = (window << np.uint64(8)) | self.chunks[np.minimum(byte + k, last)].astype(np.uint64)
        shift = (24 - self.width - (bit & 7)).astype(np.uint64)
        return ((window >> shift) & np.uint64((1 << self.width) - 1)).astype(np.uint32)

    def bit_run(self, a: int, b: int) -> np.ndarray:
        first = a // 8
        return np.unpackbits(self.bitmap[first:-(-b // 8)])[a - 8 * first:][:b - a].astype(bool)

    def bit_at(self, at: np.ndarray) -> np.ndarray:
        return (self.bitmap[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each position: directory entry, whole bytes of its block, bits of the last byte."""
        block = at // BLOCK
        out = self.ranks[block].astype(np.int64)
        byte, step = at >> 3, BLOCK // 8
        for k in range(step):
            here = block * step + k
            inside = here < byte
            if not inside.any():
                break
            out[inside] += np.bitwise_count(self.bitmap[here[inside]])
        tail = (at & 7) > 0
        out[tail] += np.bitwise_count(self.bitmap[byte[tail]] >> (8 - (at[tail] & 7)).astype(np.uint8))
        return out


class Segment:
    """A segment's documents and ids; ``blob`` starts at its magic."""

    def __init__(self, blob: bytes | memoryview):
        magic, self.part, self.number, size, n_docs, self.n, levels = _HEAD.unpack_from(blob, 0)
        if magic != MAGIC or size > len(blob) or zlib.crc32(blob[:size - 4]) != struct.unpack_from("<I", blob, size - 4)[0]:
            raise ValueError("damaged token file segment")
        at = _HEAD.size
        widths = list(blob[at:at + levels])
        at += levels

        def take(nbytes: int) -> memoryview:
            nonlocal at
            at += nbytes
            return memoryview(blob)[at - nbytes:at]

        self.null = np.unpackbits(np.frombuffer(take(-(-n_docs // 8)), np.uint8))[:n_docs].astype(bool)
        self.doc_ids = np.frombuffer(take(8 * n_docs), "<i8")
        self.starts = np.frombuffer(take(8 * (n_docs + 1)), "<i8")
        self.levels = []
        n = self.n
        for k, w in enumerate(widths):
            chunks = take(-(-n * w // 8))
            if k + 1 < levels:
                bitmap, ranks = take(-(-n // 8)), take(4 * (n // BLOCK + 1))
                self.levels.append(Level(n, w, chunks, bitmap, ranks))
                n = int(np.bitwise_count(self.levels[-1].bitmap).sum(dtype=np.int64))
            else:
                self.levels.append(Level(n, w, chunks, None, None))

    def run(self, a: int, b: int) -> np.ndarray:
        """Ids of the places [a, b)."""
        out = np.zeros(b - a, np.uint32)
        places, shift = None, 0
        for level in self.levels:
            if a == b:
                break
            chunk = level.chunk_run(a, b).astype(np.uint32) << np.uint32(shift)
            if places is None:
                out |= chunk
            else:
                out[places] |= chunk
            if level.bitmap is None:
                break
            more = level.bit_run(a, b)
            places = np.flatnonzero(more) if places is None else places[more]
            a = int(level.rank(np.array([a]))[0])
            b, shift = a + int(more.sum()), shift + level.width
        return out

    def at(self, places: np.ndarray) -> np.ndarray:
        """Ids at any places, each by one lookup a level."""
        places = np.asarray(places, np.int64)
        out = np.zeros(len(places), np.uint32)
        todo, shift = np.arange(len(places)), 0
        for level in self.levels:
            if not len(todo):
                break
            out[todo] |= level.chunk_at(places) << np.uint32(shift)
            if level.bitmap is None:
                break
            more = level.bit_at(places)
            todo, places, shift = todo[more], level.rank(places[more]), shift + level.width
        return out


def build_segment(part: int, number: int, doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    ids = np.asarray(ids, np.uint32)
    lengths = np.bincount(np.ceil(np.log2(ids.astype(np.float64) + 1)).astype(np.int64), minlength=2)
    widths = choose_widths(lengths)
    body = [bytes(widths), np.packbits(np.array([d is None for d in doc_ids], bool)).tobytes(),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.append(0, np.cumsum(counts)).astype("<i8").tobytes()]
    rest = ids
    for k, w in enumerate(widths):
        body.append(_pack(rest & np.uint32((1 << w) - 1), w))
        if k + 1 < len(widths):
            more = rest >> np.uint32(w) != 0
            bitmap = np.packbits(more)
            counted = np.bitwise_count(np.pad(bitmap, (0, -len(bitmap) % (BLOCK // 8)))).reshape(-1, BLOCK // 8)
            ranks = np.append(0, np.cumsum(counted.sum(axis=1, dtype=np.int64)))[:len(rest) // BLOCK + 1]
            body += [bitmap.tobytes(), ranks.astype("<u4").tobytes()]
            rest = rest[more] >> np.uint32(w)
    size = _HEAD.size + sum(map(len, body)) + 4
    blob = _HEAD.pack(MAGIC, part, number, size, len(doc_ids), len(ids), len(widths)) + b"".join(body)
    return blob + struct.pack("<I", zlib.crc32(blob))


def segment_at(content: memoryview, at: int) -> tuple[Segment, int]:
    """The segment at an offset of a file, and its size."""
    size = _HEAD.unpack_from(content, at)[3] if len(content) - at >= _HEAD.size else 0
    if size < _HEAD.size:
        raise ValueError("damaged token file segment")
    return Segment(content[at:at + size]), size


def segments(content: bytes) -> Iterator[tuple[int, Segment]]:
    """(offset, segment) of a file."""
    at, view = 0, memoryview(content)
    while at < len(view):
        segment, size = segment_at(view, at)
        yield at, segment
        at += size + 1  # the writer's separator


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Encode ``text`` of every row and write token files under ``path`` in ascending doc_id order (null first).

    One shuffle, of the documents by ranges of (doc_id, text hash, row): a
    doc_id that many rows share is spread over tasks, its rows ordered by
    text hash.  Null and empty texts hold the end id only.
    """
    spark = docs.sparkSession
    bound_batches(spark, ENCODE_ROWS)
    shared = word_encoder(spark, tokenizer_path, end_id)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = keyed.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
    keys = ("doc_id", "h", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        doc_ids, counts, ids, held = [], [], [], 0

        def emit():
            blob = build_segment(part, number, doc_ids, np.concatenate(counts), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["segment"])

        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, len(names), ENCODE_ROWS):
                got, n = shared.value.encode(texts.slice(at, ENCODE_ROWS))
                ends, some, a = np.cumsum(n), names[at:at + ENCODE_ROWS], 0
                while a < len(n):
                    before = int(ends[a] - n[a])
                    b = min(len(n), a + 1 + int(np.searchsorted(ends[a:] - before, SEGMENT_IDS - held)))
                    doc_ids += some[a:b]
                    counts.append(n[a:b])
                    ids.append(got[before:ends[b - 1]])
                    held += len(ids[-1])
                    a = b
                    if held >= SEGMENT_IDS:
                        yield emit()
                        number += 1
                        doc_ids, counts, ids, held = [], [], [], 0
        if doc_ids:
            yield emit()

    files = (keyed.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
             .mapInArrow(run, "segment binary"))
    (files.select(F.col("segment").cast("string").alias("value")).write
     .option("lineSep", "\n").option("maxRecordsPerFile", FILE_SEGMENTS).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
            .select("path", "content"))


def _map_segments(spark: SparkSession, path: str, fn, schema: str) -> DataFrame:
    """Rows ``fn(path, offset, segment)`` (columns by name) of every segment."""
    bound_batches(spark)
    target = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column("path")[i].as_py()
                for offset, segment in segments(batch.column("content")[i].as_py()):
                    out = fn(name, offset, segment)
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return _files(spark, path).mapInArrow(run, target)


def _bases(counts: DataFrame) -> DataFrame:
    """(part, number, n_ids) -> with ``base``: ids before the segment, by sums within parts and over them.

    Parts are the writing tasks (at most tens of thousands of rows in the outer window).
    """
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), zero).alias("part_base"))
    return (counts.withColumn("inner", F.coalesce(F.sum("n_ids").over(inside), zero)).join(parts, "part")
            .select(*counts.columns, (F.col("part_base") + F.col("inner")).alias("base")))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment: path, offset, part, number, n_docs, n_ids, base (ids before it)."""
    rows = _map_segments(
        spark, path, lambda name, offset, s: {"path": [name], "offset": [offset], "part": [s.part], "number": [s.number],
                                              "n_docs": [len(s.doc_ids)], "n_ids": [s.n]},
        "path string, offset long, part int, number int, n_docs long, n_ids long")
    return materialize(_bases(materialize(rows, "dac_segments")), "dac_manifest")


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked for, ids."""
    def documents(name, offset, s):
        ids = s.run(0, s.n).astype("<u4")
        data, ends = memoryview(ids.tobytes()), s.starts.tolist()
        out = {"part": np.full(len(s.doc_ids), s.part), "number": np.full(len(s.doc_ids), s.number),
               "doc_id": pa.array(s.doc_ids, mask=s.null), "at": s.starts[:-1], "n_tokens": np.diff(s.starts),
               "ids_crc32": [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends, ends[1:])]}
        if with_ids:
            out["ids"] = [ids[a:b].astype(np.int32) for a, b in zip(ends, ends[1:])]
        return out

    schema = "part int, number int, doc_id long, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    docs = materialize(_map_segments(spark, path, documents, schema), "dac_documents")
    bases = _bases(docs.groupBy("part", "number").agg(F.sum("n_tokens").alias("n_ids"))).select("part", "number", "base")
    return docs.join(bases, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position) -> (position, token): ids at global places, read by random access.

    A position meets its segment by an equi-join on cells of 2^21 places; the
    places asked of one segment go to it in lists of at most 65,536, so a
    segment asked for often is split.  Repeated positions give one row;
    places outside the files give none.
    """
    stored = manifest(spark, path).where("n_ids > 0")
    last = F.col("base") + F.col("n_ids") - 1
    cells = stored.select("path", "offset", "base", last.alias("last"), F.explode(F.sequence(
        F.shiftright("base", CELL_BITS), F.shiftright(last, CELL_BITS))).alias("cell"))
    asked = positions.select(F.col("position").cast("long").alias("position")).where("position IS NOT NULL").distinct()
    found = (asked.withColumn("cell", F.shiftright("position", CELL_BITS)).join(cells, "cell")
             .where("position BETWEEN base AND last")
             .groupBy("path", "offset", "base", F.shiftright("position", 16).alias("run"))
             .agg(F.collect_list("position").alias("positions")))
    found = found.groupBy("path", "run").agg(F.collect_list(F.struct("offset", "base", "positions")).alias("asked"))
    bound_batches(spark)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                content = memoryview(batch.column("content")[i].as_py())
                for a in batch.column("asked")[i].as_py():
                    segment, _ = segment_at(content, a["offset"])
                    at = np.array(a["positions"], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(at), pa.array(segment.at(at - a["base"]).astype(np.int64))], names=["position", "token"])

    return _files(spark, path).join(found, "path").select("content", "asked").mapInArrow(run, "position long, token long")


def token_file_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read the documents back (without ids).

    One row per row: repeated rows and doc_ids are documents of their own
    (equal doc_ids in order of a text hash); null doc_ids come first; null and
    empty texts hold the end id only; other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "llm", "dac")
    write_tokens(docs, path, tokenizer_path, end_id)
    return read_documents(spark, path, with_ids=False)
