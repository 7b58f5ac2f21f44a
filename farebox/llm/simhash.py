"""SimHash near-dedup (operator 10): fingerprints, binary trie self-join, components.

Fingerprints are computed per document in Arrow batches (xxHash64 of word
shingles, bit counts in numpy).  Equal fingerprints collapse to one node before
any pairing.  The distinct fingerprints are range-sorted into pages that share
a top prefix; pages whose prefixes differ in at most ``max_bits`` bits are
joined by equality on the (masked) prefix, and a task walks the two pages'
binary tries together, adding differing bits per level and cutting a pair of
nodes once the sum exceeds the budget.  A task returns a spanning forest of the
links it found (no more rows than fingerprints in the two pages), which keeps
every connection without emitting all pairs of a group.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import map_columns, materialize, words
from farebox.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
PAGE_ROWS = 4096
HASH_SEED = 42
STEP = 4                      # trie levels are walked four bits at a time
_FRONTIER = 1 << 19           # node pairs expanded at once in a task


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of one text; 0 where it has no word."""
    w = words(text.translate(_LOWER) if text else text)
    if not w:
        return 0
    joined = b" ".join(w)
    digest = xxhash.xxh64_intdigest
    if len(w) < shingle_words:
        return digest(joined, HASH_SEED)
    lengths = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(w) - shingle_words + 1
    hashes = np.fromiter(
        (digest(joined[a:b], HASH_SEED) for a, b in zip(starts[:n].tolist(), ends[shingle_words - 1:].tolist())),
        dtype=np.uint64, count=n)
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 65536):
        part = hashes[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_bits > n)
    return int.from_bytes(bits.tobytes(), "big")


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp): one row per row of ``docs``; ``fp`` is the fingerprint as a signed long,
    ``text_key`` a hash of the whole text that tells apart rows repeating a doc_id."""

    def run(batch):
        fps = np.array([fingerprint(t, shingle_words) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        return {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "fp": fps.view(np.int64)}

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return map_columns(narrow, run, "doc_id long, text_key long, fp long")


def _levels(values: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Per trie level: the nodes' first rows, nibbles, and their children's range on the next level."""
    firsts = []
    for depth in range(0, 64 + STEP, STEP):
        keys = values >> np.uint64(64 - depth) if depth else np.zeros_like(values)
        firsts.append(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])))
    out = []
    for k, first in enumerate(firsts):
        nibble = ((values[first] >> np.uint64(64 - STEP * k)) & np.uint64(15)).astype(np.uint8) if k else None
        if k + 1 < len(firsts):
            lo = np.searchsorted(firsts[k + 1], first)
            hi = np.append(lo[1:], len(firsts[k + 1]))
        else:
            lo = hi = None
        out.append((first, nibble, lo, hi))
    return out


_ONES = np.array([bin(i).count("1") for i in range(16)], dtype=np.uint8)


def trie_links(a: np.ndarray, b: np.ndarray | None, max_bits: int):
    """Walk two tries (or one with itself) together; yields (rows of a, rows of b) of linked fingerprints.

    ``a`` and ``b`` are sorted and free of repeats.  The stack holds frontiers of node
    pairs, deepest first, each cut into bounded pieces, so memory does not grow
    with the number of links.
    """
    left = _levels(a)
    right = left if b is None else _levels(b)
    start = np.zeros(1, dtype=np.int64)
    stack = [(0, start, start, np.zeros(1, dtype=np.uint8))]
    while stack:
        level, x, y, diff = stack.pop()
        if level == 64 // STEP:
            if b is None:
                proper = x < y
                x, y = x[proper], y[proper]
            if len(x):
                yield x, y
            continue
        _, _, xlo, xhi = left[level]
        _, _, ylo, yhi = right[level]
        nx, ny = xhi[x] - xlo[x], yhi[y] - ylo[y]
        sizes = nx * ny
        if len(x) > 1 and sizes.sum() > _FRONTIER:
            half = len(x) // 2
            stack.append((level, x[:half], y[:half], diff[:half]))
            stack.append((level, x[half:], y[half:], diff[half:]))
            continue
        pair = np.repeat(np.arange(len(x)), sizes)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        cx = xlo[x][pair] + within // ny[pair]
        cy = ylo[y][pair] + within % ny[pair]
        d = diff[pair] + _ONES[left[level + 1][1][cx] ^ right[level + 1][1][cy]]
        keep = d <= max_bits
        if b is None:
            keep &= cx <= cy
        if keep.any():
            stack.append((level + 1, cx[keep], cy[keep], d[keep]))


def spanning_forest(values: np.ndarray, links) -> tuple[np.ndarray, np.ndarray]:
    """Fewest (value, value) edges that connect what ``links`` (index arrays) connect."""
    parent = np.arange(len(values))
    for x, y in links:
        while True:
            px, py = parent[x], parent[y]
            apart = px != py
            if not apart.any():
                break
            x, y, px, py = x[apart], y[apart], px[apart], py[apart]
            np.minimum.at(parent, np.maximum(px, py), np.minimum(px, py))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
    moved = np.flatnonzero(parent != np.arange(len(values)))
    return values[moved], values[parent[moved]]


def prefix_bits(distinct: int, page_rows: int = PAGE_ROWS) -> int:
    """Top trie depth at which an even spread gives about one page per node."""
    return 0 if distinct <= page_rows else min(20, math.ceil(math.log2(distinct / page_rows)))


def trie_self_join(distinct: DataFrame, max_bits: int = MAX_BITS, page_rows: int = PAGE_ROWS) -> DataFrame:
    """(fp) distinct fingerprints -> (src, dst) edges connecting all that differ in at most ``max_bits`` bits."""
    bits = prefix_bits(distinct.count(), page_rows)

    def paged(batches):
        import pyarrow as pa

        def rows(values):
            tops = values >> np.uint64(64 - bits) if bits else np.zeros_like(values)
            cuts = np.flatnonzero(np.concatenate([[True], tops[1:] != tops[:-1], [True]]))
            out = {"page": [], "prefix": [], "fps": []}
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                for at in range(lo, hi, page_rows):
                    blob = values[at:min(at + page_rows, hi)]
                    out["page"].append(int(blob[:1].view(np.int64)[0]))
                    out["prefix"].append(int(tops[lo]))
                    out["fps"].append(blob.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(out["page"], pa.int64()), pa.array(out["prefix"], pa.int64()),
                 pa.array(out["fps"], pa.binary())], names=["page", "prefix", "fps"])

        held = np.empty(0, dtype=np.uint64)
        for batch in batches:  # in unsigned order; the unfinished top prefix waits for the next batch
            held = np.concatenate([held, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(held) >= 16 * page_rows:
                top = held >> np.uint64(64 - bits) if bits else np.zeros_like(held)
                done = int(np.searchsorted(top, top[-1]))
                done = done if done else len(held) // page_rows * page_rows
                yield rows(held[:done])
                held = held[done:]
        if len(held):
            yield rows(held)

    unsigned_order = F.col("fp").bitwiseXOR(F.lit(-(1 << 63)))
    pages = materialize(
        distinct.repartitionByRange(unsigned_order).sortWithinPartitions(unsigned_order)
        .mapInArrow(paged, "page long, prefix long, fps binary"), "trie_pages")

    masks = [0] + [1 << i for i in range(bits)] if max_bits else [0]
    for _ in range(max_bits - 1):
        masks = sorted({m | (1 << i) for m in masks for i in range(bits)} | set(masks))
    index = pages.select("page", "prefix")
    near = index.select(F.col("page").alias("page_a"), "prefix",
                        F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("mask"))
    pairs = (near.select("page_a", F.col("prefix").bitwiseXOR(F.col("mask")).alias("prefix"))
             .join(index.withColumnRenamed("page", "page_b"), "prefix").where("page_a <= page_b")
             .select("page_a", "page_b"))
    work = (pairs.join(pages.select(F.col("page").alias("page_a"), F.col("fps").alias("a")), "page_a")
            .join(pages.select(F.col("page").alias("page_b"), F.col("fps").alias("b")), "page_b"))

    def walk(batch):
        src, dst = [], []
        for pa_, pb, fa, fb in zip(*(batch.column(c).to_pylist() for c in ("page_a", "page_b", "a", "b"))):
            a = np.frombuffer(fa, dtype=np.uint64)
            if pa_ == pb:
                s, d = spanning_forest(a, trie_links(a, None, max_bits))
            else:
                b = np.frombuffer(fb, dtype=np.uint64)
                s, d = spanning_forest(np.concatenate([a, b]),
                                       ((x, y + len(a)) for x, y in trie_links(a, b, max_bits)))
            src.append(s.view(np.int64))
            dst.append(d.view(np.int64))
        return {"src": np.concatenate(src), "dst": np.concatenate(dst)} if src else None

    return map_columns(work, walk, "src long, dst long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id, keep_id, keep_key) per row of ``docs``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, (keep_id, keep_key) the row that stands for the
    group.  Null or wordless texts have fingerprint zero and link like any
    other; rows with a null doc_id take part but never give the id (a group of
    null ids only has a null one); repeated rows and ties get equal results; an
    empty table gives none; other columns are ignored.
    """
    fps = materialize(fingerprints(docs, shingle_words), "simhash_fps")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    nodes = materialize(fps.groupBy("fp").agg(first), "simhash_nodes")
    comps = connected_components(trie_self_join(nodes.select("fp"), max_bits))
    member = (nodes.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first", F.coalesce("component", "fp").alias("component")))
    heads = member.groupBy("component").agg(F.min("first").alias("head"))
    classes = member.join(heads, "component").select("fp", "head")
    return (fps.join(classes, "fp")
            .select("doc_id", "text_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("head.doc_id").alias("component_id"), F.col("head.doc_id").alias("keep_id"),
                    F.col("head.text_key").alias("keep_key")))


def deduplicate(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` per near-duplicate group, all columns kept (smallest doc_id; one of fully repeated rows)."""
    keys = (near_duplicates(docs, shingle_words, max_bits)
            .select(F.col("keep_id").alias("__llm_id"), F.col("keep_key").alias("__llm_key")).distinct())
    tagged = docs.withColumn("__llm_row_id", F.col("doc_id").cast("long")).withColumn("__llm_row_key", F.xxhash64("text"))
    kept = tagged.join(keys, F.col("__llm_row_id").eqNullSafe(F.col("__llm_id"))
                       & (F.col("__llm_row_key") == F.col("__llm_key")), "left_semi")
    return (kept.dropDuplicates(["__llm_row_id", "__llm_row_key"]).drop("__llm_row_id", "__llm_row_key"))
