"""Byte-level BPE encoding and decoding (operator 6).

Two tiers.  A minimal perfect hash over the vocabulary (hash and displace)
resolves pre-tokens that are whole tokens; the rest are merged lowest rank
first with a heap over a doubly linked list of bytes.  The vocabulary and the
hash (bounded by the rank file) are built once on the driver and broadcast.
Texts are cut at lone spaces into chunks whose pre-tokens do not depend on
their neighbours; a task resolves a batch's new chunks together and keeps a
bounded table of resolved ones.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import re

import numpy as np
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.common import map_columns

MEMO_CHUNKS = 300_000    # resolved chunks kept by a Python worker between batches, of
MEMO_KEY = 64            # characters at most (lines without white space are resolved again in the next batch)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_WIDE_GAP = re.compile(r" \s|\s ")


def read_ranks(spark: SparkSession, path: str) -> list[bytes]:
    """Tokens by id from a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * (1 + max(int(r) for _, r in rows))
    for token, rank in rows:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PerfectHash:
    """Minimal perfect hash: key's bucket gives a displacement, which gives its own slot of len(keys)."""

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.buckets = max(1, self.n // 4)
        seed = 0
        while not self._place(keys, seed):
            seed += 1

    @staticmethod
    def hashes(keys: list[bytes], seed: int) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(k, seed) for k in keys), dtype=np.uint64, count=len(keys))

    def _slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        mixed = (h ^ (d.astype(np.uint64) * _C1)) * _C2
        return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(self.n)).astype(np.int64)

    def _place(self, keys: list[bytes], seed: int) -> bool:
        self.seed = seed
        h = self.hashes(keys, seed)
        if len(np.unique(h)) < self.n:
            return False
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sizes = np.bincount(bucket, minlength=self.buckets)
        ends = np.cumsum(sizes)
        self.shift = np.zeros(self.buckets, dtype=np.int64)
        self.key_at = np.full(self.n, -1, dtype=np.int64)
        for b in np.argsort(-sizes, kind="stable").tolist():
            if sizes[b] < 2:
                break
            members = order[ends[b] - sizes[b]:ends[b]]
            for base in range(0, 1 << 20, 64):
                tries = self._slots(h[members][None, :], np.arange(base, base + 64)[:, None])
                ok = (self.key_at[tries] < 0).all(axis=1)
                ok &= (np.diff(np.sort(tries, axis=1), axis=1) > 0).all(axis=1)
                if ok.any():
                    t = int(np.argmax(ok))
                    self.shift[b] = base + t
                    self.key_at[tries[t]] = members
                    break
            else:
                return False
        free = iter(np.flatnonzero(self.key_at < 0).tolist())
        for b in np.flatnonzero(sizes == 1).tolist():  # lone keys take the free slots directly
            slot = next(free)
            self.shift[b] = -1 - slot
            self.key_at[slot] = order[ends[b] - 1]
        return True

    def candidates(self, keys: list[bytes]) -> np.ndarray:
        """The one key index each argument could be; callers compare the key itself."""
        h = self.hashes(keys, self.seed)
        shift = self.shift[(h % np.uint64(self.buckets)).astype(np.int64)]
        return self.key_at[np.where(shift < 0, -1 - shift, self._slots(h, np.maximum(shift, 0)))]


def merge_bytes(piece: bytes, rank: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one pre-token: always the lowest-ranked adjacent pair first, the leftmost on ties."""
    n = len(piece)
    end = list(range(1, n + 1))          # node i covers piece[i:end[i]]; its successor starts at end[i]
    before = list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != stop:
            continue                      # one of the two nodes has merged meanwhile
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := rank.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := rank.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(rank[piece[i:end[i]]])
        i = end[i]
    return tuple(out)


class Codec:
    """Encoder and decoder over a vocabulary (all 256 bytes must be tokens)."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, pattern
        self.ids = [i for i, t in enumerate(tokens) if t]
        self.known = PerfectHash([tokens[i] for i in self.ids])
        self._start()

    def _start(self):
        self.split = regex.compile(self.pattern).findall
        self.rank = {self.tokens[i]: i for i in self.ids}
        self.inner: dict[str, tuple[int, ...]] = {}   # chunk that follows a space -> ids with that space
        self.merged: dict[bytes, tuple[int, ...]] = {}   # pre-token -> ids
        self.long: list[str | bytes] = []                # keys of either that go with the batch

    def __getstate__(self):
        return {"tokens": self.tokens, "pattern": self.pattern, "ids": self.ids, "known": self.known}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def _resolve(self, texts: list[str]) -> list[tuple[int, ...]]:
        pieces = [[p.encode() for p in self.split(t)] for t in texts]
        found = self.merged
        new = list(set(itertools.chain.from_iterable(pieces)).difference(found))
        if new:
            self.long += [p for p in new if len(p) > MEMO_KEY]
            for piece, k in zip(new, self.known.candidates(new).tolist()):
                token = self.ids[k]
                found[piece] = (token,) if self.tokens[token] == piece else merge_bytes(piece, self.rank)
        return [tuple(itertools.chain.from_iterable([found[p] for p in ps])) for ps in pieces]

    def _parts(self, texts: list[str | None]) -> tuple[list[list[str]], dict[str, tuple[int, ...]]]:
        """Chunks of each text, all of them resolved: the first in the returned table, the others in ``inner``."""
        if len(self.inner) > MEMO_CHUNKS:
            self.inner = {}
        if len(self.merged) > MEMO_CHUNKS:
            self.merged = {}
        for key in self.long:
            (self.inner if isinstance(key, str) else self.merged).pop(key, None)
        self.long = []
        parts = [[t or ""] if not t or _WIDE_GAP.search(t) else t.split(" ") for t in texts]
        missing = list(set(itertools.chain.from_iterable(p[1:] for p in parts)).difference(self.inner))
        self.long += [c for c in missing if len(c) > MEMO_KEY]
        for at in range(0, len(missing), 65536):
            some = missing[at:at + 65536]
            self.inner.update(zip(some, self._resolve([" " + c for c in some])))
        heads = list({p[0] for p in parts})
        return parts, dict(zip(heads, self._resolve(heads)))

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text (null: none)."""
        parts, solo = self._parts(texts)
        lookup = self.inner.__getitem__
        return [[*solo[p[0]], *itertools.chain.from_iterable(map(lookup, p[1:]))]
                for p in parts]

    def count_batch(self, texts: list[str | None]) -> list[int]:
        """Number of ids of each text."""
        parts, solo = self._parts(texts)
        lookup = self.inner.__getitem__
        return [len(solo[p[0]]) + sum(map(len, map(lookup, p[1:]))) for p in parts]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def codec(spark: SparkSession, path: str, pattern: str):
    """Broadcast codec of a rank file (bounded by the vocabulary)."""
    return spark.sparkContext.broadcast(Codec(read_ranks(spark, path), pattern))


def encode(docs: DataFrame, path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (if asked for), ids_sha256, decoded_sha256.

    Null and empty texts have no ids (hashes of the empty string); null doc_ids,
    repeated rows and very long texts are rows like any other; other columns are
    ignored; an empty table gives none.
    """
    shared = codec(docs.sparkSession, path, pattern)

    def run(batch):
        c = shared.value
        names = list(map(str, range(len(c.tokens)))) if not hasattr(c, "names") else c.names
        c.names = names
        out = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        texts = batch.column("text").to_pylist()
        for at in range(0, len(texts), 64):
            for ids in c.encode_batch(texts[at:at + 64]):
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(c.decode(ids)).hexdigest())
                if with_ids:
                    out["ids"].append(np.array(ids, dtype=np.int32))
        return out

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_columns(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                       schema + (", ids array<int>" if with_ids else ""))


def token_counts(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(n_tokens) per row of ``docs``."""
    shared = codec(docs.sparkSession, path, pattern)

    def run(batch):
        texts = batch.column("text").to_pylist()
        return {"n_tokens": [n for at in range(0, len(texts), 64) for n in shared.value.count_batch(texts[at:at + 64])]}

    return map_columns(docs.select("text"), run, "n_tokens long")
