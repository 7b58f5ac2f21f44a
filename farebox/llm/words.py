"""Encoding with a word tokenizer of the tokenizers library that drops white space (used by operator 11).

Such a tokenizer (lower case, white space removed, no piece across a space)
gives a text the ids of its space-separated chunks one after the other, so a
batch is split, its distinct chunks are encoded once and their ids are laid out
by index arithmetic.  Chunks already seen by the Python worker come from a
table bounded by bytes.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

MEMO_BYTES = 192 * 1024 * 1024
MEMO_KEY = 64            # longer chunks (no white space: base64, CJK lines) are encoded where they occur
_ENTRY = 200             # bytes of a table entry besides key and ids, measured
_JOINED = 32 * 1024      # characters given to the library at once
_MARKS = r"\p{M}|<\|"    # NFC may join a mark to a letter, and special tokens are case sensitive: not lower-cased here
# U+0130 is left out: lower-casing adds a mark to it, which would join the run
_TRAIL = r"([a-z0-9\x{C0}-\x{12F}\x{131}-\x{24F}])([.,;:!?]+)( |$)"


class WordEncoder:
    """Ids of texts, each followed by ``end_id``; equal to the library's ``encode(text, add_special_tokens=False)``."""

    def __init__(self, definition: str, end_id: int):
        self.definition, self.end_id = definition, end_id
        self._start()
        zero = self.tokenizer.encode("0", add_special_tokens=False).ids
        probe = self.tokenizer.encode("ab 0 Cd.", add_special_tokens=False).ids
        if len(zero) != 1 or probe != self._one("ab") + zero + self._one("cd") + self._one("."):
            raise ValueError("not a lower-casing word tokenizer that drops white space")
        self.mark = zero[0]

    def _start(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.definition)
        self.memo: dict[str, bytes] = {"": b""}
        self.memo_bytes = 0

    def __getstate__(self):
        return {"definition": self.definition, "end_id": self.end_id, "mark": self.mark}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._start()

    def _one(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word: joined by the lone digit 0, whose id separates them; words with that digit singly."""
        out = {w: np.array(self._one(w), "<u4").tobytes() for w in words if "0" in w}
        plain = [w for w in words if "0" not in w]
        groups, size = [[]], 0
        for w in plain:
            if size > _JOINED:
                groups.append([])
                size = 0
            groups[-1].append(w)
            size += len(w) + 3
        found = self.tokenizer.encode_batch_fast([" 0 ".join(g) for g in groups if g], add_special_tokens=False)
        for group, enc in zip((g for g in groups if g), found):
            ids = np.array(enc.ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
            starts = np.append(0, ends[:-1] + 1)
            data = ids.tobytes()
            for w, a, b in zip(group, (4 * starts).tolist(), (4 * ends).tolist()):
                out[w] = data[a:b]
        return out

    def _chunks(self, distinct: list[str]) -> list[bytes]:
        if self.memo_bytes > MEMO_BYTES:
            self.memo, self.memo_bytes = {"": b""}, 0
        memo = self.memo
        missing = [c for c in distinct if c not in memo]
        if not missing:
            return [memo[c] for c in distinct]
        fresh = self._encode(missing)
        keep = fresh if len(max(missing, key=len)) <= MEMO_KEY else {k: v for k, v in fresh.items() if len(k) <= MEMO_KEY}
        memo.update(keep)
        self.memo_bytes += _ENTRY * len(keep) + 2 * sum(map(len, keep)) + sum(map(len, keep.values()))
        return [memo[c] if c in memo else fresh[c] for c in distinct]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids per text), end ids included; null texts are empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        spaced = pc.replace_substring(texts, "\n", " ")
        marked = pc.match_substring_regex(texts, _MARKS)
        spaced = pc.if_else(marked, spaced, pc.ascii_lower(spaced))
        # a final run of marks is a piece of its own after a letter or digit: one chunk more, far fewer distinct ones
        lists = pc.split_pattern(pc.replace_substring_regex(spaced, _TRAIL, "\\1 \\2\\3"), " ")
        coded = lists.flatten().dictionary_encode()
        ids = self._chunks(coded.dictionary.to_pylist())
        starts = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4, out=starts[1:])
        by_chunk = pa.LargeListArray.from_arrays(starts, np.frombuffer(b"".join(ids), "<u4"))
        taken = by_chunk.take(coded.indices)
        bounds = taken.offsets.to_numpy()[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        counts = np.diff(bounds) + 1
        out = np.full(int(bounds[-1]) + len(counts), self.end_id, "<u4")
        keep = np.ones(len(out), bool)
        keep[np.cumsum(counts) - 1] = False
        out[keep] = taken.flatten().to_numpy()
        return out, counts


def word_encoder(spark: SparkSession, path: str, end_id: int):
    """Broadcast encoder of a tokenizer file (bounded by the vocabulary; built once per Python worker)."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(WordEncoder(f.read(), end_id))
