"""Quality rules by tokeniser fertility (operator 2).

Base rules count words, symbols, repeated lines and repeated word windows.
The method tokenises every text with two public vocabularies and measures
characters per token, byte-fallback share and token entropy.  Rejection bands are set per
language (or script, where no language is given) and length class: a text is
rejected where a measure leaves the band around the group's median, in units of
the spread between its 10th and 90th percentile, both taken over all distinct texts that
pass the base rules (a text that is copied counts once).  Few texts say little about
their median: with n distinct texts, the band of a cell is drawn to that of its
group by 1 / (1 + (SMALL / n)^2), and that of a group, which is never judged by other
languages, is widened by 1 + (SMALL / n)^2, so that the smallest are left to the base
rules and no verdict jumps at a count.
"""

from __future__ import annotations

import base64
import unicodedata
from itertools import chain

import numpy as np
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import map_columns, materialize
from farebox.operators.enrich import checked_broadcast

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
MEMO_WORDS = 500_000        # words kept by a Python worker between batches, of
MEMO_KEY = 64               # bytes at most (lines without white space are tokenised again in the next batch)
SMALL = 50                  # distinct texts at which a cell's band is half its group's, and a group's band twice as wide
# Measure -> (lowest, highest, least spread): band in spreads around the median.
BANDS = {"chars_per_token": (-1.2, 4.0, 0.05), "chars_per_token_2": (-1.6, 5.0, 0.05),
         "byte_share": (-9.0, 5.0, 0.005), "token_entropy": (-0.95, 6.0, 0.1)}
_SPACE = " \t\n\r\x0b\x0c"


class Fertility:
    """Per-text measures; the words of each vocabulary are tokenised once per worker (bounded table)."""

    def __init__(self, piece_model: bytes, ranks: bytes, pattern: str):
        self.args = (piece_model, ranks, pattern)
        self.pieces = None

    def __getstate__(self):
        return self.args

    def __setstate__(self, args):
        self.__init__(*args)

    def _load(self):
        model, ranks, pattern = self.args
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.vocab_size())])
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.second = tiktoken.Encoding("second", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.long: list[bytes] = []
        self.memo: dict[bytes, tuple[bytes, int]] = {}  # word -> piece ids (16 bits each), length in the second vocabulary

    @staticmethod
    def base(text: str) -> tuple[dict[str, float], np.ndarray, list[bytes]]:
        """Base counts, the number of each word's first equal, and the distinct words in that order."""
        w = text.encode().split()
        distinct = list(dict.fromkeys(w))
        number = dict(zip(distinct, range(len(distinct))))
        codes = np.fromiter(map(number.__getitem__, w), dtype=np.int64, count=len(w))
        repeated = 0
        if len(w) > 2:
            # windows as numbers: pairs first, so that the products stay small for any vocabulary
            _, pair = np.unique(codes[:-1] * len(number) + codes[1:], return_inverse=True)
            _, window, count = np.unique(pair[:-1] * len(number) + codes[2:], return_inverse=True, return_counts=True)
            twice = count[window] > 1
            if twice.any():
                inside = np.zeros(len(w), dtype=bool)
                for k in range(3):
                    inside[k:len(w) - 2 + k] |= twice
                repeated = int(inside.sum())
        lines = [x for x in text.split("\n") if x.strip(_SPACE)]
        return ({"n_words": len(w), "word_chars": len(text) - sum(map(text.count, _SPACE)),
                 "n_symbols": sum(map(text.count, SYMBOLS)), "n_dup_lines": len(lines) - len(set(lines)),
                 "n_repeat_words": repeated}, codes, distinct)

    def _learn(self, new: list[bytes]) -> None:
        """Tokenise words with both vocabularies."""
        plain = [x.decode() for x in new]
        encode = self.second.encode_ordinary
        for x, word, ids in zip(new, plain, self.pieces.encode(plain, num_threads=1)):
            self.memo[x] = (np.array(ids, dtype=np.uint16).tobytes(), len(encode(" " + word)))

    def measure(self, texts: list[str | None]) -> list[dict[str, float]]:
        """Counts and measures of each text of a batch."""
        if self.pieces is None:
            self._load()
        parts = [self.base(t or "") for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        for word in self.long:
            self.memo.pop(word, None)
        new = list(set(chain.from_iterable(d for _, _, d in parts)).difference(self.memo))
        self.long = [word for word in new if len(word) > MEMO_KEY]
        for at in range(0, len(new), 65536):
            self._learn(new[at:at + 65536])
        return [self._fertility(*part) for part in parts]

    def _fertility(self, out: dict[str, float], codes: np.ndarray, distinct: list[bytes]) -> dict[str, float]:
        out |= {"chars_per_token": 0.0, "chars_per_token_2": 0.0, "byte_share": 0.0, "token_entropy": 0.0, "n_pieces": 0}
        if not distinct:
            return out
        ids, second = zip(*map(self.memo.__getitem__, distinct))
        count = np.bincount(codes, minlength=len(distinct))
        lengths = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 2
        flat = np.frombuffer(b"".join(ids), dtype=np.uint16)
        weight = np.repeat(count, lengths)
        n = int(weight.sum())
        n2 = int(count @ np.array(second))
        if n:
            share = np.bincount(flat, weights=weight)
            share = share[share > 0] / n
            out |= {"chars_per_token": out["word_chars"] / n, "chars_per_token_2": out["word_chars"] / max(1, n2),
                    "byte_share": float(weight[self.is_byte[flat]].sum() / n),
                    "token_entropy": float(-(share * np.log2(share)).sum()), "n_pieces": n}
        return out


def script(text: str | None) -> str:
    """Script of most letters among the first of each word: the first word of the letter's Unicode name."""
    seen: dict[str, int] = {}
    for word in set((text or "").split()):
        name = unicodedata.name(word[0], "").split(" ")[0] if word[0].isalpha() else ""
        if name:
            seen[name] = seen.get(name, 0) + 1
    return "script:" + max(sorted(seen), key=seen.get) if seen else "script:none"


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(docs: DataFrame, piece_model: str, ranks: str, pattern: str) -> DataFrame:
    """Base counts and tokeniser measures per row, with the band ``grp`` (language or script) and ``size_class``."""
    with open(piece_model, "rb") as a, open(ranks, "rb") as b:
        shared = docs.sparkSession.sparkContext.broadcast(Fertility(a.read(), b.read(), pattern))

    def run(batch):
        texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
        rows = [r for at in range(0, len(texts), 64) for r in shared.value.measure(texts[at:at + 64])]
        out = {k: [r[k] for r in rows] for k in [*_MEASURES, *BANDS]}
        out["size_class"] = [int(r["n_pieces"]).bit_length() for r in rows]
        out["grp"] = [f"lang:{x}" if x else script(t) for x, t in zip(langs, texts)]
        return out | {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash")}

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return map_columns(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang"),
                    F.xxhash64("text").alias("text_hash")), run,
        "doc_id long, text_hash long, " + ", ".join(f"{m} long" for m in _MEASURES) + ", "
        + ", ".join(f"{m} double" for m in BANDS) + ", grp string, size_class int")


def judge(measured: DataFrame) -> DataFrame:
    """``measured`` plus base_failed, kept and, per measure, its distance from the median in spreads."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = measured.withColumn("base_failed", failed)
    # texts of one hash and other measures are other texts; copies of a text collapse before the shuffle
    passed = materialize(df.where(~F.col("base_failed")).select("grp", "size_class", "text_hash", *BANDS).distinct(),
                         "fertility_distinct")

    def written(prefix, *keys):
        """Bands of the groups, written once; broadcast while their measured size is small, so that the
        documents of a frequent language need not meet."""
        at = F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))
        table = materialize(
            passed.groupBy(*keys).agg(((F.lit(float(SMALL)) / F.count("*")) ** 2).alias(f"{prefix}_few"),
                                      *[F.percentile_approx(m, at).alias(f"{prefix}_{m}") for m in BANDS]),
            f"bands_{prefix}")
        return checked_broadcast(table, "grp", require_unique=False)[0]

    df = (df.join(written("c", "grp", "size_class"), ["grp", "size_class"], "left")
          .join(written("g", "grp"), "grp", "left"))
    inside = F.lit(True)
    own, wide = 1 / (1 + F.col("c_few")), 1 + F.col("g_few")
    for m, (low, high, least) in BANDS.items():
        cell, group = F.col(f"c_{m}"), F.col(f"g_{m}")
        middle = group[1] + own * (cell[1] - group[1])
        spread = group[2] - group[0] + own * (cell[2] - cell[0] - group[2] + group[0])
        df = df.withColumn(f"z_{m}", (F.col(m) - middle) / (F.greatest(spread, F.lit(least)) * wide))
        inside &= F.col(f"z_{m}").between(low, high)
    return df.withColumn("kept", ~F.col("base_failed") & inside)


def quality(docs: DataFrame, piece_model: str, ranks: str, pattern: str) -> DataFrame:
    """Per row: doc_id, base counts, base_failed, kept and the measures.

    Null and empty texts have no words and fail the base rules; a null language
    is replaced by the script; null doc_ids, repeated rows and very long texts are rows like any
    other; other columns are ignored; an empty table gives none.
    """
    judged = judge(materialize(measure(docs, piece_model, ranks, pattern), "fertility"))
    return judged.select("doc_id", *_MEASURES, "base_failed", "kept", "grp", *BANDS)
