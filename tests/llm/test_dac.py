"""Token files in directly addressable codes (operator 11) against the library and plain arrays."""

import random
import zlib

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from farebox.llm import dac, words
from farebox.session import scratch_path

PATH = tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, segment string, h long, row long, __x int"
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "B", "É", "é", "Å", "̈", " ", "  ", "\n", "\t", "　", "\x1c", "0", "10", ".", ",", "'s", "'S", ").",
         "<|endoftext|>", "<|ENDOFTEXT|>", "日本", "!?", "İ", "K", "한", "한", "x²", "½.", "Σ", "word"]


def library_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def mixed_texts(n):
    rnd = random.Random(1)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 30))) for _ in range(n)] + [None, "", " \n", "q" * 3000]


def test_encoder_equals_library():
    with open(PATH, encoding="utf-8") as f:
        encoder = words.WordEncoder(f.read(), 2)
    texts = mixed_texts(2000)
    for part in (texts, texts[::-1]):
        ids, counts = encoder.encode(pa.array(part, pa.string()))
        ends = np.cumsum(counts)
        assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [library_ids(t) for t in part]
    ids, counts = encoder.encode(pa.array(texts[5:9] + texts, pa.string()).slice(4))
    assert len(counts) == len(texts) and ids[:counts[0]].tolist() == library_ids(texts[0])


def test_encoder_memory_is_bounded_by_bytes(monkeypatch):
    with open(PATH, encoding="utf-8") as f:
        encoder = words.WordEncoder(f.read(), 2)
    monkeypatch.setattr(words, "MEMO_BYTES", 20_000)
    rnd = random.Random(2)
    for _ in range(20):
        texts = ["".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(100)] + ["日本語" * 2000]
        ids, counts = encoder.encode(pa.array(texts))
        assert encoder.memo_bytes < 20_000 + 101 * (words._ENTRY + 200)
        assert max(map(len, encoder.memo)) <= words.MEMO_KEY
        assert ids[-counts[-1]:].tolist() == library_ids(texts[-1])


@pytest.mark.parametrize("n", [1, 7, 8, 511, 512, 513, 5000, 200_000])
def test_segment_runs_and_random_access(n):
    rnd = np.random.default_rng(n)
    for high in (1, 2, 50_000, 2**32):
        ids = (rnd.integers(0, high, n) >> rnd.integers(0, 20, n)).astype(np.uint32)
        counts = [n // 2, 0, n - n // 2]
        s = dac.Segment(dac.build_segment(3, 4, [-7, None, 9], np.array(counts), ids))
        assert (s.part, s.number, s.n) == (3, 4, n)
        assert s.null.tolist() == [False, True, False] and s.doc_ids.tolist() == [-7, 0, 9]
        assert np.diff(s.starts).tolist() == counts
        assert (s.run(0, n) == ids).all()
        for a, b in np.sort(rnd.integers(0, n + 1, (8, 2)), axis=1).tolist():
            assert (s.run(a, b) == ids[a:b]).all()
        places = rnd.integers(0, n, 100)
        assert (s.at(places) == ids[places]).all()


def test_widths_are_the_least():
    lengths = np.array([3, 50, 0, 20, 400, 7, 0, 3])

    def size(widths):
        at, total = 0, 0
        for k, w in enumerate(widths):
            reach = lengths.sum() if not at else lengths[at + 1:].sum()
            total += reach * (w + (k + 1 < len(widths)))
            at += w
        return total

    def splits(n):
        return [[n]] + [[w, *rest] for w in range(1, n) for rest in splits(n - w)]

    assert size(dac.choose_widths(lengths)) == min(map(size, splits(7)))


def test_damaged_segment_raises():
    blob = bytearray(dac.build_segment(0, 0, [1], np.array([3]), np.array([5, 6, 7])))
    for broken in (bytes(blob[:-1]), bytes(blob[:20]), bytes(blob[:40]) + b"\xff" + bytes(blob[41:])):
        with pytest.raises(ValueError):
            list(dac.segments(broken + b"\n"))


@pytest.fixture(scope="module")
def rows():
    texts = mixed_texts(60) + ["long " * 50_000 + "q" * 100_000]
    return [(None if i % 20 == 3 else (i * 37) % 50 - 10, t, "s", 1, 2, 3) for i, t in enumerate(texts)]


def test_round_trip_documents_and_random_access(spark, rows, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT_IDS", 300)
    monkeypatch.setattr(dac, "FILE_SEGMENTS", 2)
    monkeypatch.setattr(dac, "ENCODE_ROWS", 4)
    df = spark.createDataFrame(rows + rows[:5], SCHEMA)
    path = scratch_path(spark, "dac_test")
    dac.write_tokens(df, path, PATH, 2)
    got = sorted(dac.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in got) == sorted(
        (d is not None, d or 0, library_ids(t)) for d, t, *_ in rows + rows[:5])
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    flat = [i for r in got for i in r.ids]
    at = 0
    for r in got:
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))
        at += r.n_tokens
    asked = random.Random(4).choices(range(-3, len(flat) + 3), k=400)
    found = dac.tokens_at(spark, path, spark.createDataFrame([(p,) for p in asked + [None]], "position long")).collect()
    assert {r.position: r.token for r in found} == {p: flat[p] for p in asked if 0 <= p < len(flat)}
    assert len(found) == len({p for p in asked if 0 <= p < len(flat)})
    stored = sorted(dac.manifest(spark, path).collect(), key=lambda r: r.base)
    assert len(stored) > 3 and sum(r.n_ids for r in stored) == len(flat) and sum(r.n_docs for r in stored) == len(got)


def test_order_does_not_depend_on_the_partitions(spark, rows):
    df = spark.createDataFrame([(1, t, *r) for _, t, *r in rows], SCHEMA)
    a = sorted(map(tuple, dac.token_file_round_trip(df.repartition(7), PATH).collect()))
    assert a == sorted(map(tuple, dac.token_file_round_trip(df.coalesce(1), PATH).collect()))


def test_empty_table(spark):
    out = dac.token_file_round_trip(spark.createDataFrame([], SCHEMA), PATH)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == 0
