"""Tables kept by Python workers stay small on texts without white space; operator 8 does not depend on the partitions."""

import random
import sys

import public_tokenizers as tokenizers
import pytest
import tiktoken

from farebox.llm import bpe, fertility, toxicity

RANKS = tokenizers.path("byte_bpe_50k.tiktoken")


def lines(n, seed):
    """Long words of a few hundred characters each: base64 and a script without spaces."""
    rnd = random.Random(seed)
    alphabets = ["ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "日本語漢字仮名交文章例題単語"]
    return [" ".join("".join(rnd.choices(rnd.choice(alphabets), k=rnd.randint(100, 600))) for _ in range(20)) for _ in range(n)]


def kept(memo):
    return sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in memo.items())


def test_bpe_tables_hold_no_long_keys():
    codec = bpe.Codec(bpe.read_ranks(None, RANKS), tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=codec.rank, special_tokens={})
    for seed in range(6):
        texts = lines(20, seed)
        ids = codec.encode_batch(texts)
        assert ids == [library.encode_ordinary(t) for t in texts]
        assert codec.count_batch(texts) == list(map(len, ids))
    codec.encode_batch(["end"])
    assert all(len(k) <= bpe.MEMO_KEY for k in [*codec.inner, *codec.merged])
    assert kept(codec.inner) < 1_000_000


def test_fertility_tables_hold_no_long_keys():
    with open(tokenizers.path("piece_bpe_32k.model"), "rb") as f, open(RANKS, "rb") as g:
        made = fertility.Fertility(f.read(), g.read(), tokenizers.PATTERN)
    first = made.measure(lines(20, 0))
    for seed in range(1, 4):
        made.measure(lines(20, seed))
    assert made.measure(lines(20, 0)) == first
    made.measure(["end"])
    assert all(len(k) <= fertility.MEMO_KEY for k in made.memo) and kept(made.memo) < 1_000_000


def test_toxicity_table_holds_no_long_keys():
    made = toxicity.Featurizer(["w:idiot", "3:idi"])
    for seed in range(4):
        for text in lines(20, seed):
            made.hits(text.replace("+", "a").replace("/", "b") + " idiot")
    assert made.hits("Idiot idiots") == {0: 1, 1: 2}
    assert all(len(k) <= toxicity.MEMO_KEY for k in made.memo)


def test_toxicity_scores_do_not_depend_on_partitions_or_copies(spark, monkeypatch):
    rnd = random.Random(2)
    plain = "the of and that with this from have which their would there about other into could time than".split()
    bad = "zagword krulling vexbane idiot moron".split()

    def text(toxic):
        return " ".join(rnd.choice(plain) if not toxic or rnd.random() < 0.8 else rnd.choice(bad) for _ in range(40))

    rows = [(i, text(i % 4 == 0)) for i in range(600)]
    rows += [(1000 + i, rows[1][1]) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "CLASSIFIER_ROWS", 200)
    runs = []
    for df in (docs.coalesce(1), docs.repartition(7), docs.orderBy("text").repartition(3)):
        model = toxicity.fit(df, labels, classifier_rows=200)
        runs.append({r.doc_id: r.score for r in toxicity.score(docs, model).collect()})
    assert runs[0] == pytest.approx(runs[1], abs=1e-6) and runs[0] == pytest.approx(runs[2], abs=1e-6)
    held = [i for i in range(400, 600)]
    assert sum((runs[0][i] >= toxicity.THRESHOLD) == (i % 4 == 0) for i in held) >= 190


def test_lexicon_keeps_every_feature_with_evidence(spark):
    words = [f"foul{a}{b}" for a in "bcdfghjklm" for b in "aeiou"]
    rows = [(w * 1 + " " + w, 1) for w in words for _ in range(3)] + [("plain words only", 0)] * 300
    sample = spark.createDataFrame(rows, "text string, toxic int")
    chosen, n1, n0 = toxicity.induce_lexicon(sample)
    assert (n1, n0) == (150, 300) and {f"w:{w}" for w in words} <= {f for f, _, _ in chosen}
