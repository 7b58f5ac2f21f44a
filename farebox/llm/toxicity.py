"""Toxicity by weak supervision (operator 8).

Voters are lexicons and patterns.  Besides seed lexicons of public insults,
lexicons are induced from labelled rows (word prefixes and whole words that
mark toxic documents).  A generative label model over the voters' firing
patterns, counted over all rows outside the held-out share, estimates each
voter's firing rate per class by EM and the voters' correlations given the
class; correlated voters share their weight.  Its posteriors are the soft labels
on which a linear classifier is trained.  Scores read the text alone.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import bound_batches, map_columns, materialize

HELD_OUT = (4, 2)               # rows whose crc32(doc_id) mod 4 is 2 teach nothing
LABELLED_ROWS = 20_000          # expected bound of the labelled sample for lexicon induction
CLASSIFIER_ROWS = 40_000        # expected bound of the distinct texts the linear classifier is fitted on
PREFIXES = (3, 4, 5, 6, 7)
THRESHOLD = 0.3
COUNT_STEPS = (2, 4)            # a feature found so often sets further inputs
MEMO_WORDS = 300_000            # words kept by a Python worker, of
MEMO_KEY = 64                   # characters at most (base64 or lines without white space are looked up each time)

# Seed lexicons of insults by language.
SEED_LEXICONS = {
    "en": "idiot moron stupid loser pathetic worthless scum trash clown disgusting dumb imbecile jerk bastard bitch",
    "de": "idiot trottel dummkopf arschloch abschaum versager schwachkopf depp blödmann dreckskerl",
    "fr": "idiot imbécile connard salaud crétin débile abruti ordure minable pourriture",
    "es": "idiota imbécil estúpido cabrón basura escoria patético inútil payaso asqueroso",
}
_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = [
    re.compile(r"(?:\b[A-Z]{4,}\b[^A-Za-z]+){8}"),                               # shouting
    re.compile(r"(?i)\b(?:you|du|vous|tú)\W+(?:are|re|bist|êtes|eres)\W+(?:an?\W+|ein\W+|une?\W+)?\w+!"),  # address
]
VOTERS = [f"seed_{k}" for k in SEED_LEXICONS] + [f"prefix_{n}" for n in PREFIXES] + ["word", "shouting", "address"]


def held_out(doc_id: str = "doc_id") -> Column:
    mod, share = HELD_OUT
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod == share, F.lit(False))


def _sampled(key: Column, rows: int, wanted: int) -> Column:
    """Hash test that keeps about ``wanted`` of ``rows`` (all, if fewer)."""
    return F.pmod(F.xxhash64(key, F.lit("toxicity")), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, wanted / max(rows, 1)))


def word_features(word: str) -> list[str]:
    """Induced-lexicon features a (lower-case) word can set: its prefixes and itself."""
    return [f"{n}:{word[:n]}" for n in PREFIXES if len(word) >= n] + [f"w:{word}"]


class Featurizer:
    """Hits of lexicon features in a text, with a bounded table of words already looked up."""

    def __init__(self, features: Iterable[str]):
        self.index = {f: i for i, f in enumerate(features)}
        self.memo: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return list(self.index)

    def __setstate__(self, state):
        self.__init__(state)

    def hits(self, text: str | None) -> dict[int, int]:
        """feature number -> how often it occurs."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo, out = self.memo, {}
        for word, n in Counter(_WORD.findall((text or "").lower())).items():
            found = memo.get(word)
            if found is None:
                found = tuple(i for f in word_features(word) if (i := self.index.get(f)) is not None)
                if len(word) <= MEMO_KEY:
                    memo[word] = found
            for i in found:
                out[i] = out.get(i, 0) + n
        return out


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(text, toxic) of about ``rows`` labelled documents outside the held-out share.

    A label given more than once counts once (toxic if any says so); rows with a
    null id or label teach nothing.
    """
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out())
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("__toxic")))
    n = known.count()
    some = known.where(_sampled(F.col("doc_id"), n, rows)).withColumnRenamed("doc_id", "__id")
    return (docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("__id"))
            .select("text", F.col("__toxic").alias("toxic")))


def induce_lexicon(sample: DataFrame) -> tuple[list[tuple[str, int, int]], int, int]:
    """Every feature that marks toxic documents (in 3 of them at least, at 4 times the others' rate): (feature, toxic
    docs, other docs); and both class sizes.  Bounded by the labelled sample, with which it grows."""

    def run(batch):
        seen = [Counter(), Counter()]
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            found = {f for w in set(_WORD.findall((text or "").lower())) for f in word_features(w)}
            seen[int(toxic > 0)].update(found)
        names = list(seen[0].keys() | seen[1].keys())
        return {"feature": names, "toxic": [seen[1][f] for f in names], "other": [seen[0][f] for f in names]}

    totals = sample.agg(F.sum((F.col("toxic") > 0).cast("long")), F.count("*")).first()
    n1 = int(totals[0] or 0)
    n0 = int(totals[1]) - n1
    counts = map_columns(sample, run, "feature string, toxic long, other long").groupBy("feature").agg(
        F.sum("toxic").alias("n1"), F.sum("other").alias("n0"))
    p1 = (F.col("n1") + 0.5) / (n1 + 1.0)
    p0 = (F.col("n0") + 0.5) / (n0 + 1.0)
    best = (counts.where((F.col("n1") >= 3) & (p1 >= 4 * p0))
            .select("feature", "n1", "n0"))
    return sorted((r.feature, int(r.n1), int(r.n0)) for r in best.collect()), n1, n0


class LabelModel:
    """Two latent classes; voter k fires with rate a[k] in the toxic class and b[k] in the other."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, prior: float, steps: int = 50):
        """``patterns``: 0/1 rows of distinct firing patterns (at most 2**voters); ``counts``: documents of each."""
        k = patterns.shape[1]
        self.prior = min(max(prior, 1e-3), 0.5)
        fired = patterns[:, :].sum(axis=1)
        self.weight = np.ones(k)
        gamma = np.where(fired > 0, 0.9, 0.02)
        for _ in range(steps):
            self._rates(patterns, counts, gamma)
            self._correlate(patterns, counts, gamma)
            gamma = self.posterior(patterns)

    def _rates(self, v, counts, gamma):
        on, off = counts * gamma, counts * (1 - gamma)
        # one pseudo-document per class keeps rates inside (0, 1); a fires no less than b
        self.a = (on @ v + 0.5) / (on.sum() + 1)
        self.b = np.minimum((off @ v + 0.5) / (off.sum() + 1), self.a)

    def _correlate(self, v, counts, gamma):
        cov = np.zeros((v.shape[1], v.shape[1]))
        for share, rate in ((counts * gamma, self.a), (counts * (1 - gamma), self.b)):
            centred = v - rate
            cov += (centred * share[:, None]).T @ centred
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        self.correlation = cov / np.outer(sd, sd)
        np.fill_diagonal(self.correlation, 1.0)
        self.weight = 1 / np.maximum(self.correlation, 0).sum(axis=1)

    def posterior(self, v: np.ndarray) -> np.ndarray:
        on = np.log(self.a / self.b)
        off = np.log((1 - self.a) / (1 - self.b))
        z = math.log(self.prior / (1 - self.prior)) + v @ (self.weight * (on - off)) + (self.weight * off).sum()
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _voters(precise: dict[int, int], features: list[str]):
    """votes(text, hits) -> bit mask over VOTERS."""
    seeds = [frozenset(v.split()) for v in SEED_LEXICONS.values()]

    def votes(text: str | None, hits: dict[int, int]) -> int:
        text = text or ""
        found = set(_WORD.findall(text.lower()))
        mask = 0
        for i, lexicon in enumerate(seeds):
            if not lexicon.isdisjoint(found):
                mask |= 1 << i
        for f in hits:
            if f in precise:
                mask |= 1 << precise[f]
        for i, pattern in enumerate(_PATTERNS):
            if pattern.search(text):
                mask |= 1 << (len(VOTERS) - len(_PATTERNS) + i)
        return mask

    return votes


class ToxicityModel:
    """Fitted classifier: bias, and per feature the weights of 1, COUNT_STEPS or more occurrences."""

    def __init__(self, features: list[str], bias: float, weights: np.ndarray):
        self.featurizer, self.bias, self.weights = Featurizer(features), bias, weights

    def score(self, text: str | None) -> float:
        z = self.bias
        for f, n in self.featurizer.hits(text).items():
            w = self.weights[f]
            z += w[0] + sum(w[1 + i] for i, step in enumerate(COUNT_STEPS) if n >= step)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS,
        classifier_rows: int = CLASSIFIER_ROWS) -> ToxicityModel:
    """Lexicons, label model and classifier from the rows outside the held-out share.

    Without labels or toxic rows the seed lexicons and patterns still vote; without any
    document (or with one class only) the model scores every text with the prior.
    """
    spark = docs.sparkSession
    sample = materialize(labelled_sample(docs, labels, labelled_rows), "toxicity_sample")
    chosen, n1, n0 = induce_lexicon(sample)
    seeds = sorted({w for v in SEED_LEXICONS.values() for w in v.split()})
    names = [f for f, _, _ in chosen]
    names += [f"w:{w}" for w in seeds if f"w:{w}" not in set(names)]
    voter_of = {f"{n}": VOTERS.index(f"prefix_{n}") for n in PREFIXES} | {"w": VOTERS.index("word")}
    precise = {i: voter_of[f.split(":")[0]] for i, (f, a, b) in enumerate(chosen) if a >= 4 * b}
    prior = (n1 + 1) / (n1 + n0 + 10)

    shared = spark.sparkContext.broadcast((Featurizer(names), precise))

    def run(batch):
        featurizer, by_voter = shared.value
        votes = _voters(by_voter, names)
        masks, tokens = [], []
        for text in batch.column("text").to_pylist():
            hits = featurizer.hits(text)
            masks.append(votes(text, hits))
            tokens.append([f"{f}" for f in hits]
                          + [f"{f}#{s}" for f, n in hits.items() for s in COUNT_STEPS if n >= s])
        return {"key": batch.column("key"), "votes": masks, "tokens": tokens}

    pool = materialize(
        map_columns(docs.where(~held_out()).select(F.xxhash64("text").alias("key"), "text"), run,
                    "key long, votes int, tokens array<string>"), "toxicity_votes")
    found = pool.groupBy("votes").count().collect()  # at most 2**voters rows
    rows = sum(r["count"] for r in found)
    width = 1 + len(COUNT_STEPS)
    flat = ToxicityModel(names, math.log(prior / (1 - prior)), np.zeros((len(names), width)))
    if not rows:
        return flat
    patterns = np.array([[r.votes >> k & 1 for k in range(len(VOTERS))] for r in found], dtype=float)
    model = LabelModel(patterns, np.array([r["count"] for r in found], dtype=float), prior)
    posterior = spark.createDataFrame(
        [(r.votes, float(p)) for r, p in zip(found, model.posterior(patterns))], "votes int, p double")
    vocabulary = [t for f in range(len(names)) for t in [f"{f}"] + [f"{f}#{s}" for s in COUNT_STEPS]]
    counter = CountVectorizerModel.from_vocabulary(vocabulary, "tokens", "features", minTF=1.0, binary=True)
    texts = pool.select("key").distinct().count()
    # by the text's hash, each text once: neither copies nor files nor partitions change what is drawn
    train = (pool.where(_sampled(F.col("key"), texts, classifier_rows)).dropDuplicates(["key"])
             .join(F.broadcast(posterior), "votes")
             .select("tokens", "p", F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("label"))
             .withColumn("weight", F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p")))
             .where("weight > 1e-6"))
    if train.select("label").distinct().count() < 2:
        return flat
    fitted = LogisticRegression(maxIter=40, regParam=1e-4, weightCol="weight", standardization=False).fit(
        counter.transform(train))
    return ToxicityModel(names, float(fitted.intercept), np.array(fitted.coefficients.toArray()).reshape(-1, width))


def score_column(model: ToxicityModel, docs: DataFrame) -> Column:
    """Score (0 to 1) of the column ``text``; null and empty texts get the bias alone."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def toxicity_score(text: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in text], dtype="float64")

    return toxicity_score(F.coalesce(docs["text"], F.lit("")))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (1 from ``threshold`` on).

    Null and empty texts are scored as empty; a null doc_id is not held out;
    repeated rows get equal scores; other columns are ignored; an empty table
    gives none.
    """
    scored = docs.select("doc_id", held_out().alias("held_out"), score_column(model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def reject(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` scored below ``threshold``, all columns unchanged."""
    return docs.where(score_column(model, docs) < threshold)
