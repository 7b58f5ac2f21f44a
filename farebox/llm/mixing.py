"""Mixing sources to target weights (operator 3).

A classifier learnt from the labelled table (features: distinct words, by a
hash of their first five letters, and marks of the text's form) gives every
document a soft membership m[d] in the domains.  Nonnegative document rates r
bring the expected token totals A(r)[j] = sum_d tokens(d) r[d] m[d, j] to the
goals T by least squares, sum over domains weighted by the inverse of the
memberships' second moments C[j, k] = sum_d tokens(d) m[d, j] m[d, k]:

    minimise  1/2 (A(r) - T)' C^-1 (A(r) - T)   over  r >= 0,  from r = 1.

Projected gradient, accelerated by momentum with gradient restarts: in the
metric of the tokens the step is r = max(0, z - m . y), y = C^-1 (A(z) - T), z
being r moved on by its last change; the curvature there is at most 1, so the
step is 1.  Each step is one pass over the written memberships in Arrow batches,
and only y (one number per domain) comes from the driver: a rate is replayed
from the document's own membership and the steps so far, so nothing per document
is kept between passes, and a lost executor costs only its own batches.  The fit
ends where what is missing of every goal is under ``TOLERANCE``, or, where goals
missed by more than ``MISSED`` come no nearer (out of reach), where the projected
gradient is under ``STILL``; it raises if neither comes.

A domain that hardly occurs cannot be brought up to its target without repeating
its few documents many times.  ``goals_of`` says what such domains get instead,
and :func:`report` gives target, goal and reached total of each.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm.common import bound_batches, map_columns, materialize, words

# Domain -> share of all tokens wanted.  A document is labelled junk (quality 0),
# toxic (toxic 1, quality 1) or prose (the rest).
TARGETS = {"prose": 0.92, "junk": 0.07, "toxic": 0.01}
LABELLED_ROWS = 12_000     # expected bound of the labelled sample the classifier is fitted on
WORD_BUCKETS = 4096
TOLERANCE = 1e-4           # of a domain's tokens: where the fit ends if the goals can be met
STILL = 1e-3               # length of the projected gradient, of that of the rates: where it ends if they can't
MISSED = 0.02              # a goal further off than this, and STALL passes long not 5 % nearer, is out of reach
STALL = 15
MAX_PASSES = 500           # bound of passes, beyond which the fit fails (2 to 50 are usual, 100 and more with goals out of reach)
# A domain grows to its target if its present share is at least SCARCE of it (so by 1 / SCARCE at most); at
# ABSENT of it or less it has no goal; in between the growth allowed falls linearly to 1.
SCARCE, ABSENT = 0.25, 0.05
MEMO_BYTES = 48 * 1024 * 1024   # of distinct words kept by a Python worker
MEMO_KEY = 64                   # longer words (no white space: base64, CJK lines) are not kept
_ENTRY = 150                    # bytes of an entry beside its key


_UPPER = bytes(range(ord("A"), ord("Z") + 1))


def _shape_tokens(text: str, w: list[bytes]) -> list[int]:
    """Coarse marks of a text's form, as numbers after the word buckets."""
    n = max(1, len(w))
    size = max(1, len(text))
    raw = text.encode()
    marks = [min(9, int(10 * len(set(w)) / n)),
             10 + min(9, int(40 * sum(text.count(c) for c in "#*$%&|<>") / size)),
             20 + min(9, int(2 * sum(map(len, w)) / n) // 2),
             30 + min(9, int(math.log2(n + 1)) // 2),
             40 + min(9, int(10 * (len(raw) - len(raw.translate(None, _UPPER))) / size))]
    return [WORD_BUCKETS + m for m in marks]


SHAPES = 50


class Features:
    """Feature numbers of a text: hashed distinct words and shape marks; and its token (word) count."""

    def __init__(self):
        self.memo: dict[bytes, int] = {}
        self.size = 0

    def __getstate__(self):
        return {}

    def __setstate__(self, state):
        self.__init__()

    def of(self, text: str | None) -> tuple[int, np.ndarray]:
        w = words(text)
        distinct = set(w)
        if self.size > MEMO_BYTES:
            self.memo.clear()
            self.size = 0
        memo, found = self.memo, set()
        for x in distinct.difference(memo):
            bucket = zlib.crc32(x.lower()[:5]) % WORD_BUCKETS
            if len(x) <= MEMO_KEY:
                memo[x] = bucket
                self.size += _ENTRY + len(x)
            else:
                distinct.discard(x)
                found.add(bucket)
        found.update(map(memo.__getitem__, distinct))
        found.update(_shape_tokens(text or "", w))
        return len(w), np.fromiter(found, dtype=np.int64, count=len(found))


class DomainModel:
    """Multinomial classifier: posteriors over the domains from feature numbers."""

    def __init__(self, domains: list[str], intercept: np.ndarray, weights: np.ndarray):
        self.domains, self.intercept, self.weights = domains, intercept, weights
        self.features = Features()

    def member(self, text: str | None) -> tuple[int, np.ndarray]:
        n, found = self.features.of(text)
        z = self.intercept + self.weights[:, found].sum(axis=1)
        p = np.exp(z - z.max())
        return n, p / p.sum()


def fit_domains(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS,
                rows: int = LABELLED_ROWS) -> DomainModel:
    """Classifier over the domains from about ``rows`` labelled documents (all, if fewer).

    Null ids or labels teach nothing; with fewer than two labelled domains every
    document gets the labelled shares.
    """
    domains = list(targets)
    known = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
             .select(F.col("doc_id").alias("__id"),
                     F.when(F.col("q") == 0, "junk").when(F.col("t") == 1, "toxic").otherwise("prose").alias("domain")))
    n = known.count()
    share = math.ceil((1 << 20) * min(1.0, rows / max(n, 1)))
    some = known.where(F.pmod(F.xxhash64("__id", F.lit("mixing")), F.lit(1 << 20)) < share)

    def run(batch):
        made = Features()
        return {"label": [float(domains.index(d)) for d in batch.column("domain").to_pylist()],
                "tokens": [[str(f) for f in made.of(t)[1]] for t in batch.column("text").to_pylist()]}

    sample = materialize(
        map_columns(docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("__id"))
                    .select("domain", "text"), run, "label double, tokens array<string>"), "mixing_sample")
    counts = {int(r.label): r["count"] for r in sample.groupBy("label").count().collect()}
    size = WORD_BUCKETS + SHAPES
    if len(counts) < 2:
        share = np.array([counts.get(i, 0) + 1.0 for i in range(len(domains))])
        return DomainModel(domains, np.log(share / share.sum()), np.zeros((len(domains), size)))
    counter = CountVectorizerModel.from_vocabulary([str(i) for i in range(size)], "tokens", "features",
                                                   minTF=1.0, binary=True)
    fitted = LogisticRegression(family="multinomial", maxIter=25, regParam=2e-3, standardization=False).fit(
        counter.transform(sample))
    weights = np.zeros((len(domains), size))
    intercept = np.full(len(domains), -20.0)  # domains past the last label seen
    k = fitted.numClasses
    weights[:k] = fitted.coefficientMatrix.toArray()
    intercept[:k] = np.maximum(fitted.interceptVector.toArray(), -20.0)
    return DomainModel(domains, intercept, weights)


def membership(docs: DataFrame, model: DomainModel) -> DataFrame:
    """(doc_id, n_tokens, member array<double>) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        got = [shared.value.member(t) for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "n_tokens": [n for n, _ in got], "member": [p for _, p in got]}

    return map_columns(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                       "doc_id long, n_tokens long, member array<double>")


class RateModel:
    """Rates of documents from their membership and the steps of the fit."""

    def __init__(self, goals: np.ndarray):
        self.goals = goals                      # token totals wanted; nan: no goal, the domain hardly occurs
        self.present = np.zeros(len(goals))     # token totals at rate 1
        self.reached = np.zeros(len(goals))     # token totals after the fit
        self.steps: list[tuple[float, np.ndarray]] = []   # (momentum before the step, y)

    def replay(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rates, rates one step earlier, the point z that the last step started from)."""
        r = before = z = np.ones(len(member))
        for momentum, y in self.steps:
            z = r + momentum * (r - before)
            before, r = r, np.maximum(0.0, z - member @ y)
        return r, before, z

    def rates(self, member: np.ndarray) -> np.ndarray:
        return self.replay(member)[0]


def goals_of(totals: np.ndarray, targets: dict[str, float] = TARGETS, scarce_at: float = SCARCE,
             absent_at: float = ABSENT) -> np.ndarray:
    """Token totals wanted per domain, given the present ``totals``; nan where a domain hardly occurs.

    The targets are shares of the present total.  A domain present with less than
    ``scarce_at`` of its target may grow less than to it (both bounds 0: every target is a
    goal, however often documents repeat), and one with ``absent_at`` of it or less keeps what it has without a goal of its own; the others share the rest in
    proportion to their targets (so they may become scarce in turn).
    """
    weight = np.array(list(targets.values()), dtype=float)
    weight = weight / weight.sum()
    tokens = totals.sum()
    fixed = np.full(len(weight), np.nan)        # token totals of scarce domains
    absent = np.zeros(len(weight), dtype=bool)
    while True:
        free = np.isnan(fixed)
        left = max(0.0, tokens - fixed[~free].sum())
        share = weight[free].sum()
        wanted = np.where(free, left * weight / share if share > 0 else 0.0, fixed)
        scarce = free & (totals < scarce_at * wanted)
        if not scarce.any():
            wanted[absent] = np.nan
            return wanted
        ratio = totals[scarce] / wanted[scarce]
        growth = 1 + (1 / scarce_at - 1) * np.clip((ratio - absent_at) / max(scarce_at - absent_at, 1e-12), 0, 1)
        fixed[scarce] = np.minimum(growth * totals[scarce], wanted[scarce])
        absent[scarce] = ratio <= absent_at


def fit_rates(members: DataFrame, targets: dict[str, float] = TARGETS, scarce_at: float = SCARCE,
              absent_at: float = ABSENT) -> RateModel:
    """Fit rates so that expected domain token totals meet the goals (``goals_of``)."""
    spark = members.sparkSession
    k = len(targets)
    pairs = [(i, j) for i in range(k) for j in range(k)]
    member, n = F.col("member"), F.col("n_tokens")
    row = members.agg(F.sum(n), *[F.sum(n * member[j]) for j in range(k)], *[F.sum(n * member[i] * member[j]) for i, j in pairs]).first()
    tokens = float(row[0] or 0)
    totals = np.array([float(x or 0) for x in row[1:1 + k]])
    moments = np.array([float(x or 0) for x in row[1 + k:]]).reshape(k, k)
    model = RateModel(goals_of(totals, targets, scarce_at, absent_at))
    model.present = model.reached = totals
    used = ~np.isnan(model.goals) & (totals > 0)
    if not tokens or not used.any():
        return model
    goals = np.where(used, model.goals, 0.0)
    enough = TOLERANCE * np.maximum(np.maximum(goals, totals), 1e-4 * tokens)
    some = np.ix_(used, used)
    # 1e-9 of the scale: domains whose memberships go in step everywhere have one direction between them
    weight = np.zeros((k, k))
    weight[some] = np.linalg.inv(moments[some] + 1e-9 * tokens * np.eye(int(used.sum())))

    def passed(momentum: float):
        """Totals at the rates and at the next z, and the lengths and products that decide on the next step."""
        shared = spark.sparkContext.broadcast((model.steps, momentum))

        def run(batch):
            steps, momentum = shared.value
            told = RateModel(np.zeros(k))
            told.steps = steps
            n = batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float)
            m = batch.column("member").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            r, before, z = told.replay(m)
            nxt = r + momentum * (r - before)
            out = [*((n * r) @ m), *((n * nxt) @ m), n @ (r - z) ** 2, n @ r ** 2, n @ ((z - r) * (r - before))]
            return {f"s{j}": [float(v)] for j, v in enumerate(out)}

        size = 2 * k + 3
        part = map_columns(members.select("n_tokens", "member"), run, ", ".join(f"s{j} double" for j in range(size)))
        got = np.array([float(v or 0) for v in part.agg(*[F.sum(f"s{j}") for j in range(size)]).first()])
        shared.unpersist()
        return got[:k], got[k:2 * k], *got[2 * k:]

    age, momentum, at_next, history = 1.0, 0.0, totals, []
    for _ in range(MAX_PASSES):
        model.steps.append((momentum, np.where(used, weight @ np.where(used, at_next - goals, 0.0), 0.0)))
        older, age = age, (1 + math.sqrt(1 + 4 * age * age)) / 2
        model.reached, at_next, moved, length, against = passed((older - 1) / age)
        missed = np.where(used, np.abs(model.reached - goals), 0.0)
        if (missed <= enough).all():
            return model
        history.append(missed)
        far = missed > MISSED * goals
        stuck = len(history) > STALL and (missed >= 0.95 * history[-1 - STALL])[far].all() and far.any()
        if stuck and moved <= STILL ** 2 * length:
            return model
        momentum = (older - 1) / age
        if against > 0:                         # the step went against the last change: start the momentum anew
            age, momentum, at_next = 1.0, 0.0, model.reached
    raise RuntimeError(f"rates not fitted after {MAX_PASSES} passes: token totals {model.reached}, goals {goals}")


def report(spark: SparkSession, model: RateModel, targets: dict[str, float] = TARGETS) -> DataFrame:
    """One row per domain: target share, tokens present, goal (null: the domain hardly occurs and has none), tokens reached."""
    rows = [(d, float(t), float(p), None if math.isnan(g) else float(g), float(r))
            for (d, t), p, g, r in zip(targets.items(), model.present, model.goals, model.reached)]
    return spark.createDataFrame(rows, "domain string, target double, present double, goal double, reached double")


def rates(members: DataFrame, model: RateModel) -> DataFrame:
    """``members`` with each document's rate: (doc_id, n_tokens, member, rate)."""
    shared = members.sparkSession.sparkContext.broadcast(model)
    k = len(model.goals)

    def run(batch):
        m = batch.column("member").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
        return {**{c: batch.column(c) for c in ("doc_id", "n_tokens", "member")}, "rate": shared.value.rates(m)}

    return map_columns(members, run, "doc_id long, n_tokens long, member array<double>, rate double")


def fit_mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, scarce_at: float = SCARCE,
            absent_at: float = ABSENT) -> tuple[DataFrame, RateModel]:
    """(doc_id, n_tokens, member) of every row, written, and the fitted rates."""
    members = materialize(membership(docs, fit_domains(docs, labels, targets)), "mixing_members")
    return members, fit_rates(members, targets, scarce_at, absent_at)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, scarce_at: float = SCARCE,
        absent_at: float = ABSENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, one membership column per domain, rate.

    Null and empty texts have no tokens, their rate follows their membership;
    null doc_ids, repeated rows and ties are rows like any other with equal
    results; other columns are ignored; an empty table gives none.
    """
    members, model = fit_mix(docs, labels, targets, scarce_at, absent_at)
    done = rates(members, model)
    return done.select("doc_id", "n_tokens", *[F.col("member")[j].alias(f"p_{d}") for j, d in enumerate(targets)], "rate")


def resample(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, scarce_at: float = SCARCE,
             absent_at: float = ABSENT) -> DataFrame:
    """``docs`` with each row taken ``rate`` times on average: its whole part, and once more by a draw of its own.

    The draw is a hash of doc_id, text and the row's number in the written
    table, so repeated rows are drawn one by one and a re-run task draws alike.
    Null and empty texts, null doc_ids and ties are rows like any other; every
    column stays, whatever its name; an empty table stays empty.
    """
    domains = fit_domains(docs, labels, targets)
    shared = docs.sparkSession.sparkContext.broadcast(domains)
    bound_batches(docs.sparkSession)

    @F.pandas_udf("struct<n_tokens:long,member:array<double>>")
    def member(text: pd.Series) -> pd.DataFrame:
        got = [shared.value.member(t) for t in text]
        return pd.DataFrame({"n_tokens": [n for n, _ in got], "member": [p.tolist() for _, p in got]})

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = materialize(docs.select(row, member(F.coalesce("text", F.lit(""))).alias("m"),
                                   F.monotonically_increasing_id().alias("number")), "mixing_rows")
    model = fit_rates(rows.select("m.n_tokens", "m.member"), targets, scarce_at, absent_at)
    fitted = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def rate(member: pd.Series) -> pd.Series:
        return pd.Series(fitted.value.rates(np.array(member.tolist()).reshape(-1, len(targets))), dtype="float64")

    chance = F.pmod(F.xxhash64(F.lit("mix"), "row.doc_id", "row.text", "number"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = rows.select("row", F.floor(rate("m.member") + chance).cast("int").alias("copies")).where("copies > 0")
    return (copies.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))
