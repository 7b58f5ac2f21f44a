"""Training, scoring, evaluation, tuning and candidate ranking.

Boosted trees are grown by :mod:`farebox.operators.boost` (all trials of a
tuning run in shared passes); the other model families are ``pyspark.ml``.
Numbers cannot equal scikit-learn's (binned splits, different leaf updates);
compare AUC against a base-rate model rather than exact values.
"""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import ensembles as E
from farebox.operators import aggregate as A
from farebox.operators import boost
from farebox.session import checkpoint_root, scratch_path

# ---------------------------------------------------------------- fixed values
# Accepted hyperparameter ranges (inclusive) and the reference's defaults.
HYPERPARAMETER_RANGES = {"learning_rate": (0.0001, 1.0), "n_estimators": (1, 1000), "max_depth": (1, 20)}
DEFAULT_HYPERPARAMETERS = {"learning_rate": 0.1, "n_estimators": 100, "max_depth": 3}
JOB_HYPERPARAMETERS = {"learning_rate": 0.1, "n_estimators": 150, "max_depth": 3}
# Tuning search space: learning rate in [0.01, 0.3], depth 2..6, 150 trees, 4 trials, 2 in parallel.
TUNING_LR_RANGE = (0.01, 0.3)
TUNING_DEPTH_RANGE = (2, 6)
TUNING_TREES = 150
TUNING_TRIALS = 4
TUNING_PARALLELISM = 2
SEED = 42
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Hyperparameters:
    learning_rate: float = 0.1
    n_estimators: int = 100
    max_depth: int = 3


def validate_hyperparameters(hp: Hyperparameters) -> Hyperparameters:
    """M7: every hyperparameter inside its accepted range (all that are not are named at once)."""
    given = asdict(hp)
    outside = {name: given[name] for name, (low, high) in HYPERPARAMETER_RANGES.items()
               if not low <= given[name] <= high}
    if outside:
        raise ValueError(f"outside the accepted ranges {HYPERPARAMETER_RANGES}: {outside}")
    return hp


def validate_runs(runs: DataFrame) -> DataFrame:
    """M7 over a table of runs: ``accepted``, and ``outside`` (names of the hyperparameters out of range or null, in order)."""
    wrong = [F.when(~F.coalesce(F.col(name).between(low, high), F.lit(False)), F.lit(name))
             for name, (low, high) in HYPERPARAMETER_RANGES.items()]
    outside = F.array_join(F.array_compact(F.array(*wrong)), ",")
    return runs.withColumns({"accepted": outside == "", "outside": outside})


def feature_columns(df: DataFrame, label: str) -> list[str]:
    """All columns but the label (the reference's "everything after column 0")."""
    return [c for c in df.columns if c != label]


# ``fit_input`` draws about this many rows where no other bound (or none) is asked for.
FIT_ROWS = 150_000
# Partitions of a fit hold so many rows; beyond two per core (and 16 in all) they grow, up to the larger number.
FIT_ROWS_PER_PARTITION = 10_000
FIT_MOST_ROWS_PER_PARTITION = 250_000


def _prepared(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn(label, F.col(label).cast("double"))


def fit_partitions(rows: int, cores: int) -> int:
    """Partitions of a fit over ``rows`` rows: small ones while they are few, never one, whole waves of tasks beyond."""
    few = min(-(-rows // FIT_ROWS_PER_PARTITION), max(16, 2 * cores))
    many = -(-rows // FIT_MOST_ROWS_PER_PARTITION)
    return max(2, few, -(-many // cores) * cores if many > few else 0)


def fit_input(df: DataFrame, label: str, max_rows: int | None = FIT_ROWS) -> DataFrame:
    """Training rows of a fit: all of ``df``, or about ``max_rows`` drawn one by one
    where there are more (None: no bound), in :func:`fit_partitions` partitions.

    Rows are drawn and dealt out by a seeded salt of each row, so equal rows are drawn
    independently and meet in no one task; the drawn rows are written with it, so a re-run
    task sees the same."""
    # Tree learners checkpoint their per-iteration state every ``checkpointInterval``
    # iterations (lineage cut, so a lost executor does not replay all iterations);
    # that needs the context's checkpoint dir, read from / registered in the session.
    checkpoint_root(df.sparkSession)
    rows = df.count()
    drawn = _prepared(df, label).withColumn("__salt", F.rand(SEED))
    if max_rows is not None and rows > max_rows:
        drawn = drawn.where(F.col("__salt") < max_rows / rows)
        rows = max_rows
    path = scratch_path(df.sparkSession, "fit_rows")
    drawn.write.parquet(path)
    drawn = df.sparkSession.read.schema(drawn.schema).parquet(path)
    parts = fit_partitions(rows, df.sparkSession.sparkContext.defaultParallelism)
    return drawn.repartition(parts, F.xxhash64("__salt")).drop("__salt")


def gbt_pipeline(features: list[str], label: str, hp: Hyperparameters) -> Pipeline:
    gbt = GBTClassifier(featuresCol="features", labelCol=label, stepSize=hp.learning_rate,
                        maxIter=hp.n_estimators, maxDepth=hp.max_depth, seed=SEED, checkpointInterval=10)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), gbt])


def persist_model(model: PipelineModel, spark: SparkSession, name: str = "model") -> PipelineModel:
    """Write the fitted model to the shared folder and load it back (the model artifact).

    The loaded model carries no training summary; a summary holds a reference
    to the session, which stops the model from being shipped to executors once
    the session has used an ``Observation``.
    """
    path = scratch_path(spark, "models", name)
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def train_gbt(train: DataFrame, label: str, hp: Hyperparameters | None = None) -> PipelineModel:
    """M8: gradient-boosted trees on every column but the label."""
    hp = validate_hyperparameters(hp or Hyperparameters())
    model = gbt_pipeline(feature_columns(train, label), label, hp).fit(fit_input(train, label))
    return persist_model(model, train.sparkSession, "gbt")


def train_boosted(train: DataFrame, label: str, hp: Hyperparameters | None = None) -> E.Ensemble:
    """M8: gradient-boosted trees over all rows and every column but the label, as a plain ensemble."""
    hp = validate_hyperparameters(hp or Hyperparameters())
    trial = boost.Trial(hp.learning_rate, hp.max_depth, hp.n_estimators)
    return boost.fit_trials(fit_input(train, label, max_rows=None), feature_columns(train, label), label, [trial])[0]


def score(model: PipelineModel | E.Ensemble, df: DataFrame, out: str = "score") -> DataFrame:
    """M9: P(label = 1) per row, as a double column."""
    if isinstance(model, E.Ensemble):
        return E.score(model, df, out)
    scored = model.transform(df).withColumn(out, vector_to_array(F.col("probability"))[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def feature_importances(spark: SparkSession, model: PipelineModel | E.Ensemble, features: list[str]) -> DataFrame:
    """``(feature, importance)`` of the fitted tree model (importances sum to 1)."""
    if isinstance(model, E.Ensemble):
        imp = model.importances()
    else:
        stage = model.stages[-1]
        if not hasattr(stage, "featureImportances"):
            raise TypeError(f"{type(stage).__name__} has no feature importances")
        imp = stage.featureImportances.toArray().tolist()
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, imp)], "feature string, importance double")


def evaluation_report(scored: DataFrame, label: str, score_col: str = "score") -> DataFrame:
    """Accuracy at 0.5 and AUC in the metric-report shape, as one JSON string row.

    ``standard_deviation`` is the string ``"NaN"`` as in the reference report.
    """
    both = A.auc(scored, label, score_col)
    nan = F.lit("NaN")
    report = F.struct(F.struct(
        F.struct(F.col("accuracy").alias("value"), nan.alias("standard_deviation")).alias("accuracy"),
        F.struct(F.col("auc").alias("value"), nan.alias("standard_deviation")).alias("auc"),
    ).alias("binary_classification_metrics"))
    return both.select("accuracy", "auc", F.to_json(report).alias("report"))


def auc_of(model: PipelineModel | E.Ensemble, df: DataFrame, label: str) -> float:
    return float(A.auc(score(model, df), label).first()["auc"])


def tuning_points(trials: int = TUNING_TRIALS, seed: int = SEED) -> list[tuple[float, int]]:
    """Seeded random search points (learning rate, depth) in the reference's ranges."""
    rng = random.Random(seed)
    lo, hi = TUNING_LR_RANGE
    dlo, dhi = TUNING_DEPTH_RANGE
    return [(round(rng.uniform(lo, hi), 4), rng.randint(dlo, dhi)) for _ in range(trials)]


def tune(train: DataFrame, validation: DataFrame, label: str, trials: int = TUNING_TRIALS,
         trees: int = TUNING_TREES) -> tuple[E.Ensemble, list[dict]]:
    """Fit all trials on all rows of ``train`` in shared passes, score all on ``validation`` in one, rank by AUC (all in one query)."""
    points = tuning_points(trials)
    for lr, depth in points:
        validate_hyperparameters(Hyperparameters(lr, trees, depth))
    fitted = boost.fit_trials(fit_input(train, label, max_rows=None), feature_columns(train, label), label,
                              [boost.Trial(lr, depth, trees) for lr, depth in points])
    scored = E.score_all(fitted, validation, [label])
    auc = {r["model"]: float(r["auc"]) for r in A.auc_by(scored, ["model"], label).collect()}
    out = [{"trial": i + 1, "learning_rate": lr, "max_depth": depth, "n_estimators": trees, "validation_auc": auc[i]}
           for i, (lr, depth) in enumerate(points)]
    return fitted[max(range(len(points)), key=auc.get)], out


def candidates(label: str) -> list[tuple[str, object]]:
    """The fixed candidate list (one estimator family each)."""
    return [
        ("logistic_regression", LogisticRegression(featuresCol="features", labelCol=label, maxIter=50)),
        ("decision_tree", DecisionTreeClassifier(featuresCol="features", labelCol=label, maxDepth=5, seed=SEED)),
        ("random_forest", RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=50,
                                                 maxDepth=5, seed=SEED)),
        ("gbt", Hyperparameters(0.1, 50, 3)),
    ]


def rank_candidates(spark: SparkSession, train: DataFrame, validation: DataFrame, label: str,
                    max_candidates: int = 10, parallelism: int = TUNING_PARALLELISM) -> DataFrame:
    """Fit each candidate (``parallelism`` at a time), evaluate accuracy and AUC on
    ``validation``; returns the candidate table for the leaderboard."""
    features = feature_columns(train, label)
    chosen = candidates(label)
    if len(chosen) > max_candidates:
        raise ValueError(f"{len(chosen)} candidates, at most {max_candidates} allowed")
    tr, va = fit_input(train, label), _prepared(validation, label)

    def run(item):
        name, est = item
        if isinstance(est, Hyperparameters):
            model = boost.fit_trials(tr, features, label, [boost.Trial(est.learning_rate, est.max_depth, est.n_estimators)])[0]
        else:
            model = persist_model(Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features",
                                                                   handleInvalid="keep"), est]).fit(tr), spark, name)
        m = A.auc(score(model, va), label).first()
        return name, "accuracy", float(m["accuracy"]), float(m["auc"])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows = list(pool.map(run, chosen))
    return spark.createDataFrame(rows, "candidate string, metric_name string, value double, auc double")
