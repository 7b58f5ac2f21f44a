"""Run log, metric scraping, leaderboard and the quality gate.

Runs and model versions are ordinary tables: each training or tuning run
appends one row, comparisons are queries over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------- fixed values
# Metric line pattern printed by training (``name=value``) and the metric names scraped.
METRIC_PATTERNS = {
    "validation:accuracy": r"validation_accuracy=([0-9\.]+)",
    "validation:auc": r"validation_auc=([0-9\.]+)",
}
AUC_GATE = 0.55  # register only when AUC >= this value (equality passes)
APPROVED = "Approved"
LEADERBOARD_NAME_CHARS = 44
RUN_NAME_CHARS = 60
# ------------------------------------------------------------------------------


def metric_lines(metrics: DataFrame, names: dict[str, str]) -> DataFrame:
    """Render metric columns of a one-row frame as ``name=value`` text lines (4 decimals)."""
    lines = [F.concat(F.lit(f"{line}="), F.format_number(F.col(col), 4).cast("string")) for col, line in names.items()]
    return metrics.select(F.explode(F.array(*[F.regexp_replace(l, ",", "") for l in lines])).alias("value"))


def metrics_from_log(lines: DataFrame, patterns: dict[str, str] | None = None, text: str = "value") -> DataFrame:
    """First capture group per metric name, as doubles; lines without a match give nothing."""
    patterns = METRIC_PATTERNS if patterns is None else patterns
    parts = []
    for name, rx in patterns.items():
        v = F.regexp_extract(F.col(text), rx, 1)
        parts.append(lines.where(v != "").select(F.lit(name).alias("metric_name"),
                                                  v.try_cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_log_rows(runs: DataFrame, prefix: str = "") -> DataFrame:
    """Normalise a run table: run name without ``prefix``, metric names with ':' -> '_'.

    The whole name stays the key; :func:`compare_runs` cuts it for display.

    ``runs`` has ``run_name, learning_rate, max_depth, n_estimators, metric_name, value``.
    """
    name = F.col("run_name")
    if prefix:
        name = F.replace(name, F.lit(prefix), F.lit(""))
    return runs.select(
        name.alias("run_name"),
        "learning_rate", "max_depth", "n_estimators",
        F.replace(F.col("metric_name"), F.lit(":"), F.lit("_")).alias("metric_name"),
        F.col("value").cast("double").alias("value"),
    )


def append_rows(rows: DataFrame, path: str) -> DataFrame:
    """Append rows to a run / model-version table (Parquet at ``path``) and return the whole table."""
    rows.write.mode("append").parquet(path)
    return rows.sparkSession.read.parquet(path)


def compare_runs(run_log: DataFrame, metrics: list[str]) -> DataFrame:
    """M13 comparison view: one row per run, one column per metric (``pivot`` with a fixed value list),
    run names cut to 60 characters after the grouping."""
    return (run_log.groupBy("run_name", "learning_rate", "max_depth", "n_estimators")
            .pivot("metric_name", metrics).agg(F.max("value"))
            .withColumn("run_name", F.substring("run_name", 1, RUN_NAME_CHARS)))


def leaderboard(candidates: DataFrame, metric: str = "value", name: str = "candidate") -> DataFrame:
    """L3: sort by metric desc, 1-based rank, name cut to 44 characters.

    The window is un-partitioned on purpose: it runs over the candidate table
    (at most a few dozen rows), never over fact data.
    """
    w = Window.orderBy(F.desc(metric), F.asc(name))
    return candidates.select(F.row_number().over(w).alias("rank"),
                             F.substring(F.col(name), 1, LEADERBOARD_NAME_CHARS).alias(name), *[
                                 c for c in candidates.columns if c != name])


def best_run(trials: DataFrame, objective: str = "validation_auc", run: str = "trial") -> DataFrame:
    """L4: the run with the highest objective (``max_by``; a one-row aggregate)."""
    return trials.agg(F.max_by(F.col(run), F.col(objective)).alias(f"best_{run}"),
                      F.max(objective).alias(f"best_{objective}"))


def quality_gate(report: DataFrame, threshold: float = AUC_GATE, version_fields: dict | None = None) -> DataFrame:
    """Read ``binary_classification_metrics.auc.value`` from the JSON report; keep it when >= threshold.

    Returns the model-version rows to append (empty when the gate fails).
    """
    auc = F.get_json_object(F.col("report"), "$.binary_classification_metrics.auc.value").cast("double")
    acc = F.get_json_object(F.col("report"), "$.binary_classification_metrics.accuracy.value").cast("double")
    out = report.select(auc.alias("auc"), acc.alias("accuracy"), F.col("report").alias("model_metrics"))
    out = out.where(F.col("auc") >= F.lit(threshold)).withColumn("approval_status", F.lit(APPROVED))
    for k, v in (version_fields or {}).items():
        out = out.withColumn(k, F.lit(v))
    return out


def baseline_rows(metrics_long: DataFrame, check: str, version: int = 1) -> DataFrame:
    """Tag a metric table as a registered baseline (no comparison on the first run)."""
    return metrics_long.withColumns({"check_name": F.lit(check), "baseline_version": F.lit(version)})
