"""Session settings and the shared scratch folder.

Every operator in the package is a ``DataFrame -> DataFrame`` function; this
module only pins the few session settings the semantics depend on (UTC, ANSI)
and finds the shared folder used for written intermediates.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on.  UTC: calendar fields of NTZ timestamps and
# unix_timestamp read in the session zone.  ANSI: bad casts / x/0 raise, so the
# operators use try_cast / try_divide where the reference tolerates them.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Execution settings: AQE re-plans joins and coalesces small shuffles at run
# time and splits skewed join partitions.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def _workers_find_package(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did (on a cluster: where it is installed alike)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def configure(spark: SparkSession) -> SparkSession:
    _workers_find_package(spark)
    for k, v in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "farebox") -> SparkSession:
    """Session for tests and the bench (single JVM)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SEMANTIC_CONF, **EXECUTION_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir).  Where neither is set, a single-process master (tests, a laptop) gets a fresh
    folder that goes when the process ends; a cluster raises, since executors
    would each write to their own disk.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="farebox-ckpt-")
            atexit.register(shutil.rmtree, root, ignore_errors=True)
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A new folder path under the shared checkpoint root (not created)."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, "farebox", *parts, uuid.uuid4().hex[:12]])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop-filesystem existence check (works for any URI scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def list_files(spark: SparkSession, path: str, suffix: str = "", non_empty: bool = False) -> list[str]:
    """Names of files directly under ``path`` (metadata only, no data)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out = []
    for st in fs.listStatus(hpath):
        name = st.getPath().getName()
        if (st.isFile() and name.endswith(suffix) and not name.startswith(("_", "."))
                and (not non_empty or st.getLen() > 0)):
            out.append(st.getPath().toString())
    return sorted(out)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes under the given paths from filesystem metadata (no data is read)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        fs = hpath.getFileSystem(conf)
        if fs.exists(hpath):
            total += int(fs.getContentSummary(hpath).getLength())
    return total


MB = 1024 * 1024


MAX_SHUFFLE_PARTITIONS = 40_000


def scale_settings(total_input_bytes: int, total_cores: int, shuffled_share: float = 0.1) -> dict[str, str]:
    """Session settings sized from the input volume (e.g. 100 TB on 1,000 executors).

    * scan splits of 256 MB (Parquet row groups are read whole; fewer, larger tasks);
    * initial shuffle partitions so each holds ~200 MB of the shuffled bytes
      (``shuffled_share`` of the input; most plans shuffle narrow rows), at least 3
      waves of tasks over the cores and at most ``MAX_SHUFFLE_PARTITIONS``: every map task
      writes an index entry per partition; AQE merges small ones at run time;
    * skew split above 512 MB, or 5x the median partition;
    * coalescing respects the advisory size instead of maximising parallelism.
    """
    shuffle = min(MAX_SHUFFLE_PARTITIONS, -(-int(total_input_bytes * shuffled_share) // (200 * MB)))
    shuffle = max(3 * total_cores, shuffle)
    return {
        "spark.sql.files.maxPartitionBytes": str(256 * MB),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def configure_for_scale(spark: SparkSession, paths: list[str], total_cores: int | None = None) -> dict[str, str]:
    """Measure the inputs and apply :func:`scale_settings` to the session; returns what was set."""
    cores = total_cores or spark.sparkContext.defaultParallelism
    settings = scale_settings(input_bytes(spark, paths), cores)
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings
