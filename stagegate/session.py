"""Session helpers.

The library never creates a session on its own: every public function takes the
caller's ``SparkSession`` (or DataFrames bound to one).  ``local_session`` exists
for tests, ``bench.py`` and ``__spark_entry__.py`` only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the checks rely on for stable, comparable results.  AQE is on so that
# shuffle partition counts, broadcast decisions and skewed joins are re-planned
# from runtime statistics instead of guesses.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable-checkpoint files once the DataFrame that wrote them is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stagegate") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("STAGEGATE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only if unset.

    A folder that the session already has stays.  On a cluster ``spark.checkpoint.dir``
    names a shared folder (HDFS/S3/...) and is used as is; a cluster session without one is an error.  Only a local-mode
    session without one (tests) gets a fresh temporary folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:  # set before, by the caller or by an earlier build: kept
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a shared folder (HDFS/S3/...) before building version history on a cluster"
        )
    path = tempfile.mkdtemp(prefix="stagegate-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


# the folder of this application's tables below each checkpoint folder
_ROOTS: dict[tuple[str, str], str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the session's checkpoint folder, which driver and executors share; nothing is there yet.

    All of an application's paths lie in one folder, which goes when the driver's JVM ends: results that
    read them are lazy, so they must outlive the call that wrote them.
    """
    base = (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")
    key = (spark.sparkContext.applicationId, base)
    if key not in _ROOTS:
        root = f"{base}/stagegate-{uuid.uuid4().hex}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)  # only what exists can be marked
        fs.deleteOnExit(path)
        _ROOTS[key] = root
    return f"{_ROOTS[key]}/{name}-{uuid.uuid4().hex}"
