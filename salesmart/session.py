"""Session helpers: a configured builder for tests/benchmarks and the shared
scratch folder used to cut lineage.

On a cluster the session is the user's; the library only *reads* its
configuration.  ``spark.checkpoint.dir`` names the shared folder for
checkpoints and staged tables; we set our own only where it is unset (tests,
local runs), never a machine-local folder on a cluster.
"""

from __future__ import annotations

import contextlib
import logging
import os
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans in this package: AQE re-plans joins at
# runtime (broadcast only when the measured side is small, otherwise
# sort-merge with skewed partitions split), ANSI for strict casts, UTC so
# current_date()/date parsing are repeatable.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable-checkpoint files once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(
    app: str = "salesmart",
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    """A local session with the package's recommended configuration."""

    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, creating a local one
    only when the session names none (tests, single-machine runs)."""

    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(
                "spark.checkpoint.dir is not set: name a folder every executor can "
                "reach (HDFS/object store) before running on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="salesmart-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for staged data."""

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/salesmart-{name}-{uuid.uuid4().hex[:12]}"


def local_dir(path: str) -> str | None:
    """The local directory behind ``path`` if it is a local path."""

    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return path if os.path.isabs(path) else None


# Settings the plans rely on at scale, and what goes wrong without them.
_EXPECTED = {
    "spark.sql.adaptive.enabled": ("true", "joins on exception sets and parent keys cannot switch "
                                           "to broadcast at run time; skewed keys are not split"),
    "spark.sql.adaptive.skewJoin.enabled": ("true", "a key holding a large share of rows stays in one task"),
}


def check_session(spark: SparkSession) -> list[str]:
    """Warnings for session settings the plans depend on (AQE, skew join,
    a configured checkpoint folder on a cluster); also logged."""

    warnings = []
    for key, (want, why) in _EXPECTED.items():
        got = str(spark.conf.get(key, want)).lower()
        if got != want:
            warnings.append(f"{key}={got}: {why}")
    sc = spark.sparkContext
    if not sc.master.startswith("local") and not (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)):
        warnings.append("spark.checkpoint.dir is unset: checkpoints and staged files need a shared folder")
    log = logging.getLogger("salesmart")
    for w in warnings:
        log.warning(w)
    return warnings


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict):
    """Set runtime SQL settings for the duration of a block, then restore
    the caller's values."""

    previous = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in previous.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


ROW_GROUP = 8 << 20
_STAGED: dict[str, list[str]] = {}  # application id -> folders it staged


def staged_copy(df: DataFrame, name: str, compression: str | None = None, distinct: Iterable[str] = ()) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read again.

    The lineage ends there, so a lost executor costs a re-read, and the planner
    knows the size of what it joins.  Row groups are small (``ROW_GROUP``
    bytes), so what few tasks wrote is read by many, and a task buffers little.
    ``compression``: that of the session by default.  ``distinct``: columns whose
    values hardly repeat, which are written as they are, not by way of a dictionary."""

    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("parquet.block.size", ROW_GROUP)
    for column in distinct:
        writer = writer.option(f"parquet.enable.dictionary#{column}", "false")
    writer.parquet(path, compression=compression)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release_staged(spark: SparkSession) -> int:
    """Delete what ``staged_copy`` wrote in this application; DataFrames that
    read it fail afterwards.  Returns the number of folders."""

    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)
