"""Session helpers: building a local session for tests and benches, and
making sure reliable checkpoints have a directory to write to."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library wants; a cluster deployment passes
# its own values through spark-submit and these only fill gaps.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerline") -> SparkSession:
    """Local session for tests and the bench (not used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LEDGERLINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="ledgerline-wh-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    On a cluster the shared folder comes from ``spark.checkpoint.dir`` and a
    missing setting is an error; a machine-local temporary folder is used
    only in local mode (tests and benches).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[.*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-ckpt-", dir="/tmp"))
    else:
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return sc.getCheckpointDir()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def dropped_shuffles(spark: SparkSession):
    """Shuffle files of a query that runs inside the block are deleted when it
    ends, not when the driver next collects garbage.  For a large write whose
    plan does not run again."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerline`` importable in Python workers (the programmatic
    form of ``--py-files``), once per application.  Needed only by the
    pandas UDF / applyInPandas steps.

    Skipped when the application was submitted with the package in
    ``spark.submit.pyFiles``.  On a cluster the archive is put in the shared
    checkpoint folder and added from there; in local mode it is added from
    the driver's disk.
    """
    import shutil
    import uuid

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    submitted = sc.getConf().get("spark.submit.pyFiles", "") or ""
    if "ledgerline" in submitted:
        _SHIPPED.add(app)
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out_dir = tempfile.mkdtemp(prefix="ledgerline-pyfiles-")
    archive = shutil.make_archive(
        os.path.join(out_dir, "ledgerline"), "zip", root_dir=os.path.dirname(pkg_dir), base_dir="ledgerline"
    )
    if not sc.master.startswith("local"):
        base = ensure_checkpoint_dir(spark).rstrip("/")
        remote = f"{base}/ledgerline-pyfiles-{uuid.uuid4().hex}/ledgerline.zip"
        jvm = spark._jvm
        dst = jvm.org.apache.hadoop.fs.Path(remote)
        dst.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(
            jvm.org.apache.hadoop.fs.Path(archive), dst
        )
        archive = remote
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes under the given paths (Hadoop FileSystem, any scheme)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    return total


def suggest_shuffle_partitions(
    spark: SparkSession, paths: list[str], target_bytes: int = 128 * 1024 * 1024
) -> int:
    """Initial shuffle partitions so each holds about ``target_bytes`` of the
    input (never fewer than the cluster's cores); AQE coalesces the small
    ones at runtime, so erring high is cheap while erring low spills."""
    import math

    n = math.ceil(input_bytes(spark, paths) / target_bytes)
    return max(spark.sparkContext.defaultParallelism, n)
