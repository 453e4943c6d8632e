"""Spark session settings and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI stays on (Spark 4 default): every
# division in the library is written ``x / nullif(y, 0)`` or ``try_divide``.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "adsphere", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; size
    ``spark.sql.shuffle.partitions`` to the data (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that value
    is always used.  Only a local-mode session without the setting (tests,
    benchmarks) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
        configured = tempfile.mkdtemp(prefix="adsphere-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for materialised tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{name}"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """``values`` as the session's SQL settings inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# The shuffle files of a write are removed when it ends, not when the driver's garbage collector finds them.
OWN_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

_SCOPES: list[list[str]] = []


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the tables :func:`materialize` writes inside the block when it ends.

    For jobs whose results are written elsewhere before the block ends (the
    daily job); frames still reading a scratch table must not outlive it.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.pop()  # scopes may be nested
        for p in paths:
            _delete(spark, p)


def materialize(df, name: str, outlives: bool = False):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()`` but stores columnar, compressed files
    (reliable RDD checkpoints serialise row objects, several times slower
    for rows holding arrays).  A lost executor rereads the files instead of
    recomputing the plan.  A table that ``outlives`` the innermost
    :func:`scratch_scope` belongs to the one around it.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with settings(spark, OWN_SHUFFLES):
        df.write.mode("overwrite").parquet(path)
    scopes = _SCOPES[:-1] if outlives else _SCOPES
    if scopes:
        scopes[-1].append(path)
    return spark.read.parquet(path)
