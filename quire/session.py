"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness of the operators (not just speed).
CORRECTNESS_CONF = {
    # Text offsets and integer-microsecond clocks are computed in UTC.
    "spark.sql.session.timeZone": "UTC",
}

# A Python step holds a batch and the next one, whatever the size of the table:
# Spark's own bound is 64 MB for each.
BOUNDED_CONF = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}

# Settings for scale: AQE re-plans joins from runtime sizes (a measured
# bound before any broadcast) and splits skewed shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "quire",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings.

    On a cluster ``master`` stays None so spark-submit decides; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {**SCALE_CONF, **CORRECTNESS_CONF, **BOUNDED_CONF, **(extra or {})}
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the correctness settings and the bound of Arrow batches on a session
    someone else created and make the package importable by the Python workers."""
    for k, v in {**CORRECTNESS_CONF, **BOUNDED_CONF}.items():
        spark.conf.set(k, v)
    ship_package(spark)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """``addPyFile`` a zip of this package once per SparkContext, so the
    Python steps (``mapInPandas``) import it on every executor."""
    sc = _context(spark)
    if sc is None or id(sc) in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="quire-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(id(sc))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one: a folder of our own would be a different disk
    on each executor, so its absence is an error there. Only a ``local``
    master (tests, the bench), where everything runs on one machine, gets a
    temporary folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the driver and the executors")
        d = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # remote (Connect) sessions have no SparkContext
        return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a written intermediate table inside the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def materialize(df):
    """Cut lineage: write the rows once as a Parquet table in the shared
    folder named by ``spark.checkpoint.dir`` and read them back.

    Used after non-deterministic steps (model calls, physical slice ids) and
    for results several branches reuse, so every later branch and every
    retried task sees the same rows and the work runs once (an RDD
    checkpoint would compute the plan twice: once to count, once to write).
    """
    import uuid
    spark = df.sparkSession
    path = scratch_path(spark, f"m-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
