"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session gets.  AQE re-plans joins from measured shuffle sizes
# (broadcast only what really is small, split skewed partitions) and coalesces
# small shuffle partitions; the session zone is UTC so date boundaries match the
# SQL oracle.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "strata",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count then stays whatever the cluster configured (AQE coalesces
    it down at runtime).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/S3/...) folder there and it is used as is.
    Only when it is unset in a local session (tests) a private folder is made;
    on a cluster that is an error, since executors don't see each other's disks.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d and current:
        return current
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # a static conf on some deployments; the context dir below suffices
            pass
    strip = lambda x: str(x).replace("file://", "").replace("file:", "").rstrip("/")
    if current is None or not strip(current).startswith(strip(d)):
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
