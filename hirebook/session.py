"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans: AQE re-plans joins from measured
# shuffle sizes (runtime broadcast of small sides, skew-join splitting,
# partition coalescing); ANSI stays on, so try_* marks every NULL-on-error.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster (hundreds of executors, tens of TB per report):
# start with many shuffle partitions and let AQE coalesce them to ~256 MB;
# split input files into 256 MB tasks; treat a partition 5x the median and
# over 512 MB as skewed and split it. Spark's defaults are tuned for far
# smaller jobs.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf_for(spark: SparkSession) -> None:
    """Apply the SQL part of ``CLUSTER_CONF`` to a running session."""
    for k, v in CLUSTER_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def session_conf(master: str | None, shuffle_partitions: int = 8, extra: dict | None = None) -> dict:
    """The settings of ``build_session``: ``DEFAULT_CONF`` and, with a master
    given here, the shuffle partitions of a local run. Without one the
    launcher decides on those; what it leaves open gets ``CLUSTER_CONF``."""
    conf = dict(DEFAULT_CONF)
    if master:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    else:
        from pyspark import SparkConf
        given = SparkConf()
        conf.update({k: v for k, v in CLUSTER_CONF.items() if not given.contains(k)})
    conf.update(extra or {})
    return conf


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app: str = "hirebook", extra: dict | None = None) -> SparkSession:
    """A session with ``session_conf``; ``master=None`` leaves the master to
    the launcher (cluster runs), ``extra`` overrides any setting."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in session_conf(master, shuffle_partitions, extra).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # no driver-side context (Spark Connect)
        pass
    ensure_checkpoint_dir(spark)
    return spark


_KEPT: list[DataFrame] = []


def keep(df: DataFrame) -> DataFrame:
    """``df``, to be kept once an action computes it, until ``release``. Only
    for what several parts of one report read; nothing runs here."""
    _KEPT.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return _KEPT[-1]


def release() -> int:
    """Free all that ``keep`` holds; how many there were. Reports built before
    stay right, they compute again what they shared."""
    n = len(_KEPT)
    while _KEPT:
        try:
            _KEPT.pop().unpersist()
        except Exception as e:  # its session has ended, and its blocks with it
            if "stopped" not in str(e) and "Connection refused" not in str(e):
                raise
    return n


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used as is. A local
    session without one gets a private folder; on a cluster that is an error,
    since a machine's own folder would be lost with it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no driver-side context, use the conf
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="hirebook-ckpt-")
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def session_id(spark: SparkSession) -> str:
    """An id of the running application (for per-session caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    unless the session itself is local). It goes when the driver ends."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hirebook-{session_id(spark)}"
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None:  # not over Spark Connect
        where = jvm.org.apache.hadoop.fs.Path(root)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(where):
            fs.mkdirs(where)
            fs.deleteOnExit(where)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["CLUSTER_CONF", "DEFAULT_CONF", "build_session", "cluster_conf_for", "ensure_checkpoint_dir", "keep", "release",
           "scratch_path", "session_id"]
