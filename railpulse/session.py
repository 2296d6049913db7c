"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Configuration that suits these jobs at any size: adaptive execution re-plans
# joins from real sizes (broadcast only what proves small at run time), merges
# tiny shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of dense ids, medians and KPI 3 are removed once the
    # checkpointed data is no longer referenced, instead of piling up in the
    # shared folder run after run.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app: str = "railpulse",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context_dir(spark: SparkSession) -> str | None:
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # a session without a local SparkContext (Spark Connect)
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    return _context_dir(spark) or spark.conf.get("spark.checkpoint.dir", None) or None


class MissingCheckpointDirError(RuntimeError):
    pass


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "local")
    return master.startswith("local") and not master.startswith("local-cluster")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's checkpoint folder. Only a local master (tests, local
    runs) gets a private one when none is configured: on a cluster a folder of
    the driver's machine is not shared, so a missing setting is an error."""
    d = checkpoint_dir(spark)
    if not d:
        if not _is_local(spark):
            raise MissingCheckpointDirError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="railpulse-ckpt-")
    if not _context_dir(spark):
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:  # no local SparkContext: the session setting names it
            spark.conf.set("spark.checkpoint.dir", d)
    return _context_dir(spark) or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for a materialised
    intermediate table (never a machine-local temp folder on a cluster).
    Delete it with ``drop_scratch`` once nothing reads it any more; what is left
    goes when the driver ends."""
    base = ensure_checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    path = f"{base}{sep}tables/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_drop_all_scratch, spark)
    _SCRATCH.add(path)
    return path


_SCRATCH: set[str] = set()


def _drop_all_scratch(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is None:  # stopped before: nothing can be reached any more
        return
    for path in list(_SCRATCH):
        drop_scratch(spark, path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` named, through Spark's file system."""
    if "/tables/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    _SCRATCH.discard(path)


__all__ = ["build_session", "checkpoint_dir", "ensure_checkpoint_dir", "scratch_path", "drop_scratch", "MissingCheckpointDirError",
           "DEFAULT_CONF"]
