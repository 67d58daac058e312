"""Session construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on.  Time semantics are wall-clock
# (timestamp_ntz inside the engine); UTC keeps LTZ conversions neutral.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "custvalue",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's baseline settings.

    On a cluster ``master`` stays None and the launcher decides; tests pass
    ``local[N]``.  Shuffle partitions default to Spark's own value unless
    given: at 100 TB they should be sized to ~128-256 MB per partition and
    AQE coalesces the small ones.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (shared storage).  Only
    when it is unset -- local tests -- a fresh private folder is created and
    registered, so lineage cuts and stream checkpoints have a home.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:   # no driver-side context (remote session): the setting rules
        sc = None
    if not root and sc is not None:
        jdir = sc._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="custvalue-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the checkpoint root for one run, made through
    Hadoop's file system like every other access to it."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint): the data lives on
    shared storage, not in executor block managers.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Each query inside gives up its shuffle files when it ends, not when the driver happens to
    collect its garbage.  For queries that end in a write or an action and fill no cache."""
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, old)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder through Hadoop's file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


SCAN_PARTITIONS = "spark.custvalue.scanPartitions"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition a scan on ``keys`` into as many partitions as the setting
    ``spark.custvalue.scanPartitions`` names; without the setting ``df`` as it is.

    For single small files, which one task would read and process whole.  The
    setting is explicit: no size is looked at, and at scale it stays unset.
    """
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n), *keys) if n else df
