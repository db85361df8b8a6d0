"""Session helpers: sane defaults for tests and benches, checkpoint dir handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "barwright", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint dir; set a scratch one only when unset (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           "(lineage cuts and scratch tables are written there)")
    # local mode only (tests, single-machine runs): a scratch folder of this machine
    path = tempfile.mkdtemp(prefix="barwright-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the session's checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base.replace("file:", ""), f"{name}-{os.urandom(6).hex()}")
    return path


def materialize(df):
    """Cut lineage: write ``df`` to the session's reliable checkpoint dir and read it back.

    The result keeps ``df``'s output partitioning, so windows and joins on the same keys
    downstream need no new shuffle.  Survives executor loss (unlike a local checkpoint).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_PERSISTED: list = []


def keep(df, level=None):
    """Persist ``df`` (memory, spilling to disk) and remember it for ``release``.  Lost
    blocks are recomputed from lineage, which starts at a reliable checkpoint."""
    from pyspark import StorageLevel
    out = df.persist(level or StorageLevel.MEMORY_AND_DISK)
    _PERSISTED.append(out)
    return out


def release() -> int:
    """Unpersist every intermediate kept by the operators; returns how many."""
    n = 0
    while _PERSISTED:
        _PERSISTED.pop().unpersist()
        n += 1
    return n
