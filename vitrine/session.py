"""Session construction and shared storage locations.

Library code never picks machine-local folders on its own: durable outputs
(pre-aggregates, document snapshots, stream state) go under the shared store
root, and lineage is cut under the folder the cluster names in
``spark.checkpoint.dir``.  Only when a setting is unset (local tests) do we
fall back to a scratch folder, and only on a ``local`` master.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

STORE_CONF = "spark.vitrine.store"
# Where a local session without a checkpoint folder keeps its scratch folder's name.
SCRATCH_CONF = "spark.vitrine.storeScratch"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "vitrine", driver_memory: str | None = None) -> SparkSession:
    """Session with AQE, skew-join handling and a UTC clock.

    Broadcasts are left to the planner's size check
    (``spark.sql.autoBroadcastJoinThreshold``, re-checked by AQE against
    runtime shuffle sizes), so no side is broadcast on a guess.  Settings
    that belong to the cluster (shuffle partitions, memory) are only set
    when an argument asks for them.
    """
    b = (SparkSession.builder.appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    if master:
        b = b.master(master)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_HADOOP: dict[int, tuple] = {}


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """A Hadoop path and its file system (their Java classes are looked up once per context)."""
    sc = spark.sparkContext
    if id(sc) not in _HADOOP:
        _HADOOP.clear()
        _HADOOP[id(sc)] = sc, sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration()
    _, new, conf = _HADOOP[id(sc)]
    p = new(path)
    return p, p.getFileSystem(conf)


def _one_machine(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _shared(spark: SparkSession, path: str) -> str:
    """``path``, unless it names a machine's own disk on a cluster of several."""
    if not _one_machine(spark) and hadoop_path(spark, path)[1].getScheme() == "file":
        raise RuntimeError(f"{path} is on a local disk; on a cluster it has to be on storage that all executors share")
    return path.rstrip("/")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` made.

    Spark itself needs this folder to be shared, so it is taken as it is
    named: a ``file:`` path is a mount that all machines have.
    """
    d = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
         or spark.conf.get(SCRATCH_CONF, None))
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="vitrine-ckpt-")
        spark.conf.set(SCRATCH_CONF, d)
    return d.rstrip("/")


def store_root(spark: SparkSession) -> str:
    """Root folder for persisted pre-aggregates and document snapshots.

    ``spark.vitrine.store`` if set, else ``<checkpoint dir>/vitrine-store``.
    """
    d = spark.conf.get(STORE_CONF, None)
    return _shared(spark, d) if d else checkpoint_root(spark) + "/vitrine-store"
