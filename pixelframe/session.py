"""Session, checkpoint and path helpers.

The shared folder for lineage cuts and scratch output is the one the
cluster names in ``spark.checkpoint.dir``.  A private folder is only
created when that setting is absent (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every session of this library wants; cluster-level sizing
# (executor memory, shuffle partitions for 100 TB) is left to the submitter.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "pixelframe",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    """One JVM on one machine (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir``.  Where it is unset, a private folder is
    created for a local session (a laptop, tests); on a cluster that is an
    error, since executors would each write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not _is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder "
                               "that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="pixelframe-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


# scratch paths and tables by application id, for ``release_scratch``
_SCRATCH: dict[str, tuple[list[str], list[str]]] = {}


def _scratch_of(spark: SparkSession) -> tuple[list[str], list[str]]:
    return _SCRATCH.setdefault(spark.sparkContext.applicationId, ([], []))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/pixelframe-scratch/{name}-{uuid.uuid4().hex}"
    _scratch_of(spark)[0].append(path)
    return path


def scratch_table(spark: SparkSession, name: str) -> str:
    """Note a catalog table over scratch files, to be dropped with them."""
    _scratch_of(spark)[1].append(name)
    return name


def release_scratch(spark: SparkSession) -> int:
    """Drop the scratch tables and delete the scratch folders of this session.

    Call it when the frames read from them are done with: scratch tables stay
    until then, as frames are lazy.  Returns the number of folders deleted."""
    paths, tables = _scratch_of(spark)
    for t in tables:
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    conf, n = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        n += bool(path.getFileSystem(conf).delete(path, True))
    paths.clear()
    tables.clear()
    return n


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder and return a frame
    that reads it back: later branches do not rescan the input, and a lost
    executor does not replay the upstream plan.  (Never ``localCheckpoint``:
    that keeps blocks on executors that may disappear.)"""
    checkpoint_dir(df.sparkSession)
    # persisted first, so the checkpoint write reads the cache instead of
    # recomputing the plan a second time
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
