"""Session settings, the shared scratch folder and written intermediate tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on; all can be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs the next operator another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sessions of one key are merged inside each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload what changed instead of whole state files at each micro-batch.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_scratch: str | None = None
_intermediate: list[str] = []
_tried: set[str] = set()


def build_session(app_name: str = "meterlane", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or fetch) a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {"spark.ui.enabled": "false", **RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that someone else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``.

    Where the setting is absent, the folder given to ``SparkContext.setCheckpointDir`` is
    taken, else one in the warehouse; a machine-local folder only in local mode, as in tests.
    """
    global _local_scratch
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and _one_process(spark):
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix=f"meterlane-{os.getpid()}-")
        return _local_scratch
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/meterlane").rstrip("/")


def _one_process(spark: SparkSession) -> bool:
    """Whether the driver runs all tasks: ``local`` or ``local[n]``, not ``local-cluster``."""
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system; without a scheme it lies on the default one, as for Spark itself."""
    if "://" in path:
        return path
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = store.makeQualified(place).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def _try(spark: SparkSession, root: str) -> None:
    """Raise if the driver doesn't see what executors write to the folder."""
    path, rows = f"{root}/probe-{uuid.uuid4().hex}", max(2, spark.sparkContext.defaultParallelism)
    spark.range(0, rows, 1, rows).write.parquet(path)
    if spark.read.schema("id long").parquet(path).count() != rows:
        raise RuntimeError(f"{root} is another folder on each machine; set spark.checkpoint.dir to one that all share")


def slice_count(spark: SparkSession) -> int:
    """Number of slices for range partitioning: the larger of the two shuffle settings."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(first or 0))


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared root; nothing is created yet.

    On a cluster, a root on local disks is tried once: rows must come back from it.
    """
    root = shared_root(spark)
    if root != _local_scratch:
        root = _qualified(spark, root)
        if root.startswith("file:") and root not in _tried and not _one_process(spark):
            _try(spark, root)
            _tried.add(root)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: whatever reads the result twice sees identical rows, also
    after executors were lost and tasks re-run.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    _intermediate.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Empty all intermediate tables written so far; returns how many.

    To be called once the results built on them have been stored: frames that still
    read them find no rows afterwards.
    """
    released = 0
    while _intermediate:
        spark.range(0).write.mode("overwrite").parquet(_intermediate.pop())
        released += 1
    return released
