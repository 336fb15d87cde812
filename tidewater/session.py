"""Session defaults and the shared scratch location.

Everything time-related is pinned to UTC so that ``to_date``/``hour`` and
window boundaries do not depend on the machine. Shared intermediate data
(checkpoints, staged tables, stream checkpoints) lives under the folder the
cluster names in ``spark.checkpoint.dir``; only when that is unset (unit tests,
a laptop) do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings that may be changed on a running session (SQL confs).
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # RocksDB state: upload change logs per micro-batch, snapshots in the background
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Dynamic partition overwrite is requested per write (``write_table(...,
# dynamic=True)``, ``upsert_partitioned_table``), never switched on for the
# whole session.


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "tidewater",
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library's defaults."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_DEFAULTS.items():
        builder = builder.config(k, v)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings on a session someone else created."""
    for k, v in RUNTIME_DEFAULTS.items():
        spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (or an already-set SparkContext
    checkpoint dir). Only when neither is set and the master is local (unit
    tests, a laptop) do we create a folder; on a cluster a folder of one machine
    would be unseen by the others, so that raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return configured
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return configured or os.path.dirname(current.rstrip("/"))
    if not configured and not sc.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = configured or tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique directory path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidewater/{label}-{uuid.uuid4().hex[:12]}"


def stage(df, label: str):
    """Cut the lineage: write ``df`` as Parquet under the shared checkpoint
    folder and read it back. Unlike ``Dataset.checkpoint`` the input is
    computed once, the copy is columnar and compressed, and the planner gets
    real size statistics (so later joins can be broadcast when small). After
    an executor loss only the staged files are re-read, not the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_if_there(spark: SparkSession, path: str, fmt: str = "parquet"):
    """The table at ``path``, or None if there is none yet (no such path, or no
    data file in it). Every other failure is raised: a storage error is no
    empty table."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _store(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    """Delete a directory in whatever store it is in; none is no error."""
    where, store = _store(spark, path)
    store.delete(where, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories right under ``path``."""
    where, store = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(where) if s.isDirectory())
