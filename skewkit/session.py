"""Session helpers: a tuned local session for tests/bench, and the shared
scratch folder every staged write goes to.

On a cluster the session is built by the platform; skewkit only *reads*
``spark.checkpoint.dir`` from it, and refuses to stage anything if it is
unset. A private folder is created only for a local master without that
setting (local tests and benches).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "skewkit", extra: dict | None = None) -> SparkSession:
    """Local session with AQE, skew-join splitting and the UI switched off."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # keyed streaming state in RocksDB (off-heap, spills to local disk, checkpointed)
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        # commit a changelog per batch instead of uploading a snapshot each time
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    With a local master and no such setting, a private folder is made. With any other
    master that is an error: executors would each write to a disk of their own.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not _is_local(spark):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="skewkit-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


_staged: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Used for staged text/ORC copies, stream sources, sinks and checkpoints,
    so every executor (and a re-run task) sees the same files. ``release_scratch``
    removes it, at the latest when the driver program ends.
    """
    path = os.path.join(ensure_checkpoint_dir(spark), "skewkit", f"{name}-{uuid.uuid4().hex[:12]}")
    if not _staged:
        atexit.register(_release_all, spark)
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession, keep: set[str] | frozenset[str] = frozenset()) -> list[str]:
    """Remove the folders that ``scratch_path`` gave out in this application, but for ``keep``.

    Call it once the results that read them are written or collected. Returns what it removed.
    """
    app = spark.sparkContext.applicationId
    gone = [p for p in _staged.get(app, []) if p not in keep]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    _staged[app] = [p for p in _staged.get(app, []) if p in keep]
    return gone


def staged_paths(spark: SparkSession) -> set[str]:
    """The scratch folders of this application that have not been released."""
    return set(_staged.get(spark.sparkContext.applicationId, []))


def _release_all(spark: SparkSession) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            release_scratch(spark)
    except Exception:  # the JVM is gone: nothing more can be done from here
        pass


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let this application's Python workers import skewkit, wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="skewkit-ship-")      # the driver serves the archive from here
    archive = shutil.make_archive(os.path.join(folder, "skewkit-package"), "zip", root, "skewkit")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
