"""Spark session defaults and the shared scratch folder.

Every job in this package runs on one ``SparkSession``.  The settings below
are the ones the semantics depend on (UTC session clock, ANSI casts) plus the
ones that matter for scale (adaptive execution, skew handling, partition
sizing).  On a cluster the caller owns the session; ``configure`` only fills
in keys that are still unset, so cluster-level settings always win.
"""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results: timestamps are read and written as UTC and
# bad casts fail loudly, as the warehouse the pipeline was built for does.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only change speed.  AQE re-plans every shuffle boundary from
# measured sizes: it coalesces small partitions, splits skewed join
# partitions and turns a sort-merge join into a broadcast join when one side
# turns out to be small at runtime.
PERF_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast decisions from *measured* shuffle sizes (AQE) may use a higher
    # limit than static ones from estimates; the static threshold stays at
    # Spark's default.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Published tables are read by their folders; a hundred of them are listed faster than a job is started.
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "128",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str | None = None, app_name: str = "tributary",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``shuffle_partitions`` is the *initial* number of shuffle partitions;
    AQE coalesces them down at runtime.  On a cluster size it so that one
    partition holds ~128 MB of the largest shuffle (for 100 TB of input that
    is in the tens of thousands); locally it defaults to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false")
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SEMANTIC_CONF, **PERF_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session.

    The semantic keys are always set (results depend on them); the
    performance keys are set only where the session has no value yet.
    """
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    for key, value in PERF_CONF.items():
        if key == "spark.sql.sources.partitionOverwriteMode":
            continue
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset *and* the session is local
    (tests) a private folder is created and registered.  On a cluster an
    unset value is an error: a machine-local folder is not visible to other
    executors and does not survive losing one.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running jobs that write intermediate tables")
    local = tempfile.mkdtemp(prefix="tributary-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint folder.

    Jobs write each intermediate version to a new folder so that no job ever
    overwrites a path another plan is still reading.  All of them lie in one
    folder per application, which is deleted when the driver program ends.
    """
    base = f"{checkpoint_dir(spark)}/tributary/{spark.sparkContext.applicationId}"
    if base not in _scratch_folders:
        _scratch_folders.add(base)
        atexit.register(_delete_scratch, spark, base)
    return "/".join([base, *parts, uuid.uuid4().hex])


_scratch_folders: set[str] = set()


def _delete_scratch(spark: SparkSession, base: str) -> None:
    """At the end of the program; a session that was stopped before leaves its folder behind."""
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        delete_folder(spark, base)


def _arrow_fs(path: str):
    from pyarrow import fs as pafs
    if "://" not in path:
        return pafs.LocalFileSystem(), path.removeprefix("file:")
    if path.startswith("file://"):
        return pafs.LocalFileSystem(), path[len("file://"):]
    return pafs.FileSystem.from_uri(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) file system.

    Uses the session's Hadoop file system (same credentials and schemes as
    Spark's readers); without a JVM gateway (Spark Connect) it falls back
    to ``pyarrow.fs``.
    """
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # no py4j gateway
        from pyarrow import fs as pafs
        filesystem, local = _arrow_fs(path)
        return filesystem.get_file_info(local).type != pafs.FileType.NotFound
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(conf).exists(p))


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and a constructor of its paths."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def qualified_path(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark's readers and writers give it."""
    fs, make = _hadoop(spark, path)
    return str(fs.makeQualified(make(path)).toString())


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in the folder ``path``; empty if there is none."""
    fs, make = _hadoop(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(make(path))] if fs.exists(make(path)) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, make = _hadoop(spark, path)
    fs.delete(make(path), True)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size on storage of the files under ``paths``."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # no py4j gateway: pyarrow.fs
        from pyarrow import fs as pafs
        total = 0
        for path in paths:
            filesystem, local = _arrow_fs(path)
            info = filesystem.get_file_info(local)
            if info.type == pafs.FileType.Directory:
                infos = filesystem.get_file_info(pafs.FileSelector(local, recursive=True))
                total += sum(i.size or 0 for i in infos if i.type == pafs.FileType.File)
            elif info.type == pafs.FileType.File:
                total += info.size or 0
        return int(total)
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return int(total)


def size_shuffle_partitions(spark: SparkSession, paths: list[str],
                            target_bytes: int = 128 << 20, expansion: float = 3.0) -> int:
    """Set the initial shuffle partition count from the input size.

    ``expansion`` approximates how much larger the shuffled rows are than
    the compressed columnar input.  AQE then coalesces small partitions, so
    over-estimating is cheap while under-estimating means spilling tasks.
    Never below the cluster's default parallelism.
    """
    wanted = math.ceil(input_bytes(spark, paths) * expansion / target_bytes)
    n = max(spark.sparkContext.defaultParallelism, wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
