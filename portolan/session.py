"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark import InheritableThread, SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins and coalesces shuffle
# partitions from runtime sizes; skew join splits hot partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Bloom filters for joins that shuffle: of port dimensions too large to
    # broadcast (Spark's bound is 10 MB); a filter has at most 8 MB itself.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "4g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large run, sized from the input volume.

    The initial shuffle partition count aims at ``target_partition_bytes``
    per task for the largest shuffle (the raw-arrival distinct moves about
    the input volume), however large the input is; AQE then coalesces small
    partitions and splits skewed ones, so over-estimating is cheap. Lost executors are tolerated
    by recomputing from lineage; decommissioning migrates shuffle blocks
    first where the cluster manager supports it.
    """
    partitions = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.task.maxFailures": "8",
    }


def path_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes stored under ``paths`` (one file-system summary call per
    path; no file is opened)."""
    sc = spark.sparkContext
    hconf = sc._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = sc._jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(hconf).getContentSummary(path).getLength()
    return int(total)


def apply_scale(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Set the ``scale_conf`` settings that can change at runtime and that
    were not given at launch (a value from ``spark-submit --conf`` wins).
    Returns what was set."""
    launched = spark.sparkContext.getConf()
    applied = {}
    for key, value in scale_conf(input_bytes).items():
        if launched.contains(key) or not spark.conf.isModifiable(key):
            continue
        spark.conf.set(key, value)
        applied[key] = value
    return applied


def build_session(master: str | None = None, app: str = "portolan",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. The library's defaults fill in only what
    the launch (``spark-submit --conf``, defaults file) or a running context
    left unset; ``shuffle_partitions`` and ``extra`` are explicit and win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    running = SparkContext._active_spark_context
    # Without a running context this starts the gateway's JVM, whose
    # properties hold the launch settings.
    launched = running.getConf() if running is not None else SparkConf()
    conf = {k: v for k, v in DEFAULT_CONF.items() if not launched.contains(k)}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process on one machine."""
    return master == "local" or master.startswith("local[")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged and lineage-cutting writes.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint folder set
    on the context). When neither is set and the master is local, as in
    tests, a fresh local folder is created and registered as the checkpoint
    folder; on a cluster that is an error, since executors would not see it.
    """
    try:
        configured = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # noqa: BLE001 - key absent
        configured = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: no local context
        sc = None
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if sc is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for staged writes")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="portolan-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder by the file system that Spark reads it with."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared scratch folder."""
    return "/".join([scratch_dir(spark), *[p.strip("/") for p in parts]])


def run_concurrently(tasks: dict[str, Callable[[], object]]) -> dict[str, object]:
    """Run independent driver-side steps (each submits its own Spark jobs)
    in parallel threads and return their results by name.

    Threads inherit the caller's local properties (job group, scheduler
    pool), so cancelling the caller's group cancels them too. The first
    failure is raised after all threads have ended.
    """
    results: dict[str, object] = {}
    errors: list[BaseException] = []

    def run(name: str, fn: Callable[[], object]) -> None:
        try:
            results[name] = fn()
        except BaseException as ex:  # noqa: BLE001 - re-raised below
            errors.append(ex)

    threads = [InheritableThread(target=run, args=(n, f)) for n, f in tasks.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return results
