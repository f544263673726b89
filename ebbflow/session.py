"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC everywhere (epoch -> date is timezone
# dependent), AQE for runtime coalescing / skew splitting, no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Small files still split across cores (large files are bounded by
    # spark.sql.files.maxPartitionBytes, which is left at its default).
    "spark.sql.files.openCostInBytes": str(256 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ebbflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("EBBFLOW_DRIVER_MEMORY", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set and the
    master is local do we create one and register it with the context; on a
    cluster a machine-local folder would lose files, so that raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="ebbflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/ebbflow-{name}-{uuid.uuid4().hex[:12]}"


def apply_base_conf(spark: SparkSession) -> None:
    """Pin the runtime settings the engine depends on for an existing session."""
    for k in ("spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, BASE_CONF[k])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``ebbflow`` importable in executor Python workers (needed by the
    per-file probe) by zipping the package once per application and adding it
    with ``addPyFile``; Spark distributes it to every executor."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="ebbflow-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(path)
    _SHIPPED.add(app)


def ensure_shuffle_partitions(spark: SparkSession, input_bytes: int,
                              bytes_per_partition: int = 128 * 1024 * 1024) -> int:
    """Raise (never lower) ``spark.sql.shuffle.partitions`` so one shuffle
    partition covers about ``bytes_per_partition`` of input. AQE coalesces
    partitions that turn out small, so erring high is cheap while erring low
    makes tasks spill. Returns the setting in effect."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = -(-int(input_bytes) // bytes_per_partition)
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        return wanted
    return current
