"""Session helpers: pinned time zone, shared scratch folders."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every strata job relies on. The time zone matters for
#: epoch -> timestamp -> date conversions (all producers write UTC).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "strata",
                  shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and local runs (the UI stays off)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SESSION_DEFAULTS, **extra}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a machine-local folder would not survive
    a lost executor). Only a local-mode session without the setting, as in
    tests, gets a private folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not root and jdir.isDefined():
        root = jdir.get()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not jdir.isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once for an application: only the driver's own
    path tells where it was loaded from."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        home = os.path.dirname(os.path.abspath(__file__))
        packed = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="strata-package-"), "strata"), "zip",
                                     os.path.dirname(home), os.path.basename(home))
        spark.sparkContext.addPyFile(packed)  # the driver serves it; nothing else reads this folder
        _SHIPPED.add(app)


def cluster_settings(input_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Starting settings for a cluster run over ``input_bytes`` of input.

    Initial shuffle parallelism is sized so each post-shuffle partition is
    about ``target_partition_bytes`` (AQE then coalesces small ones and splits
    skewed ones), and never below the number of cores.
    """
    partitions = max(executor_cores, -(-input_bytes // target_partition_bytes))
    return {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
