"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every lapdeck job relies on (see README "Execution settings").
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "lapdeck",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with lapdeck's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle / scan sizing for a job reading ``input_bytes``.

    Initial shuffle partitions are sized so a partition holds about
    ``target_partition_bytes`` of the (pre-aggregation) input -- this keeps
    sort and window spills bounded per task -- and AQE coalesces partitions
    that turn out small.  Files are split at the same size.
    """
    n = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the platform and must be shared
    storage; it is only invented here when the session has none (local tests).
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared "
                "checkpoint folder")
        path = tempfile.mkdtemp(prefix="lapdeck-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new sub-folder of the shared checkpoint folder for a table that a job owns.

    The name is the application's and a random one: drivers that share the folder, and a driver that is started again, never meet.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
