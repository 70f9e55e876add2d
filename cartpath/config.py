"""Session settings, fixed values and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed values that must equal the reference's for equal results:
#   inactivity gap between two events of one session: 30 minutes = 1800 seconds (a gap of
#   exactly 1800 s starts a new session); default split: 3 train weeks and 2 test weeks;
#   one week = 7 * 24 * 60 * 60 = 604800 seconds; cutoff k = 20 for Recall@k;
#   seed 42 for the test-session cut; event vocabulary: view, addtocart, transaction.
SESSION_GAP_SEC = 1800
TRAIN_WEEKS = 3
TEST_WEEKS = 2
WEEK_SEC = 7 * 24 * 60 * 60
TOP_K = 20
SEED = 42
VIEW = "view"
CART = "addtocart"
ORDER = "transaction"
LABEL_EVENTS = (CART, ORDER)

# Own default (not from the reference).
# Widest time bucket of sessionize; the session gap bounds it too.
BUCKET_SEC = 3600


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cartpath", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests, benchmarks and notebooks.

    On a cluster, build the session with the cluster's own settings; the library only
    reads ``spark.sql.shuffle.partitions`` and the checkpoint folder from it.
    """
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only local sessions (tests) without one get a fresh local folder; on a cluster its
    executors would each write to a disk of their own, so a missing setting raises.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="cartpath-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for written intermediate tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/cartpath/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cluster_settings(input_bytes: int, partition_bytes: int = 256 << 20,
                     shuffle_fraction: float = 0.3) -> dict[str, str]:
    """Session settings for a large run, derived from the size of the event input.

    * scan splits of ``partition_bytes`` (parquet row groups are read in parallel);
    * shuffle partitions so that one partition of the event shuffle holds about
      ``partition_bytes`` (the shuffled event rows carry a few narrow columns, roughly
      ``shuffle_fraction`` of the input); AQE coalesces small ones afterwards;
    * AQE skew-join splitting for the session-keyed joins, with the same target size;
    * a broadcast threshold for measured small sides (dimension tables); the library
      itself broadcasts only frames with a proven bound.
    """
    shuffle_parts = max(200, int(input_bytes * shuffle_fraction) // partition_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
