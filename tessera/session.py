"""Session helpers.

Library code never creates or stops a session: the caller owns it.  These
helpers are for tests, the bench and command-line use, plus the one place the
library needs a shared folder (``checkpoint_dir``).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run wants: AQE for runtime re-planning (partition coalescing,
# skew-join splitting, broadcast conversion), UTC so dates and timestamps agree
# with the SQL oracle, and no UI server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files once their DataFrame is garbage collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, as the cluster names it.

    Order: the folder already set on the context, then ``spark.checkpoint.dir``
    from the session conf.  Only a local-mode session (tests, bench) gets a
    private folder of our own; on a cluster a missing setting is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a folder every executor "
        "can reach (HDFS, S3A, ...) before building surrogate keys")


def cluster_conf(total_cores: int, checkpoint_dir: str, *, partition_mb: int = 256) -> dict[str, str]:
    """Settings for a large cluster, to pass to ``spark-submit --conf`` or the
    session builder (the library never sets them itself).

    Shuffles start with about three partitions per core and AQE merges them
    towards ``partition_mb`` each, or splits skewed ones; scans read
    ``partition_mb`` splits; the broadcast threshold stays modest, since the
    library broadcasts its dimensions itself after a size check; checkpoints
    go to the shared ``checkpoint_dir``."""
    mb = 1024 * 1024
    return {
        **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.showConsoleProgress"},
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.files.maxPartitionBytes": str(partition_mb * mb),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_mb * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_mb * mb),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * mb),
        "spark.checkpoint.dir": checkpoint_dir,
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
