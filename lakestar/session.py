"""Spark session helpers.

Library code never creates its own session: every function takes the
caller's ``SparkSession``. ``local_session`` exists for tests, the bench and
the CLI on one machine.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Settings the library relies on. ``apply_defaults`` only sets a key the
# caller left unset, so a cluster's own tuning always wins.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # The JVM interprets methods of more than 8,000 bytes for ever; beyond
    # that (bronze, the reasons) Spark shall generate smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Shuffle files go when their query ends, not when the driver collects
    # garbage: a run has many queries, and none reads another one's.
    SHUFFLE_CLEANUP: "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "lakestar") -> SparkSession:
    """A local session for tests / bench; the UI stays off (no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LAKESTAR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Fill in library-relevant SQL settings the caller did not choose."""
    # Dates and times are zone-free (timestamp_ntz / date), so the session
    # zone does not change results and the caller's choice stands.
    for key, value in SESSION_DEFAULTS.items():
        if key.startswith("spark.sql.") and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring it if needed.

    Order: a directory already set on the context, then the cluster's
    ``spark.checkpoint.dir`` setting. Only a *local* master may fall back to
    a fresh scratch directory; on a cluster a machine-local folder would lose
    checkpoints with the executor, so that is an error instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        scratch = tempfile.mkdtemp(prefix="lakestar-ckpt-")
        sc.setCheckpointDir(scratch)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at shared storage "
        "(HDFS/object store) so checkpoints survive executor loss"
    )
