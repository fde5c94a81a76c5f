"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  Timestamps are TIMESTAMP_NTZ and all
# date arithmetic is written time-zone independent, but UTC keeps `show()` honest.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # prunes event scans to the keys of a filtered join side before partial aggregation
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "slotwise",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is used as is, so what is written
    below it is found again by later sessions.  Only a local session (tests) may leave it unset;
    it gets a folder below its warehouse.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def recommended_conf(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 << 20,
                     shuffle_fraction: float = 0.1) -> dict[str, str]:
    """Shuffle sizing for a given input volume.

    The metrics shuffle pruned columns after partial aggregation, a small fraction of what they
    scan, so the initial shuffle partition count is sized to ``shuffle_fraction`` of the input
    at ``target_partition_bytes`` each (at least two per core); AQE then coalesces small partitions and splits skewed
    ones at run time.  Scan splits use the same target size.
    """
    parts = int(input_bytes * shuffle_fraction // target_partition_bytes) + 1
    parts = max(total_cores * 2, parts)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }
