"""Writers.  Plain parquet has no UPDATE, so a refresh rewrites the table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> str:
    """Write ``df`` as parquet (overwrite is idempotent: re-running a refresh is safe)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def checkpoint_table(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` under the session's shared checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from the written files, not from the sources);
    the folder comes from ``spark.checkpoint.dir`` and is shared storage on a cluster.
    """
    from slotwise.session import ensure_checkpoint_dir

    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/tables/{name}"
    write_table(df, path)
    return spark.read.parquet(path)
