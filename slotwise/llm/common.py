"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import ensure_checkpoint_dir

#: Words are runs of anything but the six ASCII white-space characters (a fixed value).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; a cluster must name one."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step's rows to the shared folder and read them back.

    This cuts the lineage (a lost executor costs the running step, not the whole chain), gives the
    next join real sizes, and lets it split skewed keys, which it can't above an aggregate.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """All words of a text (null: none)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def let(value: Column, body) -> Column:
    """``body`` applied to ``value``, which is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bounded_broadcast(table: DataFrame, most: int) -> DataFrame:
    """Broadcast a stored table if it has at most ``most`` rows; else leave the join to shuffle."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers of this application the package (once), as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="slotwise-")) / "slotwise.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted((top / "slotwise").rglob("*.py")):
            out.write(source, source.relative_to(top))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def arrow_map(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)
