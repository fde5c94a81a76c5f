"""The six tables in the catalog: created if they aren't there, refused if they are different.

``ensure_tables`` may be run before every job: a table that is there with the declared columns and
partition columns stays as it is, rows included; one that differs is an error that names the
difference, and nothing is created or changed then.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from slotwise.functions.dates import BOOKING_MONTH, PARTITION_COLUMNS
from slotwise.sources import publish, schemas
from slotwise.sources.layout import TIME_COLUMNS


class SchemaDrift(ValueError):
    """A table is there with other columns or partition columns than declared."""


def partition_columns(name: str) -> list[str]:
    """The month columns a table is stored by: the booking's month for events, then the time's."""
    if name not in TIME_COLUMNS:
        return []
    return ([] if name == "appointments" else [BOOKING_MONTH]) + [PARTITION_COLUMNS[TIME_COLUMNS[name]]]


def declared(name: str) -> T.StructType:
    return T.StructType([*schemas.SCHEMAS[name].fields, *[T.StructField(c, T.StringType()) for c in partition_columns(name)]])


def drift(spark: SparkSession, database: str, name: str) -> list[str]:
    """How the catalog's table differs from the declared one; empty if it doesn't."""
    have = {f.name: f.dataType.simpleString() for f in spark.table(f"{database}.{name}").schema}
    want = {f.name: f.dataType.simpleString() for f in declared(name)}
    out = [f"{c} is missing" for c in want if c not in have] + [f"{c} isn't declared" for c in have if c not in want]
    out += [f"{c} is {have[c]}, not {want[c]}" for c in want if c in have and have[c] != want[c]]
    parts = [c.name for c in spark.catalog.listColumns(f"{database}.{name}") if c.isPartition]
    if parts != partition_columns(name):
        out.append(f"partitioned by {parts}, not {partition_columns(name)}")
    return out


def ensure_tables(spark: SparkSession, database: str, root: str, names=tuple(schemas.SCHEMAS)) -> list[str]:
    """Create the tables that aren't there yet, as external parquet tables below ``root``; return their names.

    All that are there are checked first, so a drift leaves the catalog as it was.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    there = [n for n in names if spark.catalog.tableExists(f"{database}.{n}")]
    wrong = {n: d for n in there if (d := drift(spark, database, n))}
    if wrong:
        raise SchemaDrift("; ".join(f"{database}.{n}: {', '.join(d)}" for n, d in wrong.items()))
    new = [n for n in names if n not in there]
    for name in new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in declared(name))
        by = f" PARTITIONED BY ({', '.join(partition_columns(name))})" if partition_columns(name) else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet{by} LOCATION '{root.rstrip('/')}/{name}'")
        fs, folder = publish._hadoop(spark, f"{root.rstrip('/')}/{name}")
        if by and fs.exists(folder):
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")           # folders that are there already
    return new
