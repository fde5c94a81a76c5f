"""Q1-Q5 data-quality jobs: the source schema's keys, enums, NOT NULLs, lengths and defaults
(which Spark does not enforce) re-expressed as checks over the data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.rates import count_when
from slotwise.sources import schemas
from slotwise.sources.tables import Tables

TABLES = ["salons", "customers", "appointments", "reminder_events", "delay_events"]


def _table(t: Tables, name: str) -> DataFrame:
    return getattr(t, name)


def duplicate_keys(t: Tables) -> DataFrame:
    """Q1: per table, rows, distinct keys, keys that occur more than once and excess rows.

    Counting per key is partially aggregated in every task, so a hot key costs one row per
    task before the shuffle.
    """
    parts = []
    for name in TABLES:
        pk = schemas.PRIMARY_KEYS[name]
        per_key = _table(t, name).groupBy(pk).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
            count_when(F.col("n") > 1).alias("duplicated_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"),
        ).select(F.lit(name).alias("table_name"), F.lit(pk).alias("key_column"), "*"))
    return reduce(DataFrame.unionByName, parts)


def orphans(t: Tables) -> DataFrame:
    """Q2: per foreign key, child rows whose non-NULL key has no parent row.

    Every table is read once and gives, for each key it holds, a row tagged with the parent table
    and with what the key is there: the parent's own key, or a child's reference.  One grouped
    pass per (parent, key), partially aggregated in every task, says whether the parent is there
    and how many rows of each child point to it; however skewed a key is, it costs one row per task.
    """
    keys = schemas.FOREIGN_KEYS
    parents = dict.fromkeys((parent, pcol) for _, _, parent, pcol in keys)
    tagged = []
    for name in TABLES:
        held = [F.struct(F.lit(parent).alias("parent"), F.col(pcol).alias("k"), F.lit(-1).alias("child")) for parent, pcol in parents if parent == name]
        held += [F.struct(F.lit(parent).alias("parent"), F.col(ccol).alias("k"), F.lit(i).alias("child"))
                 for i, (child, ccol, parent, _) in enumerate(keys) if child == name]
        if held:
            tagged.append(_table(t, name).select(F.inline(F.array(*held))))
    per_key = reduce(DataFrame.unionByName, tagged).where(F.col("k").isNotNull()).groupBy("parent", "k").agg(
        F.max(F.col("child") < 0).alias("there"), *[F.count(F.when(F.col("child") == i, 1)).alias(f"n{i}") for i in range(len(keys))])
    missing = per_key.where(~F.col("there")).agg(
        *[F.count(F.when(F.col(f"n{i}") > 0, 1)).alias(f"keys{i}") for i in range(len(keys))],
        *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).cast("bigint").alias(f"rows{i}") for i in range(len(keys))])
    cells = [c for i, (child, ccol, parent, _) in enumerate(keys) for c in (F.lit(child), F.lit(ccol), F.lit(parent), F.col(f"keys{i}"), F.col(f"rows{i}"))]
    return missing.select(F.stack(F.lit(len(keys)), *cells).alias("child_table", "child_column", "parent_table", "orphan_keys", "orphan_rows"))


def rules(name: str) -> list[tuple[str, str, str]]:
    """(column, rule, SQL predicate of a violating row) for one table, from the schema's
    NOT NULL flags, enum domains and declared lengths."""
    out = []
    for f in schemas.SCHEMAS[name].fields:
        if not f.nullable:
            out.append((f.name, "not_null", f"{f.name} IS NULL"))
    for (tbl, col), values in schemas.DOMAINS.items():
        if tbl == name:
            lst = ", ".join(f"'{v}'" for v in values)
            out.append((col, "domain", f"{col} IS NOT NULL AND {col} NOT IN ({lst})"))
    for (tbl, col), n in schemas.MAX_LENGTHS.items():
        if tbl == name:
            out.append((col, f"max_length_{n}", f"length({col}) > {n}"))
    return out


def domain_violations(t: Tables) -> DataFrame:
    """Q3: one row per (table, column, rule) with the number of violating rows (0 allowed).

    One pass and one global aggregate per table, every rule a conditional count.  The rules
    are data (generated from the schema), so they are handed to Spark as SQL predicates.
    """
    parts = []
    for name in TABLES:
        rs = rules(name)
        agg = _table(t, name).agg(*[F.expr(f"count(CASE WHEN {pred} THEN 1 END)").alias(f"r{i}")
                                    for i, (_, _, pred) in enumerate(rs)])
        cells = ", ".join(f"'{col}', '{rule}', r{i}" for i, (col, rule, _) in enumerate(rs))
        parts.append(agg.selectExpr(f"'{name}' AS table_name",
                                    f"stack({len(rs)}, {cells}) AS (column_name, rule, violations)"))
    return reduce(DataFrame.unionByName, parts)


def domain_violation_values(t: Tables) -> DataFrame:
    """Q3 detail: the offending enum values with their counts."""
    parts = []
    for (tbl, col), values in schemas.DOMAINS.items():
        df = _table(t, tbl)
        parts.append(df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))
                     .groupBy(F.col(col).alias("bad_value")).agg(F.count(F.lit(1)).alias("n_rows"))
                     .select(F.lit(tbl).alias("table_name"), F.lit(col).alias("column_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """Q4: fill NULLs of defaulted columns with the schema default, at load time."""
    defaults = schemas.DEFAULTS.get(table, {})
    schema = {f.name: f.dataType for f in schemas.SCHEMAS[table].fields}
    return df.select(*[F.coalesce(F.col(c), F.lit(defaults[c]).cast(schema[c])).alias(c)
                       if c in defaults else F.col(c) for c in df.columns])


def expected_band(minutes) -> F.Column:
    # --- fixed values: band ranges (minor 1-29, moderate 30-59, major 60+) ---
    return (F.when(minutes >= 60, "major").when(minutes >= 30, "moderate")
            .when(minutes >= 1, "minor").otherwise("on_schedule"))


def band_consistency(t: Tables) -> DataFrame:
    """Q5: stored delay band against the band implied by delay_minutes, with counts."""
    de = t.delay_events
    return (de.groupBy(F.col("delay_band").alias("stored_band"),
                       expected_band(F.col("delay_minutes")).alias("expected_band"))
            .agg(F.count(F.lit(1)).alias("n_events"))
            .withColumn("consistent", F.col("stored_band") == F.col("expected_band")))
