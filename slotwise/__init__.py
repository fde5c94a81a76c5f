"""slotwise — appointment / no-show analytics as Spark DataFrame jobs.

Every metric is a plain function ``(tables, as_of, ...) -> DataFrame`` built from
built-in Spark operators, so Catalyst sees the whole plan (pushdown, pruning,
partial aggregation, AQE) and the same code runs on ``local[*]`` or a cluster.
"""

from slotwise.sources.tables import Tables

__all__ = ["Tables"]
