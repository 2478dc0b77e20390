"""One place that builds window specs, so equal specs share one Window node.

Every spec is partitioned by the series keys: an unkeyed ``orderBy`` would
plan ``Exchange SinglePartition`` and pull the whole panel into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

SERIES = "series_id"
DS = "ds"
Y = "y"


def keys_of(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return [SERIES]
    if isinstance(keys, str):
        return [keys]
    return list(keys)


#: Rows of whole series that a task should get: a chain of sorts holds some 300 bytes of memory for each.
ROWS_PER_TASK = 1_000_000


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions to deal ``rows`` rows over by series: as many as there are cores, more for more rows."""
    cores = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(cores, -(-rows // ROWS_PER_TASK))


def by_series(keys=None, order: str | Sequence = DS) -> WindowSpec:
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    return Window.partitionBy(*keys_of(keys)).orderBy(*order)


def preceding(keys=None, order=DS) -> WindowSpec:
    """Rows from the series start to the current row."""
    return by_series(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def following(keys=None, order=DS) -> WindowSpec:
    """Rows from the current row to the series end, as a *growing* frame in reverse order.

    Use it with ``last(...)`` to get "the first value at or after this row".
    Spark evaluates a ``currentRow..unboundedFollowing`` frame by
    re-aggregating the rest of the partition for every row (quadratic in the
    series length); the reversed ``unboundedPreceding..currentRow`` frame is
    evaluated incrementally (linear).  ``order`` must be unique per series.
    """
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    desc = [F.col(o).desc() if isinstance(o, str) else o.desc() for o in order]
    return Window.partitionBy(*keys_of(keys)).orderBy(*desc).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)


def whole(keys=None) -> WindowSpec:
    """The whole series, unordered (for series-level statistics)."""
    return Window.partitionBy(*keys_of(keys))
