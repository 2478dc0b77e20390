"""Quantiles of large groups (AG-6, AG-12, DK-9).

Spark's ``percentile`` keeps all distinct values of a group in one task.
``exact_quantiles`` gives the same values by ranks: equal values are counted
first (combined map-side), the counts are range-partitioned by (group, value),
a scan over the ranges tells the ranks that each value covers, and only the
values at the wanted ranks are picked.  No task sees more than one range.

``approximate_quantiles`` is one pass with mergeable sketches, for a stated
rank error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranges import GROUP, in_ranges, running_sum


def _values(df: DataFrame, group: Sequence[str], value: Column) -> DataFrame:
    v = value.cast("double")
    return df.select(*group, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def exact_quantiles(df: DataFrame, group: Sequence[str], value: Column, probs: Sequence[float], name: str = "q") -> DataFrame:
    """(group, n, ``name``): an array with the linearly interpolated quantile for each of ``probs``.

    Missing values and NaN don't count; a group without any other value has no row.
    """
    g = list(group)
    counted = _values(df, g, value).groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_sum(in_ranges(counted, g, ["_v"]), ["_v"], F.col("_c"), "_upto", "_n")
    at = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    covers = lambda k: (F.col("_upto") - F.col("_c") <= k) & (k < F.col("_upto"))
    wanted = F.lit(False)
    picks = []
    for i, h in enumerate(at):
        low, high = F.floor(h), F.ceil(h)
        wanted = wanted | covers(low) | covers(high)
        picks += [F.max(F.when(covers(low), F.col("_v"))).alias(f"_l{i}"), F.max(F.when(covers(high), F.col("_v"))).alias(f"_h{i}")]
    found = ranked.where(wanted).groupBy(GROUP).agg(F.max("_n").alias("n"), *picks)
    n = F.col("n") - 1
    out = [F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * (n * F.lit(float(p)) - F.floor(n * F.lit(float(p)))) for i, p in enumerate(probs)]
    return found.select(*[F.col(GROUP)[c].alias(c) for c in g], F.col("n").cast("long").alias("n"), F.array(*out).alias(name))


def approximate_quantiles(df: DataFrame, group: Sequence[str], value: Column, probs: Sequence[float], error: float = 1e-3,
                          name: str = "q") -> DataFrame:
    """(group, n, ``name``): values whose rank is off by ``error`` times the group's rows at most."""
    return _values(df, group, value).groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("_v", [float(p) for p in probs], int(1 / error)).alias(name))


def with_groups(left: DataFrame, right: DataFrame, group: Sequence[str], how: str = "left") -> DataFrame:
    """``left`` with the columns of ``right`` (one row per group); missing keys are equal."""
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(right.withColumnsRenamed({c: f"_r_{c}" for c in group}), same, how).drop(*[f"_r_{c}" for c in group])
