"""Ranks, fills and neighbours inside groups of any size, without a window over a whole group.

A group's rows are cut into units that follow each other in the group's
order: range partitions with sampled bounds (``in_ranges``), or stretches of
so many rows (``with_halo``).  What a row needs from outside its unit comes
from a table with one row per (unit, group):

* pass 1: every unit is summarised on its own (its rows, its first and last
  values), combined map-side;
* a scan over the summaries of a group carries them from unit to unit.  It
  sees one row per unit, not the group's rows;
* pass 2: the carried values are joined back on (unit, group), the keys that
  the windows inside the units are partitioned by, so the rows move once.

A group is named by the struct of its key columns (``GROUP``), in which
missing keys are equal, so every join is a plain equality.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

GROUP, UNIT, TIE, BUCKET, HALO = "_group", "_unit", "_tie", "_bucket", "_halo"


def in_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` in range partitions by (group, order), written once, with the columns ``GROUP``, ``UNIT`` and ``TIE``.

    The last range column is random, so rows that agree in all others, were
    they a third of the table, are still cut into several ranges.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = df.withColumns({GROUP: F.struct(*group) if group else F.struct(F.lit(0).alias("all")), TIE: F.rand(17)})
    return cut_lineage(named.repartitionByRange(n, GROUP, *order, TIE).withColumn(UNIT, F.spark_partition_id()))


def _inside(unit: str, order: Sequence[str], descending: bool = False):
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    return Window.partitionBy(unit, GROUP).orderBy(*keys)


def _units(unit: str, descending: bool = False):
    """The summaries before (after) a unit's own, in its group."""
    at = F.col(unit).desc() if descending else F.col(unit).asc()
    return Window.partitionBy(GROUP).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)


def running_sum(rows: DataFrame, order: Sequence[str], amount: Column, name: str, total: str | None = None, unit: str = UNIT) -> DataFrame:
    """``name``: sum of ``amount`` over the group's rows up to the row itself; ``total``: over all of them."""
    rows_in = rows.withColumn("_amount", amount)
    sums = rows_in.groupBy(unit, GROUP).agg(F.sum("_amount").alias("_sum"))
    sums = sums.select(unit, GROUP, F.coalesce(F.sum("_sum").over(_units(unit)), F.lit(0)).alias("_before"),
                       F.sum("_sum").over(Window.partitionBy(GROUP)).alias("_total"))
    here = _inside(unit, order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows_in.withColumn("_local", F.sum("_amount").over(here)).join(sums, [unit, GROUP])
    out = out.withColumn(name, F.col("_before") + F.col("_local"))
    out = out.withColumn(total, F.col("_total")) if total else out
    return out.select(*[c for c in rows.columns if c not in (name, total)], name, *([total] if total else []))


def rank(rows: DataFrame, order: Sequence[str], name: str = "pos", total: str | None = None, unit: str = UNIT) -> DataFrame:
    """``name``: 0-based place of every row in its group; ``total``: the group's rows."""
    return running_sum(rows, order, F.lit(1).cast("long"), name, total, unit).withColumn(name, F.col(name) - 1)


def carry(rows: DataFrame, order: Sequence[str], forward: Mapping[str, Column] | None = None,
          backward: Mapping[str, Column] | None = None, following: Mapping[str, Column] | None = None, unit: str = UNIT) -> DataFrame:
    """Values from other rows of the group, as new columns.

    ``forward``: the last one that isn't missing, up to the row itself;
    ``backward``: the first one that isn't missing, from the row on;
    ``following``: that of the next row.
    """
    forward, backward, following = dict(forward or {}), dict(backward or {}), dict(following or {})
    made = {f"_f{i}": c for i, c in enumerate(forward.values())} | {f"_b{i}": c for i, c in enumerate(backward.values())} \
        | {f"_n{i}": c for i, c in enumerate(following.values())}
    rows_in = rows.withColumns(made)
    place = F.struct(*order)
    present = lambda c: F.when(F.col(c).isNotNull(), place)
    ends = [F.max_by(F.col(c), present(c)).alias(f"{c}e") if c.startswith("_f") else
            F.min_by(F.col(c), present(c) if c.startswith("_b") else place).alias(f"{c}e") for c in made]
    summary = rows_in.groupBy(unit, GROUP).agg(*ends)
    scanned = [(F.last(F.col(f"{c}e"), ignorenulls=True).over(_units(unit)) if c.startswith("_f") else
                F.last(F.col(f"{c}e"), ignorenulls=True).over(_units(unit, True)) if c.startswith("_b") else
                F.lead(f"{c}e").over(Window.partitionBy(GROUP).orderBy(unit))).alias(f"{c}c") for c in made]
    carried = summary.select(unit, GROUP, *scanned)
    up = _inside(unit, order).rowsBetween(Window.unboundedPreceding, 0)
    down = _inside(unit, order, True).rowsBetween(Window.unboundedPreceding, 0)
    local = [(F.last(F.col(c), ignorenulls=True).over(up) if c.startswith("_f") else
              F.last(F.col(c), ignorenulls=True).over(down) if c.startswith("_b") else
              F.lead(F.struct(F.col(c).alias("v"))).over(_inside(unit, order))).alias(f"{c}l") for c in made]
    joined = rows_in.select("*", *local).join(carried, [unit, GROUP])
    out = {}
    for prefix, names in (("_f", forward), ("_b", backward), ("_n", following)):
        for i, name in enumerate(names):
            c = f"{prefix}{i}"
            out[name] = (F.coalesce(f"{c}l", f"{c}c") if prefix != "_n" else
                         F.when(F.col(f"{c}l").isNotNull(), F.col(f"{c}l")["v"]).otherwise(F.col(f"{c}c")))
    return joined.select(*[F.col(c) for c in rows.columns if c not in out], *[c.alias(n) for n, c in out.items()])


def spread(rows: DataFrame, per_group: DataFrame, unit: str = UNIT) -> DataFrame:
    """Join a table with one row per ``GROUP``: first to the groups' units, then to the rows by (unit, group).

    A join on the group alone would bring all rows of a long group together.
    """
    units = rows.select(unit, GROUP).distinct().join(per_group, GROUP)
    return rows.join(units, [unit, GROUP])


def with_halo(ranked: DataFrame, back: int, ahead: int = 0, size: int = 100_000, pos: str = "pos") -> DataFrame:
    """Stretches of ``size`` rows (``BUCKET``), each with copies (``HALO``) of the ``back`` rows before and ``ahead`` rows after it.

    Counted in rows, not in time, so gaps and bursts change nothing.
    """
    size = max(size, back, ahead, 1)
    own, at = F.floor(F.col(pos) / size), F.col(pos) % size
    to = [F.struct(own.alias("b"), F.lit(False).alias("h"))]
    copies = F.array(*to)
    if back:
        copies = F.concat(copies, F.when(at >= size - back, F.array(F.struct((own + 1).alias("b"), F.lit(True).alias("h")))).otherwise(
            F.array().cast("array<struct<b:bigint,h:boolean>>")))
    if ahead:
        copies = F.concat(copies, F.when((at < ahead) & (own > 0), F.array(F.struct((own - 1).alias("b"), F.lit(True).alias("h")))).otherwise(
            F.array().cast("array<struct<b:bigint,h:boolean>>")))
    return (ranked.withColumn("_copy", F.explode(copies))
            .select("*", F.col("_copy")["b"].alias(BUCKET), F.col("_copy")["h"].alias(HALO)).drop("_copy"))


def plain(rows: DataFrame) -> DataFrame:
    """Without the helper columns."""
    return rows.drop(GROUP, UNIT, TIE, BUCKET, HALO)
