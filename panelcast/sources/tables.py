"""Panel sources: scan a table and roll it up to ``(series_id, ds, y)`` (IO-3, IO-4, PF-1).

Scale notes
-----------
* Scans select only the columns they need, so Parquet reads a pruned
  ``ReadSchema`` and any filter the caller adds is pushed to the scan.
* The daily rollup is a ``groupBy(series_id, ds)`` with map-side partial
  aggregation: a hot series or a hot day (a third of all raw rows) is
  combined inside each scan task before the shuffle, so the shuffle carries
  at most one row per (task, series, day).  After the rollup a series holds
  at most one row per calendar day, which bounds every later per-series
  window by the series' span in days, not by the raw data volume.
* Values are summed as they are.  Money columns, which hold cents, are asked
  to be summed as decimals (``exact_scale=2``): exact and order independent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import nan_to_null
from ..functions.windows import DS, SERIES, Y


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def series_key(keys: str | Sequence[str]) -> Column:
    """One STRING series id from one or more key columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def to_panel(df: DataFrame, keys: str | Sequence[str] | None, time_col: str, value_col: str,
             extra: Sequence[str] = ()) -> DataFrame:
    """Project and rename to the panel contract (PF-1, IO-4); NaN -> NULL.

    ``keys=None`` makes a panel of one series named ``'all'`` (the
    reference's single series).
    """
    sid = F.lit("all") if keys is None else series_key(keys)
    return df.select(
        sid.alias(SERIES),
        F.to_date(F.col(time_col)).alias(DS),
        nan_to_null(F.col(value_col)).alias(Y),
        *extra,
    )


def daily_rollup(df: DataFrame, keys: str | Sequence[str] | None, time_col: str, value_col: str,
                 how: str = "sum", exact_scale: int | None = None) -> DataFrame:
    """Roll raw rows up to one row per (series, day).

    ``how``: ``sum`` | ``mean`` | ``count`` | ``max`` | ``min``.  A DECIMAL
    column is summed exactly, any other as double.  ``exact_scale`` is for
    doubles known to hold that many decimals, such as money: the sum then
    runs on DECIMAL(38, scale) and doesn't depend on the order.
    """
    exact_column = dict(df.dtypes)[value_col].startswith("decimal")
    p = to_panel(df, keys, time_col, value_col)
    if exact_column:
        p = df.select((F.lit("all") if keys is None else series_key(keys)).alias(SERIES),
                      F.to_date(F.col(time_col)).alias(DS), F.col(value_col).alias(Y))
    if how == "sum":
        v = F.col(Y).cast(f"decimal(38,{exact_scale})") if exact_scale is not None and not exact_column else F.col(Y)
        agg = F.sum(v).cast("double")
    elif how == "mean":
        agg = F.avg(Y)
    elif how == "count":
        agg = F.count(F.lit(1)).cast("double")
    elif how == "max":
        agg = F.max(Y)
    elif how == "min":
        agg = F.min(Y)
    else:
        raise ValueError(f"unknown rollup {how!r}")
    return p.groupBy(SERIES, DS).agg(agg.alias(Y))


def span_days(df: DataFrame, keys: str | Sequence[str], time_col: str) -> int:
    """Days from the first to the last row of each series, added up: the panel's rows once missing days are filled."""
    day = F.to_date(F.col(time_col))
    spans = df.groupBy(series_key(keys).alias(SERIES)).agg((F.datediff(F.max(day), F.min(day)) + 1).alias("days"))
    return spans.agg(F.sum("days")).first()[0] or 0


# --- the driver tables used as panels --------------------------------------

def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order rows as a panel by priority, keeping ``o_orderkey`` as tie-break."""
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice"])
    return to_panel(o, "o_orderpriority", "o_orderdate", "o_totalprice", extra=["o_orderkey"])


def orders_priority_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order value by ``o_orderpriority`` (5 series)."""
    o = table(spark, sf_dir, "orders", ["o_orderpriority", "o_orderdate", "o_totalprice"])
    return daily_rollup(o, "o_orderpriority", "o_orderdate", "o_totalprice", exact_scale=2)


def orders_segment_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order value by customer market segment (orders joined to customer).

    Orders are first summed per (customer, day): a customer holding a third
    of all orders reaches the join as at most one row per day, so the join
    sees no hot key.  Decimal sums are exact, so summing again per
    (segment, day) after the join gives the same result as joining raw
    rows.  The customer side grows with the data, so no broadcast is
    forced; AQE broadcasts it at run time when it is small.
    """
    o = table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    per_cust = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("ds")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    j = per_cust.join(c, per_cust.o_custkey == c.c_custkey, "inner")
    return j.groupBy(F.col("c_mktsegment").cast("string").alias(SERIES), DS).agg(
        F.sum("v").cast("double").alias(Y))


def lineitem_supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily shipped quantity by supplier (100 series at sf0.01, 1,000 at sf0.1)."""
    li = table(spark, sf_dir, "lineitem", ["l_suppkey", "l_shipdate", "l_quantity"])
    return daily_rollup(li, "l_suppkey", "l_shipdate", "l_quantity")


def lineitem_supplier_days(spark: SparkSession, sf_dir: str) -> int:
    """Rows of ``lineitem_supplier_panel`` with its missing days."""
    return span_days(table(spark, sf_dir, "lineitem", ["l_suppkey", "l_shipdate"]), "l_suppkey", "l_shipdate")


def events_type_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event value by ``event_type`` (30 days, 5 series)."""
    e = table(spark, sf_dir, "events", ["event_type", "ts", "value"])
    return daily_rollup(e, "event_type", "ts", "value")


def profile(panel: DataFrame) -> DataFrame:
    """Source profile per series (IO-3): rows, first and last date."""
    return panel.groupBy(SERIES).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(DS).alias("first_ds"),
        F.max(DS).alias("last_ds"),
    )


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Raise when a required column is missing (IO-2)."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {missing}; have {df.columns}")
    return df
