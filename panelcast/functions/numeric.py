"""Null-safe numeric helpers (ANSI mode raises on ``x / 0``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN becomes NULL at the door: Spark treats NaN = NaN as true and sorts it last."""
    c = col_(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def signed_inf_div(num, den) -> Column:
    """Float division with IEEE results: x/0 = +-inf, 0/0 = NULL (NaN in numpy)."""
    num, den = col_(num), col_(den)
    return (
        F.when(num.isNull() | den.isNull(), F.lit(None).cast("double"))
        .when(den != 0, num / den)
        .when(num > 0, F.lit(INF))
        .when(num < 0, F.lit(-INF))
        .otherwise(F.lit(None).cast("double"))
    )
