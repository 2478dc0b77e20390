"""Calendar and Fourier column builders (SC-1..SC-9, DK-7).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_

TWO_PI = 2.0 * math.pi


def day_of_week(ds) -> Column:
    """Monday = 0 .. Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(col_(ds))


def cyclic(value, period: float, fn: str) -> Column:
    angle = F.lit(TWO_PI) * col_(value).cast("double") / F.lit(float(period))
    return F.sin(angle) if fn == "sin" else F.cos(angle)


def temporal_columns(ds: str = "ds") -> list[Column]:
    """The twelve calendar columns, in the reference's order (SC-8)."""
    d = F.col(ds)
    dow = day_of_week(d)
    month = F.month(d)
    doy = F.dayofyear(d)
    return [
        dow.alias("day_of_week"),
        cyclic(dow, 7, "sin").alias("day_of_week_sin"),
        cyclic(dow, 7, "cos").alias("day_of_week_cos"),
        month.alias("month"),
        cyclic(month, 12, "sin").alias("month_sin"),
        cyclic(month, 12, "cos").alias("month_cos"),
        F.quarter(d).alias("quarter"),
        doy.alias("day_of_year"),
        # the reference divides by 365 in leap years too
        cyclic(doy, 365, "sin").alias("day_of_year_sin"),
        cyclic(doy, 365, "cos").alias("day_of_year_cos"),
        F.weekofyear(d).alias("week_of_year"),  # ISO week
        (dow >= 5).cast("int").alias("is_weekend"),
    ]


# Names of the twelve calendar features, in output order.
TEMPORAL_FEATURE_NAMES = [
    "day_of_week", "day_of_week_sin", "day_of_week_cos",
    "month", "month_sin", "month_cos",
    "quarter",
    "day_of_year", "day_of_year_sin", "day_of_year_cos",
    "week_of_year", "is_weekend",
]


def day_number(ds) -> Column:
    """Days since 1970-01-01; a fold-independent time axis."""
    return F.unix_date(col_(ds).cast("date")).cast("double")


def fourier_columns(ds: str = "ds", period: float = 365.25, order: int = 6,
                    prefix: str | None = None) -> list[Column]:
    """``sin/cos(2*pi*k*t/period)`` for k = 1..order on the day axis (DK-7)."""
    prefix = prefix or f"fourier_{period:g}"
    t = day_number(ds)
    out = []
    for k in range(1, order + 1):
        angle = F.lit(TWO_PI * k / period) * t
        out.append(F.sin(angle).alias(f"{prefix}_sin{k}"))
        out.append(F.cos(angle).alias(f"{prefix}_cos{k}"))
    return out
