"""Holiday calendar dimension and the ``is_holiday`` flag (JN-1).

The calendar is generated by Spark from rules, for exactly the years the
panel spans (plus one, for a New Year's Day observed on 31 December), so it
is derived from the data and its size is bounded by the year span times
the number of rules.  The flag alone needs no calendar: see ``holiday_flag``.
Users with their own calendar pass a ``(country, ds, name)`` table instead.
A country without rules raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.windows import DS

# United States federal holidays as (name, rule, month, day or
# weekday 0=Monday, nth occurrence (-1 = last), first year in force).
# Rule 'date' is a fixed day of month, moved to Friday/Monday when it falls
# on Saturday/Sunday (an extra "(observed)" row); rule 'nth' is the n-th
# weekday of the month.
US_FEDERAL_RULES = [
    ("New Year's Day", "date", 1, 1, 0, 1871),
    ("Martin Luther King Jr. Day", "nth", 1, 0, 3, 1986),
    ("Washington's Birthday", "nth", 2, 0, 3, 1971),
    ("Memorial Day", "nth", 5, 0, -1, 1971),
    ("Juneteenth National Independence Day", "date", 6, 19, 0, 2021),
    ("Independence Day", "date", 7, 4, 0, 1871),
    ("Labor Day", "nth", 9, 0, 1, 1894),
    ("Columbus Day", "nth", 10, 0, 2, 1971),
    ("Veterans Day", "date", 11, 11, 0, 1938),
    ("Thanksgiving", "nth", 11, 3, 4, 1871),
    ("Christmas Day", "date", 12, 25, 0, 1871),
]

# National public holidays of three more countries.  Rule
# 'fixed' is a day of the month that never moves; 'easter' is so many days
# after Easter Sunday (third number); 'substitute' is a day of the month that,
# on a Saturday, has a substitute two days later, on a Sunday as many days
# later as the fourth number says.  Single years' changes are not in them.
DE_RULES = [
    ("New Year's Day", "fixed", 1, 1, 0, 1871),
    ("Good Friday", "easter", 0, -2, 0, 1871),
    ("Easter Monday", "easter", 0, 1, 0, 1871),
    ("Labour Day", "fixed", 5, 1, 0, 1933),
    ("Ascension Day", "easter", 0, 39, 0, 1871),
    ("Whit Monday", "easter", 0, 50, 0, 1871),
    ("German Unity Day", "fixed", 10, 3, 0, 1990),
    ("Christmas Day", "fixed", 12, 25, 0, 1871),
    ("Second Day of Christmas", "fixed", 12, 26, 0, 1871),
]
FR_RULES = [
    ("New Year's Day", "fixed", 1, 1, 0, 1811),
    ("Easter Monday", "easter", 0, 1, 0, 1886),
    ("Labour Day", "fixed", 5, 1, 0, 1919),
    ("Victory Day", "fixed", 5, 8, 0, 1982),
    ("Ascension Day", "easter", 0, 39, 0, 1802),
    ("Whit Monday", "easter", 0, 50, 0, 1886),
    ("Bastille Day", "fixed", 7, 14, 0, 1880),
    ("Assumption Day", "fixed", 8, 15, 0, 1802),
    ("All Saints' Day", "fixed", 11, 1, 0, 1802),
    ("Armistice Day", "fixed", 11, 11, 0, 1918),
    ("Christmas Day", "fixed", 12, 25, 0, 1802),
]
GB_RULES = [
    ("New Year's Day", "substitute", 1, 1, 1, 1974),
    ("Good Friday", "easter", 0, -2, 0, 1871),
    ("Easter Monday", "easter", 0, 1, 0, 1871),
    ("Early May Bank Holiday", "nth", 5, 0, 1, 1978),
    ("Spring Bank Holiday", "nth", 5, 0, -1, 1971),
    ("Summer Bank Holiday", "nth", 8, 0, -1, 1971),
    ("Christmas Day", "substitute", 12, 25, 2, 1871),
    ("Boxing Day", "substitute", 12, 26, 2, 1871),
]

RULES_BY_COUNTRY = {"US": US_FEDERAL_RULES, "DE": DE_RULES, "FR": FR_RULES, "GB": GB_RULES}


def rules_of(country: str) -> list[tuple]:
    if country not in RULES_BY_COUNTRY:
        raise ValueError(f"no holiday rules for {country!r}; pass a calendar, or one of {sorted(RULES_BY_COUNTRY)}")
    return RULES_BY_COUNTRY[country]


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar: the paschal full moon by epact and century corrections, then the next Sunday."""
    century = F.floor(year / 100)
    moon = F.pmod(19 * (year % 19) + century - F.floor(century / 4) - F.floor((century - F.floor((century + 8) / 25) + 1) / 3) + 15, F.lit(30))
    sunday = F.pmod(32 + 2 * (century % 4) + 2 * F.floor((year % 100) / 4) - moon - (year % 100) % 4, F.lit(7))
    late = F.floor((year % 19 + 11 * moon + 22 * sunday) / 451)  # two cases the epact puts too late
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), (moon + sunday - 7 * late).cast("int"))


def _nth_weekday(year: Column, month: int, weekday: int, nth: int) -> Column:
    if nth > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        offset = F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7))
        return F.date_add(first, offset + F.lit(7 * (nth - 1)))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.date_sub(last, F.pmod(F.weekday(last) - F.lit(weekday), F.lit(7)))


def _observed(d: Column) -> Column:
    wd = F.weekday(d)
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_add(d, 1))


def holiday_calendar(years: DataFrame, country: str = "US") -> DataFrame:
    """``(country, ds, name)`` for every year in the one-column ``years`` frame.

    Rows are produced by ``explode`` over the rule list: no join.
    """
    y = F.col("year")
    entries = []
    for name, kind, month, a, nth, since in rules_of(country):
        active = y >= F.lit(since)
        if kind == "date":
            d = F.make_date(y, F.lit(month), F.lit(a))
            entries.append(F.struct(F.when(active, d).alias("ds"), F.lit(name).alias("name")))
            entries.append(F.struct(F.when(active, _observed(d)).alias("ds"),
                                    F.lit(name + " (observed)").alias("name")))
        elif kind in ("fixed", "substitute"):
            d = F.make_date(y, F.lit(month), F.lit(a))
            entries.append(F.struct(F.when(active, d).alias("ds"), F.lit(name).alias("name")))
            if kind == "substitute":
                moved = F.when(F.weekday(d) == 5, F.date_add(d, 2)).when(F.weekday(d) == 6, F.date_add(d, nth))
                entries.append(F.struct(F.when(active, moved).alias("ds"), F.lit(name + " (substitute)").alias("name")))
        elif kind == "easter":
            entries.append(F.struct(F.when(active, F.date_add(easter(y), a)).alias("ds"), F.lit(name).alias("name")))
        else:
            d = _nth_weekday(y, month, a, nth)
            entries.append(F.struct(F.when(active, d).alias("ds"), F.lit(name).alias("name")))
    return (years.select(F.explode(F.array(*entries)).alias("h"))
            .select(F.lit(country).alias("country"), F.col("h.ds").alias("ds"), F.col("h.name").alias("name"))
            .where(F.col("ds").isNotNull()))


def calendar_for_panel(panel: DataFrame, country: str = "US", date_col: str = DS) -> DataFrame:
    """The calendar for the panel's year span (one global min/max aggregate)."""
    span = panel.agg(F.min(F.year(date_col)).alias("lo"), F.max(F.year(date_col)).alias("hi"))
    years = span.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.col("lo"), F.col("hi") + 1)).alias("year"))
    return holiday_calendar(years, country)


def holiday_flag(ds: Column, country: str = "US") -> Column:
    """``is_holiday`` as a scalar expression of the date, straight from the rules.

    Equivalent to membership in ``holiday_calendar`` (tested), but needs no
    calendar table, no join and no pass over the data to find its years.
    """
    wd, m, dom = F.weekday(ds), F.month(ds), F.dayofmonth(ds)
    hit, movable = F.lit(False), {}
    for _name, kind, month, a, nth, since in rules_of(country):
        if kind in ("fixed", "substitute"):
            on = dom == a
            if kind == "substitute":
                on = on | ((dom == a + 2) & (wd == 0)) | ((dom == a + nth) & (wd == (6 + nth) % 7))
            hit = hit | ((m == month) & on & (F.year(ds) >= since))
        elif kind == "easter":
            movable.setdefault(since, []).append(a)
        elif kind == "date":
            on = (m == month) & (dom == a) & (F.year(ds) >= since)
            nxt, prv = F.date_add(ds, 1), F.date_sub(ds, 1)
            fri = (wd == 4) & (F.month(nxt) == month) & (F.dayofmonth(nxt) == a) & (F.year(nxt) >= since)
            mon = (wd == 0) & (F.month(prv) == month) & (F.dayofmonth(prv) == a) & (F.year(prv) >= since)
            hit = hit | on | fri | mon
        elif nth > 0:
            hit = hit | ((m == month) & (wd == a) & (F.floor((dom - 1) / 7) == nth - 1) & (F.year(ds) >= since))
        else:
            hit = hit | ((m == month) & (wd == a) & (F.date_add(ds, 7) > F.last_day(ds)) & (F.year(ds) >= since))
    for since, days in movable.items():  # Easter is worked out once for all of them
        hit = hit | (F.datediff(ds, easter(F.year(ds))).isin(days) & (F.year(ds) >= since))
    return F.when(ds.isNull(), F.lit(None).cast("int")).otherwise(hit.cast("int"))


def add_holidays(panel: DataFrame, calendar: DataFrame | None = None, country: str = "US",
                 date_col: str = DS, name: str = "is_holiday") -> DataFrame:
    """``is_holiday`` in {0, 1}; 0 when the date is not in the calendar.

    Without a ``calendar`` the rules are evaluated on the date itself
    (``holiday_flag``): any year, no table and no join.  A user calendar has
    no proven bound and is joined without a forced broadcast.
    """
    if calendar is None:
        flag = F.coalesce(holiday_flag(F.col(date_col).cast("date"), country), F.lit(0))
        return panel.withColumn(name, flag)
    flags = calendar.select(F.col("ds").alias("_hd")).distinct().withColumn("_hf", F.lit(1))
    j = panel.join(flags, F.col(date_col) == F.col("_hd"), "left")
    return j.withColumn(name, F.coalesce(F.col("_hf"), F.lit(0))).drop("_hd", "_hf")


def add_holiday_windows(panel: DataFrame, country: str = "US", before: int = 1, after: int = 1, date_col: str = DS) -> DataFrame:
    """``holiday_before_k`` and ``holiday_after_k`` in {0, 1}: the date is k days before (after) a holiday."""
    d = F.col(date_col).cast("date")
    sides = {f"holiday_before_{k}": F.date_add(d, k) for k in range(1, before + 1)} \
        | {f"holiday_after_{k}": F.date_sub(d, k) for k in range(1, after + 1)}
    return panel.withColumns({n: F.coalesce(holiday_flag(x, country), F.lit(0)) for n, x in sides.items()})
