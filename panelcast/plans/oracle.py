"""Independent DuckDB SQL for the registered queries.

Written directly against the driver's parquet views (``orders``,
``lineitem``, ...), with a spine-and-join densification and plain window
SQL, so it shares no plan with the Spark side.  Double columns are rounded
to 6 places, as on the Spark side.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}


def rounded(inner: str, doubles: list[str], digits: int = 6) -> str:
    if not doubles:
        return inner
    repl = ", ".join(f"round({c}, {digits}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({repl}) FROM ({inner}) AS q"


# --- shared CTE fragments ----------------------------------------------------

ORDERS_PANEL = """
orders_panel AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders GROUP BY 1, 2
)"""


def densified(src: str, name: str) -> str:
    """Spine of every day per series joined to the panel ``src``."""
    return f"""
{name}_span AS (SELECT series_id, min(ds) AS lo, max(ds) AS hi FROM {src} GROUP BY 1),
{name}_spine AS (
  SELECT s.series_id, CAST(g.d AS DATE) AS ds
  FROM {name}_span s, LATERAL (SELECT unnest(generate_series(CAST(s.lo AS TIMESTAMP), CAST(s.hi AS TIMESTAMP),
                                                             INTERVAL 1 DAY)) AS d) g
),
{name} AS (
  SELECT sp.series_id, sp.ds, p.y,
         CAST(row_number() OVER (PARTITION BY sp.series_id ORDER BY sp.ds) - 1 AS BIGINT) AS pos
  FROM {name}_spine sp LEFT JOIN {src} p ON p.series_id = sp.series_id AND p.ds = sp.ds
)"""


def interpolated(src: str, name: str) -> str:
    w_prev = "PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    w_next = "PARTITION BY series_id ORDER BY ds ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
    return f"""
{name}_nb AS (
  SELECT *,
    last_value(y IGNORE NULLS) OVER ({w_prev}) AS pv,
    last_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER ({w_prev}) AS pi,
    first_value(y IGNORE NULLS) OVER ({w_next}) AS nv,
    first_value(CASE WHEN y IS NOT NULL THEN pos END IGNORE NULLS) OVER ({w_next}) AS ni
  FROM {src}
),
{name} AS (
  SELECT series_id, ds, pos,
    CASE WHEN y IS NOT NULL THEN y WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
         ELSE pv + (nv - pv) * ((pos - pi) / (ni - pi)) END AS y
  FROM {name}_nb
)"""


def preprocessed(src: str, name: str) -> str:
    """Outlier flag on the interpolated values, then per-series min-max scaling."""
    return f"""
{name}_st AS (
  SELECT *, avg(y) OVER (PARTITION BY series_id) AS m, stddev_samp(y) OVER (PARTITION BY series_id) AS s,
         min(y) OVER (PARTITION BY series_id) AS lo, max(y) OVER (PARTITION BY series_id) AS hi
  FROM {src}
),
{name} AS (
  SELECT series_id, ds, pos, y AS y_raw,
    CASE WHEN s IS NULL OR s = 0 OR y IS NULL THEN false ELSE abs((y - m) / s) > 3.0 END AS is_outlier,
    CASE WHEN y IS NULL THEN NULL WHEN hi = lo THEN 0.0 ELSE (y - lo) / (hi - lo) END AS y
  FROM {name}_st
)"""


CLEAN_ORDERS = ",".join([ORDERS_PANEL, densified("orders_panel", "orders_dense"),
                         interpolated("orders_dense", "orders_interp"),
                         preprocessed("orders_interp", "orders_clean")])

METRIC_COLS = ["mae", "rmse", "mape", "smape", "r2", "median_ae", "mre", "directional_accuracy", "forecast_bias"]


def metric_select(y: str = "y", yhat: str = "yhat", match: str = "dir_match") -> str:
    """The nine metrics as DuckDB aggregates (same conventions as the Spark builders)."""
    return f"""
    avg(abs({y} - {yhat})) AS mae,
    sqrt(avg(({y} - {yhat}) * ({y} - {yhat}))) AS rmse,
    CASE WHEN count(CASE WHEN {y} <> 0 THEN 1 END) = 0 THEN CAST('inf' AS DOUBLE)
         ELSE avg(CASE WHEN {y} <> 0 THEN abs(({y} - {yhat}) / {y}) END) * 100.0 END AS mape,
    avg(CASE WHEN abs({y}) + abs({yhat}) = 0 THEN 0.0
             ELSE abs({y} - {yhat}) / ((abs({y}) + abs({yhat})) / 2.0) END) * 100.0 AS smape,
    CASE WHEN count({y}) < 2 THEN NULL
         WHEN var_pop({y}) * count({y}) = 0 THEN CASE WHEN sum(({y} - {yhat}) * ({y} - {yhat})) = 0 THEN 1.0 ELSE 0.0 END
         ELSE 1.0 - sum(({y} - {yhat}) * ({y} - {yhat})) / (var_pop({y}) * count({y})) END AS r2,
    median(abs({y} - {yhat})) AS median_ae,
    CASE WHEN count(CASE WHEN {y} <> 0 THEN 1 END) = 0 THEN CAST('inf' AS DOUBLE)
         ELSE avg(CASE WHEN {y} <> 0 THEN abs(({y} - {yhat}) / {y}) END) END AS mre,
    avg({match}) * 100.0 AS directional_accuracy,
    avg({yhat} - {y}) AS forecast_bias"""


def direction_cte(src: str, name: str, group: str) -> str:
    return f"""
{name} AS (
  SELECT *, CASE WHEN yp IS NULL THEN NULL WHEN ((y - yp) > 0) = ((yhat - fp) > 0) THEN 1.0 ELSE 0.0 END AS dir_match
  FROM (SELECT *, lag(y) OVER (PARTITION BY {group} ORDER BY ds) AS yp,
                  lag(yhat) OVER (PARTITION BY {group} ORDER BY ds) AS fp FROM {src}) t
)"""


def yearly_test_rows(src: str, name: str) -> str:
    """Rows of ``src`` that are the test rows of a yearly fold, with ``fold_idx`` and the fold dimension."""
    return f"""
{name}_yr AS (
  SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY year(ds)) - 1 AS yrank FROM {src}
),
{name}_nf AS (
  SELECT series_id, count(DISTINCT year(ds)) - 1 AS n_folds FROM {src} GROUP BY 1
),
{name}_folds AS (
  SELECT y.series_id, CAST(y.yrank - 1 AS INTEGER) AS fold_idx, CAST(y.yr AS INTEGER) AS test_year
  FROM (SELECT DISTINCT series_id, year(ds) AS yr, yrank FROM {name}_yr) y JOIN {name}_nf f USING (series_id)
  WHERE y.yrank >= 1 AND y.yrank <= f.n_folds
),
{name} AS (
  SELECT t.*, CAST(t.yrank - 1 AS INTEGER) AS fold_idx
  FROM {name}_yr t JOIN {name}_nf f USING (series_id)
  WHERE t.yrank >= 1 AND t.yrank <= f.n_folds
)"""


def cv_naive_sql(clean_ctes: str, clean_name: str, season: int) -> str:
    inner = f"""
WITH {clean_ctes},
pred AS (
  SELECT series_id, ds, y, lag(y, {season}) OVER (PARTITION BY series_id ORDER BY ds) AS yhat FROM {clean_name}
),
{yearly_test_rows("pred", "test_rows")},
valid AS (SELECT series_id, fold_idx, ds, y, yhat FROM test_rows WHERE y IS NOT NULL AND yhat IS NOT NULL),
{direction_cte("valid", "dirs", "series_id, fold_idx")},
scored AS (
  SELECT series_id, fold_idx, count(*) AS n, {metric_select()}
  FROM dirs GROUP BY series_id, fold_idx
),
with_folds AS (
  SELECT f.series_id, f.fold_idx, f.test_year, CAST(coalesce(s.n, 0) AS BIGINT) AS n,
         CASE WHEN coalesce(s.n, 0) > 0 THEN 'success' ELSE 'failed' END AS status,
         CASE WHEN coalesce(s.n, 0) > 0 THEN NULL ELSE 'no row has both a value and a forecast' END AS error,
         {", ".join("s." + m for m in METRIC_COLS)}
  FROM test_rows_folds f LEFT JOIN scored s USING (series_id, fold_idx)
),
no_fold AS (
  SELECT DISTINCT series_id, CAST(NULL AS INTEGER) AS fold_idx, CAST(NULL AS INTEGER) AS test_year,
         CAST(0 AS BIGINT) AS n, 'failed' AS status, 'the series spans a single year, which makes no fold' AS error,
         {", ".join("CAST(NULL AS DOUBLE) AS " + m for m in METRIC_COLS)}
  FROM {clean_name} WHERE series_id NOT IN (SELECT series_id FROM test_rows_folds)
)
SELECT * FROM with_folds UNION ALL SELECT * FROM no_fold"""
    return rounded(inner, METRIC_COLS)


ORACLE["cv_seasonal_naive"] = cv_naive_sql(CLEAN_ORDERS, "orders_clean", 7)


# --- more shared fragments ---------------------------------------------------

INTERP_ORDERS = ",".join([ORDERS_PANEL, densified("orders_panel", "orders_dense"),
                          interpolated("orders_dense", "orders_interp")])
W_SER = "PARTITION BY series_id ORDER BY ds"
PREV = f"{W_SER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
NEXT = f"{W_SER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
FOLD_METRIC_COLS = ["n"] + METRIC_COLS


def cv_pred_ctes(season: int, name: str, context: str = "with_history") -> str:
    """CTEs ending in ``{name}(series_id, fold_idx, ds, y, yhat)``: test rows of the yearly folds."""
    if context == "with_history":
        return f"""
{name}_p AS (SELECT series_id, ds, y, lag(y, {season}) OVER ({W_SER}) AS yhat FROM orders_clean),
{yearly_test_rows(name + "_p", name + "_t")},
{name} AS (SELECT series_id, fold_idx, ds, y, yhat FROM {name}_t)"""
    return f"""
{yearly_test_rows("orders_clean", name + "_t")},
{name} AS (SELECT series_id, fold_idx, ds, y,
                  lag(y, {season}) OVER (PARTITION BY series_id, fold_idx ORDER BY ds) AS yhat FROM {name}_t)"""


def scored_cte(src: str, name: str, group: str = "series_id, fold_idx") -> str:
    return f"""
{name}_v AS (SELECT * FROM {src} WHERE y IS NOT NULL AND yhat IS NOT NULL),
{direction_cte(name + "_v", name + "_d", group)},
{name} AS (SELECT {group}, count(*) AS n, {metric_select()} FROM {name}_d GROUP BY {group})"""


def fold_metrics_ctes(season: int = 7, context: str = "with_history") -> str:
    """CTEs ending in ``fold_metrics``: the flagship output per (series, fold)."""
    return f"""{CLEAN_ORDERS},
{cv_pred_ctes(season, "cvp", context)},
{scored_cte("cvp", "cvs")},
fold_metrics AS (
  SELECT f.series_id, f.fold_idx, f.test_year, CAST(coalesce(s.n, 0) AS BIGINT) AS n,
         CASE WHEN coalesce(s.n, 0) > 0 THEN 'success' ELSE 'failed' END AS status,
         CASE WHEN coalesce(s.n, 0) > 0 THEN NULL ELSE 'no row has both a value and a forecast' END AS error,
         {", ".join("s." + m for m in METRIC_COLS)}
  FROM cvp_t_folds f LEFT JOIN cvs s USING (series_id, fold_idx)
)"""


def histogram_sql(src: str, value: str, group: str, bins: int = 30, name: str = "h") -> str:
    gcols = [g.strip() for g in group.split(",")]
    using = ", ".join(gcols)
    return f"""
{name}_vals AS (SELECT {group}, {value} AS v FROM {src} WHERE {value} IS NOT NULL AND NOT isnan({value})),
{name}_st AS (
  SELECT {group},
    CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
    CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
  FROM {name}_vals GROUP BY {group}
),
{name}_cnt AS (
  SELECT {", ".join("a." + g for g in gcols)},
         CAST(least(floor((a.v - b.lo) / ((b.hi - b.lo) / {float(bins)})), {bins - 1}) AS INTEGER) AS bin, count(*) AS c
  FROM {name}_vals a JOIN {name}_st b USING ({using}) GROUP BY ALL
),
{name} AS (
  SELECT {", ".join("s." + g for g in gcols)}, CAST(r.b AS INTEGER) AS bin,
         s.lo + CAST(r.b AS INTEGER) * ((s.hi - s.lo) / {float(bins)}) AS bin_lo,
         s.lo + (CAST(r.b AS INTEGER) + 1) * ((s.hi - s.lo) / {float(bins)}) AS bin_hi,
         CAST(coalesce(c.c, 0) AS BIGINT) AS count
  FROM {name}_st s CROSS JOIN range(0, {bins}) r(b)
  LEFT JOIN {name}_cnt c ON {" AND ".join(f"c.{g} = s.{g}" for g in gcols)} AND c.bin = r.b
)"""


def q(body: str, doubles: list[str]) -> str:
    return rounded(body, doubles)


# --- sources -----------------------------------------------------------------

ORACLE["source_profile"] = f"""WITH {ORDERS_PANEL}
SELECT series_id, count(*) AS n_rows, min(ds) AS first_ds, max(ds) AS last_ds FROM orders_panel GROUP BY 1"""

ORACLE["panel_rollup"] = q(f"WITH {ORDERS_PANEL} SELECT * FROM orders_panel", ["y"])

ORACLE["segment_panel"] = q("""
SELECT c.c_mktsegment AS series_id, CAST(o.o_orderdate AS DATE) AS ds,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""", ["y"])

ORACLE["supplier_panel"] = q("""
SELECT CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS ds,
       SUM(l_quantity) AS y
FROM lineitem GROUP BY 1, 2""", ["y"])

ORACLE["events_panel"] = q("""
SELECT event_type AS series_id, CAST(ts AS DATE) AS ds,
       SUM(value) AS y
FROM events GROUP BY 1, 2""", ["y"])

ORACLE["head_profile"] = q(f"""WITH {ORDERS_PANEL}
SELECT * FROM (SELECT *, CAST(row_number() OVER ({W_SER}) AS INTEGER) AS rn FROM orders_panel) t WHERE rn <= 5""",
                           ["y"])

# --- cleaning ----------------------------------------------------------------

RAW_ORDERS = """
raw AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y, o_orderkey
        FROM orders)"""

ORACLE["raw_positions"] = q(f"""WITH {RAW_ORDERS}
SELECT *, CAST(row_number() OVER (PARTITION BY series_id ORDER BY ds NULLS LAST, o_orderkey) - 1 AS BIGINT) AS pos
FROM raw""", ["y"])

ORACLE["duplicate_dates"] = f"""WITH {RAW_ORDERS}
SELECT series_id, CAST(count(*) - count(DISTINCT ds) - max(CASE WHEN ds IS NULL THEN 1 ELSE 0 END) AS BIGINT)
       AS n_duplicates FROM raw GROUP BY 1"""

ORACLE["dedup_first"] = q(f"""WITH {RAW_ORDERS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds NULLS LAST, o_orderkey) - 1 AS pos,
                  row_number() OVER (PARTITION BY series_id, ds ORDER BY o_orderkey) AS k FROM raw)
SELECT series_id, ds, y, CAST(pos AS BIGINT) AS pos FROM ranked WHERE k = 1""", ["y"])

ORACLE["missing_targets"] = f"""WITH {ORDERS_PANEL}, {densified("orders_panel", "orders_dense")}
SELECT series_id, CAST(count(*) - count(y) AS BIGINT) AS n_missing FROM orders_dense GROUP BY 1"""

ORACLE["interpolated"] = q(f"WITH {INTERP_ORDERS} SELECT * FROM orders_interp", ["y"])

ORACLE["forward_filled"] = q(f"""WITH {ORDERS_PANEL}, {densified("orders_panel", "orders_dense")}
SELECT series_id, ds, pos, last_value(y IGNORE NULLS) OVER ({PREV}) AS y FROM orders_dense""", ["y"])

ORACLE["dropped_missing"] = q(f"""WITH {ORDERS_PANEL}, {densified("orders_panel", "orders_dense")}
SELECT * FROM orders_dense WHERE y IS NOT NULL""", ["y"])


def outlier_sql(threshold: float) -> str:
    return f"""WITH {ORDERS_PANEL},
st AS (SELECT *, avg(y) OVER (PARTITION BY series_id) AS m, stddev_samp(y) OVER (PARTITION BY series_id) AS s
       FROM orders_panel),
flags AS (SELECT series_id, ds, y,
   CASE WHEN s IS NULL OR s = 0 OR y IS NULL THEN false ELSE abs((y - m) / s) > {threshold} END AS is_outlier FROM st)"""


ORACLE["outlier_flags"] = q(outlier_sql(3.0) + " SELECT * FROM flags", ["y"])
ORACLE["outlier_counts"] = outlier_sql(2.5) + """
SELECT series_id, CAST(count_if(is_outlier) AS BIGINT) AS n_outliers FROM flags GROUP BY 1"""

SCALER = """
scaler AS (SELECT series_id, min(y) AS y_min, max(y) AS y_max FROM orders_panel GROUP BY 1),
scaled AS (SELECT p.*, CASE WHEN s.y_max = s.y_min THEN 0.0 ELSE (p.y - s.y_min) / (s.y_max - s.y_min) END AS y_scaled
           FROM orders_panel p JOIN scaler s USING (series_id))"""

ORACLE["minmax_scaled"] = q(f"WITH {ORDERS_PANEL}, {SCALER} SELECT * FROM scaled", ["y", "y_scaled"])
ORACLE["scaler_table"] = q(f"WITH {ORDERS_PANEL}, {SCALER} SELECT * FROM scaler", ["y_min", "y_max"])
ORACLE["frozen_scaler"] = q(f"""WITH {ORDERS_PANEL},
scaler AS (SELECT series_id, min(y) AS y_min, max(y) AS y_max FROM orders_panel WHERE year(ds) < 1998 GROUP BY 1)
SELECT p.*, CASE WHEN s.y_max = s.y_min THEN 0.0 ELSE (p.y - s.y_min) / (s.y_max - s.y_min) END AS y_scaled
FROM orders_panel p LEFT JOIN scaler s USING (series_id)""", ["y", "y_scaled"])
ORACLE["inverse_scaled"] = q(f"""WITH {ORDERS_PANEL}, {SCALER}
SELECT c.series_id, c.ds, c.y, c.y_scaled, c.y_scaled * (s.y_max - s.y_min) + s.y_min AS y_restored
FROM scaled c JOIN scaler s USING (series_id)""", ["y", "y_scaled", "y_restored"])

ORACLE["preprocessed"] = q(f"WITH {CLEAN_ORDERS} SELECT * FROM orders_clean", ["y", "y_raw"])

RAW_DAYS = """
orders_panel AS (SELECT series_id, ds, y FROM (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS ds, o_totalprice AS y,
         row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE) ORDER BY o_orderkey) AS k FROM orders) t
  WHERE k = 1)"""
ORACLE["preprocessed_raw_rows"] = q(f"WITH {CLEAN_ORDERS} SELECT * EXCLUDE (y_raw) FROM orders_clean".replace(ORDERS_PANEL, RAW_DAYS),
                                    ["y"])

TRAIN_SCALE = CLEAN_ORDERS.replace("min(y) OVER (PARTITION BY series_id) AS lo", "min(CASE WHEN year(ds) < 1998 THEN y END) OVER (PARTITION BY series_id) AS lo") \
    .replace("max(y) OVER (PARTITION BY series_id) AS hi", "max(CASE WHEN year(ds) < 1998 THEN y END) OVER (PARTITION BY series_id) AS hi")
ORACLE["preprocessed_train_scale"] = q(f"WITH {TRAIN_SCALE} SELECT * EXCLUDE (y_raw) FROM orders_clean", ["y"])

ORACLE["missing_days"] = f"""WITH {ORDERS_PANEL}, {densified("orders_panel", "orders_dense")}
SELECT series_id, ds FROM orders_dense WHERE y IS NULL"""

ORACLE["log_transform"] = q(f"""WITH {ORDERS_PANEL}
SELECT *, ln(1 + y) AS y_log, exp(ln(1 + y)) - 1 AS y_back FROM orders_panel""", ["y", "y_log", "y_back"])

ORACLE["year_filter"] = q(f"WITH {ORDERS_PANEL} SELECT * FROM orders_panel WHERE year(ds) IN (1996, 1998)", ["y"])

# --- features ----------------------------------------------------------------

TP = "6.283185307179586"
CAL_COLS = f"""
  CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week,
  sin({TP} * (isodow(ds) - 1) / 7.0) AS day_of_week_sin,
  cos({TP} * (isodow(ds) - 1) / 7.0) AS day_of_week_cos,
  CAST(month(ds) AS INTEGER) AS month,
  sin({TP} * month(ds) / 12.0) AS month_sin,
  cos({TP} * month(ds) / 12.0) AS month_cos,
  CAST(quarter(ds) AS INTEGER) AS quarter,
  CAST(dayofyear(ds) AS INTEGER) AS day_of_year,
  sin({TP} * dayofyear(ds) / 365.0) AS day_of_year_sin,
  cos({TP} * dayofyear(ds) / 365.0) AS day_of_year_cos,
  CAST(week(ds) AS INTEGER) AS week_of_year,
  CAST(CASE WHEN isodow(ds) - 1 >= 5 THEN 1 ELSE 0 END AS INTEGER) AS is_weekend"""
CAL_DOUBLES = ["day_of_week_sin", "day_of_week_cos", "month_sin", "month_cos", "day_of_year_sin", "day_of_year_cos"]

ORACLE["calendar_features"] = q(f"WITH {ORDERS_PANEL} SELECT *, {CAL_COLS} FROM orders_panel", ["y"] + CAL_DOUBLES)

LAGS, WINS, SEAS, DIFFS, PCTS = [7, 14, 30, 90], [7, 14, 30], [7, 30, 365], [1, 7, 30], [1, 7, 30]
LAG_COLS = ",\n".join(f"lag(y, {k}) OVER ({W_SER}) AS lag_{k}" for k in LAGS)
ROLL_NAMES = [f"rolling_{s}_{w}" for w in WINS for s in ("mean", "std", "min", "max", "range")]


def _roll(w: int) -> str:
    fr = f"{W_SER} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW"
    full = f"count(y) OVER ({fr}) = {w}"
    return (f"CASE WHEN {full} THEN avg(y) OVER ({fr}) END AS rolling_mean_{w},\n"
            f"CASE WHEN {full} THEN stddev_samp(y) OVER ({fr}) END AS rolling_std_{w},\n"
            f"CASE WHEN {full} THEN min(y) OVER ({fr}) END AS rolling_min_{w},\n"
            f"CASE WHEN {full} THEN max(y) OVER ({fr}) END AS rolling_max_{w},\n"
            f"CASE WHEN {full} THEN max(y) OVER ({fr}) - min(y) OVER ({fr}) END AS rolling_range_{w}")


ROLL_COLS = ",\n".join(_roll(w) for w in WINS)
SEAS_NAMES = [c for p in SEAS for c in (f"seasonal_mean_{p}", f"deseasonalized_{p}")]
SEAS_COLS = ",\n".join(
    f"avg(y) OVER (PARTITION BY series_id, pos % {p}) AS seasonal_mean_{p},\n"
    f"y - avg(y) OVER (PARTITION BY series_id, pos % {p}) AS deseasonalized_{p}" for p in SEAS)
DIFF_COLS = ",\n".join(f"y - lag(y, {k}) OVER ({W_SER}) AS diff_{k}" for k in DIFFS)


def _pct(k: int) -> str:
    b = f"lag(yff, {k}) OVER ({W_SER})"
    return (f"CASE WHEN {b} IS NULL OR yff IS NULL THEN NULL WHEN {b} = 0 THEN "
            f"(CASE WHEN yff > 0 THEN CAST('inf' AS DOUBLE) WHEN yff < 0 THEN CAST('-inf' AS DOUBLE) END) "
            f"ELSE yff / {b} - 1.0 END AS pct_change_{k}")


PCT_COLS = ",\n".join(_pct(k) for k in PCTS)
LAG_NAMES = [f"lag_{k}" for k in LAGS]
DIFF_NAMES = [f"diff_{k}" for k in DIFFS]
PCT_NAMES = [f"pct_change_{k}" for k in PCTS]

FEAT_BASE = CLEAN_ORDERS + ",\nfeat_base AS (SELECT series_id, ds, y, pos FROM orders_clean)"
ORACLE["lag_features"] = q(f"WITH {FEAT_BASE} SELECT *, {LAG_COLS} FROM feat_base", ["y"] + LAG_NAMES)
ORACLE["rolling_features"] = q(f"WITH {FEAT_BASE} SELECT *, {ROLL_COLS} FROM feat_base", ["y"] + ROLL_NAMES)
ORACLE["seasonal_features"] = q(f"WITH {FEAT_BASE} SELECT *, {SEAS_COLS} FROM feat_base",
                                ["y"] + SEAS_NAMES)
ORACLE["diff_features"] = q(f"WITH {FEAT_BASE} SELECT *, {DIFF_COLS} FROM feat_base", ["y"] + DIFF_NAMES)
ORACLE["pct_change_features"] = q(f"""WITH {FEAT_BASE},
ff AS (SELECT *, last_value(y IGNORE NULLS) OVER ({PREV}) AS yff FROM feat_base)
SELECT series_id, ds, y, pos, {PCT_COLS} FROM ff""", ["y"] + PCT_NAMES)


def _holiday_rows(country: str = "US") -> str:
    from ..operators.holidays import RULES_BY_COUNTRY
    parts = []
    for name, kind, month, a, nth, since in RULES_BY_COUNTRY[country]:
        esc = name.replace("'", "''")
        if kind in ("fixed", "substitute"):
            d = f"make_date(year, {month}, {a})"
            parts.append(f"SELECT {d} AS ds, '{esc}' AS name FROM cal_years WHERE year >= {since}")
            if kind == "substitute":
                moved = f"(CASE isodow({d}) WHEN 6 THEN {d} + 2 WHEN 7 THEN {d} + {nth} END)"
                parts.append(f"SELECT {moved} AS ds, '{esc} (substitute)' AS name FROM cal_years WHERE year >= {since}")
        elif kind == "easter":
            parts.append(f"SELECT CAST(e + {a} AS DATE) AS ds, '{esc}' AS name FROM easters WHERE year >= {since}")
        elif kind == "date":
            d = f"make_date(year, {month}, {a})"
            parts.append(f"SELECT {d} AS ds, '{esc}' AS name FROM cal_years WHERE year >= {since}")
            obs = f"(CASE isodow({d}) WHEN 6 THEN {d} - 1 WHEN 7 THEN {d} + 1 END)"
            parts.append(f"SELECT {obs} AS ds, '{esc} (observed)' AS name FROM cal_years WHERE year >= {since}")
        elif nth > 0:
            first = f"make_date(year, {month}, 1)"
            d = f"{first} + CAST((({a} - (isodow({first}) - 1)) % 7 + 7) % 7 + {7 * (nth - 1)} AS INTEGER)"
            parts.append(f"SELECT {d} AS ds, '{esc}' AS name FROM cal_years WHERE year >= {since}")
        else:
            last = f"last_day(make_date(year, {month}, 1))"
            d = f"{last} - CAST((((isodow({last}) - 1) - {a}) % 7 + 7) % 7 AS INTEGER)"
            parts.append(f"SELECT {d} AS ds, '{esc}' AS name FROM cal_years WHERE year >= {since}")
    return "\nUNION ALL ".join(parts)


HOLIDAYS = f"""
cal_years AS (SELECT unnest(range(lo, hi + 2)) AS year
              FROM (SELECT min(year(ds)) AS lo, max(year(ds)) AS hi FROM orders_panel) WHERE lo IS NOT NULL),
cal AS (SELECT 'US' AS country, CAST(ds AS DATE) AS ds, name FROM ({_holiday_rows()}) h WHERE ds IS NOT NULL)"""

ORACLE["holiday_calendar"] = f"WITH {ORDERS_PANEL}, {HOLIDAYS} SELECT * FROM cal"
ORACLE["holiday_flags"] = q(f"""WITH {ORDERS_PANEL}, {HOLIDAYS}
SELECT p.*, CAST(CASE WHEN h.ds IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_holiday
FROM orders_panel p LEFT JOIN (SELECT DISTINCT ds FROM cal) h ON p.ds = h.ds""", ["y"])

FILLABLE = ["y"] + LAG_NAMES + ROLL_NAMES + SEAS_NAMES + DIFF_NAMES + PCT_NAMES
FILL_COLS = ",\n".join(
    f"coalesce(first_value({c} IGNORE NULLS) OVER ({NEXT}), last_value({c} IGNORE NULLS) OVER ({PREV})) AS {c}"
    for c in FILLABLE)
CAL_NAMES = ["day_of_week", "day_of_week_sin", "day_of_week_cos", "month", "month_sin", "month_cos", "quarter",
             "day_of_year", "day_of_year_sin", "day_of_year_cos", "week_of_year", "is_weekend"]

ORACLE["feature_table"] = q(f"""WITH {FEAT_BASE}, {HOLIDAYS.replace("FROM orders_panel", "FROM feat_base")},
ff AS (SELECT *, last_value(y IGNORE NULLS) OVER ({PREV}) AS yff FROM feat_base),
feats AS (
  SELECT f.series_id, f.ds, f.y, f.pos, {CAL_COLS.replace("(ds)", "(f.ds)")},
         {LAG_COLS.replace("ORDER BY ds", "ORDER BY f.ds")}, {ROLL_COLS.replace("ORDER BY ds", "ORDER BY f.ds")},
         {SEAS_COLS},
         CAST(CASE WHEN h.ds IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_holiday,
         {DIFF_COLS.replace("ORDER BY ds", "ORDER BY f.ds")}, {PCT_COLS.replace("ORDER BY ds", "ORDER BY f.ds")}
  FROM ff f LEFT JOIN (SELECT DISTINCT ds FROM cal) h ON f.ds = h.ds
)
SELECT series_id, ds, pos, {", ".join(CAL_NAMES)}, is_holiday, {FILL_COLS} FROM feats""",
                            FILLABLE + CAL_DOUBLES)


def _fourier(period: float, order: int, prefix: str) -> tuple[str, list[str]]:
    import math
    cols, names = [], []
    for k in range(1, order + 1):
        f = repr(2.0 * math.pi * k / period)
        t = "CAST(ds - DATE '1970-01-01' AS DOUBLE)"
        cols += [f"sin({f} * {t}) AS {prefix}_sin{k}", f"cos({f} * {t}) AS {prefix}_cos{k}"]
        names += [f"{prefix}_sin{k}", f"{prefix}_cos{k}"]
    return ",\n".join(cols), names


_FY, _FYN = _fourier(365.25, 10, "fourier_yearly")
_FW, _FWN = _fourier(7.0, 3, "fourier_weekly")
ORACLE["fourier_terms"] = q(f"WITH {ORDERS_PANEL} SELECT *, {_FY}, {_FW} FROM orders_panel", ["y"] + _FYN + _FWN)

# --- splits and folds ----------------------------------------------------------

SPLIT = f"""
split_rows AS (
  SELECT series_id, ds, y,
    CASE WHEN rn < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
         WHEN rn < floor(n * CAST(0.7 AS DOUBLE)) + floor(n * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER ({W_SER}) - 1 AS rn, count(*) OVER (PARTITION BY series_id) AS n
        FROM orders_clean) t
)"""
ORACLE["temporal_split"] = q(f"WITH {CLEAN_ORDERS}, {SPLIT} SELECT * FROM split_rows", ["y"])
ORACLE["split_sizes"] = f"""WITH {CLEAN_ORDERS}, {SPLIT}
SELECT series_id, split, count(*) AS n_rows FROM split_rows GROUP BY 1, 2"""

YEARS = """
yrs AS (SELECT series_id, CAST(yr AS INTEGER) AS year,
               CAST(row_number() OVER (PARTITION BY series_id ORDER BY yr) - 1 AS INTEGER) AS year_rank
        FROM (SELECT DISTINCT series_id, year(ds) AS yr FROM orders_panel) t)"""
ORACLE["distinct_years"] = f"WITH {ORDERS_PANEL}, {YEARS} SELECT * FROM yrs"
FOLDS = YEARS + """,
folds AS (
  SELECT y.series_id, y.year_rank - 1 AS fold_idx,
         (SELECT string_agg(CAST(y2.year AS VARCHAR), ',' ORDER BY y2.year) FROM yrs y2
          WHERE y2.series_id = y.series_id AND y2.year_rank < y.year_rank) AS train_years,
         y.year AS test_year
  FROM yrs y WHERE y.year_rank >= 1
)"""
ORACLE["yearly_folds"] = f"WITH {ORDERS_PANEL}, {FOLDS} SELECT * FROM folds"
FOLD_ROWS = f"""
fold_rows AS (
  SELECT p.series_id, p.ds, p.y, f.fold_idx,
         CASE WHEN y.year_rank = f.fold_idx + 1 THEN 'test' ELSE 'train' END AS role
  FROM orders_panel p JOIN yrs y ON p.series_id = y.series_id AND year(p.ds) = y.year
  JOIN folds f ON f.series_id = p.series_id AND y.year_rank <= f.fold_idx + 1
)"""
ORACLE["fold_rows"] = q(f"WITH {ORDERS_PANEL}, {FOLDS}, {FOLD_ROWS} SELECT * FROM fold_rows", ["y"])
ORACLE["fold_sizes"] = f"""WITH {ORDERS_PANEL}, {FOLDS}, {FOLD_ROWS}
SELECT series_id, fold_idx, role, count(*) AS n_rows FROM fold_rows GROUP BY 1, 2, 3"""


def origin_sql(initial: int, test: int, step: int, max_folds: int | None, gap: int, expanding: bool) -> str:
    cap = f"least({{}}, {max_folds})" if max_folds is not None else "{}"
    k = cap.format(f"CAST(floor((n - {initial + gap + test}) / {step}) + 1 AS BIGINT)")
    train_lo = "0" if expanding else f"f.k * {step}"
    return f"""WITH {CLEAN_ORDERS},
base AS (SELECT series_id, ds, CAST(row_number() OVER ({W_SER}) - 1 AS BIGINT) AS rn FROM orders_clean),
nk AS (SELECT series_id, CASE WHEN count(*) >= {initial + gap + test} THEN {k.replace("n -", "count(*) -")} ELSE 0 END AS kk
       FROM base GROUP BY 1),
f AS (SELECT series_id, unnest(range(0, kk)) AS k FROM nk WHERE kk > 0),
m AS (
  SELECT b.series_id, CAST(f.k AS INTEGER) AS fold_idx, 'test' AS role, b.rn, b.ds FROM base b JOIN f
    ON b.series_id = f.series_id AND b.rn >= {initial} + f.k * {step} + {gap}
       AND b.rn < {initial} + f.k * {step} + {gap} + {test}
  UNION ALL
  SELECT b.series_id, CAST(f.k AS INTEGER), 'train', b.rn, b.ds FROM base b JOIN f
    ON b.series_id = f.series_id AND b.rn >= {train_lo} AND b.rn < {initial} + f.k * {step}
)
SELECT series_id, fold_idx, role, count(*) AS n_rows, min(rn) AS first_rn, max(rn) AS last_rn,
       min(ds) AS first_ds, max(ds) AS last_ds FROM m GROUP BY 1, 2, 3"""


ORACLE["rolling_origin_sizes"] = origin_sql(365, 30, 30, None, 0, True)
ORACLE["sliding_origin_sizes"] = origin_sql(365, 30, 30, None, 7, False)

# --- metrics and CV -------------------------------------------------------------

def cv_sql(season: int, context: str) -> str:
    inner = f"""WITH {fold_metrics_ctes(season, context)},
no_fold AS (
  SELECT DISTINCT series_id, CAST(NULL AS INTEGER) AS fold_idx, CAST(NULL AS INTEGER) AS test_year,
         CAST(0 AS BIGINT) AS n, 'failed' AS status, 'the series spans a single year, which makes no fold' AS error,
         {", ".join("CAST(NULL AS DOUBLE) AS " + m for m in METRIC_COLS)}
  FROM orders_clean WHERE series_id NOT IN (SELECT series_id FROM cvp_t_folds)
)
SELECT * FROM fold_metrics UNION ALL SELECT * FROM no_fold"""
    return rounded(inner, METRIC_COLS)


ORACLE["cv_naive_test_only"] = cv_sql(1, "test_only")
CVP7 = f"{CLEAN_ORDERS}, {cv_pred_ctes(7, 'cvp')}"
CVP1 = cv_pred_ctes(1, "cvq")

ORACLE["error_analysis"] = q(f"""WITH {CVP7}
SELECT series_id, fold_idx, avg(y - yhat) AS mean_error, stddev_pop(y - yhat) AS std_error,
       min(y - yhat) AS min_error, max(y - yhat) AS max_error,
       CAST(count_if(y - yhat > 0) AS BIGINT) AS positive_errors, CAST(count_if(y - yhat < 0) AS BIGINT) AS negative_errors,
       quantile_cont(y - yhat, 0.25) AS q25, quantile_cont(y - yhat, 0.5) AS q50, quantile_cont(y - yhat, 0.75) AS q75
FROM cvp WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2""",
                             ["mean_error", "std_error", "min_error", "max_error", "q25", "q50", "q75"])

BASE = """
base_pred AS (
  SELECT * FROM (SELECT series_id, fold_idx, ds, y,
                        lag(y, 1) OVER (PARTITION BY series_id, fold_idx ORDER BY ds) AS yhat FROM cvp) t
  WHERE yhat IS NOT NULL
)"""
ORACLE["baseline_naive"] = q(f"""WITH {CVP7}, {BASE}, {scored_cte("base_pred", "bs")} SELECT * FROM bs""", METRIC_COLS)

IMP = ["mae", "rmse", "mape", "smape"]
ORACLE["improvement_over_naive"] = q(f"""WITH {CVP7}, {BASE}, {scored_cte("base_pred", "bs")},
{scored_cte("cvp", "ms")}
SELECT m.series_id, m.fold_idx, {", ".join(f"(b.{k} - m.{k}) / b.{k} * 100.0 AS {k}_improvement" for k in IMP)}
FROM ms m JOIN bs b USING (series_id, fold_idx)""", [f"{k}_improvement" for k in IMP])

ORACLE["compare_naive_models"] = q(f"""WITH {CVP7}, {CVP1}, {scored_cte("cvq", "sa")}, {scored_cte("cvp", "sb")}
SELECT coalesce(a.series_id, b.series_id) AS series_id, coalesce(a.fold_idx, b.fold_idx) AS fold_idx,
       {", ".join(f"a.{m} AS a_{m}" for m in METRIC_COLS)}, {", ".join(f"b.{m} AS b_{m}" for m in METRIC_COLS)},
       CASE WHEN a.mape < b.mape THEN 'naive' ELSE 'seasonal_naive' END AS winner,
       abs(a.mape - b.mape) AS improvement
FROM sa a FULL JOIN sb b ON a.series_id = b.series_id AND a.fold_idx = b.fold_idx""",
                                   [f"a_{m}" for m in METRIC_COLS] + [f"b_{m}" for m in METRIC_COLS] + ["improvement"])

LONG = "\nUNION ALL ".join(
    f"SELECT series_id, fold_idx, '{m}' AS metric, {m} AS value FROM fold_metrics WHERE status = 'success'"
    for m in METRIC_COLS)


def origin_cv_sql(gap: int) -> str:
    """Seasonal-naive forecasts from before each origin, scored per fold; the train window doesn't matter to them."""
    return q(f"""WITH {CLEAN_ORDERS},
base AS (SELECT series_id, ds, y, CAST(row_number() OVER ({W_SER}) - 1 AS BIGINT) AS rn FROM orders_clean),
nk AS (SELECT series_id, CASE WHEN count(*) >= {395 + gap} THEN CAST(floor((count(*) - {395 + gap}) / 30) + 1 AS BIGINT) ELSE 0 END AS kk
       FROM base GROUP BY 1),
f AS (SELECT series_id, unnest(range(0, kk)) AS k FROM nk WHERE kk > 0),
t AS (SELECT b.series_id, CAST(f.k AS INTEGER) AS fold_idx, b.ds, b.y,
             b.rn - 7 * CAST(floor((b.rn - 365 - f.k * 30) / 7) + 1 AS BIGINT) AS src
      FROM base b JOIN f ON b.series_id = f.series_id AND b.rn BETWEEN 365 + f.k * 30 + {gap} AND 365 + f.k * 30 + {gap} + 29),
op AS (SELECT t.series_id, t.fold_idx, t.ds, t.y, s.y AS yhat FROM t LEFT JOIN base s ON s.series_id = t.series_id AND s.rn = t.src),
{scored_cte("op", "os")} SELECT * FROM os""", METRIC_COLS)


ORACLE["rolling_origin_cv"] = origin_cv_sql(0)
ORACLE["gap_origin_cv"] = origin_cv_sql(7)

ORACLE["cv_summary"] = q(f"""WITH {fold_metrics_ctes()}, long AS ({LONG})
SELECT series_id, metric,
  CASE WHEN count(value) = count(*) THEN avg(value) END AS mean,
  CASE WHEN count(value) = count(*) THEN stddev_pop(value) END AS std,
  CASE WHEN count(value) = count(*) THEN min(value) END AS min,
  CASE WHEN count(value) = count(*) THEN max(value) END AS max,
  count(*) AS fold_count, 'success' AS status
FROM long GROUP BY 1, 2""", ["mean", "std", "min", "max"])
ORACLE["metrics_long"] = q(f"WITH {fold_metrics_ctes()} {LONG}", ["value"])
ORACLE["fold_counts"] = f"""WITH {fold_metrics_ctes()}
SELECT series_id, count(*) AS total_folds, CAST(count_if(status = 'success') AS BIGINT) AS successful_folds
FROM fold_metrics GROUP BY 1"""
EVENTS_PANEL = """
orders_panel AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS ds, SUM(value) AS y FROM events GROUP BY 1, 2)"""
ORACLE["events_cv"] = f"""SELECT * REPLACE (coalesce(fold_idx, -1) AS fold_idx, coalesce(test_year, -1) AS test_year)
FROM ({cv_sql(7, "with_history").replace(ORDERS_PANEL, EVENTS_PANEL)}) AS e"""
ORACLE["events_cv_summary"] = f"""WITH {EVENTS_PANEL}
SELECT DISTINCT series_id, m.metric, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min,
       CAST(NULL AS DOUBLE) AS max, CAST(0 AS BIGINT) AS fold_count, 'failed' AS status
FROM orders_panel JOIN (VALUES {", ".join(f"('{m}')" for m in METRIC_COLS)}) m(metric) ON true"""
ORACLE["events_fold_counts"] = f"""WITH {EVENTS_PANEL}
SELECT DISTINCT series_id, CAST(0 AS BIGINT) AS total_folds, CAST(0 AS BIGINT) AS successful_folds FROM orders_panel"""
ORACLE["best_fold"] = f"""WITH {fold_metrics_ctes()}
SELECT series_id, arg_min(fold_idx, (coalesce(mape, CAST('inf' AS DOUBLE)), fold_idx)) AS best_fold_idx
FROM fold_metrics WHERE status = 'success' GROUP BY 1"""
ORACLE["cv_report"] = q(f"""WITH {fold_metrics_ctes()}
SELECT series_id, fold_idx, mape, mae, rmse, r2 FROM fold_metrics WHERE status = 'success'""",
                        ["mape", "mae", "rmse", "r2"])
ORACLE["mase"] = q(f"""WITH {CVP7},
trall AS (
  SELECT c.series_id, f.fold_idx, c.ds, c.y
  FROM (SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY year(ds)) - 1 AS yrank FROM orders_clean) c
  JOIN cvp_t_folds f ON c.series_id = f.series_id AND c.yrank <= f.fold_idx
),
sc AS (SELECT series_id, fold_idx, avg(d) AS naive_mae FROM (
         SELECT *, abs(y - lag(y, 1) OVER (PARTITION BY series_id, fold_idx ORDER BY ds)) AS d FROM trall) t
       GROUP BY 1, 2),
mm AS (SELECT series_id, fold_idx, avg(abs(y - yhat)) AS mae FROM cvp WHERE y IS NOT NULL AND yhat IS NOT NULL
       GROUP BY 1, 2)
SELECT m.series_id, m.fold_idx, m.mae, s.naive_mae, CASE WHEN s.naive_mae = 0 THEN NULL ELSE m.mae / s.naive_mae END AS mase
FROM mm m LEFT JOIN sc s USING (series_id, fold_idx)""", ["mae", "naive_mae", "mase"])

# --- plot tables and diagnostics ------------------------------------------------

ORACLE["actual_vs_predicted"] = q(f"""WITH {CVP7}
SELECT series_id, fold_idx, CAST(row_number() OVER (PARTITION BY series_id, fold_idx ORDER BY ds) - 1 AS INTEGER) AS idx,
       ds, y AS actual, yhat AS predicted FROM cvp""", ["actual", "predicted"])
RESID = """
resid AS (
  SELECT series_id, fold_idx, CAST(row_number() OVER (PARTITION BY series_id, fold_idx ORDER BY ds) - 1 AS INTEGER) AS idx,
         ds, y - yhat AS residual FROM cvp WHERE y IS NOT NULL AND yhat IS NOT NULL
)"""
ORACLE["residuals"] = q(f"WITH {CVP7}, {RESID} SELECT * FROM resid", ["residual"])
ORACLE["residual_histogram"] = q(f"""WITH {CVP7}, {RESID}, {histogram_sql("resid", "residual", "series_id, fold_idx")}
SELECT * FROM h""", ["bin_lo", "bin_hi"])
ORACLE["scatter_table"] = q(f"""WITH {CVP7}
SELECT series_id, fold_idx, ds, y AS actual, yhat AS predicted,
       min(y) OVER (PARTITION BY series_id, fold_idx) AS line_min, max(y) OVER (PARTITION BY series_id, fold_idx) AS line_max
FROM cvp WHERE y IS NOT NULL AND yhat IS NOT NULL""", ["actual", "predicted", "line_min", "line_max"])
ORACLE["cv_scores"] = q(f"""WITH {fold_metrics_ctes()}
SELECT series_id, fold_idx, 'Fold ' || CAST(fold_idx + 1 AS VARCHAR) AS label, mape AS score,
       avg(mape) OVER (PARTITION BY series_id) AS mean,
       avg(mape) OVER (PARTITION BY series_id) + stddev_pop(mape) OVER (PARTITION BY series_id) AS upper,
       avg(mape) OVER (PARTITION BY series_id) - stddev_pop(mape) OVER (PARTITION BY series_id) AS lower,
       mape > avg(mape) OVER (PARTITION BY series_id) AS above_mean
FROM fold_metrics WHERE status = 'success'""", ["score", "mean", "upper", "lower"])
ORACLE["error_distribution"] = q(f"""WITH {CVP7},
ev AS (SELECT series_id, fold_idx, abs(y - yhat) AS abs_error,
              CASE WHEN y = 0 THEN NULL ELSE (y - yhat) / y * 100.0 END AS pct_error
       FROM cvp WHERE y IS NOT NULL AND yhat IS NOT NULL),
means AS (SELECT series_id, fold_idx, avg(abs_error) AS mean_abs_error, avg(pct_error) AS mean_pct_error,
                 CAST(count_if(pct_error IS NULL) AS BIGINT) AS n_zero_actual FROM ev GROUP BY 1, 2),
{histogram_sql("ev", "abs_error", "series_id, fold_idx", name="ha")},
{histogram_sql("ev", "pct_error", "series_id, fold_idx", name="hp")},
hh AS (SELECT *, 'abs_error' AS kind FROM ha UNION ALL SELECT *, 'pct_error' AS kind FROM hp)
SELECT hh.*, m.mean_abs_error, m.mean_pct_error, m.n_zero_actual FROM hh LEFT JOIN means m USING (series_id, fold_idx)""",
                                 ["bin_lo", "bin_hi", "mean_abs_error", "mean_pct_error"])
ORACLE["forecast_overlay"] = q(f"""WITH {CVP7}
SELECT series_id, ds, 'history' AS kind, y AS value, CAST(NULL AS DOUBLE) AS lower, CAST(NULL AS DOUBLE) AS upper
FROM orders_clean
UNION ALL
SELECT series_id, ds, 'forecast', yhat, NULL, NULL FROM cvp""", ["value", "lower", "upper"])
ORACLE["forecast_tails"] = q(f"""WITH {CLEAN_ORDERS},
fc AS (SELECT series_id, ds, lag(y, 7) OVER ({W_SER}) AS yhat,
              row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rd FROM orders_clean),
periods AS (SELECT * FROM (VALUES (30), (180), (365)) v(period))
SELECT fc.series_id, fc.ds, fc.yhat, CAST(p.period AS INTEGER) AS period FROM fc JOIN periods p ON fc.rd <= p.period""",
                               ["yhat"])
STACK = f"""{CVP7}, {CVP1},
stack AS (SELECT 'naive' AS model, series_id, fold_idx, ds, y, yhat FROM cvq
          UNION ALL SELECT 'seasonal_naive', series_id, fold_idx, ds, y, yhat FROM cvp)"""
ORACLE["model_stack"] = q(f"WITH {STACK} SELECT * FROM stack", ["y", "yhat"])
ORACLE["ensemble_mean"] = q(f"""WITH {STACK}
SELECT series_id, fold_idx, ds,
       CASE WHEN count(yhat) = count(*) AND count(yhat) = 2 THEN avg(yhat) END AS yhat, count(yhat) AS n_members
FROM stack GROUP BY 1, 2, 3""", ["yhat"])
ORACLE["ensemble_median"] = q(f"""WITH {STACK}
SELECT series_id, fold_idx, ds,
       CASE WHEN count(yhat) = count(*) AND count(yhat) = 2 THEN median(yhat) END AS yhat, count(yhat) AS n_members
FROM stack GROUP BY 1, 2, 3""", ["yhat"])
ORACLE["ensemble_weighted"] = q(f"""WITH {STACK},
err AS (SELECT model, series_id, fold_idx, avg(abs(y - yhat)) AS mae FROM stack WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2, 3),
wt AS (SELECT model, series_id, 1.0 / avg(mae) AS weight FROM err GROUP BY 1, 2)
SELECT s.series_id, s.fold_idx, s.ds, sum(w.weight * s.yhat) / sum(CASE WHEN s.yhat IS NOT NULL THEN w.weight END) AS yhat,
       count(s.yhat) AS n_members
FROM stack s LEFT JOIN wt w USING (model, series_id) GROUP BY 1, 2, 3""", ["yhat"])
ORACLE["prediction_intervals"] = q(f"""WITH {CVP7},
qs AS (SELECT series_id, quantile_cont(y - yhat, 0.025) AS qlo, quantile_cont(y - yhat, 0.975) AS qhi
       FROM cvp WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1)
SELECT c.series_id, c.fold_idx, c.ds, c.yhat, c.yhat + q.qlo AS lower, c.yhat + q.qhi AS upper
FROM cvp c LEFT JOIN qs q USING (series_id)""", ["yhat", "lower", "upper"])
_ACF_LAGS = range(1, 11)
ORACLE["residual_acf"] = q(f"""WITH {CVP7}, {RESID},
cen AS (SELECT *, residual - avg(residual) OVER (PARTITION BY series_id, fold_idx) AS c FROM resid),
lg AS (SELECT series_id, fold_idx, c,
         {", ".join(f"lag(c, {k}) OVER (PARTITION BY series_id, fold_idx ORDER BY ds) AS l{k}" for k in _ACF_LAGS)}
       FROM cen),
sums AS (SELECT series_id, fold_idx, count(*) AS n, sum(c * c) AS den,
           {", ".join(f"sum(c * l{k}) AS num{k}" for k in _ACF_LAGS)} FROM lg GROUP BY 1, 2),
acf AS ({" UNION ALL ".join(
    f"SELECT series_id, fold_idx, n, {k} AS lag, CASE WHEN den = 0 THEN NULL ELSE num{k} / den END AS acf FROM sums"
    for k in _ACF_LAGS)})
SELECT series_id, fold_idx, CAST(lag AS INTEGER) AS lag, n, acf,
       n * (n + 2) * sum(acf * acf / (n - lag)) OVER (PARTITION BY series_id, fold_idx ORDER BY lag
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ljung_box
FROM acf""", ["acf", "ljung_box"])
ORACLE["dickey_fuller"] = q(f"""WITH {CLEAN_ORDERS},
l AS (SELECT series_id, lag(y) OVER ({W_SER}) AS yl, y - lag(y) OVER ({W_SER}) AS dy FROM orders_clean),
a AS (SELECT series_id, regr_count(dy, yl) AS n, regr_slope(dy, yl) AS rho, regr_intercept(dy, yl) AS intercept,
             regr_sxx(dy, yl) AS sxx, regr_syy(dy, yl) AS syy, regr_sxy(dy, yl) AS sxy FROM l GROUP BY 1)
SELECT series_id, CAST(n AS BIGINT) AS n, rho, intercept,
       rho / sqrt(((syy - sxy * sxy / sxx) / (n - 2)) / sxx) AS t_stat FROM a""", ["rho", "intercept", "t_stat"])

SEAS_PAST_COLS = ",\n".join(
    f"avg(y) OVER (PARTITION BY series_id, pos % {p} ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    f" AS seasonal_mean_{p},\n"
    f"y - avg(y) OVER (PARTITION BY series_id, pos % {p} ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    f" AS deseasonalized_{p}" for p in SEAS)
FFILL_COLS = ",\n".join(f"last_value({c} IGNORE NULLS) OVER ({PREV}) AS {c}" for c in FILLABLE)
ORACLE["feature_table_leak_safe"] = q(f"""WITH {FEAT_BASE}, {HOLIDAYS.replace("FROM orders_panel", "FROM feat_base")},
ff AS (SELECT *, last_value(y IGNORE NULLS) OVER ({PREV}) AS yff FROM feat_base),
feats AS (
  SELECT f.series_id, f.ds, f.y, f.pos, {CAL_COLS.replace("(ds)", "(f.ds)")},
         {LAG_COLS.replace("ORDER BY ds", "ORDER BY f.ds")}, {ROLL_COLS.replace("ORDER BY ds", "ORDER BY f.ds")},
         {SEAS_PAST_COLS.replace("ORDER BY ds", "ORDER BY f.ds")},
         CAST(CASE WHEN h.ds IS NULL THEN 0 ELSE 1 END AS INTEGER) AS is_holiday,
         {DIFF_COLS.replace("ORDER BY ds", "ORDER BY f.ds")}, {PCT_COLS.replace("ORDER BY ds", "ORDER BY f.ds")}
  FROM ff f LEFT JOIN (SELECT DISTINCT ds FROM cal) h ON f.ds = h.ds
)
SELECT series_id, ds, pos, {", ".join(CAL_NAMES)}, is_holiday, {FFILL_COLS} FROM feats""",
                                      FILLABLE + CAL_DOUBLES)

SUPPLIER_PANEL = """
orders_panel AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS ds,
         SUM(l_quantity) AS y
  FROM lineitem GROUP BY 1, 2
)"""
# the same cleaning and CV chain, with the supplier rollup as its source panel
ORACLE["cv_supplier_seasonal_naive"] = cv_sql(7, "with_history").replace(ORDERS_PANEL, SUPPLIER_PANEL)

# --- quantiles and the fitted forecaster -----------------------------------------


def _poly(x: str, c: list[float]) -> str:
    out = repr(c[0])
    for v in c[1:]:
        out = f"({out} * {x} + {v!r})"
    return out


def _quantile(p: str) -> str:
    from ..operators.diagnostics import QUANTILE_CENTRE, QUANTILE_SPLIT, QUANTILE_TAIL

    def tail(v: str) -> str:
        r = f"sqrt(CAST(-2.0 AS DOUBLE) * ln({v}))"
        return f"{_poly(r, QUANTILE_TAIL[0])} / {_poly(r, QUANTILE_TAIL[1])}"
    x = f"({p} - 0.5)"
    centre = f"{x} * {_poly(f'({x} * {x})', QUANTILE_CENTRE[0])} / {_poly(f'({x} * {x})', QUANTILE_CENTRE[1])}"
    return (f"CASE WHEN {p} < {QUANTILE_SPLIT} THEN {tail(p)} WHEN {p} > 1 - {QUANTILE_SPLIT} THEN -({tail(f'(1.0 - {p})')}) ELSE {centre} END")


ORACLE["qq_table"] = q(f"""WITH {CVP7}, {RESID},
rk AS (SELECT series_id, fold_idx, residual, CAST(row_number() OVER (PARTITION BY series_id, fold_idx ORDER BY residual) AS INTEGER) AS i,
              count(*) OVER (PARTITION BY series_id, fold_idx) AS n FROM resid),
pp AS (SELECT series_id, fold_idx, i, residual, CASE WHEN i = n THEN pow(CAST(0.5 AS DOUBLE), 1.0 / n) WHEN i = 1 THEN 1.0 - pow(CAST(0.5 AS DOUBLE), 1.0 / n)
              ELSE (i - CAST(0.3175 AS DOUBLE)) / (n + CAST(0.365 AS DOUBLE)) END AS plotting_position FROM rk)
SELECT *, {_quantile("plotting_position")} AS theoretical FROM pp""", ["residual", "plotting_position", "theoretical"])

# rows of the one-lag model: for each horizon the lag it may use, and the trend
AR1_ROWS = f"""{CLEAN_ORDERS},
ar_base AS (SELECT *, dense_rank() OVER (PARTITION BY series_id ORDER BY year(ds)) - 1 AS yrank,
                   CAST(ds - min(ds) OVER (PARTITION BY series_id) AS DOUBLE) / 365.25 AS t,
                   row_number() OVER ({W_SER}) - 1 AS rn, count(*) OVER (PARTITION BY series_id) AS cnt FROM orders_clean),
ar_split AS (SELECT *, CASE WHEN rn < floor(cnt * CAST(0.7 AS DOUBLE)) THEN 'train'
                  WHEN rn < floor(cnt * CAST(0.7 AS DOUBLE)) + floor(cnt * CAST(0.15 AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM ar_base),
ar_rows AS ({" UNION ALL ".join(f"SELECT *, {h} AS horizon, lag(y, {h}) OVER ({W_SER}) AS x FROM ar_split" for h in (1, 2, 3))}),
ar_folds AS (SELECT DISTINCT series_id, CAST(yrank - 1 AS INTEGER) AS fold_idx, CAST(year(ds) AS INTEGER) AS test_year FROM ar_base WHERE yrank >= 1)"""


def _fit(name: str, rows: str, group: str, w: str = "1.0") -> str:
    """Weighted least squares of y on (1, x, t), in closed form."""
    return f"""
{name}_m AS (SELECT {group}, sum({w}) AS sw, sum({w} * x) / sum({w}) AS mx, sum({w} * t) / sum({w}) AS mt, sum({w} * y) / sum({w}) AS my
             FROM {rows} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY {group}),
{name}_s AS (SELECT {group}, any_value(m.mx) AS mx, any_value(m.mt) AS mt, any_value(m.my) AS my,
               sum({w} * (x - m.mx) * (x - m.mx)) AS sxx, sum({w} * (t - m.mt) * (t - m.mt)) AS stt, sum({w} * (x - m.mx) * (t - m.mt)) AS sxt,
               sum({w} * (x - m.mx) * (y - m.my)) AS sxy, sum({w} * (t - m.mt) * (y - m.my)) AS sty
             FROM {rows} JOIN {name}_m m USING ({group}) WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY {group}),
{name} AS (SELECT {group}, (sxy * stt - sty * sxt) / (sxx * stt - sxt * sxt) AS bx, (sty * sxx - sxy * sxt) / (sxx * stt - sxt * sxt) AS bt,
             my - (sxy * stt - sty * sxt) / (sxx * stt - sxt * sxt) * mx - (sty * sxx - sxy * sxt) / (sxx * stt - sxt * sxt) * mt AS b0
           FROM {name}_s)"""


AR1_CV = f"""{AR1_ROWS},
ar_train AS (SELECT f.fold_idx, r.* FROM ar_rows r JOIN ar_folds f ON f.series_id = r.series_id AND r.yrank <= f.fold_idx),
{_fit("ar_fit", "ar_train", "series_id, fold_idx, horizon")},
ar_pred AS (SELECT r.series_id, c.fold_idx, r.ds, r.horizon, r.y, c.b0 + c.bx * r.x + c.bt * r.t AS yhat
            FROM ar_rows r JOIN ar_fit c ON c.series_id = r.series_id AND c.horizon = r.horizon AND c.fold_idx = r.yrank - 1)"""
ORACLE["ar1_cv_predictions"] = q(f"WITH {AR1_CV} SELECT *, 'ar1' AS model FROM ar_pred", ["y", "yhat"])
ORACLE["ar1_cv_metrics"] = q(f"""WITH {AR1_CV}, {scored_cte("ar_pred", "am", "series_id, fold_idx, horizon")}
SELECT f.series_id, f.fold_idx, f.test_year, a.horizon, {", ".join("a." + c for c in FOLD_METRIC_COLS)},
       'success' AS status, CAST(NULL AS VARCHAR) AS error, 'ar1' AS model
FROM ar_folds f JOIN am a USING (series_id, fold_idx)""", METRIC_COLS)


ORACLE["ar1_intervals"] = q(f"""WITH {AR1_CV},
iq AS (SELECT series_id, horizon, quantile_cont(y - yhat, 0.025) AS qlo, quantile_cont(y - yhat, 0.975) AS qhi
       FROM ar_pred WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY 1, 2)
SELECT c.series_id, c.fold_idx, c.ds, c.horizon, c.yhat, c.yhat + i.qlo AS lower, c.yhat + i.qhi AS upper
FROM ar_pred c LEFT JOIN iq i USING (series_id, horizon)""", ["yhat", "lower", "upper"])


def _test_rows(fit: str, model: str) -> str:
    return (f"SELECT r.series_id, 0 AS fold_idx, r.ds, r.horizon, r.y, c.b0 + c.bx * r.x + c.bt * r.t AS yhat, '{model}' AS model "
            f"FROM ar_rows r JOIN {fit} c USING (series_id, horizon) WHERE r.split = 'test'")


AR1_FINAL = f"""{AR1_ROWS},
ar_tr AS (SELECT * FROM ar_rows WHERE split = 'train'),
{_fit("ar_ff", "ar_tr", "series_id, horizon")}"""
ORACLE["ar1_final_fit"] = q(f"WITH {AR1_FINAL} {_test_rows('ar_ff', 'ar1')}", ["y", "yhat"])


def _huber(k: int, before: str, rows: str = "ar_tr", group: str = "series_id, horizon") -> str:
    """One pass: residuals of the fit before, their scale, weights, the next fit."""
    r = "abs(r.y - (c.b0 + c.bx * r.x + c.bt * r.t))"
    return f"""
hr{k} AS (SELECT r.*, {r} AS res FROM {rows} r JOIN {before} c USING ({group}) WHERE r.x IS NOT NULL AND r.y IS NOT NULL),
hs{k} AS (SELECT {group}, CAST(1.345 AS DOUBLE) * (median(res) / CAST(0.6745 AS DOUBLE)) AS lim FROM hr{k} GROUP BY ALL),
hw{k} AS (SELECT {group}, a.x, a.t, a.y, CASE WHEN lim > 0 AND res > lim THEN lim / res ELSE CAST(1.0 AS DOUBLE) END AS w
          FROM hr{k} a JOIN hs{k} USING ({group})),
{_fit(f"hf{k}", f"hw{k}", group, "w")}"""


def _cv_rows(fit: str, model: str, horizons: int) -> str:
    return (f"SELECT r.series_id, c.fold_idx, r.ds, r.horizon, r.y, c.b0 + c.bx * r.x + c.bt * r.t AS yhat, '{model}' AS model FROM ar_rows r "
            f"JOIN {fit} c ON c.series_id = r.series_id AND c.horizon = r.horizon AND c.fold_idx = r.yrank - 1 WHERE r.horizon <= {horizons}")


_FOLD = "series_id, fold_idx, horizon"
ORACLE["ar1_cv_huber"] = q(f"WITH {AR1_CV}, {', '.join(_huber(k, b, 'ar_train', _FOLD) for k, b in ((1, 'ar_fit'), (2, 'hf1'), (3, 'hf2')))} "
                           f"{_cv_rows('hf3', 'ar1h', 2)}", ["y", "yhat"])
#: the last training day of each model, and a row's weight against it
_RECENT = "ar_end_t AS (SELECT *, max(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN t END) OVER (PARTITION BY series_id, fold_idx, horizon) AS t_end FROM ar_train)"
ORACLE["ar1_cv_newest"] = q(f"""WITH {AR1_CV}, {_RECENT}, ar_w AS (SELECT *, (1 + t / t_end) / 2 AS w FROM ar_end_t),
{_fit("ar_fw", "ar_w", _FOLD, "w")} {_cv_rows("ar_fw", "ar1n", 3)}""", ["y", "yhat"])
ORACLE["ar1_cv_half_life"] = q(f"""WITH {AR1_CV}, {_RECENT}, ar_w AS (SELECT *, pow(CAST(0.5 AS DOUBLE), t_end - t) AS w FROM ar_end_t),
{_fit("ar_fw", "ar_w", _FOLD, "w")} {_cv_rows("ar_fw", "ar1d", 3)}""", ["y", "yhat"])
ORACLE["quantile_intercept"] = q(f"""WITH {AR1_ROWS},
ql AS (SELECT f.series_id, f.fold_idx, {", ".join(f"quantile_cont(b.y, {q_}) AS q{100 * q_:g}" for q_ in (0.1, 0.5, 0.9))}
       FROM ar_base b JOIN ar_folds f ON f.series_id = b.series_id AND b.yrank <= f.fold_idx WHERE b.y IS NOT NULL GROUP BY 1, 2)
SELECT b.series_id, l.fold_idx, b.ds, 1 AS horizon, b.y, l.q10, l.q50, l.q90
FROM ar_base b JOIN ql l ON l.series_id = b.series_id AND l.fold_idx = b.yrank - 1""", ["y", "q10", "q50", "q90"])


ORACLE["ar1_huber_fit"] = q(f"WITH {AR1_FINAL}, {_huber(1, 'ar_ff')}, {_huber(2, 'hf1')}, {_huber(3, 'hf2')} {_test_rows('hf3', 'ar1h')}",
                            ["y", "yhat"])
AR1_FUTURE = f"""{AR1_FINAL},
ar_end AS (SELECT series_id, max(ds) AS last_ds, min(ds) AS first_ds, arg_max(y, ds) AS last_y FROM orders_clean GROUP BY 1),
ar_fut AS (
  SELECT e.series_id, 0 AS step, e.last_ds AS ds, e.last_y AS yhat, e.first_ds FROM ar_end e
  UNION ALL
  SELECT p.series_id, p.step + 1, CAST(p.ds + 1 AS DATE), c.b0 + c.bx * p.yhat + c.bt * (CAST(p.ds + 1 - p.first_ds AS DOUBLE) / 365.25), p.first_ds
  FROM ar_fut p JOIN ar_ff c ON c.series_id = p.series_id AND c.horizon = 1 WHERE p.step < 365)"""
ORACLE["ar1_future"] = q(f"""WITH RECURSIVE {AR1_FUTURE}
SELECT series_id, ds, CAST(step AS INTEGER) AS step, yhat, 'success' AS status, CAST(NULL AS VARCHAR) AS error FROM ar_fut WHERE step > 0""", ["yhat"])
ORACLE["ar1_future_tails"] = q(f"""WITH RECURSIVE {AR1_FUTURE},
ov AS (SELECT series_id, ds, 'history' AS kind, y AS value FROM orders_clean
       UNION ALL SELECT series_id, ds, 'forecast', yhat FROM ar_fut WHERE step > 0),
ovr AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS rd FROM ov)
SELECT o.series_id, o.ds, o.kind, o.value, CAST(p.period AS INTEGER) AS period
FROM ovr o JOIN (VALUES (30), (180), (365)) p(period) ON o.rd <= p.period""", ["value"])
ORACLE["ar1_ensemble"] = q(f"""WITH {AR1_CV}
SELECT series_id, fold_idx, ds, horizon, yhat, CASE WHEN yhat IS NULL THEN 0 ELSE 2 END::BIGINT AS n_members FROM ar_pred WHERE horizon = 1""", ["yhat"])

ORACLE["long_preprocessed"] = ORACLE["preprocessed"]
ORACLE["long_feature_table"] = ORACLE["feature_table"]
_EV = "PARTITION BY event_type ORDER BY ts, event_id"


def _event_roll(w: int) -> str:
    frame = f"OVER ({_EV} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    full = f"CASE WHEN count(value) {frame} = {w} THEN"
    return (f"{full} avg(value) {frame} END AS rolling_mean_{w}, {full} stddev_samp(value) {frame} END AS rolling_std_{w}, "
            f"{full} min(value) {frame} END AS rolling_min_{w}, {full} max(value) {frame} END AS rolling_max_{w}, "
            f"{full} max(value) {frame} - min(value) {frame} END AS rolling_range_{w}")


ORACLE["event_row_features"] = q(f"""SELECT event_type AS series_id, event_id, value AS y, row_number() OVER ({_EV}) - 1 AS pos,
  lag(value, 1) OVER ({_EV}) AS lag_1, lag(value, 90) OVER ({_EV}) AS lag_90, {_event_roll(7)}, {_event_roll(30)},
  value - lag(value, 1) OVER ({_EV}) AS diff_1 FROM events""",
    ["y", "lag_1", "lag_90", "diff_1"] + [f"rolling_{s}_{w}" for w in (7, 30) for s in ("mean", "std", "min", "max", "range")])

ORACLE["event_value_quantiles"] = q(f"""SELECT event_type, count(value) AS n,
  {", ".join(f"quantile_cont(value, {p}) AS q{i}" for i, p in enumerate((0.025, 0.25, 0.5, 0.75, 0.975)))}
FROM events WHERE value IS NOT NULL GROUP BY 1""", [f"q{i}" for i in range(5)])
ORACLE["large_prediction_intervals"] = ORACLE["prediction_intervals"]
HOURLY = """
hr_sum AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ds, sum(value) AS y FROM events GROUP BY 1, 2),
hr_span AS (SELECT series_id, min(ds) AS a, max(ds) AS b FROM hr_sum GROUP BY 1),
hr_all AS (SELECT series_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ds FROM hr_span),
hourly AS (SELECT a.series_id, a.ds, s.y, s.ds IS NULL AS is_gap FROM hr_all a LEFT JOIN hr_sum s ON s.series_id = a.series_id AND s.ds = a.ds)"""
_HW = "PARTITION BY series_id ORDER BY ds"
_HP, _HN = f"{_HW} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", f"{_HW} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"
ORACLE["hourly_events"] = q(f"""WITH {HOURLY},
hr_n AS (SELECT *, row_number() OVER ({_HW}) AS rn, lag(y, 24) OVER ({_HW}) AS lag_1d FROM hourly),
hr_p AS (SELECT *, last_value(y IGNORE NULLS) OVER ({_HP}) AS pv, last_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER ({_HP}) AS pi,
                first_value(y IGNORE NULLS) OVER ({_HN}) AS nv, first_value(CASE WHEN y IS NOT NULL THEN rn END IGNORE NULLS) OVER ({_HN}) AS ni FROM hr_n)
SELECT series_id, strftime(ds, '%Y-%m-%d %H:%M:%S') AS ds, y, is_gap, lag_1d,
  CASE WHEN y IS NOT NULL THEN y WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * ((rn - pi)::DOUBLE / (ni - pi)) END AS filled
FROM hr_p""", ["y", "lag_1d", "filled"])


def _hour_terms(days: float, order: int, prefix: str) -> tuple[str, list[str]]:
    angle = f"{TP} * {{k}} * (((epoch_us(ds)) % {round(days * 86_400 * 1_000_000)}) / {days * 86_400 * 1_000_000})"
    names = [f"fourier_{prefix}_{f}{k}" for k in range(1, order + 1) for f in ("sin", "cos")]
    return ", ".join(f"{f}({angle.format(k=k)}) AS fourier_{prefix}_{f}{k}" for k in range(1, order + 1) for f in ("sin", "cos")), names


_HOUR = [_hour_terms(365.25, 1, "yearly"), _hour_terms(7, 2, "weekly"), _hour_terms(1, 4, "daily")]
ORACLE["hourly_fourier"] = q(f"""WITH {HOURLY} SELECT series_id, strftime(ds, '%Y-%m-%d %H:%M:%S') AS ds, {", ".join(x for x, _ in _HOUR)} FROM hourly""",
                             [n for _, names in _HOUR for n in names])

#: Easter by Oudin's steps (1940): golden number, epact, full moon, Sunday.
_EASTERS = """
cal_years AS (SELECT unnest(range(lo, hi + 2)) AS year FROM (SELECT min(year(ds)) AS lo, max(year(ds)) AS hi FROM orders_panel) WHERE lo IS NOT NULL),
ea AS (SELECT year, year % 19 AS g, year // 100 AS c FROM cal_years),
eb AS (SELECT *, (c - c // 4 - (8 * c + 13) // 25 + 19 * g + 15) % 30 AS h FROM ea),
ec AS (SELECT *, h - (h // 28) * (1 - (29 // (h + 1)) * ((21 - g) // 11)) AS i FROM eb),
ed AS (SELECT *, i - (year + year // 4 + i + 2 - c + c // 4) % 7 AS l FROM ec),
easters AS (SELECT year, make_date(year, 3 + (l + 40) // 44, l + 28 - 31 * ((3 + (l + 40) // 44) // 4)) AS e FROM ed)"""
COUNTRIES = ("DE", "FR", "GB")
_CALS = " UNION ALL ".join(f"SELECT '{c}' AS country, CAST(ds AS DATE) AS ds, name FROM ({_holiday_rows(c)}) h WHERE ds IS NOT NULL" for c in COUNTRIES)
ORACLE["holiday_calendars"] = f"WITH {ORDERS_PANEL}, {_EASTERS} {_CALS}"


def _on(country: str, shift: int, name: str) -> str:
    return f"CAST(EXISTS (SELECT 1 FROM cals c WHERE c.country = '{country}' AND c.ds = CAST(p.ds + ({shift}) AS DATE)) AS INTEGER) AS {name}"


ORACLE["holiday_windows"] = q(f"""WITH {ORDERS_PANEL}, {_EASTERS}, cals AS ({_CALS})
SELECT p.*, {", ".join(_on(c, 0, f"is_holiday_{c.lower()}") for c in COUNTRIES)},
  {_on("GB", 1, "holiday_before_1")}, {_on("GB", 2, "holiday_before_2")}, {_on("GB", -1, "holiday_after_1")} FROM orders_panel p""", ["y"])
