"""Benchmark: headline plans on the driver tables, one JSON line on stdout.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT`` (default 3; the reported figure is the warm
median after one cold run).  Every stage is forced with a ``noop`` write,
so the whole plan runs and nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelcast.operators import clean as C  # noqa: E402
from panelcast.operators import evaluate as E  # noqa: E402
from panelcast.operators import features as FE  # noqa: E402
from panelcast.operators import forecast as FC  # noqa: E402
from panelcast.plans import catalog as CAT  # noqa: E402
from panelcast.plans import workflow as WF  # noqa: E402
from panelcast.session import local_session  # noqa: E402
from panelcast.sources import tables as T  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="panelcast-bench")

    def supplier_clean():
        return C.preprocess_complete(T.lineitem_supplier_panel(spark, sf_dir)).select("series_id", "ds", "y", "pos")

    def orders_clean():
        return CAT.cleaned_orders(spark, sf_dir).select("series_id", "ds", "y")

    plans = {
        "daily_rollup": lambda: T.lineitem_supplier_panel(spark, sf_dir),
        "feature_table": lambda: FE.create_all_features(supplier_clean()),
        "cv_seasonal_naive": lambda: WF.cv_seasonal_naive(supplier_clean().select("series_id", "ds", "y")),
        "cv_linear_ar": lambda: WF.cv_linear(supplier_clean().select("series_id", "ds", "y"),
                                             FC.LinearARConfig())[0],
        "metrics_summary": lambda: E.cv_summary(
            WF.cv_seasonal_naive(supplier_clean().select("series_id", "ds", "y")), ["series_id"]),
        "horizons_30": lambda: WF.cv_linear(orders_clean(), FC.LinearARConfig(n_forecasts=30))[0],
        "huber_final_fit": lambda: WF.final_fit(orders_clean(), FC.LinearARConfig(loss="huber"))[0],
        "row_origin_cv": lambda: CAT.QUERIES["rolling_origin_cv"](spark, sf_dir),
        "flagship_orders_cv": lambda: CAT.QUERIES["cv_seasonal_naive"](spark, sf_dir),
    }
    timings = {}
    for name, build in plans.items():
        run(build())  # cold run: JIT, file listing, Python workers
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run(build())
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
        print(f"{name} {timings[name]} s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_warm_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "panel": "lineitem daily quantity by l_suppkey; flagship on orders by o_orderpriority",
    }))


if __name__ == "__main__":
    main()
