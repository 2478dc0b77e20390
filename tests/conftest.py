import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelcast.session import local_session
    # hundreds of plans over a few rows each: compiling them would take longer than running them
    s = local_session("*", shuffle_partitions=4, app="panelcast-tests", extra={
        "spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"})
    yield s
    s.stop()


@pytest.fixture()
def panel_df(spark):
    """Build a panel DataFrame from {series: [(date, y), ...]}."""
    import datetime as dt

    def make(data):
        rows = []
        for sid, pts in data.items():
            for d, y in pts:
                rows.append((sid, dt.date.fromisoformat(d) if isinstance(d, str) else d,
                             None if y is None else float(y)))
        return spark.createDataFrame(rows, "series_id string, ds date, y double")
    return make


def daily(start, values):
    import datetime as dt
    d0 = dt.date.fromisoformat(start)
    return [(d0 + dt.timedelta(days=i), v) for i, v in enumerate(values)]
