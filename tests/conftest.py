import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def panel_of(spark):
    """Build a panel from ``{series: [targets]}``: consecutive days from 2024-01-01 (a Monday)."""
    def build(series, **columns):
        import datetime as dt
        rows = []
        for name, values in series.items():
            for i, v in enumerate(values):
                extra = {c: (col[name][i] if isinstance(col[name], list) else col[name]) for c, col in columns.items()}
                rows.append({"sku": name, "date": dt.date(2024, 1, 1) + dt.timedelta(days=i),
                             "sales": None if v is None else float(v), **extra})
        kinds = {"promo_flag": "int", "promo_discount": "double", "price": "double", "special_event": "int"}
        schema = "sku string, date date, sales double" + "".join(
            f", {c} {kinds.get(c, 'string')}" for c in columns)
        return spark.createDataFrame(rows, schema)
    return build


@pytest.fixture
def by_series():
    """Collect one column as ``{series: [values in day order]}``."""
    def collect(df, column):
        out = {}
        for row in df.select("sku", "date", column).orderBy("sku", "date").collect():
            out.setdefault(row[0], []).append(row[2])
        return out
    return collect
