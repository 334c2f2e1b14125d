"""Timings of the headline stages; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from panelwright import ForecastOptions, PanelSpec, scale  # noqa: E402
from panelwright.operators import cleanup, evaluate, forecast, frames, prepare, windows  # noqa: E402
from panelwright.plans.features import raw_features  # noqa: E402
from panelwright.plans.prepare import prepare_panel  # noqa: E402
from panelwright.sources.retail import daily_panel  # noqa: E402

SPEC, OPTS = PanelSpec(), ForecastOptions()


def session(cpus: str) -> SparkSession:
    return (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
            .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
            # wide projections: methods beyond the JIT's size limit would run interpreted
            .config("spark.sql.codegen.hugeMethodLimit", "8000")
            .config("spark.python.sql.dataFrameDebugging.enabled", "false")
            .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-")).getOrCreate())


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    raw = daily_panel(spark, sf, gappy=True)
    panel = scale.written(raw)
    dense = scale.written(prepare_panel(panel, SPEC))
    built = scale.written(raw_features(dense, SPEC))
    rules = cleanup.fit(built, SPEC)
    history = cleanup.apply(dense, SPEC, rules).select("sku", "date", "sales", "promo_flag")
    history = scale.written(history)
    train, test = frames.train_test_split(history, SPEC, 14)

    def backtest():
        tested = forecast.backtest(train, SPEC, OPTS)
        noop(forecast.combine(tested, forecast.ensemble_weights(forecast.leaderboard(tested))))

    def evaluation():
        predicted = forecast.point_forecasts(train, SPEC, 14)
        aligned = evaluate.align(test, predicted, SPEC, 14, point="trend_weekday")
        evaluate.metrics(aligned, evaluate.count_series(test, SPEC)).collect()

    stages = {
        "panel_densify": lambda: noop(prepare.densify(raw, SPEC)),
        "prepare_panel": lambda: noop(prepare_panel(panel, SPEC)),
        "lags_rolling": lambda: noop(windows.rolling(windows.lags(dense, SPEC), SPEC)),
        "ewm": lambda: noop(windows.ewm(dense, SPEC)),
        "all_features": lambda: noop(raw_features(dense, SPEC)),
        "cleanup": lambda: noop(cleanup.apply(built, SPEC, cleanup.fit(built, SPEC))),
        "backtest": backtest,
        "evaluation": evaluation,
    }
    timings, cold = {}, {}
    for name, run in stages.items():
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            run()
            taken.append(time.perf_counter() - start)
        cold[name], timings[name] = round(taken[0], 3), round(statistics.median(taken), 3)
    print(json.dumps({"metric": "demand_panel_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "first_run": cold, "panel_rows": dense.count(), "sf": os.path.basename(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
