"""State of series, stored panels, sketches and joins of hot keys."""

import dataclasses
import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwright import PanelSpec, Settings, scale
from panelwright.operators import cleanup, cross, forecast, regression, windows
from panelwright.plans import forecasting, state

SPEC = PanelSpec()


@pytest.fixture
def panel(spark):
    rng = np.random.default_rng(4)
    rows = []
    for s, n in enumerate((120, 90, 61, 8, 3, 1)):
        for d in range(n):
            x = None if rng.random() < 0.1 else float(rng.integers(0, 50))
            rows.append((f"s{s}", dt.date(2024, 1, 1) + dt.timedelta(days=d), x, int(rng.random() < 0.2), 0.1, 0, f"c{s % 2}"))
    rows += [("none", dt.date(2024, 1, 1) + dt.timedelta(days=d), None, 0, 0.0, 0, None) for d in range(5)]
    return spark.createDataFrame(rows, "sku string, date date, sales double, promo_flag int, promo_discount double, special_event int, category string")


def by_key(df, *names):
    return {(r["sku"], r["date"]): tuple(r[n] for n in names) for r in df.collect()}


def close(got, want):
    assert got.keys() == want.keys()
    for k in want:
        for a, b in zip(got[k], want[k], strict=True):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, abs=1e-7)), k


@pytest.mark.parametrize("cut", [0, 1, 20, 200])
def test_merged_state_equals_the_whole_history(panel, cut):
    model = regression.fit_global(panel, SPEC, 7)
    keep = regression.reach(7)
    early = panel.where(F.col("date") < F.date_add(F.lit(dt.date(2024, 1, 1)), cut))
    after = state.merged(state.series_state(early, SPEC, keep), panel, SPEC, keep)
    names = (*forecast.MODELS, regression.NAME)
    got = by_key(state.forecasts(after, SPEC, 7, model), *names)
    whole = forecast.point_forecasts(panel, SPEC, 7).join(regression.predict_global(model, panel, SPEC).withColumnRenamed("mean", regression.NAME).drop("step"), ["sku", "date"])
    close(got, by_key(whole, *names))
    promo = panel.groupBy("sku").agg(F.max("date").alias("l")).select("sku", F.date_add("l", 2).alias("date"), F.lit(1).alias("promo_flag"), F.lit(0.3).alias("promo_discount"), F.lit(1).alias("special_event"))
    close(by_key(state.forecasts(after, SPEC, 7, model, promo), regression.NAME), by_key(regression.predict_global(model, panel, SPEC, promo), "mean"))


def test_stored_rows_need_no_exchange(spark, panel, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        state.store(panel, str(tmp_path / "panel"), "sku", ["date"], 4)
        df = state.stored(spark, str(tmp_path / "panel"))
        assert sorted(map(str, df.collect())) == sorted(map(str, panel.select(df.columns).collect()))
        model = dataclasses.replace(regression.fit_global(panel, SPEC, 7), encodings={}, coefficients={"mean_7": 0.5, "promo_flag": 2.0})
        state.store(state.series_state(df, SPEC, 42), str(tmp_path / "state"), "sku", [], 4)
        held = state.stored(spark, str(tmp_path / "state"))
        for out in (windows.rolling(windows.lags(df, SPEC), SPEC), state.series_state(df, SPEC), forecast.point_forecasts(df, SPEC), state.forecasts(held, SPEC, 7),
                    state.forecasts(held, SPEC, 7, model)):
            assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
        assert state.forecasts(held, SPEC, 7, model).count() == 7 * held.count()
        # merging shuffles the new days, not the state
        plan = state.merged(held, panel, SPEC, 42)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") + plan.count("SelectedBucketsCount: 4 out of 4") >= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_modes_keep_and_advance_the_state(spark, tmp_path):
    rng = np.random.default_rng(2)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=d) for d in range(120)]
    lines = [f"s{s},{d},{int(20 + 6 * (d.weekday() > 4) + rng.integers(0, 4))},{int(rng.random() < 0.2)},0.1,0,c{s % 2}" for s in range(4) for d in days]
    head = "sku,date,sales,promo_flag,promo_discount,special_event,category\n"
    (tmp_path / "train.csv").write_text(head + "\n".join(x for x in lines if x.split(",")[1] < "2024-04-20"))
    cfg = {"data": {"train_path": str(tmp_path / "train.csv"), "datetime_format": "%Y-%m-%d", "test_size": 7}, "features": {"static_features": ["category"]},
           "model": {"prediction_length": 7, "save_path": str(tmp_path / "model"), "num_val_windows": 1, "val_step_size": 7, "quantile_levels": [0.5]},
           "output": {"predictions_path": str(tmp_path / "out.csv"), "state_path": str(tmp_path / "state")}}
    settings = Settings.from_dict(cfg)
    forecasting.run(spark, settings, "train")
    assert {r["last"] for r in state.stored(spark, str(tmp_path / "state")).collect()} == {dt.date(2024, 4, 19)}
    (tmp_path / "train.csv").write_text(head + "\n".join(x for x in lines if x.split(",")[1] >= "2024-04-18"))
    got = by_key(forecasting.run(spark, settings, "predict")["forecast"], "mean")
    (tmp_path / "train.csv").write_text(head + "\n".join(lines))
    plain = dataclasses.replace(settings, paths={k: v for k, v in settings.paths.items() if k != "state_path"})
    want = by_key(forecasting.run(spark, plain, "predict")["forecast"], "mean")
    assert len(got) == 28 and got.keys() == want.keys()
    # the long way fits the series' bounds anew with the later days
    assert all(abs(got[k][0] - want[k][0]) < 1.5 for k in want)
    held = {r["last"]: r["n"] for r in state.stored(spark, str(tmp_path / "state")).collect()}
    assert held == {dt.date(2024, 4, 29): 120}


def test_sketched_medians_take_one_job(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(float(a), None if a > 1 else float(a) ** 3, int(a > 0)) for a in rng.standard_normal(20_000)], "a double, b double, is_c int").repartition(6).cache()
    df.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sketch", "sketch")
    rules = cleanup.fit(df, SPEC, "sketch")
    assert len(tracker.getJobIdsForGroup("sketch")) <= 2        # adaptive execution runs its one shuffle as a job of its own
    spark.sparkContext.setJobGroup("other", "other")
    counts, middle = scale.sketched_medians(df, ["a", "b"], 1000)
    for c in ("a", "b"):
        values = np.array([r[0] for r in df.select(c).collect() if r[0] is not None])
        assert counts[c] == len(values) and (values < middle[c]).mean() <= 0.501 and (values <= middle[c]).mean() >= 0.499
    assert set(rules.fill) == {"b"} and rules.numeric == ("a", "b", "is_c")
    with pytest.raises(ValueError, match="medians"):
        cleanup.fit(df, SPEC, "rough")
    none = scale.sketched_medians(df.where("a > 99"), ["a"])
    assert none == ({"": 0, "a": 0}, {"a": None})


def test_only_hot_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 100)
    rows = [("hot", 1.0, i) for i in range(1000)] + [(f"k{i}", float(i), i) for i in range(300)] + [(None, 2.0, i) for i in range(500)] + [("k1", None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v double, i int").repartition(4)
    stats = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("k IS NOT NULL AND v IS NOT NULL")
    got = scale.attach(df, stats, ["k", "v"], limit=5)
    assert sorted(map(str, got.collect())) == sorted(map(str, scale.attach(df, stats, ["k", "v"]).collect())) and got.count() == len(rows)


def test_price_positions_with_one_hot_price(spark, monkeypatch):
    rows = [(f"s{i}", dt.date(2024, 1, 1 + i % 2), 5.0 if i % 3 else float(i % 11), 1.0, "hot" if i % 5 else None) for i in range(900)] + [("x", dt.date(2024, 1, 1), None, 1.0, "hot")]
    df = spark.createDataFrame(rows, "sku string, date date, price double, sales double, category string")
    want = by_key(cross.price_position(df, SPEC), "price_rank_in_category")
    monkeypatch.setattr(scale, "GROUP_ROWS", 50)
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(scale, "HOT_ROWS", 40)
    got = by_key(cross.price_position(df, SPEC), "price_rank_in_category")
    known = {k for k, r in ((r[:2], r) for r in rows) if r[4]}
    close({k: v for k, v in got.items() if k in known}, {k: v for k, v in want.items() if k in known})
    assert len(got) == len(rows)
