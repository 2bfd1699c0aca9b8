"""Moving statistics, walk-forward fits, forecasts and lead-lag correlation against plain computations."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_windows import SCHEMA, skewed
from tickseries.operators.align import align_last_known
from tickseries.operators.rolling import rolling_statistics
from tickseries.operators.stats import fit_linear, forecast_errors, lag_features, lead_lag_correlation, next_value, walk_forward


@pytest.fixture(scope="module")
def rows():
    return [(a, t, i, None if i % 9 == 0 else p) for a, t, i, p in skewed(400)]


@pytest.fixture(scope="module")
def ticks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("width", [1, 2, 7, 40, 1000])
@pytest.mark.parametrize("rows_per_task", [None, 60])
def test_rolling_statistics(ticks, rows, width, rows_per_task):
    found = rolling_statistics(ticks, ["asset"], ["t", "id"], "price", width, rows_per_task=rows_per_task)
    assert found.columns == [*ticks.columns, "rolling_avg", "rolling_stddev", "rolling_min", "rolling_max"]
    got = {r["id"]: tuple(r)[4:] for r in found.collect()}
    assert len(got) == len(rows)
    for row in rows:
        past = sorted(r for r in rows if r[0] == row[0] and r[1:3] <= row[1:3])[-width:]
        known = [r[3] for r in past if r[3] is not None]
        if len(past) < width or not known:
            assert got[row[2]] == (None,) * 4
            continue
        avg, deviation, low, high = got[row[2]]
        assert (avg, low, high) == (pytest.approx(statistics.fmean(known), abs=1e-9), min(known), max(known))
        assert deviation == (pytest.approx(statistics.stdev(known), abs=1e-9) if len(known) > 1 else None)


def test_rolling_statistics_lose_nothing_to_cancellation(spark):
    """Tiny moves on a huge level: differences of running sums would lose them."""
    rows = [("a", i, i, 1e9 + (i % 3) * 1e-3) for i in range(3000)]
    found = rolling_statistics(spark.createDataFrame(rows, SCHEMA), ["asset"], ["t", "id"], "price", 500, ["stddev"])
    last = found.orderBy(F.desc("t")).first()["rolling_stddev"]
    assert last == pytest.approx(statistics.stdev([r[3] for r in rows[-500:]]), rel=1e-6)
    with pytest.raises(ValueError):
        rolling_statistics(found, ["asset"], ["t", "id"], "price", 5, ["median"])


FORECAST = "g string, day int, k int, x1 double, x2 double, y double"


def observations(seed, change_from=None):
    rng = random.Random(seed)
    rows = []
    for g in ("a", "b"):
        for day in range(12):
            for k in range(6):
                x1, x2 = rng.random() * 10, rng.random() * 5
                y = 3 + 2 * x1 - x2 + rng.gauss(0, 0.5)
                if change_from is not None and day >= change_from:
                    y = y * 100 - 7
                rows.append((g, day, k, x1, x2, None if (day + k) % 13 == 0 else y))
    return rows + [("few", 0, 0, 1.0, 2.0, 3.0), (None, 3, 0, 1.0, 1.0, 1.0)]


def walked(spark, rows):
    frame = spark.createDataFrame(rows, FORECAST).repartition(3)
    return walk_forward(frame, "y", ["x1", "x2"], ["g"], F.col("day"))


def test_walk_forward_fits_earlier_periods_only(spark):
    rows = observations(1)
    got = {(r["g"], r["day"], r["k"]): r for r in walked(spark, rows).collect()}
    assert len(got) == len(rows)
    n_predicted = 0
    for g, day, k, x1, x2, _ in rows:
        past = [r for r in rows if r[0] == g and r[1] < day and r[5] is not None]
        found = got[(g, day, k)]
        if len(past) < 10:
            assert found["predicted"] is None and found["n_fitted"] == 0
            continue
        b = np.linalg.lstsq(np.array([[1, r[3], r[4]] for r in past]), np.array([r[5] for r in past]), rcond=None)[0]
        assert found["predicted"] == pytest.approx(b @ [1, x1, x2], abs=1e-7)
        assert found["n_fitted"] == len(past)
        n_predicted += 1
    assert n_predicted > 100


def test_later_rows_cannot_change_a_prediction(spark):
    before = {(r["g"], r["day"], r["k"]): r["predicted"] for r in walked(spark, observations(1)).collect()}
    changed = {(r["g"], r["day"], r["k"]): r["predicted"] for r in walked(spark, observations(1, change_from=8)).collect()}
    earlier = [key for key in before if key[1] <= 8]
    assert all(before[key] == pytest.approx(changed[key], abs=1e-9) if before[key] is not None else changed[key] is None for key in earlier)
    assert any(before[key] != changed[key] for key in before if key[1] > 8)


def test_forecast_errors(spark):
    found = forecast_errors(spark.createDataFrame([("a", 1.0, 2.0, 1.5), ("a", 5.0, 2.0, 5.0), ("a", None, 1.0, 1.0), ("a", 1.0, None, 1.0)], "g string, y double, p double, n double"), "y", "p", ["g"], "n")
    assert found.collect()[0].asDict() == {"g": "a", "n": 2, "mean_abs_error": 2.0, "rmse": math.sqrt(5), "naive_mean_abs_error": 0.25, "naive_rmse": pytest.approx(math.sqrt(0.125))}


def test_next_value(spark):
    rng = random.Random(2)
    rows = [("a", i, i, 50 + rng.random()) for i in range(40)] + [("b", 1, 1, 5.0)]
    lags = lag_features(spark.createDataFrame(rows, SCHEMA), ["asset"], ["t", "id"], "price", 2)
    fitted = fit_linear(lags, "price", ["lag_1", "lag_2"], ["asset"])
    (found,) = next_value(lags, fitted, "price", 2, ["asset"], ["t", "id"]).collect()
    p = [r[3] for r in rows[:40]]
    b = np.linalg.lstsq(np.array([[1, p[i - 1], p[i - 2]] for i in range(2, 40)]), np.array(p[2:]), rcond=None)[0]
    assert (found["asset"], found["t"], found["predicted"]) == ("a", 39, pytest.approx(b @ [1, p[39], p[38]], abs=1e-6))


@pytest.mark.parametrize("rows_per_task", [1000, 13])
def test_lead_lag_correlation(spark, rows_per_task):
    rng = random.Random(6)
    rows = [(i, rng.random(), None if i % 10 == 0 else rng.random(), None) for i in range(80)]
    frame = spark.createDataFrame(rows, "t int, a double, b double, c double").repartition(3)
    found = {(r["leader"], r["follower"], r["lag"]): (r["n_pairs"], r["corr"]) for r in lead_lag_correlation(frame, ["t"], {"A": "a", "B": "b", "C": "c"}, 2, rows_per_task).collect()}
    assert len(found) == 27
    for (leader, follower, lag), (n, corr) in found.items():
        x, y = ("ABC".index(leader) + 1, "ABC".index(follower) + 1)
        pairs = [(rows[i - lag][x], rows[i][y]) for i in range(lag, 80)]
        pairs = [p for p in pairs if None not in p]
        assert n == len(pairs)
        assert corr == (pytest.approx(np.corrcoef(*zip(*pairs))[0, 1], abs=1e-9) if n > 1 else None)


def test_no_exchange_gathers_an_asset(spark, ticks):
    """Nothing goes to one partition, and no exchange or window of rows is keyed by the asset alone."""
    said = ticks.select("asset", F.col("t").alias("ts"), "id", "price")
    found = align_last_known(said.where("id % 2 = 0"), said.where("id % 2 = 1"), "ts", {"price": "known"}, ["id"], ["asset"], rows_per_task=50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    by_asset = [x for x in plan.splitlines() if "Exchange hashpartitioning(asset#" in x and "_chunk" not in x]
    assert len(by_asset) <= 1  # that of the chunks' totals, at most one row a chunk and asset
