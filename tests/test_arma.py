"""ARIMA by two-stage least squares: known coefficients, plain recursions, short and flat series."""
import datetime as dt

import numpy as np
import pytest

from revlens.operators import arma

START = dt.date(2015, 1, 5)


def _frame(spark, series):
    rows = [(k, START + dt.timedelta(weeks=i), None if v is None else float(v)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "key string, week date, y double").repartition(3)


def _simulated(n, phi, theta, const=0.0, seed=0, sigma=1.0):
    rng = np.random.default_rng(seed)
    e, z = rng.normal(0, sigma, n + 200), np.zeros(n + 200)
    for t in range(max(len(phi), len(theta)), n + 200):
        z[t] = const + sum(f * z[t - 1 - i] for i, f in enumerate(phi)) + e[t] + sum(h * e[t - 1 - i] for i, h in enumerate(theta))
    return z[200:]


@pytest.mark.parametrize("phi, theta", [([0.6], [0.5]), ([0.5, -0.3], [0.4]), ([0.7], [-0.2, 0.3]), ([], [0.6]), ([0.4, 0.2], [])])
def test_simulated_coefficients_are_recovered(phi, theta):
    m = arma.fit_series(_simulated(6000, phi, theta, const=2.0, sigma=3.0), len(phi), len(theta))
    assert np.allclose(m["phi"], phi, atol=0.06) and np.allclose(m["theta"], theta, atol=0.06) and not m["adjusted"]
    assert abs(m["sigma2"] - 9.0) < 0.5 and abs(m["const"] - 2.0) < 0.4


def test_order_525_beats_its_autoregression():
    """A moving average that five lags cannot stand for."""
    z = _simulated(5000, [], [0.9, 0.0, 0.0, 0.8, 0.7], seed=3)
    full, ar = arma.fit_series(z, 5, 5), arma.fit_series(z, 5, 0)
    assert full["sigma2"] < 0.9 * ar["sigma2"]


def test_over_differenced_series_stays_bounded():
    z = np.diff(np.random.default_rng(5).normal(size=340), 2)
    m = arma.fit_series(z, 5, 5)
    roots = np.roots([1.0, *m["theta"]])
    assert np.abs(roots).max() <= arma.ROOT_LIMIT + 1e-9
    e = arma.innovations(z, np.array(m["phi"]), np.array(m["theta"]), m["const"])
    assert np.abs(e).max() < 20


def test_jvm_recursions_match_plain_loops(spark):
    order, h = (2, 1, 2), 9
    series = {"a": np.cumsum(_simulated(300, [0.5, 0.1], [0.3, 0.2], 1.0)), "b": np.cumsum(_simulated(200, [0.2], [-0.4], seed=9)),
              "short": [1.0, 2.0, 4.0], "flat": [7.0] * 60, "gap": [None, 3.0, None]}
    fitted = arma.fit(_frame(spark, series), ["key"], "y", order).cache()
    models = {r.key: r for r in arma.coefficients(fitted, ["key"]).collect()}
    assert models["short"].phi is None and models["gap"].const is None
    out = {}
    for r in arma.forecast(fitted, ["key"], order, h, "y").collect():
        out.setdefault(r.key, []).append(r)
    for key in ("a", "b", "flat"):
        y, m = np.array(series[key], float), models[key]
        z = np.diff(y)
        e = arma.innovations(z, np.array(m.phi), np.array(m.theta), m.const)
        rows = sorted(out[key], key=lambda r: r.Date)
        past, future = rows[:len(y)], rows[len(y):]
        assert [r.y for r in past] == y.tolist() and all(r.predicted_mean is None for r in past)
        assert [r.ARIMA is None for r in past] == [i < 3 for i in range(len(y))]
        assert np.allclose([r.ARIMA for r in past[3:]], y[3:] - e[2:], rtol=1e-9, atol=1e-7)
        zs, es, level, want = z.tolist(), e.tolist(), y[-1], []
        for _ in range(h):
            zs.append(m.const + m.phi[0] * zs[-1] + m.phi[1] * zs[-2] + m.theta[0] * es[-1] + m.theta[1] * es[-2])
            es.append(0.0)
            level += zs[-1]
            want.append(level)
        assert np.allclose([r.predicted_mean for r in future], want, rtol=1e-9, atol=1e-7)
        assert [r.Date for r in future] == [past[-1].Date + dt.timedelta(weeks=i + 1) for i in range(h)]
    assert len(out["short"]) == 3 and len(out["gap"]) == 1 and all(r.ARIMA is None for r in out["short"])


@pytest.mark.parametrize("order", [(0, 0, 0), (0, 1, 1), (1, 0, 0), (5, 2, 5)])
def test_every_order_runs(spark, order):
    df = _frame(spark, {"a": 50 + np.cumsum(_simulated(150, [0.3], [0.2], seed=2)), None: np.arange(80.0)})
    rows = arma.arima_forecast(df, ["key"], "y", order, 4).collect()
    assert len(rows) == 150 + 80 + 8
    future = [r.predicted_mean for r in rows if r.key is None and r.predicted_mean is not None]
    if order[1] == 2:
        assert np.allclose(sorted(future), [80, 81, 82, 83], atol=1e-6)


def test_empty_table(spark):
    df = spark.createDataFrame([], "key string, week date, y double")
    assert arma.arima_forecast(df, ["key"], "y").collect() == []


def test_item_forecast_by_method_and_centre(spark):
    from conftest import SF_SMALL
    from revlens.plans import jobs
    from revlens.sources import sales
    lines = sales(spark, SF_SMALL, ["OrderNumber", "OrderDate", "Quantity", "NetRevenue", "ProductSubgroup", "State"]).cache()
    one = jobs.forecast_items(lines, 2000, "2001-12-31", 4, [3], "arima", "Bayern")
    assert one.columns == ["DistributionCenter", "Date", "Quantity", "ARIMA", "predicted_mean"]
    assert {r.DistributionCenter for r in one.select("DistributionCenter").distinct().collect()} == {"Bayern"}
    assert one.where("predicted_mean IS NOT NULL").count() == 4
    for center, subgroup, method in (("Nowhere", None, "lag"), ("Bayern", "none", "lag"), (None, "Brand#11", "lag"), ("Bayern", None, "other")):
        with pytest.raises(ValueError):
            jobs.forecast_items(lines, 2000, "2001-12-31", 4, [3], method, center, subgroup)
    lines.unpersist()
