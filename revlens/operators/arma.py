"""FC-6: ARIMA(p, d, q) of every key's weekly series in one job.

The fit is least squares in two stages: a long autoregression gives estimates of
the innovations, then the differenced value is regressed on its own lags and on
lags of the innovations.  The innovations are computed anew by their recursion
and the second stage is repeated while that lowers their variance.  Roots of
either polynomial beyond ``ROOT_LIMIT`` (an over-differenced series has unit
roots in its moving average) are drawn inside: a moving-average root outside the
circle is replaced by its reciprocal first, which leaves the autocovariances'
shape; ``adjusted`` reports it.

A key is one row that holds its weeks as an array (bounded by the calendar, not
by the order lines), made by one aggregation.  The fit is a vectorised function
of that array; the innovation recursion over the history, the h-step forecast and
its integration back to levels are folds inside the JVM.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROOT_LIMIT = 0.99
ROUNDS = 4
MODEL = "struct<phi:array<double>,theta:array<double>,const:double,sigma2:double,n:bigint,adjusted:boolean>"
_STATE = "struct<z:array<double>,e:array<double>,out:array<double>>"


# ---------------------------------------------------------------------------
# the fit of one series
# ---------------------------------------------------------------------------

def _lagged(x: np.ndarray, lags: int, first: int) -> np.ndarray:
    """Rows ``t = first ..`` of the ``lags`` values before ``t``, newest first."""
    return np.stack([x[first - j:len(x) - j] for j in range(1, lags + 1)], axis=1) if lags else np.zeros((len(x) - first, 0))


def _least_squares(X: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.linalg.lstsq(np.hstack([np.ones((len(y), 1)), X]), y, rcond=None)[0]


def _inside(poly: np.ndarray, reflect: bool) -> tuple[np.ndarray, bool]:
    """Coefficients after the leading 1 with all roots within ``ROOT_LIMIT``."""
    roots = np.roots(np.append(1.0, poly))
    size = np.abs(roots)
    if not len(roots) or size.max() <= ROOT_LIMIT:
        return poly, False
    if reflect:
        out = size > 1
        roots[out] = 1 / np.conj(roots[out])
        size = np.abs(roots)
    far = size > ROOT_LIMIT
    roots[far] *= ROOT_LIMIT / size[far]
    new = np.real(np.poly(roots))[1:]
    return np.append(new, np.zeros(len(poly) - len(new))), True


def innovations(z: np.ndarray, phi: np.ndarray, theta: np.ndarray, const: float) -> np.ndarray:
    """One-step errors; 0 for the first ``p`` values, which have no prediction."""
    p, q = len(phi), len(theta)
    e = np.zeros(len(z) + q)
    ar = np.zeros(len(z))
    ar[p:] = const + _lagged(z, p, p) @ phi
    for t in range(p, len(z)):
        e[t + q] = z[t] - ar[t] - (theta @ e[t:t + q][::-1] if q else 0.0)
    return e[q:]


def fit_series(z, p: int, q: int) -> dict | None:
    """Coefficients of the differenced series ``z``; None where it is too short."""
    z = np.asarray([np.nan if v is None else v for v in z], float)
    n = len(z)
    m = 0
    if q:
        m = max(p + q, min(2 * (p + q), int(10 * np.log10(max(n, 2)))))
        m = min(m, (n - 2) // 3)
        if m < 1:
            return None
    if not np.isfinite(z).all() or n - max(m + q, p) < p + q + 2:
        return None
    scale = z.std()
    if scale <= 1e-12 * max(1.0, np.abs(z).max()):
        return {"phi": [0.0] * p, "theta": [0.0] * q, "const": float(z.mean()), "sigma2": 0.0, "n": n, "adjusted": False}
    x = (z - z.mean()) / scale
    e = np.zeros(n)
    if q:
        long = _least_squares(_lagged(x, m, m), x[m:])
        e[m:] = x[m:] - long[0] - _lagged(x, m, m) @ long[1:]
    first, best = max(m + q, p), None
    for _ in range(ROUNDS if q else 1):
        coef = _least_squares(np.hstack([_lagged(x, p, first), _lagged(e, q, first)]), x[first:])
        phi, a = _inside(-coef[1:p + 1], False)
        phi = -phi
        theta, b = _inside(coef[p + 1:], True)
        const = coef[0]
        if a or b:
            const += (x[first:] - const - _lagged(x, p, first) @ phi - _lagged(e, q, first) @ theta).mean()
        e = innovations(x, phi, theta, const)
        var = float((e[p:] ** 2).mean())
        if best is not None and not var < best[0] * (1 - 1e-6):
            break
        best, first = (var, phi, theta, const, a or b), max(p, q)
    var, phi, theta, const, adjusted = best
    return {"phi": phi.tolist(), "theta": theta.tolist(), "const": float(const * scale + z.mean() * (1 - phi.sum())),
            "sigma2": var * scale**2, "n": n, "adjusted": bool(adjusted)}


# ---------------------------------------------------------------------------
# all series
# ---------------------------------------------------------------------------

def _difference(a: Column) -> Column:
    """First differences of an array, one element shorter."""
    return F.transform(F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0))), lambda x, i: x - a[i])


def _dot(a: str, b: str) -> str:
    return f"aggregate(zip_with({a}, {b}, (a, b) -> a * b), 0D, (t, a) -> t + a)"


def fit(series: DataFrame, keys: list[str], value: str, order: tuple[int, int, int] = (5, 2, 5)) -> DataFrame:
    """One row per key: ``keys, weeks, y`` (arrays by week), the d-th differences ``z``,
    ``last`` (last value of each lower difference) and ``model`` (null where the series is too short).
    Weeks without a value are left out; null keys are a key of their own.
    """
    p, d, q = order

    @F.pandas_udf(MODEL)
    def solve(z: pd.Series) -> pd.DataFrame:
        rows = [fit_series(v, p, q) or dict.fromkeys(("phi", "theta", "const", "sigma2", "n", "adjusted")) for v in z]
        return pd.DataFrame(rows, columns=["phi", "theta", "const", "sigma2", "n", "adjusted"]).astype(
            {"const": float, "sigma2": float, "n": "Int64", "adjusted": "boolean"})

    s = series.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("week", F.col(value).cast("double").alias("y")))).alias("_h"))
    s = s.select(*keys, F.col("_h.week").alias("weeks"), F.col("_h.y").alias("y"))
    for j in range(d):
        s = s.withColumn(f"_d{j}", F.col("y") if j == 0 else F.col("_z"))
        s = s.withColumn("_z", _difference(F.col(f"_d{j}")))
    z = F.col("_z") if d else F.col("y")
    last = F.array(*[F.try_element_at(f"_d{j}", F.lit(-1)) for j in range(d)]).cast("array<double>")
    return s.select(*keys, "weeks", "y", z.alias("z"), last.alias("last")).withColumn("model", solve("z"))


def coefficients(fitted: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, phi, theta, const, sigma2, n, adjusted`` of :func:`fit`."""
    return fitted.select(*keys, "model.phi", "model.theta", "model.const", "model.sigma2", "model.n", "model.adjusted")


def forecast(fitted: DataFrame, keys: list[str], order: tuple[int, int, int], horizon: int = 52,
             value_name: str = "value") -> DataFrame:
    """History with the fitted values ``ARIMA`` and ``horizon`` future weeks with ``predicted_mean``.

    One row per key and week: ``keys, Date, <value_name>, ARIMA, predicted_mean``.
    The first ``d + p`` weeks have no fitted value; a key that is too short has
    history only.
    """
    p, d, q = order
    guess = f"model.const + {_dot('model.phi', 's.z')} + {_dot('model.theta', 's.e')}"
    known = f"IF(size(s.z) < {p}, CAST(NULL AS DOUBLE), {guess})"

    def step(new_z: str, new_e: str, out: str) -> str:
        return (f"CAST(named_struct('z', slice(concat(array({new_z}), s.z), 1, {p}), "
                f"'e', slice(concat(array({new_e}), s.e), 1, {q}), 'out', concat(s.out, array({out}))) AS {_STATE})")

    start = f"CAST(named_struct('z', array(), 'e', array_repeat(0D, {q}), 'out', array()) AS {_STATE})"
    past = F.expr(f"aggregate(z, {start}, (s, x) -> {step('x', f'coalesce(x - ({known}), 0D)', known)})")
    f = fitted.withColumn("_past", past)
    ahead = F.expr(f"aggregate(sequence(1, {horizon}), CAST(named_struct('z', _past.z, 'e', _past.e, 'out', array()) AS {_STATE}), "
                   f"(s, i) -> {step(guess, '0D', guess)}).out")
    level = ahead
    for j in reversed(range(d)):
        f = f.withColumn("_f", level)
        level = F.expr(f"aggregate(_f, CAST(named_struct('at', last[{j}], 'out', array()) AS struct<at:double,out:array<double>>), "
                       "(s, x) -> CAST(named_struct('at', s.at + x, 'out', concat(s.out, array(s.at + x))) AS struct<at:double,out:array<double>>)).out")
    f = f.withColumn("_level", level)
    fit_at = F.expr(f"concat(array_repeat(CAST(NULL AS DOUBLE), least({d}, size(y))), "
                    f"transform(_past.out, (g, i) -> y[i + {d}] - z[i] + g))")
    null = F.lit(None).cast("double")
    past_rows = f.select(*keys, F.inline(F.arrays_zip(F.col("weeks").alias("Date"), F.col("y").alias("y"), fit_at.alias("ARIMA")))).select(
        *keys, "Date", F.col("y").alias(value_name), "ARIMA", null.alias("predicted_mean"))
    next_rows = (f.where("model.const IS NOT NULL").select(*keys, F.array_max("weeks").alias("_end"), F.posexplode("_level").alias("_i", "_p"))
                 .select(*keys, F.date_add("_end", (F.col("_i") + 1) * 7).alias("Date"), null.alias(value_name), null.alias("ARIMA"),
                         F.col("_p").alias("predicted_mean")))
    return past_rows.unionByName(next_rows)


def arima_forecast(series: DataFrame, keys: list[str], value: str, order: tuple[int, int, int] = (5, 2, 5),
                   horizon: int = 52, value_name: str | None = None) -> DataFrame:
    """FC-6: fit and forecast; the fitted rows (one per key) are written once for both halves of the result."""
    from .cluster import materialise
    return forecast(materialise(fit(series, keys, value, order)), keys, order, horizon, value_name or value)
