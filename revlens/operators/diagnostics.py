"""Time-series diagnostics per key (FC-7..12).

Smoothing recursions are folds (``aggregate``) over a key's ordered values
inside the JVM; autocorrelations are lag windows plus sums; the partial
autocorrelation and the unit-root regression are small numpy solves per key
in ``applyInPandas`` (a group is one key's series, bounded by its weeks).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .timeaxis import centered_moving_average

# Asymptotic critical values of the constant-only unit-root test.
ADF_CRITICAL = {"1%": -3.43, "5%": -2.86, "10%": -2.57}


def _ordered_values(series: DataFrame, keys: list[str], value: str) -> DataFrame:
    return series.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("week", F.col(value).cast("double").alias("y")))),
                    lambda x: x["y"]).alias("_ys"),
        F.sort_array(F.collect_list("week")).alias("_weeks"))


def _explode_fitted(agg: DataFrame, keys: list[str], fitted) -> DataFrame:
    return agg.select(*keys, F.arrays_zip(F.col("_weeks").alias("week"), fitted.alias("fitted")).alias("_z")) \
              .select(*keys, F.inline("_z"))


def simple_exp_smoothing(series: DataFrame, keys: list[str], value: str, alpha: float) -> DataFrame:
    """FC-7: one-step-ahead fitted values; level starts at the first value."""
    agg = _ordered_values(series, keys, value)
    a = F.lit(float(alpha))
    y0 = F.element_at("_ys", 1)
    init = F.struct(y0.alias("l"), F.array(y0).alias("f"))
    fold = F.aggregate(F.slice("_ys", 2, F.size("_ys")), init, lambda acc, y: F.struct(
        (a * y + (1 - a) * acc["l"]).alias("l"), F.concat(acc["f"], F.array(acc["l"])).alias("f")))
    # the last level is the forecast for the week after the series; fitted values
    # are the levels before each observation
    return _explode_fitted(agg, keys, F.slice(fold["f"], 1, F.size("_ys")))


def ses_best_alpha(series: DataFrame, keys: list[str], value: str,
                   alphas: list[float]) -> DataFrame:
    """FC-7 with α chosen per key by the smallest squared one-step error.

    Every α of the grid is evaluated inside the key's row (``transform`` over
    the α array, one fold each) -- no join with the grid.
    """
    agg = _ordered_values(series, keys, value)
    grid = F.array(*[F.lit(float(a)) for a in alphas])

    def sse(a):
        init = F.struct(F.element_at("_ys", 1).alias("l"), F.lit(0.0).alias("e"))
        fold = F.aggregate(F.slice("_ys", 2, F.size("_ys")), init, lambda acc, y: F.struct(
            (a * y + (1 - a) * acc["l"]).alias("l"),
            (acc["e"] + (y - acc["l"]) * (y - acc["l"])).alias("e")))
        return F.struct(fold["e"].alias("sse"), a.alias("alpha"))

    best = F.array_min(F.transform(grid, sse))
    return agg.select(*keys, best["alpha"].alias("alpha"), best["sse"].alias("sse"))


def holt(series: DataFrame, keys: list[str], value: str, alpha: float, beta: float,
         multiplicative: bool = False) -> DataFrame:
    """FC-8: Holt's linear (additive) or exponential (multiplicative) trend;
    one-step-ahead fitted values, level = y0, trend = y1 - y0 (or y1 / y0)."""
    agg = _ordered_values(series, keys, value)
    a, b = F.lit(float(alpha)), F.lit(float(beta))
    y0, y1 = F.element_at("_ys", 1), F.element_at("_ys", 2)
    # a multiplicative trend needs positive values: a zero level makes the
    # trend (and every later fitted value) null instead of failing
    trend0 = F.try_divide(y1, y0) if multiplicative else (y1 - y0)
    init = F.struct(y0.alias("l"), trend0.alias("b"), F.array().cast("array<double>").alias("f"))

    def step(acc, y):
        fc = acc["l"] * acc["b"] if multiplicative else acc["l"] + acc["b"]
        lvl = a * y + (1 - a) * fc
        tr = (b * F.try_divide(lvl, acc["l"]) + (1 - b) * acc["b"]) if multiplicative else \
            (b * (lvl - acc["l"]) + (1 - b) * acc["b"])
        return F.struct(lvl.alias("l"), tr.alias("b"), F.concat(acc["f"], F.array(fc)).alias("f"))

    fold = F.aggregate(F.slice("_ys", 2, F.size("_ys")), init, step)
    fitted = F.concat(F.array(y0), fold["f"])
    return _explode_fitted(agg, keys, fitted)


def seasonal_decompose(series: DataFrame, keys: list[str], value: str, period: int = 52) -> DataFrame:
    """FC-9 additive: trend = centred MA, seasonal = mean detrended value per
    phase (centred to mean 0), residual = value - trend - seasonal."""
    w = Window.partitionBy(*keys).orderBy("week")
    s = centered_moving_average(series, keys, value, period, name="trend")
    s = s.withColumn("_phase", (F.row_number().over(w) - 1) % period)
    idx = (s.groupBy(*keys, "_phase").agg(F.avg(F.col(value) - F.col("trend")).alias("_raw")))
    idx = idx.withColumn("seasonal", F.col("_raw") - F.avg("_raw").over(Window.partitionBy(*keys)))
    out = s.join(idx.select(*keys, "_phase", "seasonal"), keys + ["_phase"], "left")
    return out.select(*keys, "week", F.col(value), "trend", "seasonal",
                      (F.col(value) - F.col("trend") - F.col("seasonal")).alias("resid"))


def acf(series: DataFrame, keys: list[str], value: str, nlags: int = 20) -> DataFrame:
    """FC-10: autocorrelation r_k = Σ (y_t - ȳ)(y_{t+k} - ȳ) / Σ (y_t - ȳ)², k = 0..nlags."""
    w = Window.partitionBy(*keys).orderBy("week")
    d = series.withColumn("_dev", F.col(value) - F.avg(value).over(Window.partitionBy(*keys)))
    d = d.select(*keys, "_dev", *[F.lag("_dev", k).over(w).alias(f"_l{k}") for k in range(1, nlags + 1)])
    sums = d.groupBy(*keys).agg(F.sum(F.col("_dev") * F.col("_dev")).alias("_c0"),
                                *[F.sum(F.col("_dev") * F.col(f"_l{k}")).alias(f"_c{k}")
                                  for k in range(1, nlags + 1)])
    rows = [F.struct(F.lit(k).alias("lag"),
                     (F.lit(1.0) if k == 0 else F.col(f"_c{k}") / F.col("_c0")).alias("acf"))
            for k in range(nlags + 1)]
    return sums.select(*keys, F.inline(F.array(*rows)))


def pacf(acf_frame: DataFrame, keys: list[str]) -> DataFrame:
    """FC-11: partial autocorrelation by Durbin–Levinson on each key's ACF."""
    schema = T.StructType([acf_frame.schema[k] for k in keys] +
                          [T.StructField("lag", T.IntegerType()), T.StructField("pacf", T.DoubleType())])

    def dl(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("lag")["acf"].to_numpy(dtype=float)
        m = len(r) - 1
        out = [1.0]
        phi = np.zeros(m + 1)
        prev = np.zeros(m + 1)
        for k in range(1, m + 1):
            num = r[k] - np.dot(prev[1:k], r[1:k][::-1])
            den = 1.0 - np.dot(prev[1:k], r[1:k])
            phi_kk = num / den if den != 0 else np.nan
            phi[1:k] = prev[1:k] - phi_kk * prev[1:k][::-1]
            phi[k] = phi_kk
            prev = phi.copy()
            out.append(float(phi_kk))
        res = pd.DataFrame({"lag": np.arange(m + 1, dtype="int32"), "pacf": out})
        for k in keys:
            res.insert(0, k, pdf[k].iloc[0])
        return res[keys + ["lag", "pacf"]]

    return acf_frame.groupBy(*keys).applyInPandas(dl, schema)


def adf_statistic(series: DataFrame, keys: list[str], value: str,
                  max_lag: int | None = None) -> DataFrame:
    """FC-12: unit-root t statistic of ``Δy_t = a + γ y_{t-1} + Σ δ_i Δy_{t-i}``
    with the lag order chosen by AIC (up to 12 (n/100)^¼), plus fixed
    critical values."""
    schema = T.StructType([series.schema[k] for k in keys] + [
        T.StructField("adf", T.DoubleType()), T.StructField("usedlag", T.IntegerType()),
        T.StructField("nobs", T.IntegerType()), T.StructField("crit_1pct", T.DoubleType()),
        T.StructField("crit_5pct", T.DoubleType()), T.StructField("crit_10pct", T.DoubleType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("week")[value].to_numpy(dtype=float)
        n = len(y)
        maxl = max_lag if max_lag is not None else int(np.ceil(12 * (n / 100) ** 0.25))
        maxl = max(0, min(maxl, n // 2 - 2))
        dy = np.diff(y)

        def design(lag, start):
            rows = len(dy) - start
            X = [np.ones(rows), y[start:-1]]
            for i in range(1, lag + 1):
                X.append(dy[start - i:len(dy) - i])
            return np.column_stack(X), dy[start:]

        best = None
        for lag in range(maxl + 1):
            X, t = design(lag, maxl)
            if len(t) <= X.shape[1]:
                continue
            coef, *_ = np.linalg.lstsq(X, t, rcond=None)
            rss = float(np.sum((t - X @ coef) ** 2))
            aic = len(t) * np.log(rss / len(t) + 1e-300) + 2 * X.shape[1]
            if best is None or aic < best[0]:
                best = (aic, lag)
        lag = best[1] if best else 0
        X, t = design(lag, lag)
        stat, nobs = np.nan, len(t)
        if len(t) > X.shape[1]:
            coef, *_ = np.linalg.lstsq(X, t, rcond=None)
            resid = t - X @ coef
            s2 = float(resid @ resid) / (len(t) - X.shape[1])
            cov = s2 * np.linalg.pinv(X.T @ X)
            se = np.sqrt(cov[1, 1])
            stat = float(coef[1] / se) if se > 0 else np.nan
        row = {k: [pdf[k].iloc[0]] for k in keys}
        row.update(adf=[stat], usedlag=[lag], nobs=[nobs], crit_1pct=[ADF_CRITICAL["1%"]],
                   crit_5pct=[ADF_CRITICAL["5%"]], crit_10pct=[ADF_CRITICAL["10%"]])
        return pd.DataFrame(row)

    return series.select(*keys, "week", value).groupBy(*keys).applyInPandas(run, schema)
