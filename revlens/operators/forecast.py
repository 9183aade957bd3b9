"""Forecasting every key's weekly series in one job (FC-1..6, FC-13, WIN-8).

Re-aimed from a per-series neural network / state-space solver to models
whose pieces map onto Spark:

* lag samples come from a window (WIN-3), one key per window partition;
* the per-key fit is a small least-squares solve in ``applyInPandas`` --
  a group is one key's *training samples*, bounded by its number of weeks,
  never by the number of order lines;
* in-sample predictions and the recursive h-step forecast are JVM array
  expressions (``zip_with`` / ``aggregate``), evaluated inside Catalyst;
* results are aligned by (key, week), not by positional offsets.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scale, timeaxis

# directions of the scaled columns below this share of the largest one are left out
RCOND = 1e-10


# ---------------------------------------------------------------------------
# fitting
# ---------------------------------------------------------------------------

def _fit_schema(df: DataFrame, keys: list[str]) -> T.StructType:
    fields = [df.schema[k] for k in keys]
    return T.StructType(fields + [T.StructField("weights", T.ArrayType(T.DoubleType())),
                                  T.StructField("bias", T.DoubleType()),
                                  T.StructField("samples", T.LongType())])


def fit_linear(samples: DataFrame, keys: list[str], features: str = "lags",
               target: str = "target", exog: list[str] | None = None) -> DataFrame:
    """Per-key least squares ``target ~ bias + features (+ exog)``.

    Returns one row per key: ``weights`` (features then exog), ``bias`` and the
    sample count.  Keys with no sample get no row.
    """
    exog = exog or []
    cols = keys + [features, target] + exog
    schema = _fit_schema(samples, keys)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        X = np.array(pdf[features].tolist(), dtype=float)
        if exog:
            X = np.hstack([X, pdf[exog].to_numpy(dtype=float)])
        y = pdf[target].to_numpy(dtype=float)
        # centred and scaled columns: levels of millions beside zeros keep their digits
        mid, size = X.mean(axis=0), X.std(axis=0)
        size[size == 0] = 1.0
        w = np.linalg.lstsq((X - mid) / size, y - y.mean(), rcond=RCOND)[0] / size
        row = {k: [pdf[k].iloc[0]] for k in keys}
        row.update(weights=[w.tolist()], bias=[float(y.mean() - mid @ w)], samples=[len(y)])
        return pd.DataFrame(row)

    return samples.select(*cols).groupBy(*keys).applyInPandas(solve, schema)


def dot(lags, weights, bias) -> F.Column:
    """bias + Σ lags_i * weights_i, as a JVM array expression."""
    prods = F.zip_with(lags, weights, lambda x, w: x * w)
    return bias + F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def recursive_forecast(last_values, weights, bias, horizon: int) -> F.Column:
    """FC-5: h-step recursion feeding each prediction back (drop oldest, append).

    ``last_values`` holds the final L observations, oldest first.
    """
    init = F.struct(last_values.alias("s"), F.array().cast("array<double>").alias("o"))

    def step(acc, _):
        nxt = dot(acc["s"], weights, bias)
        state = F.concat(F.slice(acc["s"], 2, F.size(acc["s"])), F.array(nxt))
        return F.struct(state.alias("s"), F.concat(acc["o"], F.array(nxt)).alias("o"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), init, step)["o"]


# ---------------------------------------------------------------------------
# lag model (the LSTM path, re-aimed)
# ---------------------------------------------------------------------------

def lag_model_forecast(series: DataFrame, keys: list[str], value: str, look_back: int = 10,
                       train_fraction: float = 0.8, horizon: int = 52,
                       max_weeks: int | None = None, reference_compat: bool = True,
                       value_name: str | None = None) -> DataFrame:
    """FC-3/4/5: min-max scale per key, chronological split, L lags, per-key
    linear fit, train/test predictions and an h-week recursive forecast.

    Output (FC-4), one row per key and week over history + horizon:
    ``keys, Date, <value_name>, Train, Test, Predict`` where future rows carry
    the forecast in both the value and ``Predict`` columns.
    """
    value_name = value_name or value
    s = series.select(*keys, "week", F.col(value).cast("double").alias("_y"))
    if max_weeks:
        s = timeaxis.first_n(s, keys, max_weeks)
    s = scale.minmax_scale(s, keys, "_y", "_ys")
    s = timeaxis.train_test_by_position(s, keys, train_fraction)
    samples = timeaxis.lag_frame(s.select(*keys, "week", "_ys", "split", "_min", "_max"), keys, "_ys",
                                 look_back, split_col="split", reference_compat=reference_compat)
    model = fit_linear(samples.where(F.col("split") == "train"), keys)

    pred = (samples.join(model, keys)
                   .withColumn("_p", scale.minmax_inverse(dot(F.col("lags"), F.col("weights"), F.col("bias")))))
    pred = pred.select(*keys, "week",
                       F.when(F.col("split") == "train", F.col("_p")).alias("Train"),
                       F.when(F.col("split") == "test", F.col("_p")).alias("Test"))

    # last L scaled values per key (a key's series is bounded by its weeks)
    tail = (s.groupBy(*keys)
             .agg(F.sort_array(F.collect_list(F.struct("week", "_ys"))).alias("_h"),
                  F.max("week").alias("_last"), F.first("_min").alias("_min"), F.first("_max").alias("_max")))
    tail = tail.withColumn("_lastL", F.transform(F.slice("_h", -look_back, look_back), lambda x: x["_ys"]))
    fut = (tail.where(F.size("_h") >= look_back).join(model, keys)
               .select(*keys, "_last", "_min", "_max",
                       F.posexplode(recursive_forecast(F.col("_lastL"), F.col("weights"),
                                                       F.col("bias"), horizon)).alias("_i", "_f")))
    fut = fut.select(*keys, F.date_add("_last", (F.col("_i") + 1) * 7).alias("Date"),
                     scale.minmax_inverse(F.col("_f")).alias("Predict"))

    hist = (s.select(*keys, F.col("week").alias("Date"), "_y")
             .join(pred.withColumnRenamed("week", "Date"), keys + ["Date"], "left"))
    hist = hist.select(*keys, "Date", F.col("_y").alias(value_name), "Train", "Test",
                       F.lit(None).cast("double").alias("Predict"))
    future = fut.select(*keys, "Date", F.col("Predict").alias(value_name),
                        F.lit(None).cast("double").alias("Train"), F.lit(None).cast("double").alias("Test"),
                        "Predict")
    return hist.unionByName(future)


# ---------------------------------------------------------------------------
# differenced autoregression (ARIMA without moving-average terms)
# ---------------------------------------------------------------------------

def differenced_ar_forecast(series: DataFrame, keys: list[str], value: str, p: int = 5,
                            d: int = 2, horizon: int = 52, value_name: str | None = None, q: int = 0) -> DataFrame:
    """FC-6 of order ``(p, d, q)``; see :mod:`arma`."""
    from .arma import arima_forecast
    return arima_forecast(series, keys, value, (p, d, q), horizon, value_name)


def exog_regression(series: DataFrame, keys: list[str], value: str, exog: list[str],
                    p: int = 1) -> DataFrame:
    """FC-13: ``value ~ own p lags + exogenous columns`` per key; fitted values."""
    w = Window.partitionBy(*keys).orderBy("week")
    s = series.withColumn("lags", F.collect_list(F.col(value).cast("double")).over(w.rowsBetween(-p, -1)))
    samples = s.where(F.size("lags") == p)
    model = fit_linear(samples.select(*keys, "lags", F.col(value).cast("double").alias("target"), *exog),
                       keys, exog=exog)
    out = samples.join(model, keys)
    feats = F.concat(F.col("lags"), F.array(*[F.col(e).cast("double") for e in exog]))
    return out.select(*keys, "week", F.col(value).alias(value),
                      dot(feats, F.col("weights"), F.col("bias")).alias("fitted"))
