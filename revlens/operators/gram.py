"""Linear models from sufficient statistics (FC-13, ML-18).

Counts, sums and products of the columns are one aggregation inside the JVM, per
key or fold.  Everything after it works on those few numbers: a model of any penalty is
solved from them, a chronological training set is a prefix sum over folds, and the
error on a later fold follows from that fold's own products.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SWEEPS = 2000


def products(df: DataFrame, by: list[str], features: list[str], label: str) -> DataFrame:
    """``by, n, m`` with ``m`` the upper triangle (by rows) of the products of ``1, features, label``.

    Rows with a null or NaN among them are left out.
    """
    cols = [*features, label]
    rows = df.select(*by, *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"_v{i}") for i, c in enumerate(cols)])
    rows = rows.dropna(subset=[f"_v{i}" for i in range(len(cols))])
    z = [F.lit(1.0), *[F.col(f"_v{i}") for i in range(len(cols))]]
    sums = [F.sum(z[i] * z[j]).alias(f"_s{i}_{j}") for i in range(len(z)) for j in range(i, len(z))]
    names = [f"_s{i}_{j}" for i in range(len(z)) for j in range(i, len(z))]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums).select(*by, "n", F.array(*names).alias("m"))


def matrix(upper: list[float], size: int) -> np.ndarray:
    out = np.zeros((size, size))
    out[np.triu_indices(size)] = upper
    return out + np.triu(out, 1).T


def solve(m: np.ndarray, reg: float, l1: float, intercept: bool) -> np.ndarray:
    """Coefficients ``(intercept, weights)`` of the products ``m`` of ``1, features, label``.

    Minimises ``mean squared error / 2 + reg * (l1 * |w| + (1 - l1) / 2 * |w|^2)`` over
    columns scaled to unit deviation (about zero without an intercept), the weights of constant columns are 0.
    """
    n, p = m[0, 0], len(m) - 2
    mean = m[0, 1:] / n if intercept else np.zeros(p + 1)
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    deviation = np.sqrt(np.maximum(np.diag(cov), 0.0))
    used = np.flatnonzero(deviation[:p] > 1e-12 * np.maximum(1.0, np.abs(mean[:p])))
    w = np.zeros(p)
    if len(used) and deviation[p] > 0:
        d, dy = deviation[used], deviation[p]
        a = cov[np.ix_(used, used)] / np.outer(d, d)
        b = cov[used, p] / (d * dy)
        if reg * l1 == 0:
            u = np.linalg.lstsq(a + reg * np.eye(len(used)), b, rcond=1e-12)[0]
        else:
            u, penalty = np.zeros(len(used)), reg * l1
            for _ in range(SWEEPS):
                before = u.copy()
                for j in range(len(used)):
                    r = b[j] - a[j] @ u + a[j, j] * u[j]
                    u[j] = np.sign(r) * max(abs(r) - penalty, 0.0) / (a[j, j] + reg * (1 - l1))
                if np.abs(u - before).max() < 1e-12:
                    break
        w[used] = u * dy / d
    return np.append(mean[p] - mean[:p] @ w, w) if intercept else np.append(0.0, w)


def squared_error(m: np.ndarray, coef: np.ndarray) -> float:
    """Sum of squared errors of the coefficients over the rows behind the products ``m``."""
    v = np.append(coef, -1.0)
    return max(0.0, float(v @ m @ v))


def walk_forward_grid(samples: DataFrame, features: list[str], label: str, fold_col: str, reg_params: list[float],
                      elastic_net: list[float], intercepts=(True, False)) -> DataFrame:
    """ML-18: ``regParam, elasticNetParam, fitIntercept, rmse, rank``.

    Each fold but the first is predicted by the model of all folds before it; ``rmse`` is the mean over
    those folds.  One scan of the samples, whatever the number of points.  With a
    single fold, or none, there is no score: ``rmse`` is null.
    """
    size = len(features) + 2
    rows = products(samples, [fold_col], features, label).orderBy(fold_col).collect()  # one row per fold
    folds = [matrix(r["m"], size) for r in rows]
    out = []
    for reg in reg_params:
        for l1 in elastic_net:
            for intercept in intercepts:
                errors = []
                for i in range(1, len(folds)):
                    coef = solve(sum(folds[:i]), reg, l1, intercept)
                    errors.append(np.sqrt(squared_error(folds[i], coef) / folds[i][0, 0]))
                out.append((float(reg), float(l1), bool(intercept), float(np.mean(errors)) if errors else None))
    frame = samples.sparkSession.createDataFrame(out, "regParam double, elasticNetParam double, fitIntercept boolean, rmse double")
    return frame.withColumn("rank", F.dense_rank().over(Window.orderBy(F.asc_nulls_last("rmse"))))  # grid-sized
