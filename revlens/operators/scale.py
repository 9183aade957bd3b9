"""Feature scalers (ML-1..4) as column arithmetic over a one-row parameter frame.

Parameters are computed by aggregations (exact quantiles through a
distributed sort), attached as a single broadcast row, and applied as
plain projections -- the scaled frame keeps every other column (keys).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as RF
from .ordered import exact_quantiles_multi


def robust_params(df: DataFrame, cols: list[str], q_low: float = 0.15,
                  q_high: float = 0.85) -> DataFrame:
    """One row: ``<c>_median`` and ``<c>_scale`` = q_high - q_low (1 when 0);
    the quantiles of all columns come from one distributed sort."""
    q = exact_quantiles_multi(df, cols, [q_low, 0.5, q_high])
    aggs = []
    for c in cols:
        at = lambda p: F.max(F.when((F.col("column") == c) & (F.col("prob") == p), F.col("value")))
        iqr = at(q_high) - at(q_low)
        aggs += [at(0.5).alias(f"{c}_median"),
                 F.when(iqr == 0, F.lit(1.0)).otherwise(iqr).alias(f"{c}_scale")]
    return q.agg(*aggs)


def robust_scale(df: DataFrame, cols: list[str], q_low: float = 0.15, q_high: float = 0.85,
                 params: DataFrame | None = None) -> DataFrame:
    """ML-1: (x - median) / (q_high - q_low), exact linear-interpolated quantiles;
    a zero range divides by 1."""
    params = params if params is not None else robust_params(df, cols, q_low, q_high)
    out = RF.attach_row(df, params)
    out = out.withColumns({c: (F.col(c) - F.col(f"{c}_median")) / F.col(f"{c}_scale") for c in cols})
    return out.drop(*[f"{c}_{s}" for c in cols for s in ("median", "scale")])


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """ML-2: (x - mean) / population std (std 0 -> 1)."""
    params = df.agg(*[a for c in cols for a in (F.avg(c).alias(f"{c}_mu"),
                                                 F.stddev_pop(c).alias(f"{c}_sd"))])
    out = RF.attach_row(df, params)
    out = out.withColumns({c: (F.col(c) - F.col(f"{c}_mu")) /
                           F.when(F.col(f"{c}_sd") == 0, F.lit(1.0)).otherwise(F.col(f"{c}_sd"))
                           for c in cols})
    return out.drop(*[f"{c}_{s}" for c in cols for s in ("mu", "sd")])


def maxabs_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """ML-4: x / max(|x|) (max 0 -> 1)."""
    params = df.agg(*[F.max(F.abs(c)).alias(f"{c}_ma") for c in cols])
    out = RF.attach_row(df, params)
    out = out.withColumns({c: F.col(c) / F.when(F.col(f"{c}_ma") == 0, F.lit(1.0))
                           .otherwise(F.col(f"{c}_ma")) for c in cols})
    return out.drop(*[f"{c}_ma" for c in cols])


def minmax_scale(series: DataFrame, keys: list[str], value: str, name: str = "scaled") -> DataFrame:
    """ML-3 per key: (x - min) / (max - min) to [0, 1]; keeps ``_min``/``_max``
    for :func:`minmax_inverse`.  A constant series scales to 0."""
    w = Window.partitionBy(*keys)
    out = series.withColumn("_min", F.min(value).over(w)).withColumn("_max", F.max(value).over(w))
    rng = F.col("_max") - F.col("_min")
    return out.withColumn(name, F.when(rng == 0, F.lit(0.0)).otherwise((F.col(value) - F.col("_min")) / rng))


def minmax_inverse(c, lo: str = "_min", hi: str = "_max"):
    """Inverse of :func:`minmax_scale` for a scaled column expression."""
    c = F.col(c) if isinstance(c, str) else c
    return c * (F.col(hi) - F.col(lo)) + F.col(lo)
