"""Error metrics per key and split (EVL-1..3), as aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rmse(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """EVL-1: sqrt(mean((p - a)^2)) over rows where both are present."""
    e = F.col(predicted) - F.col(actual)
    return (df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
              .groupBy(*keys).agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.count(F.lit(1)).alias("n")))


def scaled_errors(df: DataFrame, keys: list[str], actual: str, predicted: str) -> DataFrame:
    """EVL-2: MSE and MAE after min-max scaling fitted on the actual values
    (per key) and applied to both columns; rows with an actual only."""
    rows = df.where(F.col(actual).isNotNull())
    w = Window.partitionBy(*keys)
    lo, hi = F.min(actual).over(w), F.max(actual).over(w)
    rng = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)
    s = rows.select(*keys, ((F.col(actual) - lo) / rng).alias("_a"), ((F.col(predicted) - lo) / rng).alias("_p"))
    s = s.where(F.col("_p").isNotNull())
    e = F.col("_p") - F.col("_a")
    return s.groupBy(*keys).agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"))


def mape_huber(df: DataFrame, keys: list[str], actual: str, predicted: str,
               delta: float = 1.0) -> DataFrame:
    """EVL-3: mean absolute percentage error (actual 0 skipped) and Huber loss."""
    e = F.col(predicted) - F.col(actual)
    huber = F.when(F.abs(e) <= delta, 0.5 * e * e).otherwise(delta * (F.abs(e) - 0.5 * delta))
    ok = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return ok.groupBy(*keys).agg(
        (F.avg(F.when(F.col(actual) != 0, F.abs(e / F.col(actual)))) * 100).alias("mape"),
        F.avg(huber).alias("huber"))
