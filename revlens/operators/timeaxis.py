"""Weekly series for every key at once, and the positional helpers on them.

AGG-14/15, AGG-24, WIN-3..6, WIN-9, DAT-4..6.  A series has one row per
(key, week); its length is bounded by the calendar span, not by the number
of order lines, so per-key windows over series rows are cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as RF


def _sum_expr(c: str, money: bool):
    return RF.money_sum(c) if money else F.sum(c)


def daily_sum(df: DataFrame, keys: list[str], values: list[str], date_col: str = "OrderDate",
              money: tuple = ("NetRevenue",)) -> DataFrame:
    """AGG-14."""
    return (df.where(F.col(date_col).isNotNull())
              .groupBy(*keys, F.to_date(date_col).alias("day"))
              .agg(*[_sum_expr(v, v in money).alias(v) for v in values]))


def weekly_sum(df: DataFrame, keys: list[str], values: list[str], date_col: str = "OrderDate",
               money: tuple = ("NetRevenue",), dense: bool = True) -> DataFrame:
    """AGG-15 + WIN-6: sums per (key, week) with weeks (Mon, Mon] labelled by
    the left Monday; with ``dense`` every week between a key's first and last
    week is present, empty weeks as 0.

    Lines are read once and partial-aggregated to (key, week) before the first
    shuffle; every week then yields itself and the empty weeks up to the key's
    next one, so the spine needs neither a second scan nor a join.
    """
    weekly = (df.where(F.col(date_col).isNotNull())
                .groupBy(*keys, RF.week_start(date_col).alias("week"))
                .agg(*[_sum_expr(v, v in money).alias(v) for v in values]))
    if not dense:
        return weekly
    following = F.lead("week").over(Window.partitionBy(*keys).orderBy("week"))
    up_to = F.coalesce(F.date_sub(following, 7), F.col("week"))
    filled = weekly.withColumn("_weeks", F.sequence("week", up_to, F.expr("interval 7 days")))
    filled = filled.select(*keys, *values, F.posexplode("_weeks").alias("_i", "week"))
    return filled.select(*keys, "week", *[F.when(F.col("_i") == 0, F.coalesce(F.col(v), F.lit(0.0))).otherwise(0.0).alias(v)
                                          for v in values])


def add_position(series: DataFrame, keys: list[str], order: str = "week",
                 name: str = "pos") -> DataFrame:
    """0-based position of each row within its key, plus the key's length ``n``."""
    w = Window.partitionBy(*keys).orderBy(order)
    return (series.withColumn(name, F.row_number().over(w) - 1)
                  .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys))))


def first_n(series: DataFrame, keys: list[str], n: int = 130, order: str = "week") -> DataFrame:
    """WIN-5: the first ``n`` rows of every key."""
    w = Window.partitionBy(*keys).orderBy(order)
    return series.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def train_test_by_position(series: DataFrame, keys: list[str], fraction: float = 0.8,
                           order: str = "week") -> DataFrame:
    """WIN-4: the first ``floor(n * fraction)`` rows of a key are ``train``."""
    s = add_position(series, keys, order)
    return (s.withColumn("split", F.when(F.col("pos") < F.floor(F.col("n") * fraction), "train")
                                   .otherwise("test")))


def lag_frame(series: DataFrame, keys: list[str], value: str, look_back: int = 10,
              order: str = "week", split_col: str | None = None,
              reference_compat: bool = True) -> DataFrame:
    """WIN-3: for each target row the previous ``look_back`` values (oldest first).

    Frames never cross a key (or a split, when ``split_col`` is given).  With
    ``reference_compat`` the last usable target of every segment is dropped,
    which reproduces the n - L - 1 samples of the reference loop.
    """
    part = list(keys) + ([split_col] if split_col else [])
    w = Window.partitionBy(*part).orderBy(order)
    out = (series.withColumn("lags", F.collect_list(value).over(w.rowsBetween(-look_back, -1)))
                 .withColumn("_i", F.row_number().over(w) - 1)
                 .withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy(*part))))
    out = out.where(F.size("lags") == look_back)
    if reference_compat:
        out = out.where(F.col("_i") < F.col("_m") - 1)
    return out.drop("_i", "_m").withColumnRenamed(value, "target")


def last_date(series: DataFrame, keys: list[str], col: str = "week") -> DataFrame:
    """AGG-24."""
    return series.groupBy(*keys).agg(F.max(col).alias("last_week"))


def future_weeks(last: DataFrame, keys: list[str], horizon: int, col: str = "last_week") -> DataFrame:
    """DAT-4/6: the ``horizon`` Mondays after each key's last week, with step index."""
    return last.select(*keys, F.posexplode(F.sequence(
        F.date_add(col, 7), F.date_add(col, 7 * horizon), F.expr("interval 7 days")))
        .alias("step0", "week")).withColumn("step", F.col("step0") + 1).drop("step0")


def date_range_periods(spark: SparkSession, start: str, end: str, periods: int) -> DataFrame:
    """DAT-5: ``periods`` equally spaced instants from ``start`` to ``end`` inclusive."""
    a = F.unix_micros(F.lit(start).cast("timestamp"))
    b = F.unix_micros(F.lit(end).cast("timestamp"))
    step = (b - a) / (periods - 1)
    return spark.range(periods).select(
        F.col("id").alias("i"),
        F.timestamp_micros((a + F.col("id") * step).cast("long")).alias("date"))


def centered_moving_average(series: DataFrame, keys: list[str], value: str, period: int = 52,
                            order: str = "week", name: str = "trend") -> DataFrame:
    """WIN-9: centred moving average; for an even period the mean of the two
    offset windows (a 2 x period MA), null where the window is incomplete."""
    w = Window.partitionBy(*keys).orderBy(order)
    h = period // 2
    # window sums are exact decimals (twelve places), so the mean does not
    # depend on the summation order of the engine
    dec = F.col(value).cast("decimal(38,12)")

    def mean(lo, hi):
        return F.sum(dec).over(w.rowsBetween(lo, hi)).cast("double") / period

    if period % 2:
        cnt = F.count(value).over(w.rowsBetween(-h, h))
        return series.withColumn(name, F.when(cnt == period, mean(-h, h)))
    cnt = F.count(value).over(w.rowsBetween(-h, h))
    return series.withColumn(name, F.when(cnt == period + 1, (mean(-h, h - 1) + mean(-h + 1, h)) / 2))
