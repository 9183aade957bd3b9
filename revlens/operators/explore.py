"""Exploration tables: top-N, value counts, shares, profiles, histograms.

SRT-1..6, AGG-8..13, AGG-17..24, SET-1/3.  Top-N uses ``orderBy().limit()``
(per-partition top-N, then a merge of N rows per partition); nothing here
orders all rows in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as RF
from .cluster import materialise
from .ordered import quantiles_of, value_counts as count_values



SAMPLE_DIGITS = 4
SAMPLE_BUCKET = 100_000


def top_n_by_sum(df: DataFrame, group: str, value: str, n: int = 10,
                 money: bool = True) -> DataFrame:
    """SRT-2: group sum, largest ``n`` (ties by group value)."""
    total = F.sum(RF.money(value)).cast("double") if money else F.sum(value)
    agg = df.where(F.col(group).isNotNull()).groupBy(group).agg(total.alias(value))
    return agg.orderBy(F.col(value).desc(), F.col(group).asc()).limit(n)


def nlargest(df: DataFrame, col: str, n: int = 10, tie: list[str] | None = None) -> DataFrame:
    """SRT-3."""
    return df.orderBy(F.col(col).desc(), *[F.col(t).asc() for t in (tie or [])]).limit(n)


def head(df: DataFrame, n: int = 5) -> DataFrame:
    """SRT-4."""
    return df.limit(n)


def sample_exact_n(df: DataFrame, n: int, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """SRT-5: a repeatable uniform sample of exactly ``min(n, rows)`` rows.

    Rows are ordered by ``md5("<seed>|<key columns>")`` (default: all columns; null is
    an empty text) and the ``n`` smallest kept.  Counts by the digest's first digits find the
    bucket in which the n-th row lies; smaller buckets are taken whole and only that one is
    ranked, refined by more digits until at most ``SAMPLE_BUCKET`` rows are left, so no task merges n rows.  Rows that
    agree in the key are taken in the order of all columns.
    """
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key or df.columns]
    hashed = df.withColumn("_h", F.md5(F.concat_ws("|", F.lit(str(seed)), *text)))
    prefix, below, inside = "", 0, None
    for digits in range(SAMPLE_DIGITS, 33, SAMPLE_DIGITS):
        head_ = F.substring("_h", 1, digits)
        sizes = hashed.where(F.col("_h").startswith(prefix)).groupBy(head_.alias("p")).agg(F.count(F.lit(1)).alias("c")).orderBy("p").collect()
        for r in sizes:  # at most 16 ** SAMPLE_DIGITS
            prefix, inside = r["p"], r["c"]
            if below + inside >= n:
                break
            below += inside
        else:
            return hashed.drop("_h")
        if inside <= SAMPLE_BUCKET:
            break
    whole = hashed.where(F.substring("_h", 1, len(prefix)) < prefix)
    last = hashed.where(F.col("_h").startswith(prefix)).orderBy("_h", *[F.col(f"`{c}`") for c in df.columns]).limit(n - below)
    return whole.unionByName(last).drop("_h")


def argmax_best(scores: DataFrame, param: str, score: str) -> DataFrame:
    """SRT-6: the parameter with the highest score; ties -> smallest parameter."""
    return scores.agg(F.max_by(F.col(param), F.struct(F.col(score), -F.col(param))).alias(param))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """AGG-10: count per value, nulls dropped, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count")))


def value_share_pct(df: DataFrame, col: str) -> DataFrame:
    """AGG-11: value counts as percent of **all** rows (nulls in the denominator)."""
    per_value = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = per_value.agg(F.sum("count").alias("_all"))
    return (RF.attach_row(per_value.where(F.col(col).isNotNull()), total)
            .select(col, "count",
                    (F.col("count") / F.col("_all") * 100).alias("percent"),
                    RF.format_percent(F.col("count") / F.col("_all") * 100, 2).alias("label")))


def top_n_plus_others(df: DataFrame, col: str, n: int = 15, other: str = "Others") -> DataFrame:
    """AGG-12: the ``n`` most frequent values plus one ``Others`` row.

    The top set (n rows) comes from a distributed top-N and is broadcast;
    the remainder is counted against it, so no global ranking runs.
    """
    per_value = materialise(df.groupBy(col).agg(F.count(F.lit(1)).alias("count")))  # one scan of the lines
    total = per_value.agg(F.sum("count").alias("_all"))
    named = per_value.where(F.col(col).isNotNull())
    top = named.orderBy(F.col("count").desc(), F.col(col).asc()).limit(n)
    rest = (named.join(F.broadcast(top.select(col)), col, "left_anti")
                 .agg(F.lit(other).alias(col), F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("count")))
    # the remainder row is always present (0 when every value is in the top n)
    both = top.unionByName(rest)
    return (RF.attach_row(both, total)
                .select(col, "count", (F.col("count") / F.col("_all") * 100).alias("percent")))


def count_distinct(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """AGG-9: distinct count of each column (one row)."""
    f = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(*[f(c).alias(f"distinct_{c}") for c in cols])


def item_features(df: DataFrame, key: str = "ArticleID") -> DataFrame:
    """AGG-8: per article sums of revenue, price and quantity plus row count."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        RF.money_sum("NetRevenue").alias("sumRevenue"),
        RF.money_sum("PricePackagingUnit").alias("sumPrice"),
        F.sum("Quantity").alias("sumQuantity"),
        F.count(F.lit(1)).alias("rowCount"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG-17: count, mean, sample std, min, exact quartiles, max per column.

    The columns are scanned once, into the counts of their distinct values;
    moments and exact quartiles (linear interpolation) come from those.  A column without
    numbers is a row of nulls with count 0; NaN counts as null.
    """
    counts = count_values(df, cols)
    v, n = F.col("value"), F.col("n")
    mean = counts.groupBy("column").agg(F.sum("n").alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean"),
                                        F.min(v).alias("min"), F.max(v).alias("max"))
    spread = (counts.join(F.broadcast(mean.select("column", "mean")), "column")  # one row per column
              .groupBy("column").agg(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))).alias("_ss")))
    quartiles = {}
    for c, p, x in quantiles_of(counts, [0.25, 0.5, 0.75]):
        quartiles.setdefault(c, []).append(x)
    spark = df.sparkSession
    qs = spark.createDataFrame([(c, *quartiles.get(c, [None] * 3)) for c in cols], "column string, q25 double, q50 double, q75 double")
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1)))
    return (qs.join(mean, "column", "left").join(spread, "column", "left")
            .select("column", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "mean", std.alias("std"), "min", "q25", "q50", "q75", "max"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AGG-18: nulls per column as (column, nulls) rows."""
    cols = cols or df.columns
    wide = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"n{i}")
                    for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"n{i}"), F.lit(0)).alias("nulls"))
        for i, c in enumerate(cols)])))


def conditional_mean(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """AGG-19."""
    return df.groupBy(*keys).agg(F.avg(value).alias(f"mean{value}"))


def histogram(df: DataFrame, value: str, bins: int, hue: str | None = None) -> DataFrame:
    """AGG-20: equal-width bins over [min, max] (last bin closed), counted per hue.

    The bounds come from one aggregation (a single row, broadcast).
    """
    v = F.col(value)
    num = v.cast("double") if dict(df.dtypes)[value] not in ("date", "timestamp") else F.unix_date(v).cast("double") if dict(df.dtypes)[value] == "date" else F.unix_seconds(v).cast("double")
    nums = df.select(*([hue] if hue else []), num.alias("_x")).where(F.col("_x").isNotNull())
    bounds = nums.agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    keyed = RF.attach_row(nums, bounds).withColumn("bin", b)
    return keyed.groupBy(*([hue] if hue else []), "bin").agg(
        F.count(F.lit(1)).alias("count"),
        F.min(F.col("_lo") + F.col("bin") * width).alias("bin_start"))


def cluster_size(df: DataFrame, col: str = "cluster") -> DataFrame:
    """AGG-21."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("size"))


def value_range(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG-23."""
    return df.agg(*[a for c in cols for a in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """SET-1: stack by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """SET-3."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def attribute_left_join(features: DataFrame, lines: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """JOIN-7: attach one deterministic row of attributes per key (the smallest
    by the attribute values) to a per-key feature table."""
    first = lines.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min(F.struct(*[F.col(a) for a in attrs])).alias("_a"))
    return features.join(first.select(key, *[F.col(f"_a.{a}").alias(a) for a in attrs]), key, "left")
