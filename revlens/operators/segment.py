"""Revenue shares, Pareto cut-offs and recency/frequency/value features.

AGG-1..7, WIN-1/2, JOIN-5/6, JOB-2 building blocks.  Money is summed as
``decimal(18,4)`` (exact, so results do not depend on partitioning or on the
engine); ratios are computed from those exact sums with the same double
operations in every engine, so they are not rounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as RF
from .cluster import materialise
from .ordered import from_units, ordered_prefix, to_units



def global_total(df: DataFrame, value: str, alias: str = "total") -> DataFrame:
    """AGG-1: one-row frame with the exact grand total of a money column."""
    return df.agg(F.sum(RF.money(value)).alias(alias))


def sum_by_key(df: DataFrame, keys: list[str], value: str, alias: str | None = None) -> DataFrame:
    """AGG-2: exact money sum per key (partial aggregation before the shuffle).

    Null keys are dropped, as a pandas group-by does.
    """
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return (df.where(cond).groupBy(*keys)
              .agg(F.sum(RF.money(value)).alias(alias or value)))


def revenue_shares(df: DataFrame, keys: list[str], value: str = "NetRevenue",
                   share_name: str = "shareOfRevenue",
                   cumulative_name: str = "cumulatedShare",
                   keep_count: bool = False, keep_total: bool = False) -> DataFrame:
    """AGG-3 + WIN-1: per-key sum, share of the total in percent and the
    running share in descending share order (ties broken by key).

    Output: keys, ``value`` (double), share, cumulative share, ``rank`` (1-based)
    and, with ``keep_count``, ``n_keys``, with ``keep_total`` the grand ``total``.  The running sum is a distributed
    ordered prefix, not a global window.
    """
    # one pass over the lines: the null-key group only feeds the total, as the
    # reference's denominator is the sum over all rows; written once for both
    per_key_all = materialise(df.groupBy(*keys).agg(F.sum(RF.money(value)).alias("_dec")))
    total = per_key_all.agg(F.sum("_dec").alias("_total"))
    per_key = per_key_all.where(_not_null(keys)).withColumn("_units", to_units(F.col("_dec")))
    order = [F.col("_units").desc()] + [F.col(k).asc() for k in keys]
    ranked = ordered_prefix(per_key, order, value_col="_units")
    out = RF.attach_row(ranked, total)  # one row
    tot = F.col("_total").cast("double")
    return out.select(
        *keys,
        F.col("_dec").cast("double").alias(value),
        (F.col("_dec").cast("double") / tot * 100).alias(share_name),
        (from_units(F.col("_prefix")).cast("double") / tot * 100).alias(cumulative_name),
        F.col("_rownum").alias("rank"),
        *([F.col("_n").alias("n_keys")] if keep_count else []),
        *([F.col("_total").alias("total")] if keep_total else []),
    )


def top_fraction_keys(shares: DataFrame, keys: list[str], fraction: float = 0.25) -> DataFrame:
    """WIN-2: the first ``floor(n * fraction)`` keys of a ranked share table.

    ``shares`` is the output of :func:`revenue_shares` with ``keep_count``;
    ``n_keys`` comes from the same ordered prefix, so no count job runs.
    """
    return (shares.where(F.col("rank") <= F.floor(F.col("n_keys") * F.lit(fraction)))
                  .drop("n_keys"))


def top_customers(orders: DataFrame, fraction: float = 0.25, key: str = "CustomerID",
                  value: str = "NetRevenue") -> DataFrame:
    """JOB-2: the order lines of the top ``fraction`` of customers by revenue.

    Shares -> ordered prefix -> cut -> left-semi join back to the lines.  The
    semi join is a sort-merge join unless AQE measures the key set as small;
    a customer with a third of all lines is split by AQE's skew handling.
    """
    shares = revenue_shares(orders, [key], value, keep_count=True)
    keys = top_fraction_keys(shares, [key], fraction).select(key)
    return orders.join(keys, key, "left_semi")


def rfm_features(orders: DataFrame, reference_date: str, key: str | list[str] = "CustomerID",
                 frequency: str = "distinct", value: str = "NetRevenue",
                 order_col: str = "OrderNumber", date_col: str = "OrderDate",
                 recency_name: str = "daysSinceLastOrder",
                 frequency_name: str = "orderCount",
                 value_name: str = "sumRevenue") -> DataFrame:
    """AGG-4/5/6/7 (JOIN-6 folded in): one aggregation per key.

    ``frequency``: ``"distinct"`` distinct orders (AGG-4), ``"rows"`` all rows
    (AGG-5), ``"lines"`` rows with a non-null order number (AGG-6/7).  Recency
    is days from the last order to ``reference_date``.  Null keys are dropped.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if frequency == "distinct":
        freq = F.countDistinct(order_col)
    elif frequency == "rows":
        freq = F.count(F.lit(1))
    elif frequency == "lines":
        freq = F.count(order_col)
    else:
        raise ValueError(frequency)
    return (orders.where(_not_null(keys)).groupBy(*keys).agg(
        RF.days_since(reference_date, F.max(date_col)).alias(recency_name),
        freq.alias(frequency_name),
        RF.money_sum(value).alias(value_name),
    ))


def top_fraction_rfm(orders: DataFrame, reference_date: str, fraction: float = 0.25,
                     key: str = "CustomerID", value: str = "NetRevenue") -> DataFrame:
    """JOB-2 + AGG-4 in one pass: RFM features of the top ``fraction`` of keys
    by revenue.

    RFM features are per-key aggregates, so the features of the top keys'
    lines equal the top rows of the features of all lines: the lines are
    scanned and aggregated once, then only the per-key table is ranked.
    """
    feats = (orders.where(F.col(key).isNotNull()).groupBy(key).agg(
        RF.days_since(reference_date, F.max("OrderDate")).alias("daysSinceLastOrder"),
        F.countDistinct("OrderNumber").alias("orderCount"),
        F.sum(RF.money(value)).alias("_dec")))
    feats = feats.withColumn("_units", to_units(F.col("_dec")))
    ranked = ordered_prefix(feats, [F.col("_units").desc(), F.col(key).asc()])
    top = ranked.where(F.col("_rownum") <= F.floor(F.col("_n") * F.lit(fraction)))
    return top.select(key, "daysSinceLastOrder", "orderCount",
                      F.col("_dec").cast("double").alias("sumRevenue"))


def rfc_features(items: DataFrame, reference_date: str,
                 keys=("ProductSubgroup", "DistributionCenter")) -> DataFrame:
    """AGG-6: recency, non-null line count and quantity sum per item key."""
    keys = list(keys)
    return (items.where(_not_null(keys)).groupBy(*keys).agg(
        RF.days_since(reference_date, F.max("OrderDate")).alias("daysSinceLastOrder"),
        F.count("OrderNumber").alias("orderCount"),
        F.sum("Quantity").alias("sumQuantity"),
    ))


def _not_null(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond
