"""Global order statistics without a single-task window.

``ordered_prefix`` is a two-level prefix scan.  Rows are range-partitioned on a
total order (the sampled bounds split even a value that a third of all rows
share, because the order ends with a unique key), sorted within their partition
and written once together with partition and place.  Everything else describes
that written frame: one (count, sum) row per partition gives the offsets, the
place gives the row number, and running sums stay within a partition.
No plan detail (such as a reused exchange) decides the result.

Sums are exact: decimals of scale 0 and 38 digits.

``exact_quantiles_multi`` selects ranks by refining histograms over the distinct
values and their counts; nothing is sorted globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions

MONEY_UNITS = 10_000  # decimal(18,4) -> whole number of 1e-4 units
UNITS_TYPE = "decimal(38,0)"
PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in it below
BUCKETS = 4096
FEW = 1000


def to_units(c: Column) -> Column:
    """Money with four decimals -> exact whole number of 1e-4 units."""
    return (c.cast("decimal(34,4)") * MONEY_UNITS).cast(UNITS_TYPE)


def from_units(c: Column) -> Column:
    return (c.cast(UNITS_TYPE) / MONEY_UNITS).cast("decimal(38,4)")


def ordered_prefix(df: DataFrame, order_by: list[Column], value_col: str | None = None,
                   num_partitions: int | None = None, group_col: str | None = None) -> DataFrame:
    """Add ``_rownum`` (1-based position), ``_n`` (row count) and, when
    ``value_col`` (whole numbers; null counts as 0) is given, ``_prefix`` (running sum up to and
    including the row) following ``order_by``.  ``order_by`` must be a total
    order (end it with a unique key).

    With ``group_col`` positions and sums restart for every group value (null is
    one of them); a large group still spans several partitions, a small one
    shares a partition with its neighbours.
    """
    from .cluster import materialise
    order = ([F.col(group_col).asc()] if group_col else []) + list(order_by)
    ranged = df.repartitionByRange(num_partitions or shuffle_partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    saved = materialise(ranged.withColumn("_at", F.monotonically_increasing_id()))
    local = saved.select(*df.columns, F.shiftright("_at", PLACE_BITS).alias("_pid"),
                         (F.col("_at").bitwiseAND((1 << PLACE_BITS) - 1) + 1).alias("_lrn"))
    v = F.coalesce(F.col(value_col).cast(UNITS_TYPE), F.lit(0).cast(UNITS_TYPE)) if value_col is not None else None
    gk = [group_col] if group_col else []
    # one row per partition (and group in it): partitions + groups rows
    per_part = local.groupBy("_pid", *gk).agg(F.count(F.lit(1)).alias("_c"), F.min("_lrn").alias("_from"),
                                              *([F.sum(v).alias("_s")] if v is not None else []))
    base = Window.partitionBy(*gk).orderBy("_pid") if gk else Window.orderBy("_pid")
    before = base.rowsBetween(Window.unboundedPreceding, -1)
    whole = base.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select("_pid", *[F.col(g).alias("_g") for g in gk], "_from",
                              F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_cbefore"), F.sum("_c").over(whole).alias("_n"),
                              *([F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_sbefore")] if v is not None else []))
    if gk:
        out = local.join(offsets, (local["_pid"] == offsets["_pid"]) & local[group_col].eqNullSafe(F.col("_g"))).drop(offsets["_pid"]).drop("_g")
    else:
        out = local.join(F.broadcast(offsets), "_pid")  # one row per partition
    keep = [*df.columns, (F.col("_lrn") - F.col("_from") + 1 + F.col("_cbefore")).alias("_rownum"), "_n"]
    if v is not None:
        upto = Window.partitionBy("_pid", *gk).orderBy("_lrn").rowsBetween(Window.unboundedPreceding, 0)
        keep.append((F.sum(v).over(upto) + F.col("_sbefore")).cast(UNITS_TYPE).alias("_prefix"))
    return out.select(*keep)


# ---------------------------------------------------------------------------
# exact quantiles
# ---------------------------------------------------------------------------

def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """The written ``column, value, n`` of all numbers in ``cols`` (nulls and NaN left out), from one scan."""
    from .cluster import materialise
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), (F.col(c).cast("double") + 0.0).alias("value")) for c in cols])))
    return materialise(stacked.where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def _inside(counts: DataFrame, windows: dict) -> DataFrame:
    """Rows of ``counts`` with every window ``w -> (column, lo, hi)`` (one per wanted rank) that holds them."""
    frame = counts.sparkSession.createDataFrame([(w, c, lo, hi) for w, (c, lo, hi) in windows.items()],
                                                "w int, column string, _lo double, _hi double")
    return counts.join(F.broadcast(frame), "column").where((F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi")))


def _histogram(counts: DataFrame, windows: dict) -> list:
    """Rows ``w, bucket, n, m, lo, hi`` in order: ``n`` rows and ``m`` distinct values of each bucket."""
    v, lo, hi = F.col("value"), F.col("_lo"), F.col("_hi")
    # halves keep the width of any two doubles finite; the place grows with the value
    at = F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * BUCKETS)
    bucket = F.when(hi / 2 == lo / 2, (v > lo).cast("long")).otherwise(F.least(at, F.lit(BUCKETS - 1)))
    return _inside(counts, windows).groupBy("w", bucket.alias("bucket")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("m"), F.min(v).alias("lo"), F.max(v).alias("hi")).orderBy("w", "bucket").collect()


def ranks_of(counts: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """Values at the 0-based ranks of each column of :func:`value_counts`.

    Every round counts a histogram of ``BUCKETS`` equal steps for each window that is still
    open (one job for all) and goes on inside the bucket that holds the rank, from
    its least to its greatest value.  Buckets of at most ``FEW`` distinct values are read at the end.
    """
    finite = F.abs("value") < float("inf")
    ends = {r["column"]: r for r in counts.groupBy("column").agg(
        F.min(F.when(finite, F.col("value"))).alias("lo"), F.max(F.when(finite, F.col("value"))).alias("hi"),
        F.sum(F.when(F.col("value") == float("-inf"), F.col("n")).otherwise(0)).alias("low"),
        F.sum(F.when(finite, F.col("n")).otherwise(0)).alias("mid")).collect()}
    found, names, open_, below = {}, [], {}, {}
    for c, ranks in wanted.items():
        e = ends[c]
        for r in sorted(set(ranks)):
            if not e["low"] <= r < e["low"] + e["mid"]:
                found[c, r] = float("-inf") if r < e["low"] else float("inf")
            else:
                w = len(names)
                names.append((c, r))
                open_[w], below[w] = (c, e["lo"], e["hi"]), int(e["low"])
    few = {}
    while open_:
        rows: dict[int, list] = {}
        for x in _histogram(counts, open_):
            rows.setdefault(x["w"], []).append(x)
        for w, buckets in rows.items():
            c, r = names[w]
            for x in buckets:
                if r < below[w] + x["n"]:
                    break
                below[w] += x["n"]
            open_[w] = (c, x["lo"], x["hi"])
            if x["m"] <= FEW:
                few[w] = open_.pop(w)
    if few:
        for x in _inside(counts, few).select("w", "value", "n").orderBy("w", "value").collect():
            name = names[x["w"]]
            if name not in found:
                below[x["w"]] += x["n"]
                if name[1] < below[x["w"]]:
                    found[name] = x["value"]
    return found


def quantiles_of(counts: DataFrame, probs: list[float]) -> list[tuple[str, float, float]]:
    """``(column, prob, value)``: numpy's linear interpolation between two ranks."""
    sizes = {r["column"]: int(r["n"]) for r in counts.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    at = {(c, p): p * (n - 1) for c, n in sizes.items() for p in probs}
    wanted = {c: [r for p in probs for r in (int(at[c, p]), min(int(at[c, p]) + 1, n - 1))] for c, n in sizes.items()}
    values = ranks_of(counts, wanted)
    out = []
    for (c, p), h in at.items():
        lo, hi = values[c, int(h)], values[c, min(int(h) + 1, sizes[c] - 1)]
        out.append((c, float(p), lo if lo == hi else lo + (hi - lo) * (h - int(h))))
    return out


def exact_quantiles_multi(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles (linear interpolation, numpy's default, nulls ignored)
    of several columns from one scan: rows ``(column, prob, value)``; a column
    without numbers has no row."""
    return df.sparkSession.createDataFrame(quantiles_of(value_counts(df, cols), probs), "column string, prob double, value double")


def exact_quantiles(df: DataFrame, value: str, probs: list[float]) -> DataFrame:
    """Exact quantiles of one column: rows ``(prob, value)``."""
    return exact_quantiles_multi(df, [value], probs).drop("column")
