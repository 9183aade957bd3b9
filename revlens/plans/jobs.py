"""Composite user-level jobs (JOB-1..9).

Each job is a lazy composition of operators; the only driver-side loops are
the k-selection of k-means (a few candidate k values), the slices of many lines in
``prepare_sales`` and file listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as RF
from ..operators import arma, clean, cluster, explore, forecast, geo, scale, segment, slices, timeaxis

CUSTOMER_KS = list(range(3, 11))
ITEM_KS = list(range(3, 15))
ARIMA_ORDER = (5, 2, 5)
RFM_COLS = ["daysSinceLastOrder", "orderCount", "sumRevenue"]
RFC_COLS = ["daysSinceLastOrder", "orderCount", "sumQuantity"]


def prepare_sales(invoices: DataFrame, customers: DataFrame, postal_ref: DataFrame,
                  stage_dir: str | None = None) -> DataFrame:
    """JOB-1: raw invoices + customer master + postal reference -> canonical sales.

    JOIN-1 -> PRJ-2 -> FLT-1/2 -> DAT-1 -> PRJ-12/14 -> FLT-3 -> JOIN-2 ->
    STR-3 -> JOIN-3/4 -> AGG-16 -> STR-2 -> PRJ-8.  With ``stage_dir`` the
    cleaned frame is written once as a stage (cuts lineage; survives lost
    executors) before the repair steps read it.

    Places are repaired once per customer, not per line: all lines of a customer meet the
    same places, and those come first in the tie order, so the best place of the customer
    is that of its lines.  Lines are de-duplicated on their own columns and joined to it,
    in slices of the order number where they are many.
    """
    inv = clean.select_columns(invoices, clean.INVOICE_COLUMNS).withColumn(
        "Kunde_Verkauf_SK", F.col("Kunde_Verkauf_SK").cast("string"))
    cust = (clean.select_columns(customers, clean.CUSTOMER_COLUMNS)
                 .withColumnRenamed("Kunde_SK", "Kunde_Verkauf_SK"))
    if stage_dir:
        merged = inv.join(cust, "Kunde_Verkauf_SK", "inner")
        df = clean.initial_cleaning(merged)
        path = f"{stage_dir.rstrip('/')}/initial_cleaned"
        df.write.mode("overwrite").parquet(path)
        inv, number = df.sparkSession.read.parquet(path), "OrderNumber"
    else:
        number = "Belegnummer"
    places = customer_places(clean.clean_places(clean.rename_columns(cust, clean.RAW_TO_CANONICAL)),
                             geo.postal_reference(postal_ref))

    n = slices.slice_count(inv)
    if n > 1:
        places = slices.written(places, slices.new_path(inv.sparkSession, "places"))
    order = [c for c in PREPARE_TIE_ORDER if c in LINE_COLUMNS]

    def finished(part: DataFrame) -> DataFrame:
        # cleaned here, so that dates are parsed for the slice's orders alone
        lines = part if stage_dir else clean.clean_lines(clean.rename_columns(part, clean.RAW_TO_CANONICAL))
        deduped = clean.dedupe_first(lines.select(*LINE_COLUMNS), clean.DEDUPE_KEYS, order)
        return deduped.join(places, "CustomerID", "inner").select(*CANONICAL_ORDER)

    return slices.in_slices(inv, number, n, finished, "sales")


def customer_places(cust: DataFrame, ref: DataFrame) -> DataFrame:
    """One row per customer of the cleaned master: the repaired place (JOIN-2, STR-3, JOIN-3/4, STR-2, PRJ-8)."""
    blended = geo.postal_left_join(cust, ref)
    blended = clean.fill_from_column(blended, "City_correct", "City_inconsistent")
    best = geo.fuzzy_best_match(blended, ref.withColumnRenamed("PostalCode", "PostalCodeInt"),
                                "PostalCodeInt", "City_inconsistent", "City", "Final_City").drop("score")
    blended = blended.join(best, ["PostalCodeInt", "City_inconsistent"], "left")
    blended = geo.fill_states(blended, ref)
    blended = blended.withColumn("PostalCode", RF.pad_postal("PostalCodeInt"))
    # fan-out rows of one customer: prefer the town that was matched, then by name
    blended = blended.withColumn("_miss", (F.col("City_correct") != F.col("Final_City")).cast("int"))
    order = [c for c in PREPARE_TIE_ORDER if c in blended.columns]
    deduped = clean.dedupe_first(blended, ["CustomerID"], order)
    deduped = deduped.withColumn("Final_City", RF.first_part("Final_City", ","))
    deduped = geo.apply_state_overrides(deduped)
    return (deduped.drop("City_inconsistent", "City_correct", "_miss", "PostalCodeInt")
                   .withColumnRenamed("Final_City", "City"))


# Which of several lines with one dedupe key is kept: the smallest by these
# columns, in this order (nulls first): the matched town first, then by name.
PREPARE_TIE_ORDER = ["_miss", "City_correct", "State", "Final_City", "City_inconsistent", "PostalCodeInt",
                     "PostalCode", "Company", "RevenueType", "PricePackagingUnit", "Quantity", "NetRevenue",
                     "ProductGroup", "ProductSubgroup", "BusinessArea", "Type", "IndustryGroup",
                     "SalesChannelCategory", "SalesChannel", "Season"]

# The columns of a cleaned invoice line, without those of its customer.
LINE_COLUMNS = [clean.RAW_TO_CANONICAL[c] for c in clean.INVOICE_COLUMNS] + ["Season"]

CANONICAL_ORDER = ["OrderNumber", "Company", "ArticleID", "OrderDate", "CustomerID", "RevenueType",
                   "PricePackagingUnit", "Quantity", "NetRevenue", "ProductGroup", "ProductSubgroup",
                   "BusinessArea", "Type", "City", "PostalCode", "IndustryGroup",
                   "SalesChannelCategory", "SalesChannel", "Season", "State"]


def top_customers(df: DataFrame, fraction: float = 0.25) -> DataFrame:
    """JOB-2."""
    return segment.top_customers(df.select("OrderNumber", "OrderDate", "CustomerID", "NetRevenue"), fraction)


def segment_customers(orders: DataFrame, reference_date: str, ks=None, seed: int = 45,
                      with_scores: bool = False, fraction: float | None = 0.25):
    """JOB-2 + JOB-3: RFM of the top ``fraction`` customers (one pass over the
    lines, see :func:`segment.top_fraction_rfm`; ``fraction=None`` when the
    lines are already the top customers') -> robust scale (q15..q85) -> k by
    silhouette -> k-means.

    Returns (CustomerID, cluster) with 1-based ids ordered by descending
    revenue, plus the raw RFM features; with ``with_scores`` also the
    (k, silhouette, inertia) table.
    """
    rfm = (segment.top_fraction_rfm(orders, reference_date, fraction) if fraction
           else segment.rfm_features(orders, reference_date))
    scaled = scale.robust_scale(rfm, RFM_COLS)
    scaled = scaled.select("CustomerID", *[F.col(c).alias(f"{c}_s") for c in RFM_COLS])
    assigned, scores = cluster.segment(scaled, ["CustomerID"], [f"{c}_s" for c in RFM_COLS],
                                       ks or CUSTOMER_KS, seed, "sumRevenue_s")
    out = assigned.select("CustomerID", "cluster").join(rfm, "CustomerID")
    return (out, scores) if with_scores else out


def item_dataset(df: DataFrame, run_date: str) -> DataFrame:
    """JOB-4: lines with a distribution centre, quantity filled and >= 1, not in
    the future, subgroup known."""
    items = df.select("OrderNumber", "OrderDate", "Quantity", "NetRevenue", "ProductSubgroup", "State")
    items = clean.add_distribution_center(items)
    items = clean.min_quantity(items, 1.0)
    items = clean.not_in_future(items, run_date)
    return items.where(F.col("ProductSubgroup").isNotNull())


def item_shares(items: DataFrame) -> DataFrame:
    """JOB-4 share tables (revenue and quantity, with running shares)."""
    keys = ["ProductSubgroup", "DistributionCenter"]
    rev = segment.revenue_shares(items, keys, "NetRevenue").drop("rank")
    qty = segment.revenue_shares(items, keys, "Quantity", "shareOfQuantity", "cumulatedQuantity").drop("rank")
    return rev.join(qty, keys)


def segment_items(items: DataFrame, reference_date: str, ks=None, seed: int = 1,
                  with_scores: bool = False):
    """JOB-5: RFC per (subgroup, centre) -> robust scale -> k by silhouette -> k-means."""
    keys = ["ProductSubgroup", "DistributionCenter"]
    rfc = segment.rfc_features(items, reference_date, keys)
    scaled = scale.robust_scale(rfc, RFC_COLS)
    scaled = scaled.select(*keys, *[F.col(c).alias(f"{c}_s") for c in RFC_COLS])
    assigned, scores = cluster.segment(scaled, keys, [f"{c}_s" for c in RFC_COLS], ks or ITEM_KS, seed,
                                       "sumQuantity_s")
    out = assigned.select(*keys, F.col("cluster").alias("Cluster_kmeans")).join(rfc, keys)
    return (out, scores) if with_scores else out


def cluster_weekly_series(clusters: DataFrame, orders: DataFrame, max_weeks: int | None = None) -> DataFrame:
    """FC-1 for every cluster at once: semi-join orders to clustered customers,
    weekly revenue per cluster, dense; ``max_weeks`` keeps that many first weeks."""
    tagged = orders.join(clusters.select("CustomerID", "cluster"), "CustomerID", "inner")
    weekly = timeaxis.weekly_sum(tagged, ["cluster"], ["NetRevenue"])
    return timeaxis.first_n(weekly, ["cluster"], max_weeks) if max_weeks else weekly


def center_weekly_series(item_clusters: DataFrame, items: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """FC-2: weekly quantity and revenue of the clustered items, one series per
    (subgroup, centre) or per the given part of it."""
    item = ["ProductSubgroup", "DistributionCenter"]
    lines = items.join(item_clusters.select(*item), item, "left_semi")
    return timeaxis.weekly_sum(lines, keys or item, ["Quantity", "NetRevenue"])


def forecast_customers(df: DataFrame, year: int, reference_date: str, horizon: int = 52,
                       method: str = "lag", ks=None) -> DataFrame:
    """JOB-6: year filter -> top customers -> clusters -> weekly series of all
    years' orders per cluster -> forecast."""
    yr = clean.year_equals(df, year)
    clusters = segment_customers(yr, reference_date, ks)
    series = cluster_weekly_series(clusters, df.select("CustomerID", "OrderDate", "NetRevenue"))
    if method == "lag":
        return forecast.lag_model_forecast(series, ["cluster"], "NetRevenue", horizon=horizon,
                                           value_name="Revenue")
    return _arima(series, ["cluster"], "NetRevenue", method, horizon)


def _arima(series: DataFrame, keys: list[str], value: str, method: str, horizon: int) -> DataFrame:
    if method != "arima":
        raise ValueError(f"unknown method {method!r}: 'lag' or 'arima'")
    return arma.arima_forecast(series, keys, value, ARIMA_ORDER, horizon)


def forecast_items(df: DataFrame, year: int, reference_date: str, horizon: int = 52,
                   ks=None, method: str = "lag", center: str | None = None, subgroup: str | None = None) -> DataFrame:
    """JOB-7: year filter -> item dataset -> item clusters -> weekly quantity
    per (subgroup, centre) -> forecast by ``method`` ('lag' or 'arima').

    With ``center`` the centre's clustered items are one series (of
    ``subgroup`` alone if given); a centre or subgroup without clustered items is
    a ``ValueError``.  Without it every (subgroup, centre) is forecast in one job.
    """
    if center is None and subgroup is not None:
        raise ValueError("a subgroup needs a distribution centre")
    items = item_dataset(clean.year_equals(df, year), reference_date)
    rfc = segment_items(items, reference_date, ks)
    keys = ["ProductSubgroup", "DistributionCenter"]
    if center is not None:
        rfc = rfc.where(F.col("DistributionCenter") == center)
        if subgroup is not None:
            rfc = rfc.where(F.col("ProductSubgroup").cast("string") == str(subgroup))
        if rfc.limit(1).count() == 0:
            raise ValueError(f"no clustered items for centre {center!r}" + ("" if subgroup is None else f" and subgroup {subgroup!r}"))
        keys = keys[1:]
    series = center_weekly_series(rfc, items, keys)
    if method == "lag":
        return forecast.lag_model_forecast(series, keys, "Quantity", horizon=horizon)
    return _arima(series, keys, "Quantity", method, horizon)


def publish_forecasts(spark, lstm_csv_glob: str, items_glob: str, products_glob: str,
                      database: str | None = None) -> dict:
    """JOB-8: forecast file sets -> cleaned frames -> catalog tables; workbooks
    that cannot be read are listed in the table ``predictions_unreadable``."""
    from ..sinks import publish_table
    from ..sources import files
    out = {}
    cust = files.read_forecast_csv_dir(spark, lstm_csv_glob)
    out["predictions_LSTM"] = publish_table(cust, "predictions_LSTM", database)
    general = files.read_forecast_workbooks(spark, items_glob, files.GENERAL_COLUMNS, extract_item_type=False)
    out["predictions_LSTM_Items"] = publish_table(general, "predictions_LSTM_Items", database)
    prod = files.read_forecast_workbooks(spark, products_glob, files.PRODUCT_COLUMNS, extract_item_type=True)
    out["predictions_LSTM_Items_SpecificProducts"] = publish_table(
        prod, "predictions_LSTM_Items_SpecificProducts", database)
    bad = files.unreadable_workbooks(spark, items_glob).unionByName(files.unreadable_workbooks(spark, products_glob))
    out["predictions_unreadable"] = publish_table(bad, "predictions_unreadable", database)
    return out


def run_all(spark, invoices, customers, postal_ref, year: int, reference_date: str,
            stage_dir: str, horizon: int = 52, publish: dict | None = None, database: str | None = None) -> dict:
    """JOB-9: prepare -> both forecasts, each written as a parquet stage and read back -> publish.

    ``publish`` names the forecast file sets (``lstm_csv_glob``, ``items_glob``, ``products_glob``); their
    catalog tables are the result's ``published``.  Without it the last step is left out.
    """
    root = stage_dir.rstrip("/")
    sales = prepare_sales(invoices, customers, postal_ref, stage_dir)
    sales.write.mode("overwrite").parquet(f"{root}/cleaned")
    sales = spark.read.parquet(f"{root}/cleaned")
    res = {}
    for name, frame in (("customers", forecast_customers(sales, year, reference_date, horizon)),
                        ("items", forecast_items(sales, year, reference_date, horizon))):
        frame.write.mode("overwrite").parquet(f"{root}/forecast_{name}")
        res[name] = spark.read.parquet(f"{root}/forecast_{name}")
    if publish is not None:
        res["published"] = publish_forecasts(spark, publish["lstm_csv_glob"], publish["items_glob"], publish["products_glob"], database)
    return res


__all__ = ["prepare_sales", "top_customers", "segment_customers", "item_dataset", "item_shares",
           "segment_items", "cluster_weekly_series", "center_weekly_series", "forecast_customers",
           "forecast_items", "publish_forecasts", "run_all", "explore"]
