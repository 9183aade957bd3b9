"""Registered queries (Spark) and their DuckDB twins (oracle SQL).

Every query reads the driver tables (or frames Spark derives from them)
in full.  Analysis constants for the TPC-H-like data: orders span
1995-01-01 .. 2001-08-01, so the analysis year is 2000 and the reference
date 2001-12-31.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import SALES_SQL, sales
from ..functions import year_range
from ..operators import arma, clean, cluster, density, diagnostics, evaluate, explore, forecast, geo, scale, segment, timeaxis
from ..sources.tables import read_table
from . import jobs
from .. import functions as RF

ANALYSIS_YEAR = 2000
REFERENCE_DATE = "2001-12-31"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def with_sales(body: str) -> str:
    return "WITH " + SALES_SQL.strip() + ",\n" + body.strip()


# ---------------------------------------------------------------------------
# Flagship: top 25 % customers of the analysis year -> RFM features (JOB-2 + AGG-4)
# ---------------------------------------------------------------------------

def _year_sales(spark, sf_dir, cols):
    s = sales(spark, sf_dir, cols)
    return s.where(year_range("OrderDate", ANALYSIS_YEAR))


@register("top_customers_rfm", with_sales(f"""
yr AS (SELECT * FROM sales WHERE OrderDate >= DATE '{ANALYSIS_YEAR}-01-01'
                             AND OrderDate < DATE '{ANALYSIS_YEAR + 1}-01-01'),
per_cust AS (SELECT CustomerID, sum(CAST(NetRevenue AS DECIMAL(18,4))) AS rev
             FROM yr WHERE CustomerID IS NOT NULL GROUP BY CustomerID),
ranked AS (SELECT CustomerID, row_number() OVER (ORDER BY rev DESC, CustomerID) AS rn,
                  count(*) OVER () AS n FROM per_cust),
top AS (SELECT CustomerID FROM ranked WHERE rn <= floor(n * 0.25))
SELECT CustomerID,
       datediff('day', max(OrderDate), DATE '{REFERENCE_DATE}') AS daysSinceLastOrder,
       count(DISTINCT OrderNumber) AS orderCount,
       CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS sumRevenue
FROM yr WHERE CustomerID IN (SELECT CustomerID FROM top)
GROUP BY CustomerID
"""))
def q_top_customers_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _year_sales(spark, sf_dir, ["OrderNumber", "OrderDate", "CustomerID", "NetRevenue"])
    return segment.top_fraction_rfm(orders, REFERENCE_DATE, 0.25)


@register("customer_revenue_shares", with_sales(f"""
per_cust AS (SELECT CustomerID, sum(CAST(NetRevenue AS DECIMAL(18,4))) AS rev
             FROM sales GROUP BY CustomerID),
tot AS (SELECT sum(rev) AS total FROM per_cust),
ranked AS (SELECT CustomerID, rev,
                  row_number() OVER (ORDER BY rev DESC, CustomerID) AS rn,
                  sum(rev) OVER (ORDER BY rev DESC, CustomerID
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
           FROM per_cust WHERE CustomerID IS NOT NULL)
SELECT CustomerID, CAST(rev AS DOUBLE) AS NetRevenue,
       CAST(rev AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS shareOfRevenue,
       CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS cumulatedShare,
       rn AS rank
FROM ranked, tot
"""))
def q_customer_revenue_shares(spark, sf_dir):
    s = sales(spark, sf_dir, ["CustomerID", "NetRevenue"])
    return segment.revenue_shares(s, ["CustomerID"])


# ---------------------------------------------------------------------------
# Cleaning, derived columns, filters, de-duplication
# ---------------------------------------------------------------------------

@register("order_calendar_features", with_sales(f"""
o AS (SELECT DISTINCT OrderNumber, OrderDate FROM sales)
SELECT OrderNumber, OrderDate,
       CASE ((month(OrderDate) % 12 + 2) // 3) % 4 + 1
            WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' WHEN 3 THEN 'Summer' ELSE 'Autumn' END AS Season,
       CASE WHEN month(OrderDate) IN (12, 1, 2) THEN 'Winter'
            WHEN month(OrderDate) IN (3, 4, 5) THEN 'Spring'
            WHEN month(OrderDate) IN (6, 7, 8) THEN 'Summer'
            WHEN month(OrderDate) IN (9, 10, 11) THEN 'Autumn' ELSE 'Unknown' END AS SeasonMeteorological,
       datediff('day', OrderDate, DATE '{REFERENCE_DATE}') AS daysSinceLastOrder
FROM o
"""))
def q_order_calendar_features(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "OrderDate"]).distinct()
    s = clean.add_seasons(s)
    return clean.add_days_since(s, REFERENCE_DATE)


@register("filtered_year_lines", with_sales(f"""
f AS (SELECT * FROM sales
      WHERE OrderDate >= DATE '{ANALYSIS_YEAR}-01-01' AND OrderDate < DATE '{ANALYSIS_YEAR + 1}-01-01'
        AND coalesce(Quantity, 1.0) >= 1.0 AND OrderDate <= DATE '{REFERENCE_DATE}'
        AND Quantity <= 45 AND SalesChannel IN ('MACHINERY', 'BUILDING', 'AUTOMOBILE'))
SELECT RevenueType, SalesChannel, count(*) AS lines, sum(Quantity) AS sumQuantity,
       CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS sumRevenue
FROM f GROUP BY RevenueType, SalesChannel
"""))
def q_filtered_year_lines(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderDate", "Quantity", "NetRevenue", "RevenueType", "SalesChannel"])
    s = clean.year_equals(s, ANALYSIS_YEAR)
    s = clean.min_quantity(s, 1.0)
    s = clean.not_in_future(s, REFERENCE_DATE)
    s = clean.range_filter(s, "Quantity", high=45)
    s = clean.in_list(s, "SalesChannel", ["MACHINERY", "BUILDING", "AUTOMOBILE"])
    return s.groupBy("RevenueType", "SalesChannel").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("Quantity").alias("sumQuantity"),
        RF.money_sum("NetRevenue").alias("sumRevenue"))


_DEDUPE_COLS = ["OrderNumber", "ArticleID", "OrderDate", "CustomerID", "Quantity",
                "NetRevenue", "RevenueType", "Type"]


@register("dedupe_lines", with_sales("""
r AS (SELECT OrderNumber, ArticleID, OrderDate, CustomerID, Quantity, NetRevenue, RevenueType, Type,
             row_number() OVER (PARTITION BY OrderNumber, ArticleID, OrderDate, CustomerID
                                ORDER BY Quantity, NetRevenue, RevenueType, Type) AS rn
      FROM sales)
SELECT OrderNumber, ArticleID, OrderDate, CustomerID, Quantity, NetRevenue, RevenueType, Type
FROM r WHERE rn = 1
"""))
def q_dedupe_lines(spark, sf_dir):
    return clean.dedupe_first(sales(spark, sf_dir, _DEDUPE_COLS))


@register("duplicate_lines", with_sales("""
c AS (SELECT OrderNumber, ArticleID FROM sales GROUP BY 1, 2 HAVING count(*) > 1)
SELECT s.OrderNumber, s.ArticleID, s.Quantity, s.NetRevenue, s.RevenueType, s.Type
FROM sales s JOIN c USING (OrderNumber, ArticleID)
"""))
def q_duplicate_lines(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "ArticleID", "Quantity", "NetRevenue", "RevenueType", "Type"])
    return clean.duplicates_keep_all(s, ["OrderNumber", "ArticleID"])


# ---------------------------------------------------------------------------
# Exploration tables
# ---------------------------------------------------------------------------

def _top_sql(group, n):
    return with_sales(f"""
SELECT {group}, CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS NetRevenue
FROM sales WHERE {group} IS NOT NULL GROUP BY {group}
ORDER BY NetRevenue DESC, {group} LIMIT {n}
""")


for _group, _n in [("City", 10), ("CustomerID", 10), ("ProductGroup", 5), ("Season", 4),
                   ("IndustryGroup", 5)]:
    def _mk(group=_group, n=_n):
        def q(spark, sf_dir):
            return explore.top_n_by_sum(sales(spark, sf_dir, [group, "NetRevenue"]), group, "NetRevenue", n)
        return q
    register(f"top{_n}_{_group.lower()}_by_revenue", _top_sql(_group, _n))(_mk())


@register("value_counts_subgroup", with_sales("""
SELECT ProductSubgroup, count(*) AS count FROM sales WHERE ProductSubgroup IS NOT NULL
GROUP BY ProductSubgroup
"""))
def q_value_counts_subgroup(spark, sf_dir):
    return explore.value_counts(sales(spark, sf_dir, ["ProductSubgroup"]), "ProductSubgroup")


@register("value_share_industry", with_sales("""
c AS (SELECT IndustryGroup, count(*) AS count FROM sales GROUP BY IndustryGroup),
t AS (SELECT sum(count) AS total FROM c)
SELECT IndustryGroup, count, count / total * 100 AS percent,
       printf('%.2f%%', count / total * 100) AS label
FROM c, t WHERE IndustryGroup IS NOT NULL
"""))
def q_value_share_industry(spark, sf_dir):
    return explore.value_share_pct(sales(spark, sf_dir, ["IndustryGroup"]), "IndustryGroup")


@register("top15_company_plus_others", with_sales("""
c AS (SELECT Company, count(*) AS count FROM sales GROUP BY Company),
t AS (SELECT sum(count) AS total FROM c),
s AS (SELECT Company, count, count / total * 100 AS percent FROM c, t WHERE Company IS NOT NULL),
top AS (SELECT * FROM s ORDER BY count DESC, Company LIMIT 15)
SELECT * FROM top
UNION ALL
SELECT 'Others', coalesce(sum(count), 0), coalesce(sum(count), 0) / (SELECT total FROM t) * 100 FROM s WHERE Company NOT IN (SELECT Company FROM top)
"""))
def q_top15_company_plus_others(spark, sf_dir):
    return explore.top_n_plus_others(sales(spark, sf_dir, ["Company"]), "Company", 15)


@register("count_distinct_sales", with_sales("""
SELECT count(DISTINCT OrderNumber) AS distinct_OrderNumber, count(DISTINCT ArticleID) AS distinct_ArticleID,
       count(DISTINCT ProductSubgroup) AS distinct_ProductSubgroup FROM sales
"""))
def q_count_distinct_sales(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "ArticleID", "ProductSubgroup"])
    return explore.count_distinct(s, ["OrderNumber", "ArticleID", "ProductSubgroup"])


@register("item_features", with_sales("""
SELECT ArticleID, CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS sumRevenue,
       CAST(sum(CAST(PricePackagingUnit AS DECIMAL(18,4))) AS DOUBLE) AS sumPrice, sum(Quantity) AS sumQuantity, count(*) AS rowCount
FROM sales GROUP BY ArticleID
"""))
def q_item_features(spark, sf_dir):
    s = sales(spark, sf_dir, ["ArticleID", "NetRevenue", "PricePackagingUnit", "Quantity"])
    return explore.item_features(s)


@register("describe_lines", with_sales("""
SELECT * FROM (
  SELECT 'Quantity' AS "column", count(Quantity) AS count, round(avg(Quantity), 4) AS mean,
         round(stddev_samp(Quantity), 4) AS std, CAST(min(Quantity) AS DOUBLE) AS min,
         round(quantile_cont(Quantity, 0.25), 4) AS q25, round(quantile_cont(Quantity, 0.5), 4) AS q50,
         round(quantile_cont(Quantity, 0.75), 4) AS q75, CAST(max(Quantity) AS DOUBLE) AS max FROM sales
  UNION ALL
  SELECT 'NetRevenue', count(NetRevenue), round(avg(NetRevenue), 4), round(stddev_samp(NetRevenue), 4),
         min(NetRevenue), round(quantile_cont(NetRevenue, 0.25), 4), round(quantile_cont(NetRevenue, 0.5), 4),
         round(quantile_cont(NetRevenue, 0.75), 4), max(NetRevenue) FROM sales)
"""))
def q_describe_lines(spark, sf_dir):
    d = explore.describe(sales(spark, sf_dir, ["Quantity", "NetRevenue"]), ["Quantity", "NetRevenue"])
    return d.select("column", "count", *[F.round(c, 4).alias(c) for c in ["mean", "std"]], "min",
                    *[F.round(c, 4).alias(c) for c in ["q25", "q50", "q75"]], "max")


@register("null_counts_sales", with_sales("""
SELECT * FROM (VALUES ('CustomerID', (SELECT count(*) - count(CustomerID) FROM sales)),
                      ('City', (SELECT count(*) - count(City) FROM sales)),
                      ('ProductSubgroup', (SELECT count(*) - count(ProductSubgroup) FROM sales)),
                      ('Quantity', (SELECT count(*) - count(Quantity) FROM sales))) AS t("column", nulls)
"""))
def q_null_counts_sales(spark, sf_dir):
    cols = ["CustomerID", "City", "ProductSubgroup", "Quantity"]
    return explore.null_counts(sales(spark, sf_dir, cols), cols)


@register("mean_quantity_by_type_channel", with_sales("""
SELECT Type, SalesChannel, avg(Quantity) AS meanQuantity FROM sales GROUP BY Type, SalesChannel
"""))
def q_mean_quantity(spark, sf_dir):
    s = sales(spark, sf_dir, ["Type", "SalesChannel", "Quantity"])
    m = explore.conditional_mean(s, ["Type", "SalesChannel"], "Quantity")
    return m


@register("order_date_histogram", with_sales("""
x AS (SELECT SalesChannel, CAST(datediff('day', DATE '1970-01-01', OrderDate) AS DOUBLE) AS x FROM sales),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
k AS (SELECT SalesChannel, CASE WHEN hi = lo THEN 0
                 ELSE CAST(least(floor((x - lo) / ((hi - lo) / 52)), 51) AS INTEGER) END AS bin, lo, hi FROM x, b)
SELECT SalesChannel, bin, count(*) AS count, min(lo + bin * ((hi - lo) / 52)) AS bin_start
FROM k GROUP BY SalesChannel, bin
"""))
def q_order_date_histogram(spark, sf_dir):
    return explore.histogram(sales(spark, sf_dir, ["SalesChannel", "OrderDate"]), "OrderDate", 52, "SalesChannel")


@register("value_range_sales", with_sales("""
SELECT min(Quantity) AS min_Quantity, max(Quantity) AS max_Quantity,
       min(OrderDate) AS min_OrderDate, max(OrderDate) AS max_OrderDate FROM sales
"""))
def q_value_range(spark, sf_dir):
    return explore.value_range(sales(spark, sf_dir, ["Quantity", "OrderDate"]), ["Quantity", "OrderDate"])


@register("distinct_subgroups", with_sales("""
SELECT DISTINCT ProductSubgroup FROM sales WHERE ProductSubgroup IS NOT NULL
"""))
def q_distinct_subgroups(spark, sf_dir):
    return explore.distinct_values(sales(spark, sf_dir, ["ProductSubgroup"]), "ProductSubgroup")


# ---------------------------------------------------------------------------
# Time axis
# ---------------------------------------------------------------------------

_WEEK = "CAST(date_trunc('week', OrderDate - INTERVAL 1 DAY) AS DATE)"


def _weekly_sql(keys: list[str], where: str = "TRUE") -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"s.{c} = w.{c}" for c in keys)
    return f"""
w AS (SELECT {k}, {_WEEK} AS week, CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS NetRevenue,
             sum(Quantity) AS Quantity
      FROM sales WHERE {where} GROUP BY ALL),
span AS (SELECT {k}, min(week) AS a, max(week) AS b FROM w GROUP BY ALL),
spine AS (SELECT {k}, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS week FROM span),
series AS (SELECT {", ".join("s." + c for c in keys)}, s.week, coalesce(w.NetRevenue, 0.0) AS NetRevenue,
                  coalesce(w.Quantity, 0.0) AS Quantity
           FROM spine s LEFT JOIN w ON {on} AND s.week = w.week)
"""


def _weekly(spark, sf_dir, keys, year=None):
    s = sales(spark, sf_dir, keys + ["OrderDate", "NetRevenue", "Quantity"])
    if year is not None:
        s = clean.year_equals(s, year)
    return timeaxis.weekly_sum(s, keys, ["NetRevenue", "Quantity"])


@register("weekly_revenue_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
SELECT * FROM series"""))
def q_weekly_revenue_by_center(spark, sf_dir):
    return _weekly(spark, sf_dir, ["DistributionCenter"])


_YEAR_WHERE = f"OrderDate >= DATE '{ANALYSIS_YEAR}-01-01' AND OrderDate < DATE '{ANALYSIS_YEAR + 1}-01-01'"


@register("weekly_quantity_by_subgroup_center", with_sales(
    _weekly_sql(["ProductSubgroup", "DistributionCenter"], _YEAR_WHERE) + "SELECT * FROM series"))
def q_weekly_subgroup_center(spark, sf_dir):
    return _weekly(spark, sf_dir, ["ProductSubgroup", "DistributionCenter"], ANALYSIS_YEAR)


@register("daily_revenue", with_sales("""
SELECT OrderDate AS day, CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS NetRevenue
FROM sales GROUP BY OrderDate
"""))
def q_daily_revenue(spark, sf_dir):
    return timeaxis.daily_sum(sales(spark, sf_dir, ["OrderDate", "NetRevenue"]), [], ["NetRevenue"])


@register("first_130_weeks_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
SELECT DistributionCenter, week, NetRevenue FROM (
  SELECT *, row_number() OVER (PARTITION BY DistributionCenter ORDER BY week) AS rn FROM series) WHERE rn <= 130
"""))
def q_first_130_weeks(spark, sf_dir):
    return timeaxis.first_n(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], 130) \
        .select("DistributionCenter", "week", "NetRevenue")


_LAG_COLS = ", ".join(f"lag(NetRevenue, {k}) OVER w AS lag_{k}" for k in range(1, 11))


@register("lag_features_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + f"""
, l AS (SELECT DistributionCenter, week, NetRevenue AS target, {_LAG_COLS},
              row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY DistributionCenter) AS m
       FROM series WINDOW w AS (PARTITION BY DistributionCenter ORDER BY week))
SELECT DistributionCenter, week, target, {", ".join(f"lag_{k}" for k in range(1, 11))}
FROM l WHERE i >= 10 AND i < m - 1
"""))
def q_lag_features(spark, sf_dir):
    lf = timeaxis.lag_frame(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                            "NetRevenue", 10)
    return lf.select("DistributionCenter", "week", "target",
                     *[F.element_at("lags", 11 - k).alias(f"lag_{k}") for k in range(1, 11)])


@register("train_test_split_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
SELECT DistributionCenter, week, NetRevenue,
       CASE WHEN row_number() OVER w - 1 < floor(count(*) OVER (PARTITION BY DistributionCenter) * 0.8)
            THEN 'train' ELSE 'test' END AS split
FROM series WINDOW w AS (PARTITION BY DistributionCenter ORDER BY week)
"""))
def q_train_test_split(spark, sf_dir):
    t = timeaxis.train_test_by_position(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], 0.8)
    return t.select("DistributionCenter", "week", "NetRevenue", "split")


@register("last_week_by_subgroup", with_sales(f"""
SELECT ProductSubgroup, max({_WEEK}) AS last_week FROM sales GROUP BY ProductSubgroup
"""))
def q_last_week(spark, sf_dir):
    s = sales(spark, sf_dir, ["ProductSubgroup", "OrderDate"]).withColumn("week", RF.week_start("OrderDate"))
    return timeaxis.last_date(s, ["ProductSubgroup"])


@register("future_weeks_by_center", with_sales(f"""
l AS (SELECT DistributionCenter, max({_WEEK}) AS last_week FROM sales GROUP BY DistributionCenter)
SELECT DistributionCenter, CAST(last_week + INTERVAL (7 * s) DAY AS DATE) AS week, s AS step
FROM l, range(1, 53) t(s)
"""))
def q_future_weeks(spark, sf_dir):
    s = sales(spark, sf_dir, ["DistributionCenter", "OrderDate"]).withColumn("week", RF.week_start("OrderDate"))
    return timeaxis.future_weeks(timeaxis.last_date(s, ["DistributionCenter"]), ["DistributionCenter"], 52)


@register("moving_average_52_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
SELECT DistributionCenter, week, NetRevenue,
       CASE WHEN count(NetRevenue) OVER (w ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING) = 53
            THEN (CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) OVER (w ROWS BETWEEN 26 PRECEDING AND 25 FOLLOWING) AS DOUBLE) / 52
                  + CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) OVER (w ROWS BETWEEN 25 PRECEDING AND 26 FOLLOWING) AS DOUBLE) / 52) / 2 END AS trend
FROM series WINDOW w AS (PARTITION BY DistributionCenter ORDER BY week)
"""))
def q_moving_average(spark, sf_dir):
    m = timeaxis.centered_moving_average(_weekly(spark, sf_dir, ["DistributionCenter"]),
                                         ["DistributionCenter"], "NetRevenue", 52)
    return m.select("DistributionCenter", "week", "NetRevenue", "trend")


# ---------------------------------------------------------------------------
# More segment features
# ---------------------------------------------------------------------------

@register("rfm_events_rows", """
SELECT CAST(user_id AS VARCHAR) AS CustomerID,
       datediff('day', max(CAST(ts AS DATE)), DATE '2024-02-01') AS daysSinceLastOrder,
       count(*) AS orderCount, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS sumRevenue
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
""")
def q_rfm_events_rows(spark, sf_dir):
    from ..sources.tables import events_as_sales
    return segment.rfm_features(events_as_sales(spark, sf_dir), "2024-02-01", frequency="rows")


_ITEM_WHERE = (f"OrderDate >= DATE '{ANALYSIS_YEAR}-01-01' AND OrderDate < DATE '{ANALYSIS_YEAR + 1}-01-01' "
               f"AND coalesce(Quantity, 1.0) >= 1.0 AND OrderDate <= DATE '{REFERENCE_DATE}'")


def _item_dataset(spark, sf_dir, extra=("DistributionCenter",)):
    s = sales(spark, sf_dir, ["OrderNumber", "OrderDate", "Quantity", "NetRevenue", "ProductSubgroup", *extra])
    s = clean.year_equals(s, ANALYSIS_YEAR)
    s = clean.min_quantity(s, 1.0)
    return clean.not_in_future(s, REFERENCE_DATE)


@register("item_rfc_features", with_sales(f"""
SELECT ProductSubgroup, DistributionCenter,
       datediff('day', max(OrderDate), DATE '{REFERENCE_DATE}') AS daysSinceLastOrder,
       count(OrderNumber) AS orderCount, sum(coalesce(Quantity, 1.0)) AS sumQuantity
FROM sales WHERE {_ITEM_WHERE} AND ProductSubgroup IS NOT NULL AND DistributionCenter IS NOT NULL
GROUP BY ProductSubgroup, DistributionCenter
"""))
def q_item_rfc_features(spark, sf_dir):
    return segment.rfc_features(_item_dataset(spark, sf_dir), REFERENCE_DATE)


@register("item_rfm_by_state", with_sales(f"""
SELECT ProductSubgroup, State,
       datediff('day', max(OrderDate), DATE '{REFERENCE_DATE}') AS daysSinceLastOrder,
       count(OrderNumber) AS orderCount, CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS sumRevenue
FROM sales WHERE {_ITEM_WHERE} AND ProductSubgroup IS NOT NULL AND State IS NOT NULL
GROUP BY ProductSubgroup, State
"""))
def q_item_rfm_by_state(spark, sf_dir):
    items = _item_dataset(spark, sf_dir, ("State",))
    return segment.rfm_features(items, REFERENCE_DATE, key=["ProductSubgroup", "State"], frequency="lines")


def _shares_sql(keys: list[str], value: str, where: str = "TRUE") -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return with_sales(f"""
per AS (SELECT {k}, sum(CAST({value} AS DECIMAL(18,4))) AS v FROM sales WHERE {where} GROUP BY ALL),
tot AS (SELECT sum(v) AS total FROM per),
ranked AS (SELECT {k}, v, row_number() OVER (ORDER BY v DESC, {k}) AS rn,
                  sum(v) OVER (ORDER BY v DESC, {k} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
           FROM per WHERE {nn})
SELECT {k}, CAST(v AS DOUBLE) AS {value},
       CAST(v AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS shareOfRevenue,
       CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) * 100 AS cumulatedShare, rn AS rank
FROM ranked, tot
""")


_CENTRE_SQL = "CASE " + " ".join(
    f"WHEN State IN ({', '.join(repr(x) for x in states)}) THEN '{centre}'" for centre, states in RF.DISTRIBUTION_CENTRES.items()
) + f" ELSE '{RF.DEFAULT_CENTRE}' END"


@register("weekly_quantity_by_distribution_center", with_sales(f"""
c AS (SELECT {_CENTRE_SQL} AS center, {_WEEK} AS week, Quantity FROM sales),
w AS (SELECT center, week, sum(Quantity) AS Quantity FROM c GROUP BY ALL),
spine AS (SELECT center, CAST(unnest(generate_series(min(week), max(week), INTERVAL 7 DAY)) AS DATE) AS week FROM w GROUP BY center)
SELECT spine.center, spine.week, coalesce(w.Quantity, 0.0) AS Quantity
FROM spine LEFT JOIN w ON spine.center = w.center AND spine.week = w.week
"""))
def q_weekly_by_distribution_center(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderDate", "Quantity", "State"])
    s = clean.add_distribution_center(s).withColumnRenamed("DistributionCenter", "center")
    return timeaxis.weekly_sum(s, ["center"], ["Quantity"])


@register("subgroup_center_revenue_shares",
          _shares_sql(["ProductSubgroup", "DistributionCenter"], "NetRevenue", _ITEM_WHERE))
def q_subgroup_center_revenue_shares(spark, sf_dir):
    return segment.revenue_shares(_item_dataset(spark, sf_dir), ["ProductSubgroup", "DistributionCenter"])


@register("subgroup_center_quantity_shares",
          _shares_sql(["ProductSubgroup", "DistributionCenter"], "Quantity", _ITEM_WHERE))
def q_subgroup_center_quantity_shares(spark, sf_dir):
    return segment.revenue_shares(_item_dataset(spark, sf_dir), ["ProductSubgroup", "DistributionCenter"],
                                  value="Quantity")


@register("customers_for_90pct_revenue", with_sales("""
per AS (SELECT CustomerID, sum(CAST(NetRevenue AS DECIMAL(18,4))) AS v FROM sales GROUP BY CustomerID),
tot AS (SELECT sum(v) AS total FROM per),
r AS (SELECT sum(v) OVER (ORDER BY v DESC, CustomerID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM per WHERE CustomerID IS NOT NULL)
SELECT count(*) AS customers FROM r, tot WHERE CAST(cum AS DOUBLE) / CAST(total AS DOUBLE) * 100 <= 90
"""))
def q_customers_for_90pct(spark, sf_dir):
    sh = segment.revenue_shares(sales(spark, sf_dir, ["CustomerID", "NetRevenue"]), ["CustomerID"])
    return clean.range_filter(sh, "cumulatedShare", high=90).agg(F.count(F.lit(1)).alias("customers"))


@register("top_quarter_revenue_share", with_sales(f"""
yr AS (SELECT * FROM sales WHERE {_YEAR_WHERE}),
per AS (SELECT CustomerID, sum(CAST(NetRevenue AS DECIMAL(18,4))) AS v FROM yr GROUP BY CustomerID),
tot AS (SELECT sum(v) AS total FROM per),
r AS (SELECT v, row_number() OVER (ORDER BY v DESC, CustomerID) AS rn, count(*) OVER () AS n
      FROM per WHERE CustomerID IS NOT NULL)
SELECT CAST(sum(v) AS DOUBLE) / CAST(max(total) AS DOUBLE) * 100 AS topShare, count(*) AS customers
FROM r, tot WHERE rn <= floor(n * 0.25)
"""))
def q_top_quarter_share(spark, sf_dir):
    orders = _year_sales(spark, sf_dir, ["OrderDate", "CustomerID", "NetRevenue"])
    sh = segment.revenue_shares(orders, ["CustomerID"], keep_count=True, keep_total=True)
    top = segment.top_fraction_keys(sh, ["CustomerID"], 0.25)
    return top.agg(F.sum(RF.money("NetRevenue")).alias("_s"), F.max("total").alias("_t"), F.count(F.lit(1)).alias("customers")) \
        .select((F.col("_s").cast("double") / F.col("_t").cast("double") * 100)
                               .alias("topShare"), "customers")


# ---------------------------------------------------------------------------
# Location repair on TPC-H-derived keys
# ---------------------------------------------------------------------------
# A "postal reference" derived from the supplier table: code = s_suppkey,
# town = supplier nation, state = supplier region.  Customer keys are the
# codes to resolve (exact when a supplier has the same key, else nearest
# within 200, else null).

def _supplier_postal_ref(spark, sf_dir):
    su = read_table(spark, sf_dir, "supplier")
    na = read_table(spark, sf_dir, "nation")
    rg = read_table(spark, sf_dir, "region")
    return (su.join(na, su.s_nationkey == na.n_nationkey).join(rg, na.n_regionkey == rg.r_regionkey)
              .select(F.col("n_name").alias("City"), F.col("s_suppkey").cast("int").alias("PostalCode"),
                      F.col("r_name").alias("State")))


_SUPPLIER_REF_SQL = """
ref AS (SELECT n.n_name AS City, CAST(s.s_suppkey AS INTEGER) AS PostalCode, r.r_name AS State
        FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)
"""


@register("nearest_code_state", "WITH " + _SUPPLIER_REF_SQL.strip() + """,
codes AS (SELECT DISTINCT CAST(c_custkey AS INTEGER) AS PostalCodeInt FROM customer),
st AS (SELECT PostalCode AS rc, min(State) AS rs FROM ref WHERE State IS NOT NULL AND PostalCode >= 0 GROUP BY 1),
cand AS (SELECT PostalCodeInt, rs, row_number() OVER (PARTITION BY PostalCodeInt ORDER BY abs(PostalCodeInt - rc), rc) AS rn
         FROM codes JOIN st ON abs(PostalCodeInt - rc) <= 200)
SELECT c.PostalCodeInt, cand.rs AS State FROM codes c LEFT JOIN cand ON c.PostalCodeInt = cand.PostalCodeInt AND cand.rn = 1
""")
def q_nearest_code_state(spark, sf_dir):
    codes = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("PostalCodeInt")).distinct()
    return geo.nearest_state(codes, _supplier_postal_ref(spark, sf_dir))


@register("exact_code_state", "WITH " + _SUPPLIER_REF_SQL.strip() + """,
codes AS (SELECT DISTINCT CAST(c_custkey AS INTEGER) AS PostalCodeInt FROM customer),
st AS (SELECT PostalCode, min(State) AS State FROM ref WHERE State IS NOT NULL GROUP BY 1)
SELECT c.PostalCodeInt, st.State FROM codes c LEFT JOIN st ON c.PostalCodeInt = st.PostalCode
""")
def q_exact_code_state(spark, sf_dir):
    codes = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("PostalCodeInt")).distinct()
    return geo.state_lookup(codes, _supplier_postal_ref(spark, sf_dir))


@register("postal_city_candidates", "WITH " + _SUPPLIER_REF_SQL.strip() + """
SELECT PostalCode AS PostalCodeInt, array_to_string(list_sort(list(DISTINCT City)), '|') AS candidates
FROM ref WHERE City IS NOT NULL GROUP BY PostalCode
""")
def q_postal_city_candidates(spark, sf_dir):
    ref = _supplier_postal_ref(spark, sf_dir).withColumnRenamed("PostalCode", "PostalCodeInt")
    c = geo.collect_candidates(ref, "PostalCodeInt", "City")
    return c.select("PostalCodeInt", F.array_join("candidates", "|").alias("candidates"))


# Part names with their words in reverse order are matched back to the part
# catalogue names of the same product group (candidates bounded by the catalogue).
@register("part_name_fuzzy_match", """
cands AS (SELECT DISTINCT p_type AS ProductGroup, p_name AS cand FROM part WHERE p_name IS NOT NULL),
inputs AS (SELECT DISTINCT p_type AS ProductGroup,
                  array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS name_input
           FROM part WHERE p_name IS NOT NULL),
scored AS (SELECT i.ProductGroup, i.name_input, c.cand,
                  1.0 - levenshtein(lower(i.name_input), lower(c.cand))
                        / greatest(length(lower(i.name_input)), length(lower(c.cand)), 1) AS score
           FROM inputs i JOIN cands c USING (ProductGroup)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY ProductGroup, name_input ORDER BY score DESC, cand) AS rn FROM scored)
SELECT ProductGroup, name_input, cand AS best_match, score FROM ranked WHERE rn = 1
""".replace("cands AS", "WITH cands AS", 1))
def q_part_name_fuzzy_match(spark, sf_dir):
    part = read_table(spark, sf_dir, "part").where(F.col("p_name").isNotNull())
    inputs = part.select(F.col("p_type").alias("ProductGroup"),
                         F.array_join(F.reverse(F.split("p_name", " ")), " ").alias("name_input"))
    cands = part.select(F.col("p_type").alias("ProductGroup"), F.col("p_name").alias("cand"))
    return geo.fuzzy_best_match(inputs, cands, "ProductGroup", "name_input", "cand")


def _tpch_raw(spark, sf_dir):
    """Raw invoice / customer / postal-reference frames derived from the tables."""
    li, od = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "orders")
    pa, cu = read_table(spark, sf_dir, "part"), read_table(spark, sf_dir, "customer")
    na = read_table(spark, sf_dir, "nation")
    # the day is written out once per order, not per line
    od = od.select("o_orderkey", "o_custkey", "o_orderpriority", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("_day"))
    inv = (li.join(od, li.l_orderkey == od.o_orderkey).join(pa, li.l_partkey == pa.p_partkey)
             .select(F.col("o_orderkey").cast("string").alias("Belegnummer"),
                     F.col("l_suppkey").cast("string").alias("Unternehmen"),
                     F.col("l_partkey").alias("Artikel_SK"),
                     F.col("_day").alias("Auftragsdatum_SK"),
                     F.col("o_custkey").alias("Kunde_Verkauf_SK"),
                     F.col("l_returnflag").alias("Umsatztyp"),
                     F.col("p_retailprice").alias("Preis Verpackungseinheit"),
                     F.col("l_quantity").alias("Menge"),
                     (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Nettoumsatz"),
                     F.col("p_type").alias("Productgroup"), F.col("p_brand").alias("Productsubgroup"),
                     F.col("o_orderpriority").alias("Business Area"), F.col("l_linestatus").alias("Type")))
    channel = (F.when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), "B2B")
                .when(F.col("c_mktsegment").isin("AUTOMOBILE", "HOUSEHOLD"), "B2C").otherwise("B2B2C"))
    # bounded stand-in of five digits: c_custkey itself up to 99,999, then from 1 again
    plz = (F.when(F.col("c_custkey") < 100_000, F.col("c_custkey"))
            .otherwise(F.pmod(F.col("c_custkey") - 1, F.lit(99_999)) + 1))
    cust = (cu.join(na, cu.c_nationkey == na.n_nationkey)
              .select(F.col("c_custkey").cast("string").alias("Kunde_SK"),
                      F.lower(F.col("n_name")).alias("Ort"),
                      RF.pad_postal(plz).alias("PLZ-Code"),
                      F.col("c_mktsegment").alias("Branchengruppe"),
                      F.concat(channel, F.lit("_"), F.col("c_mktsegment")).alias("Vertriebskanalkategorie"),
                      F.lit(None).cast("string").alias("Vertriebskanal")))
    ref = _supplier_postal_ref(spark, sf_dir).select(F.col("City").alias("ort"),
                                                     F.col("PostalCode").alias("plz"),
                                                     F.col("State").alias("bundesland"))
    return inv, cust, ref


_PREPARE_SQL = "WITH __REF__,\ninv AS (SELECT CAST(o.o_orderkey AS VARCHAR) AS OrderNumber, CAST(l.l_suppkey AS VARCHAR) AS Company,\n               l.l_partkey AS ArticleID, CAST(strftime(o.o_orderdate, '%Y%m%d') AS INTEGER) AS d_raw,\n               CAST(o.o_custkey AS VARCHAR) AS CustomerID, l.l_returnflag AS RevenueType,\n               p.p_retailprice AS PricePackagingUnit, l.l_quantity AS Quantity,\n               l.l_extendedprice * (1 - l.l_discount) AS NetRevenue, p.p_type AS ProductGroup,\n               p.p_brand AS ProductSubgroup, o.o_orderpriority AS BusinessArea, l.l_linestatus AS Type\n        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey),\ncust AS (SELECT CAST(c.c_custkey AS VARCHAR) AS CustomerID, lower(n.n_name) AS City_inconsistent,\n                lpad(CAST(c.c_custkey AS VARCHAR), CAST(greatest(5, length(CAST(c.c_custkey AS VARCHAR))) AS INTEGER), '0') AS PostalCode, c.c_mktsegment AS IndustryGroup,\n                CASE WHEN c.c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'B2B'\n                     WHEN c.c_mktsegment IN ('AUTOMOBILE', 'HOUSEHOLD') THEN 'B2C' ELSE 'B2B2C' END\n                  || '_' || c.c_mktsegment AS SalesChannelCategory\n         FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),\nm AS (SELECT i.*, c.City_inconsistent, c.PostalCode, c.IndustryGroup, c.SalesChannelCategory,\n             CAST(try_strptime(CAST(i.d_raw AS VARCHAR), '%Y%m%d') AS DATE) AS OrderDate,\n             split_part(c.SalesChannelCategory, '_', 1) AS SalesChannel\n      FROM inv i JOIN cust c USING (CustomerID)),\ncl AS (SELECT * EXCLUDE (d_raw),\n              CASE ((month(OrderDate) % 12 + 2) // 3) % 4 + 1\n                   WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' WHEN 3 THEN 'Summer' ELSE 'Autumn' END AS Season,\n              CAST(PostalCode AS INTEGER) AS PostalCodeInt\n       FROM m WHERE City_inconsistent IS NOT NULL AND PostalCode IS NOT NULL AND length(PostalCode) = 5\n         AND PostalCode <> '00000' AND regexp_full_match(PostalCode, '[0-9]{5}') AND OrderDate IS NOT NULL\n         AND SalesChannel IN ('B2B', 'B2C', 'B2B2C') AND NetRevenue IS NOT NULL AND NOT isnan(NetRevenue)),\nbl AS (SELECT cl.*, coalesce(r.City, cl.City_inconsistent) AS City_correct, r.State AS State\n       FROM cl LEFT JOIN ref r ON cl.PostalCodeInt = r.PostalCode),\npairs AS (SELECT DISTINCT PostalCodeInt, City_inconsistent FROM bl),\ncands AS (SELECT DISTINCT PostalCode AS PostalCodeInt, City AS cand FROM ref WHERE City IS NOT NULL),\nbest AS (SELECT PostalCodeInt, City_inconsistent, cand AS Final_City FROM (\n           SELECT p.*, c.cand, row_number() OVER (PARTITION BY p.PostalCodeInt, p.City_inconsistent\n             ORDER BY 1.0 - levenshtein(lower(p.City_inconsistent), lower(c.cand))\n                      / greatest(length(lower(p.City_inconsistent)), length(lower(c.cand)), 1) DESC, c.cand) AS rn\n           FROM pairs p JOIN cands c USING (PostalCodeInt)) WHERE rn = 1\n         UNION ALL\n         SELECT PostalCodeInt, City_inconsistent, City_inconsistent FROM pairs\n         WHERE PostalCodeInt NOT IN (SELECT PostalCodeInt FROM cands)),\nst AS (SELECT PostalCode AS rc, min(State) AS rs FROM ref WHERE State IS NOT NULL AND PostalCode >= 0 GROUP BY 1),\nmissing AS (SELECT DISTINCT PostalCodeInt FROM bl WHERE State IS NULL),\nexact AS (SELECT m.PostalCodeInt, st.rs AS fill FROM missing m JOIN st ON m.PostalCodeInt = st.rc),\nnear AS (SELECT PostalCodeInt, rs AS fill FROM (\n           SELECT m.PostalCodeInt, st.rs, row_number() OVER (PARTITION BY m.PostalCodeInt\n                  ORDER BY abs(m.PostalCodeInt - st.rc), st.rc) AS rn\n           FROM missing m JOIN st ON abs(m.PostalCodeInt - st.rc) <= 200\n           WHERE m.PostalCodeInt NOT IN (SELECT PostalCodeInt FROM exact)) WHERE rn = 1),\nfills AS (SELECT * FROM exact UNION ALL SELECT * FROM near),\nfull_ AS (SELECT b.* EXCLUDE (State, PostalCode), coalesce(b.State, f.fill) AS State,\n                 lpad(CAST(b.PostalCodeInt AS VARCHAR), CAST(greatest(5, length(CAST(b.PostalCodeInt AS VARCHAR))) AS INTEGER), '0') AS PostalCode, x.Final_City,\n                 CAST(b.City_correct <> x.Final_City AS INTEGER) AS _miss\n          FROM bl b LEFT JOIN best x USING (PostalCodeInt, City_inconsistent)\n          LEFT JOIN fills f USING (PostalCodeInt)),\ndd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY OrderNumber, ArticleID, OrderDate, CustomerID\n                                 ORDER BY _miss NULLS FIRST, City_correct NULLS FIRST, State NULLS FIRST, Final_City NULLS FIRST, City_inconsistent NULLS FIRST, PostalCodeInt NULLS FIRST, PostalCode NULLS FIRST, Company NULLS FIRST, RevenueType NULLS FIRST, PricePackagingUnit NULLS FIRST, Quantity NULLS FIRST, NetRevenue NULLS FIRST, ProductGroup NULLS FIRST, ProductSubgroup NULLS FIRST, BusinessArea NULLS FIRST, Type NULLS FIRST, IndustryGroup NULLS FIRST, SalesChannelCategory NULLS FIRST, SalesChannel NULLS FIRST, Season NULLS FIRST) AS rn FROM full_) WHERE rn = 1)\nSELECT OrderNumber, Company, ArticleID, OrderDate, CustomerID, RevenueType, PricePackagingUnit, Quantity,\n       NetRevenue, ProductGroup, ProductSubgroup, BusinessArea, Type, split_part(Final_City, ',', 1) AS City,\n       PostalCode, IndustryGroup, SalesChannelCategory, SalesChannel, Season,\n       CASE WHEN State IS NULL AND PostalCode = '69966' THEN 'Baden-Württemberg'\n            WHEN State IS NULL AND PostalCode = '08312' THEN 'Sachsen'\n            WHEN State IS NULL AND PostalCode = '40002' THEN 'Nordrhein-Westfalen'\n            WHEN State IS NULL AND PostalCode = '07801' THEN 'Thüringen' ELSE State END AS State\nFROM dd\n".replace("__REF__", _SUPPLIER_REF_SQL.strip())


@register("prepare_sales_tpch", _PREPARE_SQL)
def q_prepare_sales_tpch(spark, sf_dir):
    inv, cust, ref = _tpch_raw(spark, sf_dir)
    return jobs.prepare_sales(inv, cust, ref)


# ---------------------------------------------------------------------------
# Scalers and feature tables
# ---------------------------------------------------------------------------

def _flagship_rfm(spark, sf_dir):
    orders = _year_sales(spark, sf_dir, ["OrderNumber", "OrderDate", "CustomerID", "NetRevenue"])
    return segment.top_fraction_rfm(orders, REFERENCE_DATE, 0.25)


_RFM_SQL = with_sales(f"""
yr AS (SELECT * FROM sales WHERE {_YEAR_WHERE}),
per_cust AS (SELECT CustomerID, sum(CAST(NetRevenue AS DECIMAL(18,4))) AS rev FROM yr WHERE CustomerID IS NOT NULL GROUP BY 1),
ranked AS (SELECT CustomerID, row_number() OVER (ORDER BY rev DESC, CustomerID) AS rn, count(*) OVER () AS n FROM per_cust),
top AS (SELECT CustomerID FROM ranked WHERE rn <= floor(n * 0.25)),
rfm AS (SELECT CustomerID, datediff('day', max(OrderDate), DATE '{REFERENCE_DATE}') AS daysSinceLastOrder,
               count(DISTINCT OrderNumber) AS orderCount,
               CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) AS DOUBLE) AS sumRevenue
        FROM yr WHERE CustomerID IN (SELECT CustomerID FROM top) GROUP BY CustomerID)
""")
_RFM = ["daysSinceLastOrder", "orderCount", "sumRevenue"]


def _robust_sql():
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m, "
                      f"CASE WHEN quantile_cont({c}, 0.85) - quantile_cont({c}, 0.15) = 0 THEN 1.0 "
                      f"ELSE quantile_cont({c}, 0.85) - quantile_cont({c}, 0.15) END AS {c}_s" for c in _RFM)
    cols = ", ".join(f"round(({c} - {c}_m) / {c}_s, 9) AS {c}" for c in _RFM)
    return _RFM_SQL + f", p AS (SELECT {stats} FROM rfm)\nSELECT CustomerID, {cols} FROM rfm, p"


@register("rfm_robust_scaled", _robust_sql())
def q_rfm_robust_scaled(spark, sf_dir):
    sc = scale.robust_scale(_flagship_rfm(spark, sf_dir), _RFM)
    return sc.select("CustomerID", *[F.round(c, 9).alias(c) for c in _RFM])


@register("rfm_standard_scaled", _RFM_SQL + ", p AS (SELECT " + ", ".join(
    f"avg({c}) AS {c}_mu, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS {c}_sd" for c in _RFM)
    + " FROM rfm) SELECT CustomerID, " + ", ".join(f"round(({c} - {c}_mu) / {c}_sd, 9) AS {c}" for c in _RFM)
    + " FROM rfm, p")
def q_rfm_standard_scaled(spark, sf_dir):
    sc = scale.standard_scale(_flagship_rfm(spark, sf_dir), _RFM)
    return sc.select("CustomerID", *[F.round(c, 9).alias(c) for c in _RFM])


@register("rfm_maxabs_scaled", _RFM_SQL + ", p AS (SELECT " + ", ".join(
    f"CASE WHEN max(abs({c})) = 0 THEN 1.0 ELSE max(abs({c})) END AS {c}_ma" for c in _RFM)
    + " FROM rfm) SELECT CustomerID, " + ", ".join(f"{c} / {c}_ma AS {c}" for c in _RFM) + " FROM rfm, p")
def q_rfm_maxabs_scaled(spark, sf_dir):
    return scale.maxabs_scale(_flagship_rfm(spark, sf_dir), _RFM)


@register("weekly_minmax_scaled_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
, mm AS (SELECT *, min(NetRevenue) OVER (PARTITION BY DistributionCenter) AS lo,
               max(NetRevenue) OVER (PARTITION BY DistributionCenter) AS hi FROM series)
SELECT DistributionCenter, week, NetRevenue,
       CASE WHEN hi - lo = 0 THEN 0.0 ELSE (NetRevenue - lo) / (hi - lo) END AS scaled FROM mm
"""))
def q_weekly_minmax(spark, sf_dir):
    m = scale.minmax_scale(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], "NetRevenue")
    return m.select("DistributionCenter", "week", "NetRevenue", "scaled")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("one_hot_customer_segment", """
SELECT c_custkey, c_mktsegment AS IndustryGroup, """ + ", ".join(
    f"CAST(c_mktsegment = '{v}' AS INTEGER) AS IndustryGroup_{v}" for v in _SEGMENTS) + " FROM customer")
def q_one_hot(spark, sf_dir):
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("IndustryGroup"))
    return cluster.one_hot(cu, ["IndustryGroup"])


@register("one_hot_customers_long", """
WITH l AS (SELECT c_name, dense_rank() OVER (ORDER BY c_name) - 1 AS level FROM (SELECT DISTINCT c_name FROM customer WHERE c_name IS NOT NULL)),
m AS (SELECT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS level
      FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL))
SELECT c_custkey, c_name, c_mktsegment, 'c_name' AS feature, level FROM customer JOIN l USING (c_name)
UNION ALL SELECT c_custkey, c_name, c_mktsegment, 'c_mktsegment', level FROM customer JOIN m USING (c_mktsegment)
""")
def q_one_hot_long(spark, sf_dir):
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return cluster.one_hot_long(cu, ["c_name", "c_mktsegment"])


@register("feature_hash_locations")
def q_feature_hash(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "ArticleID", "City", "ProductGroup", "ProductSubgroup",
                              "PostalCode"]).withColumn("ArticleID", F.col("ArticleID").cast("string"))
    return cluster.feature_hash(s, ["City", "ProductGroup", "ProductSubgroup", "PostalCode"], 10)


@register("rfm_correlation", _RFM_SQL + "SELECT * FROM (VALUES " + ", ".join(
    f"('{a}', '{b}', (SELECT round(corr({a}, {b}), 9) FROM rfm))" for a in _RFM for b in _RFM)
    + ") AS t(col_a, col_b, corr)")
def q_rfm_correlation(spark, sf_dir):
    c = cluster.correlation_matrix(_flagship_rfm(spark, sf_dir), _RFM)
    return c.withColumn("corr", F.round("corr", 9))


@register("top10_item_rfc_by_quantity", with_sales(f"""
SELECT ProductSubgroup, DistributionCenter,
       datediff('day', max(OrderDate), DATE '{REFERENCE_DATE}') AS daysSinceLastOrder,
       count(OrderNumber) AS orderCount, sum(coalesce(Quantity, 1.0)) AS sumQuantity
FROM sales WHERE {_ITEM_WHERE} AND ProductSubgroup IS NOT NULL AND DistributionCenter IS NOT NULL
GROUP BY ProductSubgroup, DistributionCenter ORDER BY sumQuantity DESC, ProductSubgroup, DistributionCenter LIMIT 10
"""))
def q_top10_item_rfc(spark, sf_dir):
    rfc = segment.rfc_features(_item_dataset(spark, sf_dir), REFERENCE_DATE)
    return explore.nlargest(rfc, "sumQuantity", 10, ["ProductSubgroup", "DistributionCenter"])


@register("sample_1000_lines", with_sales("""
SELECT OrderNumber, ArticleID, NetRevenue FROM sales
ORDER BY md5('42|' || coalesce(OrderNumber, '') || '|' || coalesce(CAST(ArticleID AS VARCHAR), '')), OrderNumber, ArticleID, NetRevenue
LIMIT 1000
"""))
def q_sample_lines(spark, sf_dir):
    return explore.sample_exact_n(sales(spark, sf_dir, ["OrderNumber", "ArticleID", "NetRevenue"]), 1000, 42,
                                  ["OrderNumber", "ArticleID"])


# ---------------------------------------------------------------------------
# Clustering jobs (rows-only: iterative ML)
# ---------------------------------------------------------------------------

@register("customer_segments")
def q_customer_segments(spark, sf_dir):
    orders = _year_sales(spark, sf_dir, ["OrderNumber", "OrderDate", "CustomerID", "NetRevenue"])
    return jobs.segment_customers(orders, REFERENCE_DATE)


@register("customer_k_scores")
def q_customer_k_scores(spark, sf_dir):
    orders = _year_sales(spark, sf_dir, ["OrderNumber", "OrderDate", "CustomerID", "NetRevenue"])
    return jobs.segment_customers(orders, REFERENCE_DATE, with_scores=True)[1]


@register("item_segments")
def q_item_segments(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "OrderDate", "Quantity", "NetRevenue", "ProductSubgroup",
                              "DistributionCenter"])
    items = clean.not_in_future(clean.min_quantity(clean.year_equals(s, ANALYSIS_YEAR)), REFERENCE_DATE)
    return jobs.segment_items(items, REFERENCE_DATE)


@register("customer_cluster_centers")
def q_cluster_centers(spark, sf_dir):
    seg = q_customer_segments(spark, sf_dir)
    return cluster.cluster_centers(seg, _RFM).join(explore.cluster_size(seg), "cluster")


def _embedding_pca(spark, sf_dir):
    """All dimensions of the longest vector; null and shorter vectors have no components."""
    emb = read_table(spark, sf_dir, "embeddings")
    n = emb.agg(F.max(F.size("embedding"))).first()[0] or 0
    wide = emb.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(n)])
    return cluster.pca(wide, [f"e{i}" for i in range(n)], 2)


@register("embedding_pca")
def q_embedding_pca(spark, sf_dir):
    return _embedding_pca(spark, sf_dir)[0].select("vec_id", "pc_1", "pc_2")


@register("embedding_pca_variance")
def q_embedding_pca_variance(spark, sf_dir):
    ratios = _embedding_pca(spark, sf_dir)[1]
    return spark.createDataFrame([(i + 1, x) for i, x in enumerate(ratios)], "component int, explained_variance double")


# ---------------------------------------------------------------------------
# Forecasts and diagnostics
# ---------------------------------------------------------------------------

@register("forecast_lag_by_center")
def q_forecast_lag(spark, sf_dir):
    return forecast.lag_model_forecast(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                                       "NetRevenue", horizon=52, value_name="Revenue")


@register("forecast_differenced_ar_by_center")
def q_forecast_differenced_ar(spark, sf_dir):
    return forecast.differenced_ar_forecast(_weekly(spark, sf_dir, ["DistributionCenter"]),
                                            ["DistributionCenter"], "NetRevenue", p=5, d=2, horizon=52)


@register("forecast_arima_by_center")
def q_forecast_arima(spark, sf_dir):
    return arma.arima_forecast(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], "NetRevenue",
                               jobs.ARIMA_ORDER, 52)


@register("arima_coefficients_by_center")
def q_arima_coefficients(spark, sf_dir):
    fitted = arma.fit(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], "NetRevenue", jobs.ARIMA_ORDER)
    return arma.coefficients(fitted, ["DistributionCenter"])


# order (1, 1, 0) is a regression line of each difference on the one before
@register("forecast_arima_110_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
, z AS (SELECT *, NetRevenue - lag(NetRevenue) OVER w AS z, lag(NetRevenue) OVER w AS before
        FROM series WINDOW w AS (PARTITION BY DistributionCenter ORDER BY week)),
l AS (SELECT *, lag(z) OVER (PARTITION BY DistributionCenter ORDER BY week) AS lz FROM z),
m AS (SELECT DistributionCenter, regr_slope(z, lz) AS f, regr_intercept(z, lz) AS c,
             max(week) AS last, arg_max(NetRevenue, week) AS y, arg_max(z, week) AS z FROM l GROUP BY DistributionCenter),
a AS (SELECT *, c / (1 - f) AS mu FROM m)
SELECT DistributionCenter, week AS Date, round(NetRevenue, 2) AS NetRevenue, round(before + c + f * lz, 2) AS ARIMA,
       CAST(NULL AS DOUBLE) AS predicted_mean
FROM l JOIN m USING (DistributionCenter)
UNION ALL
SELECT DistributionCenter, CAST(last + 7 * h AS DATE), NULL, NULL,
       round(y + h * mu + (z - mu) * f * (1 - pow(f, h)) / (1 - f), 2)
FROM a, (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS h)
"""))
def q_forecast_arima_110(spark, sf_dir):
    out = arma.arima_forecast(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], "NetRevenue", (1, 1, 0), 12)
    return out.select("DistributionCenter", "Date", *[F.round(c, 2).alias(c) for c in ("NetRevenue", "ARIMA", "predicted_mean")])


@register("item_center_arima")
def q_item_center_arima(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "OrderDate", "Quantity", "NetRevenue", "ProductSubgroup", "State"])
    return jobs.forecast_items(s, ANALYSIS_YEAR, REFERENCE_DATE, 52, method="arima", center="Brandenburg")


# two regressors: the normal equations in closed form
@register("exog_regression_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
, x AS (SELECT DistributionCenter, week, NetRevenue AS y, lag(NetRevenue) OVER (PARTITION BY DistributionCenter ORDER BY week) AS a,
               Quantity AS b FROM series),
m AS (SELECT DistributionCenter, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb,
             covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM x WHERE a IS NOT NULL GROUP BY ALL),
wt AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM m)
SELECT DistributionCenter, week, round(y, 2) AS NetRevenue, round(my + wa * (a - ma) + wb * (b - mb), 2) AS fitted
FROM x JOIN wt USING (DistributionCenter) WHERE a IS NOT NULL
"""))
def q_exog(spark, sf_dir):
    out = forecast.exog_regression(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                                   "NetRevenue", ["Quantity"], p=1)
    return out.withColumns({c: F.round(c, 2) for c in ("NetRevenue", "fitted")})


@register("customer_cluster_forecast")
def q_customer_cluster_forecast(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "OrderDate", "CustomerID", "NetRevenue"])
    return jobs.forecast_customers(s, ANALYSIS_YEAR, REFERENCE_DATE, 52)


@register("item_quantity_forecast")
def q_item_forecast(spark, sf_dir):
    s = sales(spark, sf_dir, ["OrderNumber", "OrderDate", "Quantity", "NetRevenue", "ProductSubgroup", "State"])
    return jobs.forecast_items(s, ANALYSIS_YEAR, REFERENCE_DATE, 52)


@register("forecast_errors_by_center")
def q_forecast_errors(spark, sf_dir):
    fc = q_forecast_lag(spark, sf_dir).where(F.col("Predict").isNull())
    tr = evaluate.rmse(fc, ["DistributionCenter"], "Revenue", "Train").withColumn("split", F.lit("train"))
    te = evaluate.rmse(fc, ["DistributionCenter"], "Revenue", "Test").withColumn("split", F.lit("test"))
    mh = evaluate.mape_huber(fc.withColumn("P", F.coalesce("Train", "Test")), ["DistributionCenter"], "Revenue", "P")
    se = evaluate.scaled_errors(fc.withColumn("P", F.coalesce("Train", "Test")), ["DistributionCenter"],
                                "Revenue", "P")
    return tr.unionByName(te).join(mh, "DistributionCenter").join(se, "DistributionCenter")


_ALPHA = 0.3


@register("ses_fixed_alpha_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + f"""
, ordered AS (SELECT DistributionCenter, week, NetRevenue,
                     row_number() OVER (PARTITION BY DistributionCenter ORDER BY week) AS i FROM series),
rec AS (
  SELECT DistributionCenter, i, week, NetRevenue AS fitted, NetRevenue AS lvl FROM ordered WHERE i = 1
  UNION ALL
  SELECT o.DistributionCenter, o.i, o.week, r.lvl AS fitted,
         CAST('{_ALPHA!r}' AS DOUBLE) * o.NetRevenue + CAST('{1.0 - _ALPHA!r}' AS DOUBLE) * r.lvl AS lvl
  FROM rec r JOIN ordered o ON o.DistributionCenter = r.DistributionCenter AND o.i = r.i + 1)
SELECT DistributionCenter, week, fitted FROM rec
""").replace("WITH sales AS", "WITH RECURSIVE sales AS", 1))
def q_ses(spark, sf_dir):
    return diagnostics.simple_exp_smoothing(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                                            "NetRevenue", _ALPHA)


@register("ses_best_alpha_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
, ordered AS (SELECT DistributionCenter, week, NetRevenue AS y,
                     row_number() OVER (PARTITION BY DistributionCenter ORDER BY week) AS i FROM series),
grid AS (SELECT CAST(g AS DOUBLE) / 10 AS alpha FROM range(1, 10) t(g)),
rec AS (
  SELECT o.DistributionCenter, g.alpha, o.i, o.y AS lvl, 0.0::DOUBLE AS e FROM ordered o, grid g WHERE o.i = 1
  UNION ALL
  SELECT r.DistributionCenter, r.alpha, o.i, r.alpha * o.y + (1 - r.alpha) * r.lvl AS lvl,
         r.e + (o.y - r.lvl) * (o.y - r.lvl) AS e
  FROM rec r JOIN ordered o ON o.DistributionCenter = r.DistributionCenter AND o.i = r.i + 1),
fin AS (SELECT DistributionCenter, alpha, e AS sse FROM (
          SELECT *, row_number() OVER (PARTITION BY DistributionCenter, alpha ORDER BY i DESC) AS rn FROM rec)
        WHERE rn = 1)
SELECT DistributionCenter, alpha, sse FROM (
  SELECT *, row_number() OVER (PARTITION BY DistributionCenter ORDER BY sse, alpha) AS rn FROM fin) WHERE rn = 1
""").replace("WITH sales AS", "WITH RECURSIVE sales AS", 1))
def q_ses_best(spark, sf_dir):
    return diagnostics.ses_best_alpha(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                                      "NetRevenue", [i / 10 for i in range(1, 10)])


@register("holt_additive_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + "\n, ordered AS (SELECT DistributionCenter, week, NetRevenue AS y,\n                     row_number() OVER (PARTITION BY DistributionCenter ORDER BY week) AS i FROM series),\nfirst2 AS (SELECT DistributionCenter, max(CASE WHEN i = 1 THEN y END) AS y1, max(CASE WHEN i = 2 THEN y END) AS y2\n           FROM ordered GROUP BY 1),\nrec AS (\n  SELECT o.DistributionCenter, o.i, o.week, o.y AS fitted, o.y AS lvl, y2 - y1 AS tr\n  FROM ordered o JOIN first2 f USING (DistributionCenter) WHERE o.i = 1\n  UNION ALL\n  SELECT x.DistributionCenter, x.i, x.week, x.fc AS fitted, x.lvl, CAST('{b}' AS DOUBLE) * (x.lvl - r.lvl) + CAST('{ob}' AS DOUBLE) * r.tr AS tr\n  FROM rec r JOIN LATERAL (\n    SELECT o.DistributionCenter, o.i, o.week, r.lvl + r.tr AS fc,\n           CAST('{a}' AS DOUBLE) * o.y + CAST('{oa}' AS DOUBLE) * (r.lvl + r.tr) AS lvl\n    FROM ordered o WHERE o.DistributionCenter = r.DistributionCenter AND o.i = r.i + 1) x ON TRUE)\nSELECT DistributionCenter, week, fitted FROM rec\n".format(
    a=repr(0.3), oa=repr(1 - 0.3), b=repr(0.1), ob=repr(1 - 0.1))).replace("WITH sales AS", "WITH RECURSIVE sales AS", 1))
def q_holt(spark, sf_dir):
    return diagnostics.holt(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                            "NetRevenue", 0.3, 0.1)


@register("holt_multiplicative_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + "\n, ordered AS (SELECT DistributionCenter, week, NetRevenue AS y,\n                     row_number() OVER (PARTITION BY DistributionCenter ORDER BY week) AS i FROM series),\nfirst2 AS (SELECT DistributionCenter, max(CASE WHEN i = 1 THEN y END) AS y1, max(CASE WHEN i = 2 THEN y END) AS y2\n           FROM ordered GROUP BY 1),\nrec AS (\n  SELECT o.DistributionCenter, o.i, o.week, o.y AS fitted, o.y AS lvl, CASE WHEN y1 = 0 THEN NULL ELSE y2 / y1 END AS tr\n  FROM ordered o JOIN first2 f USING (DistributionCenter) WHERE o.i = 1\n  UNION ALL\n  SELECT x.DistributionCenter, x.i, x.week, x.fc AS fitted, x.lvl, CAST('{b}' AS DOUBLE) * (CASE WHEN r.lvl = 0 THEN NULL ELSE x.lvl / r.lvl END) + CAST('{ob}' AS DOUBLE) * r.tr AS tr\n  FROM rec r JOIN LATERAL (\n    SELECT o.DistributionCenter, o.i, o.week, r.lvl * r.tr AS fc,\n           CAST('{a}' AS DOUBLE) * o.y + CAST('{oa}' AS DOUBLE) * (r.lvl * r.tr) AS lvl\n    FROM ordered o WHERE o.DistributionCenter = r.DistributionCenter AND o.i = r.i + 1) x ON TRUE)\nSELECT DistributionCenter, week, fitted FROM rec\n".format(
    a=repr(0.3), oa=repr(1 - 0.3), b=repr(0.1), ob=repr(1 - 0.1))).replace("WITH sales AS", "WITH RECURSIVE sales AS", 1))
def q_holt_mul(spark, sf_dir):
    return diagnostics.holt(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                            "NetRevenue", 0.3, 0.1, multiplicative=True)


@register("acf_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
, d AS (SELECT DistributionCenter, week, NetRevenue - avg(NetRevenue) OVER (PARTITION BY DistributionCenter) AS dev
       FROM series),
l AS (SELECT DistributionCenter, dev, """ + ", ".join(
    f"lag(dev, {k}) OVER (PARTITION BY DistributionCenter ORDER BY week) AS l{k}" for k in range(1, 21)) + """ FROM d),
s AS (SELECT DistributionCenter, sum(dev * dev) AS c0, """ + ", ".join(f"sum(dev * l{k}) AS c{k}" for k in range(1, 21))
    + """ FROM l GROUP BY DistributionCenter)
SELECT DistributionCenter, lag, round(acf, 9) AS acf FROM (
  SELECT DistributionCenter, 0 AS lag, 1.0 AS acf FROM s UNION ALL """ + " UNION ALL ".join(
    f"SELECT DistributionCenter, {k}, c{k} / c0 FROM s" for k in range(1, 21)) + ")"))
def q_acf(spark, sf_dir):
    a = diagnostics.acf(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], "NetRevenue", 20)
    return a.withColumn("acf", F.round("acf", 9))


@register("pacf_by_center")
def q_pacf(spark, sf_dir):
    a = diagnostics.acf(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"], "NetRevenue", 20)
    return diagnostics.pacf(a, ["DistributionCenter"])


@register("adf_by_center")
def q_adf(spark, sf_dir):
    return diagnostics.adf_statistic(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                                     "NetRevenue")


@register("seasonal_decompose_by_center", with_sales(_weekly_sql(["DistributionCenter"]) + """
, t AS (SELECT DistributionCenter, week, NetRevenue,
               CASE WHEN count(NetRevenue) OVER (w ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING) = 53
                    THEN (CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) OVER (w ROWS BETWEEN 26 PRECEDING AND 25 FOLLOWING) AS DOUBLE) / 52
                        + CAST(sum(CAST(NetRevenue AS DECIMAL(18,4))) OVER (w ROWS BETWEEN 25 PRECEDING AND 26 FOLLOWING) AS DOUBLE) / 52) / 2 END AS trend,
               (row_number() OVER w - 1) % 52 AS phase
        FROM series WINDOW w AS (PARTITION BY DistributionCenter ORDER BY week)),
idx AS (SELECT DistributionCenter, phase, avg(NetRevenue - trend) AS raw FROM t GROUP BY 1, 2),
idx2 AS (SELECT DistributionCenter, phase, raw - avg(raw) OVER (PARTITION BY DistributionCenter) AS seasonal FROM idx)
SELECT t.DistributionCenter, t.week, t.NetRevenue, t.trend, round(i.seasonal, 6) AS seasonal,
       round(t.NetRevenue - t.trend - i.seasonal, 6) AS resid
FROM t LEFT JOIN idx2 i ON t.DistributionCenter = i.DistributionCenter AND t.phase = i.phase
"""))
def q_seasonal_decompose(spark, sf_dir):
    d = diagnostics.seasonal_decompose(_weekly(spark, sf_dir, ["DistributionCenter"]), ["DistributionCenter"],
                                       "NetRevenue", 52)
    return d.withColumn("seasonal", F.round("seasonal", 6)).withColumn("resid", F.round("resid", 6))


# ---------------------------------------------------------------------------
# Neighbours, density clustering, tree model, grid search (ML-14..18), JOIN-7
# ---------------------------------------------------------------------------

def _item_rfc_scaled(spark, sf_dir):
    rfc = segment.rfc_features(_item_dataset(spark, sf_dir), REFERENCE_DATE)
    sc = scale.robust_scale(rfc, ["daysSinceLastOrder", "orderCount", "sumQuantity"])
    return sc.select(F.concat_ws("|", "ProductSubgroup", "DistributionCenter").alias("item"),
                     "daysSinceLastOrder", "orderCount", "sumQuantity")


_RFC = ["daysSinceLastOrder", "orderCount", "sumQuantity"]


def _item_rfc_scaled_sql() -> str:
    stats = ", ".join(f"quantile_cont({c}, 0.5) AS {c}_m, "
                      f"CASE WHEN quantile_cont({c}, 0.85) - quantile_cont({c}, 0.15) = 0 THEN 1.0 "
                      f"ELSE quantile_cont({c}, 0.85) - quantile_cont({c}, 0.15) END AS {c}_s" for c in _RFC)
    cols = ", ".join(f"({c} - {c}_m) / {c}_s AS {c}" for c in _RFC)
    return with_sales(f"""
rfc AS (SELECT ProductSubgroup || '|' || DistributionCenter AS item,
               CAST(datediff('day', max(OrderDate), DATE '{REFERENCE_DATE}') AS DOUBLE) AS daysSinceLastOrder,
               CAST(count(OrderNumber) AS DOUBLE) AS orderCount, sum(coalesce(Quantity, 1.0)) AS sumQuantity
        FROM sales WHERE {_ITEM_WHERE} AND ProductSubgroup IS NOT NULL AND DistributionCenter IS NOT NULL
        GROUP BY ProductSubgroup, DistributionCenter),
p AS (SELECT {stats} FROM rfc),
sc AS (SELECT item, {cols} FROM rfc, p)
""")


# brute force over all pairs: the item table has one row per (subgroup, centre)
_ITEM_PAIRS_SQL = _item_rfc_scaled_sql() + """
, d AS (SELECT a.item AS a, b.item AS b, sqrt(""" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _RFC) + """) AS dist
       FROM sc a, sc b)
, kn AS (SELECT a AS item, dist, CAST(row_number() OVER (PARTITION BY a ORDER BY dist) AS INTEGER) AS rank FROM d)
"""
# thirty quantiles of the 3-distances, and two to six samples
_EPS_QUANTILES = [round((i + 1) / 31, 6) for i in range(30)]
_MIN_SAMPLES = [2, 3, 4, 5, 6]


@register("item_knn_distance", _ITEM_PAIRS_SQL + "SELECT item, round(dist, 9) AS kdist FROM kn WHERE rank = 3")
def q_item_knn(spark, sf_dir):
    k = density.knn(_item_rfc_scaled(spark, sf_dir), "item", _RFC, k=3).where("rank = 3")
    return k.select("item", F.round("dist", 9).alias("kdist"))


@register("item_knn_ranks", _ITEM_PAIRS_SQL + "SELECT item, rank, round(dist, 9) AS dist FROM kn WHERE rank <= 6")
def q_item_knn_ranks(spark, sf_dir):
    return density.knn(_item_rfc_scaled(spark, sf_dir), "item", _RFC, k=6).withColumn("dist", F.round("dist", 9))


@register("item_knn_curve", _ITEM_PAIRS_SQL + """
SELECT row_number() OVER (ORDER BY dist, item) AS position, item, round(dist, 9) AS kdist FROM kn WHERE rank = 3
""")
def q_item_knn_curve(spark, sf_dir):
    curve = density.knn_curve(density.knn(_item_rfc_scaled(spark, sf_dir), "item", _RFC, k=3), "item", 3)
    return curve.withColumn("kdist", F.round("kdist", 9))


def _dbscan_sql(trials: str) -> str:
    """Labels by reachability among core points, for the trials of ``trials(eps, ms)``."""
    return _ITEM_PAIRS_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, trial AS ({trials})
, core AS (SELECT eps, ms, a FROM trial JOIN d ON dist <= eps GROUP BY ALL HAVING count(*) >= ms)
, link AS (SELECT x.eps, x.ms, x.a, y.a AS b FROM core x JOIN d ON d.a = x.a AND d.dist <= x.eps
           JOIN core y ON y.a = d.b AND y.eps = x.eps AND y.ms = x.ms)
, reach AS (SELECT eps, ms, a, a AS root FROM core
            UNION
            SELECT l.eps, l.ms, l.b, r.root FROM reach r JOIN link l ON l.a = r.a AND l.eps = r.eps AND l.ms = r.ms WHERE r.root < l.b)
, comp AS (SELECT eps, ms, a, min(root) AS root FROM reach GROUP BY ALL)
, num AS (SELECT eps, ms, root, dense_rank() OVER (PARTITION BY eps, ms ORDER BY root) - 1 AS cluster
          FROM (SELECT DISTINCT eps, ms, root FROM comp))
, lab AS (SELECT t.eps, t.ms, s.item, coalesce(min(num.cluster) FILTER (comp.a = s.item), min(num.cluster), -1) AS cluster
          FROM trial t CROSS JOIN sc s JOIN d ON d.a = s.item
          LEFT JOIN comp ON comp.a = d.b AND comp.eps = t.eps AND comp.ms = t.ms AND d.dist <= t.eps
          LEFT JOIN num ON num.eps = comp.eps AND num.ms = comp.ms AND num.root = comp.root
          GROUP BY ALL)
"""


_GRID_SQL = _dbscan_sql(f"""
  SELECT eps, ms FROM (SELECT DISTINCT round(unnest(quantile_cont(dist, {_EPS_QUANTILES})), 3) AS eps FROM kn WHERE rank = 3),
                      (SELECT unnest({_MIN_SAMPLES}) AS ms) WHERE eps > 0""") + """
, n AS (SELECT eps, ms, cluster, count(*) AS n FROM lab GROUP BY ALL)
, c AS (SELECT eps, ms, count(*) FILTER (cluster >= 0) AS clusters, count(*) AS labels,
               coalesce(sum(n) FILTER (cluster < 0), 0) AS noise FROM n GROUP BY ALL)
, far AS (SELECT x.eps, x.ms, x.item, x.cluster AS own, y.cluster, sum(d.dist * d.dist) AS s, count(*) AS n
          FROM lab x JOIN d ON d.a = x.item JOIN lab y ON y.item = d.b AND y.eps = x.eps AND y.ms = x.ms
          JOIN c ON c.eps = x.eps AND c.ms = x.ms AND c.clusters BETWEEN 2 AND 50 GROUP BY ALL)
, ab AS (SELECT eps, ms, item, max(CASE WHEN cluster = own AND n > 1 THEN s / (n - 1) END) AS a,
                min(CASE WHEN cluster <> own THEN s / n END) AS b FROM far GROUP BY ALL)
, sil AS (SELECT eps, ms, round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 9) AS score
          FROM ab GROUP BY ALL)
, scored AS (SELECT c.eps, CAST(c.ms AS INTEGER) AS min_samples, CAST(clusters AS INTEGER) AS clusters, CAST(noise AS INTEGER) AS noise,
                    coalesce(score, -10.0) AS score FROM c LEFT JOIN sil USING (eps, ms))
, ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, eps, min_samples) AS INTEGER) AS rank FROM scored)
"""


@register("item_dbscan", _dbscan_sql("SELECT 0.5 AS eps, 4 AS ms") + "SELECT item, cluster FROM lab")
def q_item_dbscan(spark, sf_dir):
    return density.dbscan(_item_rfc_scaled(spark, sf_dir), "item", _RFC, eps=0.5, min_samples=4)


def _item_grid(spark, sf_dir):
    """The reference tries 30 eps of its own coordinates; here they are quantiles of the 3-distances."""
    items = cluster.materialise(_item_rfc_scaled(spark, sf_dir))
    kth = density.knn(items, "item", _RFC, k=3).where("rank = 3")
    eps = kth.agg(F.percentile("dist", F.array(*map(F.lit, _EPS_QUANTILES))).alias("q")).first()["q"] or []
    return density.dbscan_search(items, "item", _RFC, sorted({round(e, 3) for e in eps} - {0.0}) or [0.5], _MIN_SAMPLES)


@register("item_dbscan_grid", _GRID_SQL + "SELECT eps, min_samples, clusters, noise, round(score, 6) AS score FROM ranked")
def q_item_dbscan_grid(spark, sf_dir):
    return _item_grid(spark, sf_dir)[0].drop("rank").withColumn("score", F.round("score", 6))


@register("item_dbscan_top10", _GRID_SQL + "SELECT rank, eps, min_samples, clusters, noise, round(score, 6) AS score FROM ranked WHERE rank <= 10")
def q_item_dbscan_top10(spark, sf_dir):
    return density.best_trials(_item_grid(spark, sf_dir)[0], 10).withColumn("score", F.round("score", 6))


@register("item_dbscan_best_labels", _GRID_SQL + """
SELECT eps, min_samples, item, cluster FROM lab JOIN (SELECT eps, min_samples, min_samples AS ms FROM ranked WHERE rank = 1) USING (eps, ms)
""")
def q_item_dbscan_best_labels(spark, sf_dir):
    return density.best_labels(*_item_grid(spark, sf_dir))


@register("random_forest_revenue")
def q_random_forest(spark, sf_dir):
    # the forest reads its input several times (metadata, split candidates,
    # cached tree input): write the three needed columns once
    s = cluster.materialise(sales(spark, sf_dir, ["OrderDate", "Quantity", "NetRevenue"]))
    train, test = clean.date_split(s, f"{ANALYSIS_YEAR}-01-01")
    return cluster.random_forest_regression(train, test, ["Quantity"], "NetRevenue", trees=100, seed=42)[1]


@register("grid_search_lag_regression")
def q_grid_search(spark, sf_dir):
    series = _weekly(spark, sf_dir, ["DistributionCenter"])
    scaled = scale.minmax_scale(series, ["DistributionCenter"], "NetRevenue", "y")
    samples = timeaxis.lag_frame(scaled.select("DistributionCenter", "week", "y"), ["DistributionCenter"], "y", 10)
    samples = timeaxis.add_position(samples, ["DistributionCenter"])
    samples = samples.withColumn("fold", F.floor(F.col("pos") * 3 / F.col("n")))
    samples = samples.select("fold", "target", *[F.col("lags")[i].alias(f"l{i}") for i in range(10)])
    return cluster.grid_search_cv(samples, [f"l{i}" for i in range(10)], "target", "fold",
                                  [0.0, 0.01, 0.1], [0.0, 0.5])


@register("customer_rfm_with_attributes", _RFM_SQL + """,
attrs AS (SELECT CustomerID, IndustryGroup, City FROM (
  SELECT CustomerID, IndustryGroup, City,
         row_number() OVER (PARTITION BY CustomerID ORDER BY IndustryGroup, City) AS rn
  FROM yr WHERE CustomerID IS NOT NULL) WHERE rn = 1)
SELECT r.*, a.IndustryGroup, a.City FROM rfm r LEFT JOIN attrs a USING (CustomerID)
""")
def q_rfm_attrs(spark, sf_dir):
    lines = _year_sales(spark, sf_dir, ["OrderNumber", "OrderDate", "CustomerID", "NetRevenue",
                                        "IndustryGroup", "City"])
    rfm = segment.top_fraction_rfm(lines, REFERENCE_DATE, 0.25)
    return explore.attribute_left_join(rfm, lines, "CustomerID", ["IndustryGroup", "City"])


# ---------------------------------------------------------------------------
# Streaming: weekly sums of the events table replayed as a file stream
# ---------------------------------------------------------------------------

@register("weekly_events_stream", """
SELECT event_type, CAST(date_trunc('week', CAST(ts AS DATE) - 1) AS DATE) AS week,
       CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS value, count(*) AS events
FROM events GROUP BY ALL
""")
def q_weekly_events_stream(spark, sf_dir):
    from ..streaming import weekly
    schema = read_table(spark, sf_dir, "events").schema
    # a glob (not a file path): the file stream source lists a folder
    stream = weekly.read_parquet_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", schema)
    stream = stream.withColumn("events", F.lit(1))
    res = weekly.weekly_sum_stream(stream, ["event_type"], "ts", ["value", "events"], money=("value",))
    return weekly.run_available(res, name="weekly-events").select(
        "event_type", "week", "value", F.col("events").cast("long").alias("events"))


def _prepared(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from ..session import ensure_checkpoint_dir, ship_package
        ensure_checkpoint_dir(spark)
        ship_package(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Registered queries; each makes sure the session has a checkpoint folder
    and that the package is shipped to the Python workers."""
    return {k: _prepared(v) for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
