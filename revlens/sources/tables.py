"""Driver tables and the canonical ``sales`` view built from them.

The canonical sales schema (one row per order line) is what every operator
expects.  On the TPC-H-like driver tables it is assembled by joins; the
adapter joins only the dimension tables the requested columns need, so a
query that reads three columns does not pay for five joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as RF

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-1: one parquet table; projection and filters reach the scan lazily."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Canonical column -> (dimension tables needed, expression factory).  Expressions use
# the driver table column names after the joins below.
_CANONICAL = {
    "OrderNumber": ((), lambda: F.col("o_orderkey").cast("string")),
    "Company": ((), lambda: F.col("l_suppkey").cast("string")),
    "ArticleID": ((), lambda: F.col("l_partkey")),
    "OrderDate": ((), lambda: F.to_date("o_orderdate")),
    "CustomerID": ((), lambda: F.col("o_custkey").cast("string")),
    "RevenueType": ((), lambda: F.col("l_returnflag")),
    "Type": ((), lambda: F.col("l_linestatus")),
    "PricePackagingUnit": (("part",), lambda: F.col("p_retailprice")),
    "Quantity": ((), lambda: F.col("l_quantity")),
    "NetRevenue": ((), lambda: F.col("l_extendedprice") * (1 - F.col("l_discount"))),
    "ProductGroup": (("part",), lambda: F.col("p_type")),
    "ProductSubgroup": (("part",), lambda: F.col("p_brand")),
    "BusinessArea": ((), lambda: F.col("o_orderpriority")),
    "IndustryGroup": (("customer",), lambda: F.col("c_mktsegment")),
    "SalesChannelCategory": (("customer",), lambda: F.col("c_mktsegment")),
    "SalesChannel": (("customer",), lambda: RF.sales_channel("c_mktsegment")),
    # the 25 nations stand for the 16 states, so that every distribution centre occurs
    "State": (("customer", "nation"), lambda: F.element_at(
        F.array(*map(F.lit, RF.STATES)), (F.col("n_nationkey") % len(RF.STATES) + 1).cast("int"))),
    "City": (("customer", "nation"), lambda: F.col("n_name")),
    "PostalCode": ((), lambda: RF.pad_postal("o_custkey")),
    "DistributionCenter": (("customer", "nation", "region"), lambda: F.col("r_name")),
    "Season": ((), lambda: RF.season_fiscal(F.to_date("o_orderdate"))),
}

SALES_COLUMNS = list(_CANONICAL)


def sales(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Canonical order lines: lineitem ⋈ orders [⋈ customer ⋈ nation ⋈ region] [⋈ part].

    Joins are equi-joins left to Catalyst: the big lineitem ⋈ orders join is a
    sort-merge join on the order key, the small dimension tables are broadcast
    only when their measured size is under the broadcast threshold (AQE checks
    it again at run time), otherwise they are shuffled too.
    """
    columns = columns or SALES_COLUMNS
    unknown = set(columns) - set(_CANONICAL)
    if unknown:
        raise ValueError(f"unknown sales columns: {sorted(unknown)}")
    need = set()
    for c in columns:
        need.update(_CANONICAL[c][0])

    # Customer-side dimensions are joined to orders first (orders is a
    # fraction of lineitem), so the large lineitem side is shuffled once for
    # the order-key join and not again for the customer key.
    od = read_table(spark, sf_dir, "orders")
    if "customer" in need:
        cu = read_table(spark, sf_dir, "customer")
        od = od.join(cu, od.o_custkey == cu.c_custkey, "inner")
    if "nation" in need:
        na = read_table(spark, sf_dir, "nation")
        od = od.join(na, od.c_nationkey == na.n_nationkey, "inner")
    if "region" in need:
        rg = read_table(spark, sf_dir, "region")
        od = od.join(rg, od.n_regionkey == rg.r_regionkey, "inner")
    li = read_table(spark, sf_dir, "lineitem")
    df = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    if "part" in need:
        pa = read_table(spark, sf_dir, "part")
        df = df.join(pa, df.l_partkey == pa.p_partkey, "inner")
    return df.select(*[_CANONICAL[c][1]().alias(c) for c in columns])


def events_as_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table in canonical shape: a user is a customer, an event an order."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("OrderNumber"),
        F.col("user_id").cast("string").alias("CustomerID"),
        F.to_date("ts").alias("OrderDate"),
        F.col("ts").alias("OrderTime"),
        F.col("event_type").alias("Type"),
        F.col("value").alias("NetRevenue"),
    )


# SQL twin of ``sales`` for the DuckDB oracle (same expressions, all joins).
SALES_SQL = """
sales AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS OrderNumber,
         CAST(l.l_suppkey AS VARCHAR) AS Company,
         l.l_partkey AS ArticleID,
         CAST(o.o_orderdate AS DATE) AS OrderDate,
         CAST(o.o_custkey AS VARCHAR) AS CustomerID,
         l.l_returnflag AS RevenueType,
         l.l_linestatus AS Type,
         p.p_retailprice AS PricePackagingUnit,
         l.l_quantity AS Quantity,
         l.l_extendedprice * (1 - l.l_discount) AS NetRevenue,
         p.p_type AS ProductGroup,
         p.p_brand AS ProductSubgroup,
         o.o_orderpriority AS BusinessArea,
         c.c_mktsegment AS IndustryGroup,
         c.c_mktsegment AS SalesChannelCategory,
         split_part(c.c_mktsegment, '_', 1) AS SalesChannel,
         (""" + repr(RF.STATES) + """)[n.n_nationkey % """ + str(len(RF.STATES)) + """ + 1] AS State,
         n.n_name AS City,
         lpad(CAST(o.o_custkey AS VARCHAR), CAST(greatest(5, length(CAST(o.o_custkey AS VARCHAR))) AS INTEGER), '0') AS PostalCode,
         r.r_name AS DistributionCenter,
         CASE ((month(o.o_orderdate) % 12 + 2) // 3) % 4 + 1
              WHEN 1 THEN 'Winter' WHEN 2 THEN 'Spring' WHEN 3 THEN 'Summer' ELSE 'Autumn' END AS Season
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)
"""
