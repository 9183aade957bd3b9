"""Projections, renames, casts, derived columns, filters and de-duplication.

PRJ-1..16, FLT-1..10, AGG-16.  All are narrow expressions except
``dedupe_first`` (one aggregation on the dedupe key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as RF

# Raw invoice / customer column names -> canonical names (fixed values).
RAW_TO_CANONICAL = {
    "Belegnummer": "OrderNumber",
    "Artikel_SK": "ArticleID",
    "Unternehmen": "Company",
    "Auftragsdatum_SK": "OrderDate",
    "Kunde_Verkauf_SK": "CustomerID",
    "Umsatztyp": "RevenueType",
    "Preis Verpackungseinheit": "PricePackagingUnit",
    "Menge": "Quantity",
    "Nettoumsatz": "NetRevenue",
    "Productgroup": "ProductGroup",
    "Productsubgroup": "ProductSubgroup",
    "Business Area": "BusinessArea",
    "Type": "Type",
    "Ort": "City",
    "Vertriebskanalkategorie": "SalesChannelCategory",
    "Vertriebskanal": "SalesChannel",
    "PLZ-Code": "PostalCode",
    "Branchengruppe": "IndustryGroup",
}
INVOICE_COLUMNS = ["Belegnummer", "Unternehmen", "Artikel_SK", "Auftragsdatum_SK",
                   "Kunde_Verkauf_SK", "Umsatztyp", "Preis Verpackungseinheit", "Menge",
                   "Nettoumsatz", "Productgroup", "Productsubgroup", "Business Area", "Type"]
CUSTOMER_COLUMNS = ["Kunde_SK", "Ort", "PLZ-Code", "Branchengruppe",
                    "Vertriebskanalkategorie", "Vertriebskanal"]
DEDUPE_KEYS = ["OrderNumber", "ArticleID", "OrderDate", "CustomerID"]


# --- projections -----------------------------------------------------------

def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ-1 (fails early on a missing column)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """PRJ-2: rename the present columns of ``mapping``."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ-3."""
    return df.drop(*cols)


def cast_columns(df: DataFrame, types: dict[str, str], safe: bool = True) -> DataFrame:
    """PRJ-4: cast (``try_cast`` when ``safe``: bad values -> null, ANSI-proof)."""
    exprs = {}
    for c, t in types.items():
        exprs[c] = F.expr(f"try_cast(`{c}` as {t})") if safe else F.col(c).cast(t)
    return df.withColumns(exprs)


def coerce_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """PRJ-5: text -> double with failures -> null, NaN -> null."""
    return df.withColumns({c: RF.nan_to_null(RF.coerce_double(c)) for c in cols})


def fill_constant(df: DataFrame, values: dict) -> DataFrame:
    """PRJ-6."""
    return df.fillna(values)


def fill_from_column(df: DataFrame, target: str, source: str) -> DataFrame:
    """PRJ-7: null ``target`` -> ``source``."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(source)))


def conditional_override(df: DataFrame, key: str, target: str, rules: dict) -> DataFrame:
    """PRJ-8: where ``key`` equals a rule key and ``target`` is null, set the rule value."""
    expr = None
    for k, v in rules.items():
        cond = (F.col(key) == F.lit(k)) & F.col(target).isNull()
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return df.withColumn(target, expr.otherwise(F.col(target)) if expr is not None else F.col(target))


def null_where_equal(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """PRJ-9."""
    return df.withColumn(actual, RF.null_where_equal(actual, predicted))


def zero_to_null_rounded(df: DataFrame, cols: list[str], scale: int = 2) -> DataFrame:
    """PRJ-10: null -> 0, half-even round, 0 -> null."""
    return df.withColumns({c: RF.zero_to_null_rounded(c, scale) for c in cols})


def recode_values(df: DataFrame, col: str, mapping: dict) -> DataFrame:
    """PRJ-11: replace listed values, keep the others."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(F.col(col) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(F.col(col) == F.lit(k), F.lit(v)))
    return df.withColumn(col, expr.otherwise(F.col(col)))


def add_seasons(df: DataFrame, date_col: str = "OrderDate") -> DataFrame:
    """PRJ-12 (``Season``) and PRJ-13 (``SeasonMeteorological``)."""
    return df.withColumns({"Season": RF.season_fiscal(date_col),
                           "SeasonMeteorological": RF.season_meteorological(date_col)})


def add_sales_channel(df: DataFrame, category: str = "SalesChannelCategory") -> DataFrame:
    """PRJ-14."""
    return df.withColumn("SalesChannel", RF.sales_channel(category))


def add_distribution_center(df: DataFrame, state: str = "State") -> DataFrame:
    """PRJ-15."""
    return df.withColumn("DistributionCenter", RF.distribution_center(state))


def add_days_since(df: DataFrame, reference_date: str, date_col: str = "OrderDate",
                   name: str = "daysSinceLastOrder") -> DataFrame:
    """PRJ-16: reference date is a required parameter."""
    return df.withColumn(name, RF.days_since(reference_date, date_col))


# --- filters ---------------------------------------------------------------

def drop_null_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """FLT-1 (NaN counts as missing, as in pandas)."""
    cond = F.lit(True)
    for c in cols:
        dtype = dict(df.dtypes)[c]
        ok = F.col(c).isNotNull()
        if dtype in ("double", "float"):
            ok = ok & ~F.isnan(F.col(c))
        cond = cond & ok
    return df.where(cond)


def valid_postal_code(df: DataFrame, col: str = "PostalCode") -> DataFrame:
    """FLT-2: five digits and not '00000'."""
    c = F.col(col)
    return df.where((F.length(c) == 5) & (c != "00000") & c.rlike("^[0-9]{5}$"))


def in_list(df: DataFrame, col: str, values: list) -> DataFrame:
    """FLT-3."""
    return df.where(F.col(col).isin(values))


def year_equals(df: DataFrame, year: int, col: str = "OrderDate") -> DataFrame:
    """FLT-4 as a range predicate (reaches the parquet scan)."""
    return df.where(RF.year_range(col, year))


def min_quantity(df: DataFrame, minimum: float = 1.0, col: str = "Quantity",
                 fill: float | None = 1.0) -> DataFrame:
    """FLT-5 (after filling null quantities with ``fill``)."""
    if fill is not None:
        df = df.fillna({col: fill})
    return df.where(F.col(col) >= minimum)


def not_in_future(df: DataFrame, run_date: str, col: str = "OrderDate") -> DataFrame:
    """FLT-6: keep dates on or before ``run_date``."""
    return df.where(F.col(col) <= F.lit(run_date).cast("date"))


def equals_filter(df: DataFrame, col: str, value, negate: bool = False) -> DataFrame:
    """FLT-7."""
    cond = F.col(col) == F.lit(value)
    return df.where(~cond if negate else cond)


def range_filter(df: DataFrame, col: str, low=None, high=None) -> DataFrame:
    """FLT-8: inclusive bounds, either may be omitted."""
    cond = F.lit(True)
    if low is not None:
        cond = cond & (F.col(col) >= low)
    if high is not None:
        cond = cond & (F.col(col) <= high)
    return df.where(cond)


def date_split(df: DataFrame, split_date: str, col: str = "OrderDate",
               inclusive_train: bool = False) -> tuple[DataFrame, DataFrame]:
    """FLT-9: train ``< split``, test ``> split``; the split date itself falls
    in neither unless ``inclusive_train``."""
    d = F.lit(split_date).cast("date")
    train = df.where(F.col(col) <= d) if inclusive_train else df.where(F.col(col) < d)
    return train, df.where(F.col(col) > d)


# --- de-duplication ----------------------------------------------------------

def dedupe_first(df: DataFrame, keys: list[str] | None = None,
                 order: list[str] | None = None) -> DataFrame:
    """AGG-16: one row per key; the kept row is the smallest by ``order``
    (default: all other columns), so the result is deterministic.

    Written as ``groupBy(keys).agg(min(struct(...)))``: partial aggregation
    runs before the shuffle, so a key shared by many rows never gathers
    them in one task.
    """
    keys = keys or DEDUPE_KEYS
    rest = [c for c in df.columns if c not in keys]
    order = order or rest
    tail = [c for c in rest if c not in order]
    packed = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(f"`{c}`").alias(f"t{i}") for i, c in enumerate(tail)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    cols = []
    for c in df.columns:
        if c in keys:
            cols.append(F.col(f"`{c}`"))
        elif c in order:
            cols.append(F.col(f"_first.o{order.index(c)}").alias(c))
        else:
            cols.append(F.col(f"_first.t{tail.index(c)}").alias(c))
    return agg.select(*cols)


def duplicates_keep_all(df: DataFrame, keys: list[str]) -> DataFrame:
    """WIN-7: every row whose key occurs more than once.

    Counted with an aggregation and joined back (no per-key window buffer):
    the count side has one row per key, partial-aggregated before the shuffle.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")).where(F.col("_cnt") > 1)
    return df.join(counts.drop("_cnt"), keys, "left_semi")


def initial_cleaning(df: DataFrame) -> DataFrame:
    """JOB-1 step: rename, drop rows without city/postal code, keep valid codes,
    parse the date, add season and channel, keep known channels, drop rows
    without revenue.  Rows with an unparsable date are dropped too (ANSI-safe)."""
    return clean_places(clean_lines(rename_columns(df, RAW_TO_CANONICAL)))


def clean_lines(df: DataFrame) -> DataFrame:
    """The part of :func:`initial_cleaning` on columns of the invoice line: date, season, revenue."""
    df = df.withColumn("OrderDate", RF.parse_yyyymmdd("OrderDate")).where(F.col("OrderDate").isNotNull())
    df = df.withColumn("Season", RF.season_fiscal("OrderDate"))
    return drop_null_rows(df, ["NetRevenue"])


def clean_places(df: DataFrame) -> DataFrame:
    """The part of :func:`initial_cleaning` on columns of the customer: city, postal code, channel."""
    df = drop_null_rows(df, ["City", "PostalCode"])
    df = valid_postal_code(df)
    df = add_sales_channel(df)
    return in_list(df, "SalesChannel", RF.SALES_CHANNELS)


def with_column_order(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in cols])


def col_or(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
