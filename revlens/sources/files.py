"""File-set readers: customer/postal CSVs, forecast CSV sets, forecast workbooks.

SRC-2..9.  Schemas are explicit (no inference); file names carry meaning
and are read from ``_metadata.file_path`` / the binary file source, never
by listing files on the driver and reading them one by one.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as RF
from ..operators import clean

CUSTOMER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                                ["Kunde_SK", "Ort", "PLZ-Code", "Branchengruppe",
                                 "Vertriebskanalkategorie", "Vertriebskanal"]])
POSTAL_SCHEMA = T.StructType([T.StructField("ort", T.StringType()), T.StructField("plz", T.IntegerType()),
                              T.StructField("bundesland", T.StringType())])
FORECAST_CSV_SCHEMA = T.StructType([T.StructField("Date", T.DateType()),
                                    T.StructField("Revenue", T.DoubleType()),
                                    T.StructField("Train", T.DoubleType()),
                                    T.StructField("Test", T.DoubleType()),
                                    T.StructField("Predict", T.DoubleType())])
GENERAL_COLUMNS = ["Date", "Quantity", "Train", "Test", "Predict", "Location"]
PRODUCT_COLUMNS = ["Date", "Quantity", "Train", "Test", "Predict", "ItemType", "Location"]
NUMERIC_COLUMNS = ["Quantity", "Train", "Test", "Predict"]
# Words removed from a workbook's base name.
NAME_NOISE = [".xlsx", "predictions", "2024"]
CLUSTER_TAGS = [("Cluster1", "1"), ("Cluster2", "2"), ("Cluster3", "3")]


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """SRC-1."""
    r = spark.read
    return (r.schema(schema) if schema else r).parquet(path)


def _by_header(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
               path_column: str | None = None) -> DataFrame:
    """CSV columns found by their header name, whatever their order; other columns are left out.

    A missing column is an error; text that does not fit its type becomes null.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = spark.read.option("enforceSchema", False).csv(path, sep=sep, header=True, encoding="UTF-8")
    names = [c.lstrip("\ufeff") for c in raw.columns]
    if path_column:
        raw = raw.select("*", F.col("_metadata.file_path"))
        names = [*names, path_column]
    raw = raw.toDF(*names)
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}, found {raw.columns}")
    return raw.select(*[F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})").alias(f.name) for f in schema],
                      *([path_column] if path_column else []))


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: ';' separated, UTF-8 (a BOM is dropped by the reader), all text so
    postal codes keep leading zeros."""
    return _by_header(spark, path, CUSTOMER_SCHEMA, sep=";")


def read_postal_reference(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: ',' separated reference with town, integer code and state.

    The header decides the column order; only the three needed columns are kept.
    """
    raw = spark.read.csv(path, sep=",", header=True, encoding="UTF-8")
    raw = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    return raw.select("ort", F.expr("try_cast(plz as int)").alias("plz"), "bundesland")


def read_plain_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                   sep: str = ",") -> DataFrame:
    """SRC-4 / SRC-6 (``sep=';'``)."""
    return _by_header(spark, path, schema, sep)


def read_csv_renamed(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    """SRC-5: header row replaced by the given names."""
    raw = spark.read.csv(path, sep=sep, header=True)
    return raw.toDF(*names)


def read_cluster_assignments(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5 + PRJ-11: (ID, cluster) with labels 0/1/2 shifted to 1/2/3."""
    df = read_csv_renamed(spark, path, ["ID", "cluster"])
    df = df.withColumn("cluster", F.expr("try_cast(cluster as int)"))
    return clean.recode_values(df, "cluster", {0: 1, 1: 2, 2: 3})


def read_forecast_csv_dir(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC-7: every CSV of a glob, tagged with the cluster named in its file
    name (first tag found, else ``Unknown``); actual revenue equal to the
    prediction becomes null (PRJ-9)."""
    df = _by_header(spark, pattern, FORECAST_CSV_SCHEMA, path_column="_path")
    tag = F.lit("Unknown")
    for needle, label in reversed(CLUSTER_TAGS):
        tag = F.when(F.col("_path").contains(needle), F.lit(label)).otherwise(tag)
    df = df.withColumn("Cluster", tag)
    for c in ["Revenue", "Train", "Test", "Predict"]:
        df = df.withColumn(c, RF.nan_to_null(c))
    df = clean.null_where_equal(df, "Revenue", "Predict")
    return df.drop("_path")


def forecast_total_by_cluster(df: DataFrame, clusters=("1", "2", "3")) -> DataFrame:
    """AGG-22: total ``Predict`` per listed cluster, 'No Data' when absent."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(c,) for c in clusters], "Cluster string")
    sums = df.groupBy("Cluster").agg(F.sum("Predict").alias("_s"))
    return (wanted.join(sums, "Cluster", "left")
                  .select("Cluster", F.coalesce(F.col("_s").cast("string"), F.lit("No Data")).alias("totalPredict")))


# --- workbooks -------------------------------------------------------------

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def decode_xlsx(content: bytes) -> pd.DataFrame:
    """First sheet of an .xlsx workbook as text cells (header = first row).

    Plain ``zipfile`` + XML: shared strings, inline strings and numbers.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            root = ElementTree.fromstring(z.read("xl/sharedStrings.xml"))
            for si in root.findall("m:si", _NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")))
        sheets = sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet"))
        root = ElementTree.fromstring(z.read(sheets[0]))
    rows = []
    for r in root.iter(f"{{{_NS['m']}}}row"):
        cells = {}
        for c in r.findall("m:c", _NS):
            t = c.get("t")
            v = c.find("m:v", _NS)
            if t == "s" and v is not None:
                val = shared[int(v.text)]
            elif t == "inlineStr":
                val = "".join(x.text or "" for x in c.iter(f"{{{_NS['m']}}}t"))
            else:
                val = v.text if v is not None else None
            cells[_col_index(c.get("r"))] = val
        if cells:
            width = max(cells) + 1
            rows.append([cells.get(i) for i in range(width)])
    if not rows:
        return pd.DataFrame()
    header, body = rows[0], rows[1:]
    width = len(header)
    return pd.DataFrame([(b + [None] * width)[:width] for b in body], columns=[str(h) for h in header])


def _excel_date(v):
    if v is None:
        return None
    try:
        x = float(v)
        return (pd.Timestamp("1899-12-30") + pd.Timedelta(days=x)).date()
    except (TypeError, ValueError):
        try:
            return pd.Timestamp(v).date()
        except (TypeError, ValueError):
            return None


def read_forecast_workbooks(spark: SparkSession, pattern: str, columns: list[str],
                            extract_item_type: bool = False, errors: list | None = None) -> DataFrame:
    """SRC-8 (+ FLT-10, STR-4..6, PRJ-5/9/10): workbooks whose lower-cased path
    contains 'predictions', decoded in ``mapInPandas`` (one task per file),
    tagged with location (and item type) from the file name.  Unreadable
    files yield no rows; they are listed by :func:`unreadable_workbooks`.
    """
    raw = (spark.read.format("binaryFile").load(pattern)
                .where(F.lower(F.col("path")).contains("predictions")))
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("Date", T.DateType())] +
                          [T.StructField(c, T.StringType()) for c in NUMERIC_COLUMNS])

    def decode(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    sheet = decode_xlsx(bytes(content))
                except Exception:  # noqa: BLE001 - unreadable file: skipped
                    continue
                out = pd.DataFrame({"path": path,
                                    "Date": [_excel_date(v) for v in sheet.get("Date", pd.Series(dtype=object))]})
                for c in NUMERIC_COLUMNS:
                    out[c] = sheet[c].astype(object).where(sheet[c].notna(), None) if c in sheet else None
                yield out

    df = raw.select("path", "content").mapInPandas(decode, schema)
    base = F.trim(_strip_noise(F.element_at(F.split("path", "/"), -1)))
    if extract_item_type:
        centres = list(RF.DISTRIBUTION_CENTRES) + [RF.DEFAULT_CENTRE]
        pattern_c = "(" + "|".join(re.escape(c) for c in centres) + ")"
        prefix = F.regexp_extract(base, f"^(.*?){pattern_c}", 1)
        item = F.regexp_replace(F.when(base.rlike(pattern_c), prefix).otherwise(base), r"[^\p{L}]", "")
        df = df.withColumn("ItemType", item).withColumn("Location", F.trim(F.replace(base, F.col("ItemType"), F.lit(""))))
    else:
        df = df.withColumn("Location", base)
    df = clean.coerce_numeric(df, NUMERIC_COLUMNS)
    df = df.withColumn("Quantity", F.when(F.col("Predict") == F.col("Quantity"), F.lit(None).cast("double"))
                       .otherwise(F.col("Quantity")))
    df = clean.zero_to_null_rounded(df, NUMERIC_COLUMNS)
    return df.select(*columns)


def unreadable_workbooks(spark: SparkSession, pattern: str) -> DataFrame:
    """Side table of workbook paths that match 'predictions' but cannot be decoded."""
    raw = (spark.read.format("binaryFile").load(pattern)
                .where(F.lower(F.col("path")).contains("predictions")))

    def check(batches):
        for pdf in batches:
            bad = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    decode_xlsx(bytes(content))
                except Exception as e:  # noqa: BLE001
                    bad.append((path, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(bad, columns=["path", "error"])

    return raw.select("path", "content").mapInPandas(check, "path string, error string")


def _strip_noise(c):
    for word in NAME_NOISE:
        c = F.replace(c, F.lit(word), F.lit(""))
    return c


def read_sql_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    """SRC-9: a catalog table (optionally its first rows)."""
    df = spark.table(name)
    return df.limit(limit) if limit else df
