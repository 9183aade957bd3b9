"""Writers: parquet stages, catalog tables and CSV exports (SNK-1..4)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """SNK-1: overwrite one parquet data set (a stage / checkpoint of a job)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def publish_table(df: DataFrame, table: str, database: str | None = None,
                  preview: int = 5) -> DataFrame:
    """SNK-2/3: replace a catalog table and return its first ``preview`` rows.

    The rows are written to a table of another name first and take the old table's
    place by renaming, so a publish that fails leaves the old table as it was (``df`` may
    even read it).
    """
    spark = df.sparkSession
    prefix = f"{database}." if database else ""
    name, mark = prefix + table, uuid.uuid4().hex
    staged, old = f"{prefix}{table}__new_{mark}", f"{prefix}{table}__old_{mark}"
    try:
        df.write.saveAsTable(staged)
        known = spark.catalog.tableExists(name)
        if known:
            spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
        except Exception:
            if known:
                spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name).limit(preview)


def write_csv_export(df: DataFrame, path: str, sep: str = ";") -> str:
    """SNK-4: ';' separated CSV with header (Spark writes UTF-8 without a BOM)."""
    df.write.mode("overwrite").csv(path, sep=sep, header=True, encoding="UTF-8")
    return path
