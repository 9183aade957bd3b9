"""Written stages in the shared folder, and connected components on them."""

from __future__ import annotations

import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# Parquet looks at sizes after each 100 rows only, and pages and row groups are held whole.
ROW_BY_ROW = {"parquet.block.row.count.limit": 1, "parquet.page.row.count.limit": 1, "parquet.enable.dictionary": "false"}


def stage(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write once, read back: cuts lineage and survives lost executors.

    With ``large_rows`` (megabytes each) every row is written and read by itself, so that
    neither side's memory grows with the rows of a task.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.options(**ROW_BY_ROW if large_rows else {}).parquet(path)
    release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of what has been written.

    It deletes them when the driver collects the garbage that still points to them; by itself
    that may not happen during a whole job of many written steps.
    """
    spark.sparkContext._jvm.System.gc()


ROWS_A_TASK = 1 << 14


def narrow(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in a task for each ``ROWS_A_TASK`` of about ``rows`` narrow rows, one a core at least.

    Steps over few rows are repeated many times; a task for each shuffle partition would
    then cost far more than its rows.  It never adds tasks.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK)))


ID_BITS = 21


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """Bit table of fixed size (``2**ID_BITS`` bits) with the crc32 of every id of ``ids(doc_id)``.

    A scan can drop most other rows with it before any shuffle; an exact join
    has to follow.
    """
    slot = F.shiftright(F.crc32(F.col("doc_id").cast("string").cast("binary")), 32 - ID_BITS)
    rows = narrow(ids.select(F.shiftright(slot, 5).alias("w"), slot.alias("slot")).groupBy("w")
                  .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 31 as int))")).alias("m")), 1 << (ID_BITS - 5)).collect()
    out = np.zeros(1 << (ID_BITS - 5), np.uint32)
    for w, m in rows:
        out[w] = m
    return out


def in_bitmap(table: np.ndarray, ids) -> np.ndarray:
    """Mask over a list of ids (None gives False)."""
    slot = np.array([0 if i is None else zlib.crc32(str(i).encode()) >> (32 - ID_BITS) for i in ids], np.int64)
    known = np.array([i is not None for i in ids], bool)
    return known & ((table[slot >> 5] >> (slot & 31).astype(np.uint32)) & np.uint32(1) == 1)


def connected_components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows ``(id, component)`` for every id in ``links(a, b)``; component = smallest id.

    Alternating large-star and small-star steps, each a partial aggregation
    and a join back, until a step changes nothing.  A self link or a null end
    is ignored; repeated links count once.  ``rows``: about how many links
    there are, if that is known; it decides the number of tasks alone.
    Both sides of a join are shuffled by its key anyway; as a merge join it
    stays in the narrow tasks and sends the driver nothing.
    """
    e = (links.where("a != b")
         .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    e = stage(e if rows is None else narrow(e, rows), "components")
    mark = _fingerprint(e)
    while mark[0]:
        rows = mark[0]
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = narrow(both.join(m.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u != v"), 2 * rows)
        large = narrow(large.distinct(), rows)
        m2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = narrow(large.join(m2.hint("merge"), "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                                  F.col("m").alias("v")), rows)
        e = stage(narrow(small.distinct(), rows), "components")
        now = _fingerprint(e)
        if now == mark:
            break
        mark = now
    # no root is below another one now
    roots = narrow(e.select(F.col("v").alias("id")).distinct(), mark[0]).select("id", F.col("id").alias("component"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _fingerprint(e: DataFrame):
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]
