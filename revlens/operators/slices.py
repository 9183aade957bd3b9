"""Jobs whose every row is shuffled several times, done in slices of a key.

All shuffle files of one plan lie on disk until the plan has ended.  In slices of a key's
hash only one slice's files lie there; what is kept is the written, columnar result.  The
input is read once a slice, with the slice's filter pushed to the scans that hold the key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SLICE_BYTES = 32 << 20
MAX_SLICES = 8


def input_bytes(df: DataFrame) -> int:
    """Size of the tables under ``df`` as Spark knows it without a job; rows that are in no file count as very many."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def slice_count(df: DataFrame) -> int:
    """A slice for each ``SLICE_BYTES`` of input, at most ``MAX_SLICES``: their share of the disk is small then."""
    return min(MAX_SLICES, max(1, -(-input_bytes(df) // SLICE_BYTES)))


def written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    # Spark deletes shuffle files when the driver collects the garbage that still points to them
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def in_slices(rows: DataFrame, key: str, n: int, work: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``work`` over the slices of ``rows`` by the hash of ``key``, each written before the next begins.

    Right for any ``work`` that never puts together rows with different keys.  One slice
    (``n`` is 1) is the lazy ``work(rows)``.
    """
    if n == 1:
        return work(rows)
    path = new_path(rows.sparkSession, name)
    for i in range(n):
        part = work(rows.where(F.pmod(F.xxhash64(key), F.lit(n)) == i))
        written(part, f"{path}/{i}")
    return rows.sparkSession.read.schema(part.schema).parquet(*[f"{path}/{i}" for i in range(n)])
