"""Weekly sums over a stream of order lines or events (AGG-15, incremental).

The week label equals the batch operator's (``functions.week_start``): an
event is shifted back one day and put in a 7-day tumbling window anchored on
Mondays (the epoch is a Thursday, so the windows start four days later).
A watermark on the shifted event time bounds the state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as RF
from ..session import ensure_checkpoint_dir


def weekly_sum_stream(stream: DataFrame, keys: list[str], ts_col: str, values: list[str],
                      watermark: str = "14 days", money: tuple = ()) -> DataFrame:
    """Streaming (or batch) frame -> (keys, week, sums) per Monday-labelled week."""
    shifted = stream.withColumn("_t", F.col(ts_col).cast("timestamp") - F.expr("INTERVAL 1 DAY"))
    shifted = shifted.withWatermark("_t", watermark)
    win = F.window("_t", "7 days", "7 days", "4 days")
    aggs = [(F.sum(RF.money(v)) if v in money else F.sum(v)).alias(v) for v in values]
    out = shifted.groupBy(win.alias("_w"), *keys).agg(*aggs)
    return out.select(*keys, F.to_date(F.col("_w.start")).alias("week"),
                      *[(F.col(v).cast("double") if v in money else F.col(v)).alias(v) for v in values])


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over parquet files at ``path`` (a folder or a glob)."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def run_available(result: DataFrame, out_path: str | None = None, name: str = "weekly") -> DataFrame:
    """Process everything available now and return the final table.

    Complete mode: every micro-batch carries the whole (small: weeks x keys)
    result, which ``foreachBatch`` writes over a parquet folder; the
    streaming checkpoint and the output live under the session's shared
    checkpoint folder.
    """
    spark = result.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = f"{name}-{uuid.uuid4().hex[:8]}"
    out_path = out_path or f"{base}/{run}/out"

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (result.writeStream.outputMode("complete").foreachBatch(write)
               .option("checkpointLocation", f"{base}/{run}/state")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out_path)
