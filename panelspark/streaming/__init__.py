"""Event-time streams: the same plans over streams and tables, idempotent sinks, chained ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Counts and sums per day and type; on a stream, days close once ``late`` has passed."""
    if events.isStreaming:
        events = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    day = F.window(F.col("ts").cast("timestamp"), "1 day")
    return events.groupBy(day.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 6).alias("v")).select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n", "v")


def deduplicated(events: DataFrame, key: str = "event_id", late: str = "1 day") -> DataFrame:
    """Each key once; on a stream the state is bounded by the watermark."""
    if not events.isStreaming:
        return events.dropDuplicates([key])
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def insert_absent(path: str, key: str):
    """A foreachBatch sink that appends keys not yet published, a null key being one like others.

    A batch is a partition that is written whole: run again, it replaces what it wrote before and adds
    nothing. Keys of other batches are looked up by their one column.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fs = spark._jvm.org.apache.hadoop.fs.Path(path)
        rows = batch.dropDuplicates([key])
        if fs.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs):
            there = spark.read.parquet(path).where(F.col("batch") != epoch).select(F.col(key).alias("published"))
            rows = rows.join(there, F.col(key).eqNullSafe(F.col("published")), "left_anti")
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={epoch}")

    return write


def broken_links(ledger: DataFrame, order: str, payload: str, previous: str, digest: str, chain: tuple[str, ...] = ()) -> DataFrame:
    """Rows of hash-chained logs, numbered one by one, whose link or digest doesn't hold, or whose predecessor is gone. Neighbours meet in an equi-join on the number, so a log of any length is checked in parallel."""
    earlier = ledger.select(*[F.col(c).alias(f"of {c}") for c in chain], (F.col(order) + 1).alias("next"), F.col(digest).alias("digest before"))
    on = F.col(order) == F.col("next")
    for c in chain:
        on &= F.col(c).eqNullSafe(F.col(f"of {c}"))
    joined = ledger.join(earlier, on, "left")
    fine = (F.col(previous) == F.coalesce("digest before", F.lit(""))) & (F.col(digest) == F.sha2(F.concat(F.col(previous), F.col(payload)), 256))
    return joined.where(~F.coalesce(fine, F.lit(False))).select(*ledger.columns)
