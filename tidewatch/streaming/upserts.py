"""Streaming form of the incremental load: deduplicate within a watermark, then
replace the touched day partitions batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.load import TRANSFER_KEY, latest
from tidewatch.operators.storage import settle


def deduplicated(stream: DataFrame, *, time: str = "block_time", delay: str = "2 days") -> DataFrame:
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(TRANSFER_KEY))


def daily_counts(stream: DataFrame, *, time: str = "block_time", delay: str = "2 days") -> DataFrame:
    """Transfers and amount per token and day, final once the watermark passed."""
    day = F.window(time, "1 day")
    counted = stream.withWatermark(time, delay).groupBy("token", day.alias("w"))
    return counted.agg(F.count("*").alias("transfers"), F.sum("amount").alias("amount_total")).select(
        "token", F.to_date("w.start").alias("day"), "transfers", "amount_total"
    )


def upsert_days(stream: DataFrame, path: str, checkpoint: str, *, time: str = "block_time") -> StreamingQuery:
    """Each micro-batch merges into the day partitions it touches; the last
    arrival of a key wins, within a batch the latest and then the greatest row.
    Rewriting whole partitions makes a repeated batch harmless."""

    def merge(batch: DataFrame, epoch: int) -> None:
        spark: SparkSession = batch.sparkSession
        new = batch.withColumn("day", F.to_date(time)).withColumn("_epoch", F.lit(epoch))
        days = [r["day"] for r in new.select("day").distinct().collect()]  # the days of one batch
        if not days:
            return
        try:
            old = spark.read.parquet(path).where(F.col("day").isin(days)).withColumn("_epoch", F.lit(-1))
            new = new.unionByName(old.select(*new.columns))
        except Exception as e:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        key = ["day", *TRANSFER_KEY]
        whole = F.struct(*sorted(c for c in batch.columns if c not in key))
        merged = latest(new, key, ["_epoch", time, whole]).drop("_epoch")
        held = settle(merged, "upsert")  # its sources are overwritten next
        held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)

    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
