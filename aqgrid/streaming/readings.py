"""Daily means as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqgrid.functions.columns import accepted_pm25


def daily_mean_stream(measurements: DataFrame, late: str = "2 days") -> DataFrame:
    """Mean and count by sensor and day; a day is complete when the watermark has passed it."""
    ok = measurements.where(accepted_pm25(F.col("parameter_id"), F.col("parameter_name"), F.col("value")))
    days = ok.withWatermark("ts", late).groupBy("sensor_id", F.window("ts", "1 day"))
    return days.agg(F.avg("value").alias("pm25"), F.count("*").alias("sample_count")).select("sensor_id", F.to_date("window.start").alias("date"), "pm25", "sample_count")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there and stop; the sink is Parquet."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def refresh_by_date(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Add each micro-batch to the dates that its rows belong to. Below a date a batch has a partition of its own, which a
    repeated attempt replaces, so that rows of earlier batches stay and none is written twice."""

    def put(batch: DataFrame, number: int) -> None:
        own = batch.withColumn("batch", F.lit(number))
        own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch").parquet(path)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
