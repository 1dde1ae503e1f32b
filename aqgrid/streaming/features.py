"""Readings that arrive late change the substitutes of other dates, too: a stream that refreshes the dates it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqgrid.operators import readings
from aqgrid.sources import dated

MEASURED = "sensor_id long, ts timestamp, parameter_id int, parameter_name string, value double, date date"
REFRESHED = "sensor_id long, date date, pm25 double, sample_count long, actual_date date, fallback_type string, days_offset long"


def around(dates: DataFrame, window_days: int = 7, seasonal: bool = True) -> DataFrame:
    """The dates whose search may find one of these: those within the window, and the same day of the years beside. A date that
    meets another one by clipping a month's length is left to the search itself, which then doesn't find it."""
    days = [F.date_add("date", k) for k in range(-window_days, window_days + 1)]
    days += [F.add_months("date", 12 * y) for y in (-1, 1)] if seasonal else []
    return dates.select(F.explode(F.array(*days)).alias("date")).distinct()


def refresh(spark: SparkSession, batch: DataFrame, number: str, targets: DataFrame, store: str, *, window_days: int = 7, min_samples: int = 3) -> None:
    """Keep a batch of measurements, then work out anew every target date that it touches and swap those dates in.

    Both steps take the batch's token once: a repeated batch finds its measurements kept, works the same dates out and leaves
    the same rows."""
    own = batch.select("sensor_id", "ts", "parameter_id", "parameter_name", "value", F.to_date("ts").alias("date"))
    dated.put(own, f"{store}/measured", token=number, replace=False)
    touched = own.select("date").distinct()
    asked = around(touched, window_days).join(targets.select("date").distinct(), "date", "left_semi")
    days = [r["date"] for r in asked.collect()]  # dates, not rows: a few years at most
    if not days:
        return
    sources = [r["date"] for r in around(asked, window_days).collect()]
    daily = readings.daily_mean(dated.read(spark, f"{store}/measured", MEASURED, sources))
    fresh = readings.with_fallback(targets.where(F.col("date").isin(days)), daily, window_days=window_days, min_samples=min_samples)
    dated.put(fresh.select("sensor_id", "date", "pm25", "sample_count", "actual_date", "fallback_type", "days_offset"), f"{store}/features", token=number, dates=days)


def refresh_stream(stream: DataFrame, targets: DataFrame, store: str, checkpoint: str, **options: int) -> None:
    """Refresh by the micro-batches of what is there, then stop. Later calls go on from the checkpoint."""
    spark = stream.sparkSession

    def put(batch: DataFrame, number: int) -> None:
        refresh(spark, batch, str(number), targets, store, **options)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
