"""Hourly weather: daily aggregates and the nearest hour to an overpass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_weather(hourly: DataFrame) -> DataFrame:
    """Aggregates by UTC day; the precipitation of a day without values is 0."""
    return hourly.groupBy(F.to_date("datetime").alias("date")).agg(
        F.avg("temperature_2m").alias("temp_mean"),
        F.max("temperature_2m").alias("temp_max"),
        F.min("temperature_2m").alias("temp_min"),
        F.avg("relative_humidity_2m").alias("rh_mean"),
        F.avg("wind_speed_10m").alias("wind_speed_mean"),
        F.max("wind_speed_10m").alias("wind_speed_max"),
        F.coalesce(F.sum("precipitation"), F.lit(0.0)).alias("precip_total"),
        F.avg("cloud_cover").alias("cloud_cover_mean"),
        F.avg("surface_pressure").alias("pressure_mean"),
    )


def nearest_hour(hourly: DataFrame, dates: DataFrame, *, hour: int = 5, tolerance_hours: int = 3) -> DataFrame:
    """For each date the row at the hour, else the nearest within the tolerance (the earlier of two); others are dropped.

    A target meets the hours around it in an equi-join on the hour; ``hours_offset`` is null for an exact match.
    """
    target = F.to_timestamp("date") + F.make_dt_interval(F.lit(0), F.lit(hour))
    t = dates.select("date").distinct().withColumn("target", target)
    spread = F.sequence(F.lit(-tolerance_hours - 1), F.lit(tolerance_hours))
    t = t.withColumn("h", F.explode(spread)).withColumn("slot", F.floor(F.unix_timestamp("target") / 3600) + F.col("h"))
    h = hourly.withColumn("slot", F.floor(F.unix_timestamp("datetime") / 3600))
    away = F.abs(F.unix_timestamp("datetime") - F.unix_timestamp("target"))
    near = t.join(h, "slot").withColumn("away", away).where(F.col("away") <= 3600 * tolerance_hours)
    names = [c for c in hourly.columns if c != "datetime"]
    best = near.groupBy("date").agg(F.min_by(F.struct("datetime", "away", *names), F.struct("away", "datetime")).alias("b"))
    offset = F.when(F.col("b.away") > 0, F.col("b.away") / 3600.0).alias("hours_offset")
    return best.select("date", F.col("b.datetime").alias("datetime_utc"), *[F.col(f"b.{c}").alias(c) for c in names], offset)


def matched_weather(hourly: DataFrame, dates: DataFrame, **kw) -> DataFrame:
    """The overpass row of each date with the day's aggregates."""
    return nearest_hour(hourly, dates, **kw).join(daily_weather(hourly), "date", "left")
