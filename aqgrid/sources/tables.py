"""Reading and writing: date lists, nested pages of measurements and weather, tables by date, and table upkeep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES = "sensor_id long, results array<struct<parameter:struct<id:int,name:string>,value:string,ts:string>>"
SENSORS = (
    "id long, name string, coordinates struct<latitude:double,longitude:double>, latest struct<coordinates:struct<latitude:double,longitude:double>>, "
    "datetimeFirst struct<utc:string>, datetimeLast struct<utc:string>"
)
# The hourly variables of a public weather interface.
HOURLY = (
    "temperature_2m",
    "relative_humidity_2m",
    "dewpoint_2m",
    "surface_pressure",
    "wind_speed_10m",
    "wind_direction_10m",
    "precipitation",
    "cloud_cover",
)


def parse_dates(lines: DataFrame, column: str = "value", distinct: bool = True) -> DataFrame:
    """Dates of a list with one ISO date a line; blanks, byte-order marks and text that is no date fall away."""
    d = lines.select(F.try_to_date(F.trim(F.regexp_replace(column, "﻿", ""))).alias("date")).where("date IS NOT NULL")
    return d.distinct() if distinct else d


def read_dates(spark: SparkSession, path: str, distinct: bool = True, sort: bool = False) -> DataFrame:
    """The dates of a file; one without any date raises."""
    d = parse_dates(spark.read.text(path), distinct=distinct)
    if d.isEmpty():
        raise ValueError(f"{path} has no dates")
    return d.orderBy("date") if sort else d


def read_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Parquet with only the named columns; a missing one raises."""
    df = spark.read.parquet(path)
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{path} has no columns {missing}")
    return df.select(*columns)


def flatten_measurements(pages: DataFrame, column: str = "json") -> DataFrame:
    """One row a measurement from pages of JSON; values that are no numbers become null."""
    rows = pages.select(F.from_json(column, PAGES).alias("p")).select("p.sensor_id", F.explode("p.results").alias("r"))
    return rows.select(
        "sensor_id",
        F.try_to_timestamp("r.ts").alias("ts"),
        F.col("r.parameter.id").alias("parameter_id"),
        F.col("r.parameter.name").alias("parameter_name"),
        F.col("r.value").try_cast("double").alias("value"),
    )


def _sensors(pages: DataFrame, column: str) -> DataFrame:
    s = pages.select(F.from_json(column, SENSORS).alias("s")).select("s.*")
    day = lambda c: F.to_date(F.try_to_timestamp(F.col(c)))
    at = lambda k: F.coalesce(F.col(f"latest.coordinates.{k}"), F.col(f"coordinates.{k}")).alias(k)
    return s.select("id", F.coalesce("name", F.lit("pm25_sensor")).alias("name"), at("latitude"), at("longitude"), day("datetimeFirst.utc").alias("first_date"), day("datetimeLast.utc").alias("last_date"))


def flatten_sensors(pages: DataFrame, column: str = "json") -> DataFrame:
    """Sensor registry from JSON; the latest coordinates go before the registered ones. Sensors without dates are left to
    ``sensor_rejects``."""
    return _sensors(pages, column).where("first_date IS NOT NULL AND last_date IS NOT NULL")


def sensor_rejects(pages: DataFrame, column: str = "json") -> DataFrame:
    """Sensors that ``flatten_sensors`` leaves out, with the reason."""
    s = _sensors(pages, column).where("first_date IS NULL OR last_date IS NULL")
    return s.select("id", "name", F.when(F.col("first_date").isNull(), "no first date").otherwise("no last date").alias("reason"))


def flatten_hourly(pages: DataFrame, column: str = "json") -> DataFrame:
    """Rows of hourly weather from parallel arrays; variables that a page lacks are null."""
    kind = "hourly struct<time:array<string>," + ",".join(f"{v}:array<double>" for v in HOURLY) + ">"
    h = pages.select(F.from_json(column, kind).alias("j")).select("j.hourly.*")
    rows = h.select(F.posexplode("time").alias("k", "t"), *HOURLY)
    return rows.select(F.try_to_timestamp("t").alias("datetime"), *[F.get(F.col(v), F.col("k")).alias(v) for v in HOURLY])


def sensor_ids(seed: DataFrame, column: str = "sensor_id") -> DataFrame:
    return seed.select(column).where(F.col(column).isNotNull()).distinct()


def write_by_date(df: DataFrame, path: str, keys: tuple[str, ...] = ("date",), order: tuple[str, ...] = ()) -> None:
    """Replace just the partitions that ``df`` holds."""
    d = df.repartition(*keys)
    d = d.sortWithinPartitions(*keys, *order) if order else d
    d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def pending(requested: DataFrame, done: DataFrame, key: str = "date", force: bool = False) -> DataFrame:
    """Units that are still to be processed."""
    return requested if force else requested.join(done.select(key).distinct(), key, "left_anti")


def attach_signal(features: DataFrame, signal: DataFrame, name: str, keys: tuple[str, ...] = ("grid_id", "date"), meta: dict[str, str] | None = None) -> DataFrame:
    """Features with a signal's value and flag; cells without a value get null and a true flag. ``meta`` goes to every row."""
    s = signal.select(*keys, F.col("value").alias(name), F.col("is_nodata").alias(f"{name}_is_nodata"))
    flag = F.coalesce(f"{name}_is_nodata", F.lit(True)).alias(f"{name}_is_nodata")
    said = [F.struct(*[F.lit(v).alias(k) for k, v in meta.items()]).alias(f"{name}_meta")] if meta else []
    return features.join(s, list(keys), "left").select(*features.columns, name, flag, *said)


def merge_dates(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("date").unionByName(b.select("date")).distinct()


def write_csv(df: DataFrame, path: str, drop: tuple[str, ...] = ("geometry",)) -> None:
    """CSV with a header, without the columns that have no plain form."""
    df.drop(*drop).write.mode("overwrite").option("header", True).csv(path)


def rejects(requested: DataFrame, done: DataFrame, reason: str, key: str = "date") -> DataFrame:
    """Units that gave no result, with the reason."""
    return pending(requested, done, key).select(key, F.lit(reason).alias("reason"))
