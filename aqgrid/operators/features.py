"""The training table: one row a cell and date, with every signal, the weather of the date and the cell's static columns."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqgrid.sources.tables import attach_signal


def assemble(cells: DataFrame, signals: dict[str, DataFrame], daily: DataFrame, static: list[DataFrame]) -> DataFrame:
    """``cells`` (grid_id, date) with ``signals`` by name (grid_id, date, value, is_nodata), ``daily`` by date and ``static``
    tables by grid_id. All are left joins on equality; the static ones come first, so that tables of ``bucketed`` are read as
    they lie and only the cells are dealt by grid_id, once for all of them."""
    out = cells
    for table in static:
        out = out.join(table, "grid_id", "left")
    for name, signal in signals.items():
        out = attach_signal(out, signal, name)
    return out.join(daily, "date", "left")


def bucketed(df: DataFrame, name: str, buckets: int, key: str = "grid_id") -> DataFrame:
    """Write a static table by buckets of its key, sorted; joins on the key then need no exchange of it. All static tables of
    one training table take the same number of buckets."""
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def static_join(spark: SparkSession, cells: DataFrame, names: list[str]) -> DataFrame:
    """Cells with bucketed tables, by merging sorted buckets."""
    for name in names:
        cells = cells.join(spark.table(name).hint("merge"), "grid_id", "left")
    return cells


def by_year(layers: DataFrame, value: str) -> DataFrame:
    """Yearly layers (grid_id, year, ``value``) as a static table: one row a cell with its layers in order of the years. Of several
    rows of a cell and year the greatest value counts."""
    one = layers.where(F.col("year").isNotNull()).groupBy("grid_id", "year").agg(F.max(value).alias(value))
    return one.groupBy("grid_id").agg(F.array_sort(F.collect_list(F.struct("year", value))).alias(f"{value}_layers"))


def as_of(cells: DataFrame, value: str, date: str = "date") -> DataFrame:
    """Replace the layers of ``by_year`` by the value of the date's year, or of the latest year before it that has a layer, and
    that year; null where all layers are later."""
    layers = F.col(f"{value}_layers")
    found = F.try_element_at(F.filter(layers, lambda x: x["year"] <= F.year(date)), F.lit(-1))
    return cells.withColumns({value: found[value], f"{value}_year": found["year"]}).drop(f"{value}_layers")


def assign_cells(sensors: DataFrame, grid: DataFrame, *, x0: float, y0: float, res: float) -> DataFrame:
    """Sensors (sensor_id, x, y) with the grid_id of the cell (ix, iy) that they lie in, lower and left edges included. Sensors
    without a place or outside the grid are left out."""
    at = lambda c, o: F.floor((F.col(c) - o) / res).cast("long")
    s = sensors.select("sensor_id", at("x", x0).alias("ix"), at("y", y0).alias("iy"))
    return s.join(grid.select("grid_id", F.col("ix").cast("long").alias("ix"), F.col("iy").cast("long").alias("iy")), ["ix", "iy"]).select("sensor_id", "grid_id").distinct()


def cell_readings(readings: DataFrame, assigned: DataFrame) -> DataFrame:
    """PM2.5 by cell and date: the mean of the cell's sensors that have a reading, and the samples behind it."""
    r = readings.where("pm25 IS NOT NULL").join(assigned, "sensor_id")
    return r.groupBy("grid_id", "date").agg(F.avg("pm25").alias("pm25"), F.sum("sample_count").cast("long").alias("sample_count"))


def training_table(
    cells: DataFrame, dates: DataFrame, *, bands: DataFrame, layers: list[str], signals: dict[str, DataFrame], daily: DataFrame, measured: DataFrame, static: list[str], rows: int = 2_000_000
) -> DataFrame:
    """Every one of the ``cells`` (grid_id) by every one of the ``dates`` (date), with ``bands`` (grid_id, date, and what is computed
    of them), the bucketed tables ``static`` by name, the as-of value of each of their yearly ``layers``, the ``signals``, the
    weather of the date and PM2.5 where a sensor of the cell measured it.

    Most cells have nothing of their own on most dates. So what they have is brought to a list for each cell and year, of several
    rows of a cell and date the greatest value counts, and the rows of all dates come out of these lists, about ``rows`` in a
    task: none of them is shuffled or sorted."""
    own = [bands, measured, *[d.select("grid_id", "date", F.col("value").alias(name), F.col("is_nodata").alias(f"{name}_is_nodata")) for name, d in signals.items()]]
    flags = {f"{name}_is_nodata" for name in signals}
    year = F.coalesce(F.year("date"), F.lit(0)).alias("year")
    asked = dates.select("date").distinct()
    calendar = asked.groupBy(year).agg(F.collect_list(F.struct("date")).alias("days")).select("year", F.col("days.date").alias("days"))
    years = {r["year"]: r["n"] for r in calendar.select("year", F.size("days").alias("n")).collect()}
    parts = max(cells.sparkSession.sparkContext.defaultParallelism, -(-cells.count() * sum(years.values()) // rows))
    stacked = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), own).join(F.broadcast(asked), "date", "left_semi")
    values = [c for c in stacked.columns if c not in ("grid_id", "date")]
    one = stacked.withColumn("year", year).repartition(parts, "grid_id", "year").groupBy("grid_id", "year", "date").agg(*[F.max(c).alias(c) for c in values])
    known = one.groupBy("grid_id", "year").agg(F.collect_list(F.struct("date", *values)).alias("known"))
    out = static_join(cells.sparkSession, cells, static)
    kept = [c for c in out.columns if c not in ("grid_id", *[f"{value}_layers" for value in layers])]
    out = out.withColumn("year", F.explode(F.array(*map(F.lit, years)).cast("array<int>"))).join(F.broadcast(calendar), "year").withColumn("date", F.get("days", F.lit(0)))
    for value in layers:
        out = as_of(out, value)
        kept += [value, f"{value}_year"]
    out = out.drop("date").join(known, ["grid_id", "year"], "left")
    own_days = F.coalesce("known.date", F.array().cast("array<date>"))
    out = out.select("grid_id", *kept, "known", F.posexplode(F.concat(own_days, F.array_except("days", own_days))).alias("at", "date"))
    found = lambda c: F.get("known", F.col("at"))[c]
    out = out.select("grid_id", "date", *kept, *[F.coalesce(found(c), F.lit(True)).alias(c) if c in flags else found(c).alias(c) for c in values])
    first, last = [c for c in bands.columns if c not in ("grid_id", "date")], [c for c in measured.columns if c not in ("grid_id", "date")]
    weather = [c for c in daily.columns if c != "date"]
    return out.join(F.broadcast(daily), "date", "left").select("grid_id", "date", *first, *kept, *[c for name in signals for c in (name, f"{name}_is_nodata")], *weather, *last)
