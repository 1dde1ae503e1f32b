"""Signals over time: neighbouring dates, month mapping, interpolation, the choice of a source, and scene catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqgrid.functions.columns import month_index


def neighbour_dates(targets: DataFrame, available: DataFrame, days: int = 30) -> DataFrame:
    """Rows (date, prev, next): the nearest available dates within ``days`` on either side, the date itself left out."""
    t = targets.select("date").distinct()
    spread = t.withColumn("day", F.explode(F.sequence(F.date_sub("date", days), F.date_add("date", days)))).where("day <> date")
    hit = spread.join(available.select(F.col("date").alias("day")).distinct(), "day")
    near = hit.groupBy("date").agg(F.max(F.when(F.col("day") < F.col("date"), F.col("day"))).alias("prev"), F.min(F.when(F.col("day") > F.col("date"), F.col("day"))).alias("next"))
    return t.join(near, "date", "left")


def month_source(targets: DataFrame, sources: DataFrame, look_back: int = 12, keep: str = "last") -> DataFrame:
    """Rows (date, source_date): the source of the date's month, or of the latest month at most ``look_back`` before it."""
    pick = F.max("date") if keep == "last" else F.min("date")
    s = sources.groupBy(month_index(F.col("date")).alias("m")).agg(pick.alias("source_date"))
    t = targets.select("date").distinct()
    months = F.sequence(month_index(F.col("date")) - look_back, month_index(F.col("date")))
    best = t.withColumn("m", F.explode(months)).join(s, "m").groupBy("date").agg(F.max_by("source_date", "m").alias("source_date"))
    return t.join(best, "date", "left")


def interpolate(targets: DataFrame, observed: DataFrame, days: int = 30) -> DataFrame:
    """Values (cell, date, value, is_nodata) by linear interpolation in time between the neighbouring observed dates.

    Cells are those of the earlier date, or of the later one where there is no earlier; a cell that the later date lacks is
    missing.
    """
    near = neighbour_dates(targets, observed, days)
    p = observed.select("cell", F.col("date").alias("prev"), F.col("value").alias("pv"))
    n = observed.select("cell", F.col("date").alias("next"), F.col("value").alias("nv"))
    both = near.where("prev IS NOT NULL").join(p, "prev").join(n, ["cell", "next"], "left")
    w = F.date_diff("date", "prev") / F.date_diff("next", "prev")
    both = both.select("cell", "date", F.when(F.col("next").isNull(), F.col("pv")).otherwise(F.col("pv") * (1 - w) + F.col("nv") * w).alias("value"))
    late = near.where("prev IS NULL AND next IS NOT NULL").join(n, "next").select("cell", "date", F.col("nv").alias("value"))
    return both.unionByName(late).withColumn("is_nodata", F.col("value").isNull())


def choose_source(cells: DataFrame, observed: DataFrame, interpolated: DataFrame) -> DataFrame:
    """Observed before interpolated before blank, with the method that gave the value."""
    o = observed.select("cell", "date", F.col("value").alias("ov"))
    i = interpolated.select("cell", "date", F.col("value").alias("iv"))
    method = F.when(F.col("ov").isNotNull(), "observed").when(F.col("iv").isNotNull(), "interpolated").otherwise("blank")
    return cells.join(o, ["cell", "date"], "left").join(i, ["cell", "date"], "left").select("cell", "date", F.coalesce("ov", "iv").alias("value"), method.alias("method"))


def clearest_by_month(scenes: DataFrame, max_cloud: float) -> DataFrame:
    """The date with the least cloud of each month, the earliest of equals."""
    ok = scenes.where(F.col("cloud") < max_cloud)
    return ok.groupBy(F.to_date(F.trunc("date", "MM")).alias("month")).agg(F.min_by("date", F.struct("cloud", "date")).alias("date"), F.min("cloud").alias("cloud"))


def clear_dates(scenes: DataFrame, max_cloud: float = 15) -> DataFrame:
    return scenes.where(F.col("cloud") < max_cloud).select("date").distinct()
