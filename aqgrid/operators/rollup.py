"""Summaries of estimates: by city, on coarser grids, along roads and routes, and the latest model version."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def city_summary(estimates: DataFrame) -> DataFrame:
    """Mean, sample variance and the 95 % interval of the mean (1.96 standard errors) by city and date."""
    s = estimates.groupBy("city_id", "date").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("variance"))
    half = 1.96 * F.sqrt(F.col("variance") / F.col("n"))
    return s.select("*", (F.col("mean") - half).alias("ci_low"), (F.col("mean") + half).alias("ci_high"))


def coarser(cells: DataFrame, factor: int = 3) -> DataFrame:
    """Means over blocks of factor x factor cells."""
    return cells.groupBy(F.floor(F.col("ix") / factor).alias("cx"), F.floor(F.col("iy") / factor).alias("cy")).agg(F.avg("value").alias("value"), F.count("value").alias("n"))


def hex_cells(points: DataFrame, size: float) -> DataFrame:
    """Points (x, y) with the axial coordinates q, r of the hexagon (pointy top, edge ``size``) that they lie in."""
    q = (math.sqrt(3) / 3 * F.col("x") - F.col("y") / 3) / size
    r = 2.0 / 3 * F.col("y") / size
    rq, rr, rs = F.floor(q + 0.5), F.floor(r + 0.5), F.floor(-q - r + 0.5)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs + q + r)
    fixed_q = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    fixed_r = F.when((dr >= dq) & (dr > ds), -rq - rs).otherwise(rr)
    return points.withColumns({"q": fixed_q.cast("long"), "r": fixed_r.cast("long")})


def coarser_hex(points: DataFrame, size: float) -> DataFrame:
    """Means of ``value`` over hexagons."""
    return hex_cells(points, size).groupBy("q", "r").agg(F.avg("value").alias("value"), F.count("value").alias("n"))


def edge_means(clipped: DataFrame, values: DataFrame) -> DataFrame:
    """Length-weighted mean of tile values along each road edge."""
    both = clipped.join(values, ["i", "j"])
    return both.groupBy("feature_id").agg((F.sum(F.col("length") * F.col("value")) / F.sum("length")).alias("value"), F.sum("length").alias("length"))


def route_exposure(routes: DataFrame, edges: DataFrame) -> DataFrame:
    """Sum of length times value over the edges of each route, and the routes' rank within a trip."""
    from pyspark.sql import Window

    r = routes.join(edges, "feature_id").groupBy("trip_id", "route_id").agg(F.sum(F.col("length") * F.col("value")).alias("exposure"))
    return r.withColumn("rank", F.rank().over(Window.partitionBy("trip_id").orderBy("exposure")).cast("long"))


def latest_version(results: DataFrame, keys: list[str]) -> DataFrame:
    rest = [c for c in results.columns if c not in keys]
    best = results.groupBy(*keys).agg(F.max_by(F.struct(*rest), "version").alias("r"))
    return best.select(*keys, "r.*")
