"""Rasters as pixel tables: sampling at points, composites, mosaics and neighbourhoods.

A pixel table has raster_id, band, row, col, value; its metadata one row a raster and band with x_origin, y_origin, res,
nodata, scale and offset. Origins are the upper left corner, rows go south.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqgrid.functions.columns import is_nodata, scaled
from aqgrid.operators.quantiles import exact_quantiles

KEYS = ["raster_id", "band"]


def cleaned(pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """Pixels with nodata as null and a flag, then scaled; raw values are masked first."""
    m = meta.select(*KEYS, "nodata", "scale", "offset")
    flag = is_nodata(F.col("value"), F.col("nodata"))
    d = pixels.join(F.broadcast(m), KEYS).withColumn("is_nodata", flag)
    value = F.when(~F.col("is_nodata"), scaled(F.col("value"), F.col("scale"), F.col("offset"))).alias("value")
    return d.select(*KEYS, "row", "col", value, "is_nodata")


def sample_nearest(points: DataFrame, pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """Each point with the value of every raster band's pixel around it; outside the raster the value is null and flagged.

    The metadata travels with every task: one row a raster and band, which the caller keeps to the rasters asked for."""
    m = meta.select(*KEYS, "x_origin", "y_origin", "res")
    at = points.crossJoin(F.broadcast(m))
    at = at.select(*points.columns, *KEYS, F.floor((F.col("y_origin") - F.col("y")) / F.col("res")).cast("int").alias("row"), F.floor((F.col("x") - F.col("x_origin")) / F.col("res")).cast("int").alias("col"))
    out = at.join(cleaned(pixels, meta), [*KEYS, "row", "col"], "left")
    return out.select(*points.columns, *KEYS, "value", F.coalesce("is_nodata", F.lit(True)).alias("is_nodata"))


def sample_bilinear(points: DataFrame, pixels: DataFrame, meta: DataFrame) -> DataFrame:
    """Weighted mean of the pixel centres around a point: four, two on the line between neighbours, one on a centre. Null
    unless all of them have values. Equal points are worked out once and each gets its row."""
    m = meta.select(*KEYS, "x_origin", "y_origin", "res")
    fy, fx = (F.col("y_origin") - F.col("_p.y")) / F.col("res") - 0.5, (F.col("_p.x") - F.col("x_origin")) / F.col("res") - 0.5
    once = points.select(F.struct(*points.columns).alias("_p")).groupBy("_p").agg(F.count("*").alias("_times"))
    at = once.crossJoin(F.broadcast(m)).select("_p", "_times", *KEYS, fy.alias("fy"), fx.alias("fx"))
    corner = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    at = at.withColumn("c", corner)
    part = lambda v, k: F.when(F.col(k) == 1, F.col(v) - F.floor(v)).otherwise(1 - (F.col(v) - F.floor(v)))
    at = at.select("_p", "_times", *KEYS, (F.floor("fy") + F.col("c.i")).cast("int").alias("row"), (F.floor("fx") + F.col("c.j")).cast("int").alias("col"), (part("fy", "c.i") * part("fx", "c.j")).alias("w"))
    at = at.where("w IS NULL OR w <> 0")  # a corner without weight may lie outside
    out = at.join(cleaned(pixels, meta), [*KEYS, "row", "col"], "left").groupBy("_p", "_times", *KEYS)
    full = F.count("value") == F.count("*")
    out = out.agg(F.when(full, F.sum(F.col("w") * F.col("value"))).alias("_v"), (~full).alias("_gone"))
    out = out.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return out.select("_p.*", *KEYS, F.col("_v").alias("value"), F.col("_gone").alias("is_nodata"))


def reproject(target: DataFrame, pixels: DataFrame, meta: DataFrame, to_source: Callable[[Column, Column], tuple[Column, Column]]) -> DataFrame:
    """Bilinear values of a raster at the pixel centres of another grid: ``target`` has row, col, x and y in its own
    coordinates, ``to_source`` turns them into those of the raster. Rows (row, col, raster_id, band, value, is_nodata)."""
    x, y = to_source(F.col("x"), F.col("y"))
    at = target.select("row", "col", x.alias("_x"), y.alias("_y")).select(F.col("row").alias("trow"), F.col("col").alias("tcol"), F.col("_x").alias("x"), F.col("_y").alias("y"))
    out = sample_bilinear(at, pixels, meta)
    return out.select(F.col("trow").alias("row"), F.col("tcol").alias("col"), *KEYS, "value", "is_nodata")


def composite(pixels: DataFrame, reducer: str = "median") -> DataFrame:
    """One value a pixel from several scenes; nulls don't count."""
    how = {"median": F.median("value"), "mean": F.avg("value"), "min": F.min("value"), "max": F.max("value")}[reducer]
    return pixels.groupBy("band", "row", "col").agg(how.alias("value"), F.count("value").alias("n_scenes"))


def mosaic(pixels: DataFrame, order: str) -> DataFrame:
    """The first non-null value of overlapping tiles, by ``order``."""
    return pixels.where("value IS NOT NULL").groupBy("band", "row", "col").agg(F.min_by("value", order).alias("value"))


def surface(dem: DataFrame, heights: DataFrame) -> DataFrame:
    """Terrain plus the largest building height of a pixel, or the terrain alone."""
    b = heights.groupBy("row", "col").agg(F.max("height").alias("height"))
    return dem.join(b, ["row", "col"], "left").select("row", "col", (F.col("value") + F.coalesce("height", F.lit(0.0))).alias("value"))


def topographic_position(pixels: DataFrame, radius: int, block: int = 256) -> DataFrame:
    """Value minus the mean, and the population deviation, over the pixels within a circle (its centre included).

    Blocks with a halo of the radius go to one task each. In a block the chords of the circle grow from their middle by one
    pixel to either side, each holding the count, mean and squared deviations of its pixels; the chord of a row joins the
    circle's moments once it has its width. So a pixel costs twice the radius, not its square, and equal values have a deviation
    of exactly 0. Missing pixels don't count. Of pixels at one place the mean counts.
    """
    import math

    import numpy as np
    import pandas as pd

    near = lambda c: F.sequence(F.floor((F.col(c) - radius) / block), F.floor((F.col(c) + radius) / block))
    once = pixels.where("value IS NOT NULL").groupBy("row", "col").agg(F.avg("value").alias("value"))
    dealt = once.withColumn("bi", F.explode(near("row"))).withColumn("bj", F.explode(near("col")))
    of_width: dict[int, list[int]] = {}
    for i in range(-radius, radius + 1):
        of_width.setdefault(math.isqrt(radius * radius - i * i), []).append(i)

    def joined(a: tuple, b: tuple) -> tuple:
        """Count, mean and squared deviations of two disjoint sets."""
        n = a[0] + b[0]
        d, share = b[1] - a[1], np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
        return n, a[1] + d * share, a[2] + b[2] + d * d * a[0] * share

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0, size = key[0] * block - radius, key[1] * block - radius, block + 2 * radius
        n, mean = np.zeros((size, size)), np.zeros((size, size))
        i, j = pdf["row"].to_numpy() - r0, pdf["col"].to_numpy() - c0
        n[i, j], mean[i, j] = 1, pdf["value"].to_numpy()
        shifted = lambda j: (n[:, j : j + block], mean[:, j : j + block], 0.0)
        chord = (n[:, radius : radius + block], mean[:, radius : radius + block], np.zeros((size, block)))
        zero = np.zeros((block, block))
        circle = (zero, zero, zero)
        for w in range(radius + 1):
            if w:
                chord = joined(joined(chord, shifted(radius - w)), shifted(radius + w))
            for i in of_width.get(w, ()):
                circle = joined(circle, tuple(x[radius + i : radius + i + block] for x in chord))
        own = slice(radius, radius + block)
        i, j = np.nonzero(n[own, own])
        tpi, std = mean[own, own][i, j] - circle[1][i, j], np.sqrt(circle[2][i, j] / circle[0][i, j])
        return pd.DataFrame({"row": i + r0 + radius, "col": j + c0 + radius, "tpi": tpi, "focal_std": std})

    kinds = ", ".join(f"{c} {pixels.schema[c].dataType.simpleString()}" for c in ("row", "col"))
    return dealt.groupBy("bi", "bj").applyInPandas(run, f"{kinds}, tpi double, focal_std double")


def horizon_svf(dsm: DataFrame, *, res: float, radius: float, directions: int = 4, block: int = 256) -> DataFrame:
    """Mean sin2 of the horizon angles of each pixel, and the sky-view factor 1 - that.

    Blocks with a halo of the radius go to one task each; in it every direction and step is one shifted array. A horizon is
    the largest elevation angle on the way out, at least 0; bilinear values between pixels; missing pixels count as none.
    """
    import math

    import numpy as np
    import pandas as pd

    steps = int(radius / res)
    halo = steps + 1
    near = lambda c: F.sequence(F.floor((F.col(c) - halo) / block), F.floor((F.col(c) + halo) / block))
    dealt = dsm.where("value IS NOT NULL").withColumn("bi", F.explode(near("row"))).withColumn("bj", F.explode(near("col")))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = key[0] * block, key[1] * block
        size = block + 2 * halo
        z = np.full((size, size), np.nan)
        z[pdf["row"].to_numpy() - r0 + halo, pdf["col"].to_numpy() - c0 + halo] = pdf["value"].to_numpy()
        own = z[halo : halo + block, halo : halo + block]
        total = np.zeros_like(own)
        for d in range(directions):
            a = 2 * math.pi * d / directions
            best = np.zeros_like(own)
            for s in range(1, steps + 1):
                y, x = round(-s * math.cos(a), 9), round(s * math.sin(a), 9)
                fy, fx = math.floor(y), math.floor(x)
                wy, wx = y - fy, x - fx
                v = np.zeros_like(own)
                for i, j, w in ((0, 0, (1 - wy) * (1 - wx)), (1, 0, wy * (1 - wx)), (0, 1, (1 - wy) * wx), (1, 1, wy * wx)):
                    if w:
                        v = v + w * z[halo + fy + i : halo + fy + i + block, halo + fx + j : halo + fx + j + block]
                best = np.fmax(best, np.arctan((v - own) / (s * res)))
            total += np.sin(best) ** 2
        i, j = np.nonzero(~np.isnan(own))
        m = total[i, j] / directions
        return pd.DataFrame({"row": i + r0, "col": j + c0, "horizon_sin2_mean": m, "svf": np.clip(1 - m, 0, 1)})

    return dealt.groupBy("bi", "bj").applyInPandas(run, "row long, col long, horizon_sin2_mean double, svf double")


def relief(pixels: DataFrame, res: float) -> DataFrame:
    """Gradient magnitude by central differences and the range within the 3 x 3 window of each pixel."""
    d = pixels.where("value IS NOT NULL")
    o = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    spread = d.withColumn("o", o).select((F.col("row") - F.col("o.i")).alias("row"), (F.col("col") - F.col("o.j")).alias("col"), "value", "o")
    at = lambda i, j: F.max(F.when((F.col("o.i") == i) & (F.col("o.j") == j), F.col("value")))
    w = spread.groupBy("row", "col").agg((F.max("value") - F.min("value")).alias("range"), ((at(0, 1) - at(0, -1)) / (2 * res)).alias("gx"), ((at(1, 0) - at(-1, 0)) / (2 * res)).alias("gy"))
    return d.select("row", "col").join(w, ["row", "col"]).select("row", "col", F.hypot("gx", "gy").alias("gradient"), "range")


def looks_like_surface(pixels: DataFrame, res: float, *, least_range: float = 3.0, least_share: float = 0.1) -> DataFrame:
    """Whether heights look like a surface model with buildings: enough windows have a range of a storey or more."""
    shape = relief(pixels, res)
    found = exact_quantiles(shape, "range", (0.95,)).first()
    r = shape.agg(F.avg((F.col("range") >= least_range).cast("double")).alias("share"), F.avg("gradient").alias("mean_gradient"))
    return r.withColumns({"p95_range": F.lit(found["q"][0] if found else None).cast("double"), "is_surface": F.col("share") >= least_share})
