"""Map features on square tiles: clipped road length and polygon area, points, dust and industrial indices.

Lines come as segments (feature_id, x1, y1, x2, y2), polygons as oriented ring edges (the same columns; holes run the other
way), points as (feature_id, x, y). Each is spread over the tiles that its box covers; the tile is the equi-key from then on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqgrid.functions.columns import confidence, dust_indices, industrial_raw
from aqgrid.operators import order
from aqgrid.operators.quantiles import exact_quantiles


def tiles(spark, nx: int, ny: int, cell: float = 30.0) -> DataFrame:
    """Tiles ``r{i}_c{j}`` with their lower left corner."""
    d = spark.range(nx * ny).select(F.expr(f"CAST(id DIV {nx} AS INT)").alias("i"), F.expr(f"CAST(id % {nx} AS INT)").alias("j"))
    return d.select(F.concat(F.lit("r"), "i", F.lit("_c"), "j").alias("tile_id"), "i", "j", (F.col("j") * cell).alias("x0"), (F.col("i") * cell).alias("y0"))


def tiles_within(spark, corners: list[tuple[float, float]], cell: float = 30.0) -> DataFrame:
    """Tiles over the box of a projected quadrilateral, those that meet it (its border counts). Corners run anticlockwise.

    Two convex shapes meet unless an axis keeps them apart: the sides of the box are dealt with by the count of tiles, and
    the normals of the four edges by a half-plane test on the tile's corner that lies furthest inside.
    """
    import math

    xs, ys = [x for x, _ in corners], [y for _, y in corners]
    x0, y0 = min(xs), min(ys)
    nx, ny = math.ceil((max(xs) - x0) / cell), math.ceil((max(ys) - y0) / cell)
    d = spark.range(nx * ny).select(F.expr(f"CAST(id DIV {ny} AS INT)").alias("j"), F.expr(f"CAST(id % {ny} AS INT)").alias("i"))
    d = d.select(F.concat(F.lit("r"), "j", F.lit("_c"), "i").alias("tile_id"), "i", "j", (x0 + F.col("j") * cell).alias("x0"), (y0 + F.col("i") * cell).alias("y0"))
    meets = F.lit(True)
    for (ax, ay), (bx, by) in zip(corners, [*corners[1:], corners[0]], strict=True):
        ex, ey = bx - ax, by - ay
        px = F.col("x0") + (cell if ey < 0 else 0.0)  # the corner with the largest cross product
        py = F.col("y0") + (cell if ex > 0 else 0.0)
        meets = meets & (ex * (py - ay) - ey * (px - ax) >= 0)
    return d.where(meets)


def merge_layers(layers: list[DataFrame]) -> DataFrame:
    """Layers one after the other; a column that a layer lacks is null there."""
    out = layers[0]
    for x in layers[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def centroids(spark, xmin: float, ymin: float, xmax: float, ymax: float, res: float = 30.0, max_cells: int | None = 3_000_000) -> DataFrame:
    """Cell centres, the first half a step inside, row by row; more than ``max_cells`` raise."""
    import math

    nx, ny = math.ceil((xmax - xmin) / res - 0.5), math.ceil((ymax - ymin) / res - 0.5)
    if max_cells is not None and nx * ny > max_cells:
        raise ValueError(f"{nx * ny} cells are more than {max_cells}")
    d = spark.range(nx * ny).select(F.expr(f"CAST(id % {nx} AS INT)").alias("ix"), F.expr(f"CAST(id DIV {nx} AS INT)").alias("iy"))
    return d.select("ix", "iy", (xmin + res / 2 + F.col("ix") * res).alias("x"), (ymin + res / 2 + F.col("iy") * res).alias("y"))


def inside(points: DataFrame, edges: DataFrame, *, key: str = "id", band: float = 1000.0) -> DataFrame:
    """Points within the boundary: an odd number of its edges lies to their right.

    Points and edges meet by bands of y, ``band`` high, as an equi-key; an edge goes to every band that it crosses. The rows
    of one key are one point.
    """
    floor = lambda c: F.floor(c / band).cast("long")
    e = edges.where("y1 <> y2").select("x1", "y1", "x2", "y2", F.explode(F.sequence(floor(F.least("y1", "y2")), floor(F.greatest("y1", "y2")))).alias("band"))
    p = points.select(key, "x", "y").dropDuplicates([key]).withColumn("band", floor(F.col("y")))
    above = (F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))
    at = F.col("x1") + (F.col("y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    hits = p.join(e, "band").where(above & (at > F.col("x"))).groupBy(key).agg(F.count("*").alias("n"))
    return points.join(hits.where("n % 2 = 1").select(key), key, "left_semi")


def dense_ids(grid: DataFrame) -> DataFrame:
    """``grid_id`` from 0, row by row: a running count over the rows of the grid, by ranges of rows, then a number within each
    row."""
    from pyspark.sql import Window

    per_row = grid.groupBy("iy").agg(F.count("*").alias("n"))
    start = order.running_sum(per_row, "iy", "n").select("iy", (F.col("running") - F.col("n")).alias("start"))
    within = F.row_number().over(Window.partitionBy("iy").orderBy("ix"))
    return grid.join(start, "iy").select((F.col("start") + within - 1).alias("grid_id"), "ix", "iy", "x", "y")


def _cells(lo: Column, hi: Column, cell: float, closed: bool) -> Column:
    first = F.ceil(lo / cell) - 1 if closed else F.floor(lo / cell)
    return F.sequence(first.cast("int"), F.floor(hi / cell).cast("int"))


def line_cells(segments: DataFrame, cell: float = 30.0, half_open: bool = False) -> DataFrame:
    """Segments with the tiles (i, j) that they may meet: in each column of tiles the rows between where the line enters and
    leaves it, a hair wider for rounding."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    low, high = F.least(y1, y2), F.greatest(y1, y2)
    slope, hair = F.try_divide(y2 - y1, x2 - x1), 1e-9 * (high - low) + 1e-9
    within = lambda x: F.greatest(F.least(x1, x2), F.least(F.greatest(x1, x2), x))

    def column(j: Column) -> Column:
        a, b = (y1 + slope * (within(x) - x1) for x in (j * cell, (j + 1) * cell))
        enter, leave = F.greatest(low, F.coalesce(F.least(a, b) - hair, low)), F.least(high, F.coalesce(F.greatest(a, b) + hair, high))
        return F.transform(_cells(enter, leave, cell, not half_open), lambda i: F.struct(i.alias("i"), j.alias("j")))

    # one list a segment, outside the compiled loop, which the clipping of its rows then fills alone
    tiles = F.flatten(F.transform(_cells(F.least(x1, x2), F.greatest(x1, x2), cell, not half_open), column))
    return segments.withColumn("_tile", F.explode(tiles)).select(*segments.columns, F.col("_tile.j").alias("j"), F.col("_tile.i").alias("i"))


def clip_lines(segments: DataFrame, cell: float = 30.0, half_open: bool = False) -> DataFrame:
    """Length of each segment within each tile, by Liang-Barsky; tiles are closed, so a segment on a shared edge counts in
    both, or half open."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    s = line_cells(segments, cell, half_open)
    near, far, out = [F.lit(0.0)], [F.lit(1.0)], F.lit(False)
    for a, d, lo in ((x1, x2 - x1, F.col("j") * cell), (y1, y2 - y1, F.col("i") * cell)):
        ahead = d >= 0  # few operations, so that the compiled loop stays small
        near.append(F.when(d != 0, (F.when(ahead, lo).otherwise(lo + cell) - a) / d).otherwise(0.0))
        far.append(F.when(d != 0, (F.when(ahead, lo + cell).otherwise(lo) - a) / d).otherwise(1.0))
        beyond = (a < lo) | ((a >= lo + cell) if half_open else (a > lo + cell))
        out = out | ((d == 0) & beyond)
    s = s.withColumn("length", F.when(out, 0.0).otherwise(F.least(*far) - F.greatest(*near)))
    return s.where("length > 0").withColumn("length", F.col("length") * F.hypot(x2 - x1, y2 - y1)).where("length > 0")


def clip_areas(edges: DataFrame, cell: float = 30.0) -> DataFrame:
    """Area of each polygon within each tile (feature_id, i, j, area), summed edge by edge.

    In each column of tiles an edge adds the signed integral of its height over a tile's lower side, clamped to the tile. In
    the rows that it crosses this is worked out; every row below gets one and the same amount, which is noted once, with the
    lowest row crossed. Those notes are summed from the top and spread over the rows between them, so that the work follows
    the border and the tiles covered, not the border times the height. All of it runs within parts dealt by the polygon.
    """
    from pyspark.sql import Window

    e = order.spread(edges, "feature_id").where("x1 <> x2")
    xa, xb = F.least("x1", "x2"), F.greatest("x1", "x2")
    e = e.withColumn("j", F.explode(_cells(xa, xb, cell, False)))
    e = e.withColumn("l", F.greatest(xa, F.col("j") * cell)).withColumn("r", F.least(xb, (F.col("j") + 1) * cell)).where("r > l")
    slope = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    at = lambda x: F.col("y1") + slope * (x - F.col("x1"))
    e = e.withColumn("yl", at(F.col("l"))).withColumn("yr", at(F.col("r"))).withColumn("w", F.col("r") - F.col("l"))
    e = e.select("feature_id", "j", "yl", "yr", "w", F.signum(F.col("x2") - F.col("x1")).alias("s"), _cells(F.least("yl", "yr"), F.greatest("yl", "yr"), cell, False).alias("rows"))
    base = F.col("i") * cell

    def positive(h: Column) -> Column:
        """Integral of max(y - h, 0) over the stretch."""
        a, b = F.col("yl") - h, F.col("yr") - h
        both = F.when((a >= 0) & (b >= 0), (a + b) / 2).when((a <= 0) & (b <= 0), 0.0)
        top = F.greatest(a, b)
        return F.col("w") * both.otherwise(F.try_divide(top * top, 2 * (top - F.least(a, b))))

    lowest = F.col("i") == F.col("rows")[0]
    e = e.withColumn("i", F.explode("rows"))
    e = e.select("feature_id", "i", "j", ((positive(base) - positive(base + cell)) * F.col("s")).alias("p"), F.when(lowest, F.col("s") * F.col("w") * cell).alias("d"))
    crossed = e.groupBy("feature_id", "j", "i").agg(F.sum("p").alias("p"), F.sum("d").alias("d"))
    # what the notes down to a row amount to, from the rows above it and with its own; the rows below the lowest note get nothing
    down = Window.partitionBy("feature_id", "j").orderBy(F.desc("i"))
    amount = lambda v: F.when(F.abs(v) > 1e-7, v).otherwise(0.0)
    crossed = crossed.withColumn("next", F.lead("i").over(down)).withColumn("sum", F.sum("d").over(down))
    crossed = crossed.withColumn("above", amount(F.coalesce(F.lag("sum").over(down), F.lit(0.0)))).withColumn("sum", amount(F.coalesce("sum", F.lit(0.0))))
    between = F.when((F.col("next") < F.col("i") - 1) & (F.col("sum") != 0), F.sequence(F.col("next") + 1, F.col("i") - 1)).otherwise(F.array().cast("array<int>"))
    own = F.array(F.struct("i", F.abs(F.col("p") + F.col("above")).alias("area")))
    out = crossed.withColumn("t", F.explode(F.concat(own, F.transform(between, lambda i: F.struct(i.alias("i"), F.abs("sum").alias("area"))))))
    return out.select("feature_id", "t.i", "j", "t.area").where("area > 1e-9")


def points_in_tiles(points: DataFrame, cell: float = 30.0) -> DataFrame:
    """Points strictly within a tile; those on an edge belong to none."""
    p = points.withColumn("i", F.floor(F.col("y") / cell).cast("int")).withColumn("j", F.floor(F.col("x") / cell).cast("int"))
    return p.where((F.col("x") > F.col("j") * cell) & (F.col("y") > F.col("i") * cell))


def dust(grid: DataFrame, roads: DataFrame, areas: DataFrame, points: DataFrame, cell: float = 30.0) -> DataFrame:
    """The dust columns of every tile; roads are clipped lines with weight and dusty, areas and points as clipped above."""
    r = roads.groupBy("i", "j").agg(F.sum("length").alias("total_road_m"), F.sum(F.when(F.col("dusty"), F.col("length")).otherwise(0.0)).alias("unpaved_road_m"), F.sum(F.col("length") * F.col("weight")).alias("road_weighted"))
    a = areas.groupBy("i", "j").agg(F.sum("area").alias("construction_area_m2"))
    p = points.groupBy("i", "j").agg(F.count("*").alias("construction_count"))
    d = grid.join(r, ["i", "j"], "left").join(a, ["i", "j"], "left").join(p, ["i", "j"], "left").fillna(0)
    made = dust_indices(F.col("total_road_m"), F.col("unpaved_road_m"), F.col("road_weighted"), F.col("construction_area_m2"), cell)
    return d.withColumns(made)


INDUSTRIAL = ("industrial_area_m2", "industrial_building_area_m2", "industrial_building_volume_m3", "landfill_area_m2", "quarry_area_m2")
COUNTS = ("industrial_building_count", "power_plant_count", "chimney_count", "industrial_poi_count", "industrial_contrib_count")


def industrial(grid: DataFrame, areas: DataFrame, points: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """The industrial columns of every tile. ``areas`` are clipped polygons with the class columns and a height, counted once a
    (feature, tile); ``points`` carry the class columns; ``lines`` are clipped lines with is_plant, counted once a tile.
    Industrial land, buildings, plants, chimneys and points of interest contribute one each."""
    on = lambda flag, v: F.sum(F.when(F.col(flag), v).otherwise(F.lit(0.0)))
    a = areas.groupBy("i", "j").agg(
        on("is_industrial", F.col("area")).alias(INDUSTRIAL[0]),
        on("is_industrial_building", F.col("area")).alias(INDUSTRIAL[1]),
        on("is_industrial_building", F.col("area") * F.col("height")).alias(INDUSTRIAL[2]),
        on("is_landfill", F.col("area")).alias(INDUSTRIAL[3]),
        on("is_quarry", F.col("area")).alias(INDUSTRIAL[4]),
        F.count_if("is_industrial_building").alias(COUNTS[0]),
        F.count_if("is_industrial").alias("_land"),
    )
    p = points.groupBy("i", "j").agg(F.count_if("is_plant").alias("_plants"), F.count_if("is_chimney").alias(COUNTS[2]), F.count_if("is_poi").alias(COUNTS[3]))
    d = grid.join(a, ["i", "j"], "left").join(p, ["i", "j"], "left")
    if lines is None:
        d = d.withColumn("_lines", F.lit(0).cast("long"))
    else:
        crossed = lines.where("is_plant").select("feature_id", "i", "j").distinct()
        d = d.join(crossed.groupBy("i", "j").agg(F.count("*").alias("_lines")), ["i", "j"], "left")
    d = d.fillna(0).withColumn(COUNTS[1], F.col("_plants") + F.col("_lines"))
    d = d.withColumn(COUNTS[4], sum((F.col(c) for c in ("_land", *COUNTS[:4])), F.lit(0).cast("long"))).drop("_land", "_plants", "_lines")
    raw = industrial_raw(*(F.col(c) for c in (INDUSTRIAL[2], INDUSTRIAL[0], COUNTS[1], COUNTS[2], INDUSTRIAL[3], INDUSTRIAL[4], COUNTS[3])))
    d = d.withColumn("industrial_index_raw", raw)
    sure = confidence(F.col(COUNTS[1]), F.col(COUNTS[2]), F.col(INDUSTRIAL[1]), F.col(INDUSTRIAL[0]), F.col(COUNTS[3]))
    return capped_index(d, "industrial_index_raw", "industrial_index_combined").withColumn("industrial_confidence", sure)


def capped_index(df: DataFrame, raw: str, name: str) -> DataFrame:
    """0..100 by the 99th percentile; where that is not positive, by the maximum, or by 1. Both are found by selection over
    the whole column, in passes over a narrow table of it."""
    found = exact_quantiles(df, raw, (0.99, 1.0)).first()
    cap = next((float(q) for q in (found["q"] if found else ()) if q > 0), 1.0)
    return df.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100 * F.col(raw) / F.lit(cap))))


def ring_flags(rings: DataFrame) -> DataFrame:
    """Rings (feature_id, ring array<struct<x, y>>) with validity flags, the signed area, and the ring turned anticlockwise."""
    pairs = "zip_with(slice(ring, 1, greatest(size(ring) - 1, 0)), slice(ring, 2, greatest(size(ring) - 1, 0)), (a, b) -> a.x * b.y - b.x * a.y)"
    d = rings.withColumn("area", F.expr(f"aggregate({pairs}, 0D, (s, v) -> s + v) / 2"))
    closed = F.coalesce(F.get("ring", F.lit(0)) == F.element_at("ring", F.lit(-1)), F.lit(False))
    d = d.withColumn("closed", F.when(F.size("ring") > 0, closed).otherwise(False)).withColumn("enough_points", F.size("ring") >= 4)
    valid = F.col("closed") & F.col("enough_points") & (F.abs("area") > 0)
    return d.withColumn("valid", valid).withColumn("ring", F.when(F.col("area") < 0, F.reverse("ring")).otherwise(F.col("ring")))


def ring_crossings(rings: DataFrame, cell: float = 30.0) -> DataFrame:
    """feature_id and ``n_crossings`` of the rings whose edges meet otherwise than at the ends that neighbours share: crossings,
    touches of a corner and an edge, edges upon each other. ``rings`` as for ``ring_flags``; repeated corners are one, an open
    ring is closed.

    Edges meet by the tiles that they run through, as an equi-key; signs of orientation then tell whether two of them meet.
    """
    once = F.filter("ring", lambda c, i: (i == 0) | (c != F.get("ring", i - 1)))
    d = order.spread(rings, "feature_id").select("feature_id", once.alias("r")).where(F.size("r") >= 2).distinct()
    d = d.withColumn("r", F.when(F.element_at("r", 1) == F.element_at("r", -1), F.col("r")).otherwise(F.concat("r", F.array(F.element_at("r", 1)))))
    edges = F.zip_with(F.slice("r", 1, F.size("r") - 1), F.slice("r", 2, F.size("r") - 1), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    d = d.select("feature_id", (F.size("r") - 1).alias("n"), F.posexplode(edges).alias("k", "e")).select("feature_id", "n", "k", "e.*")
    e = line_cells(d, cell)
    a = e.select("feature_id", "i", "j", "n", *[F.col(c).alias(f"a{c}") for c in ("k", "x1", "y1", "x2", "y2")])
    b = e.select("feature_id", "i", "j", *[F.col(c).alias(f"b{c}") for c in ("k", "x1", "y1", "x2", "y2")])
    # merged: the planner takes the rows of tiles for as few as the rings and would broadcast them
    p = a.join(b.hint("merge"), ["feature_id", "i", "j"]).where("ak < bk")
    side = lambda o, q, c: (F.col(f"{o}x2") - F.col(f"{o}x1")) * (F.col(f"{q}y{c}") - F.col(f"{o}y1")) - (F.col(f"{o}y2") - F.col(f"{o}y1")) * (F.col(f"{q}x{c}") - F.col(f"{o}x1"))
    boxes = F.lit(True)
    for c in "xy":
        low, high = (lambda q: F.least(f"{q}{c}1", f"{q}{c}2")), (lambda q: F.greatest(f"{q}{c}1", f"{q}{c}2"))
        boxes = boxes & (low("a") <= high("b")) & (low("b") <= high("a"))
    apart = lambda o, q: F.signum(side(o, q, 1)) * F.signum(side(o, q, 2)) > 0
    meets = boxes & ~apart("a", "b") & ~apart("b", "a")
    # neighbours share a corner; they are upon each other if they turn back there
    next_to = (F.col("bk") == F.col("ak") + 1) | ((F.col("ak") == 0) & (F.col("bk") == F.col("n") - 1))
    straight = (side("a", "b", 1) == 0) & (side("a", "b", 2) == 0)
    back = (F.col("ax2") - F.col("ax1")) * (F.col("bx2") - F.col("bx1")) + (F.col("ay2") - F.col("ay1")) * (F.col("by2") - F.col("by1")) < 0
    hit = p.where(F.when(next_to, straight & back).otherwise(meets)).select("feature_id", "ak", "bk").distinct()
    return hit.groupBy("feature_id").agg(F.count("*").alias("n_crossings"))


def valid_rings(rings: DataFrame, cell: float = 30.0) -> DataFrame:
    """``ring_flags`` with ``n_crossings``; a ring that meets itself isn't valid."""
    flagged = ring_flags(rings).join(ring_crossings(rings, cell), "feature_id", "left")
    n = F.coalesce("n_crossings", F.lit(0)).cast("long")
    return flagged.withColumn("n_crossings", n).withColumn("valid", F.col("valid") & (F.col("n_crossings") == 0))
