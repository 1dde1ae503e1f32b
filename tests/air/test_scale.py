"""Exact quantiles, orders by ranges, focal statistics and line walks against plain versions; repeated rows."""

import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from aqgrid.operators import landuse, order, quality, raster, readings
from aqgrid.operators.quantiles import exact_quantiles
from aqgrid.plans import registry

SHARES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("value", ["cast(id as double)", "exp(rand(1) * 600 - 300)", "(rand(3) - 0.5) * exp(rand(4) * 30)", "CASE WHEN id % 3 = 0 THEN 5.0 WHEN id % 3 = 1 THEN cast(id as double) END", "cast(id % 2 as double)"])
def test_quantiles_by_group(spark, value):
    d = spark.range(40_000).selectExpr("CASE WHEN id % 5 <> 0 THEN id % 5 END AS g", f"{value} AS v").cache()
    got = {r.g: list(r.q) for r in exact_quantiles(d, "v", SHARES, ["g"]).collect()}
    want = {r.g: list(r.p) for r in d.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, SHARES))).alias("p")).collect()}
    assert set(got) == set(want) == {None, 1, 2, 3, 4}
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12)
    d.unpersist()


def test_quantiles_of_few_rows(spark):
    one = spark.createDataFrame([(1, 2.5), (2, None), (3, 1.0), (3, 2.0)], "g int, v double")
    assert {r.g: list(r.q) for r in exact_quantiles(one, "v", (0.5,), ["g"]).collect()} == {1: [2.5], 3: [1.5]}
    assert exact_quantiles(one.where("g = 2"), "v", (0.5,)).collect() == []


def test_quantiles_of_ten_million_values(spark):
    """Bins and ends are all that is held: no task keeps the values."""
    d = spark.range(10_000_000).select(((F.col("id") * 7_654_321) % 10_000_000).cast("double").alias("v"))
    assert list(exact_quantiles(d, "v", (0.01, 0.5, 0.99)).first().q) == pytest.approx([99_999.99, 4_999_999.5, 9_899_999.01])


def test_ranges_of_an_order(spark):
    r = random.Random(1)
    values = [r.randrange(500) for _ in range(3000)] + [None] * 5
    d = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "k int, i int")
    for ranges in (1, 7, 600):
        ends = order.bounds(d, "k", ranges)
        assert ends == sorted(set(ends)) and ends[-1] == max(v for v in values if v is not None) and len(ends) <= ranges
        for k, n in d.select("k", order.range_of(F.col("k"), ends).alias("n")).distinct().collect():
            assert n == (0 if k is None else sum(e < k for e in ends))
        got = {x.value: x.before for x in order.distinct_before(d, "k", ranges).collect()}
        have = sorted({v for v in values if v is not None})
        assert got == dict(zip(have, [None, *have[:-1]], strict=True))
        per = d.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"))
        sums = {x.k: x.running for x in order.running_sum(per, "k", "n", ranges).collect()}
        assert sums == {k: sum(v is not None and v <= k for v in values) for k in have}
    rows = [(i, (i * 7919) % 1000) for i in range(2000)]
    got = order.with_before(spark.createDataFrame(rows, "k int, v int").repartition(5), "k", ("v",), 13).collect()
    assert {x.k: x.before and x.before.v for x in got} == {k: rows[k - 1][1] if k else None for k, _ in rows}
    assert order.distinct_before(d.where("false"), "k").collect() == [] == order.running_sum(d.where("false"), "k", "i").collect()


def test_orders_and_quantiles_have_no_single_task(spark):
    """Neither a window nor a percentile over a whole table."""
    sf = "/root/testdata/sf0.001"
    for name in ("w1_dense_ids", "w2_grid_spacing", "w3_date_order", "a9_capped_index", "a15_describe", "q11_surface", "q4_month_parity"):
        name = next(q for q in registry.queries() if q.startswith(name.split("_")[0] + "_"))
        text = plan(registry.queries()[name](spark, sf))
        for line in re.findall(r"Window \[.*", text):
            assert re.search(r"\], \[[a-z_]+#", line), (name, line)  # dealt by a key
        assert "percentile(" not in text, name


def plain_focal(cells, radius):
    ring = [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]
    out = {}
    for (r, c), v in cells.items():
        near = [cells[r + i, c + j] for i, j in ring if (r + i, c + j) in cells]
        out[r, c] = (v - statistics.fmean(near), statistics.pstdev(near))
    return out


@pytest.mark.parametrize(("radius", "block"), [(0, 8), (1, 4), (5, 7), (17, 16)])
def test_focal_statistics_by_growing_chords(spark, radius, block):
    r = random.Random(radius)
    cells = {(i, j): r.choice([7.0, 900.25, r.random()]) for i in range(-9, 20) for j in range(25) if r.random() < 0.8}
    cells |= {(i, 100 + j): 1234.5 for i in range(6) for j in range(6)}
    d = spark.createDataFrame([(i, j, v) for (i, j), v in cells.items()] + [(50, 50, None)], "row int, col int, value double")
    got = {(x.row, x.col): (x.tpi, x.focal_std) for x in raster.topographic_position(d.unionByName(d), radius, block).collect()}
    want = plain_focal(cells, radius)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-8)
    assert got[2, 102] == (0.0, 0.0)


def test_bilinear_of_repeated_points_and_edges(spark):
    px = spark.createDataFrame([("a", "b", r, c, float(r * 3 + c)) for r in range(3) for c in range(3)], "raster_id string, band string, row int, col int, value double")
    meta = spark.createDataFrame([("a", "b", 0.0, 3.0, 1.0, None, None, None)], "raster_id string, band string, x_origin double, y_origin double, res double, nodata double, scale double, offset double")
    pts = [(1, 1.0, 2.0), (2, 0.5, 2.5), (3, 2.5, 0.5), (4, 0.5, 2.0), (5, 0.25, 2.0), (6, None, 1.0), (1, 1.0, 2.0), (1, 1.0, 2.0)]
    clash = "id int, x double, y double"
    out = raster.sample_bilinear(spark.createDataFrame(pts, clash).withColumns({"row": F.lit(9), "w": F.lit("x"), "c": F.lit("x")}), px, meta).collect()
    got = {}
    for r in out:
        got.setdefault(r.id, []).append((r["value"], r.is_nodata))
    assert got == {1: [(2.0, False)] * 3, 2: [(0.0, False)], 3: [(8.0, False)], 4: [(1.5, False)], 5: [(None, True)], 6: [(None, True)]}
    near = raster.sample_nearest(spark.createDataFrame(pts, clash), px, meta)
    assert near.count() == len(pts)
    grid = spark.createDataFrame([(0, 0, 1.0, 2.0), (0, 0, 1.0, 2.0)], "row int, col int, x double, y double")
    assert [r["value"] for r in raster.reproject(grid, px, meta, lambda x, y: (x, y)).collect()] == [2.0, 2.0]


def _readings(spark, rows):
    full = [(s, "2024-01-01", la, lo, v, "exact" if v is not None else "none", 0) for s, la, lo, v in rows]
    schema = "sensor_id long, date string, latitude double, longitude double, pm25 double, fallback_type string, days_offset long"
    return spark.createDataFrame(full, schema).withColumn("date", F.to_date("date"))


def test_filling_with_repeated_rows(spark):
    base = [(1, 10.0, 20.0, None), (2, 10.01, 20.0, 8.0), (3, 10.0, 20.01, 16.0)]
    two = lambda rows: [r["pm25"] for r in readings.idw_fill(_readings(spark, rows)).where("sensor_id = 1").collect()]
    assert two(base) == [None]
    assert two(base * 2) == [None, None]  # two neighbours stay two
    three = [*base, (4, 9.99, 20.0, 12.0)]
    alone = two(three)
    assert alone[0] is not None and two(three * 3) == pytest.approx(alone * 3)


def test_neighbours_across_the_meridian(spark):
    rows = [(1, -17.0, 179.99, None), (2, -17.0, -179.99, 10.0), (3, -17.01, -179.995, 12.0), (4, -17.01, 179.98, 14.0), (5, -17.0, 0.0, 99.0)]
    assert 10 < readings.idw_fill(_readings(spark, rows)).where("sensor_id = 1").first()["pm25"] < 14
    r = random.Random(2)
    rows = [(i, r.choice([0, 60, 85, 88.9, -89.7, 89.95]) + r.random() * 0.05, r.choice([-180, 179.95, 0, 90]) + r.random() * 0.05, None if i % 2 else 1.0) for i in range(120)]
    d = _readings(spark, rows)
    from aqgrid.functions.columns import haversine_km

    a, b = d.where("pm25 IS NULL"), d.where("pm25 IS NOT NULL").select("sensor_id", "date", "latitude", "longitude", "pm25")
    o = b.select(F.col("sensor_id").alias("other"), F.col("latitude").alias("y"), F.col("longitude").alias("x"))
    for km in (2.0, 30.0, 400.0):
        want = a.crossJoin(o).where(haversine_km(F.col("latitude"), F.col("longitude"), F.col("y"), F.col("x")) <= km).select("sensor_id", "other").collect()
        got = readings.neighbours(a, b, km).select("sensor_id", "other").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and want


def plain_clip(x1, y1, x2, y2, cell):
    """Tiles that a segment runs through, with the length, by cutting it at every grid line."""
    ts = {0.0, 1.0}
    for a, b in ((x1, x2), (y1, y2)):
        if a != b:
            ts |= {t for k in range(math.floor(min(a, b) / cell), math.ceil(max(a, b) / cell) + 1) if 0 < (t := (k * cell - a) / (b - a)) < 1}
    out, ts = {}, sorted(ts)
    for s, t in zip(ts, ts[1:], strict=False):
        m = (s + t) / 2
        k = (math.floor((y1 + m * (y2 - y1)) / cell), math.floor((x1 + m * (x2 - x1)) / cell))
        out[k] = out.get(k, 0) + (t - s) * math.hypot(x2 - x1, y2 - y1)
    return {k: v for k, v in out.items() if v > 1e-7}


def test_lines_are_walked(spark):
    r = random.Random(3)
    xy = lambda: r.uniform(-300, 900)
    rows = [(i, xy(), xy(), xy(), xy()) for i in range(150)] + [(150, 15.0, 3.0, 15.0, 700.0), (151, 3.0, 45.0, 700.0, 45.0), (152, 1.0, 1.0, 2.0, 2.5)]
    d = spark.createDataFrame(rows, "feature_id int, x1 double, y1 double, x2 double, y2 double")
    for half in (False, True):
        got = {}
        for x in landuse.clip_lines(d, 30.0, half).where("length > 1e-7").collect():
            got.setdefault(x.feature_id, {})[x.i, x.j] = x.length
        for i, *p in rows:
            want = plain_clip(*p, 30.0)
            assert got[i].keys() == want.keys()
            assert all(got[i][k] == pytest.approx(v, abs=1e-6) for k, v in want.items())
    border = spark.createDataFrame([(1, 30.0, 3.0, 30.0, 20.0)], d.schema)
    assert landuse.clip_lines(border, 30.0).count() == 2 and landuse.clip_lines(border, 30.0, True).count() == 1
    tiles = sum(len(plain_clip(*p, 30.0)) for _, *p in rows)
    columns = sum(len({j for _, j in plain_clip(*p, 30.0)}) for _, *p in rows)
    assert landuse.clip_lines(d, 30.0, True).count() <= landuse.line_cells(d, 30.0, True).count() <= tiles + columns


def test_dates_in_order(spark):
    rows = [(i, f"2024-01-{1 + i % 28:02d}") for i in range(300)]
    d = spark.createDataFrame(rows, "k int, date string").withColumn("date", F.to_date("date")).repartition(7)
    assert quality.date_order(d, "k").first()["observed"] == 10
    assert quality.date_order(d.withColumn("g", F.col("k") % 2), "k", groups=("g",)).first()["observed"] == 20


def rows_of_tiles(spark, name, n):
    """A query's plan over ``n`` parts, which lie in one small file."""
    import subprocess

    folder = subprocess.check_output(["mktemp", "-d", "/tmp/spark-XXXXXX"], text=True).strip()
    for t in ("customer", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    row = ["id AS p_partkey", "'MEDIUM' AS p_type", "CAST(id % 50 AS INT) AS p_size"]
    spark.range(n).selectExpr(*row).coalesce(1).write.parquet(f"{folder}/part.parquet")
    return registry.queries()[name](spark, folder)


def test_tiles_of_rings_are_not_broadcast(spark):
    """Many rows come of a ring's few bytes; the planner would send them all through the driver."""
    p = plan(rows_of_tiles(spark, "g7_crossings", 5000))
    assert not re.search(r"BroadcastHashJoin \[feature_id#\d+L?, i#\d+", p)
    assert re.search(r"SortMergeJoin \[feature_id#\d+L?, i#\d+", p)


@pytest.mark.parametrize("name", ["g5_polygon_area", "g5_tile_areas", "p17_industrial_tiles", "q8_industrial_tiles"])
def test_areas_are_clipped_in_parts_by_number(spark, name):
    """60,000 edges in one small file: their tiles are worked out in several parts, whatever the bytes of the file."""
    p = plan(rows_of_tiles(spark, name, 20_000 + 60_000 * (name == "g5_tile_areas")))
    n = 12 if name == "g5_tile_areas" else max(3, spark.sparkContext.defaultParallelism)
    assert re.search(rf"hashpartitioning\(feature_id#\d+L?, {n}\), REPARTITION_BY_NUM", p)


def test_areas_of_a_ring_with_a_hole_and_gaps(spark):
    """Areas between the rows that edges cross, above a hole and within it."""
    square = lambda lo, hi: [(lo, lo, hi, lo), (hi, lo, hi, hi), (hi, hi, lo, hi), (lo, hi, lo, lo)]
    hole = [(c, d, a, b) for a, b, c, d in square(95.0, 205.0)]
    e = spark.createDataFrame([(1, *map(float, x)) for x in square(5.0, 295.0) + hole], "feature_id int, x1 double, y1 double, x2 double, y2 double")
    got = {(r.i, r.j): r.area for r in landuse.clip_areas(e).collect()}
    over = lambda lo, hi, k: max(0.0, min(hi, 30 * k + 30) - max(lo, 30 * k))
    want = {(i, j): over(5, 295, i) * over(5, 295, j) - over(95, 205, i) * over(95, 205, j) for i in range(10) for j in range(10)}
    assert got == pytest.approx({k: v for k, v in want.items() if v > 1e-9})


def test_neighbours_are_not_broadcast_and_crowds_are_dealt(spark, monkeypatch):
    """The pairs are no rows of a join, and parts and blocks of a bucket give what one group gives."""
    d = spark.range(600).selectExpr(
        "id % 200 AS sensor_id", "date_add(DATE'2024-01-30', CAST(id DIV 200 AS INT)) AS date", "19 + 0.02 * ((id % 200 * 7919) % 97) / 97 AS latitude", "72.8 + 0.02 * ((id % 200 * 7907) % 89) / 89 AS longitude",
        "CASE WHEN id % 3 = 0 THEN CAST(id AS DOUBLE) END AS pm25", "'none' AS fallback_type", "0L AS days_offset",
    )
    filled = lambda: readings.idw_fill(d, max_km=1.0)
    whole = filled()
    assert "FlatMapCoGroupsInPandas" in plan(whole) and not re.search(r"BroadcastHashJoin \[date#\d+, by", plan(whole))
    want = {(r.sensor_id, r.date): r.pm25 for r in whole.collect()}
    monkeypatch.setattr(readings, "CROWD", 20)
    monkeypatch.setattr(readings, "PAIRS", 50)
    got = {(r.sensor_id, r.date): r.pm25 for r in filled().collect()}
    assert len(got) == 600 and {k: v and round(v, 9) for k, v in got.items()} == {k: v and round(v, 9) for k, v in want.items()}
    assert sum(v is not None for v in want.values()) > 300
