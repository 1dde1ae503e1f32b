import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aqgrid.functions import columns as C
from aqgrid.operators import gtwr, landuse, raster, readings, rollup, signals, weather
from aqgrid.sources import tables
from aqgrid.streaming import readings as streams

D = dt.date


def value(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def test_indices_need_a_denominator(spark):
    n = lambda x: F.lit(x).cast("double")
    assert value(spark, C.ndvi(n(3.0), n(1.0))) == 0.5
    assert value(spark, C.ndvi(n(1.0), n(-1.0))) is None
    assert value(spark, C.ndvi(n(None), n(1.0))) is None
    assert value(spark, C.nan_to_null(n(math.nan))) is None
    assert value(spark, C.ibi(n(0.5), n(0.1), n(0.3))) == pytest.approx(0.3 / 0.7)


def test_utm_round_trip_and_known_corner(spark):
    d = spark.createDataFrame([(72.7763, 18.8939), (75.0, 0.0), (78.0, 60.0)], "lon double, lat double")
    e, n = C.to_utm(F.col("lon"), F.col("lat"))
    lon, lat = C.from_utm(F.col("e"), F.col("n"))
    x, y = C.to_utm(F.lit(150.3), F.lit(-33.9), 56, south=True)
    back = spark.range(1).select(x.alias("x"), y.alias("y")).select("x", "y", *C.from_utm(F.col("x"), F.col("y"), 56, south=True)).first()
    assert abs(back[2] - 150.3) < 1e-8 and abs(back[3] + 33.9) < 1e-8 and 6_240_000 < back["y"] < 6_260_000 and 240_000 < back["x"] < 260_000
    rows = d.withColumn("e", e).withColumn("n", n).withColumn("lon2", lon).withColumn("lat2", lat).collect()
    assert rows[0].e == pytest.approx(265761.085, abs=0.01) and rows[0].n == pytest.approx(2090560.223, abs=0.01)
    assert rows[1].e == pytest.approx(500000, abs=1e-6) and rows[1].n == pytest.approx(0, abs=1e-6)
    assert all(r.lon2 == pytest.approx(r.lon, abs=1e-8) and r.lat2 == pytest.approx(r.lat, abs=1e-8) for r in rows)


def test_labels(spark):
    n = lambda x: F.lit(x).cast("double")
    got = [value(spark, C.morphology(n(x))) for x in (0.0, 0.4, 0.41, 0.6, 0.8, 0.81, 1.0, 1.1)]
    assert got == [None, "deep_canyon", "street_canyon", "street_canyon", "urban_open", "suburban", "suburban", None]
    w = [value(spark, C.road_weight(F.lit(s).cast("string"), F.lit(h).cast("string"))) for s, h in ((None, "track"), (None, "track_x"), ("Gravel", "track"), (None, None), ("odd", "service"))]
    assert w == [0.7, 0.6, 0.9, 0.1, 0.35]
    h = [value(spark, C.building_height(F.lit(a).cast("string"), F.lit(b).cast("string"))) for a, b in (("12;3", None), ("NaN", "2"), ("x", "y"), (None, "4"))]
    assert h == [12.0, 6.0, 6.0, 12.0]


def test_dates_with_byte_order_mark(spark):
    d = spark.createDataFrame([("﻿2020-01-02",), (" 2020-01-02 ",), ("",), ("no",)], "value string")
    assert [r.date for r in tables.parse_dates(d).collect()] == [D(2020, 1, 2)]
    assert tables.parse_dates(d, distinct=False).count() == 2


def test_files_of_dates(spark, tmp_path):
    (tmp_path / "d").write_text("2020-01-05\n\n2020-01-02\n2020-01-05\n")
    (tmp_path / "e").write_text("\n \n")
    assert [r.date.day for r in tables.read_dates(spark, str(tmp_path / "d"), sort=True).collect()] == [2, 5]
    with pytest.raises(ValueError, match="no dates"):
        tables.read_dates(spark, str(tmp_path / "e"))
    assert C.bbox_centre((1.0, 2.0, 3.0, 6.0)) == (2.0, 4.0)
    assert [value(spark, C.in_bbox(F.lit(x), F.lit(2.0), (1.0, 2.0, 3.0, 6.0))) for x in (0.9, 1.0, 3.0, 3.1)] == [False, True, True, False]


def test_a_signal_brings_its_metadata(spark):
    f = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2020, 1, 1))], "grid_id long, date date")
    s = spark.createDataFrame([(1, D(2020, 1, 1), 0.5, False)], "grid_id long, date date, value double, is_nodata boolean")
    got = {r.grid_id: r for r in tables.attach_signal(f, s, "no2", meta={"unit": "mol/m2"}).collect()}
    assert (got[1].no2, got[1].no2_is_nodata, got[1].no2_meta.unit) == (0.5, False, "mol/m2")
    assert (got[2].no2, got[2].no2_is_nodata, got[2].no2_meta.unit) == (None, True, "mol/m2")


def test_nested_pages(spark):
    j = '{"hourly":{"time":["2020-01-01T00:00","2020-01-01T01:00"],"temperature_2m":[1.5,null]}}'
    rows = tables.flatten_hourly(spark.createDataFrame([(j,)], "json string")).orderBy("datetime").collect()
    assert [r.temperature_2m for r in rows] == [1.5, None] and rows[0].cloud_cover is None
    s = '{"id":1,"coordinates":{"latitude":1.0,"longitude":2.0},"datetimeFirst":{"utc":"2020-01-01T00:00:00Z"},"datetimeLast":{"utc":"2021-01-01T00:00:00Z"}}'
    rows = tables.flatten_sensors(spark.createDataFrame([(s,), ('{"id":2}',)], "json string")).collect()
    assert [(r.id, r.name, r.latitude, r.first_date) for r in rows] == [(1, "pm25_sensor", 1.0, D(2020, 1, 1))]
    assert [tuple(r) for r in tables.sensor_rejects(spark.createDataFrame([(s,), ('{"id":2}',)], "json string")).collect()] == [(2, "pm25_sensor", "no first date")]


def fallback(spark, daily, target, **kw):
    d = spark.createDataFrame(daily, "sensor_id long, date date, pm25 double, sample_count long")
    t = spark.createDataFrame([(1, target)], "sensor_id long, date date")
    r = readings.with_fallback(t, d, **kw).first()
    return r.fallback_type, r.days_offset, r.pm25, r.sample_count


def test_fallback_order(spark):
    day = D(2020, 3, 10)
    at = lambda k, v=1.0, n=3: (1, day + dt.timedelta(k), v, n)
    assert fallback(spark, [at(0, 5.0), at(1)], day) == ("exact", 0, 5.0, 3)
    assert fallback(spark, [at(0, 5.0, 2), at(-2, 7.0), at(2, 8.0)], day) == ("window", -2, 7.0, 3)
    assert fallback(spark, [at(-2, 7.0), at(1, 8.0)], day) == ("window", 1, 8.0, 3)
    assert fallback(spark, [(1, D(2019, 3, 10), 2.0, 3), (1, D(2021, 3, 10), 3.0, 3)], day) == ("seasonal", -366, 2.0, 3)
    assert fallback(spark, [(1, D(2019, 3, 10), 2.0, 3)], day, seasonal=False) == ("none", 0, None, 0)
    assert fallback(spark, [(1, D(2019, 2, 28), 2.0, 3)], D(2020, 2, 29)) == ("none", 0, None, 0)


def test_idw_rules(spark):
    day = D(2020, 1, 1)
    rows = [(1, day, 19.0, 72.8, None), (2, day, 19.01, 72.8, 10.0), (3, day, 19.02, 72.8, 20.0), (4, day, 19.0, 72.8, 30.0), (5, day, 19.0, 72.8, 40.0), (6, day, None, None, None), (7, day, 25.0, 72.8, None)]
    d = spark.createDataFrame(rows, "sensor_id long, date date, latitude double, longitude double, pm25 double").withColumn("fallback_type", F.lit("none")).withColumn("days_offset", F.lit(0).cast("long"))
    got = {r.sensor_id: r for r in readings.idw_fill(d).collect()}
    assert (got[1].pm25, got[1].fallback_type) == (30.0, "spatial_idw")  # a neighbour at the spot, the smaller id of two
    assert got[6].pm25 is None and got[7].pm25 is None and got[7].fallback_type == "none"
    far = readings.idw_fill(d.where("sensor_id not in (4, 5)")).where("sensor_id = 1").first()
    assert far.pm25 is None  # two neighbours are too few
    three = spark.createDataFrame([(8, day, 19.03, 72.8, 50.0)], "sensor_id long, date date, latitude double, longitude double, pm25 double").withColumn("fallback_type", F.lit("none")).withColumn("days_offset", F.lit(0).cast("long"))
    v = readings.idw_fill(d.where("sensor_id < 4").unionByName(three)).where("sensor_id = 1").first().pm25
    assert v == pytest.approx((10 / 1 + 20 / 4 + 50 / 9) / (1 + 1 / 4 + 1 / 9), rel=1e-6) and 10 <= v <= 50


def test_nearest_hour_ties_and_tolerance(spark):
    t = lambda *a: dt.datetime(*a)
    h = spark.createDataFrame([(t(2020, 1, 1, 4), 1.0), (t(2020, 1, 1, 6), 2.0), (t(2020, 1, 2, 8), 3.0), (t(2020, 1, 3, 9), 4.0), (t(2020, 1, 4, 5), 5.0)], "datetime timestamp, temperature_2m double")
    dates = spark.createDataFrame([(D(2020, 1, k),) for k in (1, 2, 3, 4, 4)], "date date")
    got = {r.date.day: (r.temperature_2m, r.hours_offset) for r in weather.nearest_hour(h, dates).collect()}
    assert got == {1: (1.0, 1.0), 2: (3.0, 3.0), 4: (5.0, None)}


def test_interpolation_and_month_mapping(spark):
    obs = spark.createDataFrame([(1, D(2020, 1, 1), 0.0), (2, D(2020, 1, 1), 5.0), (1, D(2020, 1, 11), 10.0), (3, D(2020, 1, 11), 1.0)], "cell long, date date, value double")
    dates = spark.createDataFrame([(D(2020, 1, 3),), (D(2020, 1, 20),), (D(2019, 12, 20),), (D(2022, 1, 1),)], "date date")
    got = {(r.cell, r.date): r.value for r in signals.interpolate(dates, obs).collect()}
    assert got == {(1, D(2020, 1, 3)): 2.0, (2, D(2020, 1, 3)): None, (1, D(2020, 1, 20)): 10.0, (3, D(2020, 1, 20)): 1.0, (1, D(2019, 12, 20)): 0.0, (2, D(2019, 12, 20)): 5.0}
    src = spark.createDataFrame([(D(2020, 1, 5),), (D(2020, 1, 25),)], "date date")
    m = {r.date: r.source_date for r in signals.month_source(dates, src).collect()}
    assert m == {D(2020, 1, 3): D(2020, 1, 25), D(2020, 1, 20): D(2020, 1, 25), D(2019, 12, 20): None, D(2022, 1, 1): None}
    assert signals.month_source(dates, src, keep="first").where("source_date = '2020-01-05'").count() == 2


def test_clipped_lines_keep_their_length(spark):
    seg = [(1, 5.0, 5.0, 95.0, 5.0), (2, 3.0, 80.0, 77.0, 11.0), (3, 10.0, 10.0, 10.0, 70.0)]
    d = spark.createDataFrame(seg, "feature_id long, x1 double, y1 double, x2 double, y2 double")
    got = {r.feature_id: r.s for r in landuse.clip_lines(d).groupBy("feature_id").agg(F.sum("length").alias("s")).collect()}
    assert all(got[k] == pytest.approx(math.hypot(c - a, e - b)) for k, a, b, c, e in seg)
    edge = spark.createDataFrame([(1, 30.0, 5.0, 30.0, 25.0)], "feature_id long, x1 double, y1 double, x2 double, y2 double")
    assert landuse.clip_lines(edge).agg(F.sum("length")).first()[0] == pytest.approx(40)  # closed tiles: both sides
    assert landuse.clip_lines(edge, half_open=True).agg(F.sum("length")).first()[0] == pytest.approx(20)


def ring(k, pts):
    return [(k, *a, *b) for a, b in zip(pts, pts[1:] + pts[:1], strict=True)]


def test_clipped_areas_with_a_hole(spark):
    outer = ring(1, [(5.0, 5.0), (85.0, 5.0), (85.0, 85.0), (5.0, 85.0)])
    hole = ring(1, [(35.0, 35.0), (35.0, 55.0), (55.0, 55.0), (55.0, 35.0)])
    d = spark.createDataFrame(outer + hole, "feature_id long, x1 double, y1 double, x2 double, y2 double")
    got = {(r.i, r.j): r.area for r in landuse.clip_areas(d).collect()}
    assert got[0, 0] == pytest.approx(625) and got[1, 1] == pytest.approx(500) and got[0, 1] == pytest.approx(750)
    assert sum(got.values()) == pytest.approx(6400 - 400)


def test_clipped_areas_match_sampling(spark):
    r = np.random.default_rng(1)
    a = np.sort(r.uniform(0, 2 * np.pi, 9))
    pts = [(60 + q * math.cos(t), 60 + q * math.sin(t)) for t, q in zip(a, r.uniform(10, 55, 9), strict=True)]
    d = spark.createDataFrame(ring(1, [(float(x), float(y)) for x, y in pts]), "feature_id long, x1 double, y1 double, x2 double, y2 double")
    got = {(x.i, x.j): x.area for x in landuse.clip_areas(d).collect()}
    gx, gy = np.meshgrid(np.arange(0, 120, 0.5) + 0.25, np.arange(0, 120, 0.5) + 0.25)
    ins = np.zeros_like(gx, bool)
    for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1], strict=True):
        ins ^= ((y1 > gy) != (y2 > gy)) & (x1 + (gy - y1) * (x2 - x1) / (y2 - y1) > gx)
    for i in range(4):
        for j in range(4):
            cell = ins[60 * i : 60 * i + 60, 60 * j : 60 * j + 60].sum() * 0.25
            assert got.get((i, j), 0) == pytest.approx(cell, abs=25)
    area = abs(sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1], strict=True))) / 2
    assert sum(got.values()) == pytest.approx(area)


def test_points_on_an_edge_belong_to_no_tile(spark):
    p = spark.createDataFrame([(1, 30.0, 5.0), (2, 31.0, 5.0)], "id long, x double, y double")
    assert [(r.id, r.i, r.j) for r in landuse.points_in_tiles(p).collect()] == [(2, 0, 1)]


def test_grid(spark):
    g = landuse.centroids(spark, 0, 0, 100, 70)
    assert g.agg(F.min("x"), F.max("x"), F.max("y"), F.count("*")).first() == (15.0, 75.0, 45.0, 6)
    ids = landuse.dense_ids(g.where("ix <> 1")).orderBy("grid_id").collect()
    assert [(r.grid_id, r.iy, r.ix) for r in ids] == [(0, 0, 0), (1, 0, 2), (2, 1, 0), (3, 1, 2)]
    with pytest.raises(ValueError):
        landuse.centroids(spark, 0, 0, 1e6, 1e6)


def test_capped_index_of_zeros(spark):
    d = spark.createDataFrame([(0.0,), (0.0,)], "raw double")
    assert [r.idx for r in landuse.capped_index(d, "raw", "idx").collect()] == [0.0, 0.0]


def plain_gtwr(train, query, hs, ht):
    X, y, c, t = (np.array([r[k] for r in train], float) for k in ("x", "y", "c", "t"))
    out = []
    for q in query:
        w = np.maximum(np.exp(-((c - q["c"]) ** 2).sum(1) / hs**2) * np.exp(-((t - q["t"]) ** 2) / ht**2), 1e-12)
        beta = np.linalg.pinv((X * w[:, None]).T @ X) @ ((X * w[:, None]).T @ y)
        res = y - X @ beta
        out.append((float(np.array(q["x"]) @ beta), math.sqrt((w * res**2).sum() / (w.sum() + 1e-12))))
    return out


def test_regression_matches_plain(spark):
    r = np.random.default_rng(42)
    row = lambda: {"x": r.normal(size=3).tolist(), "y": float(r.normal()), "c": r.uniform(0, 100, 2).tolist(), "t": float(r.uniform(0, 10))}
    train, query = [row() for _ in range(60)], [row() for _ in range(15)]
    frame = lambda rows: spark.createDataFrame([(i, q["x"], q["y"], *q["c"], q["t"]) for i, q in enumerate(rows)], "id long, x array<double>, y double, cx double, cy double, t double")
    got = gtwr.predict(frame(train), frame(query), 3, hs=20.0, ht=5.0).orderBy("id").collect()
    for g, (p, u) in zip(got, plain_gtwr(train, query, 20.0, 5.0), strict=True):
        assert g.prediction == pytest.approx(p, abs=1e-8) and g.uncertainty == pytest.approx(u, abs=1e-6)
    with pytest.raises(Exception, match="another length"):
        gtwr.predict(frame(train), frame(query), 2, hs=20.0).collect()
    assert gtwr.best_bandwidth(gtwr.bandwidth_scores(frame(train), 3, [(20.0, 5.0), (50.0, None)])).count() == 1


def test_sky_view_of_a_wall_and_open_ground(spark):
    flat = [(i, j, 0.0) for i in range(9) for j in range(9)]
    d = spark.createDataFrame(flat, "row long, col long, value double")
    assert {r.svf for r in raster.horizon_svf(d, res=1.0, radius=3.0, directions=8, block=4).collect()} == {1.0}
    wall = spark.createDataFrame([(i, j, 100.0 if j == 5 else 0.0) for i, j, _ in flat], "row long, col long, value double")
    got = {(r.row, r.col): r.svf for r in raster.horizon_svf(wall, res=1.0, radius=3.0, directions=4, block=3).collect()}
    assert got[4, 4] == pytest.approx(0.75, abs=1e-3) and got[4, 5] == 1.0 and got[4, 1] == 1.0


def test_rollups(spark):
    d = spark.createDataFrame([(1, 1, 5.0), (1, 2, 7.0)], "k long, version long, value double")
    assert rollup.latest_version(d, ["k"]).first().value == 7.0
    c = spark.createDataFrame([(0, 0, 1.0), (2, 2, 3.0), (3, 0, 9.0)], "ix int, iy int, value double")
    assert {(r.cx, r.cy, r.value) for r in rollup.coarser(c).collect()} == {(0, 0, 2.0), (1, 0, 9.0)}


def test_tables_by_date(spark, tmp_path):
    p = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "id long, date date")
    tables.write_by_date(make([(1, D(2020, 1, 1)), (2, D(2020, 1, 2))]), p)
    tables.write_by_date(make([(3, D(2020, 1, 2))]), p)
    assert {r.id for r in spark.read.parquet(p).collect()} == {1, 3}
    with pytest.raises(ValueError):
        tables.read_columns(spark, p, ["id", "nope"])
    req = make([(0, D(2020, 1, 1)), (0, D(2020, 1, 5))]).select("date")
    assert [r.date for r in tables.pending(req, spark.read.parquet(p)).collect()] == [D(2020, 1, 5)]


def test_stream_equals_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(s, dt.datetime(2020, 1, day, h), 2, "pm25", float(h)) for s in (1, 2) for day in range(1, 9) for h in (1, 5)]
    m = spark.createDataFrame(rows, "sensor_id long, ts timestamp, parameter_id int, parameter_name string, value double")
    m.write.parquet(src)
    st = streams.daily_mean_stream(spark.readStream.schema(m.schema).parquet(src))
    streams.run_available(st, str(tmp_path / "out"), str(tmp_path / "state"))
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("sensor_id", "date", "pm25", "sample_count").collect()}
    want = {tuple(r) for r in readings.daily_mean(m).where("date <= '2020-01-05'").select("sensor_id", "date", "pm25", "sample_count").collect()}
    assert got == want


def test_plans_have_no_nested_loops(spark):
    from aqgrid.plans import registry

    q = registry.queries()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on tables above the threshold
    try:
        # lists of all sensors or cells by all dates, which are what those queries ask for
        lists = {"j4_fallback", "m10_choose_source", "s11_attach_signal", "a16_null_counts", "r1_feature_table", "r1_training_table", "q3_features"}
        # metadata of rasters, or the one row of an aggregate
        single = {"j8_sample_nearest", "g9_sample_bilinear", "m7_standardise", "a15_describe", "q6_sky_view", "g13_sky_view_cells", "q9_grid", "g9_reproject"}
        for name in q:
            plan = q[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan or name in lists, name
            assert "BroadcastNestedLoopJoin" not in plan or name in single, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_csv_rejects_and_relief(spark, tmp_path):
    d = spark.createDataFrame([(1, D(2020, 1, 1), "g")], "id long, date date, geometry string")
    tables.write_csv(d, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["id", "date"]
    assert tables.rejects(d, d.limit(0), "none").first().reason == "none"
    flat = spark.createDataFrame([(i, j, 5.0 * j) for i in range(4) for j in range(4)], "row long, col long, value double")
    got = {(r.row, r.col): (r.gradient, r.range) for r in raster.relief(flat, 5.0).collect()}
    assert got[1, 1] == (1.0, 10.0) and got[0, 0] == (None, 5.0)


def test_refresh_by_date(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    make = lambda rows: spark.createDataFrame(rows, "id long, date date")
    make([(1, D(2020, 1, 1)), (2, D(2020, 1, 2))]).write.parquet(src)
    stream = lambda: spark.readStream.schema("id long, date date").parquet(src)
    streams.refresh_by_date(stream(), out, str(tmp_path / "state"))
    make([(3, D(2020, 1, 2))]).write.mode("append").parquet(src)
    streams.refresh_by_date(stream(), out, str(tmp_path / "state"))
    assert {(r.id, r.date) for r in spark.read.parquet(out).collect()} == {(1, D(2020, 1, 1)), (2, D(2020, 1, 2)), (3, D(2020, 1, 2))}
    streams.refresh_by_date(stream(), out, str(tmp_path / "state2"))  # both files as batch 0 of a new stream: its own partitions are replaced
    assert sorted(r.id for r in spark.read.parquet(out).where("batch = 0").collect()) == [1, 2, 3]


def test_ring_flags(spark):
    P = "array<struct<x:double,y:double>>"
    sq = [(0.0, 0.0), (0.0, 2.0), (2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]
    d = spark.createDataFrame([(1, sq), (2, sq[:-1]), (3, []), (4, [(0.0, 0.0)] * 4)], f"feature_id long, ring {P}")
    got = {r.feature_id: (r.valid, r.area) for r in landuse.ring_flags(d).collect()}
    assert got[1] == (True, -4.0) and not got[2][0] and got[3] == (False, 0.0) and not got[4][0]


def test_points_inside_by_bands(spark):
    import random

    r = random.Random(5)
    ring = [(0.0, 0.0), (900.0, 100.0), (500.0, 400.0), (950.0, 900.0), (100.0, 800.0), (300.0, 450.0)]
    edges = [(*a, *b) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]
    pts = [(k, r.uniform(-50, 1000), r.uniform(-50, 1000)) for k in range(300)] + [(5, 0.0, 0.0)]
    pts[-1] = pts[5]  # a repeated row
    e = spark.createDataFrame(edges, "x1 double, y1 double, x2 double, y2 double")
    got = sorted(x.id for x in landuse.inside(spark.createDataFrame(pts, "id long, x double, y double"), e, band=70.0).collect())
    odd = lambda x, y: sum((b > y) != (d > y) and a + (y - b) * (c - a) / (d - b) > x for a, b, c, d in edges) % 2
    assert got == sorted(k for k, x, y in pts if odd(x, y))


def test_tiles_within_a_turned_box(spark):
    quad = [(0.0, 40.0), (220.0, 0.0), (300.0, 250.0), (60.0, 300.0)]
    got = {(r.j, r.i) for r in landuse.tiles_within(spark, quad).collect()}

    def meets(j, i):  # by a fine lattice of the tile
        cross = lambda a, b, x, y: (b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])
        return any(all(cross(a, b, 30 * j + u, 30 * i + v) >= 0 for a, b in zip(quad, [*quad[1:], quad[0]], strict=True)) for u in range(31) for v in range(31))

    assert {(j, i) for j in range(10) for i in range(10) if meets(j, i)} <= got and len(got) < 100


def test_neighbours_far_north(spark):
    day = D(2020, 1, 1)
    rows = [(k, day, 70.0 + 0.03 * (k % 7), 20.0 + 0.08 * (k % 11)) for k in range(60)]
    d = spark.createDataFrame(rows, "sensor_id long, date date, latitude double, longitude double").withColumn("pm25", F.lit(1.0))
    got = {(r.sensor_id, r.other) for r in readings.neighbours(d, d, 5.0).collect()}

    def km(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[3] - a[3]) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h))

    assert got == {(a[0], b[0]) for a in rows for b in rows if a[0] != b[0] and km(a, b) <= 5.0}


def test_regression_with_gaps_and_blocks(spark):
    schema = "id long, x array<double>, y double, cx double, cy double, t double"
    rows = [(k, [1.0, k % 5 / 5.0], k % 7 + 0.5, k * 3.0 % 50, k * 7.0 % 50, float(k % 3)) for k in range(40)]
    train = spark.createDataFrame([*rows, (99, [1.0, None], 1.0, 0.0, 0.0, 0.0), (98, [1.0, 1.0], None, 0.0, 0.0, 0.0)], schema)
    query = spark.createDataFrame([(1, [1.0, 0.5], None, 10.0, 10.0, None), (2, [1.0, 0.2], None, None, 3.0, 1.0)], schema)
    one = {r.id: r.prediction for r in gtwr.predict(train, query, 2, hs=20.0, ht=5.0, parts=1, blocks=1).collect()}
    many = {r.id: r.prediction for r in gtwr.predict(train, query, 2, hs=20.0, ht=5.0, parts=3, blocks=5).collect()}
    assert one.keys() == many.keys() == {1, 2} and all(one[k] == pytest.approx(many[k]) for k in one)
    w = np.array([math.exp(-((10 - r[3]) ** 2 + (10 - r[4]) ** 2) / 400) for r in rows])  # no time, no time weight
    X, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    beta = np.linalg.solve((X * w[:, None]).T @ X, (X * w[:, None]).T @ y)
    assert one[1] == pytest.approx(float(beta @ [1.0, 0.5]))
    near = gtwr.predict(train, query.where("id = 1"), 2, hs=20.0, cutoff=1000.0).first().prediction
    assert near == pytest.approx(gtwr.predict(train, query.where("id = 1"), 2, hs=20.0).first().prediction)


def test_life_spans_and_fill_report(spark):
    s = spark.createDataFrame([(1, D(2020, 1, 1), D(2020, 1, 3)), (2, None, D(2020, 1, 3)), (3, D(2020, 1, 3), D(2020, 1, 1))], "sensor_id long, first_date date, last_date date")
    d = spark.createDataFrame([(D(2020, 1, 2),), (D(2020, 1, 3),), (D(2020, 1, 9),)], "date date")
    assert sorted((r.sensor_id, r.date.day) for r in readings.eligible(s, d).collect()) == [(1, 2), (1, 3)]
    r = spark.createDataFrame([(1.0, "exact"), (2.0, "spatial_idw"), (None, "none"), (None, None)], "pm25 double, fallback_type string")
    assert tuple(readings.fill_report(r).first()) == (3, 4, 2, pytest.approx(100 / 3))
    assert {(x.fallback_type, x.n, x.percent) for x in readings.fallback_statistics(r).collect()} == {("exact", 1, 25.0), ("spatial_idw", 1, 25.0), ("none", 1, 25.0), (None, 1, 25.0)}


def test_hexagons_are_the_nearest_centres(spark):
    import random

    r = random.Random(8)
    pts = [(k, r.uniform(-100, 100), r.uniform(-100, 100)) for k in range(200)]
    for row in rollup.hex_cells(spark.createDataFrame(pts, "id long, x double, y double"), 7.0).collect():
        centre = lambda q, s: (7 * math.sqrt(3) * (q + s / 2), 7 * 1.5 * s)
        own = math.dist(centre(row.q, row.r), (row.x, row.y))
        assert all(own <= math.dist(centre(row.q + a, row.r + b), (row.x, row.y)) + 1e-9 for a, b in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)))
