import datetime as dt

from pyspark.sql import functions as F

from aqgrid.operators import quality, raster


def test_describe_by_morphology(spark):
    rows = [(10.0, 0.4), (20.0, 0.1), (None, 0.3), (5.0, 0.41), (7.0, 0.9), (1.0, None), (1.0, 0.0), (1.0, 1.1)]
    got = {r.morphology: r for r in quality.describe_by_morphology(spark.createDataFrame(rows, "pm25 double, svf double")).collect()}
    assert {k: (r.n, r.min, r.max, r.mean, r.p50) for k, r in got.items()} == {"deep_canyon": (2, 10.0, 20.0, 15.0, 15.0), "street_canyon": (1, 5.0, 5.0, 5.0, 5.0), "suburban": (1, 7.0, 7.0, 7.0, 7.0)}
    assert abs(got["deep_canyon"]["std"] - 50**0.5) < 1e-9 and got["suburban"]["std"] is None


def test_sky_view_at_cells_and_canyon_share(spark):
    pixels = spark.createDataFrame([("a", "svf", 0, k, v) for k, v in enumerate([0.2, 0.5, 0.9])], "raster_id string, band string, row int, col int, value double")
    meta = spark.createDataFrame([("a", "svf", 0.0, 30.0, 30.0, None, None, None)], "raster_id string, band string, x_origin double, y_origin double, res double, nodata double, scale double, offset double")
    cells = spark.createDataFrame([(1, 15.0, 15.0), (2, 45.0, 15.0), (3, 75.0, 15.0), (4, 500.0, 15.0)], "id long, x double, y double")
    r = quality.canyon_share(raster.sample_nearest(cells, pixels, meta), "value").first()
    assert (r["min"], r["max"], r.n_missing, r.n_canyons, r.canyon_percent) == (0.2, 0.9, 1, 1, 25.0)
    assert abs(r["mean"] - 1.6 / 3) < 1e-9
    assert quality.canyon_share(cells.where("false").selectExpr("x AS svf")).first().canyon_percent is None


def failed(report):
    return {r.check for r in report.collect() if not r.passed}


def test_readings_report_finds_each_fault(spark):
    D = dt.date
    schema = "date date, sensor_id long, sensor_name string, latitude double, longitude double, first_date date, last_date date, pm25 double, sample_count int, actual_date date, fallback_type string, days_offset int"
    good = [(D(2020, 1, k), 1, "s", 19.0, 72.9, D(2020, 1, 1), D(2020, 1, 9), 20.0, 3, D(2020, 1, k), "exact", 0) for k in (1, 2, 3)]
    days = spark.createDataFrame([(D(2020, 1, k),) for k in (1, 2, 3)], "date date")
    make = lambda rows: spark.createDataFrame(rows, schema)
    assert failed(quality.readings_report(make(good), days)) == set()
    bad = lambda **kw: make([*good, tuple(kw.get(n, v) for n, v in zip([x.split()[0] for x in schema.split(", ")], good[0], strict=True))])
    assert failed(quality.readings_report(bad(pm25=-1.0), days)) == {"pm25_range", "pm25_below_1"}
    assert failed(quality.readings_report(bad(pm25=600.0), days)) == {"pm25_extreme", "pm25_above_300"}
    assert failed(quality.readings_report(bad(fallback_type="other"), days)) == {"fallback_type"}
    assert failed(quality.readings_report(bad(days_offset=2), days)) == {"exact_offset"}
    assert failed(quality.readings_report(bad(latitude=None), days)) == {"coordinates_missing"}
    assert failed(quality.readings_report(make(good).drop("sensor_name"), days)) == {"columns"}
    assert failed(quality.readings_report(make(good), days.union(spark.createDataFrame([(D(2020, 2, 1),)], "date date")))) == {"missing_dates"}
    thin = make(good).withColumn("pm25", F.when(F.col("date") == "2020-01-01", F.col("pm25")))
    assert failed(quality.readings_report(thin, days)) == {"pm25_coverage"}
    assert failed(quality.readings_report(make([]), days)) == {"pm25_coverage", "missing_dates"}


def test_weather_report_finds_each_fault(spark):
    D = dt.date
    schema = "date date, datetime_utc timestamp, " + ", ".join(f"{c} double" for c in (*quality.WEATHER[2:], *quality.WEATHER_DAILY)) + ", place int"
    row = lambda day, place, **kw: (D(2020, 1, day), dt.datetime(2020, 1, day, 5), *[kw.get(c, 20.0 if c != "surface_pressure" else 1000.0) for c in (*quality.WEATHER[2:], *quality.WEATHER_DAILY)], place)
    days = spark.createDataFrame([(D(2020, 1, 1),), (D(2020, 1, 2),)], "date date")
    report = lambda rows: failed(quality.weather_report(spark.createDataFrame(rows, schema), days, "place"))
    assert report([row(1, 1), row(2, 2)]) == set()
    assert report([row(1, 2), row(2, 1)]) == {"date_order"}
    assert report([row(1, 1), row(2, 2), row(2, 3)]) == {"repeated_dates"}
    assert report([row(1, 1)]) == {"missing_dates"}
    assert report([row(1, 1), row(2, 2, temperature_2m=-1.0)]) == {"temperature_2m_range"}
    assert report([row(1, 1), row(2, 2, temperature_2m=47.0)]) == {"temperature_2m_unusual"}
    assert report([row(1, 1), row(2, 2, wind_direction_10m=361.0)]) == {"wind_direction_10m_range"}
    assert report([row(1, 1), row(2, 2, surface_pressure=900.0)]) == {"surface_pressure_unusual"}
    assert report([row(1, 1), row(2, 2, cloud_cover=None)]) == {"cloud_cover_missing"}


def test_feature_and_raster_reports(spark):
    schema = "grid_id long, date date, toa_b1 double, s5p_no2 double, s5p_no2_is_nodata boolean, sentinel2_evi double, sentinel2_evi_is_nodata boolean, pct_unpaved double, industrial_area_m2 double, pm25 double"
    make = lambda *rows: spark.createDataFrame([(1, dt.date(2020, 1, 1), *r) for r in rows], schema)
    good = (0.5, 1.0, False, 0.2, False, 50.0, 3.0, 10.0)
    assert failed(quality.feature_report(make(good))) == set()
    assert failed(quality.feature_report(make(good, (3.0, -1.0, True, 9.0, False, 150.0, -1.0, 1e4)))) == {"toa_b1_range", "sentinel2_evi_range", "pct_unpaved_range", "industrial_area_m2_range", "pm25_range"}
    assert failed(quality.feature_report(make((0.5, None, True, 0.2, False, 5.0, 3.0, None)))) == {"s5p_no2_valid", "pm25_valid"}
    assert "rows" in failed(quality.feature_report(make().drop("date")))
    px = lambda *v: spark.createDataFrame([(0, k, x) for k, x in enumerate(v)], "row int, col int, value double")
    meta = lambda res, step: spark.createDataFrame([("a", 0.0, 10.0, res, step)], "raster_id string, x_origin double, y_origin double, res double, y_step double")
    box = (0.0, 0.0, 30.0, 10.0)
    assert failed(quality.raster_report(px(0.1, 0.9), meta(3.0, -3.0), res=3.0, extent=box)) == set()
    assert failed(quality.raster_report(px(0.5, 0.5), meta(3.2, 3.2), res=3.0, extent=box)) == {"spread", "resolution", "north_up"}
    assert failed(quality.raster_report(px(0.1, 1.5, None), meta(20.0, -20.0), res=20.0, extent=box)) == {"value_range", "nodata_percent", "extent"}
    assert "nodata_percent" in failed(quality.raster_report(px(None), meta(3.0, -3.0), res=3.0))


def test_grid_report_counts_what_lies_inside(spark):
    g = spark.createDataFrame([(k, 30.0 * (k % 5), 30.0 * (k // 5)) for k in range(25)], "grid_id long, x double, y double")
    box = lambda x: spark.createDataFrame([(-5.0, -5.0, x, -5.0), (x, -5.0, x, 200.0), (x, 200.0, -5.0, 200.0), (-5.0, 200.0, -5.0, -5.0)], "x1 double, y1 double, x2 double, y2 double")
    assert failed(quality.grid_report(g, box(125.0))) == set()
    assert failed(quality.grid_report(g, box(100.0))) == {"inside_percent"}
    assert failed(quality.grid_report(g.union(g.limit(1)))) == {"unique_ids", "unique_places"}
