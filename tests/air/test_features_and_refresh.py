"""The training table, tables by date with manifests, the refresh by late readings, crossings of rings, shifted regression."""

import datetime as dt
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from aqgrid.operators import features, gtwr, landuse, readings
from aqgrid.sources import dated
from aqgrid.streaming import features as refreshed

D = dt.date
ROWS = "id long, date date"


def test_static_side_has_no_exchange(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        land = spark.range(50).select(F.col("id").alias("grid_id"), (F.col("id") * 2).alias("dust"))
        layers = spark.createDataFrame([(g, y, g + y / 1e4) for g in range(40) for y in (2019, 2021)] + [(1, 2021, 0.0), (2, None, 9.0)], "grid_id long, year int, svf double")
        features.bucketed(land, "t_land", 4)
        features.bucketed(features.by_year(layers, "svf"), "t_sky", 4)
        cells = spark.createDataFrame([(g, D(y, 5, 1)) for g in range(50) for y in (2018, 2019, 2020, 2022)] * 2, "grid_id long, date date")
        out = features.as_of(features.static_join(spark, cells, ["t_land", "t_sky"]), "svf")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"(?<!AQE)Exchange hashpartitioning", plan)) == 1, plan  # the cells, once
        got = {(r.grid_id, r.date.year): (r.dust, r.svf, r.svf_year) for r in out.collect()}
        assert out.count() == 400 and got[3, 2018] == (6, None, None) and got[3, 2020] == (6, 3 + 0.2019, 2019)
        assert got[3, 2022] == (6, 3 + 0.2021, 2021) and got[45, 2022] == (90, None, None) and got[1, 2022][1] == 1.2021
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS t_land")
        spark.sql("DROP TABLE IF EXISTS t_sky")


def test_sensors_to_cells(spark):
    grid = spark.createDataFrame([(10 * i + j, j, i) for i in range(3) for j in range(3)], "grid_id long, ix int, iy int")
    s = spark.createDataFrame([(1, 100.0, 200.0), (2, 129.9, 230.0), (3, 99.0, 200.0), (4, None, 1.0), (5, 100.0, 200.0), (1, 100.0, 200.0)], "sensor_id long, x double, y double")
    a = features.assign_cells(s, grid, x0=100.0, y0=200.0, res=30.0)
    assert sorted(map(tuple, a.collect())) == [(1, 0), (2, 10), (5, 0)]
    r = spark.createDataFrame([(1, D(2020, 1, 1), 4.0, 2), (5, D(2020, 1, 1), 8.0, 3), (2, D(2020, 1, 1), None, 0)], "sensor_id long, date date, pm25 double, sample_count long")
    assert [tuple(x) for x in features.cell_readings(r, a).collect()] == [(0, D(2020, 1, 1), 6.0, 5)]


def _rows(df):
    return sorted(map(tuple, df.select("id", "date").collect()))


def test_dated_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda *rows: spark.createDataFrame(list(rows), ROWS)
    assert dated.read(spark, path, ROWS).collect() == []
    dated.put(make((1, D(2020, 1, 1)), (2, D(2020, 1, 2))), path, token="0", replace=False)
    dated.put(make((3, D(2020, 1, 2))), path, token="1", replace=False)
    dated.put(make((3, D(2020, 1, 2))), path, token="1", replace=False)  # a repeated batch
    three = [(1, D(2020, 1, 1)), (2, D(2020, 1, 2)), (3, D(2020, 1, 2))]
    assert _rows(dated.read(spark, path, ROWS)) == three
    assert _rows(dated.read(spark, path, ROWS, [D(2020, 1, 2), D(2020, 1, 9)])) == three[1:]
    before = dated.read(spark, path, ROWS)  # planned on the manifest before the compaction
    assert dated.compact(spark, path, ROWS) == ["2020-01-02"]
    assert _rows(before) == three == _rows(dated.read(spark, path, ROWS))
    assert dated.compact(spark, path, ROWS) == [] and all(len(g) == 1 for g in dated.latest(spark, path)["dates"].values())
    assert dated.clean(spark, path, keep=2) == 0 and _rows(before) == three
    assert dated.clean(spark, path, keep=1) == 2 and _rows(dated.read(spark, path, ROWS)) == three
    dated.put(make((9, D(2020, 1, 1))), path, dates=[D(2020, 1, 1), D(2020, 1, 2)])
    assert _rows(dated.read(spark, path, ROWS)) == [(9, D(2020, 1, 1))]


def test_compaction_while_others_read(spark, tmp_path):
    """Readings between any two steps of writer and compaction see each row once."""
    path, want = str(tmp_path / "t"), []
    for n in range(4):
        rows = [(10 * n + k, D(2020, 1, 1 + k % 2)) for k in range(6)]
        want += rows
        dated.put(spark.createDataFrame(rows, ROWS), path, token=str(n), replace=False)
        m, seen = dated.latest(spark, path), dated.read(spark, path, ROWS)
        dated.compact(spark, path, ROWS)
        assert _rows(seen) == _rows(dated.read(spark, path, ROWS, manifest=m)) == _rows(dated.read(spark, path, ROWS)) == sorted(want)
        dated.clean(spark, path)


def test_refresh_equals_one_batch(spark, tmp_path):
    r = random.Random(1)
    days = [D(2020, 2, 20) + dt.timedelta(k) for k in range(25)] + [D(2021, 3, 1), D(2019, 2, 28), D(2021, 2, 28)]
    rows = [(s, dt.datetime(d.year, d.month, d.day, h), 2, "pm25", float(r.randrange(50))) for s in (1, 2) for d in days if r.random() < 0.5 for h in (1, 5, 9)]
    r.shuffle(rows)
    schema = "sensor_id long, ts timestamp, parameter_id int, parameter_name string, value double"
    targets = spark.createDataFrame([(s, d) for s in (1, 2, 3) for d in [*days, D(2020, 2, 29), D(2022, 1, 1)]], "sensor_id long, date date").distinct()
    store, src = str(tmp_path / "store"), str(tmp_path / "in")
    cols = ["sensor_id", "date", "pm25", "sample_count", "actual_date", "fallback_type", "days_offset"]
    table = lambda d: {(x.sensor_id, x.date): tuple(x)[2:] for x in d.select(*cols).collect()}
    for k in range(3):
        spark.createDataFrame(rows[k::3], schema).coalesce(1).write.mode("append").parquet(src)
        refreshed.refresh_stream(spark.readStream.schema(schema).parquet(src), targets, store, str(tmp_path / "state"))
        so_far = spark.createDataFrame([x for i in range(k + 1) for x in rows[i::3]], schema)
        want = table(readings.with_fallback(targets, readings.daily_mean(so_far)))
        got = table(dated.read(spark, f"{store}/features", refreshed.REFRESHED))
        assert all(got[x] == pytest.approx(want[x]) if want[x][0] is None else got[x][0] == pytest.approx(want[x][0]) and got[x][1:] == want[x][1:] for x in got)
        assert all(v[3] == "none" for x, v in want.items() if x not in got)  # dates that nothing has touched yet
    before = dated.latest(spark, f"{store}/features")
    refreshed.refresh(spark, spark.createDataFrame(rows[2::3], schema), "2", targets, store)  # the last batch once more
    assert dated.latest(spark, f"{store}/features") == before


RING = "feature_id long, ring array<struct<x: double, y: double>>"


def test_rings_that_meet_themselves(spark):
    sq = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 100.0), (0.0, 0.0)]
    bow = [(0.0, 0.0), (100.0, 100.0), (100.0, 0.0), (0.0, 100.0), (0.0, 0.0)]
    touch = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (50.0, 0.0), (0.0, 100.0), (0.0, 0.0)]
    spike = [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (100.0, 50.0), (0.0, 100.0), (0.0, 0.0)]
    hole = [(0.0, 0.0), (90.0, 0.0), (90.0, 90.0), (0.0, 90.0), (0.0, 0.0), (20.0, 20.0), (40.0, 20.0), (0.0, 0.0)]
    twice = [(0.0, 0.0), (0.0, 0.0), (100.0, 0.0), (100.0, 0.0), (100.0, 100.0), (0.0, 0.0), (0.0, 0.0)]
    d = spark.createDataFrame([(1, sq), (2, bow), (3, touch), (4, spike), (5, hole), (6, twice), (7, sq[:-1]), (8, []), (9, None), (2, bow)], RING)
    got = {r.feature_id: (r.n_crossings, r.valid) for r in landuse.valid_rings(d).collect()}
    assert {k for k, (n, _) in got.items() if n} == {2, 3, 4, 5}
    assert got[2] == (1, False) and got[1] == (0, True) and got[6][0] == 0 and got[7][0] == 0


def test_crossings_match_all_pairs(spark):
    r = random.Random(7)
    rings = {}
    for k in range(60):
        n = r.randrange(4, 14)
        ring = [(float(r.randrange(12) * 20), float(r.randrange(12) * 20)) for _ in range(n)]
        ring = [p for i, p in enumerate(ring) if i == 0 or p != ring[i - 1]]
        rings[k] = [*ring, ring[0]] if ring[0] != ring[-1] else ring
    side = lambda a, b, c: (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])

    def meets(a, b, c, d):
        if any(max(a[i], b[i]) < min(c[i], d[i]) or max(c[i], d[i]) < min(a[i], b[i]) for i in (0, 1)):
            return False
        return side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0

    want = {}
    for k, ring in rings.items():
        e = list(zip(ring, ring[1:], strict=False))
        hits = 0
        for i in range(len(e)):
            for j in range(i + 1, len(e)):
                (a, b), (c, d) = e[i], e[j]
                if j == i + 1 or (i == 0 and j == len(e) - 1):
                    dot = (b[0] - a[0]) * (d[0] - c[0]) + (b[1] - a[1]) * (d[1] - c[1])
                    hits += side(a, b, c) == side(a, b, d) == 0 and dot < 0
                else:
                    hits += meets(a, b, c, d)
        if hits:
            want[k] = hits
    got = landuse.ring_crossings(spark.createDataFrame(list(rings.items()), RING), 30.0).collect()
    assert {r.feature_id: r.n_crossings for r in got} == want and len(want) < 60


def test_regression_of_a_target_far_from_zero(spark):
    schema = "id long, x array<double>, y double, cx double, cy double, t double"
    r = random.Random(3)
    rows = [(k, [1.0, r.random()], r.random(), r.uniform(0, 50), r.uniform(0, 50), float(k % 3)) for k in range(80)]
    asked = spark.createDataFrame([(k, [1.0, r.random()], r.uniform(0, 50), r.uniform(0, 50), 1.0) for k in range(20)], "id long, x array<double>, cx double, cy double, t double")
    out = {}
    for far in (0.0, 1e6):
        train = spark.createDataFrame([(k, x, y + far, *z) for k, x, y, *z in rows], schema)
        out[far] = {v.id: (v.prediction - far, v.uncertainty) for v in gtwr.predict(train, asked, 2, hs=20.0, ht=5.0).collect()}
    for k, (p, u) in out[0.0].items():
        assert out[1e6][k][1] == pytest.approx(u, rel=1e-6) and out[1e6][k][0] == pytest.approx(p, abs=1e-6)
    x, y = np.array([v[1] for v in rows]), np.array([v[2] for v in rows])
    q = asked.first()
    w = np.array([max(1e-12, math.exp(-((v[3] - q.cx) ** 2 + (v[4] - q.cy) ** 2) / 400) * math.exp(-((v[5] - q.t) ** 2) / 25)) for v in rows])
    beta = np.linalg.pinv(x.T @ (w[:, None] * x)) @ (x.T @ (w * y))
    assert out[0.0][q.id] == pytest.approx((float(np.dot(q.x, beta)), math.sqrt(float((w * (y - x @ beta) ** 2).sum() / (w.sum() + 1e-12)))), rel=1e-9)


def test_regression_by_nodes_equals_all_pairs(spark):
    """Near queries and far ones, crowds apart from each other, and rows without a time or a place."""
    schema = "id long, x array<double>, y double, cx double, cy double, t double"
    r = random.Random(5)
    some = lambda v, k: None if r.random() < k else v
    place = lambda k: (r.uniform(0, 9) + 80 * (k % 3 == 0), r.uniform(0, 9) + 70 * (k % 3 == 1)) if k % 2 else (r.uniform(0, 100), r.uniform(0, 100))
    rows = [(k, [1.0, r.random()], r.uniform(-9, 9), *((some(v, 0.03)) for v in place(k % 6 | 1)), some(r.uniform(0, 9), 0.1)) for k in range(400)]
    asked = [(k, [1.0, r.random()], 0.0, *((some(v, 0.03)) for v in place(k)), some(r.uniform(0, 9), 0.1)) for k in range(300)]
    train, query = spark.createDataFrame(rows, schema), spark.createDataFrame(asked, schema)
    of = lambda **o: {v.id: (v.prediction, v.uncertainty) for v in gtwr.predict(train, query, 2, **o).collect()}
    for h in ({"hs": 30.0, "ht": 5.0}, {"hs": 27.5}, {"hs": 1000.0, "ht": 1000.0}, {"hs": 5.0, "ht": 1.0}):  # the last reaches the least weight
        got, want = of(**h), of(**h, parts=2, blocks=3)
        assert len(got) == 300 and got.keys() == want.keys()
        assert all(got[k] == pytest.approx(want[k], rel=1e-7, abs=1e-7) for k in want), h
    one = spark.createDataFrame([(k, [1.0], float(k), 3.0, 4.0, 5.0) for k in range(4)], schema)
    assert [v.prediction for v in gtwr.predict(one, one.limit(1), 1, hs=1.0, ht=1.0).collect()] == pytest.approx([1.5])


def test_regression_grows_with_the_rows_not_the_pairs(spark):
    from aqgrid.plans import registry

    assert "CoGroupsInPandas" not in registry.queries()["m3_gtwr"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_rows_of_all_dates_are_neither_shuffled_nor_paired(spark):
    """Cells meet the dates as lists, after the last exchange and sort."""
    from aqgrid.plans import registry

    text = registry.queries()["r1_training_table"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    above = text[: text.index("Generate posexplode")]
    assert "Exchange hashpartitioning" not in above and "Sort [" not in above


def test_training_table_of_a_few_cells(spark):
    day = lambda y, d: D(y, 5, d)
    make = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    try:
        features.bucketed(make("grid_id long, dust double", (1, 5.0)), "t_few_land", 2)
        features.bucketed(features.by_year(make("grid_id long, year int, svf double", (1, 2020, 0.5)), "svf"), "t_few_sky", 2)
        out = features.training_table(
            make("grid_id long", (1,), (2,)), make(ROWS.replace("id long, ", ""), (day(2019, 1),), (day(2020, 1),), (day(2020, 2),), (day(2020, 1),)),
            bands=make("grid_id long, date date, b double", (1, day(2020, 1), 3.0), (1, day(2020, 9), 4.0), (7, day(2020, 1), 4.0)), layers=["svf"],
            signals={"no2": make("grid_id long, date date, value double, is_nodata boolean", (2, day(2020, 2), 7.0, False), (1, day(2020, 1), None, True))},
            daily=make("date date, temp double", (day(2020, 1), 20.0)), measured=make("grid_id long, date date, pm25 double", (2, day(2019, 1), 9.0)), static=["t_few_land", "t_few_sky"],
        )
        assert out.columns == ["grid_id", "date", "b", "dust", "svf", "svf_year", "no2", "no2_is_nodata", "temp", "pm25"]
        assert sorted(map(tuple, out.collect())) == [
            (1, day(2019, 1), None, 5.0, None, None, None, True, None, None),
            (1, day(2020, 1), 3.0, 5.0, 0.5, 2020, None, True, 20.0, None),
            (1, day(2020, 2), None, 5.0, 0.5, 2020, None, True, None, None),
            (2, day(2019, 1), None, None, None, None, None, True, None, 9.0),
            (2, day(2020, 1), None, None, None, None, None, True, 20.0, None),
            (2, day(2020, 2), None, None, None, None, 7.0, False, None, None),
        ]
    finally:
        spark.sql("DROP TABLE IF EXISTS t_few_land")
        spark.sql("DROP TABLE IF EXISTS t_few_sky")


def _substitute(have, day, window=7):
    """The reading of a target by trying its days one after the other."""
    tries = [(day, "exact")] + [(day + dt.timedelta(o), "window") for k in range(1, window + 1) for o in (-k, k)]
    if (day.month, day.day) != (2, 29):
        tries += [(day.replace(year=day.year + y), "seasonal") for y in (-1, 1)]
    return next(((have[d][0], have[d][1], d, kind, (d - day).days) for d, kind in tries if d in have and have[d][1] >= 3), (None, 0, None, "none", 0))


def test_substitutes_by_their_order(spark):
    """Ties, months and years apart, leap days, sensors without readings, repeated targets; no target is spread over its days."""
    r = random.Random(11)
    span = [D(2019, 2, 1) + dt.timedelta(k) for k in range(1200)]
    daily = {(s, d): (float(r.randrange(90)), r.choice([1, 3, 8])) for s in range(1, 9) for d in span if r.random() < s / 80}
    daily |= {(9, D(2020, 2, 29)): (1.0, 5), (9, D(2021, 2, 28)): (2.0, 5), (10, D(2020, 3, 1)): (3.0, 3), (10, D(2020, 3, 7)): (4.0, 3)}
    asked = [(s, d, float(s)) for s in range(0, 11) for d in span if s > 8 or r.random() < 0.3] + [(9, D(2020, 2, 28), 9.0), (None, D(2020, 3, 1), 0.0), (3, None, 0.0)]
    measured = spark.createDataFrame([(*k, *v) for k, v in daily.items()] + [(None, D(2020, 3, 1), 7.0, 9)], "sensor_id long, date date, pm25 double, sample_count long")
    out = readings.with_fallback(spark.createDataFrame(asked, "sensor_id long, date date, latitude double"), measured)
    want = [(*a, *(_substitute({d: v for (s, d), v in daily.items() if s == a[0]}, a[1]) if None not in a else (None, 0, None, "none", 0))) for a in asked]
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key) and {x[6] for x in want} == {"exact", "window", "seasonal", "none"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window [" in plan and "date_add(" not in plan
