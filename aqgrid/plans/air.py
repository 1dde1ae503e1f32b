"""One query for each operator, with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aqgrid.functions import columns as C
from aqgrid.operators import features, gtwr, landuse, quality, raster, readings, rollup, signals, weather
from aqgrid.plans import standins as S
from aqgrid.plans.queries import query
from aqgrid.plans.standins import sql, table
from aqgrid.sources import dated, scratch, tables
from aqgrid.streaming import features as refreshed
from aqgrid.streaming import readings as streams


def r6(df, *names):
    """Doubles rounded to six places, as sums depend on their order."""
    return df.withColumns({c: F.round(c, 6) for c in names})


def near6(df, *names):
    """The same for statistics of values with few decimals: those often end in a 5 at the seventh place, which the last bits
    of a sum would round up or down. The SQL adds the same hair."""
    return df.withColumns({c: F.round(F.col(c) + 3e-8, 6) for c in names})


def _folder(spark, name):
    """A new folder in what driver and executors share."""
    return scratch.fresh_dir(spark, name)


# ---- readings

A1 = "SELECT sensor_id, date, round(pm25, 6) AS pm25, sample_count FROM daily"


@query("a1_daily_mean", sql(A1, "meas", "daily"))
def a1(spark, d):
    return r6(readings.daily_mean(S.measurements(spark, d)), "pm25")


_CAND = """offs AS (SELECT 0 AS o, 0 AS p, 'exact' AS kind UNION ALL SELECT -k, 2 * k - 1, 'window' FROM range(1, 8) t(k) UNION ALL SELECT k, 2 * k, 'window' FROM range(1, 8) t(k)),
tg AS (SELECT sensor_id, date FROM sens CROSS JOIN days),
cand AS (SELECT sensor_id, date, CAST(date + CAST(o AS INTEGER) AS DATE) AS day, p, kind FROM tg CROSS JOIN offs
  UNION ALL SELECT sensor_id, date, CAST(date + y * INTERVAL 1 YEAR AS DATE), 1000 + CASE WHEN y > 0 THEN 1 ELSE 0 END, 'seasonal' FROM tg CROSS JOIN (SELECT unnest([-1, 1]) AS y) WHERE NOT (month(date) = 2 AND day(date) = 29)),
best AS (SELECT c.sensor_id, c.date, d.pm25, d.sample_count, c.day, c.kind, row_number() OVER (PARTITION BY c.sensor_id, c.date ORDER BY p) AS rn
  FROM cand c JOIN daily d ON d.sensor_id = c.sensor_id AND d.date = c.day AND d.sample_count >= 3),
fb AS (SELECT tg.sensor_id, tg.date, b.pm25, coalesce(b.sample_count, 0) AS sample_count, b.day AS actual_date, coalesce(b.kind, 'none') AS fallback_type,
  CAST(coalesce(b.day - tg.date, 0) AS BIGINT) AS days_offset FROM tg LEFT JOIN best b ON b.sensor_id = tg.sensor_id AND b.date = tg.date AND b.rn = 1)"""


def _targets(spark, d):
    return S.sensors(spark, d).crossJoin(S.days(spark, d))


def _readings(spark, d):
    return readings.with_fallback(_targets(spark, d), readings.daily_mean(S.measurements(spark, d)))


J4 = sql(_CAND + " SELECT sensor_id, date, round(pm25, 6) AS pm25, sample_count, actual_date, fallback_type, days_offset FROM fb", "meas", "daily", "sens", "days")


@query("j4_fallback", J4)
def j4(spark, d):
    return r6(_readings(spark, d).drop("latitude", "longitude"), "pm25")


_KM = """2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)) FROM (SELECT *, pow(sin(radians(olat - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians(olat)) * pow(sin(radians(olon - longitude) / 2), 2) AS h"""
_THIN = """tg AS (SELECT sensor_id, date FROM sens CROSS JOIN days),
fb AS (SELECT tg.sensor_id, tg.date, d.pm25, coalesce(d.sample_count, 0) AS sample_count, d.date AS actual_date, CASE WHEN d.date IS NULL THEN 'none' ELSE 'exact' END AS fallback_type, CAST(0 AS BIGINT) AS days_offset
  FROM tg LEFT JOIN daily d ON d.sensor_id = tg.sensor_id AND d.date = tg.date AND d.sample_count >= 3)"""
_IDW = (
    _THIN
    + f""", rd AS (SELECT fb.*, latitude, longitude FROM fb JOIN sens USING (sensor_id)),
pr AS (SELECT sensor_id, date, other, opm, {_KM} FROM (SELECT a.sensor_id, a.date, a.latitude, a.longitude, b.sensor_id AS other, b.latitude AS olat, b.longitude AS olon, b.pm25 AS opm
  FROM rd a JOIN rd b ON a.date = b.date AND a.sensor_id <> b.sensor_id WHERE a.pm25 IS NULL AND b.pm25 IS NOT NULL AND a.latitude IS NOT NULL AND b.latitude IS NOT NULL))),
pk AS (SELECT sensor_id, date, other, opm, km FROM pr t(sensor_id, date, other, opm, km) WHERE km <= 3),
est AS (SELECT sensor_id, date, coalesce(arg_min(opm, other) FILTER (km < 0.001), sum(opm / (km * km)) FILTER (km >= 0.001) / sum(1 / (km * km)) FILTER (km >= 0.001)) AS idw FROM pk GROUP BY ALL HAVING count(*) >= 3),
filled AS (SELECT rd.sensor_id, rd.date, coalesce(rd.pm25, idw) AS pm25, sample_count, actual_date, CASE WHEN rd.pm25 IS NULL AND idw IS NOT NULL THEN 'spatial_idw' ELSE fallback_type END AS fallback_type,
  CASE WHEN rd.pm25 IS NULL AND idw IS NOT NULL THEN 0 ELSE days_offset END AS days_offset, latitude, longitude FROM rd LEFT JOIN est USING (sensor_id, date))"""
)


def _thin(spark, d):
    """Readings without the window and the seasonal search, so that many are left to fill."""
    return readings.with_fallback(_targets(spark, d), readings.daily_mean(S.measurements(spark, d)), window_days=0, seasonal=False)


@query("m9_idw_fill", sql(_IDW + " SELECT sensor_id, date, round(pm25, 6) AS pm25, sample_count, actual_date, fallback_type, days_offset FROM filled", "meas", "daily", "sens", "days"))
def m9(spark, d):
    return r6(readings.idw_fill(_thin(spark, d), max_km=3.0).drop("latitude", "longitude"), "pm25")


@query("a13_fallback_statistics", sql(_IDW + " SELECT fallback_type, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM filled GROUP BY 1", "meas", "daily", "sens", "days"))
def a13(spark, d):
    return r6(readings.fallback_statistics(readings.idw_fill(_thin(spark, d), max_km=3.0)), "percent")


@query(
    "a14_fill_report",
    sql(_IDW + " SELECT (SELECT count(*) FILTER (pm25 IS NULL) FROM fb) AS missing_before, count(*) AS n_rows, count(*) FILTER (pm25 IS NULL) AS missing_after, round(100.0 * ((SELECT count(*) FILTER (pm25 IS NULL) FROM fb) - count(*) FILTER (pm25 IS NULL)) / (SELECT count(*) FILTER (pm25 IS NULL) FROM fb), 6) AS filled_percent FROM filled", "meas", "daily", "sens", "days"),
)
def a14(spark, d):
    return r6(readings.fill_report(readings.idw_fill(_thin(spark, d), max_km=3.0)), "filled_percent")


@query("p10_eligible_dates", sql("life AS (SELECT user_id AS sensor_id, min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date FROM events GROUP BY 1) SELECT sensor_id, date FROM life JOIN days ON date BETWEEN first_date AND last_date", "days"))
def p10(spark, d):
    life = table(spark, d, "events").groupBy(F.col("user_id").alias("sensor_id")).agg(F.min(F.to_date("ts")).alias("first_date"), F.max(F.to_date("ts")).alias("last_date"))
    return readings.eligible(life, S.days(spark, d)).select("sensor_id", "date")


# ---- weather

_DAY = """SELECT CAST(datetime AS DATE) AS date, avg(temperature_2m) AS temp_mean, max(temperature_2m) AS temp_max, min(temperature_2m) AS temp_min, avg(relative_humidity_2m) AS rh_mean,
avg(wind_speed_10m) AS wind_speed_mean, max(wind_speed_10m) AS wind_speed_max, coalesce(sum(precipitation), 0) AS precip_total, avg(cloud_cover) AS cloud_cover_mean, avg(surface_pressure) AS pressure_mean FROM hourly GROUP BY 1"""
_MEANS = ("temp_mean", "rh_mean", "wind_speed_mean", "precip_total", "cloud_cover_mean", "pressure_mean")
_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in _MEANS)


@query("a2_daily_weather", sql(f"SELECT date, temp_max, temp_min, wind_speed_max, {_ROUND} FROM ({_DAY})", "hourly"))
def a2(spark, d):
    return weather.daily_weather(S.hourly(spark, d)).withColumns({c: F.round(c, 6) for c in _MEANS})


_NEAR = """tg AS (SELECT date, date + INTERVAL 5 HOUR AS target FROM days),
nr AS (SELECT date, h.*, abs(epoch(datetime) - epoch(target)) AS away, row_number() OVER (PARTITION BY date ORDER BY abs(epoch(datetime) - epoch(target)), datetime) AS rn
  FROM tg JOIN hourly h ON abs(epoch(datetime) - epoch(target)) <= 10800)"""


@query("j3_nearest_hour", sql(_NEAR + " SELECT date, datetime AS datetime_utc, temperature_2m, cloud_cover, CASE WHEN away > 0 THEN away / 3600.0 END AS hours_offset FROM nr WHERE rn = 1", "days", "hourly"))
def j3(spark, d):
    return weather.nearest_hour(S.hourly(spark, d), S.days(spark, d)).select("date", "datetime_utc", "temperature_2m", "cloud_cover", "hours_offset")


@query("j2_matched_weather", sql(_NEAR + f" SELECT n.date, n.datetime AS datetime_utc, round(w.temp_mean, 6) AS temp_mean, round(w.precip_total, 6) AS precip_total FROM nr n LEFT JOIN ({_DAY}) w ON w.date = n.date WHERE rn = 1", "days", "hourly"))
def j2(spark, d):
    out = weather.matched_weather(S.hourly(spark, d), S.days(spark, d))
    return out.select("date", "datetime_utc", F.round("temp_mean", 6).alias("temp_mean"), F.round("precip_total", 6).alias("precip_total"))


# ---- time signals and scenes

_NB = "tg AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders), nb AS (SELECT tg.date, max(o.date) FILTER (o.date < tg.date) AS prev, min(o.date) FILTER (o.date > tg.date) AS next FROM tg LEFT JOIN (SELECT DISTINCT date FROM obs) o ON abs(o.date - tg.date) <= 30 AND o.date <> tg.date GROUP BY 1)"


@query("j5_neighbour_dates", sql(_NB + " SELECT * FROM nb", "obs"))
def j5(spark, d):
    return signals.neighbour_dates(S.order_dates(spark, d), S.observed(spark, d))


@query(
    "j6_month_source",
    sql(
        """src AS (SELECT DISTINCT date FROM scenes WHERE cloud < 2), m AS (SELECT 12 * year(date) + month(date) AS m, max(date) AS source_date FROM src GROUP BY 1), tg AS (SELECT DISTINCT date FROM scenes)
SELECT tg.date, (SELECT arg_max(source_date, m) FROM m WHERE m BETWEEN 12 * year(tg.date) + month(tg.date) - 12 AND 12 * year(tg.date) + month(tg.date)) AS source_date FROM tg""",
        "scenes",
    ),
)
def j6(spark, d):
    return signals.month_source(S.order_dates(spark, d), signals.clear_dates(S.scenes(spark, d), 2))


_W5 = _NB + """, ip AS (SELECT p.cell, nb.date, CASE WHEN nb.next IS NULL THEN p.value ELSE p.value * (1 - CAST(nb.date - nb.prev AS DOUBLE) / (nb.next - nb.prev)) + n.value * (CAST(nb.date - nb.prev AS DOUBLE) / (nb.next - nb.prev)) END AS value
FROM nb JOIN obs p ON p.date = nb.prev LEFT JOIN obs n ON n.date = nb.next AND n.cell = p.cell
UNION ALL SELECT n.cell, nb.date, n.value FROM nb JOIN obs n ON n.date = nb.next WHERE nb.prev IS NULL)"""


@query("w5_interpolate", sql(_W5 + " SELECT cell, date, round(value, 6) AS value, value IS NULL AS is_nodata FROM ip", "obs"))
def w5(spark, d):
    return r6(signals.interpolate(S.order_dates(spark, d), S.observed(spark, d)), "value")


@query(
    "m10_choose_source",
    sql(
        _W5
        + """, cells AS (SELECT c.cell, tg.date FROM (SELECT DISTINCT cell FROM obs) c CROSS JOIN tg)
SELECT cell, date, round(coalesce(o.value, ip.value), 6) AS value, CASE WHEN o.value IS NOT NULL THEN 'observed' WHEN ip.value IS NOT NULL THEN 'interpolated' ELSE 'blank' END AS method
FROM cells LEFT JOIN obs o USING (cell, date) LEFT JOIN ip USING (cell, date)""",
        "obs",
    ),
)
def m10(spark, d):
    o, t = S.observed(spark, d), S.order_dates(spark, d)
    cells = o.select("cell").distinct().crossJoin(t)
    return r6(signals.choose_source(cells, o, signals.interpolate(t, o)), "value")


@query("a11_clearest_by_month", sql("SELECT CAST(date_trunc('month', date) AS DATE) AS month, arg_min(date, cloud * 100000 + (date - DATE '1970-01-01')) AS date, min(cloud) AS cloud FROM scenes WHERE cloud < 50 GROUP BY 1", "scenes"))
def a11(spark, d):
    return signals.clearest_by_month(S.scenes(spark, d), 50)


@query("a12_clear_dates", sql("SELECT DISTINCT date FROM scenes WHERE cloud < 15", "scenes"))
def a12(spark, d):
    return signals.clear_dates(S.scenes(spark, d))


@query("s12_merge_dates", sql("SELECT date FROM scenes WHERE cloud < 3 UNION SELECT date FROM days", "scenes", "days"))
def s12(spark, d):
    return tables.merge_dates(signals.clear_dates(S.scenes(spark, d), 3), S.days(spark, d))


@query("s9_pending", sql("SELECT DISTINCT date FROM scenes WHERE date NOT IN (SELECT date FROM scenes WHERE cloud < 15)", "scenes"))
def s9(spark, d):
    return tables.pending(S.order_dates(spark, d), signals.clear_dates(S.scenes(spark, d)))


@query("s6_sensor_ids", "SELECT DISTINCT user_id AS sensor_id FROM events")
def s6(spark, d):
    return tables.sensor_ids(table(spark, d, "events"), "user_id").withColumnRenamed("user_id", "sensor_id")


@query("s1_dates", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders")
def s1(spark, d):
    lines = table(spark, d, "orders").select(F.concat(F.lit("﻿ "), F.to_date("o_orderdate").cast("string"), F.lit(" ")).alias("value"))
    return tables.parse_dates(lines.unionByName(lines.select(F.lit(" ").alias("value")).limit(1)))


@query("s3_measurements", "SELECT user_id AS sensor_id, ts, CAST(2 AS INTEGER) AS parameter_id, 'pm25' AS parameter_name, value FROM events")
def s3(spark, d):
    m = S.measurements(spark, d)
    entry = F.struct(F.struct(F.lit(2).alias("id"), F.lit("pm25").alias("name")).alias("parameter"), F.col("value").cast("string").alias("value"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"))
    pages = m.groupBy("sensor_id", F.to_date("ts").alias("page")).agg(F.collect_list(entry).alias("results"))
    return tables.flatten_measurements(pages.select(F.to_json(F.struct("sensor_id", "results")).alias("json")))


@query("s11_attach_signal", sql("SELECT cell AS grid_id, date, round(value, 6) AS no2, value IS NULL AS no2_is_nodata FROM (SELECT DISTINCT cell FROM obs) CROSS JOIN (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders) LEFT JOIN obs USING (cell, date)", "obs"))
def s11(spark, d):
    o = S.observed(spark, d).withColumnRenamed("cell", "grid_id")
    cells = o.select("grid_id").distinct().crossJoin(S.order_dates(spark, d))
    return r6(tables.attach_signal(cells, o.withColumn("is_nodata", F.lit(False)), "no2"), "no2")


# ---- indices and rasters


@query(
    "p1_indices",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS b5, l_tax * 100 AS b4, l_discount * 100 AS b3, l_extendedprice / 1000 AS b6 FROM lineitem),
i AS (SELECT *, (b5 - b4) / nullif(b5 + b4, 0) AS ndvi, (b3 - b6) / nullif(b3 + b6, 0) AS mndwi, (b6 - b5) / nullif(b6 + b5, 0) AS ndbi FROM b)
SELECT l_orderkey, l_linenumber, round(ndvi, 6) AS ndvi, round(mndwi, 6) AS mndwi, round(ndbi, 6) AS ndbi,
round((b6 + b4 - b5 - b3) / nullif(b6 + b4 + b5 + b3, 0), 6) AS bsi, round(2.5 * (b5 - b4) / nullif(b5 + 6 * b4 - 7.5 * b3 + 1, 0), 4) AS evi FROM i""",
)
def p1(spark, d):
    b = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("b5"), (F.col("l_tax") * 100).alias("b4"), (F.col("l_discount") * 100).alias("b3"), (F.col("l_extendedprice") / 1000).alias("b6"))
    b3, b4, b5, b6 = (F.col(f"b{k}") for k in (3, 4, 5, 6))
    out = b.select("l_orderkey", "l_linenumber", C.ndvi(b5, b4).alias("ndvi"), C.mndwi(b3, b6).alias("mndwi"), C.ndbi(b6, b5).alias("ndbi"), C.bsi(b6, b4, b5, b3).alias("bsi"), F.round(C.evi(b5, b4, b3, 1.0), 4).alias("evi"))
    return r6(out, "ndvi", "mndwi", "ndbi", "bsi")


@query("p4_cloud_mask", "SELECT o_orderkey, (o_orderkey & 1024) = 0 AND (o_orderkey & 2048) = 0 AS clear FROM orders")
def p4(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.clear_of_cloud(F.col("o_orderkey")).alias("clear"))


@query("p5_cleaned_pixels", sql("SELECT band, CAST(r AS INTEGER) AS row, CAST(c AS INTEGER) AS col, round(value, 6) AS value, nd AS is_nodata FROM pix", "pix"))
def p5(spark, d):
    return r6(raster.cleaned(S.pixels(spark, d), S.pixel_meta(spark)).drop("raster_id"), "value")


@query(
    "j8_sample_nearest",
    sql("SELECT id, b.band, round(value, 6) AS value, coalesce(nd, true) AS is_nodata FROM pts CROSS JOIN (SELECT unnest(['price', 'size']) AS band) b LEFT JOIN pix ON pix.band = b.band AND r = floor((1200 - y) / 30) AND c = floor(x / 30)", "pix", "pts"),
)
def j8(spark, d):
    return r6(raster.sample_nearest(S.points(spark, d), S.pixels(spark, d), S.pixel_meta(spark)).select("id", "band", "value", "is_nodata"), "value")


@query(
    "g9_sample_bilinear",
    sql(
        """f AS (SELECT id, band, (1200 - y) / 30 - 0.5 AS fy, x / 30 - 0.5 AS fx FROM pts CROSS JOIN (SELECT unnest(['price', 'size']) AS band)),
k AS (SELECT id, band, floor(fy) + i AS r, floor(fx) + j AS c, (CASE WHEN i = 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END) * (CASE WHEN j = 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) AS w
FROM f CROSS JOIN (SELECT unnest([0, 1]) AS i) CROSS JOIN (SELECT unnest([0, 1]) AS j))
SELECT id, k.band, CASE WHEN count(value) = 4 THEN round(sum(w * value), 5) END AS value, count(value) <> 4 AS is_nodata FROM k LEFT JOIN pix ON pix.band = k.band AND pix.r = k.r AND pix.c = k.c GROUP BY id, k.band""",
        "pix",
        "pts",
    ),
)
def g9(spark, d):
    out = raster.sample_bilinear(S.points(spark, d), S.pixels(spark, d), S.pixel_meta(spark))
    return out.select("id", "band", F.round("value", 5).alias("value"), "is_nodata")


def _scene_pixels(spark, d):
    """Lines as pixels of scenes. Some lines share their order and number; of those the first in the file comes first, as in SQL."""
    k, scene = F.col("l_partkey"), F.struct("l_orderkey", "l_linenumber", "_metadata.file_path", "_metadata.row_index")
    return table(spark, d, "lineitem").select(F.lit("b").alias("band"), F.expr("l_partkey DIV 50").alias("row"), (k % 50).alias("col"), F.col("l_quantity").alias("value"), scene.alias("scene"))


@query("a10_composite", "SELECT 'b' AS band, l_partkey // 50 AS row, l_partkey % 50 AS col, median(l_quantity) AS value, count(l_quantity) AS n_scenes FROM lineitem GROUP BY l_partkey")
def a10(spark, d):
    return raster.composite(_scene_pixels(spark, d))


@query("g10_mosaic", "SELECT 'b' AS band, l_partkey // 50 AS row, l_partkey % 50 AS col, arg_min(l_quantity, l_orderkey * 100 + l_linenumber) AS value FROM lineitem GROUP BY l_partkey")
def g10(spark, d):
    return raster.mosaic(_scene_pixels(spark, d), "scene")


def _dsm(spark, d):
    p = table(spark, d, "part")
    at = [F.expr("p_partkey DIV 50").alias("row"), (F.col("p_partkey") % 50).alias("col")]
    dem = p.select(*at, F.col("p_size").cast("double").alias("value"))
    return raster.surface(dem, p.where("p_partkey % 3 = 0").select(*at, (F.col("p_retailprice") - 900).alias("height")))


_DSM = "dsm AS (SELECT p_partkey // 50 AS r, p_partkey % 50 AS c, p_size + CASE WHEN p_partkey % 3 = 0 THEN p_retailprice - 900 ELSE 0 END AS z FROM part)"


@query("p20_surface", f"WITH {_DSM} SELECT r AS row, c AS col, round(z, 6) AS value FROM dsm")
def p20(spark, d):
    return r6(_dsm(spark, d), "value")


@query(
    "g12_sky_view",
    f"""WITH {_DSM}, n AS (SELECT a.r, a.c, k, max(greatest(atan((b.z - a.z) / (30.0 * s)), 0)) AS h FROM dsm a CROSS JOIN (SELECT unnest([1, 2, 3]) AS s) CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS k)
LEFT JOIN dsm b ON b.r = a.r + CASE k WHEN 0 THEN -s WHEN 2 THEN s ELSE 0 END AND b.c = a.c + CASE k WHEN 1 THEN s WHEN 3 THEN -s ELSE 0 END GROUP BY 1, 2, 3)
SELECT r AS row, c AS col, round(sum(pow(sin(coalesce(h, 0)), 2)) / 4, 6) AS horizon_sin2_mean, round(1 - sum(pow(sin(coalesce(h, 0)), 2)) / 4, 6) AS svf FROM n GROUP BY 1, 2""",
)
def g12(spark, d):
    return r6(raster.horizon_svf(_dsm(spark, d), res=30.0, radius=90.0, directions=4, block=16), "horizon_sin2_mean", "svf")


@query("g12_sky_view_fine")
def g12_fine(spark, d):
    """The reference's 16 directions and 100 m at 3 m pixels."""
    return r6(raster.horizon_svf(_dsm(spark, d), res=3.0, radius=100.0, directions=16), "horizon_sin2_mean", "svf")


@query("g14_topographic_position", f"WITH {_DSM} SELECT a.r AS row, a.c AS col, round(a.z - avg(b.z), 6) AS tpi, round(stddev_pop(b.z), 6) AS focal_std FROM dsm a JOIN dsm b ON pow(a.r - b.r, 2) + pow(a.c - b.c, 2) <= 4 GROUP BY a.r, a.c, a.z")
def g14(spark, d):
    return r6(raster.topographic_position(_dsm(spark, d), 2), "tpi", "focal_std")


# ---- tiles

_CLIP = """cl AS (SELECT *, greatest(least(1.0, greatest((x0 - x1) / nullif(x2 - x1, 0), (x0 + 30 - x1) / nullif(x2 - x1, 0)), greatest((y0 - y1) / nullif(y2 - y1, 0), (y0 + 30 - y1) / nullif(y2 - y1, 0)))
  - greatest(0.0, least((x0 - x1) / nullif(x2 - x1, 0), (x0 + 30 - x1) / nullif(x2 - x1, 0)), least((y0 - y1) / nullif(y2 - y1, 0), (y0 + 30 - y1) / nullif(y2 - y1, 0))), 0) * sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) AS length
  FROM (SELECT seg.*, i, j, i * 30.0 AS y0, j * 30.0 AS x0 FROM seg JOIN range(-1, 11) ti(i) ON i * 30.0 <= greatest(y1, y2) AND i * 30.0 + 30 >= least(y1, y2) JOIN range(-1, 11) tj(j) ON j * 30.0 <= greatest(x1, x2) AND j * 30.0 + 30 >= least(x1, x2))
  WHERE NOT (x1 = x2 AND (x1 < x0 OR x1 > x0 + 30)) AND NOT (y1 = y2 AND (y1 < y0 OR y1 > y0 + 30)))"""


@query("g4_clip_lines", sql(_CLIP + " SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(sum(length), 4) AS length FROM cl WHERE length > 1e-9 GROUP BY ALL", "seg"))
def g4(spark, d):
    c = landuse.clip_lines(S.road_segments(spark, d)).where("length > 1e-9")
    return c.groupBy("i", "j").agg(F.round(F.sum("length"), 4).alias("length"))


def _roads(spark, d):
    """Clipped roads with weight and dustiness by the kind of event."""
    kinds = {"purchase": ("gravel", None), "click": ("asphalt", "residential"), "view": (None, "track"), "signup": (None, "tracks_other")}
    pick = lambda k: F.try_element_at(F.create_map(*[F.lit(x) for e, v in kinds.items() for x in (e, v[k] or "")]), F.col("event_type"))
    c = landuse.clip_lines(S.road_segments(spark, d)).where("length > 1e-9")
    return c.withColumn("weight", C.road_weight(pick(0), pick(1))).withColumn("dusty", C.is_dusty(pick(0)))


_WEIGHT = "CASE event_type WHEN 'purchase' THEN 0.9 WHEN 'click' THEN 0.05 WHEN 'view' THEN 0.7 WHEN 'signup' THEN 0.6 ELSE 0.1 END"


@query(
    "a3_road_lengths",
    sql(_CLIP + f" SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, round(sum(length), 4) AS total, round(sum(CASE WHEN event_type = 'purchase' THEN length ELSE 0 END), 4) AS unpaved, round(sum(length * {_WEIGHT}), 4) AS weighted FROM cl WHERE length > 1e-9 GROUP BY ALL", "seg"),
)
def a3(spark, d):
    r = _roads(spark, d).groupBy("i", "j").agg(F.sum("length").alias("total"), F.sum(F.when(F.col("dusty"), F.col("length")).otherwise(0.0)).alias("unpaved"), F.sum(F.col("length") * F.col("weight")).alias("weighted"))
    return r.select("i", "j", *[F.round(c, 4).alias(c) for c in ("total", "unpaved", "weighted")])


_TRI = """tri AS (SELECT p_partkey AS k, p_size, 300.0::DOUBLE * ((p_partkey * 7919) % 997) / 997.0 AS x1, 300.0::DOUBLE * ((p_partkey * 7907) % 997) / 997.0 AS x2, 300.0::DOUBLE * ((p_partkey * 7901) % 997) / 997.0 AS x3,
300.0::DOUBLE * ((p_partkey * 104729) % 991) / 991.0 AS y1, 300.0::DOUBLE * ((p_partkey * 104723) % 991) / 991.0 AS y2, 300.0::DOUBLE * ((p_partkey * 104717) % 991) / 991.0 AS y3 FROM part)"""


#: Area of each triangle in each tile: over the stretch that an edge and a tile share, the integral of the edge's height
#: above the tile's foot, between 0 and 30, counted with the edge's direction.
_AREA = (
    _TRI
    + """, ed AS (SELECT k, p_size, x1, y1, x2, y2 FROM tri UNION ALL SELECT k, p_size, x2, y2, x3, y3 FROM tri UNION ALL SELECT k, p_size, x3, y3, x1, y1 FROM tri),
st AS (SELECT k, p_size, i, j, sign(x2 - x1) AS s, greatest(least(x1, x2), j * 30.0) AS l, least(greatest(x1, x2), j * 30.0 + 30) AS r, x1, y1, (y2 - y1) / (x2 - x1) AS m FROM ed CROSS JOIN range(10) ti(i) CROSS JOIN range(10) tj(j) WHERE x1 <> x2),
hs AS (SELECT *, y1 + m * (l - x1) - i * 30.0 AS a, y1 + m * (r - x1) - i * 30.0 AS b FROM st WHERE r > l),
ps AS (SELECT *, (r - l) * (CASE WHEN a >= 0 AND b >= 0 THEN (a + b) / 2 WHEN a <= 0 AND b <= 0 THEN 0 ELSE pow(greatest(a, b), 2) / (2 * abs(a - b)) END
  - CASE WHEN a >= 30 AND b >= 30 THEN (a + b - 60) / 2 WHEN a <= 30 AND b <= 30 THEN 0 ELSE pow(greatest(a, b) - 30, 2) / (2 * abs(a - b)) END) AS part FROM hs),
ar AS (SELECT k, p_size, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, abs(sum(s * part)) AS area FROM ps GROUP BY ALL HAVING abs(sum(s * part)) > 1e-9)"""
)


@query("g5_tile_areas", f"WITH {_AREA} SELECT k AS feature_id, i, j, round(area, 4) AS area FROM ar WHERE area > 1e-3")
def g5_tiles(spark, d):
    """Every polygon's area in every tile."""
    a = landuse.clip_areas(S.triangles(spark, d)).where("area > 1e-3")
    return a.select("feature_id", "i", "j", F.round("area", 4).alias("area"))


@query("g5_polygon_area", f"WITH {_TRI} SELECT k AS feature_id, round(abs((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2, 4) AS area FROM tri WHERE abs((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2 > 1e-3")
def g5(spark, d):
    """The clipped areas of a polygon's tiles add up to its own."""
    a = landuse.clip_areas(S.triangles(spark, d)).groupBy("feature_id").agg(F.round(F.sum("area"), 4).alias("area"))
    return a.where("area > 1e-3")


_PT = "pt AS (SELECT c_custkey AS id, c_mktsegment AS seg, 300.0::DOUBLE * ((c_custkey * 7919) % 997) / 997.0 AS x, 300.0::DOUBLE * ((c_custkey * 104729) % 991) / 991.0 AS y FROM customer)"


def _tile_points(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), F.col("c_mktsegment").alias("seg"), (300.0 * ((k * 7919) % 997) / 997.0).alias("x"), (300.0 * ((k * 104729) % 991) / 991.0).alias("y"))


@query("g6_points_in_tiles", f"WITH {_PT} SELECT id, CAST(floor(y / 30) AS INTEGER) AS i, CAST(floor(x / 30) AS INTEGER) AS j FROM pt WHERE x > floor(x / 30) * 30 AND y > floor(y / 30) * 30")
def g6(spark, d):
    return landuse.points_in_tiles(_tile_points(spark, d)).select("id", "i", "j")


def _dust(spark, d):
    areas = landuse.clip_areas(S.triangles(spark, d).where("p_size < 5").drop("p_size"))
    return landuse.dust(landuse.tiles(spark, 10, 10), _roads(spark, d), areas, landuse.points_in_tiles(_tile_points(spark, d).where("seg = 'BUILDING'")))


_DUST = (
    "ds AS (SELECT t.i, t.j, coalesce(rd.total, 0) AS total_road_m, coalesce(rd.unpaved, 0) AS unpaved_road_m, coalesce(rd.weighted, 0) AS road_weighted, coalesce(co.area, 0) AS construction_area_m2, coalesce(pn.n, 0) AS construction_count "
    "FROM (SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j FROM range(10) a(i) CROSS JOIN range(10) b(j)) t "
    f"LEFT JOIN (SELECT i, j, sum(length) AS total, sum(CASE WHEN event_type = 'purchase' THEN length ELSE 0 END) AS unpaved, sum(length * {_WEIGHT}) AS weighted FROM cl WHERE length > 1e-9 GROUP BY ALL) rd USING (i, j) "
    "LEFT JOIN (SELECT i, j, sum(area) AS area FROM ar WHERE p_size < 5 GROUP BY ALL) co USING (i, j) "
    "LEFT JOIN (SELECT CAST(floor(y / 30) AS INTEGER) AS i, CAST(floor(x / 30) AS INTEGER) AS j, count(*) AS n FROM pt WHERE seg = 'BUILDING' AND x > floor(x / 30) * 30 AND y > floor(y / 30) * 30 GROUP BY ALL) pn USING (i, j)), "
    "dx AS (SELECT *, 'r' || i || '_c' || j AS tile_id, 900.0::DOUBLE AS tile_area, CASE WHEN total_road_m > 0 THEN 100 * unpaved_road_m / total_road_m ELSE 0 END AS pct_unpaved, least(100, 100 * road_weighted / (900 * sqrt(2))) AS road_dust_index, "
    "least(100, construction_area_m2 / 9) AS construction_dust_index FROM ds), dt AS (SELECT *, 0.6 * road_dust_index + 0.4 * construction_dust_index AS dust_index_combined FROM dx)"
)
_DUST_NAMES = ("total_road_m", "unpaved_road_m", "road_weighted", "construction_area_m2", "pct_unpaved", "road_dust_index", "construction_dust_index", "dust_index_combined")


@query("p16_dust_tiles", sql(f"{_CLIP}, {_AREA}, {_PT}, {_DUST} SELECT tile_id, construction_count, " + ", ".join(f"round({c}, 3) AS {c}" for c in _DUST_NAMES) + " FROM dt", "seg"))
def p16(spark, d):
    return _dust(spark, d).select("tile_id", "construction_count", *[F.round(c, 3).alias(c) for c in _DUST_NAMES])


def _tags(**pairs):
    """A map of tags; what is null is no tag."""
    return F.map_from_entries(F.array_compact(F.array(*[F.when(v.isNotNull(), F.struct(F.lit(k).alias("k"), v.alias("v"))) for k, v in pairs.items()])))


def _choose(c, **by):
    """Text by the values of a column, else null."""
    out = F.lit(None).cast("string")
    for k, v in by.items():
        out = F.when(F.col(c) == k, v).otherwise(out)
    return out


def _part_tags(spark, d):
    """Tags of each part's polygon: its use or building by the type, its height or levels by the size."""
    size = F.col("p_size")
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("feature_id"),
        _tags(
            landuse=_choose("p_type", MEDIUM="Industrial", LARGE="landfill", PROMO="quarry"),
            building=_choose("p_type", SMALL="factory", ECONOMY="works", STANDARD="house"),
            height=F.when(size % 2 == 0, F.concat(size.cast("string"), F.lit(" ;3"))),
            levels=F.when(size % 3 == 0, size.cast("string")),
        ).alias("tags"),
    )


_CLASSES = """cs AS (SELECT p_partkey AS k, p_type = 'MEDIUM' AS is_industrial, p_type = 'LARGE' AS is_landfill, p_type = 'PROMO' AS is_quarry, p_type IN ('SMALL', 'ECONOMY') AS is_industrial_building,
  CAST(CASE WHEN p_size % 2 = 0 THEN p_size WHEN p_size % 3 = 0 THEN 3 * p_size ELSE 6 END AS DOUBLE) AS height FROM part)"""


def _classed_parts(spark, d):
    t = _part_tags(spark, d)
    get = lambda k: F.try_element_at("tags", F.lit(k))
    kinds = C.industrial_classes(F.col("tags"))
    return t.select("feature_id", *[kinds[k].alias(k) for k in ("is_industrial", "is_landfill", "is_quarry", "is_industrial_building")], C.building_height(get("height"), get("levels")).alias("height"))


@query("p15_classes", f"WITH {_CLASSES} SELECT k AS feature_id, is_industrial, is_landfill, is_quarry, is_industrial_building FROM cs")
def p15(spark, d):
    return _classed_parts(spark, d).drop("height")


@query("p14_heights", f"WITH {_CLASSES} SELECT k AS feature_id, height FROM cs")
def p14(spark, d):
    return _classed_parts(spark, d).select("feature_id", "height")


def _industrial(spark, d):
    a = landuse.clip_areas(S.triangles(spark, d).drop("p_size")).join(_classed_parts(spark, d), "feature_id")
    tags = _tags(power=_choose("seg", MACHINERY="plant"), man_made=_choose("seg", BUILDING="chimney"), industrial=_choose("seg", AUTOMOBILE="yes"), site=_choose("seg", HOUSEHOLD="industrial"))
    kinds = C.industrial_classes(tags)
    p = landuse.points_in_tiles(_tile_points(spark, d)).withColumns({k: kinds[k] for k in ("is_plant", "is_chimney", "is_poi")})
    line = C.industrial_classes(_tags(power=_choose("event_type", signup="plant")))
    lines = landuse.clip_lines(S.road_segments(spark, d)).where("length > 1e-9").withColumn("is_plant", line["is_plant"])
    return landuse.industrial(landuse.tiles(spark, 10, 10), a, p, lines)


_IND = (
    "ia AS (SELECT i, j, sum(CASE WHEN is_industrial THEN area ELSE 0 END) AS land, sum(CASE WHEN is_industrial_building THEN area ELSE 0 END) AS building, sum(CASE WHEN is_industrial_building THEN area * height ELSE 0 END) AS volume, "
    "sum(CASE WHEN is_landfill THEN area ELSE 0 END) AS landfill, sum(CASE WHEN is_quarry THEN area ELSE 0 END) AS quarry, count(*) FILTER (is_industrial_building) AS n_building, count(*) FILTER (is_industrial) AS n_land FROM ar JOIN cs USING (k) GROUP BY ALL), "
    "ip AS (SELECT CAST(floor(y / 30) AS INTEGER) AS i, CAST(floor(x / 30) AS INTEGER) AS j, count(*) FILTER (seg = 'MACHINERY') AS plants, count(*) FILTER (seg = 'BUILDING') AS chimneys, count(*) FILTER (seg IN ('AUTOMOBILE', 'HOUSEHOLD')) AS pois "
    "FROM pt WHERE x > floor(x / 30) * 30 AND y > floor(y / 30) * 30 GROUP BY ALL), "
    "il AS (SELECT i, j, count(DISTINCT feature_id) AS n FROM cl WHERE length > 1e-9 AND event_type = 'signup' GROUP BY ALL), "
    "iu AS (SELECT 'r' || t.i || '_c' || t.j AS tile_id, 900.0::DOUBLE AS tile_area, coalesce(land, 0) AS industrial_area_m2, coalesce(building, 0) AS industrial_building_area_m2, coalesce(volume, 0) AS industrial_building_volume_m3, coalesce(landfill, 0) AS landfill_area_m2, "
    "coalesce(quarry, 0) AS quarry_area_m2, coalesce(n_building, 0) AS industrial_building_count, coalesce(plants, 0) + coalesce(il.n, 0) AS power_plant_count, coalesce(chimneys, 0) AS chimney_count, coalesce(pois, 0) AS industrial_poi_count, "
    "coalesce(n_land, 0) + coalesce(n_building, 0) + coalesce(plants, 0) + coalesce(il.n, 0) + coalesce(chimneys, 0) + coalesce(pois, 0) AS industrial_contrib_count "
    "FROM (SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j FROM range(10) a(i) CROSS JOIN range(10) b(j)) t LEFT JOIN ia USING (i, j) LEFT JOIN ip USING (i, j) LEFT JOIN il USING (i, j)), "
    "iv AS (SELECT *, industrial_building_volume_m3 / 1000 + 0.8 * industrial_area_m2 / 1000 + 50 * power_plant_count + 20 * chimney_count + 0.2 * landfill_area_m2 / 1000 + 0.2 * quarry_area_m2 / 1000 + 5 * industrial_poi_count AS industrial_index_raw FROM iu), "
    "iw AS (SELECT quantile_cont(industrial_index_raw, 0.99) AS p, max(industrial_index_raw) AS m FROM iv), "
    "ind AS (SELECT iv.*, greatest(0.0, least(100.0, 100 * industrial_index_raw / CASE WHEN p > 0 THEN p WHEN m > 0 THEN m ELSE 1 END)) AS industrial_index_combined, "
    "CASE WHEN power_plant_count > 0 OR chimney_count > 0 OR industrial_building_area_m2 > 0 THEN 'high' WHEN industrial_area_m2 > 0 OR industrial_poi_count > 0 THEN 'medium' ELSE 'low' END AS industrial_confidence FROM iv, iw)"
)
_IND_NAMES = (*landuse.INDUSTRIAL, "industrial_index_raw", "industrial_index_combined")


@query("p17_industrial_tiles", sql(f"{_CLIP}, {_AREA}, {_PT}, {_CLASSES}, {_IND} SELECT tile_id, {', '.join(landuse.COUNTS)}, " + ", ".join(f"round({c}, 2) AS {c}" for c in _IND_NAMES) + ", industrial_confidence FROM ind", "seg"))
def p17(spark, d):
    return _industrial(spark, d).select("tile_id", *landuse.COUNTS, *[F.round(c, 2).alias(c) for c in _IND_NAMES], "industrial_confidence")


@query("a9_capped_index", "WITH c AS (SELECT quantile_cont(s_acctbal, 0.99) AS p, max(s_acctbal) AS m FROM supplier) SELECT s_suppkey, round(greatest(0.0, least(100.0, 100 * s_acctbal / CASE WHEN p > 0 THEN p WHEN m > 0 THEN m ELSE 1 END)), 6) AS idx FROM supplier, c")
def a9(spark, d):
    return r6(landuse.capped_index(table(spark, d, "supplier"), "s_acctbal", "idx").select("s_suppkey", "idx"), "idx")


@query("w1_dense_ids", "SELECT row_number() OVER (ORDER BY p_partkey // 50, p_partkey % 50) - 1 AS grid_id, p_partkey // 50 AS iy, p_partkey % 50 AS ix FROM part WHERE p_size > 10")
def w1(spark, d):
    g = table(spark, d, "part").where("p_size > 10").select((F.col("p_partkey") % 50).alias("ix"), F.expr("p_partkey DIV 50").alias("iy"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    return landuse.dense_ids(g).select("grid_id", "ix", "iy")


@query("j13_inside", f"WITH {_PT} SELECT id FROM pt WHERE (CASE WHEN (0 > y) <> (290 > y) AND 10 + (y - 0) * 140.0 / 290 > x THEN 1 ELSE 0 END + CASE WHEN (290 > y) <> (0 > y) AND 150 + (y - 290) * 140.0 / -290 > x THEN 1 ELSE 0 END) % 2 = 1")
def j13(spark, d):
    edges = spark.createDataFrame([(10.0, 0.0, 150.0, 290.0), (150.0, 290.0, 290.0, 0.0), (290.0, 0.0, 10.0, 0.0)], "x1 double, y1 double, x2 double, y2 double")
    return landuse.inside(_tile_points(spark, d).select("id", "x", "y"), edges).select("id")


@query("p7_haversine", sql(f"SELECT a, b, round(km, 6) AS km FROM (SELECT a, b, {_KM} FROM (SELECT x.sensor_id AS a, y.sensor_id AS b, x.latitude, x.longitude, y.latitude AS olat, y.longitude AS olon FROM sens x JOIN sens y ON y.sensor_id = x.sensor_id + 1))) t(a, b, km)", "sens"))
def p7(spark, d):
    s = S.sensors(spark, d)
    o = s.select(F.col("sensor_id").alias("b"), (F.col("sensor_id") - 1).alias("sensor_id"), F.col("latitude").alias("olat"), F.col("longitude").alias("olon"))
    return s.join(o, "sensor_id").select(F.col("sensor_id").alias("a"), "b", F.round(C.haversine_km(F.col("latitude"), F.col("longitude"), F.col("olat"), F.col("olon")), 6).alias("km"))


# ---- regression

_GT = """tr AS (SELECT s_suppkey AS id, ((s_suppkey * 31) % 101) / 101.0 AS f, s_acctbal / 1000 AS y, 100.0::DOUBLE * ((s_suppkey * 7919) % 997) / 997.0 AS cx, 100.0::DOUBLE * ((s_suppkey * 104729) % 991) / 991.0 AS cy, s_suppkey % 10 AS t FROM supplier),
qu AS (SELECT c_custkey AS id, ((c_custkey * 37) % 101) / 101.0 AS f, 100.0::DOUBLE * ((c_custkey * 7919) % 997) / 997.0 AS cx, 100.0::DOUBLE * ((c_custkey * 104729) % 991) / 991.0 AS cy, c_custkey % 10 AS t FROM customer),
w AS (SELECT qu.id, qu.f AS qf, tr.f, tr.y, greatest(exp(-(pow(qu.cx - tr.cx, 2) + pow(qu.cy - tr.cy, 2)) / 900.0) * exp(-pow(qu.t - tr.t, 2) / 25.0), 1e-12) AS w FROM qu CROSS JOIN tr),
s AS (SELECT id, any_value(qf) AS qf, sum(w) AS a, sum(w * f) AS b, sum(w * f * f) AS c, sum(w * y) AS u, sum(w * f * y) AS v, sum(w * y * y) AS yy FROM w GROUP BY id),
k AS (SELECT *, (c * u - b * v) / (a * c - b * b) AS b0, (a * v - b * u) / (a * c - b * b) AS b1 FROM s)"""


@query("m3_gtwr", f"WITH {_GT} SELECT id, round(b0 + b1 * qf, 5) AS prediction, round(sqrt(greatest((yy - 2 * (b0 * u + b1 * v) + b0 * b0 * a + 2 * b0 * b1 * b + b1 * b1 * c) / (a + 1e-12), 0)), 5) AS uncertainty FROM k")
def m3(spark, d):
    out = gtwr.predict(S.train(spark, d), S.asked(spark, d), 2, hs=30.0, ht=5.0)
    return out.select("id", F.round("prediction", 5).alias("prediction"), F.round("uncertainty", 5).alias("uncertainty"))


_LOO = """tr AS (SELECT s_suppkey AS id, ((s_suppkey * 31) % 101) / 101.0 AS f, s_acctbal / 1000 AS y, 100.0::DOUBLE * ((s_suppkey * 7919) % 997) / 997.0 AS cx, 100.0::DOUBLE * ((s_suppkey * 104729) % 991) / 991.0 AS cy, s_suppkey % 10 AS t FROM supplier),
gr AS (SELECT unnest([20.0, 40.0, 80.0]) AS hs, unnest([5.0, 5.0, NULL]) AS ht),
w AS (SELECT hs, ht, a.id, a.f AS qf, a.y AS qy, b.f, b.y, greatest(exp(-(pow(a.cx - b.cx, 2) + pow(a.cy - b.cy, 2)) / (hs * hs)) * coalesce(exp(-pow(a.t - b.t, 2) / (ht * ht)), 1), 1e-12) AS w FROM gr CROSS JOIN tr a JOIN tr b ON a.id <> b.id),
s AS (SELECT hs, ht, id, any_value(qf) AS qf, any_value(qy) AS qy, sum(w) AS a, sum(w * f) AS b, sum(w * f * f) AS c, sum(w * y) AS u, sum(w * f * y) AS v FROM w GROUP BY ALL),
e AS (SELECT hs, ht, qy - ((c * u - b * v) + (a * v - b * u) * qf) / (a * c - b * b) AS e FROM s)"""


@query("m6_bandwidth", f"WITH {_LOO} SELECT CAST(hs AS DOUBLE) AS hs, CAST(ht AS DOUBLE) AS ht, round(sqrt(avg(e * e)), 6) AS rmse FROM e GROUP BY hs, ht")
def m6(spark, d):
    return r6(gtwr.bandwidth_scores(S.train(spark, d), 2, [(20.0, 5.0), (40.0, 5.0), (80.0, None)]), "rmse")


@query("m7_standardise", "SELECT s_suppkey, round((s_acctbal - avg(s_acctbal) OVER ()) / stddev_pop(s_acctbal) OVER (), 6) AS s_acctbal FROM supplier")
def m7(spark, d):
    return r6(gtwr.standardise(table(spark, d, "supplier").select("s_suppkey", "s_acctbal"), ["s_acctbal"]), "s_acctbal")


# ---- roll-ups


@query("r2_city_summary", "SELECT city_id, date, n, round(m + 3e-8, 6) AS mean, round(v + 3e-8, 6) AS variance, round(m - 1.96 * sqrt(v / n) + 3e-8, 6) AS ci_low, round(m + 1.96 * sqrt(v / n) + 3e-8, 6) AS ci_high FROM (SELECT user_id % 5 AS city_id, CAST(ts AS DATE) AS date, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY 1, 2)")
def r2(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 5).alias("city_id"), F.to_date("ts").alias("date"), "value")
    return near6(rollup.city_summary(e), "mean", "variance", "ci_low", "ci_high")


@query("r3_coarser", "SELECT (p_partkey % 50) // 3 AS cx, (p_partkey // 50) // 3 AS cy, round(avg(p_retailprice), 6) AS value, count(*) AS n FROM part GROUP BY 1, 2")
def r3(spark, d):
    g = table(spark, d, "part").select((F.col("p_partkey") % 50).alias("ix"), F.expr("p_partkey DIV 50").alias("iy"), F.col("p_retailprice").alias("value"))
    return r6(rollup.coarser(g), "value")


def _edges(spark, d):
    values = landuse.tiles(spark, 10, 10).select("i", "j", (F.col("i") * 10.0 + F.col("j")).alias("value"))
    return rollup.edge_means(landuse.clip_lines(S.road_segments(spark, d)).where("length > 1e-9"), values)


@query("r4_edge_means", sql(_CLIP + " SELECT feature_id, round(sum(length * (i * 10.0 + j)) / sum(length), 7) AS value, round(sum(length), 7) AS length FROM cl WHERE length > 1e-9 AND i BETWEEN 0 AND 9 AND j BETWEEN 0 AND 9 GROUP BY 1", "seg"))
def r4(spark, d):
    return _edges(spark, d).select("feature_id", F.round("value", 7).alias("value"), F.round("length", 7).alias("length"))


@query(
    "r5_route_exposure",
    sql(
        _CLIP
        + """, eg AS (SELECT feature_id, sum(length * (i * 10.0 + j)) AS lv FROM cl WHERE length > 1e-9 AND i BETWEEN 0 AND 9 AND j BETWEEN 0 AND 9 GROUP BY 1),
ex AS (SELECT user_id % 7 AS trip_id, user_id AS route_id, sum(lv) AS exposure FROM events JOIN eg ON feature_id = event_id GROUP BY ALL)
SELECT trip_id, route_id, round(exposure, 3) AS exposure, rank() OVER (PARTITION BY trip_id ORDER BY round(exposure, 6)) AS rank FROM ex""",
        "seg",
    ),
)
def r5(spark, d):
    routes = table(spark, d, "events").select((F.col("user_id") % 7).alias("trip_id"), F.col("user_id").alias("route_id"), F.col("event_id").alias("feature_id"))
    return rollup.route_exposure(routes, _edges(spark, d)).select("trip_id", "route_id", F.round("exposure", 3).alias("exposure"), "rank")


@query("r6_latest_version", "SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice, max(o_orderkey) AS version FROM orders GROUP BY 1")
def r6_latest(spark, d):
    return rollup.latest_version(table(spark, d, "orders").select("o_custkey", "o_totalprice", F.col("o_orderkey").alias("version")), ["o_custkey"])


# ---- quality



def _report(source, *checks):
    """SQL of a report: (name, scope, severity, condition that breaks a row) or (…, aggregate, low, high)."""
    out = []
    for name, scope, severity, what, *bounds in checks:
        if not bounds:
            out.append(f"""SELECT '{name}' AS "check", '{scope}' AS scope, '{severity}' AS severity, count(*) FILTER ({what}) = 0 AS passed, CAST(count(*) FILTER ({what}) AS DOUBLE) AS observed, 0.0::DOUBLE AS expected FROM {source}""")
            continue
        low, high = bounds
        ok = " AND ".join(([f"{what} >= {low}"] if low is not None else []) + ([f"{what} <= {high}"] if high is not None else []))
        out.append(f"""SELECT '{name}' AS "check", '{scope}' AS scope, '{severity}' AS severity, coalesce({ok}, false) AS passed, CAST({what} AS DOUBLE) AS observed, {float(low if low is not None else high)}::DOUBLE AS expected FROM {source}""")
    return " UNION ALL ".join(out)


def _columns(n, name="columns", severity="error"):
    """The row of a check of columns: what is missing is known from the schema, not from any table."""
    return f""" UNION ALL SELECT '{name}', 'table', '{severity}', {"true" if n == 0 else "false"}, {float(n)}::DOUBLE, 0.0::DOUBLE"""


_MISSING = """ UNION ALL SELECT 'missing_dates', 'table', '{severity}', count(*) = 0, CAST(count(*) AS DOUBLE), 0.0::DOUBLE FROM (SELECT DISTINCT date FROM {expected} WHERE date NOT IN (SELECT date FROM {have}))"""
_ROUNDED = "SELECT \"check\", scope, severity, passed, round(observed, 6) AS observed, expected FROM ({})"
_Q1 = _report(
    "rl",
    ("pm25_range", "row", "error", "pm25 < 0 OR pm25 > 1000"),
    ("pm25_extreme", "row", "warning", "pm25 > 500"),
    ("pm25_below_1", "row", "warning", "pm25 < 1"),
    ("pm25_above_300", "row", "warning", "pm25 > 300"),
    ("fallback_type", "row", "error", "fallback_type NOT IN ('exact', 'window', 'seasonal', 'spatial_idw', 'none')"),
    ("latitude", "row", "error", "latitude < -90 OR latitude > 90"),
    ("longitude", "row", "error", "longitude < -180 OR longitude > 180"),
    ("coordinates_missing", "row", "warning", "latitude IS NULL OR longitude IS NULL"),
    ("exact_offset", "row", "warning", "fallback_type = 'exact' AND days_offset <> 0"),
    ("pm25_coverage", "table", "error", "100.0 * count(pm25) / count(*)", 50.0, None),
)


@query("q1_readings", sql(_IDW + ", rl AS (SELECT * FROM filled), od AS (SELECT date FROM days UNION SELECT CAST(max(ts) AS DATE) + 3 FROM events) " + _ROUNDED.format(_Q1 + _columns(3) + _MISSING.format(severity="error", expected="od", have="rl")), "meas", "daily", "sens", "days"))
def q1(spark, d):
    """Readings without a name and a life span, of which one more date is expected."""
    f = readings.idw_fill(_thin(spark, d), max_km=3.0)
    more = table(spark, d, "events").agg(F.date_add(F.to_date(F.max("ts")), 3).alias("date"))
    return r6(quality.readings_report(f, S.days(spark, d).union(more)), "observed")


_MW = _NEAR + f""", mw AS (SELECT n.date, n.datetime AS datetime_utc, n.temperature_2m, n.relative_humidity_2m, n.surface_pressure, n.wind_speed_10m, n.precipitation, n.cloud_cover, w.* EXCLUDE (date),
  lag(n.date) OVER (PARTITION BY month(n.date) ORDER BY n.temperature_2m, n.date) AS before FROM nr n LEFT JOIN ({_DAY}) w ON w.date = n.date WHERE rn = 1)"""
_Q2_NAMES = ("date", "datetime_utc", "temperature_2m", "relative_humidity_2m", "surface_pressure", "wind_speed_10m", "precipitation", "cloud_cover", "temp_mean", "temp_max", "temp_min", "rh_mean", "wind_speed_mean", "wind_speed_max", "precip_total", "cloud_cover_mean", "pressure_mean")
_Q2 = _report(
    "mw",
    ("temperature_2m_range", "row", "error", "temperature_2m < 0 OR temperature_2m > 50"),
    ("relative_humidity_2m_range", "row", "error", "relative_humidity_2m < 0 OR relative_humidity_2m > 100"),
    ("wind_speed_10m_range", "row", "error", "wind_speed_10m < 0"),
    ("precipitation_range", "row", "error", "precipitation < 0"),
    ("cloud_cover_range", "row", "error", "cloud_cover < 0 OR cloud_cover > 100"),
    ("temperature_2m_unusual", "row", "warning", "(temperature_2m < 10 OR temperature_2m > 45) AND temperature_2m BETWEEN 0 AND 50"),
    ("wind_speed_10m_unusual", "row", "warning", "wind_speed_10m > 30"),
    ("surface_pressure_unusual", "row", "warning", "surface_pressure < 950 OR surface_pressure > 1050"),
    *[(f"{c}_missing", "row", "warning", f"{c} IS NULL") for c in _Q2_NAMES],
    ("repeated_dates", "table", "error", "count(date) - count(DISTINCT date)", None, 0),
    ("date_order", "table", "warning", "count(*) FILTER (date < before)", None, 0),
)


@query("q2_weather", sql(_MW + " " + _Q2 + _columns(2) + _columns(0, "optional_columns", "warning") + _MISSING.format(severity="warning", expected="days", have="mw"), "days", "hourly"))
def q2(spark, d):
    """The dates don't rise, as the rows of each month are in the order of their temperature."""
    w = weather.matched_weather(S.hourly(spark, d), S.days(spark, d)).drop("hours_offset")
    w = w.withColumn("order", F.struct("temperature_2m", "date")).withColumn("month", F.month("date"))
    return quality.weather_report(w, S.days(spark, d), "order", ("month",))


_Q7 = _report(
    "dt",
    ("tile_area", "row", "error", "tile_area < 700 OR tile_area > 1100"),
    *[(f"{c}_negative", "row", "error", f"{c} < 0") for c in ("total_road_m", "unpaved_road_m", "road_weighted", "construction_area_m2", "construction_count")],
    *[(f"{c}_range", "row", "error", f"{c} < 0 OR {c} > 100") for c in ("pct_unpaved", "road_dust_index", "construction_dust_index", "dust_index_combined")],
    ("unpaved_within_total", "row", "error", "unpaved_road_m > total_road_m + 1e-6"),
)


@query("q7_dust_tiles", sql(f"{_CLIP}, {_AREA}, {_PT}, {_DUST} {_Q7}{_columns(0)}", "seg"))
def q7(spark, d):
    return quality.run_checks(_dust(spark, d).withColumn("tile_area", F.lit(900.0)), quality.dust_checks(), columns=("tile_id",))


@query("q4_month_parity", "WITH s AS (SELECT o_custkey AS g, CAST(o_orderdate AS DATE) AS d, max(o_totalprice) FILTER (o_orderpriority <> '1-URGENT') AS v FROM orders GROUP BY ALL), f AS (SELECT *, date_trunc('month', d) AS m, min(d) OVER (PARTITION BY date_trunc('month', d)) AS first FROM s) SELECT a.d AS date, count(*) AS n_cells, count(*) FILTER (abs(a.v - b.v) > 1e-6) AS n_values, count(*) FILTER ((a.v IS NULL) <> (b.v IS NULL)) AS n_masks FROM f a JOIN f b ON a.m = b.m AND a.g = b.g AND b.d = b.first WHERE a.d > a.first GROUP BY 1")
def q4(spark, d):
    """A value by customer and date, null where all its orders are urgent."""
    value = F.max(F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")))
    s = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("grid_id"), F.to_date("o_orderdate").alias("date")).agg(value.alias("value"))
    return quality.month_parity(s)


@query("j11_compare_dates", sql("e AS (SELECT DISTINCT date FROM scenes), a AS (SELECT DISTINCT date FROM scenes WHERE cloud < 15 UNION SELECT date FROM days) SELECT 'missing' AS status, date FROM e WHERE date NOT IN (SELECT date FROM a) UNION ALL SELECT 'extra', date FROM a WHERE date NOT IN (SELECT date FROM e) UNION ALL SELECT 'matched', date FROM e WHERE date IN (SELECT date FROM a)", "scenes", "days"))
def j11(spark, d):
    return quality.compare_dates(S.order_dates(spark, d), tables.merge_dates(signals.clear_dates(S.scenes(spark, d)), S.days(spark, d)))


@query("a15_describe", "SELECT count(value) AS n, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(stddev_pop(value), 6) AS std_pop, " + ", ".join(f"round(quantile_cont(value, {q / 100}), 6) AS p{q}" for q in (1, 5, 25, 50, 75, 95, 99)) + " FROM events")
def a15(spark, d):
    return r6(quality.describe(table(spark, d, "events"), "value"), "mean", "std", "std_pop", "p1", "p5", "p25", "p50", "p75", "p95", "p99")


@query("a16_null_counts", sql(_CAND + """ SELECT "column", nulls FROM (SELECT unnest(['pm25', 'actual_date', 'date', 'days_offset', 'fallback_type', 'sample_count', 'sensor_id']) AS "column", unnest([count(*) FILTER (pm25 IS NULL), count(*) FILTER (actual_date IS NULL), count(*) FILTER (date IS NULL), count(*) FILTER (days_offset IS NULL), count(*) FILTER (fallback_type IS NULL), count(*) FILTER (sample_count IS NULL), count(*) FILTER (sensor_id IS NULL)]) AS nulls FROM fb)""", "meas", "daily", "sens", "days"))
def a16(spark, d):
    return quality.null_counts(_readings(spark, d).drop("latitude", "longitude"))


@query("a17_year_coverage", sql("m AS (SELECT DISTINCT 12 * year(date) + month(date) AS m FROM scenes WHERE cloud < 2), t AS (SELECT DISTINCT date FROM scenes) SELECT year(date) AS year, count(*) AS total, count(*) FILTER (12 * year(date) + month(date) IN (SELECT m FROM m)) AS mapped, round(100.0 * count(*) FILTER (12 * year(date) + month(date) IN (SELECT m FROM m)) / count(*), 6) AS percent FROM t GROUP BY 1", "scenes"))
def a17(spark, d):
    t = S.order_dates(spark, d)
    return r6(quality.year_coverage(t, signals.month_source(t, signals.clear_dates(S.scenes(spark, d), 2), look_back=0)), "percent")


@query("a20_uniqueness", "SELECT count(l_partkey) AS n, count(DISTINCT l_partkey) AS n_unique, count(l_partkey) - count(DISTINCT l_partkey) AS n_duplicates FROM lineitem")
def a20(spark, d):
    return quality.uniqueness(table(spark, d, "lineitem"), "l_partkey")


@query("w2_grid_spacing", "SELECT median(v - p) AS spacing FROM (SELECT v, lag(v) OVER (ORDER BY v) AS p FROM (SELECT DISTINCT 30.0::DOUBLE * (p_partkey % 50) AS v FROM part))")
def w2(spark, d):
    return quality.grid_spacing(table(spark, d, "part").select((30.0 * (F.col("p_partkey") % 50)).alias("x")), "x")


# ---- streams


@query("t1_daily_mean_stream", sql(A1 + " WHERE date + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY", "meas", "daily"))
def t1(spark, d):
    """The days that the watermark has closed when all files are read."""
    e = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/event[s].parquet")
    m = e.select(F.col("user_id").alias("sensor_id"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "purchase", 1).otherwise(2).alias("parameter_id"), F.lit("pm25").alias("parameter_name"), "value")
    base = _folder(spark, "stream")
    streams.run_available(streams.daily_mean_stream(m), f"{base}/out", f"{base}/state")
    out = spark.read.schema("sensor_id long, date date, pm25 double, sample_count long").parquet(f"{base}/out")
    return r6(out, "pm25")


@query("t2_refresh_by_date", "SELECT event_id, CAST(ts AS DATE) AS date FROM events")
def t2(spark, d):
    """Events dealt to their dates by micro-batches, read back."""
    base = _folder(spark, "refresh")
    e = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/event[s].parquet")
    streams.refresh_by_date(e.select("event_id", F.to_date("ts").alias("date")), f"{base}/out", f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("event_id", "date")


def _arrivals(spark, d):
    """Events as a stream of four micro-batches."""
    staged = scratch.fresh_dir(spark, "arrivals")
    e = table(spark, d, "events")
    e.repartition(4).write.parquet(staged)
    return spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(staged)


@query("t2_refresh_features", J4)
def t2_features(spark, d):
    """Readings with their substitutes, refreshed date by date as measurements arrive in four batches, each of which brings late
    readings to dates already worked out: the table that one batch gives."""
    m = S.as_measurements(_arrivals(spark, d))
    base = _folder(spark, "refreshed")
    refreshed.refresh_stream(m, scratch.written(_targets(spark, d), "targets"), base, f"{base}/state")
    out = dated.read(spark, f"{base}/features", refreshed.REFRESHED)
    return r6(out, "pm25")


@query("s7_compaction", "SELECT event_id, CAST(ts AS DATE) AS date FROM events")
def s7_compaction(spark, d):
    """Events added to their dates by four micro-batches, brought into one folder a date, the folders of before removed."""
    base = _folder(spark, "compacted")
    rows = _arrivals(spark, d).select("event_id", F.to_date("ts").alias("date"))
    add = lambda batch, n: dated.put(batch, f"{base}/t", token=str(n), replace=False)
    rows.writeStream.foreachBatch(add).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    dated.compact(spark, f"{base}/t", "event_id long, date date")
    dated.clean(spark, f"{base}/t", keep=1)
    return dated.read(spark, f"{base}/t", "event_id long, date date")


# ---- further tables and checks


@query("s10_rejects", sql("SELECT DISTINCT date, 'no clear scene' AS reason FROM scenes WHERE date NOT IN (SELECT date FROM scenes WHERE cloud < 15)", "scenes"))
def s10(spark, d):
    return tables.rejects(S.order_dates(spark, d), signals.clear_dates(S.scenes(spark, d)), "no clear scene")


@query("g7_ring_flags", f"WITH {_TRI} SELECT k AS feature_id, round(((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) / 2, 6) AS area, k % 4 <> 0 AS closed, k % 4 <> 0 AS enough_points, k % 4 <> 0 AS valid FROM tri WHERE abs((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) > 1e-3 AND k % 4 <> 0 UNION ALL SELECT k, round((x1 * y2 - x2 * y1 + x2 * y3 - x3 * y2) / 2, 6), false, false, false FROM tri WHERE abs((x2 - x1) * (y3 - y1) - (x3 - x1) * (y2 - y1)) > 1e-3 AND k % 4 = 0")
def g7(spark, d):
    """Triangles of which every fourth ring is left open."""
    k = F.col("p_partkey")
    corner = [F.struct((300.0 * ((k * a) % 997) / 997.0).alias("x"), (300.0 * ((k * b) % 991) / 991.0).alias("y")) for a, b in ((7919, 104729), (7907, 104723), (7901, 104717))]
    p = table(spark, d, "part").select(k.alias("feature_id"), *[c.alias(f"c{i}") for i, c in enumerate(corner)])
    wide = F.abs((F.col("c1.x") - F.col("c0.x")) * (F.col("c2.y") - F.col("c0.y")) - (F.col("c2.x") - F.col("c0.x")) * (F.col("c1.y") - F.col("c0.y")))
    ring = F.when(F.col("feature_id") % 4 == 0, F.array("c0", "c1", "c2")).otherwise(F.array("c0", "c1", "c2", "c0"))
    out = landuse.ring_flags(p.where(wide > 1e-3).select("feature_id", ring.alias("ring")))
    return r6(out.select("feature_id", "area", "closed", "enough_points", "valid"), "area")


_QUAD = "quad AS (SELECT p_partkey AS k, [" + ", ".join(f"{{'x': 300.0::DOUBLE * ((p_partkey * {a}) % 997) / 997.0, 'y': 300.0::DOUBLE * ((p_partkey * {b}) % 991) / 991.0}}" for a, b in ((7919, 104729), (7907, 104723), (7901, 104717), (7883, 104711))) + "] AS c FROM part)"
_CROSS = f"""WITH {_QUAD},
ed AS (SELECT k, i, c[i + 1].x AS x1, c[i + 1].y AS y1, c[(i + 1) % 4 + 1].x AS x2, c[(i + 1) % 4 + 1].y AS y2 FROM quad CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS i)),
pr AS (SELECT a.k, b.i - a.i AS gap, a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1 AS bx1, b.y1 AS by1, b.x2 AS bx2, b.y2 AS by2,
  sign((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1)) AS s1, sign((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) AS s2,
  sign((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1)) AS s3, sign((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) AS s4
  FROM ed a JOIN ed b ON a.k = b.k AND a.i < b.i)
SELECT quad.k AS feature_id, count(*) FILTER (NOT (ax1 = ax2 AND ay1 = ay2) AND NOT (bx1 = bx2 AND by1 = by2) AND CASE WHEN gap = 2 THEN s1 * s2 <= 0 AND s3 * s4 <= 0 AND least(ax1, ax2) <= greatest(bx1, bx2) AND least(bx1, bx2) <= greatest(ax1, ax2) AND least(ay1, ay2) <= greatest(by1, by2) AND least(by1, by2) <= greatest(ay1, ay2)
  ELSE s1 = 0 AND s2 = 0 AND (ax2 - ax1) * (bx2 - bx1) + (ay2 - ay1) * (by2 - by1) < 0 END) AS n_crossings
FROM quad JOIN pr USING (k) GROUP BY 1"""


@query("g7_crossings", f"SELECT feature_id, n_crossings, n_crossings = 0 AS simple FROM ({_CROSS})")
def g7_crossings(spark, d):
    """Rings of four hashed corners, of which a third are bow-ties."""
    k = F.col("p_partkey")
    corner = [F.struct((300.0 * ((k * a) % 997) / 997.0).alias("x"), (300.0 * ((k * b) % 991) / 991.0).alias("y")) for a, b in ((7919, 104729), (7907, 104723), (7901, 104717), (7883, 104711))]
    rings = table(spark, d, "part").select(k.alias("feature_id"), F.array(*corner, corner[0]).alias("ring"))
    out = landuse.valid_rings(rings)
    return out.select("feature_id", "n_crossings", (F.col("n_crossings") == 0).alias("simple"))


@query("g15_relief", f"WITH {_DSM} SELECT a.r AS row, a.c AS col, round(max(b.z) - min(b.z), 6) AS range FROM dsm a JOIN dsm b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY 1, 2")
def g15(spark, d):
    return r6(raster.relief(_dsm(spark, d), 30.0).select("row", "col", "range"), "range")


@query("q11_surface", f"WITH {_DSM}, w AS (SELECT max(b.z) - min(b.z) AS g FROM dsm a JOIN dsm b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY a.r, a.c) SELECT round(avg(CASE WHEN g >= 3 THEN 1.0 ELSE 0.0 END), 6) AS share, round(quantile_cont(g, 0.95), 6) AS p95_range, avg(CASE WHEN g >= 3 THEN 1.0 ELSE 0.0 END) >= 0.1 AS is_surface FROM w")
def q11(spark, d):
    return r6(raster.looks_like_surface(_dsm(spark, d), 30.0).select("share", "p95_range", "is_surface"), "share", "p95_range")


def _features(spark, d, targets, observed):
    cells = observed.select(F.col("cell").alias("grid_id")).distinct().crossJoin(targets)
    inter = signals.interpolate(targets, observed).withColumnRenamed("cell", "grid_id")
    daily = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.max("l_quantity").alias("temp_max"))
    static = table(spark, d, "customer").groupBy(S.cell("c_custkey").alias("grid_id")).agg(F.round(F.sum("c_acctbal"), 2).alias("dust"))
    return features.assemble(cells, {"s5p_no2": inter}, daily, [static])


@query(
    "r1_feature_table",
    sql(
        _W5
        + """, w AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS temp_max FROM lineitem GROUP BY 1)
SELECT c.cell AS grid_id, tg.date, round(ip.value, 6) AS s5p_no2, coalesce(ip.value IS NULL, true) AS s5p_no2_is_nodata, u.dust, w.temp_max
FROM (SELECT DISTINCT cell FROM obs) c CROSS JOIN tg LEFT JOIN (SELECT c_custkey // 10 AS cell, round(sum(c_acctbal), 2) AS dust FROM customer GROUP BY 1) u ON u.cell = c.cell LEFT JOIN ip ON ip.cell = c.cell AND ip.date = tg.date LEFT JOIN w ON w.date = tg.date""",
        "obs",
    ),
)
def r1(spark, d):
    return r6(_features(spark, d, S.order_dates(spark, d), S.observed(spark, d)), "s5p_no2")


_TRAINING = (
    _W5
    + """, bands AS (SELECT o_custkey // 10 AS cell, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) / 1013700 AS nir, min(o_totalprice) / 2027400 AS red FROM orders GROUP BY ALL),
src AS (SELECT tg.date, (SELECT max(o.date) FROM (SELECT DISTINCT date FROM obs) o WHERE date_trunc('month', o.date) = (SELECT max(date_trunc('month', x.date)) FROM (SELECT DISTINCT date FROM obs) x WHERE date_trunc('month', x.date) <= date_trunc('month', tg.date) AND date_trunc('month', x.date) >= date_trunc('month', tg.date) - INTERVAL 12 MONTH)) AS s FROM tg),
ly AS (SELECT o_custkey // 10 AS cell, year(o_orderdate) AS y, max(o_totalprice) / 1013700 AS svf FROM orders WHERE year(o_orderdate) % 2 = 1 GROUP BY ALL),
wd AS (SELECT CAST(l_shipdate AS DATE) AS date, max(l_quantity) AS temp_max FROM lineitem GROUP BY 1),
st AS (SELECT c_custkey // 10 AS cell, round(sum(c_acctbal), 2) AS dust_index_combined, count(*) FILTER (c_mktsegment = 'MACHINERY') AS industrial_contrib_count FROM customer GROUP BY 1),
sn AS (SELECT s_suppkey, floor(450.0 * ((s_suppkey * 7919) % 997) / 997.0 / 30) AS ix, floor(300.0 * ((s_suppkey * 104729) % 991) / 991.0 / 30) AS iy FROM supplier),
pl AS (SELECT s_suppkey, cell FROM sn JOIN (SELECT DISTINCT c_custkey // 10 AS cell FROM customer) g ON g.cell % 15 = ix AND g.cell // 15 = iy),
rd AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, avg(l_quantity) AS pm25, count(*) AS n FROM lineitem GROUP BY ALL),
pm AS (SELECT cell, date, avg(pm25) AS pm25, CAST(sum(n) AS BIGINT) AS sample_count FROM rd JOIN pl ON pl.s_suppkey = rd.l_suppkey GROUP BY ALL)
SELECT c.cell AS grid_id, tg.date, round(b.nir, 6) AS toa_b5, round(b.red, 6) AS toa_b4, round((b.nir - b.red) / (b.nir + b.red), 6) AS ndvi,
  round(ev.value, 6) AS sentinel2_evi, ev.value IS NULL AS sentinel2_evi_is_nodata, round(ip.value, 6) AS s5p_no2, ip.value IS NULL AS s5p_no2_is_nodata,
  round((SELECT max_by(ly.svf, ly.y) FROM ly WHERE ly.cell = c.cell AND ly.y <= year(tg.date)), 6) AS svf, CAST((SELECT max(ly.y) FROM ly WHERE ly.cell = c.cell AND ly.y <= year(tg.date)) AS INT) AS svf_year,
  st.dust_index_combined, st.industrial_contrib_count, wd.temp_max, round(pm.pm25, 6) AS pm25, pm.sample_count
FROM (SELECT DISTINCT cell FROM obs) c CROSS JOIN tg LEFT JOIN bands b ON b.cell = c.cell AND b.date = tg.date LEFT JOIN src ON src.date = tg.date LEFT JOIN obs ev ON ev.cell = c.cell AND ev.date = src.s
LEFT JOIN ip ON ip.cell = c.cell AND ip.date = tg.date LEFT JOIN st ON st.cell = c.cell LEFT JOIN wd ON wd.date = tg.date LEFT JOIN pm ON pm.cell = c.cell AND pm.date = tg.date"""
)


@query("r1_training_table", sql(_TRAINING, "obs"))
def r1_training(spark, d):
    """Bands and an index, EVI of the month's source, interpolated NO2, the sky view of the latest layer, weather, dust, industry
    and PM2.5 of the cells' sensors. What stands by cell alone lies in buckets. Prices are divided so that none ends in a 5 at
    the seventh place."""
    o, targets, seen = table(spark, d, "orders"), S.order_dates(spark, d), scratch.written(S.observed(spark, d), "observed")
    day, own = F.to_date("o_orderdate").alias("date"), S.cell("o_custkey").alias("grid_id")
    bands = o.groupBy(own, day).agg((F.max("o_totalprice") / 1013700).alias("toa_b5"), (F.min("o_totalprice") / 2027400).alias("toa_b4"))
    bands = bands.withColumn("ndvi", C.ndvi(F.col("toa_b5"), F.col("toa_b4")))
    cells = seen.select(F.col("cell").alias("grid_id")).distinct()
    year = F.year("o_orderdate")
    layers = o.where(year % 2 == 1).groupBy(own, year.alias("year")).agg(F.round(F.max("o_totalprice") / 1013700, 6).alias("svf"))
    c = table(spark, d, "customer")
    land = c.groupBy(S.cell("c_custkey").alias("grid_id")).agg(F.round(F.sum("c_acctbal"), 2).alias("dust_index_combined"), F.count_if(F.col("c_mktsegment") == "MACHINERY").alias("industrial_contrib_count"))
    names, buckets = [f"aqgrid_{kind}_{uuid.uuid4().hex}" for kind in ("land", "sky")], int(spark.conf.get("spark.sql.shuffle.partitions"))
    features.bucketed(land, names[0], buckets)
    features.bucketed(features.by_year(layers, "svf"), names[1], buckets)
    source = signals.month_source(targets, seen.select("date").distinct()).where("source_date IS NOT NULL")
    evi = F.broadcast(source).join(seen.withColumnRenamed("date", "source_date"), "source_date").select(F.col("cell").alias("grid_id"), "date", "value", F.lit(False).alias("is_nodata"))
    no2 = signals.interpolate(targets, seen).withColumnRenamed("cell", "grid_id")
    lines = table(spark, d, "lineitem")
    daily = lines.groupBy(F.to_date("l_shipdate").alias("date")).agg(F.max("l_quantity").alias("temp_max"))
    k = F.col("s_suppkey")
    sensors = table(spark, d, "supplier").select(k.alias("sensor_id"), (450.0 * ((k * 7919) % 997) / 997.0).alias("x"), (300.0 * ((k * 104729) % 991) / 991.0).alias("y"))
    grid = land.select("grid_id", (F.col("grid_id") % 15).alias("ix"), F.expr("grid_id DIV 15").alias("iy"))
    measured = lines.groupBy(F.col("l_suppkey").alias("sensor_id"), F.to_date("l_shipdate").alias("date")).agg(F.avg("l_quantity").alias("pm25"), F.count("*").alias("sample_count"))
    pm = features.cell_readings(measured, features.assign_cells(sensors, grid, x0=0.0, y0=0.0, res=30.0))
    signal = {"sentinel2_evi": r6(evi, "value"), "s5p_no2": r6(no2, "value")}  # rounded before they are spread over all dates
    return features.training_table(cells, targets, bands=r6(bands, "toa_b5", "toa_b4", "ndvi"), layers=["svf"], signals=signal, daily=daily, measured=r6(pm, "pm25"), static=names)


_Q3 = _report(
    "ft",
    ("s5p_no2_range", "row", "error", "s5p_no2 < 0 AND NOT s5p_no2_is_nodata"),
    ("dust_index_range", "row", "error", "dust_index < 0"),
    ("rows", "table", "error", "count(*)", 1, None),
    ("s5p_no2_valid", "table", "error", "count(*) FILTER (NOT s5p_no2_is_nodata)", 1, None),
)


@query(
    "q3_features",
    sql(
        _W5
        + """, ft AS (SELECT c.cell AS grid_id, tg.date, ip.value AS s5p_no2, ip.value IS NULL AS s5p_no2_is_nodata, u.dust AS dust_index FROM (SELECT DISTINCT cell FROM obs) c CROSS JOIN tg
LEFT JOIN (SELECT c_custkey // 10 AS cell, sum(c_acctbal) AS dust FROM customer GROUP BY 1) u ON u.cell = c.cell LEFT JOIN ip ON ip.cell = c.cell AND ip.date = tg.date) """
        + _Q3
        + _columns(0),
        "obs",
    ),
)
def q3(spark, d):
    return quality.feature_report(_features(spark, d, S.order_dates(spark, d), S.observed(spark, d)).withColumnRenamed("dust", "dust_index"))


@query("q5_unmapped_months", sql("SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(DISTINCT date) AS n_dates FROM scenes WHERE date_trunc('month', date) NOT IN (SELECT date_trunc('month', date) FROM scenes WHERE cloud < 1) GROUP BY 1", "scenes"))
def q5(spark, d):
    return quality.unmapped_months(S.order_dates(spark, d), signals.clear_dates(S.scenes(spark, d), 1))


_SKY = f"""{_DSM}, nz AS (SELECT a.r, a.c, k, max(greatest(atan((b.z - a.z) / (30.0 * s)), 0)) AS h FROM dsm a CROSS JOIN (SELECT unnest([1, 2, 3]) AS s) CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS k)
LEFT JOIN dsm b ON b.r = a.r + CASE k WHEN 0 THEN -s WHEN 2 THEN s ELSE 0 END AND b.c = a.c + CASE k WHEN 1 THEN s WHEN 3 THEN -s ELSE 0 END GROUP BY 1, 2, 3),
sky AS (SELECT r, c, 1 - sum(pow(sin(coalesce(h, 0)), 2)) / 4 AS value FROM nz GROUP BY 1, 2),
size AS (SELECT 0.0::DOUBLE AS west, 3000.0 - (max(r) + 1) * 30.0 AS south, (max(c) + 1) * 30.0 AS east, 3000.0::DOUBLE AS north FROM sky)"""


def _sky(spark, d):
    return raster.horizon_svf(_dsm(spark, d), res=30.0, radius=90.0, directions=4, block=64)


@query(
    "q6_sky_view",
    f"WITH {_SKY} "
    + _ROUNDED.format(
        _report(
            "sky",
            ("value_range", "row", "error", "value < 0 OR value > 1"),
            ("spread", "table", "error", "coalesce(max(value) - min(value), 0)", 1e-12, None),
            ("nodata_percent", "table", "warning", "100 - 100.0 * count(value) / count(*)", None, 10),
        )
        + _columns(0)
        + " UNION ALL "
        + _report("(SELECT 30.0 AS res, -30.0 AS y_step)", ("resolution", "raster", "error", "abs(res - 30) > 0.1"), ("north_up", "raster", "error", "y_step > 0"))
        + " UNION ALL "
        + _report("size", ("extent", "raster", "warning", "west < 0 OR south < 0 OR east > 1500 OR north > 3000"))
    ),
)
def q6(spark, d):
    meta = spark.createDataFrame([("a", 0.0, 3000.0, 30.0, -30.0)], "raster_id string, x_origin double, y_origin double, res double, y_step double")
    return r6(quality.raster_report(_sky(spark, d).select("row", "col", F.col("svf").alias("value")), meta, res=30.0, extent=(0.0, 0.0, 1500.0, 3000.0)), "observed")


_CELLS = f"{_PT}, ce AS (SELECT id, value FROM pt LEFT JOIN sky ON r = 9 - floor((300 - y) / 30) AND c = floor(x / 30))"


def _sky_cells(spark, d):
    """The sky view at every customer's place; the lattice's rows go north here."""
    px = _sky(spark, d).select(F.lit("a").alias("raster_id"), F.lit("svf").alias("band"), (F.lit(9) - F.col("row")).cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col("svf").alias("value"))
    meta = spark.createDataFrame([("a", "svf", 0.0, 300.0, 30.0, None, None, None)], "raster_id string, band string, x_origin double, y_origin double, res double, nodata double, scale double, offset double")
    return raster.sample_nearest(_tile_points(spark, d), px, meta).withColumnRenamed("value", "svf")


@query("g13_sky_view_cells", f"WITH {_SKY}, {_CELLS} SELECT round(min(value), 6) AS min, round(avg(value), 6) AS mean, round(max(value), 6) AS max, count(*) FILTER (value IS NULL) AS n_missing, count(*) FILTER (value < 0.5) AS n_canyons, round(100.0 * count(*) FILTER (value < 0.5) / count(*), 6) AS canyon_percent FROM ce")
def g13(spark, d):
    return r6(quality.canyon_share(_sky_cells(spark, d)), "min", "mean", "max", "canyon_percent")


_MORPH = "CASE WHEN v > 0 AND v <= 0.4 THEN 'deep_canyon' WHEN v > 0.4 AND v <= 0.6 THEN 'street_canyon' WHEN v > 0.6 AND v <= 0.8 THEN 'urban_open' WHEN v > 0.8 AND v <= 1 THEN 'suburban' END"


@query("a18_by_morphology", f"SELECT morphology, n, min, max, round(mean + 3e-8, 6) AS mean, round(std, 6) AS std, round(std_pop, 6) AS std_pop, " + ", ".join(f"round(p{q} + 3e-8, 6) AS p{q}" for q in (1, 5, 25, 50, 75, 95, 99)) + f" FROM (SELECT {_MORPH} AS morphology, count(value) AS n, min(value) AS min, max(value) AS max, avg(value) AS mean, stddev_samp(value) AS std, stddev_pop(value) AS std_pop, " + ", ".join(f"quantile_cont(value, {q / 100}) AS p{q}" for q in (1, 5, 25, 50, 75, 95, 99)) + " FROM (SELECT value, (user_id * 37 % 101) / 100.0 AS v FROM events) GROUP BY 1) WHERE morphology IS NOT NULL")
def a18(spark, d):
    e = table(spark, d, "events").select("value", ((F.col("user_id") * 37 % 101) / 100.0).alias("svf"))
    out = quality.describe_by_morphology(e, "value")
    return r6(near6(out, "mean", *[f"p{q}" for q in (1, 5, 25, 50, 75, 95, 99)]), "std", "std_pop")


@query("p19_classes", "SELECT s_suppkey, " + _MORPH + " AS morphology, v < 0.5 AS canyon FROM (SELECT s_suppkey, (s_suppkey * 37 % 101) / 100.0 AS v FROM supplier)")
def p19(spark, d):
    v = (F.col("s_suppkey") * 37 % 101) / 100.0
    return table(spark, d, "supplier").select("s_suppkey", C.morphology(v).alias("morphology"), C.is_canyon(v).alias("canyon"))


@query("w3_date_order", """SELECT 'date_order' AS "check", 'table' AS scope, 'warning' AS severity, count(*) FILTER (date < before) = 0 AS passed, CAST(count(*) FILTER (date < before) AS DOUBLE) AS observed, 0.0::DOUBLE AS expected FROM (SELECT CAST(o_orderdate AS DATE) AS date, lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders)""")
def w3(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("date"))
    return quality.date_order(o, "o_orderkey", groups=("o_custkey",))


@query("w9_merge_layers", "SELECT s_suppkey AS id, s_acctbal AS balance, NULL AS segment, NULL AS size FROM supplier UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment, NULL FROM customer UNION ALL SELECT p_partkey, NULL, NULL, p_size FROM part")
def w9(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return landuse.merge_layers([a, b, table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("size"))])


_HEX = "hx AS (SELECT id, (sqrt(3) / 3 * x - y / 3) / 20 AS q, 2.0 / 3 * y / 20 AS r FROM pt), hr AS (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(-q - r + 0.5) AS rs FROM hx), hd AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs + q + r) AS ds FROM hr)"


@query("r3_hexagons", f"WITH {_PT}, {_HEX} SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END AS BIGINT) AS q, CAST(CASE WHEN dr >= dq AND dr > ds THEN -rq - rs ELSE rr END AS BIGINT) AS r, avg(CAST(id AS DOUBLE)) AS value, count(*) AS n FROM hd GROUP BY 1, 2")
def r3_hex(spark, d):
    return rollup.coarser_hex(_tile_points(spark, d).withColumn("value", F.col("id").cast("double")), 20.0)


@query("q8_industrial_tiles", sql(f"{_CLIP}, {_AREA}, {_PT}, {_CLASSES}, {_IND} " + _report(
    "ind",
    ("tile_area", "row", "error", "tile_area < 700 OR tile_area > 1100"),
    *[(f"{c}_negative", "row", "error", f"{c} < 0") for c in ("industrial_area_m2", "industrial_building_area_m2", "industrial_building_volume_m3", "landfill_area_m2", "quarry_area_m2", "power_plant_count", "chimney_count", "industrial_poi_count", "industrial_building_count", "industrial_contrib_count")],
    ("industrial_index_combined_range", "row", "error", "industrial_index_combined < 0 OR industrial_index_combined > 100"),
    ("confidence_label", "row", "error", "industrial_confidence NOT IN ('high', 'medium', 'low')"),
) + _columns(0), "seg"))
def q8(spark, d):
    return quality.run_checks(_industrial(spark, d).withColumn("tile_area", F.lit(900.0)), quality.industrial_checks(), columns=("tile_id",))


_GRID = "g AS (SELECT p_partkey AS grid_id, 30.0::DOUBLE * (p_partkey % 50) AS x, 30.0::DOUBLE * (p_partkey // 50) AS y FROM part)"
_STEP = "(SELECT median(v - p) FROM (SELECT v, lag(v) OVER (ORDER BY v) AS p FROM (SELECT DISTINCT {0} AS v FROM g)))"


@query(
    "q9_grid",
    f"WITH {_GRID} "
    + _ROUNDED.format(
        _report(
            "g",
            ("unique_ids", "table", "error", "count(*) - count(DISTINCT grid_id)", None, 0),
            ("unique_places", "table", "error", "count(*) - count(DISTINCT (x, y))", None, 0),
            ("inside_percent", "table", "error", "100.0 * count(*) FILTER (x >= -15 AND x < 1380 AND y > -15 AND y < 15000) / count(*)", 90, None),
        )
        + "".join(f" UNION ALL SELECT 'spacing_{c}', 'table', 'error', abs(s - 30) <= 1, s, 30.0::DOUBLE FROM (SELECT {_STEP.format(c)} AS s)" for c in "xy")
    ),
)
def q9(spark, d):
    """A lattice of which the last four columns lie outside the boundary."""
    k = F.col("p_partkey")
    box = [(-15.0, -15.0, 1380.0, -15.0), (1380.0, -15.0, 1380.0, 15000.0), (1380.0, 15000.0, -15.0, 15000.0), (-15.0, 15000.0, -15.0, -15.0)]
    edges = spark.createDataFrame(box, "x1 double, y1 double, x2 double, y2 double")
    g = table(spark, d, "part").select(k.alias("grid_id"), (30.0 * (k % 50)).alias("x"), (30.0 * F.expr("p_partkey DIV 50")).alias("y"))
    return r6(quality.grid_report(g, edges), "observed")


@query("q10_profile", """SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props']) AS "column", (SELECT count(*) FROM events) AS n_rows, unnest([(SELECT count(*) FILTER (event_id IS NULL) FROM events), (SELECT count(*) FILTER (ts IS NULL) FROM events), (SELECT count(*) FILTER (user_id IS NULL) FROM events), (SELECT count(*) FILTER (event_type IS NULL) FROM events), (SELECT count(*) FILTER (value IS NULL) FROM events), (SELECT count(*) FILTER (props IS NULL) FROM events)]) AS nulls""")
def q10(spark, d):
    return quality.profile(table(spark, d, "events")).drop("type")


@query("p2_built_up", """WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS b5, l_tax * 100 AS b4, l_discount * 100 AS b3, l_extendedprice / 1000 AS b6 FROM lineitem),
i AS (SELECT *, (b5 - b4) / nullif(b5 + b4, 0) AS v, (b3 - b6) / nullif(b3 + b6, 0) AS w, (b6 - b5) / nullif(b6 + b5, 0) AS u FROM b)
SELECT l_orderkey, l_linenumber, round((u - (v + w) / 2) / nullif(u + (v + w) / 2, 0), 3) AS ibi, round((b4 - b5) / nullif(b4 + b5, 0), 6) AS ui, round((b6 - b5) / (10 * sqrt(b6 + b3)), 6) AS ebbi FROM i WHERE abs(u + (v + w) / 2) > 1e-3""")
def p2(spark, d):
    """Where the built-up index is far from its pole."""
    b = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("b5"), (F.col("l_tax") * 100).alias("b4"), (F.col("l_discount") * 100).alias("b3"), (F.col("l_extendedprice") / 1000).alias("b6"))
    b3, b4, b5, b6 = (F.col(f"b{k}") for k in (3, 4, 5, 6))
    i = b.withColumns({"v": C.ndvi(b5, b4), "w": C.mndwi(b3, b6), "u": C.ndbi(b6, b5)})
    u, v, w = F.col("u"), F.col("v"), F.col("w")
    return i.where(F.abs(u + (v + w) / 2) > 1e-3).select("l_orderkey", "l_linenumber", F.round(C.ibi(u, v, w), 3).alias("ibi"), F.round(C.ui(b4, b5), 6).alias("ui"), F.round(C.ebbi(b6, b5, b3), 6).alias("ebbi"))


@query("p8_projection", sql("SELECT sensor_id, round(latitude, 6) AS lat, round(longitude, 6) AS lon, true AS in_box FROM sens WHERE latitude IS NOT NULL", "sens"))
def p8(spark, d):
    """There and back: the projected sensors return to where they were, within the box of the stand-ins."""
    e, n = C.to_utm(F.col("longitude"), F.col("latitude"))
    lon, lat = C.from_utm(F.col("e"), F.col("n"))
    s = S.sensors(spark, d).where("latitude IS NOT NULL").withColumns({"e": e, "n": n})
    return s.select("sensor_id", F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"), C.in_bbox(F.col("longitude"), F.col("latitude"), (72.7763, 18.8939, 72.9797, 19.2701)).alias("in_box"))


def _series(south):
    """The projection in SQL: conformal latitude, then three terms of the series, with their coefficients as numbers."""
    f = 1 / 298.257223563
    n = f / (2 - f)
    e, k = 2 * n**0.5 / (1 + n), 0.9996 * 6378137.0 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    a = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    at = lambda x: f"(0.5 * ln((1 + {x}) / (1 - {x})))"
    sinh, cosh = (lambda x: f"((exp({x}) - exp(-({x}))) / 2)"), (lambda x: f"((exp({x}) + exp(-({x}))) / 2)")
    s, sign = "sin(radians(la))", -1 if south else 1
    east = "eta + " + " + ".join(f"{c!r}::DOUBLE * cos({2 * j} * xi) * {sinh(f'{2 * j} * eta')}" for j, c in enumerate(a, 1))
    north = "xi + " + " + ".join(f"{c!r}::DOUBLE * sin({2 * j} * xi) * {cosh(f'{2 * j} * eta')}" for j, c in enumerate(a, 1))
    return f"""(SELECT sensor_id, round(500000 + {k!r}::DOUBLE * ({east}), 4) AS e, round({10_000_000 if south else 0} + {k!r}::DOUBLE * ({north}), 4) AS n FROM (
SELECT sensor_id, atan2(t, cos(d)) AS xi, {at("sin(d) / sqrt(1 + t * t)")} AS eta FROM (
SELECT sensor_id, {sinh(f"{at(s)} - {e!r}::DOUBLE * {at(f'({e!r}::DOUBLE * {s})')}")} AS t, radians(longitude - 75) AS d FROM (SELECT sensor_id, longitude, {sign} * latitude AS la FROM sens WHERE latitude IS NOT NULL))))"""


@query("p8_utm", sql(f"SELECT a.sensor_id, a.e AS easting, a.n AS northing, b.n AS northing_south FROM {_series(False)} a JOIN {_series(True)} b USING (sensor_id)", "sens"))
def p8_utm(spark, d):
    """Easting and northing of the sensors, and of their mirror images south of the equator."""
    s = S.sensors(spark, d).where("latitude IS NOT NULL")
    (e, n), (_, south) = C.to_utm(F.col("longitude"), F.col("latitude")), C.to_utm(F.col("longitude"), -F.col("latitude"), south=True)
    return s.select("sensor_id", F.round(e, 4).alias("easting"), F.round(n, 4).alias("northing"), F.round(south, 4).alias("northing_south"))


@query("g1_centroids", "SELECT CAST(c AS INTEGER) AS ix, CAST(r AS INTEGER) AS iy, 15.0::DOUBLE + 30.0 * c AS x, 15.0::DOUBLE + 30.0 * r AS y, n FROM range(10) a(c) CROSS JOIN range(10) b(r) LEFT JOIN (SELECT floor(300.0::DOUBLE * ((c_custkey * 7919) % 997) / 997.0 / 30) AS cx, floor(300.0::DOUBLE * ((c_custkey * 104729) % 991) / 991.0 / 30) AS cy, count(*) AS n FROM customer GROUP BY ALL) ON cx = c AND cy = r")
def g1(spark, d):
    """Cell centres with the customers around them."""
    at = lambda c: F.floor(F.col(c) / 30).cast("int")
    n = _tile_points(spark, d).groupBy(at("x").alias("ix"), at("y").alias("iy")).agg(F.count("*").alias("n"))
    return landuse.centroids(spark, 0.0, 0.0, 300.0, 300.0).join(n, ["ix", "iy"], "left")


_QUAD = [(0.0, 40.0), (220.0, 0.0), (300.0, 250.0), (60.0, 300.0)]


def _beyond(a, b):
    """SQL: all corners of the tile lie on the outer side of an edge."""
    corners = [f"({b[0] - a[0]}) * (y0 + {dy} - ({a[1]})) - ({b[1] - a[1]}) * (x0 + {dx} - ({a[0]})) < 0" for dx in (0, 30) for dy in (0, 30)]
    return "(" + " AND ".join(corners) + ")"


@query("g2_tiles_within", f"WITH {_PT}, t AS (SELECT c, r, c * 30.0 AS x0, r * 30.0 AS y0 FROM range(10) a(c) CROSS JOIN range(10) b(r)) SELECT 'r' || c || '_c' || r AS tile_id, count(id) AS n FROM t LEFT JOIN pt ON floor(x / 30) = c AND floor(y / 30) = r WHERE NOT (" + " OR ".join(_beyond(a, b) for a, b in zip(_QUAD, [*_QUAD[1:], _QUAD[0]], strict=True)) + ") GROUP BY 1")
def g2(spark, d):
    """Tiles that meet a quadrilateral, with the customers in them."""
    at = lambda c: F.floor(F.col(c) / 30).cast("int")
    n = _tile_points(spark, d).groupBy(at("x").alias("j"), at("y").alias("i")).agg(F.count("*").alias("n"))
    return landuse.tiles_within(spark, _QUAD).join(n, ["i", "j"], "left").select("tile_id", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


@query(
    "g9_reproject",
    sql(
        """tg AS (SELECT r AS row, c AS col, band, 300 + 40.0 * c - 10.0 * r AS x, 1100 - 40.0 * r - 10.0 * c AS y FROM range(12) a(r) CROSS JOIN range(12) b(c) CROSS JOIN (SELECT unnest(['price', 'size']) AS band)),
f AS (SELECT *, (1200 - y) / 30 - 0.5 AS fy, x / 30 - 0.5 AS fx FROM tg),
k AS (SELECT row, col, band, floor(fy) + i AS r, floor(fx) + j AS c, (CASE WHEN i = 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END) * (CASE WHEN j = 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) AS w FROM f CROSS JOIN (SELECT unnest([0, 1]) AS i) CROSS JOIN (SELECT unnest([0, 1]) AS j))
SELECT CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, k.band, CASE WHEN count(value) = 4 THEN round(sum(w * value), 5) END AS value, count(value) <> 4 AS is_nodata FROM k LEFT JOIN pix ON pix.band = k.band AND pix.r = k.r AND pix.c = k.c GROUP BY ALL""",
        "pix",
    ),
)
def g9_reproject(spark, d):
    """A turned and coarser grid over the lattice of parts."""
    t = landuse.centroids(spark, 0.0, 0.0, 12.0, 12.0, 1.0).select(F.col("iy").alias("row"), F.col("ix").alias("col"), F.col("ix").cast("double").alias("x"), F.col("iy").cast("double").alias("y"))
    turned = lambda x, y: (300 + 40.0 * x - 10.0 * y, 1100 - 40.0 * y - 10.0 * x)
    out = raster.reproject(t, S.pixels(spark, d), S.pixel_meta(spark), turned)
    return out.select("row", "col", "band", F.round("value", 5).alias("value"), "is_nodata")


# ---- sources and sinks, there and back


def _sensor_pages(spark, d):
    """The registry's JSON for each supplier: names, places and dates are missing here and there."""
    k = F.col("s_suppkey")
    point = lambda a, b: F.struct(a.alias("latitude"), b.alias("longitude"))
    day = lambda n: F.concat(F.date_add(F.lit("2020-01-01").cast("date"), n.cast("int")).cast("string"), F.lit("T00:00:00Z"))
    s = F.struct(
        k.alias("id"),
        F.when(k % 5 != 0, F.col("s_name")).alias("name"),
        point(k / 4.0, k / 8.0).alias("coordinates"),
        F.when(k % 3 == 0, F.struct(point(k / 2.0, k * 1.0).alias("coordinates"))).alias("latest"),
        F.when(k % 7 != 0, F.struct(day(k % 1000).alias("utc"))).alias("datetimeFirst"),
        F.when(k % 11 != 0, F.struct(day(k % 1000 + 30).alias("utc"))).alias("datetimeLast"),
    )
    return table(spark, d, "supplier").select(F.to_json(s).alias("json"))


_NAME = "CASE WHEN s_suppkey % 5 <> 0 THEN s_name ELSE 'pm25_sensor' END AS name"


@query("s4_sensors", f"SELECT s_suppkey AS id, {_NAME}, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey / 2 ELSE s_suppkey / 4 END AS latitude, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_suppkey AS DOUBLE) ELSE s_suppkey / 8 END AS longitude, CAST(DATE '2020-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE) AS first_date, CAST(DATE '2020-01-31' + CAST(s_suppkey % 1000 AS INTEGER) AS DATE) AS last_date FROM supplier WHERE s_suppkey % 7 <> 0 AND s_suppkey % 11 <> 0")
def s4(spark, d):
    return tables.flatten_sensors(_sensor_pages(spark, d))


@query("s4_sensor_rejects", f"SELECT s_suppkey AS id, {_NAME}, CASE WHEN s_suppkey % 7 = 0 THEN 'no first date' ELSE 'no last date' END AS reason FROM supplier WHERE s_suppkey % 7 = 0 OR s_suppkey % 11 = 0")
def s4_rejects(spark, d):
    return tables.sensor_rejects(_sensor_pages(spark, d))


@query("s5_hourly", sql("SELECT datetime, temperature_2m, cloud_cover, CAST(NULL AS DOUBLE) AS dewpoint_2m FROM hourly", "hourly"))
def s5(spark, d):
    """A page a day, with parallel arrays; the dew point is in none."""
    h = S.hourly(spark, d).groupBy(F.to_date("datetime").alias("day")).agg(F.array_sort(F.collect_list(F.struct("datetime", "temperature_2m", "cloud_cover"))).alias("h"))
    arrays = F.struct(F.transform("h", lambda x: F.date_format(x["datetime"], "yyyy-MM-dd'T'HH:mm")).alias("time"), F.col("h.temperature_2m").alias("temperature_2m"), F.col("h.cloud_cover").alias("cloud_cover"))
    return tables.flatten_hourly(h.select(F.to_json(F.struct(arrays.alias("hourly"))).alias("json"))).select("datetime", "temperature_2m", "cloud_cover", "dewpoint_2m")


@query("s7_tables_by_date", sql(A1, "meas", "daily"))
def s7(spark, d):
    """Daily means written by date, of which one day is written again, and read back by column (S2)."""
    path, daily = _folder(spark, "by-date"), readings.daily_mean(S.measurements(spark, d))
    tables.write_by_date(daily, path, order=("sensor_id",))
    tables.write_by_date(daily.where("dayofmonth(date) = 3"), path)
    return r6(tables.read_columns(spark, path, ["sensor_id", "date", "pm25", "sample_count"]), "pm25")


@query("s8_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def s8(spark, d):
    path, s = _folder(spark, "csv"), table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    tables.write_csv(s.withColumn("geometry", F.lit("POINT")), path)
    return spark.read.schema(s.schema).option("header", True).csv(path)


@query("w7_sample_rows", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY md5(l_orderkey || ':' || l_linenumber || ':7') LIMIT 100")
def w7(spark, d):
    return quality.sample_rows(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), 100, ("l_orderkey", "l_linenumber"), seed=7)
