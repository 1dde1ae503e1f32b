"""Logical tables of the library over the tables at hand, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _location(df: DataFrame, key: str) -> DataFrame:
    """Hashed coordinates in a box of about 22 x 42 km; none where the id is a multiple of 17."""
    k = F.col(key)
    return df.withColumn("latitude", F.when(k % 17 != 0, 18.8939 + 0.3762 * ((k * 7919) % 997) / 997.0)).withColumn("longitude", F.when(k % 17 != 0, 72.7763 + 0.2034 * ((k * 104729) % 991) / 991.0))


def measurements(spark, sf_dir) -> DataFrame:
    return as_measurements(table(spark, sf_dir, "events"))


def as_measurements(events: DataFrame) -> DataFrame:
    kind = F.when(F.col("event_type") == "purchase", 1).otherwise(2)
    return events.select(F.col("user_id").alias("sensor_id"), F.col("ts").cast("timestamp").alias("ts"), kind.alias("parameter_id"), F.lit("pm25").alias("parameter_name"), "value")


def sensors(spark, sf_dir) -> DataFrame:
    return _location(table(spark, sf_dir, "events").select(F.col("user_id").alias("sensor_id")).distinct(), "sensor_id")


def days(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.to_date("ts").alias("date")).distinct()


def order_dates(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()


def hourly(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("datetime"), "value")
    h = e.groupBy("datetime").agg(
        F.max("value").alias("temperature_2m"),
        F.min("value").alias("relative_humidity_2m"),
        F.min("value").alias("wind_speed_10m"),
        F.round(F.sum("value"), 4).alias("precipitation"),
        F.count("*").cast("double").alias("cloud_cover"),
        F.lit(1000.0).alias("surface_pressure"),
    )
    day, hour = F.dayofmonth("datetime"), F.hour("datetime")
    return h.where(~((day + hour) % 7 == 5) & ~((day % 10 == 0) & (hour < 12)))


def pixels(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    at = [F.lit("a").alias("raster_id"), F.expr("CAST(p_partkey DIV 50 AS INT)").alias("row"), F.expr("CAST(p_partkey % 50 AS INT)").alias("col")]
    one = p.select(*at, F.lit("price").alias("band"), F.col("p_retailprice").alias("value"))
    return one.unionByName(p.select(*at, F.lit("size").alias("band"), F.col("p_size").cast("double").alias("value")))


def pixel_meta(spark) -> DataFrame:
    rows = [("a", "price", 0.0, 1200.0, 30.0, None, 0.01, -5.0), ("a", "size", 0.0, 1200.0, 30.0, 13.0, None, None)]
    return spark.createDataFrame(rows, "raster_id string, band string, x_origin double, y_origin double, res double, nodata double, scale double, offset double")


def points(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("id"), (1500.0 * ((k * 7919) % 997) / 997.0).alias("x"), (1200.0 * ((k * 104729) % 991) / 991.0).alias("y"))


def scenes(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.to_date("o_orderdate").alias("date"), (F.floor("o_totalprice") % 100).alias("cloud"))


def cell(key: str) -> Column:
    """Ten customers live in a cell, so that cells grow with the customers."""
    return F.expr(f"{key} DIV 10")


def observed(spark, sf_dir) -> DataFrame:
    """A signal from every order: values by cell and date, on the dates whose mean cloud is below 50 (about half)."""
    clear = scenes(spark, sf_dir).groupBy("date").agg(F.avg("cloud").alias("cloud")).where("cloud < 50").select("date")
    o = table(spark, sf_dir, "orders").groupBy(cell("o_custkey").alias("cell"), F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("value"))
    return o.join(clear, "date", "left_semi").select("cell", "date", "value")


def road_segments(spark, sf_dir) -> DataFrame:
    """Polylines of each user's events in time order, as segments."""
    from pyspark.sql import Window

    k = F.col("event_id")
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", (300.0 * ((k * 7919) % 997) / 997.0).alias("x1"), (300.0 * ((k * 104729) % 991) / 991.0).alias("y1"))
    w = Window.partitionBy("user_id").orderBy("event_id")
    e = e.withColumn("x2", F.lead("x1").over(w)).withColumn("y2", F.lead("y1").over(w))
    return e.where("x2 IS NOT NULL").select(k.alias("feature_id"), F.col("event_type"), "x1", "y1", "x2", "y2")


def triangles(spark, sf_dir) -> DataFrame:
    """Oriented edges of a triangle for each part."""
    k = F.col("p_partkey")
    p = table(spark, sf_dir, "part").select(
        k.alias("feature_id"),
        "p_size",
        *[(300.0 * ((k * m) % 997) / 997.0).alias(f"x{i}") for i, m in ((1, 7919), (2, 7907), (3, 7901))],
        *[(300.0 * ((k * m) % 991) / 991.0).alias(f"y{i}") for i, m in ((1, 104729), (2, 104723), (3, 104717))],
    )
    e = F.explode(F.array(*[F.struct(F.col(f"x{a}").alias("x1"), F.col(f"y{a}").alias("y1"), F.col(f"x{b}").alias("x2"), F.col(f"y{b}").alias("y2")) for a, b in ((1, 2), (2, 3), (3, 1))]))
    return p.withColumn("e", e).select("feature_id", "p_size", "e.*")


def train(spark, sf_dir) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        k.alias("id"), F.array(F.lit(1.0), ((k * 31) % 101) / 101.0).alias("x"), (F.col("s_acctbal") / 1000).alias("y"), (100.0 * ((k * 7919) % 997) / 997.0).alias("cx"), (100.0 * ((k * 104729) % 991) / 991.0).alias("cy"), (k % 10).cast("double").alias("t")
    )


def asked(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("id"), F.array(F.lit(1.0), ((k * 37) % 101) / 101.0).alias("x"), (100.0 * ((k * 7919) % 997) / 997.0).alias("cx"), (100.0 * ((k * 104729) % 991) / 991.0).alias("cy"), (k % 10).cast("double").alias("t")
    )


# ---- the same in SQL, as common table expressions

SQL = {
    "meas": "meas AS (SELECT user_id AS sensor_id, ts, CASE WHEN event_type = 'purchase' THEN 1 ELSE 2 END AS parameter_id, value FROM events)",
    "daily": "daily AS (SELECT sensor_id, CAST(ts AS DATE) AS date, avg(value) AS pm25, count(*) AS sample_count FROM meas WHERE parameter_id = 2 AND value >= 0 GROUP BY ALL)",
    "sens": (
        "sens AS (SELECT sensor_id, CASE WHEN sensor_id % 17 <> 0 THEN 18.8939 + 0.3762 * ((sensor_id * 7919) % 997) / 997.0 END AS latitude, "
        "CASE WHEN sensor_id % 17 <> 0 THEN 72.7763 + 0.2034 * ((sensor_id * 104729) % 991) / 991.0 END AS longitude FROM (SELECT DISTINCT user_id AS sensor_id FROM events))"
    ),
    "days": "days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events)",
    "hourly": (
        "hourly AS (SELECT * FROM (SELECT date_trunc('hour', ts) AS datetime, max(value) AS temperature_2m, min(value) AS relative_humidity_2m, min(value) AS wind_speed_10m, "
        "round(sum(value), 4) AS precipitation, CAST(count(*) AS DOUBLE) AS cloud_cover, 1000.0::DOUBLE AS surface_pressure FROM events GROUP BY 1) "
        "WHERE NOT ((day(datetime) + hour(datetime)) % 7 = 5) AND NOT (day(datetime) % 10 = 0 AND hour(datetime) < 12))"
    ),
    "pix": (
        "pix AS (SELECT 'price' AS band, p_partkey // 50 AS r, p_partkey % 50 AS c, false AS nd, p_retailprice * 0.01::DOUBLE + -5.0::DOUBLE AS value FROM part UNION ALL "
        "SELECT 'size', p_partkey // 50, p_partkey % 50, p_size = 13, CASE WHEN p_size <> 13 THEN CAST(p_size AS DOUBLE) END FROM part)"
    ),
    "pts": "pts AS (SELECT c_custkey AS id, 1500.0::DOUBLE * ((c_custkey * 7919) % 997) / 997.0 AS x, 1200.0::DOUBLE * ((c_custkey * 104729) % 991) / 991.0 AS y FROM customer)",
    "scenes": "scenes AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(floor(o_totalprice) AS BIGINT) % 100 AS cloud FROM orders)",
    "obs": (
        "clear AS (SELECT CAST(o_orderdate AS DATE) AS date FROM orders GROUP BY 1 HAVING avg(CAST(floor(o_totalprice) AS BIGINT) % 100) < 50), "
        "obs AS (SELECT o_custkey // 10 AS cell, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT date FROM clear) GROUP BY ALL)"
    ),
    "seg": (
        "seg AS (SELECT * FROM (SELECT event_id AS feature_id, event_type, 300.0::DOUBLE * ((event_id * 7919) % 997) / 997.0 AS x1, 300.0::DOUBLE * ((event_id * 104729) % 991) / 991.0 AS y1, "
        "lead(300.0::DOUBLE * ((event_id * 7919) % 997) / 997.0) OVER w AS x2, lead(300.0::DOUBLE * ((event_id * 104729) % 991) / 991.0) OVER w AS y2 FROM events "
        "WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) WHERE x2 IS NOT NULL)"
    ),
}


def sql(body: str, *names: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names) + (" " + body if body.lstrip().upper().startswith("SELECT") else ", " + body)
