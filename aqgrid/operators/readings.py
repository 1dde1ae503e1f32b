"""Ground readings: daily means, the search for a substitute date, and gap filling from neighbours."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aqgrid.functions.columns import EARTH_KM, accepted_pm25, haversine_km
from aqgrid.operators import order
from aqgrid.sources.scratch import written

#: Of the search for neighbours: days of a span, rows of a part or block, and pairs of places that a task holds at once.
SPAN, CROWD, PAIRS = 32, 200_000, 1 << 18


def daily_mean(measurements: DataFrame) -> DataFrame:
    """Mean and count of accepted values by sensor and UTC day."""
    ok = measurements.where(accepted_pm25(F.col("parameter_id"), F.col("parameter_name"), F.col("value")))
    return ok.groupBy("sensor_id", F.to_date("ts").alias("date")).agg(F.avg("value").alias("pm25"), F.count("*").alias("sample_count"))


def eligible(sensors: DataFrame, dates: DataFrame) -> DataFrame:
    """Sensors with each date of their life span, which is spread over its days to meet the dates by equality."""
    span = F.when(F.col("first_date") <= F.col("last_date"), F.sequence("first_date", "last_date"))
    return sensors.withColumn("date", F.explode(span)).join(dates.select("date").distinct(), "date")


def with_fallback(targets: DataFrame, daily: DataFrame, *, window_days: int = 7, min_samples: int = 3, seasonal: bool = True) -> DataFrame:
    """For each (sensor_id, date) the reading of the day, else of the nearest day (the earlier first), else of the same day
    a year before or after, else none. Targets and readings of a sensor stand in the order of their dates, where the reading
    before and the one behind are the nearest; only targets that find none there look for other years, by an equi-join."""
    good = daily.where((F.col("sample_count") >= min_samples) & F.col("sensor_id").isNotNull() & F.col("date").isNotNull())
    good = good.select("sensor_id", "date", F.struct("pm25", F.col("sample_count").cast("long").alias("sample_count"), F.col("date").alias("day")).alias("_own"))
    both = targets.withColumn("_asked", F.lit(True)).unionByName(good, allowMissingColumns=True)
    up = [Window.partitionBy("sensor_id").orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.asc("date"), F.desc("date"))]
    both = both.withColumns({"_before": F.last("_own", ignorenulls=True).over(up[0]), "_behind": F.last("_own", ignorenulls=True).over(up[1])}).where("_asked")
    off = F.date_diff("date", "_before.day"), F.date_diff("_behind.day", "date")
    first = (off[0] <= window_days) & ~F.coalesce(off[1] < off[0], F.lit(False))
    near = F.when(first, F.col("_before")).when(off[1] <= window_days, F.col("_behind"))
    kind = lambda b: F.when(b["day"] == F.col("date"), "exact").when(b["day"].isNotNull(), "window")
    out = both.select(*targets.columns, near.alias("_b")).withColumn("_kind", kind(F.col("_b")))
    if seasonal:
        asked = out.where("_b IS NULL AND NOT (month(date) = 2 AND day(date) = 29)").select("sensor_id", "date").distinct()
        years = F.explode(F.array(*[F.struct(F.add_months("date", 12 * y).alias("day"), F.lit(int(y > 0)).alias("rank")) for y in (-1, 1)]))
        found = asked.select("sensor_id", "date", years.alias("c")).select("sensor_id", "date", "c.*")
        best = found.join(good.withColumnRenamed("date", "day"), ["sensor_id", "day"]).groupBy("sensor_id", "date").agg(F.min_by("_own", "rank").alias("_other"))
        out = out.join(best, ["sensor_id", "date"], "left")
        take = F.col("_b").isNull()
        out = out.withColumns({"_kind": F.when(take & F.col("_other").isNotNull(), "seasonal").otherwise(F.col("_kind")), "_b": F.when(take, F.col("_other")).otherwise(F.col("_b"))})
    return out.select(
        *targets.columns,
        F.col("_b.pm25").alias("pm25"),
        F.coalesce("_b.sample_count", F.lit(0)).cast("long").alias("sample_count"),
        F.col("_b.day").alias("actual_date"),
        F.coalesce("_kind", F.lit("none")).alias("fallback_type"),
        F.coalesce(F.date_diff("_b.day", "date"), F.lit(0)).cast("long").alias("days_offset"),
    )


def _in_buckets(targets: DataFrame, valid: DataFrame, max_km: float) -> tuple[DataFrame, DataFrame]:
    """Targets in the buckets (by, bx) that they look into, and measured sensors in their own.

    Buckets are bands of latitude at least ``max_km`` high, cut by longitude so that each is at least as wide at its own
    and its neighbouring bands' highest latitude; a target looks into the 3 x 3 around its own. The buckets of a band close to
    a circle, so that pairs across the 180th meridian meet. Beyond 89 degrees a band is one bucket.
    """
    dy = max_km / 110.0

    def slices(band: Column) -> Column:
        top = F.greatest(F.abs(band - 1), F.abs(band + 2)) * dy
        wide = dy / F.cos(F.radians(F.least(top, F.lit(89.0))))
        return F.when(top < 89, F.greatest(F.floor(360 / wide), F.lit(1))).otherwise(1)

    def slice_of(longitude: str, n: Column) -> Column:
        return F.pmod(F.floor((F.col(longitude) + 180) / 360 * n), n)

    bands = F.explode(F.array(*[F.floor(F.col("latitude") / dy) + i for i in (-1, 0, 1)]))
    t = targets.where("latitude IS NOT NULL AND longitude IS NOT NULL").withColumn("by", bands)
    n, own = slices(F.col("by")), slice_of("longitude", slices(F.col("by")))
    t = t.select("date", "sensor_id", "latitude", "longitude", "by", F.explode(F.array_distinct(F.array(*[F.pmod(own + j, n) for j in (-1, 0, 1)]))).alias("bx"))
    v = valid.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(
        "date",
        F.col("sensor_id").alias("other"),
        F.col("latitude").alias("olat"),
        F.col("longitude").alias("olon"),
        F.col("pm25").alias("opm"),
        F.floor(F.col("latitude") / dy).alias("by"),
        slice_of("longitude", slices(F.floor(F.col("latitude") / dy))).alias("bx"),
    )
    return t, v


def neighbours(targets: DataFrame, valid: DataFrame, max_km: float) -> DataFrame:
    """Pairs of a target and another sensor with a value on the same date, at most ``max_km`` apart."""
    t, v = _in_buckets(targets, valid, max_km)
    pairs = t.join(v.hint("merge"), ["date", "by", "bx"]).where("other <> sensor_id")
    return pairs.withColumn("km", haversine_km(F.col("latitude"), F.col("longitude"), F.col("olat"), F.col("olon"))).where(F.col("km") <= max_km)


def _near_sums(targets: DataFrame, known: DataFrame, max_km: float, power: float) -> DataFrame:
    """For each target that has neighbours: their number n, the one within a metre with the smallest id (near, with its value opm),
    and of the others the sum s of weighted values and w of the weights.

    The pairs are never rows: in a bucket and a span of dates, the distances between the places of targets and of measured
    sensors are worked out once for all dates, and matrix products add up the dates. Crowded buckets are dealt into parts of the
    targets and blocks of the measured sensors, so that a task's memory is bounded; the work is the pairs of places."""
    place = ["sensor_id", "date", "latitude", "longitude"]
    day = F.date_diff("date", F.lit("1970-01-01").cast("date"))
    span = F.floor(day / SPAN).alias("span"), F.pmod(day, F.lit(SPAN)).alias("day")
    t, v = _in_buckets(targets, known, max_km)
    t, v = t.where("sensor_id IS NOT NULL AND date IS NOT NULL").select("*", *span), v.where("other IS NOT NULL AND date IS NOT NULL").select("*", *span).drop("date")
    keys = ["span", "by", "bx"]
    # the densest bucket of measured sensors; one of targets has about those of nine boxes
    most = v.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    box = targets.groupBy(span[0], F.floor(F.col("latitude") / (max_km / 110.0)).alias("by"), F.floor(F.col("longitude") / (max_km / 110.0)).alias("bx")).agg(F.count("*").alias("n"))
    parts, blocks = max(1, -(-9 * (box.agg(F.max("n")).first()[0] or 0) // CROWD)), max(1, -(-most // CROWD))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    keys += ["part", "block"]
    t = t.withColumn("part", deal("sensor_id", parts)).withColumn("block", every(blocks)).repartition(order.parts(targets), *keys)
    v = v.withColumn("block", deal("other", blocks)).withColumn("part", every(parts))

    def add(ts: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        if not len(ts) or not len(vs):
            return pd.DataFrame(columns=[*place, "n", "near", "opm", "s", "w"])
        ids = pd.factorize(pd.concat([ts["sensor_id"], vs["other"]], ignore_index=True), sort=True)[0]
        ts, vs = ts.assign(id=ids[: len(ts)]), vs.assign(id=ids[len(ts) :])
        at, of = (d.groupby(c, sort=False).ngroup().to_numpy() for d, c in ((ts, ["id", "latitude", "longitude"]), (vs, ["id", "olat", "olon"])))
        # the first row of each place
        tp, vp = (d.iloc[np.unique(k, return_index=True)[1]] for d, k in ((ts, at), (vs, of)))
        value, have = np.zeros((len(vp), SPAN)), np.zeros((len(vp), SPAN))
        value[of, vs["day"]], have[of, vs["day"]] = vs["opm"], 1.0
        n, s, w = (np.zeros((len(tp), SPAN)) for _ in range(3))
        near, opm = np.full((len(tp), SPAN), -1), np.full((len(tp), SPAN), np.nan)
        lat, lon, olat, olon = (np.radians(d[c].to_numpy(float)) for d, c in ((tp, "latitude"), (tp, "longitude"), (vp, "olat"), (vp, "olon")))
        tid, vid = tp["id"].to_numpy(), vp["id"].to_numpy()
        step = max(1, PAIRS // len(vp))
        for k in range(0, len(tp), step):
            a = slice(k, k + step)
            h = np.sin((olat - lat[a, None]) / 2) ** 2 + np.cos(lat[a, None]) * np.cos(olat) * np.sin((olon - lon[a, None]) / 2) ** 2
            km = 2 * EARTH_KM * np.arctan2(np.sqrt(h), np.sqrt(1 - h))
            ok = (km <= max_km) & (tid[a, None] != vid)
            close = ok & (km < 0.001)
            weight = np.zeros_like(km)
            np.divide(1.0, km**power, out=weight, where=ok & ~close)
            n[a], s[a], w[a] = ok.astype(float) @ have, weight @ value, weight @ have
            x, y = np.nonzero(close)
            for i, j in sorted(zip(x + k, y, strict=True), key=lambda p: -vid[p[1]]):  # the smallest id comes last
                on = have[j] > 0
                near[i, on], opm[i, on] = j, value[j, on]
        cell = at, ts["day"].to_numpy()
        who = near[cell]
        out = ts[place].assign(n=n[cell].astype("int64"), opm=opm[cell], s=s[cell], w=w[cell])
        out["near"] = vp["other"].astype(object).reset_index(drop=True).reindex(who).where(who >= 0, None).to_numpy()
        return out[out["n"] > 0][[*place, "n", "near", "opm", "s", "w"]]

    kind = known.schema["sensor_id"].dataType.simpleString()
    schema = f"sensor_id {kind}, date date, latitude double, longitude double, n long, near {kind}, opm double, s double, w double"
    sums = t.groupBy(*keys).cogroup(v.groupBy(*keys)).applyInPandas(add, schema)
    return sums.groupBy(*place).agg(F.sum("n").alias("n"), F.min("near").alias("near"), F.min_by("opm", "near").alias("opm"), F.sum("s").alias("s"), F.sum("w").alias("w"))


def idw_fill(readings: DataFrame, *, max_km: float = 10.0, min_neighbours: int = 3, power: float = 2.0) -> DataFrame:
    """Fill missing values by inverse distance weighting over the same day's measured ones; a neighbour within a metre gives
    its own value (of several the one with the smallest id). Rows without coordinates or neighbours stay missing.

    A sensor counts once a date: of repeated rows the one with the smallest reading and place. Repeated missing rows are worked
    out once for each place and all filled. The readings are written once, as both sides of the search and the result need them."""
    readings = written(readings, "readings")
    place = ["sensor_id", "date", "latitude", "longitude"]
    known = readings.where("pm25 IS NOT NULL").groupBy("sensor_id", "date").agg(F.min(F.struct("pm25", "latitude", "longitude")).alias("r")).select("sensor_id", "date", "r.*")
    est = _near_sums(readings.where("pm25 IS NULL").select(*place).distinct(), known, max_km, power)
    est = est.where(F.col("n") >= min_neighbours).select(*place, F.coalesce(F.when(F.col("near").isNotNull(), F.col("opm")), F.try_divide("s", "w")).alias("idw"))
    out = readings.join(est, place, "left").select(*readings.columns, "idw")
    new = F.col("pm25").isNull() & F.col("idw").isNotNull()
    return (
        out.withColumn("fallback_type", F.when(new, "spatial_idw").otherwise(F.col("fallback_type")))
        .withColumn("days_offset", F.when(new, F.lit(0).cast("long")).otherwise(F.col("days_offset")))
        .withColumn("pm25", F.coalesce("pm25", "idw"))
        .drop("idw")
    )


def fallback_statistics(readings: DataFrame) -> DataFrame:
    """Rows and percent by type; the total is a window over the few types."""
    from pyspark.sql import Window

    n = readings.groupBy("fallback_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return n.select("fallback_type", "n", (100.0 * F.col("n") / total).alias("percent"))


def fill_report(filled: DataFrame) -> DataFrame:
    """Missing values before and after filling, in one pass: what was filled says so in its type."""
    gone, new = F.col("pm25").isNull(), F.coalesce(F.col("fallback_type") == "spatial_idw", F.lit(False))
    out = filled.agg(F.count_if(gone | new).alias("missing_before"), F.count("*").alias("n_rows"), F.count_if(gone).alias("missing_after"))
    return out.withColumn("filled_percent", F.try_divide(100.0 * (F.col("missing_before") - F.col("missing_after")), F.col("missing_before")))
