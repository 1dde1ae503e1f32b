"""Table checks as rows (check, scope, severity, passed, observed, expected), and table profiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aqgrid.functions.columns import is_canyon, morphology
from aqgrid.operators import order as ordering
from aqgrid.operators.landuse import inside
from aqgrid.operators.quantiles import exact_quantiles


@dataclass(frozen=True)
class Check:
    """A condition that each row must meet; ``observed`` counts the rows that don't."""

    name: str
    broken: Column
    scope: str = "row"
    severity: str = "error"


@dataclass(frozen=True)
class Measure:
    """An aggregate of the whole table that must lie between two bounds; null fails."""

    name: str
    value: Column
    low: float | None = None
    high: float | None = None
    severity: str = "error"
    scope: str = "table"


def _row(name: str, scope: str, severity: str, passed: Column, observed: Column, expected: float) -> Column:
    return F.struct(F.lit(name).alias("check"), F.lit(scope).alias("scope"), F.lit(severity).alias("severity"), F.coalesce(passed, F.lit(False)).alias("passed"), observed.cast("double").alias("observed"), F.lit(float(expected)).alias("expected"))


def run_checks(df: DataFrame, checks: list[Check], columns: tuple[str, ...] = (), measures: list[Measure] | None = None, optional: tuple[str, ...] = ()) -> DataFrame:
    """All checks and measures in one pass over the table. Missing columns fail a check of their own, missing optional ones
    give a warning."""
    measures = measures or []
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(c.broken).alias(f"_{k}") for k, c in enumerate(checks)], *[m.value.alias(f"_m{k}") for k, m in enumerate(measures)])
    rows = [_row(c.name, c.scope, c.severity, F.col(f"_{k}") == 0, F.col(f"_{k}"), 0) for k, c in enumerate(checks)]
    for k, m in enumerate(measures):
        v = F.col(f"_m{k}")
        within = F.lit(True) if m.low is None else v >= m.low
        within = within if m.high is None else within & (v <= m.high)
        rows.append(_row(m.name, m.scope, m.severity, within & v.isNotNull(), v, m.high if m.low is None else m.low))
    for name, wanted, severity in (("columns", columns, "error"), ("optional_columns", optional, "warning")):
        if wanted:
            n = len([c for c in wanted if c not in df.columns])
            rows.append(_row(name, "table", severity, F.lit(n == 0), F.lit(n), 0))
    return counts.select(F.inline(F.array(*rows)))


def coverage(c: str) -> Column:
    """Percent of the rows with a value."""
    return F.try_divide(100.0 * F.count(c), F.count("*"))


def missing_values(columns: list[str]) -> list[Check]:
    return [Check(f"{c}_missing", F.col(c).isNull(), severity="warning") for c in columns]


def missing_dates(df: DataFrame, expected: DataFrame, severity: str = "error") -> DataFrame:
    """One row: how many of the expected dates the table lacks."""
    gone = expected.select("date").distinct().join(df.select("date").distinct(), "date", "left_anti")
    return gone.agg(F.count("*").alias("n")).select(F.inline(F.array(_row("missing_dates", "table", severity, F.col("n") == 0, F.col("n"), 0))))


def date_order(df: DataFrame, order: str, date: str = "date", groups: tuple[str, ...] = ()) -> DataFrame:
    """One row: how many dates are earlier than the one before them in ``order`` (within ``groups``, which then deal the work;
    without them ranges of the order do, each taking over the last row of the range before it)."""
    if groups:
        rows = df.withColumn("before", F.struct(F.lag(date).over(Window.partitionBy(*groups).orderBy(order)).alias(date)))
    else:
        rows = ordering.with_before(df, order, (date,))
    falls = rows.select((F.col(date) < F.col("before")[date]).alias("falls")).agg(F.count_if("falls").alias("n"))
    return falls.select(F.inline(F.array(_row("date_order", "table", "warning", F.col("n") == 0, F.col("n"), 0))))


def outside(c: str, low: float | None = None, high: float | None = None) -> Column:
    x, out = F.col(c), F.lit(False)
    if low is not None:
        out = out | (x < low)
    if high is not None:
        out = out | (x > high)
    return F.coalesce(out, F.lit(False))


READINGS = ("date", "sensor_id", "sensor_name", "latitude", "longitude", "first_date", "last_date", "pm25", "sample_count", "actual_date", "fallback_type", "days_offset")


def readings_checks() -> list[Check]:
    kinds = ("exact", "window", "seasonal", "spatial_idw", "none")
    return [
        Check("pm25_range", outside("pm25", 0, 1000)),
        Check("pm25_extreme", outside("pm25", None, 500), severity="warning"),
        Check("pm25_below_1", outside("pm25", 1), severity="warning"),
        Check("pm25_above_300", outside("pm25", None, 300), severity="warning"),
        Check("fallback_type", ~F.col("fallback_type").isin(*kinds)),
        Check("latitude", outside("latitude", -90, 90)),
        Check("longitude", outside("longitude", -180, 180)),
        Check("coordinates_missing", F.col("latitude").isNull() | F.col("longitude").isNull(), severity="warning"),
        Check("exact_offset", (F.col("fallback_type") == "exact") & (F.col("days_offset") != 0), severity="warning"),
    ]


def readings_report(df: DataFrame, expected: DataFrame, least_coverage: float = 50.0) -> DataFrame:
    """All checks of ground readings: columns, ranges, labels, coverage and the expected dates."""
    return run_checks(df, readings_checks(), READINGS, [Measure("pm25_coverage", coverage("pm25"), low=least_coverage)]).unionByName(missing_dates(df, expected))


# Columns of matched weather, the bands outside which a value is an error, and those that give a warning.
WEATHER = ("date", "datetime_utc", "temperature_2m", "relative_humidity_2m", "dewpoint_2m", "surface_pressure", "wind_speed_10m", "wind_direction_10m", "precipitation", "cloud_cover")
WEATHER_DAILY = ("temp_mean", "temp_max", "temp_min", "rh_mean", "wind_speed_mean", "wind_speed_max", "precip_total", "cloud_cover_mean", "pressure_mean")
WEATHER_ERROR = {"temperature_2m": (0, 50), "relative_humidity_2m": (0, 100), "wind_speed_10m": (0, None), "wind_direction_10m": (0, 360), "precipitation": (0, None), "cloud_cover": (0, 100)}
WEATHER_WARNING = {"temperature_2m": (10, 45), "wind_speed_10m": (None, 30), "surface_pressure": (950, 1050)}


def weather_checks(columns: list[str]) -> list[Check]:
    """Errors, and warnings for what lies outside the warning band but is no error."""
    out = [Check(f"{c}_range", outside(c, a, b)) for c, (a, b) in WEATHER_ERROR.items() if c in columns]
    for c, (a, b) in WEATHER_WARNING.items():
        if c in columns:
            error = outside(c, *WEATHER_ERROR[c]) if c in WEATHER_ERROR else F.lit(False)
            out.append(Check(f"{c}_unusual", outside(c, a, b) & ~error, severity="warning"))
    return out


def weather_report(df: DataFrame, expected: DataFrame, order: str, groups: tuple[str, ...] = ()) -> DataFrame:
    """All checks of matched weather: columns, bands, missing values, repeated dates, their order and the expected ones."""
    have = [c for c in (*WEATHER, *WEATHER_DAILY) if c in df.columns]
    repeated = Measure("repeated_dates", (F.count("date") - F.count_distinct("date")).cast("double"), high=0)
    out = run_checks(df, weather_checks(df.columns) + missing_values(have), WEATHER, [repeated], WEATHER_DAILY)
    return out.unionByName(date_order(df, order, groups=groups)).unionByName(missing_dates(df, expected, "warning"))


# Smallest and largest area of a tile of 30 m.
TILE_AREA = (700, 1100)


def dust_checks(area: str = "tile_area") -> list[Check]:
    names = ("total_road_m", "unpaved_road_m", "road_weighted", "construction_area_m2", "construction_count")
    out = [Check("tile_area", outside(area, *TILE_AREA))] + [Check(f"{c}_negative", outside(c, 0)) for c in names]
    out += [Check(f"{c}_range", outside(c, 0, 100)) for c in ("pct_unpaved", "road_dust_index", "construction_dust_index", "dust_index_combined")]
    return [*out, Check("unpaved_within_total", F.col("unpaved_road_m") > F.col("total_road_m") + 1e-6)]


def compare_dates(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows (status, date): missing, extra and matched dates."""
    e, a = expected.select("date").distinct(), actual.select("date").distinct()
    tag = lambda d, s: d.select(F.lit(s).alias("status"), "date")
    return tag(e.join(a, "date", "left_anti"), "missing").union(tag(a.join(e, "date", "left_anti"), "extra")).union(tag(e.join(a, "date", "left_semi"), "matched"))


def describe(df: DataFrame, column: str) -> DataFrame:
    """Size, extremes, moments and exact percentiles of a column."""
    return _described(df, column)


def describe_by_morphology(df: DataFrame, column: str = "pm25", svf: str = "svf") -> DataFrame:
    """``describe`` for each morphology class of the sky view; rows outside every class are left out."""
    return _described(df.withColumn("morphology", morphology(F.col(svf))).where("morphology IS NOT NULL"), column, "morphology")


def _described(df: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Moments in one aggregate of partial sums, percentiles by selection over the whole column; both have a row a group."""
    ps = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
    c, keys = F.col(column), [key] if key else []
    moments = df.groupBy(*keys).agg(F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.stddev_pop(c).alias("std_pop"))
    quantiles = exact_quantiles(df, column, ps, keys)
    out = moments.join(F.broadcast(quantiles), keys, "left") if key else moments.join(F.broadcast(quantiles), how="left")
    return out.select(*keys, "n", "min", "max", "mean", "std", "std_pop", *[F.col("q")[k].alias(f"p{round(100 * q)}") for k, q in enumerate(ps)])


def canyon_share(cells: DataFrame, svf: str = "svf") -> DataFrame:
    """Extremes and mean of the sky view over all cells, those without one, and canyons as a number and percent of all cells."""
    c, n = F.col(svf), F.count_if(is_canyon(F.col(svf)))
    return cells.agg(F.min(c).alias("min"), F.avg(c).alias("mean"), F.max(c).alias("max"), F.count_if(c.isNull()).alias("n_missing"), n.alias("n_canyons"), F.try_divide(100.0 * n, F.count("*")).alias("canyon_percent"))


def sample_rows(df: DataFrame, n: int, keys: tuple[str, ...], seed: int = 0) -> DataFrame:
    """``n`` rows picked by the digest of their keys and a seed: the same ones however the table is dealt."""
    return df.orderBy(F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))).cast("binary"))).limit(n)


def null_counts(df: DataFrame, top: int = 10) -> DataFrame:
    """The columns with the most nulls."""
    n = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = n.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])))
    return rows.orderBy(F.desc("nulls"), "column").limit(top)


def uniqueness(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count(column).alias("n"), F.count_distinct(column).alias("n_unique"), (F.count(column) - F.count_distinct(column)).alias("n_duplicates"))


def month_parity(series: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Each date of a month against the month's first: cells compared, values that differ, masks that differ."""
    d = series.select("grid_id", "date", "value", F.trunc("date", "MM").alias("month"))
    first = d.groupBy("month").agg(F.min("date").alias("first"))  # a row a month
    d = d.join(first, "month")
    ref = d.where("date = first").select("month", "grid_id", F.col("value").alias("ref"))
    both = d.where("date > first").join(ref, ["month", "grid_id"])
    return both.groupBy("date").agg(
        F.count("*").alias("n_cells"), F.count_if(F.abs(F.col("value") - F.col("ref")) > tolerance).alias("n_values"), F.count_if(F.col("value").isNull() != F.col("ref").isNull()).alias("n_masks")
    )


def year_coverage(dates: DataFrame, mapped: DataFrame) -> DataFrame:
    """By year: dates, those with a source, percent."""
    d = dates.select("date").distinct().join(mapped.select("date", "source_date"), "date", "left")
    return d.groupBy(F.year("date").cast("long").alias("year")).agg(F.count("*").alias("total"), F.count("source_date").alias("mapped"), (100.0 * F.count("source_date") / F.count("*")).alias("percent"))


def grid_spacing(grid: DataFrame, column: str) -> DataFrame:
    """Median step between neighbouring distinct coordinates."""
    steps = ordering.distinct_before(grid, column).select((F.col("value") - F.col("before")).alias("step"))
    found = exact_quantiles(steps, "step", (0.5,)).first()
    return grid.sparkSession.createDataFrame([(found["q"][0] if found else None,)], "spacing double")


# Ranges of the feature table by column name or prefix.
FEATURES = {
    "toa_": (-0.1, 2), "ndvi": (-2, 2), "ibi": (-2, 2), "ndbi": (-2, 2), "ui": (-2, 2), "mndwi": (-2, 2), "bsi": (-2, 2), "ebbi": (-2, 2), "sentinel2_evi": (-1, 1.5), "s5p_no2": (0, None), "pct_": (0, 100), "pm25": (0, 1000),
    "total_": (0, None), "unpaved_": (0, None), "road_": (0, None), "construction_": (0, None), "dust_": (0, None), "industrial_": (0, None), "power_": (0, None), "chimney_": (0, None), "landfill_": (0, None), "quarry_": (0, None),
}


def feature_checks(dtypes: list[tuple[str, str]]) -> list[Check]:
    """Checks by group of the feature table, for the columns that are there; a flagged signal counts only where it is valid."""
    names, out = {c for c, _ in dtypes}, []
    for c, kind in dtypes:
        if kind in ("string", "boolean") or c.endswith("_meta"):
            continue
        for name, (low, high) in FEATURES.items():
            if c == name or (name.endswith("_") and c.startswith(name)):
                broken = outside(c, low, high)
                out.append(Check(f"{c}_range", broken & ~F.col(f"{c}_is_nodata") if f"{c}_is_nodata" in names else broken))
    return out


def feature_measures(columns: list[str]) -> list[Measure]:
    """Signals must not be nodata throughout."""
    out = [Measure(f"{c.removesuffix('_is_nodata')}_valid", F.count_if(~F.col(c)), low=1) for c in columns if c.endswith("_is_nodata")]
    return out + ([Measure("pm25_valid", F.count("pm25"), low=1)] if "pm25" in columns else [])


def feature_report(df: DataFrame, columns: tuple[str, ...] = ("grid_id", "date")) -> DataFrame:
    """All checks of the feature table."""
    return run_checks(df, feature_checks(df.dtypes), columns, [Measure("rows", F.count("*"), low=1), *feature_measures(df.columns)])


def industrial_checks(area: str = "tile_area") -> list[Check]:
    names = ("industrial_area_m2", "industrial_building_area_m2", "industrial_building_volume_m3", "landfill_area_m2", "quarry_area_m2", "power_plant_count", "chimney_count", "industrial_poi_count", "industrial_building_count", "industrial_contrib_count")
    out = [Check("tile_area", outside(area, *TILE_AREA))] + [Check(f"{c}_negative", outside(c, 0)) for c in names]
    return [*out, Check("industrial_index_combined_range", outside("industrial_index_combined", 0, 100)), Check("confidence_label", ~F.col("industrial_confidence").isin("high", "medium", "low"))]


def raster_report(pixels: DataFrame, meta: DataFrame, *, res: float, tolerance: float = 0.1, low: float = 0.0, high: float = 1.0, most_nodata: float = 10.0, extent: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Checks of a raster (row, col, value) of one band: range, not constant, share of nodata; of its metadata the resolution,
    north-up (``y_step`` below 0 where the column is there) and the extent, which may leave ``extent`` by nothing."""
    v = F.col("value")
    measures = [
        Measure("spread", F.coalesce(F.max(v) - F.min(v), F.lit(0.0)), low=1e-12),
        Measure("nodata_percent", 100.0 - coverage("value"), high=most_nodata, severity="warning"),
    ]
    out = run_checks(pixels, [Check("value_range", outside("value", low, high))], ("row", "col", "value"), measures)
    m = [Check("resolution", F.abs(F.col("res") - res) > tolerance, scope="raster"), Check("north_up", (F.col("y_step") > 0) if "y_step" in meta.columns else F.lit(False), scope="raster")]
    out = out.unionByName(run_checks(meta, m))
    if extent is None:
        return out
    size = pixels.agg(F.max("row").alias("rows"), F.max("col").alias("cols"))
    edges = meta.crossJoin(F.broadcast(size)).select(
        F.col("x_origin").alias("west"), (F.col("y_origin") - (F.col("rows") + 1) * F.col("res")).alias("south"), (F.col("x_origin") + (F.col("cols") + 1) * F.col("res")).alias("east"), F.col("y_origin").alias("north")
    )
    beyond = (F.col("west") < extent[0]) | (F.col("south") < extent[1]) | (F.col("east") > extent[2]) | (F.col("north") > extent[3])
    return out.unionByName(run_checks(edges, [Check("extent", beyond, scope="raster", severity="warning")]))


def grid_report(grid: DataFrame, boundary: DataFrame | None = None, res: float = 30.0, tolerance: float = 1.0, least_inside: float = 90.0) -> DataFrame:
    """Checks of a grid as a whole: unique ids, no repeated place, the spacing of x and y, and with a boundary the percent of
    cells inside it."""
    n = grid.agg((F.count("*") - F.count_distinct("grid_id")).alias("ids"), (F.count("*") - F.count_distinct("x", "y")).alias("places"), F.count("*").alias("cells"))
    steps = grid_spacing(grid, "x").select(F.col("spacing").alias("sx")).crossJoin(F.broadcast(grid_spacing(grid, "y").select(F.col("spacing").alias("sy"))))
    near = lambda c: F.abs(F.col(c) - res) <= tolerance
    rows = [_row("unique_ids", "table", "error", F.col("ids") == 0, F.col("ids"), 0), _row("unique_places", "table", "error", F.col("places") == 0, F.col("places"), 0), _row("spacing_x", "table", "error", near("sx"), F.col("sx"), res), _row("spacing_y", "table", "error", near("sy"), F.col("sy"), res)]
    out = n.crossJoin(F.broadcast(steps))
    if boundary is not None:
        out = out.crossJoin(F.broadcast(inside(grid, boundary, key="grid_id").agg(F.count("*").alias("within"))))
        share = F.try_divide(100.0 * F.col("within"), F.col("cells"))
        rows.append(_row("inside_percent", "table", "error", share >= least_inside, share, least_inside))
    return out.select(F.inline(F.array(*rows)))


def profile(df: DataFrame) -> DataFrame:
    """Type, rows and nulls of each column."""
    kinds = dict(df.dtypes)
    n = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return n.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col("_rows").alias("n_rows"), F.col(c).alias("nulls")) for c in df.columns])))


def unmapped_months(dates: DataFrame, sources: DataFrame) -> DataFrame:
    """Months of the dates that no source covers, with the number of dates."""
    m = lambda d: d.select(F.to_date(F.trunc("date", "MM")).alias("month"), "date").distinct()
    return m(dates).join(m(sources).select("month").distinct(), "month", "left_anti").groupBy("month").agg(F.count("*").alias("n_dates"))
