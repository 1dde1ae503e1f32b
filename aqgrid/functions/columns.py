"""Scalar building blocks: every function takes Columns and gives a Column, so all of it stays in whole-stage codegen.

Missing values are NULL throughout; ``nan_to_null`` stands at the edge where a source may hold NaN.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); null where a value is missing or the sum is zero."""
    return F.try_divide(a - b, a + b)


def ndvi(nir: Column, red: Column) -> Column:
    return normalised_difference(nir, red)


def mndwi(green: Column, swir: Column) -> Column:
    return normalised_difference(green, swir)


def ndbi(swir: Column, nir: Column) -> Column:
    return normalised_difference(swir, nir)


def ibi(built: Column, vegetation: Column, water: Column) -> Column:
    """Built-up index from the three normalised differences; unbounded near a zero denominator."""
    m = (vegetation + water) / 2
    return F.try_divide(built - m, built + m)


def evi(nir: Column, red: Column, blue: Column, scale: float = 1e-4) -> Column:
    """Enhanced vegetation index of reflectances stored as integers."""
    n, r, b = nir * scale, red * scale, blue * scale
    return F.try_divide(2.5 * (n - r), n + 6 * r - 7.5 * b + 1)


def ui(swir2: Column, nir: Column) -> Column:
    """Urban index."""
    return normalised_difference(swir2, nir)


def bsi(swir: Column, red: Column, nir: Column, blue: Column) -> Column:
    """Bare soil index."""
    return normalised_difference(swir + red, nir + blue)


def ebbi(swir: Column, nir: Column, thermal: Column) -> Column:
    """Enhanced built-up and bareness index."""
    return F.try_divide(swir - nir, 10 * F.sqrt(F.when(swir + thermal >= 0, swir + thermal)))


def clear_of_cloud(qa: Column) -> Column:
    """Quality bits 10 (cloud) and 11 (cirrus) are both unset."""
    return (F.getbit(qa, F.lit(10)) == 0) & (F.getbit(qa, F.lit(11)) == 0)


def is_nodata(value: Column, nodata: Column) -> Column:
    """The value is missing, or close to the nodata value by a relative 1e-5."""
    return value.isNull() | F.coalesce(F.abs(value - nodata) <= 1e-5 * F.abs(nodata), F.lit(False))


def scaled(value: Column, scale: Column, offset: Column) -> Column:
    return value * F.coalesce(scale, F.lit(1.0)) + F.coalesce(offset, F.lit(0.0))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(a), F.sqrt(1 - a))


# WGS84 and the UTM scale.
_A, _F, _K0 = 6378137.0, 1 / 298.257223563, 0.9996
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96, _N**2 / 48 + _N**3 / 15, 17 * _N**3 / 480)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3, 7 * _N**2 / 3 - 8 * _N**3 / 5, 56 * _N**3 / 15)


#: What is added to northings of the southern zones.
SOUTH = 10_000_000.0


def to_utm(lon: Column, lat: Column, zone: int = 43, south: bool = False) -> tuple[Column, Column]:
    """Easting and northing of a northern or southern zone by the Krueger series of third order."""
    e = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    d = F.radians(lon - (zone * 6 - 183))
    xi, eta = F.atan2(t, F.cos(d)), F.atanh(F.sin(d) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return 500000.0 + _K0 * _RADIUS * east, (SOUTH if south else 0.0) + _K0 * _RADIUS * north


def from_utm(x: Column, y: Column, zone: int = 43, south: bool = False) -> tuple[Column, Column]:
    """Longitude and latitude of a UTM point."""
    xi, eta = (y - (SOUTH if south else 0.0)) / (_K0 * _RADIUS), (x - 500000.0) / (_K0 * _RADIUS)
    a, b = xi, eta
    for j, w in enumerate(_BETA, 1):
        a = a - w * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        b = b - w * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(a) / F.cosh(b))
    lat = chi
    for j, w in enumerate(_DELTA, 1):
        lat = lat + w * F.sin(2 * j * chi)
    return (zone * 6 - 183) + F.degrees(F.atan2(F.sinh(b), F.cos(a))), F.degrees(lat)


def in_bbox(x: Column, y: Column, bbox: tuple[float, float, float, float]) -> Column:
    return (x >= bbox[0]) & (x <= bbox[2]) & (y >= bbox[1]) & (y <= bbox[3])


def bbox_centre(bbox: tuple[float, float, float, float]) -> tuple[float, float]:
    return (bbox[0] + bbox[2]) / 2, (bbox[1] + bbox[3]) / 2


def accepted_pm25(parameter_id: Column, name: Column, value: Column) -> Column:
    """Null parameter id or 2; null, empty or PM2.5 name; a number of at least 0."""
    named = F.coalesce(name, F.lit("")) == ""
    return (parameter_id.isNull() | (parameter_id == 2)) & (named | F.lower(name).isin("pm25", "pm2.5")) & F.coalesce(value >= 0, F.lit(False))


# Weights of road surfaces and classes, and the surfaces that count as dusty.
ROAD_WEIGHTS = {
    "unpaved": 1.0,
    "dirt": 0.95,
    "gravel": 0.9,
    "sand": 0.9,
    "compacteddirt": 0.95,
    "ground": 0.8,
    "clay": 0.8,
    "pebblestone": 0.7,
    "rubble": 0.6,
    "track": 0.7,
    "residential": 0.35,
    "service": 0.35,
    "unclassified": 0.3,
    "paved": 0.05,
    "asphalt": 0.05,
    "concrete": 0.05,
}
DUSTY_SURFACES = ("unpaved", "dirt", "gravel", "sand", "compacteddirt", "ground", "clay", "pebblestone", "rubble")


def road_weight(surface: Column, highway: Column) -> Column:
    """By surface, else by class, else 0.6 for other tracks and 0.1 for the rest."""
    table = F.create_map(*[F.lit(x) for kv in ROAD_WEIGHTS.items() for x in kv])
    s, h = (F.lower(F.coalesce(c, F.lit(""))) for c in (surface, highway))
    return F.coalesce(F.try_element_at(table, s), F.try_element_at(table, h), F.when(h.startswith("track"), 0.6).otherwise(0.1))


def is_dusty(surface: Column) -> Column:
    return F.coalesce(F.lower(surface).isin(*DUSTY_SURFACES), F.lit(False))


def building_height(height: Column, levels: Column, default: float = 6.0, per_level: float = 3.0) -> Column:
    """First part of the height tag, else levels times the storey height, else the default; text that is no number is missing."""
    number = lambda c: nan_to_null(F.trim(c).try_cast("double"))
    return F.coalesce(number(F.split(height, ";")[0]), number(levels) * per_level, F.lit(default))


def industrial_classes(tags: Column) -> dict[str, Column]:
    """Boolean columns from a map of tags."""
    t = lambda k: F.lower(F.coalesce(F.try_element_at(tags, F.lit(k)), F.lit("")))
    return {
        "is_industrial": t("landuse") == "industrial",
        "is_landfill": t("landuse") == "landfill",
        "is_quarry": t("landuse") == "quarry",
        "is_industrial_building": t("building").isin("industrial", "factory", "works"),
        "is_plant": t("power") == "plant",
        "is_chimney": (t("man_made") == "chimney") | (t("chimney") == "yes"),
        "is_poi": (t("industrial") == "yes") | (t("site") == "industrial"),
    }


def dust_indices(total: Column, unpaved: Column, weighted: Column, area: Column, cell: float = 30.0) -> dict[str, Column]:
    road = F.least(F.lit(100.0), 100 * weighted / (cell * cell * math.sqrt(2)))
    built = F.least(F.lit(100.0), 100 * area / (cell * cell))
    return {
        "pct_unpaved": F.when(total > 0, 100 * unpaved / total).otherwise(0.0),
        "road_dust_index": road,
        "construction_dust_index": built,
        "dust_index_combined": 0.6 * road + 0.4 * built,
    }


def industrial_raw(volume: Column, area: Column, plants: Column, chimneys: Column, landfill: Column, quarry: Column, poi: Column) -> Column:
    return volume / 1000 + 0.8 * area / 1000 + 50 * plants + 20 * chimneys + 0.2 * landfill / 1000 + 0.2 * quarry / 1000 + 5 * poi


def confidence(plants: Column, chimneys: Column, building_area: Column, area: Column, poi: Column) -> Column:
    """high with a plant, a chimney or a building, medium with industrial land or a point of interest, else low."""
    return F.when((plants > 0) | (chimneys > 0) | (building_area > 0), "high").when((area > 0) | (poi > 0), "medium").otherwise("low")


# The names of the classes and their upper bounds, in the next function.
def morphology(svf: Column) -> Column:
    """Right-closed classes of the sky-view factor; values outside (0, 1] have none."""
    return F.when((svf > 0) & (svf <= 0.4), "deep_canyon").when((svf > 0.4) & (svf <= 0.6), "street_canyon").when((svf > 0.6) & (svf <= 0.8), "urban_open").when((svf > 0.8) & (svf <= 1), "suburban")


def is_canyon(svf: Column) -> Column:
    return svf < 0.5


def month_index(d: Column) -> Column:
    return 12 * F.year(d) + F.month(d)


def gaussian_kernel(d2: Column, hs: float, dt: Column | None = None, ht: float | None = None) -> Column:
    """Space-time weight, at least 1e-12; the time factor only where both times and a bandwidth are there."""
    w = F.exp(-d2 / (hs * hs))
    if dt is not None and ht is not None and not math.isnan(ht):
        w = w * F.when(dt.isNotNull(), F.exp(-dt * dt / (ht * ht))).otherwise(1.0)
    return F.greatest(w, F.lit(1e-12))
