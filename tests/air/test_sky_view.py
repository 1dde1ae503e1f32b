import math
import random

import pytest

from aqgrid.operators import raster
from aqgrid.plans import air, registry

SF = "/root/testdata/sf0.001"


def plain(z, r, c, steps, res, directions):
    total = 0.0
    for d in range(directions):
        a, best = 2 * math.pi * d / directions, 0.0
        for s in range(1, steps + 1):
            y, x = round(r - s * math.cos(a), 9), round(c + s * math.sin(a), 9)
            i, j = math.floor(y), math.floor(x)
            parts = [((i + p, j + q), (y - i if p else 1 - y + i) * (x - j if q else 1 - x + j)) for p in (0, 1) for q in (0, 1)]
            parts = [(k, w) for k, w in parts if w > 1e-8]
            if all(k in z for k, _ in parts):
                best = max(best, math.atan((sum(w * z[k] for k, w in parts) - z[r, c]) / (s * res)))
        total += math.sin(best) ** 2
    return total / directions


def test_sixteen_directions_match_a_double_loop(spark):
    r = random.Random(2)
    z = {(i, j): r.uniform(0, 20) for i in range(12) for j in range(14) if (i, j) != (5, 6)}
    d = spark.createDataFrame([(i, j, v) for (i, j), v in z.items()], "row long, col long, value double")
    got = {(x.row, x.col): x.svf for x in raster.horizon_svf(d, res=3.0, radius=12.0, directions=16, block=8).collect()}
    assert got.keys() == z.keys()
    assert all(abs(v - 1 + plain(z, *k, 4, 3.0, 16)) < 1e-6 for k, v in got.items())


def test_the_fine_sky_view_matches_a_double_loop(spark):
    z = {(x.row, x.col): x.value for x in air._dsm(spark, SF).collect() if x.value is not None}
    got = {(x.row, x.col): x.svf for x in registry.queries()["g12_sky_view_fine"](spark, SF).collect()}
    assert got.keys() == z.keys()
    assert all(got[k] == pytest.approx(1 - plain(z, *k, 33, 3.0, 16), abs=2e-6) for k in sorted(z)[::7])
