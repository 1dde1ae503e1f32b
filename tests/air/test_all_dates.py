"""The date queries over every order date and every order, against plain loops."""

import bisect
import datetime

import pytest

from aqgrid.plans import air, registry

SF = "/root/testdata/sf0.001"
MONTH = datetime.timedelta(30)


@pytest.fixture(scope="module")
def orders(spark):
    rows = spark.read.parquet(f"{SF}/orders.parquet").selectExpr("o_custkey DIV 10 AS cell", "CAST(o_orderdate AS DATE) AS date", "o_totalprice AS value").collect()
    clouds = {}
    for r in rows:
        clouds.setdefault(r.date, []).append(int(r.value // 1) % 100)
    seen = {}
    for r in rows:
        if sum(clouds[r.date]) / len(clouds[r.date]) < 50:
            seen[r.cell, r.date] = max(r.value, seen.get((r.cell, r.date), r.value))
    return sorted(clouds), seen


def neighbours(dates, seen):
    have = sorted({d for _, d in seen})
    out = {}
    for d in dates:
        a, b = bisect.bisect_left(have, d) - 1, bisect.bisect_right(have, d)
        out[d] = (have[a] if a >= 0 and d - have[a] <= MONTH else None, have[b] if b < len(have) and have[b] - d <= MONTH else None)
    return out


def between(dates, seen):
    at = {}
    for (c, d), v in seen.items():
        at.setdefault(d, {})[c] = v
    out = {}
    for d, (a, b) in neighbours(dates, seen).items():
        for c, v in at.get(a if a else b, {}).items():
            if a and b:
                w = (d - a).days / (b - a).days
                v = v * (1 - w) + at[b][c] * w if c in at[b] else None
            out[c, d] = v
    return out


def near(a, b):
    assert a.keys() == b.keys()
    assert all((a[k] is None) == (b[k] is None) and (a[k] is None or abs(a[k] - b[k]) < 1e-4) for k in a)


def test_every_order_date_has_its_neighbours(spark, orders):
    got = {r.date: (r.prev, r.next) for r in registry.queries()["j5_neighbour_dates"](spark, SF).collect()}
    assert got == neighbours(*orders)
    assert len(got) == len(orders[0]) and 0.3 < len({d for _, d in orders[1]}) / len(got) < 0.7


def test_every_order_date_is_interpolated_and_chosen(spark, orders):
    dates, seen = orders
    want = between(dates, seen)
    got = registry.queries()["w5_interpolate"](spark, SF).collect()
    near({(r.cell, r.date): r.value for r in got}, want)
    assert all(r.is_nodata == (r.value is None) for r in got)
    got = registry.queries()["m10_choose_source"](spark, SF).collect()
    every = {(c, d) for c in {c for c, _ in seen} for d in dates}
    near({(r.cell, r.date): r.value for r in got}, {k: seen.get(k, want.get(k)) for k in every})
    assert all(r.method == ("observed" if (r.cell, r.date) in seen else "interpolated" if want.get((r.cell, r.date)) is not None else "blank") for r in got)


def test_the_signal_and_the_features_cover_every_order_date(spark, orders, monkeypatch):
    dates, seen = orders
    every = {(c, d) for c in {c for c, _ in seen} for d in dates}
    near({(r.grid_id, r.date): r.no2 for r in registry.queries()["s11_attach_signal"](spark, SF).collect()}, {k: seen.get(k) for k in every})
    want = between(dates, seen)
    near({(r.grid_id, r.date): r.s5p_no2 for r in registry.queries()["r1_feature_table"](spark, SF).collect()}, {k: want.get(k) for k in every})
    monkeypatch.setattr(air.quality, "run_checks", lambda df, *a, **b: df)
    assert registry.queries()["q3_features"](spark, SF).count() == len(every)
