"""Exact quantiles of whole columns by distributed selection, without a buffer of all values.

Spark's ``percentile`` keeps every distinct value in one task. Here each pass is one grouped count: the interval of values that
holds a wanted rank is cut into ``BINS``, each with its rows, least and greatest value; the bin with the rank is the next
interval, until all of its values are equal. An interval shrinks by a factor of about ``BINS`` a pass, so that 10^12 values take
four or five. Passes cut evenly by value and by its logarithm in turn, so that far outliers cost one pass.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StructField, StructType

from aqgrid.sources.scratch import discard, written

BINS = 1024


def _log(v: float, one_sign: bool) -> float:
    return math.copysign(1, v) * (math.log(abs(v)) if one_sign else math.log1p(abs(v)))


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows (``by``..., q): the quantiles of the column's values in each group, interpolated between neighbours as ``percentile``
    does. Nulls don't count; a group without values has no row. The result, a row a group, passes through the driver, as do the
    counts of the bins."""
    spark, by = df.sparkSession, list(by)
    d = written(df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v")), "quantiles")
    keys = [f for f in d.schema.fields if f.name in by]
    start = {tuple(r[k] for k in by): r for r in d.groupBy(*by).agg(F.count("*").alias("n"), F.min("_v").alias("a"), F.max("_v").alias("b")).collect() if r["n"]}
    places = {g: [s * (r["n"] - 1) for s in shares] for g, r in start.items()}
    #: group and rank: the interval that holds it, and the rows below the interval
    open_ = {(g, k): (r["a"], r["b"], 0) for g, r in start.items() for at in places[g] for k in (math.floor(at), math.ceil(at))}
    found: dict[tuple, float] = {}
    linear = True
    while open_:
        for x, (low, high, _) in list(open_.items()):
            if low == high:
                found[x] = open_.pop(x) and low
        if not open_:
            break
        intervals = sorted({(*g, low, high) for (g, _), (low, high, _) in open_.items()}, key=str)
        # by logarithm only where it tells the ends apart; where all values are of one sign also far below 1
        rows = [(*x, linear or _log(x[-2], x[-2] * x[-1] > 0) == _log(x[-1], x[-2] * x[-1] > 0)) for x in intervals]
        kind = StructType([*keys, StructField("_low", DoubleType()), StructField("_high", DoubleType()), StructField("_linear", BooleanType())])
        ends = spark.createDataFrame(rows, kind)
        meet = (d["_v"] >= ends["_low"]) & (d["_v"] <= ends["_high"])
        for k in by:
            meet = meet & d[k].eqNullSafe(ends[k])
        near = d
        if len(intervals) <= 64:  # after the first pass few rows lie in any interval: a plain filter first
            inside = F.lit(False)
            for x in intervals:
                inside = inside | d["_v"].between(x[-2], x[-1])
            near = d.where(inside)
        hit = near.join(F.broadcast(ends), meet).select(*(d[k] for k in by), "_v", "_low", "_high", "_linear")
        log = lambda c: F.signum(c) * F.when(F.col("_low") * F.col("_high") > 0, F.log(F.abs(c))).otherwise(F.log1p(F.abs(c)))
        pick = lambda c: F.when(F.col("_linear"), F.col(c) / 2).otherwise(log(c))  # noqa: E731  (halves, as ends may lie as far apart as doubles go)
        share = (pick("_v") - pick("_low")) / (pick("_high") - pick("_low"))
        hit = hit.withColumn("_bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
        bins = defaultdict(list)
        for r in hit.groupBy(*by, "_low", "_high", "_bin").agg(F.count("*").alias("n"), F.min("_v").alias("a"), F.max("_v").alias("b")).collect():
            bins[(*(r[k] for k in by), r["_low"], r["_high"])].append((r["_bin"], r["n"], r["a"], r["b"]))
        for (g, k), (low, high, below) in open_.items():
            for _, n, a, b in sorted(bins[(*g, low, high)]):
                if k < below + n:
                    open_[g, k] = (a, b, below)
                    break
                below += n
        linear = not linear
    discard(d)

    def value(g: tuple, at: float) -> float:
        low, high, part = found[g, math.floor(at)], found[g, math.ceil(at)], at - math.floor(at)
        return low if part == 0 or low == high else (1 - part) * low + part * high

    out = StructType([*keys, StructField("q", ArrayType(DoubleType()))])
    return spark.createDataFrame([(*g, [value(g, at) for at in ats]) for g, ats in places.items()], out)
