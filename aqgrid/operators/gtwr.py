"""Geographically and temporally weighted regression.

Each query point solves its own weighted least squares over all training points. No pair of them is a row.

Where no weight can fall to the least one, as queries and training points all lie within some five bandwidths, a weight is a
product of smooth functions of x, y and time. Each axis is cut into boxes of a bandwidth at most, with as many Chebyshev nodes as
carry the weights to twelve digits. One pass over the training points adds each of them to the nodes of its box, the weights
between nodes are one matrix an axis, and one pass over the queries reads their sums off the nodes. What all tasks share are the
sums of the nodes, as many as the bandwidths ask for, whatever the number of rows.

Else parts of the queries meet blocks of the training points, both packed by a hash of their id, and each meeting adds weights
times products to the normal equations by one matrix product for all bandwidths at once. Only p x p sums travel on. A group holds
one part and one block, so ``parts`` and ``blocks`` bound the memory of a task; the work is queries times training points.
``cutoff`` restricts a query to training points within a distance by way of buckets, which is approximate, as every point has
a weight of 1e-12 or more.

Training rows without a target or with a missing feature are left out; missing coordinates give the least weight.

The sums are taken of what a plain regression over all training rows leaves of the target, so that a target far from 0 costs no
digits of the residuals; the coefficients and predictions are those of the target itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from numpy.polynomial.chebyshev import chebvander
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqgrid.functions.columns import gaussian_kernel
from aqgrid.operators import order

#: Pairs whose weights a task holds at once.
TILE = 1 << 21
#: The least weight, the sums that the nodes of all boxes may hold, and rows that a task spreads over them at once.
LEAST, NODE_SUMS, ROWS = 1e-12, 1 << 22, 1024
Grid = list[tuple[float, float | None]]


def _sized(d: DataFrame, p: int) -> DataFrame:
    return d.withColumn("x", F.when(F.assert_true(F.size("x") == p, "x has another length").isNull(), F.col("x")))


def _training(train: DataFrame, p: int) -> DataFrame:
    t = _sized(train.select("id", "x", "y", "cx", "cy", "t"), p)
    return t.where(F.col("y").isNotNull() & ~F.exists("x", lambda v: v.isNull()))


def _names(p: int) -> list[str]:
    return [f"a{i}_{j}" for i in range(p) for j in range(i, p)] + [f"b{i}" for i in range(p)] + ["yy", "w"]


def _products(ts: pd.DataFrame, p: int) -> np.ndarray:
    """What each training row adds to the sums of ``_names``, but for its weight."""
    x, y = np.array(ts["x"].tolist(), float).reshape(len(ts), p), ts["y"].to_numpy(float)
    return np.stack([*(x[:, i] * x[:, j] for i in range(p) for j in range(i, p)), *(x[:, i] * y for i in range(p)), y * y, np.ones(len(y))], axis=1)


class _Axis(NamedTuple):
    """``n`` boxes from ``low`` on with ``nodes`` each, and a last place for rows without a value, whose weight along the axis is 1."""

    low: float
    width: float
    n: int
    nodes: int
    h: float

    @property
    def size(self) -> int:
        return self.n * self.nodes + 1

    def span(self, box: int) -> slice:
        return slice(box * self.nodes, (box + 1) * self.nodes if box < self.n else self.size)

    def place(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The box of each value and its shares of the box's nodes; ``n`` and no matter which shares where there is no value."""
        at = (np.where(np.isnan(v), self.low, v) - self.low) / (self.width or 1.0)
        box = np.clip(np.floor(at), 0, self.n - 1).astype(int)
        shares = _shares(2 * (at - box) - 1 if self.width else 0 * at, self.nodes)
        return np.where(np.isnan(v), self.n, box), shares

    def weights(self) -> np.ndarray:
        """Between any two nodes."""
        c = (self.low + self.width * (np.arange(self.n)[:, None] + 0.5 + _nodes(self.nodes) / 2)).ravel()
        w = np.ones((self.size, self.size))
        w[:-1, :-1] = np.exp(-(((c[:, None] - c) / self.h) ** 2))
        return w


def _nodes(n: int) -> np.ndarray:
    return np.cos(np.pi * (np.arange(n) + 0.5) / n)


def _shares(u: np.ndarray, n: int) -> np.ndarray:
    """Of values from -1 to 1: with what factors those at the nodes make up the one there."""
    back = chebvander(_nodes(n), n - 1).T * (2 / n)
    back[0] /= 2
    return chebvander(u, n - 1) @ back


def _axis(low: float, high: float, h: float) -> _Axis:
    """Boxes of a bandwidth at most, with the fewest nodes that give every weight to twelve digits."""
    n = max(1, math.ceil((high - low) / h))
    width, u, off = (high - low) / n, np.linspace(-1, 1, 101), np.linspace(-1, 1, 101)[:, None] * (high - low)
    weight = lambda v: np.exp(-(((off - v * width / 2) / h) ** 2))
    for nodes in range(1, 48):
        if np.abs(weight(_nodes(nodes)) @ _shares(u, nodes).T / weight(u) - 1).max() < 1e-12:
            break
    return _Axis(low, width, n, nodes, h)


def _axes(train: DataFrame, query: DataFrame, p: int, hs: float, ht: float | None) -> list[_Axis] | None:
    """The axes that hold all coordinates; none where the least weight may count, or nodes would hold too much."""
    names = ("cx", "cy", "t")
    ends = [F.struct(F.min(c), F.max(c)).alias(c) for c in names]
    both = train.select(*names).unionByName(query.select(*names)).agg(*ends).first()
    low, high = zip(*[both[c] if both[c][0] is not None else (0.0, 0.0) for c in names], strict=True)
    if ht is None or math.isnan(ht):
        low, high, ht = (*low[:2], 0.0), (*high[:2], 0.0), math.inf
    if not (hs > 0 and ht > 0 and sum(((b - a) / h) ** 2 for a, b, h in zip(low, high, (hs, hs, ht), strict=True)) < -math.log(LEAST) - 0.01):
        return None
    axes = [_axis(a, b, h) for a, b, h in zip(low, high, (hs, hs, ht), strict=True)]
    return axes if math.prod(a.size for a in axes) * len(_names(p)) <= NODE_SUMS else None


def _by_box(d: pd.DataFrame, axes: list[_Axis]) -> Iterator[tuple[np.ndarray, tuple[slice, ...], list[np.ndarray]]]:
    """Row numbers, the nodes of their box on each axis, and their shares of these. Rows without a place are left out."""
    v = [d[c].to_numpy(float) for c in ("cx", "cy", "t")]
    if math.isinf(axes[2].h):
        v[2] = np.full(len(d), np.nan)
    placed = [a.place(x) for a, x in zip(axes, v, strict=True)]
    key = (placed[0][0] * (axes[1].n + 1) + placed[1][0]) * (axes[2].n + 1) + placed[2][0]
    rows = np.flatnonzero((placed[0][0] < axes[0].n) & (placed[1][0] < axes[1].n))
    rows = rows[np.argsort(key[rows], kind="stable")]
    for group in np.split(rows, np.flatnonzero(np.diff(key[rows])) + 1) if len(rows) else ():
        boxes = [int(b[group[0]]) for b, _ in placed]
        for at in range(0, len(group), ROWS):
            r = group[at : at + ROWS]
            yield r, tuple(a.span(b) for a, b in zip(axes, boxes, strict=True)), [s[r] if b < a.n else np.ones((len(r), 1)) for a, b, (_, s) in zip(axes, boxes, placed, strict=True)]


def _node_sums(train: DataFrame, p: int, axes: list[_Axis], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of ``_names`` that weights reach at each node, and those of the training points without a place."""
    names, shape = _names(p), tuple(a.size for a in axes)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, lost = np.zeros((*shape, len(names))), np.zeros(len(names))
        for d in batches:
            z = _products(d, p)
            lost += z[d["cx"].isna() | d["cy"].isna()].sum(0)
            for r, (i, j, k), (sx, sy, st) in _by_box(d, axes):
                left, right = (z[r][:, :, None] * sx[:, None, :]).reshape(len(r), -1), (sy[:, :, None] * st[:, None, :]).reshape(len(r), -1)
                sums[i, j, k] += np.moveaxis((left.T @ right).reshape(-1, sx.shape[1], sy.shape[1], st.shape[1]), 0, 3)
        flat = sums.reshape(-1, len(names))
        some = np.flatnonzero(flat.any(1))
        yield pd.DataFrame(flat[some], columns=names).assign(node=some)
        yield pd.DataFrame(lost[None], columns=names).assign(node=-1)

    schema = ", ".join(f"{n} double" for n in names) + ", node long"
    dealt = train.repartition(parts, "id").select("x", "y", "cx", "cy", "t")
    found = dealt.mapInPandas(add, schema).groupBy("node").agg(*[F.sum(n).alias(n) for n in names]).toArrow().to_pandas()
    sums, lost = np.zeros((*shape, len(names))), np.zeros(len(names))
    at, values = found["node"].to_numpy(), found[names].to_numpy()
    sums.reshape(-1, len(names))[at[at >= 0]] = values[at >= 0]
    return sums, values[at < 0].sum(0)


def _by_nodes(train: DataFrame, query: DataFrame, p: int, axes: list[_Axis], base: np.ndarray, n: int) -> DataFrame:
    """Rows (id, prediction, uncertainty), as from ``_block_sums`` and ``_solved``."""
    spark = train.sparkSession
    sums, lost = _node_sums(train, p, axes, min(-(-n // 16_384), 4 * spark.sparkContext.defaultParallelism))
    every = sums.sum((0, 1, 2)) + lost
    for k, a in enumerate(axes):
        sums = np.moveaxis(np.tensordot(a.weights(), sums, (1, k)), 0, k)
    held = spark.sparkContext.broadcast(np.ascontiguousarray(sums))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field = held.value
        for d in batches:
            s = np.tile(LEAST * every, (len(d), 1))
            for r, (i, j, k), (sx, sy, st) in _by_box(d, axes):
                box = sx @ field[i, j, k].reshape(sx.shape[1], -1)
                box = sy[:, None, :] @ box.reshape(len(r), sy.shape[1], -1)
                s[r] = (st[:, None, :] @ box.reshape(len(r), st.shape[1], -1))[:, 0] + LEAST * lost
            yield _regressed(d[["id", "x"]].assign(**dict(zip(_names(p), s.T, strict=True))), p, base)

    return order.spread(query, "id").mapInPandas(read, "id long, prediction double, uncertainty double")


def _block_sums(train: DataFrame, query: DataFrame, p: int, grid: Grid, parts: int, blocks: int, leave_self_out: bool) -> DataFrame:
    """Rows (id, g, the sums of ``_names``) for each query, bandwidth and block."""
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = query.select("id", "cx", "cy", "t").withColumn("part", deal(parts)).withColumn("block", every(blocks))
    t = train.withColumn("block", deal(blocks)).withColumn("part", every(parts))
    names = _names(p)

    def add(qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(ts):
            return pd.DataFrame(columns=["id", "g", *names])
        z = _products(ts, p)
        number = lambda d, c: d[c].to_numpy(float)
        out = []
        for at in range(0, len(qs), max(1, TILE // len(ts))):
            part = qs.iloc[at : at + max(1, TILE // len(ts))]
            d2 = (number(part, "cx")[:, None] - number(ts, "cx")) ** 2 + (number(part, "cy")[:, None] - number(ts, "cy")) ** 2
            dt2 = (number(part, "t")[:, None] - number(ts, "t")) ** 2
            same = part["id"].to_numpy()[:, None] == ts["id"].to_numpy() if leave_self_out else None
            for g, (hs, ht) in enumerate(grid):
                w = np.exp(-d2 / (hs * hs))
                if ht is not None and not np.isnan(ht):
                    w *= np.where(np.isnan(dt2), 1.0, np.exp(-dt2 / (ht * ht)))
                w = np.fmax(w, LEAST)
                if same is not None:
                    w[same] = 0
                out.append(pd.DataFrame(w @ z, columns=names).assign(id=part["id"].to_numpy(), g=g))
        return pd.concat(out)[["id", "g", *names]]

    schema = "id long, g int, " + ", ".join(f"{n} double" for n in names)
    return q.groupBy("part", "block").cogroup(t.groupBy("part", "block")).applyInPandas(add, schema)


def _near_sums(train: DataFrame, query: DataFrame, p: int, hs: float, ht: float | None, cutoff: float, leave_self_out: bool) -> DataFrame:
    """The same sums over the training points within a distance; queries look into the 3 x 3 buckets around their own."""
    t = train.select(*[F.col(c).alias(f"t{c}") for c in ("id", "x", "y", "cx", "cy", "t")])
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    bucket = lambda c: F.floor(F.col(c) / cutoff)
    q = query.select("id", "cx", "cy", "t").withColumn("o", F.explode(around)).withColumn("bx", bucket("cx") + F.col("o.i")).withColumn("by", bucket("cy") + F.col("o.j")).drop("o")
    d2 = F.pow(F.col("cx") - F.col("tcx"), 2) + F.pow(F.col("cy") - F.col("tcy"), 2)
    pairs = q.join(t.withColumn("bx", bucket("tcx")).withColumn("by", bucket("tcy")), ["bx", "by"]).where(d2 <= cutoff * cutoff)
    if leave_self_out:
        pairs = pairs.where("id <> tid")
    pairs = pairs.withColumn("w", gaussian_kernel(d2, hs, F.col("t") - F.col("tt"), ht))
    x, w, y = [F.col("tx")[k] for k in range(p)], F.col("w"), F.col("ty")
    terms: list[Column] = [w * x[i] * x[j] for i in range(p) for j in range(i, p)] + [w * x[i] * y for i in range(p)] + [w * y * y, w]
    return pairs.groupBy("id").agg(F.lit(0).alias("g"), *[F.sum(c).alias(n) for c, n in zip(terms, _names(p), strict=True)])


def _shifted(train: DataFrame, p: int) -> tuple[DataFrame, np.ndarray, int]:
    """Training rows with the residuals of one regression over all of them as y, its coefficients, and the number of rows."""
    x, y = [F.col("x")[k] for k in range(p)], F.col("y")
    sums = train.agg(F.count("*").alias("n"), *[F.sum(x[i] * x[j]).alias(f"a{i}_{j}") for i in range(p) for j in range(i, p)], *[F.sum(x[i] * y).alias(f"b{i}") for i in range(p)]).first()
    if not sums["n"]:
        return train, np.zeros(p), 0
    a = np.array([[sums[f"a{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)], float)
    base = np.linalg.pinv(a) @ np.array([sums[f"b{i}"] for i in range(p)], float)
    fit = sum((F.lit(float(v)) * c for v, c in zip(base, x, strict=True)), F.lit(0.0))
    return train.withColumn("y", y - fit), base, sums["n"]


def _dealt(n_query: int, n_train: int, parts: int | None, blocks: int | None) -> tuple[int, int]:
    """Parts of about 8,192 queries and blocks of about 32,768 training points, where the caller names none."""
    return parts or max(16, -(-n_query // 8192)), blocks or max(4, -(-n_train // 32768))


def _regressed(d: pd.DataFrame, p: int, base: np.ndarray) -> pd.DataFrame:
    """(id, prediction, uncertainty) of rows with the sums of ``_names`` and x."""
    a, b = np.zeros((len(d), p, p)), np.zeros((len(d), p))
    for i in range(p):
        b[:, i] = d[f"b{i}"]
        for j in range(i, p):
            a[:, i, j] = a[:, j, i] = d[f"a{i}_{j}"]
    beta = np.einsum("nij,nj->ni", np.linalg.pinv(a), b + a @ base)
    xq = np.array(d["x"].tolist(), float).reshape(len(d), p)
    off = beta - base
    rss = d["yy"].to_numpy() - 2 * (off * b).sum(1) + np.einsum("ni,nij,nj->n", off, a, off)
    return pd.DataFrame({"id": d["id"], "prediction": (xq * beta).sum(1), "uncertainty": np.sqrt(np.maximum(rss / (d["w"].to_numpy() + 1e-12), 0))})


def _solved(sums: DataFrame, query: DataFrame, p: int, base: np.ndarray) -> DataFrame:
    """Rows (id, g, prediction, uncertainty) from the sums over all blocks; ``base`` was taken off the target."""

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            yield _regressed(d, p, base).assign(g=d["g"])[["id", "g", "prediction", "uncertainty"]]

    total = sums.groupBy("id", "g").agg(*[F.sum(n).alias(n) for n in _names(p)])
    return total.join(query.select("id", "x"), "id").mapInPandas(solve, "id long, g int, prediction double, uncertainty double")


def predict(
    train: DataFrame, query: DataFrame, p: int, *, hs: float, ht: float | None = None, cutoff: float | None = None, leave_self_out: bool = False, parts: int | None = None, blocks: int | None = None
) -> DataFrame:
    """Rows (id, prediction, uncertainty) for query rows (id, x, cx, cy, t) from training rows (id, x, y, cx, cy, t).

    ``x`` is an array of p numbers; no intercept is added; query ids are unique. Uncertainty is the weighted residual
    deviation. ``parts`` and ``blocks`` follow from the numbers of rows unless they are given; where one is, all pairs are
    worked out.
    """
    q, (t, base, n) = _sized(query.select("id", "x", "cx", "cy", "t"), p), _shifted(_training(train, p), p)
    if cutoff is None and not leave_self_out and parts is None and blocks is None and n and (axes := _axes(t, q, p, hs, ht)):
        return _by_nodes(t, q, p, axes, base, n)
    if cutoff is None:
        parts, blocks = _dealt(query.count(), n, parts, blocks)
    sums = _block_sums(t, q, p, [(hs, ht)], parts, blocks, leave_self_out) if cutoff is None else _near_sums(t, q, p, hs, ht, cutoff, leave_self_out)
    return _solved(sums, q, p, base).drop("g")


def bandwidth_scores(train: DataFrame, p: int, grid: Grid, *, parts: int | None = None, blocks: int | None = None) -> DataFrame:
    """Leave-one-out root mean squared error of each (hs, ht); all bandwidths share the distances of one pass."""
    full = _training(train, p)
    t, base, n = _shifted(full, p)
    parts, blocks = _dealt(n, n, parts, blocks)
    one = _solved(_block_sums(t, t, p, grid, parts, blocks, True), t, p, base).join(full.select("id", "y"), "id")
    score = one.groupBy("g").agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).alias("rmse"))
    pick = lambda k: F.element_at(F.array(*[F.lit(v[k]).cast("double") for v in grid]), F.col("g") + 1)
    return score.select(pick(0).alias("hs"), pick(1).alias("ht"), "rmse")


def best_bandwidth(scores: DataFrame) -> DataFrame:
    return scores.orderBy("rmse", "hs", "ht").limit(1)


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values become the mean, then each column gets mean 0 and population deviation 1 (0 where it is constant)."""
    sums = df.agg(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns])
    scaled = {c: F.coalesce(F.try_divide(F.col(c) - F.col(f"{c}_m"), F.nullif(F.col(f"{c}_s"), F.lit(0.0))), F.lit(0.0)) for c in columns}
    return df.crossJoin(F.broadcast(sums)).withColumns(scaled).select(*df.columns)
