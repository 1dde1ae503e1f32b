"""Prefix trie of conversations with totals over every subtree, by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns; its members are the conversations that begin with it. Texts stay where they are
read: a turn travels as 128 bits of the SHA-256 of its role and text, and a running digest down each conversation, streamed in
sorted order, names the nodes (equal digests count as equal). A node is known by its smallest member and its depth, as is its
parent; these parent edges form the forest that ``rollup`` sums over.

The rollup splits every component at its centroid, the deepest node under which at least half of the component lies. The
total below the centroid, within the component, is what the centroid still lacks and is added to all nodes on the path from
it to the component's top; then the centroid's children become tops of components of their own, and the rest stays with the
old top. Each component so loses half of its nodes a round, however deep or wide the trie. Rounds over large components are
joins and grouped sums of narrow rows, written to the shared folder; components of at most ``LOCAL`` nodes are taken to their
end by one task, many at a time, by the same steps on arrays.

Nulls: a null role or text counts as empty; a null turn comes first; rows without a conversation id belong to no member and are
left out. Rows with equal turns are ordered by their digests, and repeated rows are turns of their own. Empty tables give no
rows, extra columns are dropped, whatever their names. The ids of a node's ends are hashed as a stream, in bounded memory.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aqgrid.llm.common import discard, written

#: Nodes of a component that one task takes to the end.
LOCAL = 4096
#: Nodes that a task gathers before it works on them.
GATHER = 1 << 15
ROOT = (0, 0)


def places(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Each turn by its place in the conversation, from 1: conv_id, place, d1 and d2 (its digest), chars (code points)."""
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    sha = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring(sha, at, 16), 16, -10).cast("long")
    d = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), half(1).alias("d1"), half(17).alias("d2"), F.length(text).cast("long").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "d1", "d2")
    return d.select("conv_id", F.row_number().over(order).cast("long").alias("place"), "d1", "d2", "chars")


def rebuild(turns: DataFrame) -> DataFrame:
    """Conversations of ``places`` rebuilt: conversation c takes the first h turns of conversation c - c % 100, then its own
    after its first h, h being the CRC-32 of c modulo 6. One more row a conversation, at place 0 and without a digest.

    The narrow rows are written first, as they are read for three ends."""
    turns = written(turns, "trie-places")
    heads = (F.crc32(F.col("conv_id").cast("string")) % 6).alias("h")
    own = turns.where(F.col("place") > heads)
    every = turns.where("place = 1").select("conv_id", heads, (F.col("conv_id") - F.col("conv_id") % 100).alias("base"))
    taken = turns.where("place <= 5 AND conv_id % 100 = 0").withColumnRenamed("conv_id", "base")
    taken = every.join(taken, "base").where("place <= h").select("conv_id", "place", "d1", "d2", "chars")
    mark = every.select("conv_id", F.lit(0).cast("long").alias("place"), *(F.lit(None).cast("long").alias(c) for c in ("d1", "d2", "chars")))
    return own.unionByName(taken).unionByName(mark)


def _together(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt so that those of equal keys share a task.

    Dealt by a hash of the keys: where the rows are a union of parts that already lie by the plain keys, Spark would take out
    the exchange and then merge the parts' small partitions unevenly, so that equal keys would come apart.
    """
    return rows.repartition(F.xxhash64(*keys))


PATH = "conv_id long, depth long, k1 long, k2 long, p1 long, p2 long, chars long, ends boolean"


def paths(turns: DataFrame) -> DataFrame:
    """One row for each member of each node: conversations of ``places`` in order, with the keys of node and parent."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PATH.split(", ")]
        types = [pa.bool_() if n == "ends" else pa.int64() for n in names]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        rows: list[tuple] = []
        held: tuple | None = None  # the last node of the open conversation, which its next turn will close
        for batch in batches:
            for conv, d1, d2, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "d1", "d2", "chars")), strict=True):
                if held is None or held[0] != conv:
                    if held is not None:
                        rows.append((*held, True))
                    held = (conv, 0, *ROOT, None, None, 0)
                if d1 is not None:
                    rows.append((*held, False))
                    key = hashlib.blake2b(struct.pack("<qqqq", held[2], held[3], d1, d2), digest_size=16).digest()
                    held = (conv, held[1] + 1, *struct.unpack("<qq", key), held[2], held[3], chars)
            if rows:
                yield pack(rows)
                rows = []
        if held is not None:
            yield pack([(*held, True)])

    return _together(turns, "conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "d1", "d2", "chars").mapInArrow(run, PATH)


def ends(path: DataFrame) -> DataFrame:
    """k1, k2, ends_sha256: for each node where conversations end, the digest of their ids, joined by commas in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        out: list[tuple] = []
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["k1", "k2", "ends_sha256"])
        for batch in batches:
            for k1, k2, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (k1, k2):
                    if now:
                        out.append((*now, sha.hexdigest()))
                    now, sha = (k1, k2), hashlib.sha256(str(conv).encode())
                else:
                    sha.update(f",{conv}".encode())
            if out:
                yield pack(out)
                out = []
        if now:
            yield pack([(*now, sha.hexdigest())])

    d = path.where("ends").select("k1", "k2", "conv_id")
    return _together(d, "k1", "k2").sortWithinPartitions("k1", "k2", "conv_id").mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


def forest_arrays(parent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(preorder place, subtree size) of each node; a parent stands before its children, tops have -1."""
    n, up = len(parent), parent.tolist()
    size, enter, free = [1] * n, [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if up[i] >= 0:
            size[up[i]] += size[i]
    at = 0
    for i in range(n):
        p = up[i]
        if p < 0:
            enter[i], at = at, at + size[i]
        else:
            enter[i] = free[p]
            free[p] += size[i]
        free[i] = enter[i] + 1
    return np.array(enter, np.int64), np.array(size, np.int64)


def decompose(parent: np.ndarray, depth: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, int]:
    """(sums of the values over every node's subtree, rounds) in a forest as in ``forest_arrays``; values has a column each."""
    n = len(parent)
    enter, size = forest_arrays(parent)
    leave = enter + size
    total = np.zeros_like(values)
    top = np.arange(n)
    for i in range(n):  # parents first
        if parent[i] >= 0:
            top[i] = top[parent[i]]
    open_ = np.arange(n)
    rounds = 0
    while len(open_):
        rounds += 1
        open_ = open_[np.lexsort((enter[open_], top[open_]))]  # by component, in preorder
        t = top[open_]
        half = open_[2 * size[open_] >= size[t]]
        half = half[np.lexsort((depth[half], top[half]))]
        last = np.append(top[half][1:] != top[half][:-1], True)
        centre = np.full(n, -1)
        centre[top[half][last]] = half[last]
        x = centre[t]
        below = (enter[open_] >= enter[x]) & (enter[open_] < leave[x])
        first = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
        sums = np.add.reduceat(np.where(below[:, None], values[open_], 0), first)
        xs, tops = x[first], t[first]
        total[xs] += sums
        gone = size[xs].copy()
        at, on = parent[xs], xs != tops
        at, add, less, stop = at[on], sums[on], gone[on], tops[on]
        while len(at):  # from the centroids to the tops, in all components at once
            total[at] += add
            size[at] -= less
            on = at != stop
            at, add, less, stop = parent[at[on]], add[on], less[on], stop[on]
        child = below & (parent[open_] == x)
        new = np.maximum.accumulate(np.where(child, np.arange(len(open_)), 0))
        top[open_] = np.where(below, open_[new], t)
        open_ = open_[open_ != x]
    return total, rounds


def _finish(rows: DataFrame, names: list[str]) -> DataFrame:
    """Components of at most LOCAL nodes to their end: conv, depth and the totals, with what was added before."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def solve(d: pa.Table) -> pa.RecordBatch:
            c = {k: d.column(k).to_numpy() for k in d.column_names}
            node = {k: i for i, k in enumerate(zip(c["conv"].tolist(), c["depth"].tolist(), strict=True))}
            is_top = (c["conv"] == c["tconv"]) & (c["depth"] == c["tdepth"])
            parent = np.array([-1 if t else node[p, k - 1] for t, p, k in zip(is_top.tolist(), c["pconv"].tolist(), c["depth"].tolist(), strict=True)], np.int64)
            total, _ = decompose(parent, c["depth"], np.stack([c[v] for v in names], 1))
            return pa.RecordBatch.from_arrays([pa.array(c["conv"]), pa.array(c["depth"]), *(pa.array(total[:, i] + c[f"sum_{v}"]) for i, v in enumerate(names))], names=["conv", "depth", *names])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= GATHER:
                d = pa.Table.from_batches(held)
                t, k = d.column("tconv").to_numpy(), d.column("tdepth").to_numpy()
                cuts = np.flatnonzero((t[1:] != t[:-1]) | (k[1:] != k[:-1]))
                if len(cuts):  # the last component may go on
                    cut = int(cuts[-1]) + 1
                    yield solve(d.slice(0, cut))
                    held = d.slice(cut).combine_chunks().to_batches()
                    size = d.num_rows - cut
        if size:
            yield solve(pa.Table.from_batches(held))

    d = rows.select("tconv", "tdepth", "conv", "depth", "pconv", *names, *(f"sum_{v}" for v in names))
    d = _together(d, "tconv", "tdepth").sortWithinPartitions("tconv", "tdepth", "depth", "conv")
    return d.mapInArrow(run, "conv long, depth long, " + ", ".join(f"{v} long" for v in names))


def rollup(nodes: DataFrame, above: DataFrame, names: list[str]) -> DataFrame:
    """conv, depth and the sums of the values ``names`` over each node's subtree.

    ``nodes``: conv, depth, pconv (the parent is at depth - 1), size (nodes of its subtree) and the values, of one tree.
    ``above``: for each conv and each depth of its path conv, depth, at (the conv of the node there) and nxt (of the next one).
    """
    done, small = [], []
    state = nodes.select("conv", "depth", "pconv", "size", *names, *(F.lit(0).cast("long").alias(f"sum_{v}") for v in names))
    low = state.agg(F.min(F.struct("depth", "conv")).alias("t"))  # the root
    state = state.join(F.broadcast(low.select(F.col("t.conv").alias("tconv"), F.col("t.depth").alias("tdepth"))))
    top = ["tconv", "tdepth"]
    state = written(state, "trie-state")
    old: list[DataFrame] = [state]
    while True:
        whole = written(state.groupBy(top).agg(F.max("size").alias("whole")).where(F.col("whole") > LOCAL), "trie-wholes")
        if whole.isEmpty():
            small.append(state)
            break
        small.append(state.join(whole, top, "left_anti"))
        big = state.join(whole, top)
        half = big.where("2 * size >= whole").groupBy(top).agg(F.max(F.struct("depth", "conv", "size")).alias("x"))
        centre = written(half.select(*top, F.col("x.conv").alias("xconv"), F.col("x.depth").alias("xdepth"), F.col("x.size").alias("xsize")), "trie-centres")
        d = state.join(centre, top).withColumn("key", F.least("depth", "xdepth"))
        a = above.select(F.col("conv"), F.col("depth").alias("key"), "at", "nxt")
        d = d.join(a, ["conv", "key"])
        d = written(d.withColumn("below", (F.col("depth") >= F.col("xdepth")) & (F.col("at") == F.col("xconv"))).drop("key", "at"), "trie-split")
        total = d.where("below").groupBy(top).agg(*(F.sum(v).alias(f"add_{v}") for v in names))
        path = centre.join(total, top).join(above.withColumnsRenamed({"conv": "xconv"}).drop("nxt"), "xconv").where("depth BETWEEN tdepth AND xdepth")
        path = path.select(F.col("at").alias("conv"), "depth", F.when(F.col("depth") < F.col("xdepth"), F.col("xsize")).otherwise(0).alias("less"), *(f"add_{v}" for v in names))
        d = d.join(path, ["conv", "depth"], "left")
        moved = F.col("below") & (F.col("depth") > F.col("xdepth"))
        d = d.select(
            "conv", "depth", "pconv", (F.col("size") - F.coalesce("less", F.lit(0))).alias("size"), *names,
            *((F.col(f"sum_{v}") + F.coalesce(f"add_{v}", F.lit(0))).alias(f"sum_{v}") for v in names),
            F.when(moved, F.col("nxt")).otherwise(F.col("tconv")).alias("tconv"), F.when(moved, F.col("xdepth") + 1).otherwise(F.col("tdepth")).alias("tdepth"),
            (F.col("below") & (F.col("depth") == F.col("xdepth"))).alias("centre"),
        )
        state = written(d, "trie-state")
        old.append(state)
        done.append(state.where("centre").select("conv", "depth", *(F.col(f"sum_{v}").alias(v) for v in names)))
        state = state.where("NOT centre").drop("centre")
    rest = small[0].drop("centre")
    for s in small[1:]:
        rest = rest.unionByName(s)
    out = _finish(rest, names)
    for x in done:
        out = out.unionByName(x)
    return out


def trie(turns: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations given as ``places`` (or ``rebuild``) gives them.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves and saved_tokens (over the subtree),
    ends_sha256.
    """
    path = written(paths(turns), "trie-paths")
    key, up = ["k1", "k2"], ["p1", "p2"]
    node = path.groupBy(key).agg(F.min("conv_id").alias("conv"), F.count(F.lit(1)).alias("n_convs"), *(F.min(c).alias(c) for c in ("depth", "chars", *up)))
    node = written(node, "trie-nodes")
    children = node.where("p1 IS NOT NULL").groupBy(up).agg(F.count(F.lit(1)).alias("n_children")).withColumnsRenamed(dict(zip(up, key, strict=True)))
    parent = node.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("pconv"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    full = node.join(children, key, "left").join(ends(path), key, "left").join(parent, up, "left")
    full = full.select("conv", "depth", "pconv", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "chars", F.coalesce("ends_sha256", none).alias("ends_sha256"))

    # the path of each smallest member as nodes, and from it the size of each subtree
    own = node.groupBy("conv").agg(F.min("depth").alias("since"), F.max("depth").alias("till"))
    at = path.join(node.select(*key, F.col("conv").alias("at")), key).join(own.withColumnRenamed("conv", "conv_id"), "conv_id")
    at = at.select(F.col("conv_id").alias("conv"), "depth", "at", (F.col("till") - F.greatest("depth", "since") + 1).alias("mine"))
    above = written(at.withColumn("nxt", F.lead("at").over(Window.partitionBy("conv").orderBy("depth"))), "trie-above")
    size = above.groupBy(F.col("at").alias("conv"), "depth").agg(F.sum("mine").alias("size"))
    leaf, tokens = (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")
    full = written(full.join(size, ["conv", "depth"]).select("*", leaf, tokens), "trie-full")
    sums = rollup(full, above.drop("mine"), ["n_leaves", "saved_tokens"])
    out = full.drop("n_leaves", "saved_tokens").join(sums, ["conv", "depth"])
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("pconv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(turns: DataFrame, **columns: str) -> DataFrame:
    """The trie of a table of conversations as they are."""
    return trie(places(turns, **columns))
