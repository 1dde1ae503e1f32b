import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from aqgrid.llm import prefix_trie
from aqgrid.llm.queries import op13_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(rows, rebuilt):
    """The nodes by plain dictionaries, from rows (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if rebuilt else 0
        full[c] = (own.get(c - c % 100, [])[:h] if h else []) + turns[h:]
    members = defaultdict(list)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[x] for x in children[p]) if children[p] else 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[x] for x in children[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if len(full[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(members[p]), len(p), parent, len(members[p]), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def collected(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def some(seed, n, longest, words=3):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), r.choice("abcdefgh"[:words])) for c in range(n) for t in range(r.randrange(1, longest))]


@pytest.mark.parametrize(("seed", "n", "longest"), [(1, 60, 9), (2, 8, 60)])
def test_trie_in_one_task(spark, seed, n, longest):
    rows = some(seed, n, longest)
    assert collected(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows, False)


def test_trie_by_distributed_rounds(spark, monkeypatch):
    """Components far larger than one task takes, among them a deep path."""
    monkeypatch.setattr(prefix_trie, "LOCAL", 30)
    monkeypatch.setattr(prefix_trie, "GATHER", 20)
    rows = some(3, 40, 7, words=2) + [(100 + c, t, "user", f"t{t}") for c in range(3) for t in range(50 + 20 * c)]
    assert collected(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA))) == plain_trie(rows, False)


def test_trie_of_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (1, None, "user", None), (1, 0, None, "a"), (2, None, "user", ""), (2, 0, "", "a"), (3, 1, "us", "era"), (4, 1, "user", "a"),
        (5, 2, "user", "x" * 200_000), (5, 2, "user", "x" * 200_000), (6, 2, "user", "x" * 200_000), (-7, 1, "user", "é😀"), (8, 1, "user", "é😀"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain_trie(rows, False)
    assert collected(prefix_trie.prefix_trie(df)) == want
    clash = df.withColumns({c: df.text for c in ("place", "d1", "depth", "k1", "conv", "at", "size")})
    assert collected(prefix_trie.prefix_trie(clash)) == want
    assert collected(prefix_trie.prefix_trie(df.where("false"))) == []


@pytest.mark.parametrize("merged", ["1k", "64m"])
def test_rebuilt_conversations(spark, tmp_path, merged):
    """Bases present and absent, shorter than their heads, ids without turns of their own left; Spark merges small partitions."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", merged)
    r = random.Random(4)
    rows = [(c, t, "user", r.choice("ab")) for c in [*range(0, 40), *range(200, 230), 351, 352, 399, 1000] for t in range(r.randrange(1, 9) if c else 3)]
    rows += [(500, 1, "user", "only")] + [(c, 1, "user", "own") for c in range(501, 512)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    try:
        assert collected(op13_prefix_trie(spark, str(tmp_path))) == plain_trie(rows, True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_query_against_plain(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert collected(op13_prefix_trie(spark, sf)) == plain_trie(rows, True)


def test_larger_table_by_paths(spark, tmp_path):
    """Twenty thousand conversations, enough for Spark to merge partitions as it likes: one node a member and depth."""
    d = spark.range(20_000).selectExpr("id AS conv_id", "explode(sequence(0, cast(id % 7 AS int))) AS t").selectExpr("conv_id", "cast(t AS long) AS turn", "'user' AS role", "concat('w', (conv_id * 7 + t) % 5) AS text")
    path = prefix_trie.paths(prefix_trie.rebuild(prefix_trie.places(d)))
    assert path.groupBy("conv_id", "depth").count().where("count > 1").count() == 0
    assert path.where("depth = 0").count() == path.where("ends").count() == 20_000


@pytest.mark.parametrize("reach", [1, 4, 10**6])
def test_decomposition_halves(reach):
    """Sums as plain ones, in no more rounds than the logarithm of the largest component."""
    r = random.Random(reach)
    for _ in range(40):
        n = r.randrange(1, 250)
        parent = [-1 if i == 0 or r.random() < 0.02 else r.randrange(max(0, i - reach), i) for i in range(n)]
        depth = []
        for p in parent:
            depth.append(0 if p < 0 else depth[p] + 1)
        order = sorted(range(n), key=lambda i: depth[i])
        place = {i: k for k, i in enumerate(order)}
        up = np.array([place[parent[i]] if parent[i] >= 0 else -1 for i in order])
        values = np.array([[r.randrange(9), 1] for _ in range(n)])
        want = values.copy()
        for i in range(n - 1, -1, -1):
            if up[i] >= 0:
                want[up[i]] += want[i]
        got, rounds = prefix_trie.decompose(up, np.array([depth[i] for i in order]), values)
        assert (got == want).all()
        assert rounds <= np.log2(n) + 1.01
