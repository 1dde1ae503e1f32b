import datetime
import json
import math

import duckdb
import pytest

from aqgrid.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v.isoformat() if isinstance(v, datetime.date) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(json.dumps([plain(r[c]) for c in cols]) for r in df.collect())
    assert got
    if name in registry.oracles():
        cur = con.execute(registry.oracles()[name])
        names = [c[0] for c in cur.description]
        assert sorted(names) == cols
        assert got == sorted(json.dumps([plain(r[names.index(c)]) for c in cols]) for r in cur.fetchall())


def test_mosaic_of_lines_that_share_their_number(spark, con, tmp_path):
    """Of lines with one order and number the first in the file counts, wherever the readers split it."""
    folder = str(tmp_path)
    con.execute(f"COPY (SELECT (i % 5)::BIGINT AS l_orderkey, (i // 7 % 40)::BIGINT AS l_partkey, 1 AS l_linenumber, ((i * 7919) % 50)::DOUBLE AS l_quantity FROM range(200000) t(i)) TO '{folder}/lineitem.parquet' (FORMAT parquet, ROW_GROUP_SIZE 20000)")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        got = {(r.row, r.col): r.value for r in registry.queries()["g10_mosaic"](spark, folder).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    first = con.execute(f"SELECT l_partkey // 50, l_partkey % 50, arg_min(l_quantity, file_row_number) FROM read_parquet('{folder}/lineitem.parquet', file_row_number = true) WHERE l_orderkey = 0 GROUP BY l_partkey").fetchall()
    assert got == {(i, j): v for i, j, v in first}
