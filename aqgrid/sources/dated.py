"""Tables by date whose dates are replaced, added to and compacted while others read them.

Rows lie in folders of a generation and a date; a manifest names the folders that make up the table. Writing makes a new
generation and then a new manifest, which a reader sees whole or not at all. Old folders stay until ``clean``, so that a reader
of the manifest before still finds them. One writer at a time, such as one stream; a token makes a repeated batch harmless.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _manifests(spark: SparkSession, path: str) -> list[str]:
    p, fs = _fs(spark, f"{path}/_manifests")
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().endswith(".json")) if fs.exists(p) else []


def _manifest(spark: SparkSession, path: str, name: str | None) -> dict:
    if name is None:
        return {"dates": {}, "tokens": []}
    rows = spark.read.option("wholetext", True).text(f"{path}/_manifests/{name}").collect()
    return json.loads(rows[0]["value"])


def latest(spark: SparkSession, path: str) -> dict:
    """The manifest in force: folders by date, and the tokens of the batches that it holds."""
    return _manifest(spark, path, (_manifests(spark, path) or [None])[-1])


def _publish(spark: SparkSession, path: str, manifest: dict) -> None:
    names = _manifests(spark, path)
    number = int(names[-1].split(".")[0]) + 1 if names else 0
    draft, fs = _fs(spark, f"{path}/_manifests/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    final, _ = _fs(spark, f"{path}/_manifests/{number:012d}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"{path} has another writer")


def put(df: DataFrame, path: str, *, token: str | None = None, replace: bool = True, dates: list | None = None) -> None:
    """Write the rows to their dates, which they replace or are added to. ``dates`` names dates that are emptied where no row
    has them. Nothing happens if the token has been written before."""
    spark, old = df.sparkSession, latest(df.sparkSession, path)
    if token is not None and token in old["tokens"]:
        return
    gen = uuid.uuid4().hex
    df.repartition("date").withColumn("gen", F.lit(gen)).write.mode("append").partitionBy("gen", "date").parquet(f"{path}/data")
    p, fs = _fs(spark, f"{path}/data/gen={gen}")
    made = [s.getPath().getName().removeprefix("date=") for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
    kept = dict(old["dates"])
    for d in {str(x) for x in dates or ()} if replace else ():
        kept.pop(d, None)
    for d in made:
        kept[d] = ([] if replace else kept.get(d, [])) + [gen]
    _publish(spark, path, {"dates": kept, "tokens": old["tokens"] + ([token] if token is not None else [])})


def read(spark: SparkSession, path: str, schema: str, dates: list | None = None, manifest: dict | None = None) -> DataFrame:
    """The table as the latest manifest has it, or only some of its dates. ``schema`` as written, with ``date``."""
    m = manifest or latest(spark, path)
    wanted = None if dates is None else {str(x) for x in dates}
    folders = [f"{path}/data/gen={g}/date={d}" for d, gens in m["dates"].items() if wanted is None or d in wanted for g in gens]
    empty = spark.createDataFrame([], schema)
    if not folders:
        return empty
    return spark.read.schema(f"{schema}, gen string").option("basePath", f"{path}/data").parquet(*folders).select(*empty.columns)


def compact(spark: SparkSession, path: str, schema: str, most: int = 1) -> list[str]:
    """Bring dates that lie in more than ``most`` folders into one; the dates that were compacted. Readers see the same rows
    before, meanwhile and after."""
    m = latest(spark, path)
    many = [d for d, gens in m["dates"].items() if len(gens) > most]
    if many:
        put(read(spark, path, schema, many, m), path)
    return many


def clean(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove generations of dates that none of the last ``keep`` manifests names, and older manifests; how many folders went."""
    names = _manifests(spark, path)
    live = {(d, g) for n in names[-keep:] for d, gens in _manifest(spark, path, n)["dates"].items() for g in gens}
    p, fs = _fs(spark, f"{path}/data")
    gone = 0
    for g in fs.listStatus(p) if fs.exists(p) else ():
        for d in fs.listStatus(g.getPath()):
            if d.isDirectory() and (d.getPath().getName().removeprefix("date="), g.getPath().getName().removeprefix("gen=")) not in live:
                fs.delete(d.getPath(), True)
                gone += 1
    for n in names[:-keep]:
        q, _ = _fs(spark, f"{path}/_manifests/{n}")
        fs.delete(q, False)
    return gone
