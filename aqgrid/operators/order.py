"""Orders over whole tables without a task that holds them: ranges of the key, and what one range hands to the next; parts by
the number of rows.

The ranges end at values that the table holds, found by Spark's approximate percentiles; which range a row falls into follows
from its key alone, so that it is the same however often a plan or a lost task is run.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def bounds(df: DataFrame, key: str, ranges: int) -> list[Any]:
    """At most ``ranges`` ascending values of the numeric or date column; each closes a range of about as many rows, the last
    one is the greatest value. Nulls are left out; without other values there are no bounds."""
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, shares, max(10_000, 20 * ranges)).alias("q") if shares else F.array().alias("q"), F.max(key).alias("top")).first()
    return [] if found["top"] is None else sorted({*(found["q"] or []), found["top"]})


def range_of(key: Column, ends: list[Any]) -> Column:
    """The range of a key: how many of the bounds are below it, by binary search. A null falls into the first range."""
    if not ends:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(ends).bit_length()))]
    values, last = F.array(*map(F.lit, ends)), len(ends)
    ahead = lambda low, step: F.element_at(values, F.least(low + step, F.lit(last))) < key
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when((low + step <= last) & ahead(low, step), low + step).otherwise(low))


def parts(df: DataFrame, rows: int = 20_000) -> int:
    """How many parts of about ``rows`` the rows make, one for each core at least."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def spread(df: DataFrame, *keys: str, rows: int = 20_000) -> DataFrame:
    """The rows dealt by a hash of the keys to parts of about ``rows``. For what makes many rows of each one: adaptive execution
    merges parts by the bytes that go in, so that a few tasks would hold all that comes out."""
    return df.repartition(parts(df, rows), *keys)


#: Ranges of an order where nothing else is asked for.
RANGES = 64


def running_sum(df: DataFrame, key: str, value: str, ranges: int = RANGES) -> DataFrame:
    """The rows with ``running``: the sum of the values up to each row's key, rows of one key together. A window within each range
    of keys, and the sums of the ranges before it, one number a range."""
    ends = bounds(df, key, ranges)
    d = df.withColumn("_range", range_of(F.col(key), ends))
    sums = {r["_range"]: r["s"] for r in d.groupBy("_range").agg(F.sum(value).alias("s")).collect()}
    ahead, total = [], 0
    for k in range(max(1, len(ends))):
        ahead.append(total)
        total += sums.get(k) or 0
    within = F.sum(value).over(Window.partitionBy("_range").orderBy(key))
    return d.withColumn("running", within + F.element_at(F.array(*map(F.lit, ahead)), F.col("_range") + 1)).drop("_range")


def distinct_before(df: DataFrame, key: str, ranges: int = RANGES) -> DataFrame:
    """The distinct values of a column as ``value``, each with the next smaller one as ``before``. What a range hands to the next
    is the value that closes it."""
    ends = bounds(df, key, ranges)
    d = df.select(F.col(key).alias("value")).where(F.col(key).isNotNull()).distinct().withColumn("_range", range_of(F.col("value"), ends))
    before = F.lag("value").over(Window.partitionBy("_range").orderBy("value"))
    closed = F.when(F.col("_range") > 0, F.get(F.array(*map(F.lit, ends)), F.col("_range") - 1)) if ends else F.lit(None)
    return d.select("value", F.coalesce(before, closed).alias("before"))


def with_before(df: DataFrame, key: str, columns: tuple[str, ...], ranges: int = RANGES) -> DataFrame:
    """The rows with ``before``: a struct of the columns in the row before, by the key and then the columns themselves.

    The last row of each range, one row a range, is found by a grouped maximum and meets the first rows of the next range."""
    ends = bounds(df, key, ranges)
    d = df.withColumn("_range", range_of(F.col(key), ends)).withColumn("_row", F.struct(key, *columns))
    last = {r["_range"]: r["x"] for r in d.groupBy("_range").agg(F.max("_row").alias("x")).collect()}
    kind = d.schema["_row"].dataType
    handed = [(k, last[k - 1]) for k in range(1, max(1, len(ends))) if last.get(k - 1) is not None]
    edge = df.sparkSession.createDataFrame(handed, StructType([StructField("_range", IntegerType()), StructField("_edge", kind)]))
    d = d.join(F.broadcast(edge), "_range", "left")
    order = Window.partitionBy("_range").orderBy("_row")
    return d.withColumn("before", F.coalesce(F.lag("_row").over(order), F.col("_edge"))).drop("_range", "_row", "_edge")
