"""Collects the queries of every module of the library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aqgrid.plans import air  # noqa: F401  registers its queries
from aqgrid.plans.queries import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return QUERIES


def oracles() -> dict[str, str]:
    return ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["m9_idw_fill"](spark, sf_dir)
