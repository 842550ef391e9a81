"""All registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import catalogue, more

Query = Callable[[SparkSession, str], DataFrame]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.QUERIES["q_relations"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return catalogue.QUERIES | more.QUERIES


def oracle_sql() -> dict[str, str]:
    return catalogue.ORACLES | more.ORACLES
