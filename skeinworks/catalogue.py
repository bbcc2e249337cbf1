"""Registry of the core queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skeinworks.plans import answers, batches, checks, codes, graphs, planning, search, seeds, status, texts  # noqa: F401  (they register their queries)
from skeinworks.plans.registry import QUERIES, SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["pre_edges"](spark, sf_dir)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
