"""Queries of this subpackage with their SQL, kept apart from those of the rest of the library."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def visible(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, on machines that have it too.

    Elsewhere it is shipped with `--py-files`.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with SQL of equal meaning if SQL can express it."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            visible(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return register
