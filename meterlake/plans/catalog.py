"""Registered queries: each name maps to a Spark builder ``(spark, sf_dir)
-> DataFrame`` and, where the result is SQL-expressible, to the equivalent
DuckDB SQL over the same parquet tables (the verify oracle).

Float results are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import r6
from ..session import apply_defaults
from ..sources import fixtures as fx
from . import oracle as o

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]) -> Builder:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return run
    return deco


# Import the modules that register queries (side effect: fill the dicts).
from . import queries_core, queries_clean, queries_serving, queries_stream, queries_ml  # noqa: E402,F401
