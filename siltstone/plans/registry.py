"""All queries of the engine's own operators, by name, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its oracle where SQL can express it."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE[f.__name__] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes that one task may well read: input of less than this for each core is dealt out anew, as its few row groups would keep few cores busy.
SPLIT_BYTES = 128 << 20


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows mean much work each: a small one is spread over all cores, a large one has splits enough as it is."""
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, key) if size < cores * SPLIT_BYTES else df


_MODULES = ("text", "relational", "catalog", "web", "records", "scholarly", "sources", "publishing", "formats", "streams", "declared")


def load() -> dict[str, Query]:
    """All queries: the modules of plans register theirs when they are imported."""
    for module in _MODULES:
        importlib.import_module(f"siltstone.plans.{module}")
    return QUERIES
