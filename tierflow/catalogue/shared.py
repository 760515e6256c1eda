"""Helpers of the query catalogue."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierflow.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str, nullable: tuple[str, ...] = ()):
    """Register a query with the DuckDB SQL that must give the same rows.

    ``nullable`` names number columns that hold NULLs. Both sides give them as doubles, because clients
    differ in how they show integers with gaps.
    """

    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def shown(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df.withColumns({c: df[c].cast("double") for c in nullable}) if nullable else df

        QUERIES[name] = shown
        casts = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in nullable)
        ORACLES[name] = f"SELECT * REPLACE ({casts}) FROM ({sql})" if nullable else sql
        return fn

    return keep


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The table's files as a stream."""
    schema = load(spark, sf_dir, table).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{table}.parquet*")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared scratch area."""
    return f"{scratch_dir(spark)}/tierflow-runs/{name}-{uuid.uuid4().hex}"
