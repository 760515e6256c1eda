"""Runs of rows by key: each written once, merged when read, compacted by size tiers.

A run is a folder of rows, at most one for each identity (the columns that name a row), in partitions by key hash. Adding a run
costs its own size. A reader merges the runs: the largest one passes row by row but for the identities the others hold, so a
large base with small additions is not shuffled where Spark can broadcast the additions. Once ``FAN`` runs have about the same
size they become one, with everything smaller: a row is rewritten about log(rows) / log(FAN) times in its life.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.ordering import null_safe
from tierflow.sources.storage import children, exists, get_text, put_text, remove

BUCKET = "__bucket"
LABEL = "__label"
FAN = 4
ROWS = "_rows"


@dataclass(frozen=True)
class Run:
    """``name`` labels the folder below the store's; ``rows`` decides the tier only."""

    name: str
    rows: int

    @property
    def tier(self) -> int:
        return int(math.log(max(1, self.rows), FAN))


def listed(runs: Iterable[Run]) -> list[dict]:
    return [asdict(r) for r in runs]


class RunStore:
    def __init__(
        self, spark: SparkSession, path: str, folder: str, schema: T.StructType, keys: list[str], identity: list[str], buckets: int,
        merge: Callable[[DataFrame], DataFrame],
    ):
        """``merge`` reduces rows of several runs to one for each identity, whatever their order."""
        self.spark, self.path, self.folder, self.buckets = spark, path, folder, buckets
        self.schema, self.keys, self.identity, self.merge = schema, keys, identity, merge

    def where(self, name: str) -> str:
        return f"{self.path}/{self.folder}/{LABEL}={name}"

    def names(self) -> list[str]:
        """Labels of the runs that are there, finished or not."""
        return [n.removeprefix(f"{LABEL}=") for n in children(self.spark, f"{self.path}/{self.folder}") if n.startswith(f"{LABEL}=")]

    def bucket(self):
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def write(self, rows: DataFrame, name: str) -> Run:
        """Write ``rows`` as the run ``name``, replacing one of that name."""
        # Rebalancing keeps a bucket's rows together, and splits a bucket that is too large for one task.
        dealt = rows.withColumn(BUCKET, self.bucket()).hint("rebalance", F.col(BUCKET))
        dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(self.where(name))
        run = self.run(name)
        put_text(self.spark, f"{self.where(name)}/{ROWS}", str(run.rows))
        return run

    def run(self, name: str) -> Run:
        """A run that was written before, this session or another."""
        where = self.where(name)
        if exists(self.spark, f"{where}/{ROWS}"):
            return Run(name, int(get_text(self.spark, f"{where}/{ROWS}")))
        if not any(n.startswith(f"{BUCKET}=") for n in children(self.spark, where)):
            return Run(name, 0)
        return Run(name, self.read([Run(name, 1)]).count())

    def read(self, runs: list[Run], buckets: list[int] | None = None) -> DataFrame:
        """Rows of the runs as they are."""
        # A run without rows has no file; Spark would take its folder's schema for lost.
        paths = [self.where(r.name) for r in runs if r.rows]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        stored = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(LABEL, T.StringType())])
        rows = self.spark.read.schema(stored).option("basePath", f"{self.path}/{self.folder}").parquet(*paths)
        return (rows if buckets is None else rows.where(F.col(BUCKET).isin(buckets))).drop(BUCKET, LABEL)

    def merged(self, runs: list[Run]) -> DataFrame:
        """One row for each identity."""
        runs = [r for r in runs if r.rows]
        if len(runs) < 2:
            return self.read(runs)
        base = max(runs, key=lambda r: r.rows)
        young = self.read([r for r in runs if r is not base])
        names = young.select(*[F.col(f"`{c}`") for c in self.identity]).distinct()
        old = self.read([base])
        on = null_safe(old, names, self.identity)
        again = self.merge(young.unionByName(old.join(names, on, "left_semi")))
        return old.join(names, on, "left_anti").unionByName(again.select(*old.columns))

    def of_keys(self, runs: list[Run], names: DataFrame) -> DataFrame:
        """Merged rows of the keys that ``names`` lists."""
        rows = self.read(runs)
        return self.merge(rows.join(names, null_safe(rows, names, self.keys), "left_semi"))

    def compacted(self, runs: list[Run], name: str, shape: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> list[Run]:
        """The runs after merging those that a full tier makes due; ``shape`` may leave out rows nobody needs again."""
        runs = [r for r in runs if r.rows]
        due: list[Run] = []
        for tier in sorted({r.tier for r in runs}):
            upto = [r for r in runs if r.tier <= tier]
            # What lower tiers bring may fill this one.
            carried = due and Run("", sum(r.rows for r in due)).tier >= tier
            if sum(r.tier == tier for r in runs) + bool(carried) >= FAN:
                due = upto
        if len(due) < 2:
            return runs
        done = self.write(shape(self.merge(self.read(due))), name)
        return [r for r in runs if r not in due] + ([done] if done.rows else [])

    def sweep(self, kept: set[str], upto: Callable[[str], bool]) -> None:
        """Remove the runs outside ``kept`` that ``upto`` holds for."""
        for name in self.names():
            if name not in kept and upto(name):
                remove(self.spark, self.where(name))


def by_latest(keys: list[str], values: list[str], run: str) -> Callable[[DataFrame], DataFrame]:
    """A merge that keeps each identity's row of the highest run number."""

    def merge(rows: DataFrame) -> DataFrame:
        best = F.max_by(F.struct(*[F.col(f"`{v}`") for v in values]), F.col(run)).alias("__best")
        latest = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(best, F.max(run).alias(run))
        return latest.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"__best.`{v}`") for v in values], run)

    return merge


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
