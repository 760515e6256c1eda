"""Change feeds: a published table as a stream of row-level changes.

A published table is replaced or merged as a whole, so its files cannot be followed. Its feed can: an append-only table with the net
changes between one publication and the next, read by Spark's file stream. A step is derived when a reader asks for it, from
the last publication the feed holds to the newest one, written aside and moved to its name when it is whole. So the offsets,
the restart and the exactly-once delivery are those of any file stream, for any number of readers, and a table
that nobody follows pays nothing.

::

    <table>/feed/_commit_version=N    changes up to publication N
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.cdc import pack, unpack
from tierflow.sources.storage import current_version, make_folder, move, newest, read_published

FEED = "feed"
CHANGE, COMMIT = "_change_type", "_commit_version"
INSERT, UPDATE, DELETE = "insert", "update", "delete"
# Reader option that brings deleted rows, and the two columns above.
OPTION = "readChangeFeed"


def keyed_changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``after`` that are new or different, and rows of ``before`` that are gone; both have one row for each key."""
    values = [f for f in after.schema.fields if f.name not in keys]
    names = [f"__v{i}" for i in range(len(values))]

    def shaped(df: DataFrame, side: str) -> DataFrame:
        kept = [F.col(f"`{k}`").alias(f"__{side}k{i}") for i, k in enumerate(keys)]
        packed = [pack(F.col(f"`{f.name}`"), f.dataType).alias(n) for f, n in zip(values, names)]
        return df.select(*kept, F.struct(F.lit(True).alias("__there"), *packed).alias(side))

    old, new = shaped(before, "b"), shaped(after, "a")
    on = [old[f"__bk{i}"].eqNullSafe(new[f"__ak{i}"]) for i in range(len(keys))]
    joined = old.join(new, on, "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
    kind = F.when(F.col("b").isNull(), INSERT).when(F.col("a").isNull(), DELETE).otherwise(UPDATE)
    row = F.coalesce("a", "b")
    by_name = {f.name: unpack(row[n], f.dataType).alias(f.name) for f, n in zip(values, names)}
    by_name |= {k: F.when(F.col("a").isNotNull(), F.col(f"__ak{i}")).otherwise(F.col(f"__bk{i}")).alias(k) for i, k in enumerate(keys)}
    return joined.select(*[by_name[c] for c in after.columns], kind.alias(CHANGE))


def row_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The same for tables without keys: rows count, so a row that stands there once more is an insert."""
    fields = after.schema.fields
    packed = [pack(F.col(f"`{f.name}`"), f.dataType).alias(f"__v{i}") for i, f in enumerate(fields)]
    signed = after.select(*packed, F.lit(1).alias("__n")).union(before.select(*packed, F.lit(-1).alias("__n")))
    names = [f"__v{i}" for i in range(len(fields))]
    net = signed.groupBy(*names).agg(F.sum("__n").alias("__n")).where("__n <> 0")
    each = net.withColumn("__each", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("__n"))))
    kind = F.when(F.col("__n") > 0, INSERT).otherwise(DELETE)
    return each.select(*[unpack(F.col(n), f.dataType).alias(f.name) for n, f in zip(names, fields)], kind.alias(CHANGE))


class ChangeFeed:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, newest_version: int | None, between: Callable[[int | None, int], DataFrame]):
        """``between(a, b)``: net changes from publication a (None: nothing) to b, with ``_change_type``."""
        self.spark, self.path, self.schema = spark, f"{path.rstrip('/')}/{FEED}", schema
        self.newest_version, self.between = newest_version, between

    def advance(self) -> None:
        """Write the step up to the newest publication, unless it is there."""
        last = newest(self.spark, self.path, COMMIT)
        if self.newest_version is None or last == self.newest_version:
            return
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        self.between(last, self.newest_version).write.parquet(draft)
        move(self.spark, draft, f"{self.path}/{COMMIT}={self.newest_version}")

    def stream(self, options: dict | None = None) -> DataFrame:
        """New and changed rows; with ``readChangeFeed`` deleted ones, too, and what happened in which publication."""
        self.advance()
        make_folder(self.spark, self.path)
        options = dict(options or {})
        whole = str(options.pop(OPTION, "false")).lower() == "true"
        stored = T.StructType([*self.schema.fields, T.StructField(CHANGE, T.StringType()), T.StructField(COMMIT, T.LongType())])
        rows = self.spark.readStream.schema(stored).options(**options).parquet(self.path)
        return rows if whole else rows.where(F.col(CHANGE) != DELETE).drop(CHANGE, COMMIT)


def published_feed(spark: SparkSession, path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> ChangeFeed:
    """Feed of a table of versions; ``shape`` picks the rows of a version that count."""
    version = current_version(spark, path)

    def between(a: int | None, b: int) -> DataFrame:
        after = shape(read_published(spark, path, b))
        if a is None:
            return after.withColumn(CHANGE, F.lit(INSERT))
        before = shape(read_published(spark, path, a))
        # A version may have columns its predecessor lacks.
        return row_changes(after.where("false").unionByName(before, allowMissingColumns=True).select(*after.columns), after)

    return ChangeFeed(spark, path, shape(read_published(spark, path, version)).schema, version, between)
