"""Targets of full snapshots, written by what changes.

Every snapshot is compared with the rows that are current; only differences are written. ``current`` is a store of runs with one
row for each key (see ``runs``), ``closed`` holds the versions that ended, which no later snapshot touches. A digest for each
of ``DIGESTS`` groups of keys is kept with every publication: a group with an equal digest is neither read nor compared.

::

    current/...              keys, start and values of the current row; tombstones of keys that went
    closed/snapshot=N        type 2: versions that snapshot N ended
    digests/snapshot=N       group, rows and digest of snapshot N
    v=N/_runs                the runs after snapshot N; _SUCCESS beside it comes last
    description              schema and options, for readers
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.cdc import END, START, ChangeOptions, pack, tracked_columns
from tierflow.operators.snapshots import one_row_per_key
from tierflow.session import materialize
from tierflow.sources.storage import current_version, exists, get_text, newest, put_text, touch
from tierflow.streaming.feed import CHANGE, COMMIT, FEED, INSERT, ChangeFeed, keyed_changes
from tierflow.streaming.runs import Run, RunStore, by_latest, listed

DIGESTS = 1 << 16
KIND = "snapshots"
NUMBER, GONE, GROUP = "__run", "__gone", "__group"


class SnapshotTarget:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, opts: ChangeOptions, buckets: int = 64, digests: int = DIGESTS):
        self.spark, self.path, self.schema, self.opts, self.buckets, self.digests = spark, path.rstrip("/"), schema, opts, buckets, digests
        self.keys = list(opts.keys)
        self.values = [c for c in schema.names if c not in self.keys]
        self.tracked = tracked_columns(schema.names, opts)
        self.bounds = [T.StructField(START, T.LongType()), T.StructField(END, T.LongType())]
        stored = [schema[c] for c in (*self.keys, *self.values)]
        fields = T.StructType([*stored, self.bounds[0], T.StructField(GONE, T.BooleanType()), T.StructField(NUMBER, T.LongType())])
        merge = by_latest(self.keys, [*self.values, START, GONE], NUMBER)
        self.current = RunStore(spark, self.path, "current", fields, self.keys, self.keys, buckets, merge)

    def describe(self) -> None:
        told = {"kind": KIND, "schema": self.schema.jsonValue(), "options": asdict(self.opts), "buckets": self.buckets, "digests": self.digests}
        put_text(self.spark, f"{self.path}/description", json.dumps(told))

    # --- what is published ---

    def version(self) -> int | None:
        return current_version(self.spark, self.path)

    def _runs(self, version: int | None) -> list[Run]:
        if version is None:
            return []
        return [Run(**r) for r in json.loads(get_text(self.spark, f"{self.path}/v={version}/_runs"))]

    def _closed(self, version: int | None) -> DataFrame:
        fields = T.StructType([*self.schema.fields, *self.bounds, T.StructField("snapshot", T.LongType())])
        if version is None or not exists(self.spark, f"{self.path}/closed"):
            return self.spark.createDataFrame([], T.StructType(fields.fields[:-1]))
        # A snapshot whose publication failed may have left versions beyond it.
        return self.spark.read.schema(fields).parquet(f"{self.path}/closed").where(F.col("snapshot") <= version).drop("snapshot")

    def _shown(self, rows: DataFrame) -> DataFrame:
        """Current rows as the target shows them."""
        live = rows.where(f"NOT {GONE}")
        names = [F.col(f"`{c}`") for c in self.schema.names]
        return live.select(*names) if self.opts.scd_type == "1" else live.select(*names, START, F.lit(None).cast("bigint").alias(END))

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if version is None:
            raise FileNotFoundError(f"no snapshot under {self.path}")
        rows = self._shown(self.current.merged(self._runs(version)))
        return rows if self.opts.scd_type == "1" else rows.unionByName(self._closed(version))

    # --- a snapshot ---

    def _group(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys], F.lit(7)), F.lit(self.digests)).cast("int")

    def _digested(self, rows: DataFrame) -> DataFrame:
        values = [pack(F.col(f"`{f.name}`"), f.dataType) for f in self.schema.fields]
        # Sums of two independent hashes: the same for the same rows in any order.
        one, two = (F.xxhash64(*values, F.lit(seed)).cast("decimal(20,0)") for seed in (1, 2))
        return rows.groupBy(self._group().alias(GROUP)).agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("one"), F.sum(two).alias("two"))

    def apply(self, snapshot: DataFrame, version: int) -> None:
        """Bring the target to a snapshot; versions rise. A key twice in it is an error and nothing is published."""
        before = self.version()
        if before is not None and version <= before:
            raise ValueError(f"snapshot {version} does not follow {before}")
        rows = one_row_per_key(snapshot.select(*[F.col(f"`{c}`") for c in self.schema.names]), self.keys)
        digests = f"{self.path}/digests/snapshot={version}"
        self._digested(rows).write.mode("overwrite").parquet(digests)
        runs = self._runs(before)
        fresh, old = rows, self._shown_with_start(self.current.merged(runs))
        if before is not None:
            now, then = self.spark.read.parquet(digests), self.spark.read.parquet(f"{self.path}/digests/snapshot={before}")
            same = now.join(then, [now[c].eqNullSafe(then[c]) for c in now.columns], "left_semi").select(GROUP)
            # At most one row for each group of keys, whatever the table's size.
            same = F.broadcast(same)
            fresh = rows.withColumn(GROUP, self._group()).join(same, GROUP, "left_anti").drop(GROUP)
            old = old.withColumn(GROUP, self._group()).join(same, GROUP, "left_anti").drop(GROUP)
        changes = materialize(self._changes(old, fresh))
        at, number = F.lit(version).cast("bigint"), F.lit(version).cast("long").alias(NUMBER)
        changed = F.col("o").isNotNull() & (F.col("n").isNull() | F.col("edge"))
        if self.opts.scd_type == "2":
            ended = changes.where(changed).select(*[F.col(f"o.`{c}`") for c in self.schema.names], F.col(f"o.{START}"), at.alias(END))
            ended.write.mode("overwrite").parquet(f"{self.path}/closed/snapshot={version}")
        gone = F.col("n").isNull()
        start = F.when(gone | (F.col("o").isNotNull() & ~F.col("edge")), F.col(f"o.{START}")).otherwise(at)
        row = [F.when(gone, F.col("o")[c]).otherwise(F.col("n")[c]).alias(c) for c in (*self.keys, *self.values)]
        new = changes.select(*row, start.alias(START), gone.alias(GONE), number)
        made = self.current.write(new, f"b{version}")
        runs = self.current.compacted([*runs, made], f"m{version}")
        put_text(self.spark, f"{self.path}/v={version}/_runs", json.dumps(listed(runs)))
        touch(self.spark, f"{self.path}/v={version}/_SUCCESS")
        self._sweep(before, runs)

    def _shown_with_start(self, rows: DataFrame) -> DataFrame:
        return rows.where(f"NOT {GONE}").select(*[F.col(f"`{c}`") for c in self.schema.names], START)

    def _changes(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Old (``o``) and new row (``n``) of the keys that differ; ``edge``: a tracked value does."""
        o = old.select(F.struct(*[F.col(f"`{c}`") for c in old.columns]).alias("o"))
        n = new.select(F.struct(*[F.col(f"`{c}`") for c in new.columns]).alias("n"))
        both = o.join(n, [o["o"][k].eqNullSafe(n["n"][k]) for k in self.keys], "full_outer")

        def differ(columns: list[str]) -> Column:
            kinds = {f.name: f.dataType for f in self.schema.fields}
            same = F.lit(True)
            for c in columns:
                same = same & pack(F.col("o")[c], kinds[c]).eqNullSafe(pack(F.col("n")[c], kinds[c]))
            return ~same

        both = both.withColumn("edge", differ(self.tracked))
        return both.where(F.col("o").isNull() | F.col("n").isNull() | differ(self.values))

    def _sweep(self, before: int | None, runs: list[Run]) -> None:
        """Remove runs that neither of the last two snapshots nor the change feed's last one names."""
        fed = newest(self.spark, f"{self.path}/{FEED}", COMMIT)
        kept = {r.name for v in (before, fed) if v is not None for r in self._runs(v)} | {r.name for r in runs}
        self.current.sweep(kept, lambda name: before is not None and int(name[1:]) <= before)

    # --- feed ---

    def feed(self) -> ChangeFeed:
        version = self.version()
        schema = self.schema if self.opts.scd_type == "1" else T.StructType([*self.schema.fields, *self.bounds])
        return ChangeFeed(self.spark, self.path, schema, version, self._between)

    def _between(self, a: int | None, b: int) -> DataFrame:
        if a is None:
            return self.read(b).withColumn(CHANGE, F.lit(INSERT))
        identity = self.keys if self.opts.scd_type == "1" else [*self.keys, START]
        came = self.current.read([r for r in self._runs(b) if r not in self._runs(a)])
        names = materialize(came.select(*[F.col(f"`{k}`") for k in self.keys]).distinct())

        def at(version: int) -> DataFrame:
            rows = self._shown(self.current.of_keys(self._runs(version), names))
            if self.opts.scd_type == "1":
                return rows
            # Versions that ended up to a are the same in both states.
            return rows if version == a else rows.unionByName(self._closed(b).where(F.col(END) > a))

        return keyed_changes(at(a), at(b), identity)


def open_snapshots(spark: SparkSession, path: str) -> SnapshotTarget:
    told = json.loads(get_text(spark, f"{path}/description"))
    return SnapshotTarget(spark, path, T.StructType.fromJson(told["schema"]), ChangeOptions.of(told["options"]), told["buckets"], told["digests"])
