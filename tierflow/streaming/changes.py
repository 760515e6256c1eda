"""Change capture on a stream.

A target is a log-structured table (see ``runs``): a batch, a publication or a compaction adds runs, readers merge them, and a
manifest says which runs make the target.

Type 1. A batch is reduced to one mergeable state for each of its keys, tombstones included. Publishing lists the new runs; nothing
is rewritten but what a full tier makes due.

Type 2. Batches go to a log of changes. For every key the target keeps its last sequence and its open version (``tails``). A
key whose new changes all follow its last one goes on from there and the log is not read; the versions it closes and opens
are one small run. Only keys with late or repeated changes are made again from their logged changes, and only versions
that come out different are written. With ``final_after`` a change is final once the newest sequence is that much ahead: later
arrivals of before that mark are set apart as rejects, and compaction drops final changes from the log.

::

    log/bN, log/mN               states (type 1) or changes (type 2) of batch N, and what publication N merged
    tails/..., versions/...      type 2: where each key stands; versions by (keys, start), tombstones for those that went
    truncates/batch=N            truncate point of a batch, if it has one
    rejects/batch=N              rows without a sequence, or behind the mark, as they came
    manifest/N.json              the runs after publication N
    description                  schema and options, for readers
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators import cdc
from tierflow.operators.cdc import END, OP, ROW, SEQ, START, UPSERT, ChangeOptions
from tierflow.operators.ordering import HOT_KEY_ROWS, null_safe
from tierflow.session import materialize
from tierflow.sources.storage import children, exists, get_text, newest, put_text
from tierflow.streaming.feed import CHANGE, COMMIT, FEED, INSERT, ChangeFeed, keyed_changes
from tierflow.streaming.runs import Run, RunStore, by_latest, listed, union

REJECTS = "rejects"
NUMBER, GONE, OPEN = "__run", "__gone", "__open"


@dataclass
class Manifest:
    """What a publication holds. ``batch``: the last batch in it; ``mark``: changes before it are final, as text."""

    number: int = -1
    batch: int = -1
    log: list[Run] = field(default_factory=list)
    tails: list[Run] = field(default_factory=list)
    versions: list[Run] = field(default_factory=list)
    mark: str | None = None

    def text(self) -> str:
        told = {"batch": self.batch, "mark": self.mark}
        return json.dumps(told | {k: listed(getattr(self, k)) for k in ("log", "tails", "versions")})

    @classmethod
    def of(cls, number: int, text: str) -> "Manifest":
        told = json.loads(text)
        runs = {k: [Run(**r) for r in told[k]] for k in ("log", "tails", "versions")}
        return cls(number, told["batch"], mark=told["mark"], **runs)


class ChangeTarget:
    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, opts: ChangeOptions, buckets: int = 64,
        hot_key_rows: int = HOT_KEY_ROWS, final_after: str | None = None,
    ):
        """``final_after``: SQL of what a sequence must be ahead of a change to make it final (``INTERVAL 2 DAYS``, ``1000``)."""
        if final_after and opts.scd_type != "2":
            raise ValueError("final_after needs scd_type 2; type 1 keeps no log")
        self.spark, self.path, self.opts, self.buckets = spark, path.rstrip("/"), opts, buckets
        self.schema, self.final_after = schema, final_after
        columns = schema.names
        self.keys = cdc._find(columns, opts.keys)
        self.keep = cdc.null_keeping_columns(columns, opts)
        self.stored = cdc.stored_schema(schema, opts)
        self.tracked = cdc.tracked_columns(columns, opts)
        self.limits = {"hot_key_rows": hot_key_rows}
        self._stores()

    def _stores(self) -> None:
        empty = self.spark.createDataFrame([], self.schema)
        changes = cdc.read_changes(empty, self.opts)
        self.sequence = changes.schema[SEQ].dataType

        def store(folder, schema, identity, merge) -> RunStore:
            return RunStore(self.spark, self.path, folder, schema, self.keys, identity, self.buckets, merge)

        if self.opts.scd_type == "1":
            states = cdc.key_state(changes, self.keys, self.keep)
            self.log = store("log", states.schema, self.keys, lambda rows: cdc.merge_states(rows, self.keys, self.keep))
            return
        self.log = store("log", changes.schema, [*self.keys, SEQ], lambda rows: cdc.unique_changes(rows, self.keys).select(*changes.columns))
        key_fields = [self.schema[k] for k in self.keys]
        seq, number = T.StructField(SEQ, self.sequence), T.StructField(NUMBER, T.LongType())
        open_version = T.StructType([T.StructField(START, self.sequence), T.StructField(ROW, changes.schema[ROW].dataType)])
        tails = T.StructType([*key_fields, seq, T.StructField(OPEN, open_version), number])
        self.tails = store("tails", tails, self.keys, by_latest(self.keys, [SEQ, OPEN], NUMBER))
        values = [f for f in self.stored.fields if f.name not in self.keys]
        bounds = [T.StructField(START, self.sequence), T.StructField(END, self.sequence)]
        versions = T.StructType([*key_fields, bounds[0], *values, bounds[1], T.StructField(GONE, T.BooleanType()), number])
        names = [f.name for f in values] + [END, GONE]
        self.versions = store("versions", versions, [*self.keys, START], by_latest([*self.keys, START], names, NUMBER))

    # --- log ---

    def absorb(self, batch: DataFrame, batch_id: int) -> None:
        """Log a micro-batch. One that was published already is left alone; it can only be the last one, coming again."""
        manifest = self.manifest()
        if batch_id <= manifest.batch:
            if batch_id < manifest.batch:
                raise ValueError(f"{self.path} has batch {manifest.batch} already; {batch_id} is of another checkpoint")
            return
        # Held while it is written, so that rules in front of it count every row once.
        batch.persist()
        try:
            mark, wanted = self._mark(manifest), F.lit(True)
            rejected = cdc.rejected_changes(batch, self.opts)
            if mark is not None:
                late = F.expr(self.opts.sequence_by) < mark
                source = batch.where(self.opts.where) if self.opts.where else batch
                rejected = rejected.unionByName(source.where(late))
                wanted = F.col(SEQ) >= mark
            rejected.write.mode("overwrite").parquet(f"{self.path}/{REJECTS}/batch={batch_id}")
            changes = cdc.read_changes(batch, self.opts).where(wanted)
            if self.opts.apply_as_truncates:
                points = cdc.truncate_point(changes).where("at IS NOT NULL")
                points.write.mode("overwrite").parquet(f"{self.path}/truncates/batch={batch_id}")
            # Type 2 needs every change; repeated ones are sorted out when versions are made.
            rows = cdc.key_state(changes, self.keys, self.keep) if self.opts.scd_type == "1" else changes
            self.log.write(rows, f"b{batch_id}")
        finally:
            batch.unpersist()

    def _has_rows(self, folder: str) -> bool:
        """Whether some committed batch under ``folder`` holds a data file."""
        base = f"{self.path}/{folder}"
        batches = [b for b in children(self.spark, base) if b.startswith("batch=")]
        return any(n.startswith("part-") for b in batches for n in children(self.spark, f"{base}/{b}"))

    # --- manifest ---

    def manifest(self, number: int | None = None) -> Manifest:
        """The last publication or the one asked for; an empty one before the first."""
        folder = f"{self.path}/manifest"
        numbers = [int(n.removesuffix(".json")) for n in children(self.spark, folder) if n.endswith(".json")]
        if number is None:
            number = max(numbers, default=-1)
        if number not in numbers:
            return Manifest()
        return Manifest.of(number, get_text(self.spark, f"{folder}/{number}.json"))

    def _mark(self, manifest: Manifest) -> Column | None:
        return None if manifest.mark is None else F.lit(manifest.mark).cast(self.sequence)

    # --- publish ---

    def publish(self) -> None:
        """Bring the target up to the last logged batch."""
        before = self.manifest()
        logged = sorted(int(n[1:]) for n in self.log.names() if n.startswith("b"))
        waiting = [n for n in logged if n > before.batch and exists(self.spark, f"{self.log.where(f'b{n}')}/_SUCCESS")]
        if not waiting:
            return
        last = waiting[-1]
        new = [r for r in (self.log.run(f"b{n}") for n in waiting) if r.rows]
        after = Manifest(last, last, [*before.log, *new], before.tails, before.versions, before.mark)
        label = f"m{last}"
        if self.opts.scd_type == "1":
            after.log = self.log.compacted(after.log, label)
        elif new:
            self._publish_history(before, after, new)
            mark = self._mark(after)
            after.log = self.log.compacted(after.log, label, lambda rows: rows if mark is None else rows.where(F.col(SEQ) >= mark))
            after.tails = self.tails.compacted(after.tails, label)
            after.versions = self.versions.compacted(after.versions, label)
        put_text(self.spark, f"{self.path}/manifest/{last}.json", after.text())
        self._sweep(before, after)

    def _publish_history(self, before: Manifest, after: Manifest, new: list[Run]) -> None:
        number = F.lit(after.batch).cast("long").alias(NUMBER)
        key_columns = [F.col(f"`{k}`") for k in self.keys]
        delta = materialize(self.log.merge(self.log.read(new)))
        touched = delta.groupBy(*key_columns).agg(F.min(SEQ).alias("__first"), F.max(SEQ).alias("__last"))
        known = self.tails.of_keys(before.tails, touched).withColumnRenamed(SEQ, "__seen").drop(NUMBER)
        joined = touched.join(known, null_safe(touched, known, self.keys), "left").select(*[touched[k] for k in self.keys], "__first", "__last", "__seen", OPEN)
        late = F.coalesce(F.col("__first") <= F.col("__seen"), F.lit(False))
        joined = materialize(joined.withColumn("__late", late))
        in_order, late_keys = joined.where("NOT __late"), joined.where("__late")

        # Keys that go on: their open version stands for all that was before.
        going = delta.join(in_order, null_safe(delta, in_order, self.keys), "left_semi")
        standing = in_order.where(f"{OPEN} IS NOT NULL").select(*key_columns, F.col(f"{OPEN}.{START}").alias(SEQ), F.lit(UPSERT).alias(OP), F.col(f"{OPEN}.{ROW}").alias(ROW))
        made = [materialize(self._history(going.unionByName(standing)))]
        changed = [made[0].withColumn(GONE, F.lit(False))]
        if not late_keys.isEmpty():
            again, different = self._late_history(before, after, late_keys)
            made.append(again)
            changed.append(different)
        versions = union(changed).withColumn(NUMBER, number)
        after.versions = [*before.versions, self.versions.write(versions.select(*self.versions.schema.names), f"b{after.batch}")]

        values = [f for f in self.stored.fields if f.name not in self.keys]
        packed = [cdc.pack(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in values] or [F.lit(None).cast("boolean").alias("__none")]
        now_open = union(made).where(f"{END} IS NULL")
        standing = now_open.select(*key_columns, F.struct(F.col(START), F.struct(*packed).alias(ROW)).alias("__now"))
        tails = joined.join(standing, null_safe(joined, standing, self.keys), "left").select(
            *[joined[k] for k in self.keys], F.greatest("__seen", "__last").alias(SEQ), F.col("__now").alias(OPEN), number
        )
        after.tails = [*before.tails, self.tails.write(tails, f"b{after.batch}")]
        if self.final_after:
            after.mark = self._new_mark(before, joined)

    def _history(self, changes: DataFrame) -> DataFrame:
        return cdc.history(changes, self.keys, self.stored, self.tracked, self.keep, **self.limits)

    def _late_history(self, before: Manifest, after: Manifest, late_keys: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Versions of the late keys made again; those that came out different, with tombstones for those that went."""
        buckets = [r[0] for r in late_keys.select(self.log.bucket().alias("b")).distinct().collect()]  # at most `buckets`
        logged = self.log.read(after.log, buckets)
        changes = logged.join(late_keys, null_safe(logged, late_keys, self.keys), "left_semi")
        old = materialize(self.versions.of_keys(before.versions, late_keys).where(f"NOT {GONE}").drop(GONE, NUMBER))
        mark = self._mark(before)
        if mark is not None:
            # The log is whole from the mark on; the version over the mark stands for what was before it.
            over = (F.col(START) < mark) & (F.col(END).isNull() | (F.col(END) >= mark))
            fields = self.log.schema[ROW].dataType.fields
            packed = [cdc.pack(F.col(f"`{f.name}`"), self.schema[f.name].dataType).alias(f.name) if f.name in self.schema.names else F.lit(None).cast("boolean").alias(f.name) for f in fields]
            held = old.where(over).select(*[F.col(f"`{k}`") for k in self.keys], F.col(START).alias(SEQ), F.lit(UPSERT).alias(OP), F.struct(*packed).alias(ROW))
            changes = changes.where(F.col(SEQ) >= mark).unionByName(held)
            old = old.where(F.col(END).isNull() | (F.col(END) >= mark))
        made = materialize(self._history(changes))
        identity = [*self.keys, START]
        values = [f for f in made.schema.fields if f.name not in identity]
        packed = F.struct(*[cdc.pack(F.col(f"`{f.name}`"), f.dataType).alias(f"v{i}") for i, f in enumerate(values)])
        mine, theirs = made.withColumn("__v", packed), old.withColumn("__v", packed).select(*[F.col(f"`{c}`").alias(f"__o{i}") for i, c in enumerate(identity)], F.col("__v").alias("__w"))
        on = [mine[c].eqNullSafe(theirs[f"__o{i}"]) for i, c in enumerate(identity)]
        again = mine.join(theirs, [*on, mine["__v"].eqNullSafe(theirs["__w"])], "left_anti").drop("__v")
        dropped = old.join(made, null_safe(old, made, identity), "left_anti")
        return made, again.withColumn(GONE, F.lit(False)).unionByName(dropped.withColumn(GONE, F.lit(True)))

    def _new_mark(self, before: Manifest, joined: DataFrame) -> str | None:
        """The newest sequence less ``final_after``; it never goes back."""
        reached = joined.agg(F.max("__last").alias("at")).select(F.expr(f"CAST(at - {self.final_after} AS STRING)"))
        found = reached.first()[0]
        if found is None or before.mark is None:
            return found or before.mark
        later = F.greatest(F.lit(found).cast(self.sequence), F.lit(before.mark).cast(self.sequence)).cast("string")
        return self.spark.range(1).select(later).first()[0]

    def _sweep(self, before: Manifest, after: Manifest) -> None:
        """Remove runs that neither of the last two publications nor the change feed's last one names."""
        kept = [before, after]
        fed = newest(self.spark, f"{self.path}/{FEED}", COMMIT)
        if fed is not None:
            kept.append(self.manifest(fed))
        for store in (self.log,) if self.opts.scd_type == "1" else (self.log, self.tails, self.versions):
            names = {r.name for m in kept for r in getattr(m, store.folder)}
            store.sweep(names, lambda name: int(name[1:]) <= before.batch)

    # --- read ---

    def _rows(self, manifest: Manifest, merged: Callable[[RunStore, list[Run]], DataFrame]) -> DataFrame:
        if self.opts.scd_type == "2":
            rows = merged(self.versions, manifest.versions).where(f"NOT {GONE}")
            return rows.select(*[F.col(f"`{c}`") for c in self.stored.names], START, END)
        return cdc.live_rows(merged(self.log, manifest.log), self.keys, self.keep, self.stored, self._truncated_at(manifest))

    def read(self) -> DataFrame | None:
        """The target as last published; None before the first publication with rows."""
        manifest = self.manifest()
        if not any(r.rows for r in manifest.log + manifest.versions):
            return None
        return self._rows(manifest, lambda store, runs: store.merged(runs))

    def rejects(self) -> DataFrame:
        """Every row so far that could not be ordered, or came behind the mark, with all columns of the source."""
        if not self._has_rows(REJECTS):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{REJECTS}")

    def _truncated_at(self, manifest: Manifest):
        if not self._has_rows("truncates"):  # no batch held a truncate
            return None
        points = self.spark.read.parquet(f"{self.path}/truncates").where(F.col("batch") <= manifest.batch)
        return points.agg(F.max("at")).scalar()

    def feed(self) -> ChangeFeed:
        """The target's changes from publication to publication."""
        now = self.manifest()
        schema = self._rows(Manifest(), lambda store, _: store.read([])).schema
        return ChangeFeed(self.spark, self.path, schema, now.number if now.number >= 0 else None, self._between)

    def _between(self, a: int | None, b: int) -> DataFrame:
        before, after = Manifest() if a is None else self.manifest(a), self.manifest(b)
        if self.opts.scd_type == "1":
            store, old, new, identity = self.log, before.log, after.log, self.keys
        else:
            store, old, new, identity = self.versions, before.versions, after.versions, [*self.keys, START]
        if a is None:
            return self._rows(after, lambda store, runs: store.merged(runs)).withColumn(CHANGE, F.lit(INSERT))
        if self.opts.apply_as_truncates:
            # A truncate reaches keys that no new run names.
            return keyed_changes(*[self._rows(m, lambda store, runs: store.merged(runs)) for m in (before, after)], identity)
        # Whatever changed since is in runs that came since.
        came = store.read([r for r in new if r not in old])
        names = materialize(came.select(*[F.col(f"`{k}`") for k in self.keys]).distinct())
        return keyed_changes(*[self._rows(m, lambda store, runs: store.of_keys(runs, names)) for m in (before, after)], identity)

    # --- description ---

    def describe(self) -> None:
        """Leave what a reader needs to know beside the data."""
        told = {"schema": self.schema.jsonValue(), "options": asdict(self.opts), "buckets": self.buckets, "final_after": self.final_after}
        put_text(self.spark, f"{self.path}/description", json.dumps(told))


def open_changes(spark: SparkSession, path: str) -> ChangeTarget:
    """A change target that some stream has written."""
    told = json.loads(get_text(spark, f"{path}/description"))
    opts = ChangeOptions.of(told["options"])
    return ChangeTarget(spark, path, T.StructType.fromJson(told["schema"]), opts, told["buckets"], final_after=told.get("final_after"))


def apply_changes_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    opts: ChangeOptions,
    *,
    buckets: int = 64,
    publish_every: int = 1,
    name: str | None = None,
    available_now: bool = True,
    interval: str | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
    final_after: str | None = None,
) -> tuple[StreamingQuery, ChangeTarget]:
    """Start the stream. With ``publish_every`` > 1 call ``target.publish()`` once the query has ended."""
    target = ChangeTarget(stream.sparkSession, path, stream.schema, opts, buckets, hot_key_rows, final_after)

    target.describe()
    target.publish()  # what a run before this one logged and did not publish

    def handle(batch: DataFrame, batch_id: int) -> None:
        target.absorb(batch, batch_id)
        if batch_id % publish_every == publish_every - 1:
            target.publish()

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name or opts.flow_name:
        writer = writer.queryName(name or opts.flow_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval or "0 seconds")
    return writer.start(), target
