"""Table sinks, batch and streaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators.curve import with_curve_place
from tierflow.operators.project import where_all
from tierflow.operators.quality import ROUTE, RuleSet, expect, route_rows
from tierflow.sources.storage import exists, publish, read_published, touch
from tierflow.sources.tables import read_path

ZORDER_PROPERTY = "pipelines.autoOptimize.zOrderCols"


def column_names(value: str | list[str] | None) -> list[str] | None:
    """Column list of a metadata entry: comma text is split, blanks go, nothing left means None."""
    if not value:
        return None
    parts = value.split(",") if isinstance(value, str) else value
    names = [p.strip() for p in parts if p and p.strip()]
    return names or None


@dataclass(frozen=True)
class Layout:
    partition_by: list[str] | None = None
    cluster_by: list[str] | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.cluster_by and self.properties.get(ZORDER_PROPERTY):
            raise ValueError("cluster columns and z-order columns exclude each other")

    def arrange(self, df: DataFrame) -> DataFrame:
        """Order rows for the write.

        Cluster columns: range partitions, sorted, which gives files narrow min/max ranges; several columns by their place on
        a space-filling curve, which gives narrow ranges in each of them. The number of
        the input partition breaks ties, so that the rows of one frequent value (copies included) spread
        over many tasks; unlike a random number it is the same when a lost task runs again.
        Partition columns alone: rows of a partition come together, large partitions stay split.
        """
        if df.isStreaming:
            return df
        if self.cluster_by:
            tied, order = df.withColumn("__tie", F.spark_partition_id()), self.cluster_by
            if len(order) > 1:
                tied, order = with_curve_place(tied, self.cluster_by, "__place"), ["__place"]
            ranged = tied.repartitionByRange(*order, "__tie")
            return ranged.sortWithinPartitions(*(self.partition_by or []), *order).drop("__tie", "__place")
        if self.partition_by:
            return df.hint("rebalance", *[F.col(c) for c in self.partition_by])
        return df


def create_table(spark: SparkSession, name: str, schema, layout: Layout, path: str | None = None, comment: str = "") -> None:
    """Register an empty parquet table unless it is there; properties are kept as text."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"]
    if layout.partition_by:
        parts.append(f"PARTITIONED BY ({', '.join(f'`{c}`' for c in layout.partition_by)})")
    elif layout.cluster_by:
        parts.append(f"CLUSTER BY ({', '.join(f'`{c}`' for c in layout.cluster_by)})")
    if path:
        parts.append(f"LOCATION '{path}'")
    if comment:
        parts.append("COMMENT '" + comment.replace("'", "\\'") + "'")
    if layout.properties:
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in layout.properties.items())
        parts.append(f"TBLPROPERTIES ({listed})")
    spark.sql(" ".join(parts))


def append_batch(df: DataFrame, path: str, layout: Layout = Layout()) -> None:
    writer = layout.arrange(df).write.mode("append")
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer.parquet(path)


def replace_batch(df: DataFrame, path: str, layout: Layout = Layout()) -> int:
    """A full recompute: the rows become the table's next version, so running again changes nothing."""
    return publish(layout.arrange(df), path, layout.partition_by)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, layout: Layout = Layout(), name: str | None = None,
    available_now: bool = True, interval: str | None = None,
) -> StreamingQuery:
    """Exactly-once append of a stream to a parquet directory."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval or "0 seconds")
    return writer.start(path)


def overwrite_merging(df: DataFrame, path: str) -> int:
    """Replace a table's rows; columns only the older version has stay, as NULL."""
    spark = df.sparkSession
    try:
        older = read_published(spark, path).where("false")
    except FileNotFoundError:
        return publish(df, path)
    return publish(older.unionByName(df, allowMissingColumns=True), path)


# --- checked tables: main and quarantine from one pass ------------------------------------------


def write_checked(df: DataFrame, rules: RuleSet, path: str, layout: Layout = Layout()) -> dict[str, int]:
    """Main and quarantine rows as one version: both appear together, or neither when a rule fails.

    Both lie in the layout's partitions and order, below their route.

    Returns the violation counts of the same pass.
    """
    seen = None
    if rules.counted:
        df, seen = expect(df, rules.counted, "checked")
    routed = Layout([ROUTE, *(layout.partition_by or [])], layout.cluster_by)
    replace_batch(route_rows(df, rules), path, routed)
    return seen.get if seen else {}


def read_route(spark: SparkSession, path: str, route: str) -> DataFrame:
    return read_published(spark, path).where(F.col(ROUTE) == route).drop(ROUTE)


def checked_stream(
    df: DataFrame, rules: RuleSet, path: str, checkpoint: str, layout: Layout = Layout(), name: str | None = None
) -> StreamingQuery:
    """Streaming form: one query and one exactly-once sink for both kinds of rows.

    The progress reports the violation counts under ``name``, or ``checked``.
    """
    routed = Layout([ROUTE, *(layout.partition_by or [])])
    if rules.counted:
        df, _ = expect(df, rules.counted, name or "checked")
    return append_stream(route_rows(df, rules), path, checkpoint, routed, name)


def read_checked(spark: SparkSession, path: str, route: str, streaming: bool = False, options: dict | None = None) -> DataFrame:
    df = read_path(spark, path, streaming, options=options)
    return df.where(F.col(ROUTE) == route).drop(ROUTE)


# --- append flows ------------------------------------------------------------------------------


@dataclass(frozen=True)
class AppendFlow:
    """An extra source that appends to an existing target."""

    name: str
    source_format: str
    source_details: dict
    create_streaming_table: bool = False
    comment: str | None = None
    reader_options: dict = field(default_factory=dict)
    spark_conf: dict = field(default_factory=dict)
    once: bool = False

    @classmethod
    def of(cls, mapping: dict) -> "AppendFlow":
        missing = [
            k for k in ("name", "source_format", "create_streaming_table", "source_details") if mapping.get(k) is None
        ]
        if missing:
            raise ValueError(f"append flow lacks mandatory {missing}")
        known = {k: v for k, v in mapping.items() if k in cls.__dataclass_fields__ and v is not None}
        for flag in ("create_streaming_table", "once"):
            known[flag] = str(known.get(flag, "false")).lower() == "true"
        return cls(**known)


def union_flows(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def run_append_flows(
    spark: SparkSession,
    flows: list[AppendFlow],
    read: Callable[[AppendFlow], DataFrame],
    path: str,
    checkpoints: str,
    layout: Layout = Layout(),
) -> list[str]:
    """Run each flow to the end of its present input, all into one directory; returns the flows that ran.

    A flow has its own checkpoint. A ``once`` flow leaves a mark and never runs again.
    """
    ran = []
    for flow in flows:
        mark = f"{checkpoints}/{flow.name}.done"
        if flow.once and exists(spark, mark):
            continue
        before = {k: spark.conf.get(k, None) for k in flow.spark_conf}
        for key, value in flow.spark_conf.items():
            spark.conf.set(key, value)
        try:
            # One directory per flow: the streaming file sink keeps one commit log per directory.
            append_stream(
                read(flow), f"{path}/flow={flow.name}", f"{checkpoints}/{flow.name}", layout, flow.name
            ).awaitTermination()
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
        if flow.once:
            touch(spark, mark)
        ran.append(flow.name)
    return ran


def read_flows(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    return union_flows([spark.read.parquet(f"{path}/flow={n}") for n in names])


# --- fan-out -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class FanOutTarget:
    name: str
    select_exp: list[str] | None = None
    where_clause: list[str] | None = None


def fan_out(df: DataFrame, targets: list[FanOutTarget]) -> dict[str, DataFrame]:
    """One source, several targets, each with its own projection and predicate (pushed to its scan)."""
    return {
        t.name: where_all(df.selectExpr(*t.select_exp) if t.select_exp else df, t.where_clause) for t in targets
    }


def fan_out_stream(
    df: DataFrame, targets: list[FanOutTarget], path: str, checkpoint: str
) -> StreamingQuery:
    """One read of the stream feeds all targets; the micro-batch is held while they are written."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, rows in fan_out(batch, targets).items():
                rows.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
