"""Source and sink queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.catalogue.changes import LATEST_SQL
from tierflow.catalogue.shared import load, query, stream, work_dir
from tierflow.operators.cdc import apply_changes
from tierflow.operators.messages import add_seed_rows
from tierflow.operators.project import align, project_then_filter, typed_null
from tierflow.operators.quality import apply_quality, resolve_rules
from tierflow.sources.files import FileSource, infer_schema, read_files, rescue, union_files
from tierflow.sources.schemas import ddl_schema
from tierflow.sources.storage import read_published
from tierflow.sources.tables import read_path, read_table, snapshot_series
from tierflow.streaming.sinks import (
    AppendFlow,
    FanOutTarget,
    Layout,
    append_batch,
    append_stream,
    checked_stream,
    create_table,
    fan_out,
    fan_out_stream,
    overwrite_merging,
    read_checked,
    read_flows,
    run_append_flows,
)

# --- scans --------------------------------------------------------------------------------------


@query(
    "file_scan_project_filter",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_returnflag AS flag
    FROM lineitem WHERE l_returnflag = 'R' AND l_extendedprice * (1 - l_discount) > 20000 AND l_orderkey > 100""",
)
def file_scan_project_filter(spark, sf):
    return project_then_filter(
        read_files(spark, FileSource(f"{sf}/lineitem.parquet", "parquet")),
        ["l_orderkey", "l_linenumber", "l_extendedprice * (1 - l_discount) AS net", "l_returnflag AS flag"],
        ["flag = 'R'", "net > 20000", "", "l_orderkey > 100"],
    )


_ORDER_DDL = "o_orderkey bigint, o_custkey: bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


@query(
    "file_formats_scan",
    "SELECT format, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, count(DISTINCT o_orderpriority) AS priorities FROM orders, (VALUES ('csv'), ('json'), ('parquet'), ('orc')) f(format) GROUP BY format",
)
def file_formats_scan(spark, sf):
    """The orders written in each format and read back with a schema from a DDL file."""
    folder = work_dir(spark, "formats")
    spark.createDataFrame([(_ORDER_DDL,)], "value string").coalesce(1).write.text(f"{folder}/ddl")
    schema = ddl_schema(spark, f"{folder}/ddl")
    orders = load(spark, sf, "orders").select(*schema.fieldNames())
    out = None
    for fmt in ("csv", "json", "parquet", "orc"):
        options = {"header": "true"} if fmt == "csv" else {}
        orders.write.format(fmt).options(**options).save(f"{folder}/{fmt}")
        part = read_files(spark, FileSource(f"{folder}/{fmt}", fmt, options, schema)).agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.count_distinct("o_orderpriority").alias("priorities")
        ).select(F.lit(fmt).alias("format"), "n", "keys", "priorities")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "union_file_reads",
    "SELECT c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier",
)
def union_file_reads(spark, sf):
    folder = work_dir(spark, "union")
    load(spark, sf, "customer").selectExpr("c_custkey AS key", "c_acctbal AS balance", "c_mktsegment AS segment").write.parquet(f"{folder}/a")
    load(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_acctbal AS balance").write.parquet(f"{folder}/b")
    return union_files(spark, [FileSource(f"{folder}/a", "parquet"), FileSource(f"{folder}/b", "parquet")])


@query("incremental_ingest", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def incremental_ingest(spark, sf):
    """JSON files arrive in two rounds; each run takes up the files the last one has not seen."""
    folder = work_dir(spark, "ingest")
    events = load(spark, sf, "events")
    source = FileSource(
        f"{folder}/in", "cloudFiles",
        {"cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true", "cloudFiles.maxFilesPerTrigger": "2"},
    )
    for half in (0, 1):
        events.where(F.col("event_id") % 2 == half).select("event_id", "event_type", "user_id").write.mode("append").json(f"{folder}/in")
        feed = read_files(spark, source, streaming=True)
        append_stream(feed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


# Some texts carry a field the schema lacks, some a user that is no number, some are cut.
_LINE = """CASE WHEN event_id % 11 = 0 THEN left(line, length(line) - 2) ELSE line END"""
_RAW_LINE = """concat('{"id":', CAST(event_id AS STRING), ',"user":', CASE WHEN event_id % 5 = 0 THEN '"u' || CAST(user_id AS STRING) || '"' ELSE CAST(user_id AS STRING) END,
    CASE WHEN event_id % 3 = 0 THEN ',"more":"x' || CAST(event_id AS STRING) || '"' ELSE '' END, '}')"""


@query(
    "rescued_data",
    f"""
    WITH l AS (SELECT event_id, {_LINE} AS line FROM (SELECT event_id, {_RAW_LINE.replace('STRING', 'VARCHAR')} AS line, user_id FROM events)),
    j AS (SELECT event_id, line, event_id % 11 <> 0 AS ok FROM l)
    SELECT event_id, CASE WHEN ok THEN CAST(json_extract_string(line, '$.id') AS BIGINT) END AS id,
      CASE WHEN ok THEN TRY_CAST(json_extract_string(line, '$.user') AS BIGINT) END AS user,
      CASE WHEN NOT ok THEN line END AS whole,
      CASE WHEN ok AND event_id % 3 = 0 THEN 'x' || event_id END AS more,
      CASE WHEN ok AND event_id % 5 = 0 THEN json_extract_string(line, '$.user') END AS odd_user
    FROM j""",
    nullable=("id", "user"),
)
def rescued_data(spark, sf):
    lines = load(spark, sf, "events").select("event_id", F.expr(_RAW_LINE).alias("line"))
    lines = lines.select("event_id", F.expr(_LINE).alias("line"))
    schema = T.StructType.fromDDL("id bigint, user bigint")
    out = rescue(lines, "line", schema, "_rescued_data", keep=["event_id"])
    bad = F.col("id").isNull()
    left_over = F.when(~bad, F.col("_rescued_data"))
    return out.select(
        "event_id", "id", "user", F.when(bad, F.col("_rescued_data")).alias("whole"),
        F.get_json_object(left_over, "$.more").alias("more"), F.get_json_object(left_over, "$.user").alias("odd_user"),
    )


@query("file_metadata_cols", "SELECT event_id, 'events.parquet' AS input_file_name, true AS sized, true AS stamped FROM events")
def file_metadata_cols(spark, sf):
    section = {
        "include_autoloader_metadata_column": "True",
        "autoloader_metadata_col_name": "source_metadata",
        "select_metadata_cols": {"input_file_name": "_metadata.file_name"},
    }
    df = read_files(spark, FileSource(f"{sf}/events.parquet", "parquet", metadata=section, ingestion_time=True))
    return df.selectExpr(
        "event_id", "input_file_name", "source_metadata.file_size > 0 AS sized", "ingestion_timestamp IS NOT NULL AS stamped"
    )


@query("inferred_schema_scan", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def inferred_schema_scan(spark, sf):
    folder = work_dir(spark, "infer")
    load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal").write.json(folder)
    source = FileSource(folder, "cloudFiles", {"cloudFiles.format": "json", "cloudFiles.inferColumnTypes": "true"})
    schema = infer_schema(spark, source)
    return read_files(spark, FileSource(folder, "json", schema=schema))


@query("snapshot_source", "SELECT r.v AS version, count(*) AS n FROM orders JOIN (VALUES (1), (2), (3)) r(v) ON CAST(left(o_orderpriority, 1) AS INT) >= r.v GROUP BY r.v")
def snapshot_source(spark, sf):
    """Snapshots handed out by a callback until it has no more."""
    orders = load(spark, sf, "orders")

    def following(latest):
        version = (latest or 0) + 1
        urgent = F.left("o_orderpriority", F.lit(1)).cast("int") >= version
        return (orders.where(urgent), version) if version <= 3 else None

    out = None
    for df, version in snapshot_series(following):
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(version).alias("version"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "seed_rows",
    "SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT 999, 'dummy', NULL",
    nullable=("n_regionkey",),
)
def seed_rows(spark, sf):
    return add_seed_rows(load(spark, sf, "nation"), [{"n_nationkey": 999, "n_name": "dummy"}])


@query(
    "missing_columns_as_null",
    "SELECT s_suppkey, CAST(s_acctbal AS DOUBLE) AS s_acctbal, CAST(NULL AS VARCHAR) AS s_comment FROM supplier",
)
def missing_columns_as_null(spark, sf):
    return align(load(spark, sf, "supplier"), T.StructType.fromDDL("s_suppkey bigint, s_acctbal double, s_comment string"))


@query(
    "table_stream_scan",
    "SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_acctbal > 0",
)
def table_stream_scan(spark, sf):
    """A table with properties is created, filled, and read as a stream by name."""
    folder = work_dir(spark, "catalog")
    name = f"suppliers_{folder[-8:]}"
    source = load(spark, sf, "supplier")
    layout = Layout(cluster_by=["s_nationkey"], properties={"quality": "bronze", "vendor.retention": "interval 30 days"})
    create_table(spark, name, source.schema, layout, f"{folder}/table", "suppliers, clustered")
    append_batch(source, f"{folder}/table", layout)
    feed = read_table(spark, name, {"maxFilesPerTrigger": "4"}).where("s_acctbal > 0").select("s_suppkey", "s_name", "s_nationkey")
    append_stream(feed, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


# --- sinks and streams --------------------------------------------------------------------------


@query("stream_append", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_append(spark, sf):
    folder = work_dir(spark, "append")
    append_stream(stream(spark, sf, "events"), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return read_path(spark, f"{folder}/out", streaming=False)


@query("stream_table_chain", "SELECT event_id, value * 2 AS doubled FROM events WHERE event_type = 'purchase'")
def stream_table_chain(spark, sf):
    """A second stream reads the table the first one writes."""
    folder = work_dir(spark, "chain")
    append_stream(stream(spark, sf, "events"), f"{folder}/bronze", f"{folder}/c1").awaitTermination()
    shaped = project_then_filter(
        read_path(spark, f"{folder}/bronze"), ["event_id", "value * 2 AS doubled", "event_type"], ["event_type = 'purchase'"]
    ).drop("event_type")
    append_stream(shaped, f"{folder}/silver", f"{folder}/c2").awaitTermination()
    return spark.read.parquet(f"{folder}/silver")


@query("stream_union", "SELECT event_id, event_type FROM events WHERE event_type = 'click' UNION ALL SELECT event_id, event_type FROM events WHERE value > 100")
def stream_union(spark, sf):
    folder = work_dir(spark, "stream-union")
    clicks = stream(spark, sf, "events").where("event_type = 'click'").select("event_id", "event_type")
    large = stream(spark, sf, "events").where("value > 100").select("event_id", "event_type")
    append_stream(clicks.union(large), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query(
    "stream_static_enrich",
    "SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment FROM events e LEFT JOIN customer c ON e.user_id * 3 = c.c_custkey",
)
def stream_static_enrich(spark, sf):
    folder = work_dir(spark, "enrich")
    customers = load(spark, sf, "customer")
    feed = stream(spark, sf, "events")
    joined = feed.join(customers, F.col("user_id") * 3 == customers["c_custkey"], "left")
    append_stream(
        joined.select("event_id", "user_id", "c_name", "c_mktsegment"), f"{folder}/out", f"{folder}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query(
    "stream_quarantine",
    """
    SELECT 'main' AS route, event_id FROM events WHERE event_type <> 'error'
    UNION ALL SELECT 'quarantine', event_id FROM events WHERE event_type = 'error' OR value > 200""",
)
def stream_quarantine(spark, sf):
    folder = work_dir(spark, "stream-quarantine")
    rules = resolve_rules(
        {
            "expect_or_drop": {"no_error": "event_type <> 'error'"},
            "expect_or_fail": {"has_id": "event_id IS NOT NULL"},
            "expect_or_quarantine": {"bad": "event_type = 'error' OR value > 200"},
        }
    )
    checked_stream(stream(spark, sf, "events"), rules, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    sides = [read_checked(spark, f"{folder}/out", r).select(F.lit(r).alias("route"), "event_id") for r in ("main", "quarantine")]
    return sides[0].unionByName(sides[1])


@query("partitioned_write", "SELECT o_orderstatus, o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def partitioned_write(spark, sf):
    path = work_dir(spark, "partitioned")
    append_batch(load(spark, sf, "orders"), path, Layout(partition_by=["o_orderstatus"]))
    return spark.read.parquet(path).where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey")


@query("clustered_write", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey BETWEEN 100 AND 900")
def clustered_write(spark, sf):
    path = work_dir(spark, "clustered")
    append_batch(load(spark, sf, "lineitem"), path, Layout(cluster_by=["l_orderkey"]))
    return spark.read.parquet(path).where("l_orderkey BETWEEN 100 AND 900").select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "overwrite_schema_merge",
    "SELECT p_partkey, CAST(NULL AS VARCHAR) AS p_name, CAST(NULL AS VARCHAR) AS p_brand, p_size * 2 AS p_double FROM part",
)
def overwrite_schema_merge(spark, sf):
    path = work_dir(spark, "overwrite")
    part = load(spark, sf, "part")
    overwrite_merging(part.select("p_partkey", "p_name", "p_brand"), path)
    overwrite_merging(part.selectExpr("p_partkey", "p_size * 2 AS p_double"), path)
    return read_published(spark, path)


@query(
    "append_flows",
    """
    SELECT c_custkey AS key, c_name AS name, 'customer' AS origin FROM customer
    UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""",
)
def append_flows(spark, sf):
    """Two flows into one target; the one-time flow does not run a second time."""
    folder = work_dir(spark, "flows")
    flows = [
        AppendFlow("customers", "parquet", {"path": f"{sf}/customer.parquet"}),
        AppendFlow("suppliers", "parquet", {"path": f"{sf}/supplier.parquet"}, once=True),
    ]

    def read(flow: AppendFlow) -> DataFrame:
        letter = flow.name[0]
        key = "custkey" if letter == "c" else "suppkey"
        return stream(spark, sf, flow.name[:-1]).selectExpr(
            f"{letter}_{key} AS key", f"{letter}_name AS name", f"'{flow.name[:-1]}' AS origin"
        )

    for _ in range(2):
        run_append_flows(spark, flows, read, f"{folder}/out", f"{folder}/checkpoints")
    return read_flows(spark, f"{folder}/out", ["customers", "suppliers"])


TARGETS = [
    FanOutTarget("clicks", ["event_id", "user_id", "event_type"], ["event_type = 'click'"]),
    FanOutTarget("purchases", ["event_id", "value * 2 AS amount", "event_type"], ["event_type = 'purchase'", "amount > 20"]),
]
_FANOUT_SQL = """
    SELECT 'clicks' AS target, event_id, CAST(NULL AS DOUBLE) AS amount FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'purchases', event_id, value * 2 FROM events WHERE event_type = 'purchase' AND value * 2 > 20"""


def _fanned(frames: dict[str, DataFrame]) -> DataFrame:
    left = frames["clicks"].select(F.lit("clicks").alias("target"), "event_id", typed_null("double").alias("amount"))
    return left.unionByName(frames["purchases"].select(F.lit("purchases").alias("target"), "event_id", "amount"))


@query("fanout", _FANOUT_SQL)
def fanout(spark, sf):
    return _fanned(fan_out(load(spark, sf, "events"), TARGETS))


@query("stream_fanout", _FANOUT_SQL)
def stream_fanout(spark, sf):
    folder = work_dir(spark, "fanout")
    fan_out_stream(stream(spark, sf, "events"), TARGETS, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return _fanned({t.name: spark.read.parquet(f"{folder}/out/{t.name}") for t in TARGETS})


# --- one flow end to end ------------------------------------------------------------------------


@query(
    "bronze_to_silver_changes",
    f"""
    SELECT user_id, upper(event_type) AS kind, value FROM ({LATEST_SQL.replace('FROM events', "FROM events WHERE user_id IS NOT NULL AND value < 450")})
    WHERE event_type <> 'error'""",
)
def bronze_to_silver_changes(spark: SparkSession, sf: str) -> DataFrame:
    rules = resolve_rules(
        {
            "expect": {"priced": "value > 0"},
            "expect_or_drop": {"has_user": "user_id IS NOT NULL", "sane": "value < 450"},
            "expect_or_quarantine": {"odd": "user_id IS NULL OR value >= 450"},
        }
    )
    bronze = apply_quality(read_files(spark, FileSource(f"{sf}/events.parquet", "parquet")), rules, "bronze_events").main
    silver = project_then_filter(
        bronze, ["user_id", "event_id", "ts", "event_type", "upper(event_type) AS kind", "value"], ["event_id IS NOT NULL"]
    )
    return apply_changes(
        silver, ["user_id"], "struct(ts, event_id)", apply_as_deletes="event_type = 'error'",
        except_column_list=["event_id", "ts", "event_type"],
    )
