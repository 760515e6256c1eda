"""Spec-table queries over flows described by the given tables, and whole-layer runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.catalogue.changes import LATEST_SQL
from tierflow.catalogue.records import BODY_DDL, records
from tierflow.catalogue.shared import load, query, stream, work_dir
from tierflow.functions.crypto import Cipher
from tierflow.operators.project import align, pinned, spread
from tierflow.plans.medallion import Hooks, MedallionRun
from tierflow.plans.onboarding import (
    add_audit_columns,
    attach_transforms,
    bronze_rows,
    gold_rows,
    silver_rows,
    store_specs,
    with_layer,
)
from tierflow.plans.specs import BronzeSpec, GoldSpec, SilverSpec, latest_specs, spec_schema
from tierflow.sources.schemas import ddl_schema
from tierflow.sources.storage import read_published
from tierflow.sources.tables import for_environment

# One flow per part: every fifth has no bronze section, odd ones use the flat key layout.
_FLOW = """named_struct(
    'data_flow_id', CAST(p_partkey AS STRING), 'data_flow_group', p_brand, 'source_format', CASE WHEN p_size % 2 = 0 THEN 'csv' ELSE 'parquet' END,
    'source_details_dev', named_struct('source_path_dev', concat('/in/', p_partkey), 'source_path_prd', '/prd'),
    'bronze_reader_options', named_struct('header', 'true'),
    'bronze_dev', CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 2 = 0 THEN named_struct(
        'target_details', named_struct('catalog', 'lake', 'schema', 'raw', 'table', concat('t', p_partkey), 'path', ''),
        'partition_columns', 'a, b', 'cluster_by', array('k'), 'bronze_table_properties', named_struct('quality', 'bronze', 'none', CAST(NULL AS STRING)),
        'cdc_apply_changes', named_struct('keys', array('id'), 'sequence_by', 'ts', 'scd_type', CAST(1 + p_size % 2 AS STRING))) END,
    'bronze_table', CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 2 = 1 THEN concat('t', p_partkey) END,
    'bronze_database_dev', CASE WHEN p_partkey % 2 = 1 THEN 'flat' END,
    'bronze_table_path_dev', CASE WHEN p_partkey % 2 = 1 THEN concat('/out/', p_partkey) END,
    'silver_dev', CASE WHEN p_partkey % 3 = 0 AND p_partkey % 10 = 2 THEN named_struct('target_details', named_struct('catalog', 'lake', 'schema', 'fine', 'table', concat('s', p_partkey))) END,
    'gold_dev', CASE WHEN p_partkey % 4 = 0 THEN named_struct('target_details', named_struct('catalog', 'lake', 'schema', 'gold', 'table', concat('g', p_partkey)), 'is_streaming', 'True') END)"""


def _flows(spark: SparkSession, sf: str) -> DataFrame:
    parts = spread(load(spark, sf, "part").select("p_partkey", "p_brand", "p_size"))
    return pinned(parts, v=F.parse_json(F.to_json(F.expr(_FLOW)))).select("v")


@query("spec_layer_rows", "SELECT 'bronze' AS layer, count(*) AS n FROM part WHERE p_partkey % 5 <> 0 UNION ALL SELECT 'gold', count(*) FROM part WHERE p_partkey % 4 = 0")
def spec_layer_rows(spark, sf):
    flows = _flows(spark, sf)
    parts = [
        with_layer(flows, layer, "dev").agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), "n")
        for layer in ("bronze", "gold")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "spec_bronze_rows",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS grp, CASE WHEN p_size % 2 = 0 THEN 'csv' ELSE 'parquet' END AS format, '/in/' || p_partkey AS path,
      CASE WHEN p_partkey % 2 = 0 THEN 'lake.raw' ELSE 'flat' END AS db, 't' || p_partkey AS tbl, CASE WHEN p_partkey % 2 = 1 THEN '/out/' || p_partkey END AS target_path,
      CASE WHEN p_partkey % 2 = 0 THEN 'a|b' END AS partitions, CASE WHEN p_partkey % 2 = 0 THEN 'k' END AS clusters,
      CASE WHEN p_partkey % 2 = 0 THEN CAST(1 + p_size % 2 AS VARCHAR) END AS scd_type, CAST(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS INT) AS n_properties
    FROM part WHERE p_partkey % 5 <> 0""",
)
def spec_bronze_rows(spark, sf):
    return bronze_rows(_flows(spark, sf), "dev").selectExpr(
        "dataFlowId AS id", "dataFlowGroup AS grp", "sourceFormat AS format", "sourceDetails['path'] AS path",
        "targetDetails['database'] AS db", "targetDetails['table'] AS tbl", "targetDetails['path'] AS target_path",
        "array_join(partitionColumns, '|') AS partitions", "array_join(clusterBy, '|') AS clusters",
        "get_json_object(cdcApplyChanges, '$.scd_type') AS scd_type", "size(tableProperties) AS n_properties",
    )


@query(
    "spec_transform_join",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, 's' || p_partkey AS tbl, 'lake.raw' AS source_db, 't' || p_partkey AS source_table, 'x' || p_partkey AS first_expr, 'y' AS predicate
    FROM part WHERE p_partkey % 3 = 0 AND p_partkey % 10 = 2""",
)
def spec_transform_join(spark, sf):
    rows = silver_rows(_flows(spark, sf), "dev").drop("selectExp", "whereClause")
    texts = load(spark, sf, "part").selectExpr(
        "concat('s', p_partkey) AS target_table", "array(concat('x', p_partkey)) AS selectExp", "array('y') AS whereClause"
    )
    joined = attach_transforms(rows, texts)
    return joined.selectExpr(
        "dataFlowId AS id", "targetDetails['table'] AS tbl", "sourceDetails['database'] AS source_db",
        "sourceDetails['table'] AS source_table", "selectExp[0] AS first_expr", "whereClause[0] AS predicate",
    )


@query("spec_gold_rows", "SELECT CAST(p_partkey AS VARCHAR) AS id, 'lake.gold' AS db, 'g' || p_partkey AS tbl, 'true' AS streaming, 'dev' AS env FROM part WHERE p_partkey % 4 = 0")
def spec_gold_rows(spark, sf):
    return gold_rows(_flows(spark, sf), "dev").selectExpr(
        "dataFlowId AS id", "targetDetails['database'] AS db", "targetDetails['table'] AS tbl", "isStreaming AS streaming", "env"
    )


def _versioned(spark: SparkSession, sf: str, version: str, author: str, keep: str) -> DataFrame:
    rows = bronze_rows(_flows(spark, sf), "dev").where(keep)
    clock = F.lit(f"2024-01-0{version[-1]} 00:00:00").cast("timestamp")
    return align(add_audit_columns(rows, version, author, clock), spec_schema("bronze"))


@query(
    "spec_merge",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN 'v2' ELSE 'v1' END AS version,
      CASE WHEN p_partkey % 7 <> 0 THEN 'ann' ELSE 'bob' END AS created_by, CASE WHEN p_partkey % 3 = 0 THEN 'bob' ELSE 'ann' END AS updated_by,
      CASE WHEN p_partkey % 7 <> 0 THEN 1 ELSE 2 END AS created_day
    FROM part WHERE p_partkey % 5 <> 0 AND (p_partkey % 7 <> 0 OR p_partkey % 3 = 0)""",
)
def spec_merge(spark, sf):
    """A second onboarding updates every third flow and adds some; creation columns stay."""
    path = work_dir(spark, "specs")
    store_specs(_versioned(spark, sf, "v1", "ann", "dataFlowId % 7 <> 0"), path)
    store_specs(_versioned(spark, sf, "v2", "bob", "dataFlowId % 3 = 0"), path, overwrite=False)
    return read_published(spark, path).selectExpr(
        "dataFlowId AS id", "version", "createdBy AS created_by", "updatedBy AS updated_by", "day(createDate) AS created_day"
    )


@query(
    "spec_latest",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 3 = 0 THEN 'v10' ELSE 'v2' END AS version FROM part
    WHERE p_partkey % 5 <> 0 AND p_brand = 'Brand#2'""",
)
def spec_latest(spark, sf):
    """Version v10 is later than v2; the table lacks columns of newer spec layouts."""
    older = _versioned(spark, sf, "v2", "ann", "true").drop("metadata", "description")
    newer = older.where("dataFlowId % 3 = 0").withColumn("version", F.lit("v10"))
    return latest_specs(older.unionByName(newer), "bronze", group="Brand#2").selectExpr("dataFlowId AS id", "version")


@query("environment_source", "SELECT s_suppkey AS key FROM supplier")
def environment_source(spark, sf):
    entry = {"source_table_dev": "supplier", "source_table_prd": "customer"}
    return load(spark, sf, for_environment(entry, "source_table", "dev")).select(F.col("s_suppkey").alias("key"))


# --- whole runs ---------------------------------------------------------------------------------

_CIPHER = Cipher("0123456789abcdef")
_RULES = json.dumps(
    {
        "expect": {"priced": "value > 0"},
        "expect_or_drop": {"has_user": "user_id IS NOT NULL"},
        "expect_or_quarantine": {"large": "value > 300"},
    }
)


def _details(name: str) -> dict:
    database, table = name.split(".")
    return {"database": database, "table": table}


def _specs(sf: str, streaming: bool) -> dict:
    common = {"dataFlowGroup": "g", "isStreaming": str(streaming).lower()}
    bronze = [
        BronzeSpec(
            "1", targetDetails=_details("raw.events"), sourceFormat="parquet", sourceDetails={"path": f"{sf}/events.parquet*"},
            readerConfigOptions={}, dataQualityExpectations=_RULES, targetPiiFields={"props": "string"}, **common,
        ),
        BronzeSpec(
            "2", targetDetails=_details("raw.customers"), sourceFormat="parquet", sourceDetails={"path": f"{sf}/customer.parquet*"},
            readerConfigOptions={}, **common,
        ),
    ]
    silver = [
        SilverSpec(
            "1", targetDetails=_details("fine.users"), sourceDetails=_details("raw.events"), targetPiiFields={"props": "string"},
            selectExp=["user_id", "event_id", "ts", "event_type", "value", "get_json_object(props, '$.k') AS k", "props"],
            whereClause=["value < 400"],
            cdcApplyChanges=json.dumps(
                {"keys": ["user_id"], "sequence_by": "struct(ts, event_id)", "scd_type": "1", "apply_as_deletes": "event_type = 'error'", "except_column_list": ["ts"]}
            ),
            **common,
        )
    ]
    gold = [
        GoldSpec(
            "1", targetDetails=_details("mart.by_segment"), env="dev", **{**common, "isStreaming": "false"},
            sources=[
                {"reference_name": "users_vw", "source_table": "fine.users", "filter_condition": "k IS NOT NULL", "is_streaming": "false", "pii_fields": {}},
                {"reference_name": "people_vw", "source_table": "raw.customers", "filter_condition": "", "is_streaming": "false", "pii_fields": {}},
            ],
            views=[
                {"reference_name": "enriched_vw", "sql_condition": "SELECT u.*, p.c_mktsegment FROM live.users_vw u LEFT JOIN live.people_vw p ON u.user_id = p.c_custkey"},
                {"reference_name": "segments_vw", "sql_condition": "SELECT c_mktsegment, count(DISTINCT user_id) AS users, CAST(sum(CAST(value AS DECIMAL(22,2))) AS DOUBLE) AS amount FROM live.enriched_vw GROUP BY c_mktsegment"},
            ],
        ),
        GoldSpec(
            "2", targetDetails=_details("mart.segment_names"), env="dev", **{**common, "isStreaming": "false"}, sources=[],
            views=[{"reference_name": "names_vw", "sql_condition": "SELECT c_mktsegment FROM mart.by_segment"}],
        ),
    ]
    return {"bronze": bronze, "silver": silver, "gold": gold}


_USERS_SQL = f"""({LATEST_SQL.replace('FROM events', 'FROM events WHERE user_id IS NOT NULL AND value < 400')} AND event_type <> 'error')"""
_RUN_SQL = f"""
    SELECT c_mktsegment, count(DISTINCT user_id) AS users, CAST(sum(CAST(value AS DECIMAL(22,2))) AS DOUBLE) AS amount
    FROM {_USERS_SQL} u LEFT JOIN customer ON user_id = c_custkey GROUP BY c_mktsegment"""


def _run(spark, sf, streaming: bool) -> tuple[MedallionRun, dict]:
    run = MedallionRun(spark, work_dir(spark, "layers"), cipher=_CIPHER, buckets=4)
    specs = _specs(sf, streaming)
    run.run("bronze_silver_gold", specs)
    return run, specs


@query("layers_batch", _RUN_SQL)
def layers_batch(spark, sf):
    run, specs = _run(spark, sf, streaming=False)
    return run.read(specs["gold"][0])


@query("layers_batch_rerun", _RUN_SQL)
def layers_batch_rerun(spark, sf):
    """A second run over the same input leaves the same rows, in every layer."""
    run, specs = _run(spark, sf, streaming=False)
    before = {s.table: run.read(s).count() for layer in specs.values() for s in layer}
    run.run("bronze_silver_gold", specs)
    after = {s.table: run.read(s).count() for layer in specs.values() for s in layer}
    if before != after:
        raise AssertionError(f"a second run changed the tables: {before} became {after}")
    return run.read(specs["gold"][0])


@query("dq_partitioned", "SELECT event_id, event_type, value FROM events WHERE user_id IS NOT NULL")
def dq_partitioned(spark, sf):
    """A checked target in partitions: the folders of a type hold exactly its rows."""
    run, spec = _partitioned(spark, sf)
    folder = run.path(spec.targetDetails)
    return spark.read.parquet(f"{folder}/v=1/__route=main").select("event_id", "event_type", "value")


@query("quarantine_partitioned", "SELECT event_id, event_type, value FROM events WHERE value > 300")
def quarantine_partitioned(spark, sf):
    run, spec = _partitioned(spark, sf)
    folder = run.path(spec.targetDetails)
    return spark.read.parquet(f"{folder}/v=1/__route=quarantine").select("event_id", "event_type", "value")


def _partitioned(spark, sf):
    spec = BronzeSpec(
        "1", "g", targetDetails=_details("raw.events"), sourceFormat="parquet", sourceDetails={"path": f"{sf}/events.parquet*"},
        readerConfigOptions={}, dataQualityExpectations=_RULES, partitionColumns=["event_type"], isStreaming="false",
    )
    run = MedallionRun(spark, work_dir(spark, "partitioned"), cipher=_CIPHER)
    run.run("bronze", {"bronze": [spec]})
    return run, spec


@query(
    "append_flow_creates_target",
    """
    SELECT c_custkey AS id FROM customer UNION ALL SELECT c_custkey FROM customer""",
)
def append_flow_creates_target(spark, sf):
    """A target that only append flows fill: the first one may create it."""
    flows = [
        {"name": n, "source_format": "parquet", "source_details": {"path": f"{sf}/customer.parquet*"}, "create_streaming_table": str(n == "one").lower()}
        for n in ("one", "two")
    ]
    spec = BronzeSpec("1", "g", targetDetails=_details("raw.people"), appendFlows=json.dumps(flows), isStreaming="true")
    run = MedallionRun(spark, work_dir(spark, "created"))
    run.run("bronze", {"bronze": [spec]})
    return run.read(spec).select(F.col("c_custkey").alias("id"))


@query("layers_stream", _RUN_SQL)
def layers_stream(spark, sf):
    run, specs = _run(spark, sf, streaming=True)
    return run.read(specs["gold"][0])


@query(
    "layers_message_flow",
    """
    SELECT event_id AS "kafkaOffset", event_id AS ticket__ticketId FROM events
    WHERE event_id % 31 <> 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0 AND user_id % 2 = 0 AND (event_id % 6 = 1 OR event_id % 3 = 0)""",
)
def layers_message_flow(spark, sf):
    """A message flow: captured records stand in for the connector; invalid messages go to quarantine."""
    root = work_dir(spark, "messages")
    spark.createDataFrame([(BODY_DDL,)], "value string").coalesce(1).write.text(f"{root}/ddl")
    spec = BronzeSpec(
        "1", "g", targetDetails=_details("raw.bets"), sourceFormat="kafka",
        sourceDetails={"kafka.bootstrap.servers": "host:9092", "subscribe": "bets"},
        readerConfigOptions={"custom_decode_fo": "true", "custom_decode_trasaction_type": "BET_FO"},
        schema=ddl_schema(spark, f"{root}/ddl").json(), flattenNestedData="true", columnToExtract=[""],
        dataQualityExpectations=json.dumps(
            {"expect_or_drop": {"valid_json": "is_error = false"}, "expect_or_quarantine": {"bad": "is_error = true and error_details IS NOT NULL"}}
        ),
    )
    hooks = Hooks(read_records=lambda session, options, streaming: records(stream(session, sf, "events")))
    run = MedallionRun(spark, root, hooks=hooks)
    run.run("bronze", {"bronze": [spec]})
    return run.read(spec).select("kafkaOffset", "ticket__ticketId").distinct()
