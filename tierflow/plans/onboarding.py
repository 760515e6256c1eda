"""Onboarding: metadata files to spec tables, one projection per layer.

The file is read as variants, so that flows may differ in the fields they have. Both key layouts are
understood: nested (``bronze_dev.target_details.table``) and flat (``bronze_database_dev``, ``bronze_table``).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.keyed import duplicate_keys, keyed_merge
from tierflow.operators.project import align, spread
from tierflow.operators.quality import expect_or_fail
from tierflow.plans.specs import spec_schema
from tierflow.session import materialize
from tierflow.sources.schemas import ddl_schema, json_objects, multiline_json, read_texts
from tierflow.sources.storage import publish, read_published
from tierflow.streaming.sinks import ZORDER_PROPERTY, overwrite_merging

# Source formats a flow may name.
SOURCE_FORMATS = ("cloudfiles", "csv", "parquet", "json", "eventhub", "kafka", "delta", "snapshot")
PROTECTED = ("createDate", "createdBy")

_MAP = "map<string,string>"


class Flow:
    """Typed reads from the variant column ``v`` of an onboarding row."""

    def __init__(self, layer: str, env: str):
        self.layer, self.env = layer, env

    def at(self, path: str, dtype: str = "string") -> Column:
        return F.try_variant_get("v", f"$.{path}", dtype)

    def own(self, name: str, dtype: str = "string") -> Column:
        """A setting of the layer: nested, or flat with the layer's name in front."""
        flat = name if name.startswith(f"{self.layer}_") else f"{self.layer}_{name}"
        return F.coalesce(
            self.at(f"{self.layer}_{self.env}.{name}", dtype),
            self.at(f"{self.layer}_{self.env}.{flat}", dtype),
            self.at(flat, dtype),
        )

    def text(self, col: Column) -> Column:
        """Blank texts count as not given."""
        return F.when(F.trim(col) != "", col)

    def json(self, name: str) -> Column:
        raw = self.own(name, "variant")
        return F.when(raw.isNotNull() & ~F.is_variant_null(raw) & ~F.to_json(raw).isin("{}", "[]", '""'), F.to_json(raw))

    def map(self, *found: Column) -> Column:
        return F.map_filter(F.coalesce(*found, F.create_map().cast(_MAP)), lambda _, x: x.isNotNull())

    def names(self, name: str) -> Column:
        """Column list given as an array or as comma text."""
        listed = F.coalesce(self.own(name, "array<string>"), F.split(self.own(name), ","))
        cleaned = F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x != "")
        return F.when(F.size(cleaned) > 0, cleaned)

    def target(self, place: str | None = None) -> Column:
        """database, table and path of the layer's target."""
        layer = place or self.layer
        nested = f"{layer}_{self.env}.target_details"
        parts = {
            "database": F.coalesce(
                F.concat_ws(".", self.at(f"{nested}.catalog"), F.coalesce(self.at(f"{nested}.schema"), self.at(f"{nested}.database"))),
                F.lit(""),
            ),
            "table": F.coalesce(self.at(f"{nested}.table"), self.at(f"{layer}_table")),
            "path": self.text(F.coalesce(self.at(f"{nested}.path"), self.at(f"{layer}_table_path_{self.env}"))),
        }
        parts["database"] = F.coalesce(self.text(parts["database"]), self.at(f"{layer}_database_{self.env}"))
        entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in parts.items()])
        return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def read_onboarding(spark: SparkSession, path: str) -> DataFrame:
    """Flows of an onboarding file, one variant per row. Only JSON files are known; ids must be unique."""
    if not path.lower().endswith(".json"):
        raise ValueError(f"onboarding files are JSON, got {path}")
    df = spread(json_objects(spark, path))
    ids = df.select(F.try_variant_get("v", "$.data_flow_id", "string").alias("data_flow_id"))
    twice = duplicate_keys(ids, ["data_flow_id"])
    number = twice.count()
    if number:
        shown = [r[0] for r in twice.take(20)]
        raise ValueError(f"{number} data_flow_id given more than once: {shown}{' and others' if number > len(shown) else ''}")
    return df


def with_layer(df: DataFrame, layer: str, env: str) -> DataFrame:
    """Rows that describe the layer."""
    flow = Flow(layer, env)
    nested = flow.at(f"{layer}_{env}", "variant")
    return df.where((nested.isNotNull() & ~F.is_variant_null(nested)) | flow.at(f"{layer}_table").isNotNull())


def _common(flow: Flow) -> dict[str, Column]:
    layer = flow.layer
    return {
        "dataFlowId": flow.at("data_flow_id"),
        "dataFlowGroup": flow.at("data_flow_group"),
        "targetFormat": F.lit("parquet"),
        "targetDetails": flow.target(),
        "tableProperties": flow.map(flow.own(f"{layer}_table_properties", _MAP)),
        "partitionColumns": F.coalesce(flow.names("partition_columns"), flow.names("table_partitions")),
        "clusterBy": flow.names("cluster_by"),
        "cdcApplyChanges": flow.json("cdc_apply_changes"),
        "dqPath": flow.text(flow.own(f"{layer}_data_quality_expectations_json_{flow.env}")),
        "writerConfigOptions": flow.map(flow.own(f"{layer}_writer_config_options", _MAP)),
        "appendFlows": flow.json("append_flows"),
        "targetPiiFields": flow.map(flow.own("target_pii_fields", _MAP)),
        "isStreaming": flow.own("is_streaming"),
    }


def _source_details(flow: Flow) -> Column:
    """Source settings; the path of this environment is called ``path``."""
    raw = flow.map(flow.at(f"source_details_{flow.env}", _MAP), flow.at("source_details", _MAP))
    path = F.coalesce(raw[f"source_path_{flow.env}"], raw["source_path"], raw["path"])
    rest = F.map_filter(raw, lambda k, _: ~k.startswith("source_path") & (k != "path"))
    return F.map_concat(rest, F.when(path.isNotNull(), F.create_map(F.lit("path"), path)).otherwise(F.create_map().cast(_MAP)))


def _quarantine(flow: Flow) -> Column:
    parts = {
        "database": flow.text(flow.own(f"bronze_database_quarantine_{flow.env}")),
        "table": flow.text(flow.own("bronze_quarantine_table")),
        "path": flow.text(flow.own(f"bronze_quarantine_table_path_{flow.env}")),
        "partition_columns": F.array_join(flow.names("bronze_quarantine_table_partitions"), ","),
        "cluster_by": F.array_join(flow.names("bronze_quarantine_table_cluster_by"), ","),
    }
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in parts.items()])
    filled = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return F.when(parts["table"].isNotNull(), filled).otherwise(F.create_map().cast(_MAP))


def _joined(df: DataFrame, key: Column, found: dict[str, str], name: str) -> DataFrame:
    """Add ``name``: what ``found`` holds for the key, from a small table of as many rows as distinct files."""
    if not found:
        return df.withColumn(name, F.lit(None).cast("string"))
    table = df.sparkSession.createDataFrame(list(found.items()), f"__key string, `{name}` string")
    return df.join(table, key == table["__key"], "left").drop("__key")


def _distinct(df: DataFrame, **cols: Column) -> dict[str, list[str]]:
    """Distinct texts of each column, from one job."""
    tagged = F.array(*[F.struct(F.lit(n).alias("what"), c.alias("text")) for n, c in cols.items()])
    found: dict[str, list[str]] = {n: [] for n in cols}
    for row in df.select(F.inline(tagged)).where("text IS NOT NULL").distinct().collect():
        found[row["what"]].append(row["text"])
    return found


SchemaMapper = Callable[[str, SparkSession], T.StructType]


def _mapped(path: str, spark: SparkSession) -> T.StructType:
    return ddl_schema(spark, path)


def _append_paths(text: str) -> dict[str, str]:
    """Schema file of each append flow that names one."""
    paths = {f["name"]: (f.get("source_details") or {}).get("source_schema_path") for f in json.loads(text)}
    return {name: path for name, path in paths.items() if path}


def _with_side_files(df: DataFrame, flow: Flow, mapper: SchemaMapper = _mapped) -> tuple[DataFrame, list[str]]:
    """Replace the paths of rule files, DDL files and append-flow schemas by what they hold; returns the paths of transformations, too.

    One job finds the paths of all kinds, one reads the files; only a schema mapper of the caller's own is asked path by path.
    """
    spark = df.sparkSession
    bronze = flow.layer == "bronze"
    ddl = F.col("sourceDetails")["source_schema_path"] if bronze else F.lit(None).cast("string")
    transforms = F.lit(None).cast("string") if bronze else F.col("transformPath")
    found = _distinct(df, rules=F.col("dqPath"), flows=F.col("appendFlows"), ddl=ddl, transforms=transforms)
    appended = {text: _append_paths(text) for text in found["flows"]}
    schema_paths = sorted({*found["ddl"], *(p for paths in appended.values() for p in paths.values())})
    own = mapper is not _mapped
    texts = read_texts(spark, sorted({*found["rules"], *([] if own else schema_paths)}))
    schemas = {p: (mapper(p, spark) if own else T.StructType.fromDDL(texts[p])).json() for p in schema_paths}
    df = _joined(df, F.col("dqPath"), {p: texts[p] for p in found["rules"]}, "dataQualityExpectations")
    df = _joined(df, F.col("appendFlows"), {t: json.dumps({n: schemas[p] for n, p in paths.items()}) for t, paths in appended.items()}, "appendFlowsSchemas")
    if bronze:
        df = _joined(df, ddl, {p: schemas[p] for p in found["ddl"]}, "schema")
    columns = {
        "appendFlowsSchemas": F.from_json("appendFlowsSchemas", _MAP),
        # The environment's path of an append flow is called ``path`` as well.
        "appendFlows": F.regexp_replace("appendFlows", f'"source_path_{flow.env}":', '"path":'),
    }
    return df.withColumns(columns).drop("dqPath"), found["transforms"]


def _check(df: DataFrame, layer: str) -> DataFrame:
    rules = {
        "data_flow_id missing": "dataFlowId IS NOT NULL",
        "data_flow_group missing": "dataFlowGroup IS NOT NULL",
        "target table missing": "targetDetails['table'] IS NOT NULL",
        "cluster and z-order columns given together": f"clusterBy IS NULL OR tableProperties['{ZORDER_PROPERTY}'] IS NULL",
    }
    if layer == "bronze":
        formats = ", ".join(f"'{f}'" for f in SOURCE_FORMATS)
        rules |= {
            "source_format missing or unknown": f"lower(sourceFormat) IN ({formats})",
            "source_details missing": "size(sourceDetails) > 0",
            "bronze_reader_options missing": "readerConfigOptions IS NOT NULL",
            "snapshot_format missing": "lower(sourceFormat) <> 'snapshot' OR sourceDetails['snapshot_format'] IS NOT NULL",
        }
    if layer == "silver":
        rules["source table missing"] = "sourceDetails['table'] IS NOT NULL"
    # Behind a generator the rules read finished columns; a filter would move below the projection and take copies of it along.
    staged = df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    return expect_or_fail(staged, rules)


def bronze_rows(df: DataFrame, env: str, mapper: SchemaMapper = _mapped) -> DataFrame:
    """Bronze flows as spec rows; ``mapper`` turns a schema file into a schema, by default as DDL."""
    flow = Flow("bronze", env)
    column = F.coalesce(flow.at("column_to_extract", "array<string>"), F.array(flow.at("column_to_extract")))
    columns = {
        **_common(flow),
        "sourceFormat": flow.at("source_format"),
        "sourceDetails": _source_details(flow),
        "readerConfigOptions": flow.own("bronze_reader_options", _MAP),
        "applyChangesFromSnapshot": flow.json("apply_changes_from_snapshot"),
        "quarantineTargetDetails": _quarantine(flow),
        "quarantineTableProperties": flow.map(flow.own("bronze_quarantine_table_properties", _MAP)),
        "flattenNestedData": flow.at("flatten_nested_data"),
        "columnToExtract": F.filter(column, lambda c: c.isNotNull() & (F.trim(c) != "")),
        "description": flow.at("description"),
        "metadata": flow.at("metadata", _MAP),
    }
    rows = with_layer(df, "bronze", env).select(*[c.alias(n) for n, c in columns.items()])
    return _check(_with_side_files(rows, flow, mapper)[0], "bronze")


def silver_rows(df: DataFrame, env: str) -> DataFrame:
    flow = Flow("silver", env)
    own = F.map_filter(
        F.create_map(
            F.lit("database"),
            F.concat_ws(".", flow.at(f"silver_{env}.source_details.catalog"), flow.at(f"silver_{env}.source_details.schema")),
            F.lit("table"),
            flow.at(f"silver_{env}.source_details.table"),
        ),
        lambda _, x: x.isNotNull(),
    )
    columns = {
        **_common(flow),
        "sourceFormat": F.lit("parquet"),
        # Without a source of its own a silver flow reads the bronze target of the same row.
        "sourceDetails": F.when(flow.at(f"silver_{env}.source_details.table").isNotNull(), own).otherwise(flow.target("bronze")),
        "readerConfigOptions": F.create_map().cast(_MAP),
        "transformPath": flow.text(flow.own(f"silver_transformation_json_{env}")),
    }
    rows = with_layer(df, "silver", env).select(*[c.alias(n) for n, c in columns.items()])
    rows, paths = _with_side_files(rows, flow)
    rows = _check(rows, "silver")
    ddl = "target_table string, select_exp array<string>, target_partition_cols array<string>, where_clause array<string>"
    if not paths:
        return rows.withColumns({"selectExp": F.lit(None), "whereClause": F.lit(None)})
    texts = multiline_json(df.sparkSession, paths, ddl)
    return attach_transforms(rows, texts.selectExpr("target_table", "select_exp AS selectExp", "where_clause AS whereClause"))


def gold_rows(df: DataFrame, env: str) -> DataFrame:
    flow = Flow("gold", env)
    columns = {
        **_common(flow),
        "isStreaming": F.lower(F.coalesce(flow.own("is_streaming"), F.lit("false"))),
        "env": F.lit(env),
        "transformPath": flow.text(flow.own(f"gold_transformation_json_{env}")),
    }
    rows = with_layer(df, "gold", env).select(*[c.alias(n) for n, c in columns.items()])
    rows, paths = _with_side_files(rows, flow)
    rows = _check(rows, "gold")
    return attach_transforms(rows, gold_transforms(df.sparkSession, paths, env)) if paths else rows


def gold_transforms(spark: SparkSession, paths: list[str], env: str) -> DataFrame:
    """Gold transformation files: target, sources of this environment, views in order.

    The list of views is the field whose name ends in ``views``.
    """
    raw = json_objects(spark, paths)
    fields = F.variant_get("v", "$", "map<string,variant>")
    views = F.get(F.map_values(F.map_filter(fields, lambda k, _: k.endswith("views"))), F.lit(0))
    listed = F.try_variant_get("v", "$.sources", "array<variant>")

    def source(s: Column) -> Column:
        def get(name, dtype="string"):
            return F.try_variant_get(s, f"$.{name}", dtype)

        pii = F.coalesce(get("pii_fields", _MAP), F.create_map().cast(_MAP))
        return F.struct(
            get("reference_name").alias("reference_name"),
            F.coalesce(get(f"source_table_{env}"), get("source_table")).alias("source_table"),
            F.coalesce(get("filter_condition"), F.lit("")).alias("filter_condition"),
            F.coalesce(get("is_streaming"), F.lit("false")).alias("is_streaming"),
            F.map_filter(pii, lambda _, x: x.isNotNull()).alias("pii_fields"),
        )

    return raw.select(
        F.try_variant_get("v", "$.target_table", "string").alias("target_table"),
        F.transform(listed, source).alias("sources"),
        F.try_variant_get(views, "$", "array<struct<reference_name:string,sql_condition:string>>").alias("views"),
    )


def attach_transforms(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Each flow with the transformation of its target table."""
    return rows.join(texts, F.col("targetDetails")["table"] == texts["target_table"]).drop("target_table", "transformPath")


def add_audit_columns(df: DataFrame, version: str, author: str, now: Column | None = None) -> DataFrame:
    now = F.current_timestamp() if now is None else now
    return df.withColumns(
        {
            "version": F.lit(version),
            "createDate": now,
            "createdBy": F.lit(author),
            "updateDate": now,
            "updatedBy": F.lit(author),
        }
    )


def compile_specs(
    spark: SparkSession, path: str, layer: str, env: str, version: str, author: str, now: Column | None = None,
    mapper: SchemaMapper = _mapped,
) -> DataFrame:
    """Spec rows of one layer of an onboarding file."""
    flows = read_onboarding(spark, path)
    if layer == "bronze":
        rows = bronze_rows(flows, env, mapper)
    else:
        rows = silver_rows(flows, env) if layer == "silver" else gold_rows(flows, env)
    return align(add_audit_columns(rows, version, author, now), spec_schema(layer))


def store_specs(specs: DataFrame, path: str, overwrite: bool = True) -> int:
    """Replace the spec table, or merge into it by flow id; creation columns survive a merge."""
    if overwrite:
        return overwrite_merging(specs, path)
    try:
        older = read_published(specs.sparkSession, path)
    except FileNotFoundError:
        return publish(specs, path)
    # The merge reads the new specs several times; compiling them once is enough.
    fresh = materialize(specs)
    return publish(keyed_merge(align(older, specs.schema), fresh, ["dataFlowId"], PROTECTED), path)


def onboard(
    spark: SparkSession, path: str, tables: dict[str, str], env: str, version: str, author: str, overwrite: bool = True,
    mapper: SchemaMapper = _mapped,
) -> dict[str, int]:
    """Compile and store every layer in ``tables`` (layer to spec-table path); returns table versions."""
    return {
        layer: store_specs(compile_specs(spark, path, layer, env, version, author, mapper=mapper), where, overwrite)
        for layer, where in tables.items()
    }
