"""Dataflow specs: one row per flow and layer."""

from __future__ import annotations

import json
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.cdc import ChangeOptions
from tierflow.operators.keyed import latest_per_key, natural_order
from tierflow.operators.project import align
from tierflow.operators.quality import RuleSet, resolve_rules
from tierflow.operators.snapshots import snapshot_options
from tierflow.streaming.sinks import AppendFlow, Layout, column_names

_MAP, _LIST, _TEXT = "map<string,string>", "array<string>", "string"
_AUDIT = (
    "version string, createDate timestamp, createdBy string, updateDate timestamp, updatedBy string"
)
_COMMON = f"""targetFormat string, targetDetails {_MAP}, tableProperties {_MAP}, partitionColumns {_LIST},
    clusterBy {_LIST}, cdcApplyChanges string, dataQualityExpectations string, writerConfigOptions {_MAP},
    appendFlows string, appendFlowsSchemas {_MAP}, targetPiiFields {_MAP}, isStreaming string"""
_SOURCE = f"sourceFormat string, sourceDetails {_MAP}, readerConfigOptions {_MAP}"
_VIEWS = "array<struct<reference_name: string, sql_condition: string>>"
_SOURCES = (
    f"array<struct<reference_name: string, source_table: string, filter_condition: string, "
    f"is_streaming: string, pii_fields: {_MAP}>>"
)

# Column lists of the three spec tables.
SPEC_DDL = {
    "bronze": (
        f"""dataFlowId string, dataFlowGroup string, {_SOURCE}, {_COMMON}, `schema` string,
        applyChangesFromSnapshot string, quarantineTargetDetails {_MAP}, quarantineTableProperties {_MAP},
        flattenNestedData string, columnToExtract {_LIST}, description string, metadata {_MAP}, {_AUDIT}"""
    ),
    "silver": (
        f"""dataFlowId string, dataFlowGroup string, {_SOURCE}, {_COMMON}, selectExp {_LIST},
        whereClause {_LIST}, {_AUDIT}"""
    ),
    "gold": (
        f"dataFlowId string, dataFlowGroup string, {_COMMON}, sources {_SOURCES}, views {_VIEWS}, env string, {_AUDIT}"
    ),
}


def spec_schema(layer: str) -> T.StructType:
    return T.StructType.fromDDL(SPEC_DDL[layer])


ENTITY_KEY = ["dataFlowGroup", "dataFlowId"]


@dataclass(frozen=True)
class Spec:
    """What all layers share."""

    dataFlowId: str
    dataFlowGroup: str
    targetFormat: str = "parquet"
    targetDetails: dict | None = None
    tableProperties: dict | None = None
    partitionColumns: list | None = None
    clusterBy: list | None = None
    cdcApplyChanges: str | None = None
    dataQualityExpectations: str | None = None
    writerConfigOptions: dict | None = None
    appendFlows: str | None = None
    appendFlowsSchemas: dict | None = None
    targetPiiFields: dict | None = None
    isStreaming: str | None = None
    version: str | None = None
    createDate: object = None
    createdBy: str | None = None
    updateDate: object = None
    updatedBy: str | None = None

    @property
    def table(self) -> str:
        d = self.targetDetails or {}
        return f"{d['database']}.{d['table']}" if d.get("database") else d["table"]

    @property
    def layout(self) -> Layout:
        return Layout(column_names(self.partitionColumns), column_names(self.clusterBy), self.tableProperties or {})

    @property
    def changes(self) -> ChangeOptions | None:
        return ChangeOptions.of(json.loads(self.cdcApplyChanges)) if self.cdcApplyChanges else None

    @property
    def rules(self) -> RuleSet:
        return resolve_rules(self.dataQualityExpectations)

    @property
    def flows(self) -> list[AppendFlow]:
        return [AppendFlow.of(f) for f in json.loads(self.appendFlows)] if self.appendFlows else []

    @property
    def wants_ingestion_time(self) -> bool:
        return str((self.writerConfigOptions or {}).get("includeIngestionTimeAsColumn", "")).lower() == "true"

    @property
    def streaming(self) -> bool:
        return str(self.isStreaming or "true").lower() != "false"


@dataclass(frozen=True)
class BronzeSpec(Spec):
    sourceFormat: str | None = None
    sourceDetails: dict | None = None
    readerConfigOptions: dict | None = None
    schema: str | None = None
    applyChangesFromSnapshot: str | None = None
    quarantineTargetDetails: dict | None = None
    quarantineTableProperties: dict | None = None
    flattenNestedData: str | None = None
    columnToExtract: list | None = None
    description: str | None = None
    metadata: dict | None = None

    @property
    def snapshot(self) -> ChangeOptions | None:
        if not self.applyChangesFromSnapshot:
            return None
        told = json.loads(self.applyChangesFromSnapshot)
        missing = [k for k in ("keys", "scd_type") if not told.get(k)]
        if missing:
            raise ValueError(f"snapshot options lack mandatory {missing}")
        return snapshot_options(
            told["keys"],
            told["scd_type"],
            told.get("track_history_column_list"),
            told.get("track_history_except_column_list"),
        )

    @property
    def struct(self) -> T.StructType | None:
        return T.StructType.fromJson(json.loads(self.schema)) if self.schema else None


@dataclass(frozen=True)
class SilverSpec(Spec):
    sourceFormat: str | None = None
    sourceDetails: dict | None = None
    readerConfigOptions: dict | None = None
    selectExp: list | None = None
    whereClause: list | None = None


@dataclass(frozen=True)
class GoldSpec(Spec):
    sources: list | None = None
    views: list | None = None
    env: str | None = None

    @property
    def streaming(self) -> bool:
        return str(self.isStreaming or "false").lower() == "true"


SPEC_CLASSES = {"bronze": BronzeSpec, "silver": SilverSpec, "gold": GoldSpec}


def latest_specs(table: DataFrame, layer: str, group: str | None = None, ids: list[str] | str | None = None) -> DataFrame:
    """Latest version of each flow of a group and / or an id list; columns an older table lacks are NULL."""
    df = align(table, spec_schema(layer))
    if group:
        df = df.where(F.col("dataFlowGroup") == group)
    if ids:
        wanted = [i.strip().strip("'\"") for i in ids.split(",")] if isinstance(ids, str) else list(ids)
        df = df.where(F.col("dataFlowId").isin(wanted))
    return latest_per_key(df, ENTITY_KEY, [natural_order(F.col("version")).desc()])


def load_specs(table: DataFrame, layer: str, group: str | None = None, ids=None) -> list[Spec]:
    """Specs as objects. There is one row per flow, so collecting them is safe."""
    cls = SPEC_CLASSES[layer]
    names = {f.name for f in fields(cls)}
    rows = latest_specs(table, layer, group, ids).collect()
    return [cls(**{k: v for k, v in r.asDict(recursive=True).items() if k in names}) for r in rows]
