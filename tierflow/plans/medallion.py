"""Run the flows of a spec table: bronze, silver and gold in order."""

from __future__ import annotations

import json
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.functions.crypto import Cipher, encrypt_columns, with_decrypted
from tierflow.operators.cdc import ChangeOptions, apply_changes, rejected_changes
from tierflow.operators.flatten import flatten_by_spec
from tierflow.operators.messages import decode_messages
from tierflow.operators.project import Hook, apply_hook, project_then_filter
from tierflow.operators.quality import ROUTE, RuleSet, StreamCounts, apply_quality
from tierflow.plans.launch import side_by_side
from tierflow.plans.specs import BronzeSpec, GoldSpec, SilverSpec, Spec
from tierflow.plans.views import ViewRegistry, build_targets, plain_name
from tierflow.session import SPREAD_GROUPS, held
from tierflow.sources import kafka
from tierflow.sources.files import FileSource, read_files, with_ingestion_time
from tierflow.sources.schemas import ddl_schema
from tierflow.sources.storage import (
    children,
    current_version,
    exists,
    get_text,
    put_text,
    read_published,
    touch,
)
from tierflow.sources.tables import NextSnapshot, numbered_files, read_path, snapshot_series
from tierflow.streaming.changes import apply_changes_stream, open_changes
from tierflow.streaming.feed import published_feed
from tierflow.streaming.sinks import (
    AppendFlow,
    append_stream,
    checked_stream,
    read_checked,
    read_flows,
    read_route,
    replace_batch,
    run_append_flows,
    write_checked,
)
from tierflow.streaming.snapshots import KIND, SnapshotTarget, open_snapshots

LINK = "link"
REJECTS = "__rejects"

# Layer names a run accepts and the layers each stands for.
LAYERS = {
    "bronze": ("bronze",),
    "silver": ("silver",),
    "gold": ("gold",),
    "bronze_silver": ("bronze", "silver"),
    "bronze_gold": ("bronze", "gold"),
    "bronze_silver_gold": ("bronze", "silver", "gold"),
}


@dataclass
class Hooks:
    """What a caller may plug in. Transform hooks get (frame, spec)."""

    transforms: dict[str, Hook] = field(default_factory=dict)
    next_snapshot: Callable[[BronzeSpec], NextSnapshot] | None = None
    decoder: Callable | None = None
    secrets: kafka.Secrets | None = None
    seed_rows: dict[str, list[dict]] = field(default_factory=dict)
    # Stands in for the Kafka connector, for instance over captured records.
    read_records: Callable[[SparkSession, dict, bool], DataFrame] | None = None
    schema_mapper: Callable | None = None


class MedallionRun:
    """Flows of one run. Tables live under ``root`` as ``database/table`` unless the spec has a path."""

    def __init__(
        self, spark: SparkSession, root: str, *, cipher: Cipher | None = None, hooks: Hooks | None = None, buckets: int = 64,
        publish_every: int = 16, flows_at_once: int = 4,
    ):
        """``publish_every``: micro-batches of a change-capture stream after which its target is brought up to date.

        ``flows_at_once``: flows of one layer that run side by side, where none reads or writes what another writes.
        """
        self.flows_at_once = flows_at_once
        self.spark, self.root = spark, root.rstrip("/")
        self.cipher, self.hooks, self.buckets, self.publish_every = cipher, hooks or Hooks(), buckets, publish_every
        # Violations per table and rule, and changes without a sequence per table, as the last run counted them.
        self.violations: dict[str, dict[str, int]] = {}
        self.rejected: dict[str, int] = {}

    # --- tables ---

    def path(self, details: dict) -> str:
        if details.get("path"):
            return details["path"].rstrip("/")
        return "/".join(p for p in (self.root, details.get("database"), details["table"]) if p)

    def checkpoint(self, spec: Spec, what: str = "main") -> str:
        return f"{self.root}/_checkpoints/{spec.table}/{what}"

    def open(self, path: str, streaming: bool = False, options: dict | None = None) -> DataFrame:
        """Main rows of a table this engine has written, whichever sink it used.

        A stream over a published table (batch and change-capture targets, snapshots) is its change feed: new and changed rows,
        each once. The option ``readChangeFeed`` brings deleted rows, too, and two columns that tell what happened when.
        """
        names = children(self.spark, path)
        if LINK in names:
            return self._rejected(get_text(self.spark, f"{path}/{LINK}"))
        if "description" in names:
            snapshots = json.loads(get_text(self.spark, f"{path}/description")).get("kind") == KIND
            target = open_snapshots(self.spark, path) if snapshots else open_changes(self.spark, path)
            if streaming:
                return target.feed().stream(options)
            if snapshots:
                return target.read()
            df = target.read()
            if df is None:
                raise FileNotFoundError(f"nothing published under {path}")
            return df
        if current_version(self.spark, path) is not None:
            if streaming:
                return published_feed(self.spark, path, _main_rows).stream(options)
            return _main_rows(read_published(self.spark, path))
        if any(n.startswith(f"{ROUTE}=") for n in names):
            return read_checked(self.spark, path, "main", streaming, options)
        return read_path(self.spark, path, streaming, options=options)

    def _rejected(self, path: str) -> DataFrame:
        if current_version(self.spark, path) is not None:
            return read_route(self.spark, path, "quarantine")
        return read_checked(self.spark, path, "quarantine")

    def rejects(self, spec: Spec) -> DataFrame:
        """Changes that a change-capture target could not order."""
        path = self.path(spec.targetDetails)
        if "description" in children(self.spark, path):
            return open_changes(self.spark, path).rejects()
        return read_published(self.spark, f"{path}{REJECTS}")

    def quarantine(self, spec: BronzeSpec) -> DataFrame:
        return self._rejected(self.path(spec.targetDetails))

    def _link_quarantine(self, spec: Spec) -> None:
        """Let the quarantine table's own name lead to the rejected rows, which lie beside the main ones."""
        details = getattr(spec, "quarantineTargetDetails", None)
        if details and details.get("table"):
            put_text(self.spark, f"{self.path(details)}/{LINK}", self.path(spec.targetDetails))

    def read(self, spec: Spec) -> DataFrame:
        """A target with the rows its append flows brought."""
        path = self.path(spec.targetDetails)
        names = [f.name for f in spec.flows]
        brought = read_flows(self.spark, f"{path}__flows", names) if names else None
        if brought is not None and self._flows_create(spec, path):
            return brought
        main = self.open(path)
        return main if brought is None else main.unionByName(brought, allowMissingColumns=True)

    def _flows_create(self, spec: Spec, path: str) -> bool:
        """Whether a target without rows of its own is left to append flows that may create it."""
        return not children(self.spark, path) and any(f.create_streaming_table for f in spec.flows)

    # --- run ---

    def run(self, layers: str, specs: dict[str, list[Spec]]) -> list[str]:
        """Run the layers in order to the end of the present input; returns the tables written."""
        if layers.lower() not in LAYERS:
            raise ValueError(f"unknown layers {layers!r}, known: {sorted(LAYERS)}")
        written = []
        for layer in LAYERS[layers.lower()]:
            if layer == "gold":
                written += self._gold(specs.get("gold", []))
                continue
            flows = specs.get(layer, [])
            work = self._bronze if layer == "bronze" else self._silver
            side_by_side(self.spark, flows, work, name=lambda s: s.table, waits=self._waits, most=self.flows_at_once)
            written += [spec.table for spec in flows]
        return written

    def _reads(self, spec: Spec) -> set[str]:
        """Folders of this engine's tables that a flow or one of its append flows reads."""
        found = set()
        for details in (spec.sourceDetails or {}, *(f.source_details or {} for f in spec.flows)):
            if details.get("path"):
                found.add(details["path"].rstrip("/"))
            elif details.get("source_table") or details.get("table"):
                table = {"database": details.get("source_database") or details.get("database"), "table": details.get("source_table") or details["table"]}
                found.add(self.path(table))
        return found

    def _waits(self, spec: Spec, earlier: Spec) -> bool:
        """Whether a flow must come behind an earlier one of its layer: a table in common, or settings of the whole session."""
        written = self.path(earlier.targetDetails)
        session = any(f.spark_conf for f in (*spec.flows, *earlier.flows))
        return session or written in self._reads(spec) or written == self.path(spec.targetDetails) or self.path(spec.targetDetails) in self._reads(earlier)

    # --- bronze ---

    def _source(self, spec: BronzeSpec) -> DataFrame:
        details, options = spec.sourceDetails or {}, spec.readerConfigOptions or {}
        kind = (spec.sourceFormat or "").lower()
        if kind in ("kafka", "eventhub"):
            return self._records(kind, details, options, spec)
        if kind == "delta":
            df = self._table(details, options, spec.streaming)
        else:
            df = self._files(spec.sourceFormat, details, options, spec.struct, spec.streaming)
        df = flatten_by_spec(df, spec.flattenNestedData, spec.columnToExtract)
        return with_ingestion_time(df) if spec.wants_ingestion_time else df

    def _files(self, format, details, options, schema, streaming) -> DataFrame:
        mapper, ddl = self.hooks.schema_mapper, details.get("source_schema_path")
        if mapper and ddl:
            schema = mapper(ddl, self.spark)
        section = details.get("source_metadata")
        section = json.loads(section) if isinstance(section, str) else section
        if section and isinstance(section.get("select_metadata_cols"), str):
            section["select_metadata_cols"] = json.loads(section["select_metadata_cols"])
        return read_files(self.spark, FileSource(details["path"], format, options, schema, section), streaming)

    def _table(self, details, options, streaming) -> DataFrame:
        if details.get("path"):
            return read_path(self.spark, details["path"], streaming, options=options)
        path = self.path({"database": details.get("source_database"), "table": details["source_table"]})
        return self.open(path, streaming, options)

    def _records(self, kind, details, options, spec: BronzeSpec) -> DataFrame:
        if kind == "kafka":
            merged = kafka.kafka_options(details, options, self.hooks.secrets)
        else:
            merged = kafka.eventhub_options(details, options, self.hooks.secrets)
        reader = self.hooks.read_records or kafka.read_kafka
        df = reader(self.spark, kafka.connector_options(merged), spec.streaming)
        message = kafka.message_kind(merged)
        if message:
            ddl = details.get("source_schema_path")
            column = spec.columnToExtract or []
            wants_flat = str(spec.flattenNestedData or "").lower() == "true"
            df = decode_messages(
                df,
                message,
                schema=spec.struct or (ddl_schema(self.spark, ddl) if ddl else None),
                decoder=self.hooks.decoder,
                flatten_column=(column[0] if column else "") if wants_flat else None,
                seed_rows=self.hooks.seed_rows.get(message),
                seed_folder=f"{self.root}/_seeds/{spec.table}",
            )
        else:
            df = flatten_by_spec(df, spec.flattenNestedData, spec.columnToExtract)
        return with_ingestion_time(df) if spec.wants_ingestion_time else df

    def _bronze(self, spec: BronzeSpec) -> None:
        if not spec.sourceFormat and any(f.create_streaming_table for f in spec.flows):
            self._append_flows(spec)
            return
        if (spec.sourceFormat or "").lower() == "snapshot":
            self._snapshots(spec)
        else:
            df = apply_hook(self._source(spec), self.hooks.transforms.get("bronze"), spec)
            if spec.targetPiiFields and self.cipher:
                df = encrypt_columns(df, spec.targetPiiFields, self.cipher)
            self._write(df, spec)
        self._append_flows(spec)

    def _snapshots(self, spec: BronzeSpec) -> None:
        """Apply the snapshots that followed the last one stored; each step publishes a version."""
        opts = spec.snapshot
        if opts is None:
            raise ValueError(f"{spec.table}: a snapshot source needs apply_changes_from_snapshot")
        details = spec.sourceDetails or {}
        if self.hooks.next_snapshot:
            following = self.hooks.next_snapshot(spec)
        else:
            following = numbered_files(
                self.spark, details["path"] + "{version}." + details["snapshot_format"],
                details["snapshot_format"], spec.readerConfigOptions, spec.struct,
            )
        path = self.path(spec.targetDetails)
        # The table version is the snapshot version.
        for snapshot, version in snapshot_series(following, current_version(self.spark, path)):
            if "description" not in children(self.spark, path):
                SnapshotTarget(self.spark, path, snapshot.schema, opts, self.buckets).describe()
            open_snapshots(self.spark, path).apply(snapshot, version)

    def _append_flows(self, spec: Spec) -> None:
        if not spec.flows:
            return
        path = self.path(spec.targetDetails)
        if not children(self.spark, path) and not self._flows_create(spec, path):
            raise ValueError(f"{spec.table}: no append flow may create it (create_streaming_table), and it is not there")
        schemas = {k: T.StructType.fromJson(json.loads(v)) for k, v in (spec.appendFlowsSchemas or {}).items()}

        def read(flow: AppendFlow) -> DataFrame:
            kind = flow.source_format.lower()
            if kind in ("kafka", "eventhub"):
                build = kafka.kafka_options if kind == "kafka" else kafka.eventhub_options
                merged = build(flow.source_details, flow.reader_options, self.hooks.secrets)
                reader = self.hooks.read_records or kafka.read_kafka
                df = reader(self.spark, kafka.connector_options(merged), True)
            elif kind == "delta":
                df = self._table(flow.source_details, flow.reader_options, True)
            else:
                df = self._files(flow.source_format, flow.source_details, flow.reader_options, schemas.get(flow.name), True)
            return with_ingestion_time(df) if spec.wants_ingestion_time else df

        run_append_flows(
            self.spark, spec.flows, read, f"{self.path(spec.targetDetails)}__flows",
            f"{self.root}/_checkpoints/{spec.table}", spec.layout,
        )

    # --- silver ---

    def _silver(self, spec: SilverSpec) -> None:
        df = self.open(self.path(spec.sourceDetails), spec.streaming, spec.readerConfigOptions)

        def transform(clear: DataFrame) -> DataFrame:
            shaped = project_then_filter(clear, spec.selectExp, spec.whereClause)
            return apply_hook(shaped, self.hooks.transforms.get("silver"), spec)

        self._write(with_decrypted(df, spec.targetPiiFields or {}, self.cipher, transform), spec)
        self._append_flows(spec)

    # --- gold ---

    def _gold(self, specs: list[GoldSpec]) -> list[str]:
        """All gold targets share their views; each is made and written behind those it reads, whatever their kind."""
        if not specs:
            return []
        registry, by_name = ViewRegistry(self.spark), {s.table: s for s in specs}
        siblings = {plain_name(name) for name in by_name}
        written: list[str] = []

        def bound(spec: GoldSpec, source: dict) -> tuple[str, bool]:
            """The name of a source's rows in the registry, and whether it is a stream; stream and batch of a table are two names."""
            table = source["source_table"]
            as_stream = spec.streaming and str(source.get("is_streaming") or "true").lower() == "true"
            if table.lower().startswith("live.") or (plain_name(table) in siblings and not as_stream):
                return table, as_stream
            return f"`{table} as {'stream' if as_stream else 'table'}`", as_stream

        def bind(target: dict) -> None:
            spec = by_name[target["target"]]
            for source in spec.sources or []:
                name, as_stream = bound(spec, source)
                if name != source["source_table"] and plain_name(name) not in registry.frames:
                    registry.register(name, self._table_of_source(source["source_table"], as_stream))

        def built(target: dict, df: DataFrame) -> None:
            spec = by_name[target["target"]]
            with nullcontext() if df.isStreaming else held(self.spark, SPREAD_GROUPS):
                self._write(apply_hook(df, self.hooks.transforms.get("gold"), spec), spec)
            self._append_flows(spec)
            written.append(spec.table)
            # Who reads it by name reads what is written, and does not make it again.
            registry.register(spec.table, self.open(self.path(spec.targetDetails)))

        targets = [
            {
                "target": s.table,
                "streaming": s.streaming,
                "sources": [{**source, "source_table": bound(s, source)[0]} for source in s.sources or []],
                "waits": [source["source_table"] for source in s.sources or []],
                "views": [{"name": v["reference_name"], "sql": v["sql_condition"]} for v in s.views or []],
                "pii": s.targetPiiFields,
            }
            for s in sorted(specs, key=lambda s: not s.streaming)  # streams first, where nothing else decides
        ]
        build_targets(registry, targets, specs[0].env or "dev", self.cipher, bind=bind, built=built)
        return written

    def _table_of_source(self, table: str, as_stream: bool) -> DataFrame:
        database, _, name = table.rpartition(".")
        path = self.path({"database": database, "table": name})
        if children(self.spark, path):
            return self.open(path, as_stream)
        return self.spark.readStream.table(table) if as_stream else self.spark.table(table)

    # --- write ---

    def _write(self, df: DataFrame, spec: Spec) -> None:
        path, opts, rules = self.path(spec.targetDetails), spec.changes, spec.rules
        if opts:
            self._write_changes(df, spec, path, opts, rules)
        elif rules:
            if df.isStreaming:
                with StreamCounts(self.spark, spec.table) as counts:
                    running = checked_stream(df, rules, path, self.checkpoint(spec), spec.layout, spec.table)
                    self.violations[spec.table] = counts.of(running)
            else:
                self.violations[spec.table] = write_checked(df, rules, path, spec.layout)
            self._link_quarantine(spec)
        elif df.isStreaming:
            append_stream(df, path, self.checkpoint(spec), spec.layout, spec.table).awaitTermination()
        else:
            replace_batch(df, path, spec.layout)

    def _write_changes(self, df, spec: Spec, path: str, opts: ChangeOptions, rules: RuleSet) -> None:
        """Warn, drop and fail rules stand in front of change capture; quarantine does not apply there."""
        mark = f"{self.checkpoint(spec, opts.flow_name or 'main')}.done"
        if opts.once and exists(self.spark, mark):
            return
        result = apply_quality(df, rules, spec.table) if rules else None
        checked = result.main if result else df
        if df.isStreaming:
            with StreamCounts(self.spark, spec.table) as counts:
                query, target = apply_changes_stream(
                    checked, path, self.checkpoint(spec, opts.flow_name or "main"), opts, buckets=self.buckets, publish_every=self.publish_every, name=spec.table
                )
                seen = counts.of(query)
            target.publish()
            self.rejected[spec.table] = target.rejects().count()
        else:
            # The rejects are written first: their pass also counts the violations, as it reads every row.
            rejects = f"{path}{REJECTS}"
            replace_batch(rejected_changes(checked, opts), rejects)
            self.rejected[spec.table] = read_published(self.spark, rejects).count()
            seen = result.metrics.get if result and result.metrics else {}
            replace_batch(apply_changes(checked, opts), path, spec.layout)
        if rules:
            self.violations[spec.table] = seen
        if opts.once:
            touch(self.spark, mark)


def _main_rows(df: DataFrame) -> DataFrame:
    return df.where(f"{ROUTE} = 'main'").drop(ROUTE) if ROUTE in df.columns else df
