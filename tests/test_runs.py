"""Onboarding and whole runs."""

import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.catalogue.metadata import _flows
from tierflow.functions.crypto import Cipher
from tierflow.plans import onboarding
from tierflow.plans.medallion import Hooks, MedallionRun
from tierflow.plans.onboarding import bronze_rows, compile_specs, onboard, read_onboarding, store_specs, with_layer
from tierflow.plans.specs import BronzeSpec, GoldSpec, SilverSpec, load_specs, spec_schema
from tierflow.sources.storage import current_version, publish, read_published
from tierflow.streaming.sinks import FanOutTarget, fan_out_stream

RULES = {"expect_or_drop": {"has_id": "id IS NOT NULL"}, "expect_or_quarantine": {"no_id": "id IS NULL"}}


@pytest.fixture
def metadata(tmp_path):
    """One nested and one flat flow with their side files."""
    (tmp_path / "rules.json").write_text(json.dumps(RULES))
    (tmp_path / "people.ddl").write_text("id string, name string, op string, day string")
    (tmp_path / "silver.json").write_text(
        json.dumps([{"target_table": "people", "select_exp": ["id", "upper(name) AS name", "op", "day"], "where_clause": ["name <> 'X'"]}])
    )
    (tmp_path / "gold.json").write_text(
        json.dumps(
            [
                {
                    "target_table": "names",
                    "sources": [
                        {"reference_name": "p_vw", "source_table_dev": "lake.fine.people", "filter_condition": "id > 0", "is_streaming": "false", "pii_fields": {"x": None}}
                    ],
                    "sql_views": [{"reference_name": "n_vw", "sql_condition": "SELECT count(DISTINCT name) AS n FROM live.p_vw"}],
                }
            ]
        )
    )
    (tmp_path / "in").mkdir()
    feed = [
        {"id": "1", "name": "ann", "op": "U", "day": "1"},
        {"id": "2", "name": "bob", "op": "U", "day": "1"},
        {"id": "1", "name": "anna", "op": "U", "day": "2"},
        {"id": "2", "op": "D", "name": "bob", "day": "3"},
        {"name": "nobody", "op": "U", "day": "1"},
        {"id": "3", "name": "x", "op": "U", "day": "1"},
    ]
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(r) for r in feed))
    details = {"catalog": "lake", "schema": "raw", "table": "people"}
    nested = {
        "data_flow_id": "1", "data_flow_group": "g", "source_format": "cloudFiles",
        "source_details_dev": {"source_path_dev": str(tmp_path / "in"), "source_schema_path": str(tmp_path / "people.ddl"), "source_path_prd": "/prd"},
        "bronze_reader_options": {"cloudFiles.format": "json"},
        "bronze_dev": {
            "target_details": details, "bronze_data_quality_expectations_json_dev": str(tmp_path / "rules.json"), "is_streaming": "true",
            "bronze_writer_config_options": {"includeIngestionTimeAsColumn": "true"}, "target_pii_fields": {"name": "string"},
            "bronze_quarantine_table": "people_q", "bronze_database_quarantine_dev": "rej", "partition_columns": "day",
        },
        "silver_dev": {
            "target_details": {"catalog": "lake", "schema": "fine", "table": "people"}, "silver_transformation_json_dev": str(tmp_path / "silver.json"),
            "target_pii_fields": {"name": "string"},
            "cdc_apply_changes": {"keys": ["id"], "sequence_by": "day", "scd_type": "1", "apply_as_deletes": "op = 'D'", "except_column_list": ["op", "day"]},
        },
        "gold_dev": {"target_details": {"catalog": "lake", "schema": "mart", "table": "names"}, "gold_transformation_json_dev": str(tmp_path / "gold.json")},
        "metadata": {"tags": ["a"]},
    }
    flat = {
        "data_flow_id": "2", "data_flow_group": "h", "source_format": "snapshot",
        "source_details": {"source_path_dev": str(tmp_path / "LOAD_"), "snapshot_format": "csv"}, "bronze_reader_options": {"header": "true"},
        "bronze_database_dev": "raw", "bronze_table": "stores", "bronze_apply_changes_from_snapshot": {"keys": ["id"], "scd_type": "2"},
        "bronze_table_properties": {"quality": "bronze"},
        "bronze_append_flows": [
            {"name": "extra", "create_streaming_table": False, "source_format": "cloudFiles", "once": True,
             "source_details": {"source_path_dev": str(tmp_path / "more"), "source_schema_path": str(tmp_path / "people.ddl")},
             "reader_options": {"cloudFiles.format": "json"}}
        ],
    }
    path = tmp_path / "flows.json"
    path.write_text(json.dumps([nested, flat]))
    return tmp_path


def compiled(spark, metadata, layer):
    return compile_specs(spark, str(metadata / "flows.json"), layer, "dev", "v1", "ann")


def test_bronze_specs_of_both_layouts(spark, metadata):
    one, two = compiled(spark, metadata, "bronze").orderBy("dataFlowId").collect()
    assert one.targetDetails == {"database": "lake.raw", "table": "people"} and one.partitionColumns == ["day"]
    assert one.sourceDetails["path"].endswith("/in") and "source_path_prd" not in one.sourceDetails
    assert json.loads(one.dataQualityExpectations) == RULES
    assert [f["name"] for f in json.loads(one.schema)["fields"]] == ["id", "name", "op", "day"]
    assert one.quarantineTargetDetails == {"database": "rej", "table": "people_q"} and one.metadata["tags"] == '["a"]'
    assert one.targetPiiFields == {"name": "string"} and one.cdcApplyChanges is None
    assert two.targetDetails == {"database": "raw", "table": "stores"} and two.tableProperties == {"quality": "bronze"}
    assert json.loads(two.applyChangesFromSnapshot) == {"keys": ["id"], "scd_type": "2"}
    assert json.loads(two.appendFlows)[0]["source_details"]["path"].endswith("/more") and "extra" in two.appendFlowsSchemas
    assert (two.version, two.createdBy, two.updatedBy) == ("v1", "ann", "ann")


def test_schema_mapper_replaces_the_ddl_parser(spark, metadata):
    seen = []

    def mapper(path, session):
        seen.append(path.rsplit("/", 1)[-1])
        return T.StructType([T.StructField("mapped", T.StringType())])

    specs = compile_specs(spark, str(metadata / "flows.json"), "bronze", "dev", "v1", "ann", mapper=mapper)
    one = specs.where("dataFlowId = '1'").first()
    assert json.loads(one.schema)["fields"][0]["name"] == "mapped" and set(seen) == {"people.ddl"}


def test_silver_and_gold_specs(spark, metadata):
    (silver,) = compiled(spark, metadata, "silver").collect()
    assert silver.sourceDetails == {"database": "lake.raw", "table": "people"} and silver.whereClause == ["name <> 'X'"]
    (gold,) = compiled(spark, metadata, "gold").collect()
    assert gold.views[0].reference_name == "n_vw" and gold.sources[0].source_table == "lake.fine.people"
    assert gold.sources[0].pii_fields == {} and gold.isStreaming == "false" and gold.env == "dev"


@pytest.mark.parametrize(
    "change, message",
    [
        ({"source_format": "xml"}, "source_format"),
        ({"bronze_reader_options": None}, "bronze_reader_options"),
        ({"data_flow_group": None}, "data_flow_group"),
        ({"source_details_dev": None}, "source_details"),
    ],
)
def test_incomplete_flows_are_refused(spark, metadata, change, message):
    flows = json.loads((metadata / "flows.json").read_text())[:1]
    flows[0].update(change)
    (metadata / "flows.json").write_text(json.dumps(flows))
    with pytest.raises(PySparkException, match=message):
        compiled(spark, metadata, "bronze").collect()


def test_cluster_and_zorder_conflict(spark, metadata):
    flows = json.loads((metadata / "flows.json").read_text())[:1]
    flows[0]["bronze_dev"] |= {"cluster_by": ["id"], "bronze_table_properties": {"pipelines.autoOptimize.zOrderCols": "id"}}
    (metadata / "flows.json").write_text(json.dumps(flows))
    with pytest.raises(PySparkException, match="z-order"):
        compiled(spark, metadata, "bronze").collect()


def test_duplicate_ids_and_wrong_extension(spark, metadata):
    flows = json.loads((metadata / "flows.json").read_text())
    (metadata / "twice.json").write_text(json.dumps(flows + flows[:1]))
    with pytest.raises(ValueError, match="more than once"):
        read_onboarding(spark, str(metadata / "twice.json"))
    with pytest.raises(ValueError, match="JSON"):
        read_onboarding(spark, "flows.yaml")


def test_merge_keeps_creation_columns_and_filters_combine(spark, metadata):
    table = str(metadata / "specs")
    store_specs(compiled(spark, metadata, "bronze"), table)
    later = compile_specs(spark, str(metadata / "flows.json"), "bronze", "dev", "v2", "bob", F.lit("2031-01-01").cast("timestamp"))
    store_specs(later.where("dataFlowId = '2'"), table, overwrite=False)
    stored = read_published(spark, table)
    assert rows(stored, "dataFlowId", "version", "createdBy", "updatedBy") == [("1", "v1", "ann", "ann"), ("2", "v2", "ann", "bob")]
    assert [s.dataFlowId for s in load_specs(stored, "bronze", group="g")] == ["1"]
    assert load_specs(stored, "bronze", group="g", ids="2, 3") == []
    assert [s.dataFlowId for s in load_specs(stored.drop("appendFlows"), "bronze", ids=["2"])] == ["2"]
    assert set(spec_schema("bronze").names) >= {"dataFlowId", "appendFlows", "metadata"}


def test_three_layers_from_an_onboarding_file(spark, metadata):
    tables = {layer: str(metadata / "specs" / layer) for layer in ("bronze", "silver", "gold")}
    onboard(spark, str(metadata / "flows.json"), tables, "dev", "v1", "ann")
    specs = {layer: load_specs(read_published(spark, path), layer, group="g") for layer, path in tables.items()}
    cipher = Cipher("0123456789abcdef")
    seen = []
    hooks = Hooks(transforms={"silver": lambda df, spec: seen.append(spec.table) or df})
    run = MedallionRun(spark, str(metadata / "lake"), cipher=cipher, hooks=hooks, buckets=4)
    run.run("bronze_silver", specs)
    assert run.violations["lake.raw.people"] == {"rows": 6, "has_id": 1}
    run.run("bronze_silver", specs)  # finds nothing new
    assert seen == ["lake.fine.people"] * 2
    run.run("gold", specs)
    bronze = run.read(specs["bronze"][0])
    assert bronze.count() == 5 and "ingestion_timestamp" in bronze.columns
    assert bronze.where("name = 'ann'").count() == 0  # encrypted at rest
    assert run.quarantine(specs["bronze"][0]).count() == 1
    assert run.open(run.path({"database": "rej", "table": "people_q"})).count() == 1
    assert rows(run.read(specs["silver"][0]), "id") == [("1",)]
    assert rows(run.read(specs["gold"][0])) == [(1,)]


def test_snapshot_flow_runs_on_where_it_stopped(spark, metadata):
    (metadata / "LOAD_1.csv").write_text("id,address\n1,a\n2,b\n")
    (metadata / "LOAD_2.csv").write_text("id,address\n1,a2\n")
    (metadata / "more").mkdir()
    (metadata / "more" / "x.json").write_text('{"id": "9"}')
    specs = [BronzeSpec(**{k: v for k, v in r.asDict(recursive=True).items() if k in BronzeSpec.__dataclass_fields__})
             for r in compiled(spark, metadata, "bronze").where("dataFlowId = '2'").collect()]
    run = MedallionRun(spark, str(metadata / "lake"))
    run.run("bronze", {"bronze": specs})
    (metadata / "LOAD_3.csv").write_text("id,address\n1,a2\n2,c\n")
    (metadata / "more" / "y.json").write_text('{"id": "10"}')
    run.run("bronze", {"bronze": specs})
    path = run.path(specs[0].targetDetails)
    assert current_version(spark, path) == 3
    got = sorted(tuple(r) for r in run.open(path).selectExpr("id", "address", "__START_AT", "coalesce(__END_AT, 0)").collect())
    assert got == [("1", "a", 1, 2), ("1", "a2", 2, 0), ("2", "b", 1, 2), ("2", "c", 3, 0)]
    # The one-time append flow ran once only.
    assert rows(run.read(specs[0]).where("address IS NULL"), "id") == [("9",)]


def test_batch_flows_cdc_type2_and_once(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "x", 1)], "id int, v string, s int").write.parquet(str(tmp_path / "in"))
    cdc = {"keys": ["id"], "sequence_by": "s", "scd_type": "2", "once": "true", "except_column_list": ["s"]}
    bronze = BronzeSpec(
        "1", "g", targetDetails={"database": "raw", "table": "t"}, sourceFormat="parquet", sourceDetails={"path": str(tmp_path / "in")},
        readerConfigOptions={}, isStreaming="false", cdcApplyChanges=json.dumps(cdc),
        dataQualityExpectations=json.dumps({"expect_all_or_drop": {"few": "id < 2"}}),
    )
    run = MedallionRun(spark, str(tmp_path / "lake"))
    run.run("bronze", {"bronze": [bronze]})
    run.run("bronze", {"bronze": [bronze]})
    assert current_version(spark, run.path(bronze.targetDetails)) == 1
    assert rows(run.read(bronze)) == [(1, "a", 1, 2), (1, "b", 2, None)]
    silver = SilverSpec(
        "1", "g", targetDetails={"database": "fine", "table": "t"}, sourceDetails={"database": "raw", "table": "t"}, selectExp=["id", "v"],
        whereClause=["v = 'b'"], isStreaming="false",
    )
    run.run("silver", {"silver": [silver]})
    assert rows(run.read(silver)) == [(1, "b")]


def test_rules_in_front_of_streaming_cdc(spark, tmp_path):
    spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "x", 1)], "id int, v string, s int").write.parquet(str(tmp_path / "in"))
    bronze = BronzeSpec(
        "1", "g", targetDetails={"database": "raw", "table": "c"}, sourceFormat="parquet", sourceDetails={"path": str(tmp_path / "in")},
        readerConfigOptions={}, cdcApplyChanges=json.dumps({"keys": ["id"], "sequence_by": "s", "scd_type": "1"}),
        dataQualityExpectations=json.dumps({"expect": {"a": "v = 'a'"}, "expect_or_drop": {"few": "id < 2"}}),
    )
    run = MedallionRun(spark, str(tmp_path / "lake"), buckets=2)
    run.run("bronze", {"bronze": [bronze]})
    assert rows(run.read(bronze)) == [(1, "b", 2)]


def test_streaming_gold_target(spark, tmp_path):
    spark.range(6).write.parquet(str(tmp_path / "in"))
    bronze = BronzeSpec(
        "1", "g", targetDetails={"database": "raw", "table": "n"}, sourceFormat="parquet", sourceDetails={"path": str(tmp_path / "in")}, readerConfigOptions={}
    )
    gold = GoldSpec(
        "2", "g", targetDetails={"database": "mart", "table": "even"}, isStreaming="true", env="dev",
        sources=[{"reference_name": "n_vw", "source_table": "raw.n", "filter_condition": "", "is_streaming": "true", "pii_fields": {}}],
        views=[{"reference_name": "even_vw", "sql_condition": "SELECT id FROM live.n_vw WHERE id % 2 = 0"}],
    )
    run = MedallionRun(spark, str(tmp_path / "lake"))
    run.run("bronze_gold", {"bronze": [bronze], "gold": [gold]})
    spark.range(6, 9).write.mode("append").parquet(str(tmp_path / "in"))
    run.run("bronze_gold", {"bronze": [bronze], "gold": [gold]})
    assert rows(run.read(gold)) == [(0,), (2,), (4,), (6,), (8,)]
    with pytest.raises(ValueError, match="unknown layers"):
        run.run("platinum", {})


def test_fan_out_replay_replaces_its_batch(spark, tmp_path):
    spark.range(4).write.parquet(str(tmp_path / "in"))
    feed = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    targets = [FanOutTarget("low", ["id"], ["id < 2"]), FanOutTarget("all")]
    for checkpoint in ("c1", "c2"):  # the second checkpoint plays batch 0 again
        fan_out_stream(feed, targets, str(tmp_path / "out"), str(tmp_path / checkpoint)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "low")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out" / "all")).count() == 4


def test_cdc_keeps_counts_and_rejects(spark, tmp_path):
    """Violations and changes without a sequence are reported and kept, in batch and stream."""
    rows_in = [(1, 1, "a"), (1, None, "b"), (2, 5, None), (3, 7, "c")]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows_in, "k int, seq int, v string").repartition(2).write.parquet(source)
    for streaming in (False, True):
        root = str(tmp_path / f"lake{streaming}")
        spec = BronzeSpec(
            "1", "g", targetDetails={"database": "raw", "table": "t"}, sourceFormat="parquet", sourceDetails={"path": source}, readerConfigOptions={},
            schema=spark.read.parquet(source).schema.json(), dataQualityExpectations=json.dumps({"expect": {"has_v": "v IS NOT NULL"}}),
            cdcApplyChanges=json.dumps({"keys": ["k"], "sequence_by": "seq", "scd_type": "1"}), isStreaming=str(streaming).lower(),
        )
        run = MedallionRun(spark, root, buckets=2)
        run.run("bronze", {"bronze": [spec]})
        assert (streaming, run.violations[spec.table]["has_v"], run.rejected[spec.table]) == (streaming, 1, 1)
        assert rows(run.rejects(spec), "k", "v") == [(1, "b")]
        assert run.read(spec).count() == 3


def test_stream_counts_are_complete(spark, tmp_path):
    """More micro-batches than a query's progress remembers."""
    from tierflow.operators.quality import RuleSet, StreamCounts
    from tierflow.streaming.sinks import checked_stream

    source = str(tmp_path / "in")
    spark.range(130).repartition(130).write.parquet(source)
    feed = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(source)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    try:
        with StreamCounts(spark, "many") as counts:
            running = checked_stream(feed, RuleSet(warn={"even": "id % 2 = 0"}), str(tmp_path / "out"), str(tmp_path / "cp"), name="many")
            assert counts.of(running) == {"rows": 130, "even": 65}
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)


def test_version_zero_and_gaps(spark, tmp_path):

    from tierflow.sources.tables import numbered_files, snapshot_series

    for n in (0, 1, 3):
        spark.range(n + 1).write.parquet(f"{tmp_path}/in/load_{n}.parquet")
    following = numbered_files(spark, f"{tmp_path}/in/load_{{version}}.parquet", "parquet")
    assert [v for _, v in snapshot_series(following)] == [0, 1, 3]
    assert publish(spark.range(1), f"{tmp_path}/t", version=0) == 0 and current_version(spark, f"{tmp_path}/t") == 0
    assert publish(spark.range(2), f"{tmp_path}/t") == 1 and read_published(spark, f"{tmp_path}/t", 0).count() == 1


def _copies(tmp_path, n, source, **more):
    return [
        BronzeSpec(str(k), "g", targetDetails={"database": "raw", "table": f"t{k}"}, sourceFormat="parquet", sourceDetails={"path": source}, readerConfigOptions={}, isStreaming="false", **more)
        for k in range(n)
    ]


def test_flows_of_a_layer_run_side_by_side(spark, tmp_path):
    import threading

    source, met = str(tmp_path / "in"), threading.Barrier(3, timeout=60)
    spark.range(5).write.parquet(source)

    def hook(df, spec):
        if spec.dataFlowId < "3":
            met.wait()  # passes only if three flows are at work at once
        return df

    run = MedallionRun(spark, str(tmp_path / "lake"), hooks=Hooks(transforms={"bronze": hook}), flows_at_once=3)
    specs = _copies(tmp_path, 5, source)
    assert run.run("bronze", {"bronze": specs}) == [s.table for s in specs]
    assert [run.read(s).count() for s in specs] == [5] * 5


def test_flows_wait_for_what_they_read(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    first = _copies(tmp_path, 1, source)[0]
    second = BronzeSpec(
        "9", "g", targetDetails={"database": "raw", "table": "behind"}, sourceFormat="delta", sourceDetails={"source_database": "raw", "source_table": "t0"}, readerConfigOptions={}, isStreaming="false"
    )
    run = MedallionRun(spark, str(tmp_path / "lake"))
    assert run._waits(second, first) and not run._waits(_copies(tmp_path, 2, source)[1], first)
    run.run("bronze", {"bronze": [first, second]})
    assert run.read(second).count() == 5


def test_a_failed_flow_stops_the_others(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    started = []

    def hook(df, spec):
        started.append(spec.dataFlowId)
        if spec.dataFlowId == "0":
            raise ValueError("no such luck")
        return df.where("coalesce(reflect('java.lang.Thread', 'sleep', 60000L), 'x') = 'x'") if spec.dataFlowId == "1" else df

    run = MedallionRun(spark, str(tmp_path / "lake"), hooks=Hooks(transforms={"bronze": hook}), flows_at_once=2)
    specs = _copies(tmp_path, 2, source)
    with pytest.raises(ValueError, match="no such luck"):
        run.run("bronze", {"bronze": specs})
    assert set(started) <= {"0", "1"}


def test_side_files_are_read_in_a_constant_number_of_jobs(spark, metadata):
    flows = json.loads((metadata / "flows.json").read_text())
    many = []
    for k in range(30):
        flow = json.loads(json.dumps(flows[0]))
        (metadata / f"rules {k}.json").write_text(json.dumps({"expect": {f"r{k}": f"id <> '{k}'"}}))
        (metadata / f"people{k}.ddl").write_text(f"id string, c{k} string")
        flow |= {"data_flow_id": str(k)}
        flow["source_details_dev"]["source_schema_path"] = str(metadata / f"people{k}.ddl")
        flow["bronze_dev"]["bronze_data_quality_expectations_json_dev"] = f"file://{metadata}/rules {k}.json" if k % 2 else str(metadata / f"rules {k}.json")
        many.append(flow)

    def jobs(part):
        (metadata / "flows.json").write_text(json.dumps(part))
        spark.sparkContext.setJobGroup(f"onboard{len(part)}", "")
        try:
            rows_of = {r.dataFlowId: r for r in compiled(spark, metadata, "bronze").collect()}
            return rows_of, len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"onboard{len(part)}"))
        finally:
            spark.sparkContext.setJobGroup("", "")

    few, n_few = jobs(many[:3])
    told, n_many = jobs(many)
    assert n_many <= n_few + 2 and len(told) == 30
    for k in range(30):
        assert f"r{k}" in told[str(k)].dataQualityExpectations and json.loads(told[str(k)].schema)["fields"][1]["name"] == f"c{k}"


def test_flows_of_one_file_are_spread_and_read_once(spark, tmp_path):
    flow = {"data_flow_group": "g", "source_format": "csv", "source_details_dev": {"source_path_dev": "/in"}, "bronze_reader_options": {}, "bronze_table": "t"}
    (tmp_path / "flows.json").write_text(json.dumps([{**flow, "data_flow_id": str(i)} for i in range(64)]))
    made = bronze_rows(read_onboarding(spark, str(tmp_path / "flows.json")), "dev")
    assert made.rdd.getNumPartitions() > 1 and made.count() == 64
    # The filter of the rules takes no copies of the columns it reads, nor of the texts they come from.
    assert made._jdf.queryExecution().optimizedPlan().toString().count("$.source_format") == 1
    layer = with_layer(_flows(spark, "/root/testdata/sf0.001"), "bronze", "dev")
    filters = [line for line in layer._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert filters and not any("p_partkey" in line for line in filters) and layer.rdd.getNumPartitions() > 1


def test_paths_of_all_kinds_come_from_one_job(spark, monkeypatch):
    asked = []
    found = onboarding._distinct
    monkeypatch.setattr(onboarding, "_distinct", lambda df, **cols: asked.append(sorted(cols)) or found(df, **cols))
    assert onboarding.gold_rows(_flows(spark, "/root/testdata/sf0.001"), "dev").count() == 50
    assert asked == [["ddl", "flows", "rules", "transforms"]]
