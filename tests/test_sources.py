import pytest
from conftest import rows
from pyspark.sql import types as T

from tierflow.plans.views import ViewRegistry, build_targets, strip_live, view_chain
from tierflow.session import scratch_dir
from tierflow.sources import kafka
from tierflow.sources.files import FileSource, infer_schema, read_files
from tierflow.sources.schemas import ddl_schema, multiline_json
from tierflow.sources.tables import for_environment, numbered_files
from tierflow.streaming.sinks import AppendFlow, Layout, append_batch, column_names, overwrite_merging
from tierflow.sources.storage import publish, read_published

TLS = {
    "kafka.bootstrap.servers": "h:9092",
    "subscribe": "t",
    "kafka.security.protocol": "SSL",
    "kafka.ssl.truststore.location": "/t",
    "kafka.ssl.keystore.location": "/k",
    "kafka.ssl.truststore.secrets.scope": "s",
    "kafka.ssl.truststore.secrets.key": "tk",
    "kafka.ssl.keystore.secrets.scope": "s",
    "kafka.ssl.keystore.secrets.key": "kk",
}


def test_kafka_options():
    got = kafka.kafka_options(TLS, {"subscribe": "other", "startingOffsets": "latest", "decode_headers": "true"}, lambda s, k: f"{s}/{k}")
    assert got["subscribe"] == "other" and got["kafka.ssl.keystore.password"] == "s/kk"
    assert "decode_headers" not in kafka.connector_options(got)
    plain = kafka.kafka_options({"kafka.bootstrap.servers": "h", "subscribe": "t"}, None)
    assert plain == {"kafka.bootstrap.servers": "h", "subscribe": "t"}
    with pytest.raises(ValueError, match="TLS"):
        kafka.kafka_options({k: v for k, v in TLS.items() if not k.endswith("secrets.key")}, {}, lambda s, k: "x")


def test_eventhub_options():
    details = {
        "eventhub.namespace": "ns", "eventhub.port": "9093", "eventhub.name": "hub", "eventhub.accessKeyName": "reader",
        "eventhub.secretsScopeName": "scope",
    }
    got = kafka.eventhub_options(details, {"startingOffsets": "earliest"}, lambda s, k: f"{s}:{k}")
    assert got["kafka.bootstrap.servers"] == "ns.servicebus.windows.net:9093" and got["subscribe"] == "hub"
    assert "SharedAccessKey=scope:reader" in got["kafka.sasl.jaas.config"]
    named = kafka.eventhub_options({**details, "eventhub.accessKeySecretName": "other"}, None, lambda s, k: k)
    assert "SharedAccessKey=other" in named["kafka.sasl.jaas.config"]


def test_message_kind():
    assert kafka.message_kind({"custom_decode_pmu": "true", "custom_decode_trasaction_type": "RACE_PMU"}) == "RACE_PMU"
    assert kafka.message_kind({"custom_decode_fo": "false", "custom_decode_trasaction_type": "BET_FO"}) is None


def test_ddl_files_in_both_styles(spark, tmp_path):
    for i, ddl in enumerate(("id bigint, s struct<a: int>\n", "id: bigint,\n s: struct<a: int>")):
        (tmp_path / f"{i}.ddl").write_text(ddl)
        assert ddl_schema(spark, str(tmp_path / f"{i}.ddl")).simpleString() == "struct<id:bigint,s:struct<a:int>>"


def test_csv_with_options_and_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id;v\n1;x\n2;y\n")
    schema = T.StructType.fromDDL("id int, v string")
    options = {"header": "true", "sep": ";"}
    assert rows(read_files(spark, FileSource(str(tmp_path), "csv", options, schema))) == [(1, "x"), (2, "y")]
    assert infer_schema(spark, FileSource(str(tmp_path), "csv", options)).simpleString() == "struct<id:int,v:string>"
    with pytest.raises(ValueError, match="not supported"):
        read_files(spark, FileSource(str(tmp_path), "xml2"))


def test_rescued_files(spark, tmp_path):
    lines = ['{"id": 1, "n": {"a": 1}}', '{"id": "x", "extra": [1]}', '{"id": 3', "", '{"id": null, "n": null}', '{"id": 5, "n": 7}']
    (tmp_path / "a.json").write_text("\n".join(lines))
    source = FileSource(
        str(tmp_path), "cloudFiles", {"cloudFiles.format": "json", "cloudFiles.rescuedDataColumn": "_rescued_data"},
        T.StructType.fromDDL("id bigint, n struct<a: int>, _rescued_data string"),
        metadata={"select_metadata_cols": {"file": "_metadata.file_name"}},
    )
    got = {r["_rescued_data"]: (r["id"], r["n"], r["file"]) for r in read_files(spark, source).collect()}
    assert set(got) == {None, '{"id":"x","extra":[1]}', '{"id": 3', '{"n":7}'}
    assert got['{"id": 3'] == (None, None, "a.json") and got['{"n":7}'][0] == 5
    assert read_files(spark, source).where("_rescued_data IS NULL").count() == 2


def test_rescued_csv_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\nbad,y\n3,z,extra\n")
    source = FileSource(
        str(tmp_path), "cloudFiles",
        {"cloudFiles.format": "csv", "cloudFiles.rescuedDataColumn": "_rescued_data", "header": "true"},
        T.StructType.fromDDL("id int, v string, _rescued_data string"),
    )
    got = rows(read_files(spark, source), "v", "_rescued_data")
    assert got == [("x", None), ("y", "bad,y"), ("z", "3,z,extra")]
    assert rows(read_files(spark, source).where("_rescued_data IS NULL"), "v") == [("x",)]
    assert read_files(spark, source).where("_rescued_data IS NOT NULL").count() == 2


def test_file_metadata_forms(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "t"))
    base = FileSource(str(tmp_path / "t"), "parquet", metadata={"select_metadata_cols": {"size": "_metadata.file_size"}})
    assert read_files(spark, base).columns == ["id", "size"]
    on = {"include_autoloader_metadata_column": "True"}
    assert read_files(spark, FileSource(base.path, "parquet", metadata=on)).columns == ["id", "source_metadata"]
    named = {**on, "autoloader_metadata_col_name": "m"}
    assert read_files(spark, FileSource(base.path, "parquet", metadata=named)).columns == ["id", "m"]


def test_numbered_snapshots(spark, tmp_path):
    for i in (1, 2):
        (tmp_path / f"LOAD_{i}.csv").write_text(f"id\n{i}\n")
    following = numbered_files(spark, f"{tmp_path}/LOAD_{{version}}.csv", "csv", {"header": "true"})
    df, version = following(1)
    assert version == 2 and rows(df) == [("2",)]
    assert following(2) is None


def test_small_helpers(spark, tmp_path):
    assert column_names("a, b,") == ["a", "b"] and column_names(["", " "]) is None and column_names(None) is None
    assert for_environment({"t_dev": 1, "t": 2}, "t", "dev") == 1 and for_environment({"t": 2}, "t", "prd") == 2
    with pytest.raises(ValueError, match="z-order"):
        Layout(cluster_by=["a"], properties={"pipelines.autoOptimize.zOrderCols": "a"})
    with pytest.raises(ValueError, match="mandatory"):
        AppendFlow.of({"name": "x"})
    assert AppendFlow.of({"name": "x", "source_format": "delta", "create_streaming_table": False, "source_details": {}, "once": "true"}).once
    (tmp_path / "j.json").write_text('[{"a": 1}, {"a": 2}]')
    assert rows(multiline_json(spark, str(tmp_path / "j.json"), "a int")) == [(1,), (2,)]


class FakeSession:
    """Just enough of a session to ask for its settings."""

    def __init__(self, master, shared=None):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_comes_from_the_session():
    assert scratch_dir(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch_dir(FakeSession("local[2]")).endswith("tierflow-scratch")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession("yarn"))


def test_frequent_cluster_value_is_spread(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 20_000, 1, 8).selectExpr("IF(id % 10 < 9, 5, id) AS k", "'same' AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        append_batch(df, path, Layout(cluster_by=["k"]))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = spark.read.parquet(path)
    assert back.count() == 20_000
    assert back.where("k = 5").select("_metadata.file_name").distinct().count() > 1


def test_versions_and_schema_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_merging(spark.sql("SELECT 1 AS a, 'x' AS b"), path)
    overwrite_merging(spark.sql("SELECT 2 AS a, 3 AS c"), path)
    assert rows(read_published(spark, path)) == [(2, None, 3)]
    publish(read_published(spark, path).selectExpr("a + 1 AS a"), path)
    assert rows(read_published(spark, path)) == [(3,)] and rows(read_published(spark, path, 1)) == [(1, "x")]
    with pytest.raises(ValueError, match="exists already"):
        publish(spark.range(1), path, version=2)
    with pytest.raises(FileNotFoundError):
        read_published(spark, str(tmp_path / "none"))


def test_view_prefix_and_errors(spark):
    assert strip_live("select * from LIVE.a join live.`b c` using (x)") == "select * from a join `b c` using (x)"
    registry = ViewRegistry(spark)
    with pytest.raises(ValueError, match="at least one"):
        view_chain(registry, [])
    loop = [
        {"target": "a", "views": [{"name": "va", "sql": "SELECT * FROM vb"}]},
        {"target": "b", "views": [{"name": "vb", "sql": "SELECT * FROM va"}]},
    ]
    with pytest.raises(ValueError, match="wait for each other"):
        build_targets(registry, loop)


def test_streaming_view_chain(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    registry = ViewRegistry(spark)
    registry.register("numbers", spark.readStream.schema("id bigint").parquet(str(tmp_path / "in")))
    target = {
        "target": "t",
        "sources": [{"reference_name": "n_vw", "source_table": "numbers", "filter_condition": "id > 3", "is_streaming": "true", "pii_fields": {}}],
        "views": [{"name": "even_vw", "sql": "SELECT id FROM live.n_vw WHERE id % 2 = 0"}],
    }
    out = build_targets(registry, [target], streaming=True)["t"]
    assert out.isStreaming
    running = out.writeStream.format("memory").queryName("chain_out").trigger(availableNow=True).start()
    running.awaitTermination()
    assert rows(spark.table("chain_out")) == [(4,), (6,), (8,)]

