"""Flattening, message decoding, encryption."""

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tierflow.functions import channels as ch
from tierflow.functions import decode
from tierflow.functions.crypto import Cipher, decrypt_columns, encrypt_columns
from tierflow.operators.flatten import flatten, flatten_by_spec
from tierflow.operators.messages import add_seed_rows, decode_messages
from tierflow.streaming.sinks import append_stream
from tierflow.operators.project import apply_hook, expand, output_schema, trim_names, where_all


def test_struct_columns_move_to_the_end(spark):
    df = spark.sql("SELECT named_struct('x', 1, 'y', named_struct('z', 2)) AS a, 3 AS b")
    assert flatten(df).columns == ["b", "a__x", "a__y__z"]


def test_root_arrays_need_a_name(spark):
    with pytest.raises(ValueError, match="name the column"):
        flatten(spark.sql("SELECT array(1) AS a, 2 AS b"))
    with pytest.raises(ValueError, match="name the column"):
        flatten(spark.sql("SELECT array(1) AS a, array(2) AS b"))
    with pytest.raises(ValueError, match="no column"):
        flatten(spark.sql("SELECT array(1) AS a, 2 AS b"), "c")


def test_named_array_drops_empty_rows_but_inner_ones_stay(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, array(named_struct('v', array(7, 8)))), (2, array(named_struct('v', array()))), (3, array()) t(id, a)"""
    )
    assert rows(flatten(df, "a")) == [(1, 7), (1, 8), (2, None)]


def test_colliding_names_raise(spark):
    with pytest.raises(ValueError, match="twice"):
        flatten(spark.sql("SELECT 1 AS id, array(named_struct('id', 2)) AS a"), "a")


def test_name_may_appear_at_a_deeper_level(spark):
    df = spark.sql("SELECT named_struct('legs', array(named_struct('n', 1), named_struct('n', 2)), 'k', 5) AS h")
    assert rows(flatten(df, "h__legs")) == [(5, 1), (5, 2)]


def test_depth_guard_and_flags(spark):
    df = spark.sql("SELECT named_struct('a', named_struct('b', named_struct('c', 1))) AS s")
    with pytest.raises(ValueError, match="nested deeper"):
        flatten(df, max_depth=0)
    assert flatten_by_spec(df, "false", None).columns == ["s"]
    assert flatten_by_spec(df, "TRUE", []).columns == ["s__a__b__c"]
    assert spark.range(1).select().columns == flatten(spark.range(1).select()).columns


def test_odd_names_survive(spark):
    df = spark.sql("SELECT named_struct('a.b', 1, 'c`d', 2) AS `x y`")
    assert flatten(df).columns == ["x y__a.b", "x y__c`d"]


def test_json_validity(spark):
    df = spark.createDataFrame([("{}",), ("[1]",), ("{",), (None,), ("",)], "t string")
    got = rows(df.select("t", decode.json_validity(F.col("t")).alias("v")).select("t", "v.is_error", F.col("v.error_details").isNull()))
    assert got == [(None, True, False), ("", True, False), ("[1]", False, True), ("{", True, False), ("{}", False, True)]
    decode.register_json_validity(spark)
    assert df.selectExpr("json_validity(t).is_error AS e").where("e").count() == 3


def test_header_helpers(spark):
    df = spark.sql(
        """SELECT array(named_struct('key', 'a', 'value', encode('1', 'UTF-8')), named_struct('key', 'b', 'value', encode('2', 'UTF-8')),
        named_struct('key', 'a', 'value', encode('3', 'UTF-8'))) AS h UNION ALL SELECT array() UNION ALL SELECT NULL"""
    ).select(decode.decode_headers(F.col("h")).alias("h"))
    first, as_map = decode.header_value(F.col("h"), "a"), decode.header_map(F.col("h"))
    assert rows(df.select(first, as_map["a"], F.size(as_map))) == [(None, None, None), (None, None, 0), ("1", "3", 2)]


def test_payload_column(spark):
    assert decode.payload_column(spark.sql("SELECT 1 AS a, X'01' AS b, 'x' AS Value")) == "Value"
    assert decode.payload_column(spark.sql("SELECT 1 AS a, X'01' AS b, X'02' AS c")) == "b"
    assert decode.payload_column(spark.sql("SELECT 1 AS a")) is None


def test_split_payload(spark):
    df = spark.createDataFrame([("a~|~b|c~|~", True), ("a~|~b", False), (None, True)], "t string, ok boolean")
    got = df.select(decode.split_payload(F.col("t"), F.col("ok")).alias("p")).collect()
    assert [r[0] for r in got] == [["a", "b|c", ""], [], None]


def test_unknown_kinds_and_seed_columns(spark):
    with pytest.raises(ValueError, match="unknown message kind"):
        decode_messages(spark.range(1), "OTHER")
    with pytest.raises(ValueError, match="schema"):
        decode_messages(spark.range(1), "BET_FO")
    with pytest.raises(ValueError, match="decoder"):
        decode_messages(spark.range(1), "RACE_PMU")
    with pytest.raises(ValueError, match="unknown columns"):
        add_seed_rows(spark.range(1), [{"nope": 1}])


def test_seed_rows_come_once_on_a_stream(spark, tmp_path):
    for _ in range(2):
        spark.range(5).write.mode("append").parquet(str(tmp_path / "in"))
        feed = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
        seeded = add_seed_rows(feed, [{"id": 98}, {"id": 99}], str(tmp_path / "seeds"))
        append_stream(seeded, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert [r[0] for r in rows(spark.read.parquet(str(tmp_path / "out")))] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4, 98, 99]


def test_projection_helpers(spark):
    df = spark.sql("SELECT 1 AS ` a `, named_struct('x', 2) AS s")
    assert trim_names(df).columns == ["a", "s"]
    assert expand(trim_names(df), "s", keep=["a"]).columns == ["a", "x"]
    assert where_all(df, [" ", ""]).count() == 1 and where_all(df, None).count() == 1
    assert output_schema(spark.range(3), ["id * 2 AS d"], ["d > 1"]).simpleString() == "struct<d:bigint>"
    assert apply_hook(spark.range(3), lambda d, spec: d.where(f"id = {spec}"), 2).count() == 1


values = st.lists(
    st.tuples(st.none() | st.text(max_size=12), st.none() | st.integers(-(2**31), 2**31 - 1), st.lists(st.text(max_size=4), max_size=3)),
    min_size=1,
    max_size=15,
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck), derandomize=True)
@given(values, st.sampled_from(["GCM", "ECB"]))
def test_decrypt_undoes_encrypt(spark, data, mode):
    df = spark.createDataFrame(data, "t string, n int, l array<string>")
    pii = {"T": "string", "n": "int", "l": "array<string>", "gone": "string"}
    cipher = Cipher("0123456789abcdef", mode)
    hidden = encrypt_columns(df, pii, cipher)
    assert [f.dataType.simpleString() for f in hidden.schema] == ["string"] * 3
    assert rows(decrypt_columns(hidden, pii, cipher)) == rows(df)


def test_wrong_key_raises_and_column_stays_sealed(spark):
    df = encrypt_columns(spark.sql("SELECT 'x' AS a"), {"a": "string"}, Cipher("0123456789abcdef"))
    with pytest.raises(PySparkException):
        decrypt_columns(df, {"a": "string"}, Cipher("fedcba9876543210")).collect()
    with pytest.raises(ValueError):
        Cipher()


def test_channels(spark):
    df = spark.createDataFrame(
        [("301", 5, 0, "RC ESC/EWallet"), ("A1", 17, 0, "TBAS"), (None, 1, 0, "TB Voice"), (None, 2, 26, "Racing Touch"), (None, 2, 9, "NA")],
        "c string, s int, t int, want string",
    )
    assert df.where(ch.fixed_odds_channel(F.col("c"), F.col("s"), F.col("t")) != F.col("want")).count() == 0
    ticket = spark.range(1).select(ch.ticket_number(F.lit("1900-01-03"), F.lit("ACP02"), F.lit(7)))
    assert rows(ticket) == [(2_021_000_000_007,)]
    assert str(rows(spark.range(1).select(ch.money(F.lit(12345))))[0][0]) == "123.45"
