"""Queries over nested rows, message records and encrypted columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.catalogue.shared import load, query, stream, work_dir
from tierflow.functions import decode
from tierflow.functions.crypto import Cipher, decrypt_columns, encrypt_columns, register_cipher_functions, with_decrypted
from tierflow.operators.flatten import flatten, flatten_by_spec
from tierflow.operators.messages import (
    JsonRoute,
    decode_binary_messages,
    decode_json_messages,
    decode_messages,
    record_metadata,
    with_text_headers,
)
from tierflow.operators.project import project_then_filter
from tierflow.operators.quality import expect_or_drop
from tierflow.sources.tables import sql_source
from tierflow.streaming.sinks import append_stream

# --- flatten ------------------------------------------------------------------------------------


def _nested_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with an array of structs of up to three entries, empty for every fourth order."""
    return load(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        """transform(filter(array(1, 2, 3), i -> i <= o_orderkey % 4),
          i -> named_struct('nr', i, 'part', o_orderkey * 10 + i, 'terms', named_struct('price', o_totalprice * i, 'rank', i + 1))) AS lines""",
    )


_LINES_SQL = "(SELECT o.*, i AS nr, o_orderkey * 10 + i AS part, o_totalprice * i AS price, i + 1 AS rank FROM orders o {kind} JOIN (VALUES (1), (2), (3)) n(i) ON i <= o_orderkey % 4)"


@query(
    "flatten_struct",
    """
    SELECT o_orderkey, o_custkey AS header__custkey, o_orderstatus AS header__state__status, o_totalprice AS header__state__price FROM orders""",
)
def flatten_struct(spark, sf):
    rows = load(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "named_struct('custkey', o_custkey, 'state', named_struct('status', o_orderstatus, 'price', o_totalprice)) AS header",
    )
    return flatten(rows)


@query(
    "flatten_array_named",
    "SELECT o_orderkey, o_custkey, o_orderstatus, nr, part, price AS terms__price, rank AS terms__rank FROM "
    + _LINES_SQL.format(kind="INNER"),
)
def flatten_array_named(spark, sf):
    return flatten_by_spec(_nested_orders(spark, sf), "true", ["lines"])


@query(
    "flatten_outer",
    """
    SELECT o_orderkey AS root__o_orderkey, o_custkey AS root__o_custkey, nr AS root__lines__nr, part AS root__lines__part,
      price AS root__lines__terms__price, rank AS root__lines__terms__rank FROM """
    + _LINES_SQL.format(kind="LEFT"),
    nullable=("root__lines__nr", "root__lines__part", "root__lines__terms__rank"),
)
def flatten_outer(spark, sf):
    rows = _nested_orders(spark, sf).select(F.struct("o_orderkey", "o_custkey", "lines").alias("root"))
    return flatten(rows)


@query(
    "flatten_root_array",
    "SELECT nr, part, price AS terms__price, rank AS terms__rank FROM " + _LINES_SQL.format(kind="INNER"),
)
def flatten_root_array(spark, sf):
    return flatten(_nested_orders(spark, sf).select("lines"))


@query(
    "flatten_struct_named",
    "SELECT c_custkey, c_name, c_nationkey AS home__nation, c_mktsegment AS home__segment FROM customer",
)
def flatten_struct_named(spark, sf):
    rows = load(spark, sf, "customer").selectExpr(
        "c_custkey", "named_struct('c_name', c_name, 'home', named_struct('nation', c_nationkey, 'segment', c_mktsegment)) AS person"
    )
    return flatten(rows, "person")


@query(
    "flatten_scalar_named",
    "SELECT c_custkey, c_name AS who__name FROM customer",
)
def flatten_scalar_named(spark, sf):
    rows = load(spark, sf, "customer").selectExpr("c_custkey", "named_struct('name', c_name) AS who")
    return flatten(rows, "c_custkey")


@query(
    "flatten_two_arrays",
    """
    SELECT e.event_id AS root__event_id, a.x AS root__letters, b.y AS root__numbers
    FROM events e LEFT JOIN (VALUES (0, 'a'), (0, 'b'), (1, 'c')) a(m, x) ON e.event_id % 3 = a.m
    LEFT JOIN (VALUES (0, 1), (0, 2)) b(m, y) ON e.event_id % 2 = b.m""",
    nullable=("root__numbers",),
)
def flatten_two_arrays(spark, sf):
    rows = load(spark, sf, "events").selectExpr(
        """named_struct('event_id', event_id,
          'letters', CASE event_id % 3 WHEN 0 THEN array('a', 'b') WHEN 1 THEN array('c') ELSE array() END,
          'numbers', CASE event_id % 2 WHEN 0 THEN array(1, 2) END) AS root"""
    )
    return flatten(rows)


# --- message records ----------------------------------------------------------------------------

_BODY = """CASE
    WHEN event_id % 31 = 0 THEN ' empty '
    WHEN event_id % 37 = 0 THEN NULL
    WHEN event_id % 41 = 0 THEN '{"activityType":"1",'
    ELSE concat('{"activityType":"', CAST(1 + event_id % 3 AS STRING), '","ticket":{"sportId":"', CAST(1 + user_id % 2 AS STRING),
      '","ticketStatus":"', CAST(1 + event_id % 6 AS STRING), '","ticketId":', CAST(event_id AS STRING),
      ',"legs":[{"odds":', CAST(value AS STRING), ',"line":', CAST(user_id AS STRING), '},{"odds":1.5,"line":', CAST(event_id AS STRING), '}]}}') END"""
_BODY_SQL = _BODY.replace("STRING", "VARCHAR")
BODY_DDL = (
    "activityType string, ticket struct<sportId: string, ticketStatus: string, ticketId: bigint, "
    "legs: array<struct<odds: double, line: bigint>>>"
)


def records(events: DataFrame) -> DataFrame:
    """Events in the Kafka record layout: binary key, value and header values."""
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.encode(F.expr(_BODY), "UTF-8").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.expr(
            """array_compact(array(
              named_struct('key', 'ActivityCode', 'value', encode(CAST(5 + event_id % 4 AS STRING), 'UTF-8')),
              named_struct('key', 'ActivityId', 'value', encode(concat('act-', event_id), 'UTF-8')),
              CASE WHEN event_id % 2 = 0 THEN named_struct('key', 'VersionNumber', 'value', encode(CAST(user_id AS STRING), 'UTF-8')) END,
              CASE WHEN event_id % 10 = 0 THEN named_struct('key', 'ActivityCode', 'value', encode('late', 'UTF-8')) END))"""
        ).alias("headers"),
    )


@query(
    "headers_decode",
    """
    SELECT event_id AS "kafkaOffset", 'events' AS "kafkaTopic", CAST(event_id % 4 AS INT) AS "kafkaPartition", ts AS "kafkaMessageTimestamp",
      CAST(5 + event_id % 4 AS VARCHAR) AS first_code, CASE WHEN event_id % 10 = 0 THEN 'late' ELSE CAST(5 + event_id % 4 AS VARCHAR) END AS last_code,
      'act-' || event_id AS activity_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) END AS version
    FROM events""",
)
def headers_decode(spark, sf):
    rows = with_text_headers(records(load(spark, sf, "events")))
    by_key = decode.header_map(F.col("headers"))
    out = record_metadata(
        rows,
        [
            decode.header_value(F.col("headers"), "ActivityCode").alias("first_code"),
            by_key["ActivityCode"].alias("last_code"),
            by_key["ActivityId"].alias("activity_id"),
            decode.header_value(F.col("headers"), "VersionNumber").alias("version"),
        ],
    )
    return out.withColumn("kafkaMessageTimestamp", F.col("kafkaMessageTimestamp").cast("timestamp_ntz"))


@query(
    "header_filter_hex",
    "SELECT event_id, lower(hex(CAST(user_id AS VARCHAR))) AS key_hex FROM events WHERE 5 + event_id % 4 = 6",
)
def header_filter_hex(spark, sf):
    rows = with_text_headers(records(load(spark, sf, "events")))
    kept = rows.where(decode.header_value(F.col("headers"), "ActivityCode") == "6")
    return kept.select(F.col("offset").alias("event_id"), F.lower(decode.payload_hex(F.col("key"))).alias("key_hex"))


@query(
    "json_paths",
    f"""
    SELECT event_id, CASE WHEN ok THEN json_extract_string(b, '$.ticket.sportId') END AS sport_id,
      CASE WHEN ok THEN CAST(json_extract_string(b, '$.ticket.ticketId') AS BIGINT) END AS ticket_id,
      CASE WHEN ok THEN CAST(json_extract_string(b, '$.ticket.legs[0].odds') AS DOUBLE) END AS first_odds, CAST(NULL AS VARCHAR) AS absent
    FROM (SELECT event_id, b, coalesce(json_valid(b), false) AS ok FROM (SELECT event_id, {_BODY_SQL} AS b FROM events))""",
    nullable=("ticket_id",),
)
def json_paths(spark, sf):
    rows = records(load(spark, sf, "events")).select(F.col("offset").alias("event_id"), decode.payload_text(F.col("value")).alias("body"))
    return decode.json_paths(
        rows,
        F.col("body"),
        {
            "sport_id": "$.ticket.sportId",
            "ticket_id": ("$.ticket.ticketId", "bigint"),
            "first_odds": ("$.ticket.legs[0].odds", "double"),
            "absent": "$.ticket.nothing",
        },
    ).drop("body")


@query(
    "nested_index",
    f"""
    SELECT event_id, CAST(json_extract_string(b, '$.ticket.legs[1].line') AS BIGINT) AS second_line, CAST(NULL AS DOUBLE) AS fifth_odds
    FROM (SELECT event_id, {_BODY_SQL} AS b FROM events) WHERE coalesce(json_valid(b), false)""",
)
def nested_index(spark, sf):
    rows = records(load(spark, sf, "events")).withColumn("body", decode.payload_text(F.col("value")))
    rows = rows.where(decode.paths_present(F.col("body"), ["$.ticket.ticketId", "$.ticket.legs[0].odds"]))
    rows = rows.withColumn("doc", decode.parse_json_as(F.col("body"), BODY_DDL))
    return rows.select(
        F.col("offset").alias("event_id"),
        decode.nested_item(F.col("doc"), "ticket", "legs", 1, "line").alias("second_line"),
        decode.nested_item(F.col("doc"), "ticket", "legs", 4, "odds").alias("fifth_odds"),
    )


@query(
    "delimited_split",
    """
    SELECT conv_id, turn, len(parts) AS n_parts, parts[1] AS first_part, parts[2] AS second_part, len(CASE WHEN turn % 2 = 0 THEN parts ELSE [] END) AS n_even
    FROM (SELECT conv_id, turn, string_split(role || '~|~' || text || '~|~end', '~|~') AS parts FROM conversations)""",
)
def delimited_split(spark, sf):
    rows = load(spark, sf, "conversations").withColumn("line", F.concat_ws("~|~", "role", "text", F.lit("end")))
    parts = decode.split_payload(F.col("line"), F.lit(True))
    even = decode.split_payload(F.col("line"), F.col("turn") % 2 == 0)
    return rows.select(
        "conv_id", "turn", F.size(parts).cast("bigint").alias("n_parts"), F.get(parts, F.lit(0)).alias("first_part"),
        F.get(parts, F.lit(1)).alias("second_part"), F.size(even).cast("bigint").alias("n_even"),
    )


@query(
    "translator_columns",
    """
    SELECT event_id, event_id % 4 <> 0 AS ab_success, CASE WHEN event_id % 4 <> 0 THEN 'a~|~' || user_id END AS ab_data,
      CASE WHEN event_id % 4 = 0 THEN 'bad' END AS ab_error_message, CASE WHEN event_id % 4 <> 0 THEN 2 END AS ab_field_count,
      CASE WHEN event_id % 4 <> 0 THEN CAST(event_id % 3 AS INT) END AS ab_cancel_type,
      CASE WHEN event_id % 4 <> 0 THEN CAST(user_id AS VARCHAR) END AS second_field, event_id % 4 <> 0 AS is_valid, 'value' AS payload
    FROM events""",
    nullable=("ab_cancel_type", "ab_field_count"),
)
def translator_columns(spark, sf):
    rows = records(load(spark, sf, "events"))
    payload = decode.payload_column(rows)
    rows = rows.selectExpr(
        "offset AS event_id",
        """CASE WHEN offset % 4 = 0 THEN '{"success": false, "error_message": "bad"}'
           ELSE concat('{"success": true, "data": "a~|~', decode(key, 'UTF-8'), '", "field_count": 2, "cancel_type": ', offset % 3, '}') END AS answer""",
        "concat('{\"is_valid\": ', CASE WHEN offset % 4 = 0 THEN 'false' ELSE 'true' END, '}') AS verdict",
    )
    out = decode.result_columns(rows, F.col("answer"))
    return out.select(
        "event_id", "ab_success", "ab_data", "ab_error_message", "ab_field_count", "ab_cancel_type",
        F.get("ab_parsed_fields", F.lit(1)).alias("second_field"),
        decode.is_valid_answer(F.col("verdict")).alias("is_valid"), F.lit(payload).alias("payload"),
    )


_ROUTED_SQL = f"""
    WITH r AS (SELECT event_id, user_id, {_BODY_SQL} AS b FROM events),
    j AS (SELECT *, coalesce(json_valid(b), false) AS ok FROM r WHERE b IS NOT NULL AND trim(b) <> 'empty'),
    p AS (SELECT *, CASE WHEN ok THEN json_extract_string(b, '$.ticket.sportId') END AS sport, CASE WHEN ok THEN json_extract_string(b, '$.activityType') END AS activity,
      CASE WHEN ok THEN json_extract_string(b, '$.ticket.ticketStatus') END AS status FROM j)"""


@query(
    "decode_messages_json",
    _ROUTED_SQL
    + """
    SELECT event_id AS "kafkaOffset", NOT ok AS is_error, CAST(CASE WHEN ok THEN event_id END AS BIGINT) AS ticket__ticketId, sport AS sport_id,
      CAST(activity AS BIGINT) AS headeractivityType, CAST(status AS BIGINT) AS headerticketStatus,
      CASE WHEN event_id % 2 = 0 THEN user_id END AS headerVersionNumber, l.odds AS ticket__legs__odds
    FROM p LEFT JOIN (SELECT event_id AS id, value AS odds FROM events UNION ALL SELECT event_id, 1.5 FROM events) l ON p.ok AND l.id = p.event_id
    WHERE NOT ok OR (sport = '1' AND (status = '2' OR activity = '1'))""",
    nullable=("headerVersionNumber", "headeractivityType", "headerticketStatus", "ticket__ticketId"),
)
def decode_messages_json(spark, sf):
    rows = records(load(spark, sf, "events"))
    flat = decode_messages(rows, "BET_FO", schema=BODY_DDL, flatten_column="")
    return flat.select(
        "kafkaOffset", "is_error", "ticket__ticketId", "sport_id", "headeractivityType", "headerticketStatus",
        "headerVersionNumber", "ticket__legs__odds",
    )


@query(
    "decode_messages_cancel",
    _ROUTED_SQL
    + """
    SELECT event_id AS "kafkaOffset", sport AS sport_id, status AS headerticketStatus, activity AS headeractivityType FROM p
    WHERE ok AND sport = '1' AND (status = '5' OR activity = '3')""",
)
def decode_messages_cancel(spark, sf):
    route = JsonRoute(
        {"sport_id": "$.ticket.sportId", "headerticketStatus": "$.ticket.ticketStatus", "headeractivityType": "$.activityType"},
        "sport_id = '1' AND (headerticketStatus = '5' OR headeractivityType = '3')",
    )
    out = decode_json_messages(records(load(spark, sf, "events")), BODY_DDL, route, keep_invalid=False)
    return out.select("kafkaOffset", "sport_id", "headerticketStatus", "headeractivityType")


@query(
    "decode_messages_binary",
    """
    SELECT event_id AS "kafkaOffset", false AS is_error, CAST(length(CAST(user_id AS VARCHAR)) AS INT) AS n_bytes, CAST(user_id AS VARCHAR) AS acct_no,
      'act-' || event_id AS msg_order_no FROM events WHERE 5 + event_id % 4 = 8""",
)
def decode_messages_binary(spark, sf):
    """The decoder is the caller's; this one reads the account number out of the payload's hex text."""

    def decoder(hex_text):
        text = F.decode(F.unhex(hex_text), "UTF-8")
        return F.struct(
            F.struct(F.lit(False).alias("is_error")).alias("errors"),
            F.struct(F.length(text).alias("n_bytes")).alias("headerFields"),
            F.struct(text.alias("acct_no")).alias("valueFields"),
        )

    rows = records(load(spark, sf, "events")).withColumn("value", F.col("key"))
    out = decode_binary_messages(rows, decoder, "8")
    return out.select("kafkaOffset", "is_error", "n_bytes", "acct_no", "msg_order_no")


@query(
    "stream_decode",
    _ROUTED_SQL
    + """
    SELECT event_id AS "kafkaOffset", sport AS sport_id, event_id AS ticket__ticketId FROM p WHERE ok AND sport = '1' AND (status = '2' OR activity = '1')
    UNION ALL SELECT -1, '0', NULL""",
    nullable=("ticket__ticketId",),
)
def stream_decode(spark, sf):
    """The same decoding on a stream, with a seed row, and the invalid messages dropped by rule."""
    folder = work_dir(spark, "decode")
    seeds = [{"kafkaOffset": -1, "sport_id": "0", "is_error": False}]
    out = decode_messages(
        records(stream(spark, sf, "events")), "BET_FO", schema=BODY_DDL, seed_rows=seeds, seed_folder=f"{folder}/seeds"
    )
    good = expect_or_drop(out, {"valid_json": "is_error = false"})
    append_stream(
        good.selectExpr("kafkaOffset", "sport_id", "ticket.ticketId AS ticket__ticketId"), f"{folder}/out", f"{folder}/c"
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


# --- encryption ---------------------------------------------------------------------------------

TEST_KEY = "0123456789abcdef"
GCM, ECB = Cipher(TEST_KEY), Cipher(TEST_KEY, "ECB")
PII = {"c_name": "string", "C_ACCTBAL": "double", "c_nationkey": "int", "no_such_column": "string", "c_mktsegment": None}


@query(
    "pii_roundtrip",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, true AS was_hidden FROM customer",
)
def pii_roundtrip(spark, sf):
    customers = load(spark, sf, "customer").withColumn("__clear", F.col("c_name"))
    hidden = encrypt_columns(customers, PII, GCM).withColumn("was_hidden", F.col("c_name") != F.col("__clear"))
    return decrypt_columns(hidden.drop("__clear"), PII, GCM)


@query(
    "pii_nested_roundtrip",
    "SELECT c_custkey, c_name AS name, c_acctbal AS balance, c_mktsegment AS tag FROM customer",
)
def pii_nested_roundtrip(spark, sf):
    pii = {"person": "struct<name: string, balance: double>", "tags": "array<string>"}
    rows = load(spark, sf, "customer").selectExpr(
        "c_custkey", "named_struct('name', c_name, 'balance', c_acctbal) AS person", "array(c_mktsegment) AS tags"
    )
    clear = decrypt_columns(encrypt_columns(rows, pii, GCM), pii, GCM)
    return clear.selectExpr("c_custkey", "person.name", "person.balance", "tags[0] AS tag")


@query(
    "pii_encrypted_join",
    """
    SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 100000""",
)
def pii_encrypted_join(spark, sf):
    """Deterministic encryption leaves equality intact, so both sides join without the clear text."""
    customers = encrypt_columns(load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), {"c_custkey": "bigint"}, ECB)
    orders = load(spark, sf, "orders").where("o_totalprice > 100000").select("o_orderkey", "o_custkey")
    hidden = encrypt_columns(orders, {"o_custkey": "bigint"}, ECB)
    return hidden.join(customers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")


@query("pii_sql_functions", "SELECT c_custkey, c_name, upper(c_name) AS loud FROM customer WHERE c_nationkey > 5")
def pii_sql_functions(spark, sf):
    register_cipher_functions(spark, f"'{TEST_KEY}'", "seal_text", "open_text")
    named = Cipher(encrypt_function="seal_text", decrypt_function="open_text")
    rows = encrypt_columns(load(spark, sf, "customer"), {"c_name": "string"}, named)
    clear = decrypt_columns(rows.where("c_nationkey > 5"), {"c_name": "string"}, named)
    return clear.selectExpr("c_custkey", "c_name", "upper(c_name) AS loud")


@query(
    "pii_silver_shape",
    "SELECT c_custkey, 'Dear ' || c_name AS c_name FROM customer WHERE c_name LIKE '%1'",
)
def pii_silver_shape(spark, sf):
    """Decrypt, shape and filter on the clear text, encrypt again; read back at the end for the check."""
    pii = {"c_name": "string"}
    bronze = encrypt_columns(load(spark, sf, "customer"), pii, GCM)
    silver = with_decrypted(
        bronze, pii, GCM, lambda df: project_then_filter(df, ["c_custkey", "'Dear ' || c_name AS c_name"], ["c_name LIKE '%1'"])
    )
    return decrypt_columns(silver, pii, GCM)


@query("sql_source_decrypted", "SELECT s_suppkey, s_name FROM supplier WHERE s_name > 'Supplier#000000004'")
def sql_source_decrypted(spark, sf):
    encrypt_columns(load(spark, sf, "supplier"), {"s_name": "string"}, GCM).createOrReplaceTempView("sealed_supplier")
    df = sql_source(spark, "sealed_supplier", pii={"s_name": "string"}, cipher=GCM, condition="s_name > 'Supplier#000000004'")
    return df.select("s_suppkey", "s_name")
