"""Decode pipelines over frames in the Kafka record layout."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.decode import (
    decode_headers,
    header_map,
    header_value,
    payload_hex,
    payload_text,
    validity_of,
)
from tierflow.operators.flatten import flatten
from tierflow.operators.project import pinned
from tierflow.session import scratch_dir

# Output names of a record's position and the constants of the four known routes.
RECORD_COLUMNS = {
    "kafkaOffset": "offset",
    "kafkaTopic": "topic",
    "kafkaPartition": "partition",
    "kafkaMessageTimestamp": "timestamp",
}
EMPTY_PAYLOAD = "empty"


@dataclass(frozen=True)
class JsonRoute:
    """Which JSON messages belong to a flow: paths read from the payload and a predicate over them."""

    paths: dict[str, str] = field(default_factory=dict)
    predicate: str = ""
    headers: dict[str, str] = field(default_factory=dict)
    long_columns: tuple[str, ...] = ()


_BET_PATHS = {
    "sport_id": "$.ticket.sportId",
    "headeractivityType": "$.activityType",
    "headerticketStatus": "$.ticket.ticketStatus",
}
_BET_HEADERS = {"headerVersionNumber": "VersionNumber"}
_BET_LONGS = ("headeractivityType", "headerticketStatus", "headerVersionNumber")
JSON_ROUTES = {
    "BET_FO": JsonRoute(
        _BET_PATHS,
        "sport_id = '1' AND (headerticketStatus = '2' OR headeractivityType = '1')",
        _BET_HEADERS,
        _BET_LONGS,
    ),
    "BET_FO_CANCEL": JsonRoute(
        _BET_PATHS,
        "sport_id = '1' AND (headerticketStatus = '5' OR headeractivityType = '3')",
        _BET_HEADERS,
        _BET_LONGS,
    ),
}
# Activity code that the headers of a binary message must carry.
BINARY_ROUTES = {"RACE_PMU": "6", "RACE_PMU_CANCEL": "8"}


def record_metadata(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Position columns of a record under their output names, then ``extra`` columns."""
    return df.select(*[F.col(src).alias(out) for out, src in RECORD_COLUMNS.items()], *(extra or []))


def with_text_headers(df: DataFrame) -> DataFrame:
    return df.withColumn("headers", decode_headers(F.col("headers")))


def with_payload(text: Column) -> Column:
    """Condition: a payload is there and is not the literal that marks an empty one."""
    return text.isNotNull() & (F.trim(text) != EMPTY_PAYLOAD)


def decode_json_messages(
    df: DataFrame, schema: T.StructType | str, route: JsonRoute, *, keep_invalid: bool = True
) -> DataFrame:
    """Records of one route: position, headers, validity, parsed fields and the route's own columns.

    Invalid JSON has no route. With ``keep_invalid`` such records pass with ``is_error`` set, so that
    a quarantine rule can take them; the parsed columns are NULL then.
    """
    staged = with_text_headers(df).withColumn("decoded_value", payload_text(F.col("value")))
    staged = staged.where(with_payload(F.col("decoded_value")))
    staged = pinned(staged, __v=F.try_parse_json("decoded_value"))
    wanted = {n: F.try_variant_get("__v", p, "string") for n, p in route.paths.items()}
    wanted |= {n: header_value(F.col("headers"), k) for n, k in route.headers.items()}
    checked = validity_of(F.col("decoded_value"), F.col("__v"))
    staged = pinned(staged, __valid=checked, **wanted)
    if route.predicate:
        fits = F.coalesce(F.expr(route.predicate), F.lit(False))
        staged = staged.where(fits | F.col("__valid.is_error") if keep_invalid else fits)
    own = [
        F.col(n).try_cast("bigint").alias(n) if n in route.long_columns else F.col(n)
        for n in [*route.paths, *route.headers]
    ]
    staged = staged.withColumns(
        {"__json": F.from_json("decoded_value", schema), "headersRefined": header_map(F.col("headers"))}
    )
    return record_metadata(
        staged,
        ["headersRefined", F.col("__valid.is_error"), F.col("__valid.error_details"), F.col("__json.*"), *own],
    )


def decode_binary_messages(
    df: DataFrame,
    decoder: Callable[[Column], Column],
    activity_code: str,
    *,
    code_header: str = "ActivityCode",
    id_header: str = "ActivityId",
    id_column: str = "msg_order_no",
    parts: tuple[str, ...] = ("errors", "headerFields", "valueFields"),
) -> DataFrame:
    """Records with one activity code, their payload decoded by the caller's function.

    ``decoder`` gets the payload as hex text and returns a struct; its ``parts`` are spread out.
    """
    staged = with_text_headers(df)
    staged = staged.where(header_value(F.col("headers"), code_header) == activity_code)
    staged = staged.withColumn("__root", decoder(payload_hex(F.col("value"))))
    return record_metadata(
        staged,
        [*[F.col(f"__root.{p}.*") for p in parts], header_value(F.col("headers"), id_header).alias(id_column)],
    )


def add_seed_rows(df: DataFrame, rows: list[dict], folder: str | None = None) -> DataFrame:
    """Union constant rows by name; columns they lack are NULL, columns ``df`` lacks are an error.

    A stream reads them from a small table in ``folder``, by default below the shared scratch folder. The
    stream's checkpoint remembers that file, so the rows come once, however often the query restarts.
    """
    unknown = sorted({k for r in rows for k in r} - set(df.columns))
    if unknown:
        raise ValueError(f"seed rows name unknown columns {unknown}")
    one = df.sparkSession.range(1)
    literals = [
        one.select(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]) for row in rows
    ]
    seeds = reduce(DataFrame.unionByName, literals)
    if df.isStreaming:
        content = hashlib.sha1(json.dumps([rows, df.schema.json()], default=str, sort_keys=True).encode()).hexdigest()
        path = f"{folder or scratch_dir(df.sparkSession) + '/tierflow-seeds'}/{content}"
        seeds.coalesce(1).write.mode("ignore").parquet(path)
        seeds = df.sparkSession.readStream.schema(df.schema).parquet(path)
    return df.unionByName(seeds)


def decode_messages(
    df: DataFrame,
    kind: str,
    *,
    schema: T.StructType | str | None = None,
    decoder: Callable[[Column], Column] | None = None,
    flatten_column: str | None = None,
    seed_rows: list[dict] | None = None,
    seed_folder: str | None = None,
) -> DataFrame:
    """Decode, route, flatten once and add seed rows for one of the known message kinds."""
    if kind in JSON_ROUTES:
        if schema is None:
            raise ValueError(f"{kind} needs the payload schema")
        out = decode_json_messages(df, schema, JSON_ROUTES[kind])
    elif kind in BINARY_ROUTES:
        if decoder is None:
            raise ValueError(f"{kind} needs a decoder function")
        out = decode_binary_messages(df, decoder, BINARY_ROUTES[kind])
    else:
        raise ValueError(f"unknown message kind {kind!r}")
    if flatten_column is not None:
        out = flatten(out, flatten_column)
    return add_seed_rows(out, seed_rows, seed_folder) if seed_rows else out
