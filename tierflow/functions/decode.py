"""Column expressions that decode message records; all of them run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.project import pinned


def decode_headers(headers: Column) -> Column:
    """array<struct<key, binary value>> with the values as text."""
    return F.transform(
        headers, lambda h: F.struct(h["key"].alias("key"), F.decode(h["value"], "UTF-8").alias("value"))
    )


def header_map(headers: Column) -> Column:
    """Decoded headers as a map; of a repeated key the last value stays, whatever the session says."""
    keys = F.transform(headers, lambda h: h["key"])
    last = F.filter(
        headers,
        lambda h, i: ~F.exists(F.slice(keys, i + 2, F.greatest(F.size(keys), F.lit(1))), lambda k: k == h["key"]),
    )
    return F.map_from_entries(last)


def header_value(headers: Column, key: str) -> Column:
    """First value of a key; NULL when it is absent."""
    return F.get(F.filter(headers, lambda h: h["key"] == key), F.lit(0))["value"]


def payload_text(value: Column) -> Column:
    return F.decode(value, "UTF-8")


def payload_hex(value: Column) -> Column:
    return F.hex(value)


def json_validity(text: Column) -> Column:
    """struct<is_error, error_details> of a JSON text; NULL is an error."""
    return validity_of(text, F.try_parse_json(text))


def validity_of(text: Column, parsed: Column) -> Column:
    """The same, where the text has been parsed already."""
    bad = parsed.isNull()
    return F.struct(
        bad.alias("is_error"),
        F.when(text.isNull(), "JSON string is null")
        .when(bad, F.concat(F.lit("invalid JSON: "), text))
        .alias("error_details"),
    )


def register_json_validity(spark: SparkSession, name: str = "json_validity") -> None:
    """The same check under a SQL name, as a SQL function instead of a Python one."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING)
        RETURNS STRUCT<is_error: BOOLEAN, error_details: STRING>
        RETURN named_struct(
          'is_error', try_parse_json(txt) IS NULL,
          'error_details', CASE WHEN txt IS NULL THEN 'JSON string is null'
            WHEN try_parse_json(txt) IS NULL THEN concat('invalid JSON: ', txt) END)"""
    )


def parse_json_as(text: Column, schema: T.StructType | str) -> Column:
    return F.from_json(text, schema)


def json_path(text: Column, path: str, dtype: str = "string") -> Column:
    """Typed value at a path; NULL when the text is no JSON, the path is absent or the cast fails."""
    return F.try_variant_get(F.try_parse_json(text), path, dtype)


def json_paths(df: DataFrame, text: Column, paths: dict[str, tuple[str, str] | str]) -> DataFrame:
    """One column per path, all read from a value that is parsed once."""
    named = {n: (p, "string") if isinstance(p, str) else p for n, p in paths.items()}
    staged = pinned(df, __v=F.try_parse_json(text))
    return staged.withColumns({n: F.try_variant_get(F.col("__v"), p, t) for n, (p, t) in named.items()}).drop("__v")


def nested_item(col: Column, *steps: str | int) -> Column:
    """Field names and array positions in turn; a missing position gives NULL instead of an error."""
    for step in steps:
        col = F.get(col, F.lit(step)) if isinstance(step, int) else col.getField(step)
    return col


def paths_present(text: Column, paths: list[str]) -> Column:
    """TRUE when every path holds a value; the text is parsed once."""

    def complete(value: Column) -> Column:
        found = [F.try_variant_get(value, p, "string").isNotNull() for p in paths]
        return reduce(lambda a, b: a & b, found, F.lit(True))

    return F.exists(F.array(F.try_parse_json(text)), complete)


# Column names under which a message payload is looked for, in this order of columns.
PAYLOAD_NAMES = ("binary_data", "raw_data", "message_data", "value", "content")


def payload_column(df: DataFrame) -> str | None:
    """The first column with a usual payload name, else the first binary column."""
    for name in df.columns:
        if name.lower() in PAYLOAD_NAMES:
            return name
    binary = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)]
    return binary[0] if binary else None


# Layout of a translator's JSON answer and of its check answer.
RESULT_DDL = "success boolean, data string, error_message string, field_count int, cancel_type int"
CHECK_DDL = "is_valid boolean, error string"
FIELD_SEPARATOR = "~|~"


def split_payload(text: Column, ok: Column, delimiter: str = FIELD_SEPARATOR) -> Column:
    """Parts of a delimited text; an empty array when ``ok`` is not TRUE."""
    pattern = "".join(f"\\{c}" if not c.isalnum() else c for c in delimiter)
    return F.when(ok, F.split(text, pattern)).otherwise(F.array().cast("array<string>"))


def result_columns(df: DataFrame, answer: Column, prefix: str = "ab") -> DataFrame:
    """Status columns and split fields of a translator's JSON answer."""
    staged = df.withColumn("__r", F.from_json(answer, RESULT_DDL))
    r = F.col("__r")
    return staged.withColumns(
        {
            f"{prefix}_success": r["success"],
            f"{prefix}_data": r["data"],
            f"{prefix}_error_message": r["error_message"],
            f"{prefix}_field_count": r["field_count"],
            f"{prefix}_cancel_type": r["cancel_type"],
            f"{prefix}_parsed_fields": split_payload(r["data"], r["success"]),
        }
    ).drop("__r")


def is_valid_answer(answer: Column) -> Column:
    return F.from_json(answer, CHECK_DDL)["is_valid"]
