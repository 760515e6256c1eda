"""Schemas and small metadata files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.sources.storage import qualified


def read_text(spark: SparkSession, path: str) -> str:
    """A small metadata file as one text."""
    return spark.read.text(path, wholetext=True).first()[0]


def read_texts(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Small metadata files by the path they were asked for, read by one job however many they are."""
    if not paths:
        return {}

    def plain(uri: str) -> str:
        return re.sub(r"^([\w+.-]+):/+", r"\1:/", uri)

    asked = {plain(qualified(spark, p)): p for p in paths}
    rows = spark.read.text(sorted(set(paths)), wholetext=True).select("_metadata.file_path", "value").collect()
    found = {asked[plain(r["file_path"])]: r["value"] for r in rows if plain(r["file_path"]) in asked}
    # An empty file has no row; two ways to write one path are one file.
    return {p: found.get(asked[plain(qualified(spark, p))], "") for p in paths}


def ddl_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a DDL text file; both ``name type`` and ``name: type`` are DDL."""
    return T.StructType.fromDDL(read_text(spark, path))


def multiline_json(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiline", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def json_objects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Objects of JSON files (one object or an array of them each) as variants in column ``v``."""
    raw = spark.read.option("multiline", "true").option("singleVariantColumn", "v").json(path)
    listed = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.array("v"))
    return raw.select(F.explode(listed).alias("v"))
