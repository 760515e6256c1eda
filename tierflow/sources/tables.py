"""Table, path and SQL sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierflow.functions.crypto import Cipher, decrypt_columns
from tierflow.operators.project import where_all
from tierflow.sources.storage import children


def read_table(spark: SparkSession, name: str, options: dict[str, str] | None = None, streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.options(**(options or {})).table(name)


def read_path(
    spark: SparkSession, path: str, streaming: bool = True, format: str = "parquet", options: dict | None = None
) -> DataFrame:
    """A directory another flow writes. A stream takes its schema from the files there are now."""
    if not streaming:
        return spark.read.format(format).options(**(options or {})).load(path)
    schema = spark.read.format(format).load(path).schema
    return spark.readStream.format(format).options(**(options or {})).schema(schema).load(path)


def sql_source(
    spark: SparkSession,
    table: str,
    *,
    streaming: bool = False,
    pii: dict[str, str] | None = None,
    cipher: Cipher | None = None,
    condition: str | None = None,
) -> DataFrame:
    """All of a table or view, as a stream on request, decrypted and then filtered."""
    df = spark.sql(f"SELECT * FROM STREAM({table})" if streaming else f"SELECT * FROM {table}")
    if pii and cipher:
        df = decrypt_columns(df, pii, cipher)
    return where_all(df, condition)


def for_environment(entry: dict, name: str, env: str, default=None):
    """Value of ``name_{env}``, else of ``name``."""
    value = entry.get(f"{name}_{env}")
    return value if value is not None else entry.get(name, default)


NextSnapshot = Callable[[int | None], "tuple[DataFrame, int] | None"]


def snapshot_series(next_snapshot: NextSnapshot, latest: int | None = None):
    """Snapshots as the callback hands them out: it gets the last version and ends with None."""
    while (found := next_snapshot(latest)) is not None:
        df, version = found
        if latest is not None and version <= latest:
            raise ValueError(f"snapshot version {version} does not follow {latest}")
        yield df, version
        latest = version


def numbered_files(spark: SparkSession, pattern: str, format: str, options: dict | None = None, schema=None) -> NextSnapshot:
    """Callback over files named by version, ``pattern`` holding ``{version}`` in its last part.

    The lowest version above the last one comes next, so version 0 counts and a missing number hides nothing.
    """
    folder, _, name = pattern.rpartition("/")
    before, _, after = name.partition("{version}")

    def number(child: str) -> int | None:
        inner = child[len(before) : len(child) - len(after)] if child.startswith(before) and child.endswith(after) else ""
        return int(inner) if inner.isdecimal() else None

    def following(latest: int | None):
        found = [n for n in map(number, children(spark, folder)) if n is not None]
        version = min((n for n in found if latest is None or n > latest), default=None)
        if version is None:
            return None
        reader = spark.read.format(format).options(**(options or {}))
        return (reader.schema(schema) if schema else reader).load(pattern.format(version=version)), version

    return following
