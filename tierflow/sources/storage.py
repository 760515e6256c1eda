"""Directory helpers on whatever file system a path names, and versioned parquet tables.

A table version is a directory ``v=N``. Spark's committer puts ``_SUCCESS`` into it last, which is what
makes the version visible; a job that fails leaves the older version in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a URI with its file system, encoded as Spark encodes it."""
    hadoop, fs = _resolve(spark, path)
    return fs.makeQualified(hadoop).toUri().toString()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _resolve(spark, path)
    return fs.exists(hadoop)


def children(spark: SparkSession, path: str) -> list[str]:
    hadoop, fs = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def touch(spark: SparkSession, path: str) -> None:
    hadoop, fs = _resolve(spark, path)
    fs.create(hadoop, True).close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file of pipeline state; it appears whole or not at all."""
    target, fs = _resolve(spark, path)
    draft = target.suffix(".part")
    out = fs.create(draft, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(draft, target)


def get_text(spark: SparkSession, path: str) -> str:
    target, fs = _resolve(spark, path)
    source = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def make_folder(spark: SparkSession, path: str) -> None:
    target, fs = _resolve(spark, path)
    fs.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder this engine has written, with all it holds."""
    target, fs = _resolve(spark, path)
    fs.delete(target, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Let a finished folder appear under its name, all at once where the file system can."""
    source, fs = _resolve(spark, path)
    target, _ = _resolve(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"cannot move {path} to {to}")


def newest(spark: SparkSession, path: str, label: str) -> int | None:
    """Highest committed N among the directories ``label=N`` of ``path``."""
    start = f"{label}="
    found = sorted((int(n[len(start):]) for n in children(spark, path) if n.startswith(start)), reverse=True)
    return next((n for n in found if exists(spark, f"{path}/{label}={n}/_SUCCESS")), None)


def current_version(spark: SparkSession, path: str) -> int | None:
    return newest(spark, path, "v")


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None, version: int | None = None) -> int:
    """Write ``df`` as the next (or a given, higher) version. ``df`` may read the current one."""
    current = current_version(df.sparkSession, path)
    if version is None:
        version = 1 if current is None else current + 1
    if current is not None and version <= current:
        raise ValueError(f"version {version} of {path} exists already")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/v={version}")
    return version


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    version = current_version(spark, path) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no published version under {path}")
    return spark.read.parquet(f"{path}/v={version}")
