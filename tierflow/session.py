"""Session defaults and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job here relies on. Sizes (partitions, memory) belong to the cluster, not to this list.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime defaults on a session somebody else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


# A join on few values must not decide where rows are grouped: its small side is broadcast once its size is known, however few
# of its partitions hold rows, and groups are dealt out by all their keys.
SPREAD_GROUPS = {
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.adaptive.nonEmptyPartitionRatioForBroadcastJoin": "0",
}


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Hold settings of the session for what is planned and run inside."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: what the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "tierflow-scratch")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/tierflow/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
