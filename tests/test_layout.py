"""Clustered layouts: what a filter on a cluster column can skip."""

import pyarrow.parquet as pq
from conftest import rows
from pyspark.sql import functions as F

from tierflow.operators.curve import with_curve_place
from tierflow.streaming.sinks import Layout, append_batch


def test_a_filter_on_either_column_skips_most_files(spark, tmp_path):
    df = spark.range(40_000).selectExpr("pmod(xxhash64(id), 100000) AS x", "cast(pmod(xxhash64(id, 1), 100000) AS string) AS y", "id").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        append_batch(df, str(tmp_path / "t"), Layout(cluster_by=["x", "y"]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    ranges = []
    for path in (tmp_path / "t").glob("*.parquet"):
        group = pq.ParquetFile(path).metadata.row_group(0)
        ranges.append([(group.column(k).statistics.min, group.column(k).statistics.max) for k in (0, 1)])
    assert len(ranges) > 40
    for column, value in ((0, 31_415), (0, 90_000), (1, "31415"), (1, "9")):
        assert sum(r[column][0] <= value <= r[column][1] for r in ranges) <= len(ranges) * 0.35
    assert spark.read.parquet(str(tmp_path / "t")).exceptAll(df).isEmpty() and spark.read.parquet(str(tmp_path / "t")).count() == 40_000


def test_places_of_every_kind_of_value(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', DATE '2020-01-01', TIMESTAMP '2020-01-01', true, 1.5D), (2, 'b', DATE '2021-01-01', TIMESTAMP '2021-01-01', false, 2.5D), (NULL, NULL, NULL, NULL, NULL, NULL) t(i, s, d, t, b, f)")
    for columns in (["i", "s"], ["d", "t"], ["b", "f", "i"]):
        assert with_curve_place(df, columns, "p").where("p IS NULL").isEmpty()
    assert rows(with_curve_place(df, ["i", "s"], "p").orderBy(F.col("p")).select("i")) == [(None,), (1,), (2,)]
    empty = df.where("false")
    assert with_curve_place(empty, ["i", "s"], "p").count() == 0
