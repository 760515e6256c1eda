"""Keyed table operators: latest row, upsert merge, duplicate keys, count reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def natural_order(col: Column) -> Column:
    """Sort value that compares the numbers inside a text as numbers (``v2`` before ``v10``)."""
    numbers = F.transform(F.regexp_extract_all(col, F.lit(r"(\d+)")), lambda x: x.cast("decimal(38,0)"))
    return F.struct(numbers.alias("numbers"), col.alias("text"))


def latest_per_key(df: DataFrame, keys: list[str], order_desc: list[Column]) -> DataFrame:
    """One row per key, the first by ``order_desc``; Spark keeps one row per key before the shuffle."""
    ranked = Window.partitionBy(*keys).orderBy(*order_desc)
    return df.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def keyed_merge(
    target: DataFrame, upserts: DataFrame, keys: list[str], protected: tuple[str, ...] = ()
) -> DataFrame:
    """Target after an upsert: matched rows take every column but ``protected``, others are added.

    A key that several upserts share is an error, as in SQL MERGE. NULL keys match nothing.
    Each input is read once: a full join on the keys shuffles the target once, and says of every row whether it stays, is
    updated or added.
    """
    columns = target.columns
    anykey = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])
    # Upserts without a key are told apart by their content; equal ones are counted, and added as often.
    content = F.when(anykey, F.to_json(whole))
    counted = upserts.groupBy(*keys, content.alias("__content")).agg(F.count(F.lit(1)).alias("__n"), F.first(whole).alias("__src"))
    twice = F.raise_error(F.concat_ws(" ", F.lit("several upserts for key"), F.to_json(F.struct(*keys))))
    # The check is part of every value, so it cannot be pruned away.
    source = counted.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.when(anykey | (F.col("__n") == 1), F.col("__src")).otherwise(twice).alias("__src"),
        F.when(anykey, F.col("__n")).otherwise(1).cast("int").alias("__copies"),
    )
    held = target.select(whole.alias("__old"))
    on = reduce(lambda a, b: a & b, (held["__old"][k] == source[f"__k{i}"] for i, k in enumerate(keys)))
    both = held.join(source, on, "full_outer")
    old, new = F.col("__old"), F.col("__src")
    values = [F.when(old.isNull(), new[c]).when(new.isNull() | F.lit(c in protected), old[c]).otherwise(new[c]).alias(c) for c in columns]
    return both.select(F.inline(F.array_repeat(F.struct(*values), F.coalesce("__copies", F.lit(1)))))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(name).alias("table_name"), "actual")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def reconcile_counts(tables: dict[str, DataFrame], expected: DataFrame, mode: str = "exact") -> DataFrame:
    """Compare row counts with ``expected(table_name, expected)``; ``mode`` is exact or minimum."""
    if mode not in ("exact", "minimum"):
        raise ValueError(f"mode must be exact or minimum, got {mode!r}")
    actual = row_counts(tables)
    joined = expected.join(actual, "table_name", "left")
    test = F.col("actual") == F.col("expected") if mode == "exact" else F.col("actual") >= F.col("expected")
    return joined.select("table_name", "expected", "actual", F.coalesce(test, F.lit(False)).alias("ok"))
