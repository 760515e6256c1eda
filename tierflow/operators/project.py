"""Projection and filter steps of a flow."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Hook = Callable[[DataFrame, object], DataFrame]


def project(df: DataFrame, select_exp: list[str] | None) -> DataFrame:
    return df.selectExpr(*select_exp) if select_exp else df


def where_all(df: DataFrame, predicates: list[str] | str | None) -> DataFrame:
    """Rows meeting every predicate; blank entries are no filter."""
    listed = [predicates] if isinstance(predicates, str) else predicates or []
    for predicate in listed:
        if predicate and predicate.strip():
            df = df.where(predicate)
    return df


def project_then_filter(df: DataFrame, select_exp: list[str] | None, predicates: list[str] | None) -> DataFrame:
    """The filter sees projected columns only; the optimizer still moves it down to the scan."""
    return where_all(project(df, select_exp), predicates)


def output_schema(df: DataFrame, select_exp: list[str] | None, predicates: list[str] | None) -> T.StructType:
    """Schema after projection and filter; nothing runs."""
    return project_then_filter(df, select_exp, predicates).schema


def apply_hook(df: DataFrame, hook: Hook | None, spec: object) -> DataFrame:
    return df.transform(hook, spec) if hook else df


def trim_names(df: DataFrame) -> DataFrame:
    names = [c.strip() for c in df.columns]
    return df if names == df.columns else df.toDF(*names)


def expand(df: DataFrame, *paths: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns followed by the fields of each struct path."""
    return df.select(*(keep or []), *[f"{p}.*" for p in paths])


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A filter on an ordinary column moves below the projection and takes a copy of the expression with
    it, once per mention. Behind a generator it stays where it is, which pays off for parsed messages.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows evenly over the cluster's cores, for work that is heavy for the bytes read.

    A small file is one task, however long its rows take. The number is given, so adaptive execution, which goes by bytes,
    does not join the parts again.
    """
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order; missing ones as typed NULL (older tables, union branches)."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            F.col(f"`{present[f.name.lower()]}`").cast(f.dataType).alias(f.name)
            if f.name.lower() in present
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def calendar_gate(df: DataFrame, day: Column, places: list[str], *, current: str = "is_current = 1",
                  date_column: str = "meeting_date", place_column: str = "meeting_location") -> DataFrame:
    """One row ``is_open``: does the calendar list any of ``places`` as current on ``day``?"""
    per_place = (
        df.where(current)
        .where((F.col(date_column).cast("date") == day) & F.col(place_column).isin(*places))
        .groupBy(place_column)
        .count()
    )
    return per_place.agg(F.coalesce(F.max(F.col("count") > 0), F.lit(False)).alias("is_open"))
