"""Per-key ordered lookups that stay balanced when one key owns most of the rows.

A window over ``partitionBy(keys)`` puts every row of a key into one task. For ordinary keys that
is the cheapest plan. Keys with more rows than a task should hold are cut into *runs*: the rows
are range-partitioned by (keys, order), written once, and the partition number becomes part of the
window key. Each lookup is then answered inside the run and, for the rows at a run's edge, from a
summary with one row per (key, run).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.session import materialize

HOT_KEY_ROWS = 2_000_000

RUN = "__run"


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[k]) for k in keys))


@dataclass(frozen=True)
class KeyOrder:
    """Rows ordered by ``order`` inside ``keys``; ``split`` says that the rows carry a run number."""

    keys: tuple[str, ...]
    order: str
    split: bool = False

    @property
    def _group(self) -> list[str]:
        return [*self.keys, RUN] if self.split else list(self.keys)

    def _window(self):
        return Window.partitionBy(*self._group).orderBy(self.order)

    def _attach(self, df: DataFrame, summary: DataFrame) -> DataFrame:
        renamed = summary.select(
            *[F.col(c).alias(f"__s_{c}") for c in self._group],
            *[c for c in summary.columns if c not in self._group],
        )
        on = reduce(
            lambda a, b: a & b, (df[c].eqNullSafe(renamed[f"__s_{c}"]) for c in self._group)
        )
        return df.join(renamed, on, "left").drop(*[f"__s_{c}" for c in self._group])

    def _runs(self):
        return Window.partitionBy(*self.keys).orderBy(RUN)

    def running_max(self, df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
        """Largest value of each expression over the key's rows up to and including this one."""
        upto = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if not self.split:
            return df.withColumns({n: F.max(e).over(upto) for n, e in exprs.items()})
        staged = df.withColumns({f"__e_{n}": e for n, e in exprs.items()})
        before = self._runs().rowsBetween(Window.unboundedPreceding, -1)
        edges = staged.groupBy(*self._group).agg(
            *[F.max(f"__e_{n}").alias(f"__m_{n}") for n in exprs]
        )
        edges = edges.select(
            *self._group, *[F.max(f"__m_{n}").over(before).alias(f"__b_{n}") for n in exprs]
        )
        local = staged.withColumns({n: F.max(f"__e_{n}").over(upto) for n in exprs})
        joined = self._attach(local, edges)
        return joined.withColumns(
            {n: F.greatest(F.col(n), F.col(f"__b_{n}")) for n in exprs}
        ).drop(*[f"__e_{n}" for n in exprs], *[f"__b_{n}" for n in exprs])

    def previous(self, df: DataFrame, name: str, value: Column) -> DataFrame:
        """``value`` of the row just before this one in its key, as a struct (NULL on the first row)."""
        boxed = F.struct(value.alias("value"))
        if not self.split:
            return df.withColumn(name, F.lag(boxed).over(self._window()))
        staged = df.withColumn("__e", boxed)
        edges = staged.groupBy(*self._group).agg(F.max_by("__e", self.order).alias("__m"))
        edges = edges.select(*self._group, F.lag("__m").over(self._runs()).alias("__b"))
        local = staged.withColumn(name, F.lag("__e").over(self._window()))
        return (
            self._attach(local, edges)
            .withColumn(name, F.coalesce(name, "__b"))
            .drop("__e", "__b")
        )

    def next_order(self, df: DataFrame, name: str) -> DataFrame:
        """Order value of the row that follows in the same key."""
        if not self.split:
            return df.withColumn(name, F.lead(self.order).over(self._window()))
        edges = df.groupBy(*self._group).agg(F.min(self.order).alias("__m"))
        edges = edges.select(*self._group, F.lead("__m").over(self._runs()).alias("__b"))
        local = df.withColumn(name, F.lead(self.order).over(self._window()))
        return self._attach(local, edges).withColumn(name, F.coalesce(name, "__b")).drop("__b")


def hot_keys(
    df: DataFrame,
    keys: list[str],
    *,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame | None:
    """Keys with more rows than one task should hold, or None when there are none.

    The count is combined on the map side and reads only the key columns.
    """
    if df.isStreaming:
        return None
    counted = df.groupBy(*keys).count().where(F.col("count") > hot_key_rows)
    found = materialize(counted.select(*keys, F.col("count").alias("__rows")))
    return None if found.isEmpty() else found


def split_runs(df: DataFrame, keys: list[str], order: str, rows_per_run: int, total: int) -> DataFrame:
    """Cut (keys, order) into runs of about ``rows_per_run`` rows and number them.

    Rows are written before the number is used, so that a lost executor cannot renumber them.
    """
    parts = max(2, -(-total // rows_per_run))
    ranged = df.repartitionByRange(parts, *keys, order).withColumn(RUN, F.spark_partition_id())
    return materialize(ranged)


def by_key_order(
    df: DataFrame,
    keys: list[str],
    order: str,
    collapse,
    body,
    *,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Run ``body(rows, KeyOrder)`` over all rows, with hot keys on the split plan.

    ``collapse`` reduces ``df`` to one row per (keys, order). Ordinary keys are shuffled once, on the
    keys, for both steps; hot keys are collapsed on (keys, order) before they are cut into runs.
    """
    hot = hot_keys(df, keys, hot_key_rows=hot_key_rows)
    plain = KeyOrder(tuple(keys), order)
    if hot is None:
        return body(collapse(df.repartition(*keys)), plain)
    total = hot.agg(F.sum("__rows")).first()[0]
    names = hot.select(*keys)
    cold = df.join(names, null_safe(df, names, keys), "left_anti")
    heavy = df.join(names, null_safe(df, names, keys), "left_semi")
    runs = split_runs(collapse(heavy), keys, order, hot_key_rows, total)
    split = KeyOrder(tuple(keys), order, split=True)
    return body(collapse(cold.repartition(*keys)), plain).unionByName(body(runs, split))
