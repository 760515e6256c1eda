"""Data-quality rules: warn, drop, fail and quarantine.

A rule is a SQL predicate. It passes only when TRUE; NULL counts as a violation. Every rule sees the
rows as they came in, whatever the other rules do with them.
"""

from __future__ import annotations

import json
import threading
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass(frozen=True)
class RuleSet:
    warn: dict[str, str] = field(default_factory=dict)
    drop: dict[str, str] = field(default_factory=dict)
    fail: dict[str, str] = field(default_factory=dict)
    quarantine: dict[str, str] = field(default_factory=dict)

    @property
    def counted(self) -> dict[str, str]:
        """Rules whose violations are reported."""
        return {**self.warn, **self.drop, **self.fail}

    def __bool__(self) -> bool:
        return bool(self.warn or self.drop or self.fail or self.quarantine)


def resolve_rules(source: str | dict | None) -> RuleSet:
    """Rule set of a rule file; where both spellings of a kind exist the singular one counts."""
    if not source:
        return RuleSet()
    raw = json.loads(source) if isinstance(source, str) else source

    def kind(singular: str, plural: str) -> dict[str, str]:
        return dict(raw.get(singular) or raw.get(plural) or {})

    return RuleSet(
        warn=kind("expect", "expect_all"),
        drop=kind("expect_or_drop", "expect_all_or_drop"),
        fail=kind("expect_or_fail", "expect_all_or_fail"),
        quarantine=dict(raw.get("expect_or_quarantine") or {}),
    )


def passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule).cast("boolean"), F.lit(False))


def passes_all(rules: dict[str, str]) -> Column:
    return reduce(lambda a, b: a & b, (passes(r) for r in rules.values()), F.lit(True))


def _failure(rules: dict[str, str]) -> Column:
    broken = F.concat_ws(", ", *[F.when(~passes(r), F.lit(n)) for n, r in rules.items()])
    return F.raise_error(F.concat(F.lit("rules violated: "), broken))


def _kept(drop: dict[str, str], fail: dict[str, str]) -> Column:
    """Filter condition: raise on a broken fail rule, else test the drop rules.

    With a fail rule the condition also holds a random number. That makes the filter a barrier: no
    later predicate can move below it and hide the violating row.
    """
    if not fail:
        return passes_all(drop)
    checked = F.when(~passes_all(fail), _failure(fail).cast("boolean")).otherwise(passes_all(drop))
    return checked & (F.rand(0) + 1 > 0)


def _counts(rules: dict[str, str]) -> list[Column]:
    return [F.count_if(~passes(r)).alias(n) for n, r in rules.items()]


def expect(df: DataFrame, rules: dict[str, str], name: str = "expect") -> tuple[DataFrame, Observation | None]:
    """Keep every row and count rows and violations per rule while the rows pass by.

    A batch returns the observation to ask. A stream reports under ``name`` in its progress instead, see
    :class:`StreamCounts`.
    """
    counts = [F.count(F.lit(1)).alias("rows"), *_counts(rules)]
    if df.isStreaming:
        return df.observe(name, *counts), None
    seen = Observation(name)
    return df.observe(seen, *counts), seen


class StreamCounts(StreamingQueryListener):
    """Rows and violations of every micro-batch of one stream, summed as they are reported.

    Use as a context in which the stream runs; a query's own progress only holds its last reports.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self.total: dict[str, int] = {}
        self.ended: set[str] = set()
        self.news = threading.Condition()

    def __enter__(self) -> StreamCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics.get(self.name)
        if found:
            for key, value in found.asDict().items():
                self.total[key] = self.total.get(key, 0) + value

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self.ended.add(str(event.runId))
            self.news.notify_all()

    def of(self, running: StreamingQuery, patience: float = 60) -> dict[str, int]:
        """The counts once ``running`` has ended and all of its reports are in."""
        running.awaitTermination()
        with self.news:
            if not self.news.wait_for(lambda: str(running.runId) in self.ended, patience):
                raise TimeoutError(f"the end of stream {self.name} was not reported")
        return self.total


def rule_report(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule with passed and failed counts, from a single pass over the data."""
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"r{i}") for i, c in enumerate(_counts(rules))])
    entries = F.array(
        *[
            F.struct(
                F.lit(n).alias("rule"),
                (F.col("rows") - F.col(f"r{i}")).alias("passed"),
                F.col(f"r{i}").alias("failed"),
            )
            for i, n in enumerate(rules)
        ]
    )
    return wide.select(F.inline(entries))


def expect_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.where(_kept(rules, {}))


def expect_or_fail(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.where(_kept({}, rules))


def quarantine(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows that satisfy the quarantine rules (they are written negatively)."""
    return df.where(passes_all(rules) if rules else F.lit(False))


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    return expect_or_fail(df, {f"{c} is missing": f"`{c}` IS NOT NULL" for c in columns})


@dataclass(frozen=True)
class Checked:
    main: DataFrame
    quarantine: DataFrame
    metrics: Observation | None


def apply_quality(df: DataFrame, rules: RuleSet, name: str = "quality") -> Checked:
    """Main rows, quarantined rows and the violation counts of all rules but quarantine."""
    main, seen = expect(df, rules.counted, name) if rules.counted else (df, None)
    main = main.where(_kept(rules.drop, rules.fail)) if rules.drop or rules.fail else main
    return Checked(main, quarantine(df, rules.quarantine), seen)


ROUTE = "__route"


def route_rows(df: DataFrame, rules: RuleSet) -> DataFrame:
    """All output rows of a checked table in one pass, told apart by ``__route``.

    A row may go to main, to quarantine, to both or to none.
    """
    if not rules.quarantine:
        return df.where(_kept(rules.drop, rules.fail)).withColumn(ROUTE, F.lit("main"))
    main, held = F.lit("main"), F.lit("quarantine")
    keep, hold = passes_all(rules.drop), passes_all(rules.quarantine)
    ways = F.when(keep & hold, F.array(main, held)).when(keep, F.array(main)).when(hold, F.array(held))
    checked = df.where(_kept({}, rules.fail)) if rules.fail else df
    return checked.withColumn(ROUTE, F.explode(ways))
