"""SQL view chains over named frames."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierflow.functions.crypto import Cipher, decrypt_columns, encrypt_columns
from tierflow.operators.project import where_all
from tierflow.plans.relations import ordered, relations, renamed
from tierflow.session import materialize
from tierflow.sources.tables import for_environment, sql_source

_LIVE = re.compile(r"\blive\.(`[^`]+`|\w+)", re.IGNORECASE)


def strip_live(sql: str) -> str:
    """The ``live.`` prefix marks a view of the same run."""
    return _LIVE.sub(r"\1", sql)


def plain_name(name: str | tuple[str, ...]) -> str:
    """A table name as the registry knows it: lower case, without quotes and ``live.``."""
    parts = [p.strip("`") for p in re.findall(r"`[^`]*`|[^.`]+", name)] if isinstance(name, str) else list(name)
    if len(parts) > 1 and parts[0].lower() == "live":
        parts = parts[1:]
    return ".".join(parts).lower()


class ViewRegistry:
    """Named frames of one run, visible to its SQL only.

    A frame is a temporary view of a name of its own; in SQL texts the tables of that name, and nothing else, are replaced by
    it. So runs in one session do not see each other's views, and columns or strings named like a view stay as they are.
    A view that several targets read is written once to the shared folder, so that each reader scans the result instead of
    computing it again.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.frames: dict[str, DataFrame] = {}
        self._prefix = f"run_{uuid.uuid4().hex}_"
        self._views: dict[str, str] = {}

    def register(self, name: str, df: DataFrame) -> DataFrame:
        known = plain_name(name)
        self._views[known] = self._views.get(known, f"{self._prefix}{len(self._views)}")
        df.createOrReplaceTempView(self._views[known])
        self.frames[known] = df
        return df

    def sql(self, text: str) -> DataFrame:
        def view(parts: tuple[str, ...]) -> str | None:
            known = self._views.get(plain_name(parts))
            if known is None and parts[0].lower() == "live" and len(parts) > 1:
                return ".".join(f"`{p}`" for p in parts[1:])
            return known

        return self.spark.sql(renamed(self.spark, text, view))

    def source(self, table: str, streaming: bool, pii: dict[str, str], cipher: Cipher | None, condition: str | None) -> DataFrame:
        """A registered frame or a table of the catalogue, decrypted and then filtered."""
        df = self.frames.get(plain_name(table))
        if df is None:
            return sql_source(self.spark, strip_live(table), streaming=streaming, pii=pii, cipher=cipher, condition=condition)
        if pii and cipher:
            df = decrypt_columns(df, pii, cipher)
        return where_all(df, condition)

    def share(self, name: str) -> DataFrame:
        df = self.frames[plain_name(name)]
        return df if df.isStreaming else self.register(name, materialize(df))


def register_sources(
    registry: ViewRegistry, sources: list[dict], env: str, cipher: Cipher | None, streaming: bool
) -> None:
    """Sources of a target; on a batch flow every source is read as a batch."""
    for source in sources:
        as_stream = streaming and str(source.get("is_streaming") or "true").lower() == "true"
        df = registry.source(
            for_environment(source, "source_table", env), as_stream, {k: v for k, v in (source.get("pii_fields") or {}).items() if v},
            cipher, source.get("filter_condition"),
        )
        registry.register(source["reference_name"], df)


def view_chain(
    registry: ViewRegistry, views: list[tuple[str, str]], pii: dict[str, str] | None = None, cipher: Cipher | None = None
) -> DataFrame:
    """Register views in order; each may read the earlier ones, the last is the result (encrypted)."""
    if not views:
        raise ValueError("a view chain needs at least one view")
    df = None
    for i, (name, sql) in enumerate(views):
        df = registry.sql(sql)
        if i == len(views) - 1 and pii and cipher:
            df = encrypt_columns(df, pii, cipher)
        registry.register(name, df)
    return df


def target_needs(spark: SparkSession, targets: list[dict], env: str) -> tuple[dict[str, set[str]], dict[str, set[str]]]:
    """For each target the targets it reads, and for each view name the targets whose SQL reads it.

    A name belongs to the target whose result goes by it, else to the first that defines it as a view, else to the first that
    has a source of that name; a target's own views and sources come before those of others.
    """
    owner: dict[str, str] = {}
    for names in (
        lambda t: [n for n in (t["target"], t.get("alias")) if n],
        lambda t: [v["name"] for v in t["views"]],
        lambda t: [s["reference_name"] for s in t.get("sources") or []],
    ):
        for t in targets:
            for name in names(t):
                owner.setdefault(plain_name(name), t["target"])
    needs: dict[str, set[str]] = {}
    readers: dict[str, set[str]] = {}
    for t in targets:
        own = {plain_name(n) for n in [*(v["name"] for v in t["views"]), *(s["reference_name"] for s in t.get("sources") or [])]}
        read = [plain_name(r.parts) for v in t["views"] for r in relations(spark, v["sql"])]
        read += [plain_name(n) for n in [*(for_environment(s, "source_table", env) for s in t.get("sources") or []), *(t.get("waits") or [])]]
        for name in read:
            readers.setdefault(name, set()).add(t["target"])
        needs[t["target"]] = {owner[n] for n in read if n in owner and n not in own} - {t["target"]}
    return needs, readers


def build_targets(
    registry: ViewRegistry, targets: list[dict], env: str = "dev", cipher: Cipher | None = None, streaming: bool = False,
    bind: Callable[[dict], None] | None = None, built: Callable[[dict, DataFrame], None] | None = None,
) -> dict[str, DataFrame]:
    """Final frames of several targets that share views, each made behind those it reads.

    A target is ``{target, sources, views: [{name, sql}], pii, alias, streaming, waits}``; other targets may read its result
    under its name or alias (``waits`` names tables it reads in other ways). What a target reads comes from the parsed plan of its SQL, batch and streaming targets together; targets
    that wait for each other are an error. A view read by two or more targets is materialized once. ``bind`` is called
    before a target is made (its sources can be registered then), ``built`` with its frame.
    """
    by_name = {t["target"]: t for t in targets}
    needs, readers = target_needs(registry.spark, targets, env)
    done: dict[str, DataFrame] = {}
    for name in ordered(list(by_name), needs):
        t = by_name[name]
        if bind:
            bind(t)
        register_sources(registry, t.get("sources") or [], env, cipher, t.get("streaming", streaming))
        views = [(v["name"], v["sql"]) for v in t["views"]]
        if not views:
            raise ValueError("a view chain needs at least one view")
        for i, view in enumerate(views):
            last = i == len(views) - 1
            df = view_chain(registry, [view], t.get("pii") if last else None, cipher)
            if not last and len(readers.get(plain_name(view[0]), ())) > 1:
                registry.share(view[0])
        done[name] = df
        registry.register(name, df)
        if t.get("alias"):
            registry.register(t["alias"], df)
        if built:
            built(t, df)
    return done
