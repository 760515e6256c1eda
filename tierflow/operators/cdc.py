"""Change data capture: type-1 upserts and type-2 history from a change feed.

Contract (batch and stream alike)

* The result is a function of the *set* of events: arrival order, batch split and replays do not matter.
* A NULL sequence cannot be ordered; such rows go to :func:`rejected_changes`, never to the target.
* Two events of one key with equal sequence: a delete wins, then the larger row in column order.
* A truncate at ``t`` removes every event with a sequence below ``t``; type 1 only.
* Type-2 versions are half open: ``[__START_AT, __END_AT)``, NULL end while the version is current.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.ordering import (
    HOT_KEY_ROWS,
    RUN,
    KeyOrder,
    by_key_order,
)

START, END = "__START_AT", "__END_AT"
SEQ, OP, ROW = "__seq", "__op", "__row"
UPSERT, DELETE, TRUNCATE = 0, 1, 2


@dataclass(frozen=True)
class ChangeOptions:
    """Options of one change-capture target; the defaults are the metadata format's defaults."""

    keys: tuple[str, ...]
    sequence_by: str
    scd_type: str = "1"
    where: str | None = None
    ignore_null_updates: bool = False
    ignore_null_updates_column_list: tuple[str, ...] | None = None
    ignore_null_updates_except_column_list: tuple[str, ...] | None = None
    apply_as_deletes: str | None = None
    apply_as_truncates: str | None = None
    column_list: tuple[str, ...] | None = None
    except_column_list: tuple[str, ...] | None = None
    track_history_column_list: tuple[str, ...] | None = None
    track_history_except_column_list: tuple[str, ...] | None = None
    flow_name: str | None = None
    once: bool = False

    def __post_init__(self):
        if not self.keys:
            raise ValueError("keys must name at least one column")
        if not self.sequence_by:
            raise ValueError("sequence_by is mandatory")
        if str(self.scd_type) not in ("1", "2"):
            raise ValueError(f"scd_type must be 1 or 2, got {self.scd_type!r}")
        if str(self.scd_type) == "2" and self.apply_as_truncates:
            raise ValueError("apply_as_truncates needs scd_type 1")
        for a, b in (
            ("column_list", "except_column_list"),
            ("track_history_column_list", "track_history_except_column_list"),
            ("ignore_null_updates_column_list", "ignore_null_updates_except_column_list"),
        ):
            if getattr(self, a) and getattr(self, b):
                raise ValueError(f"{a} and {b} exclude each other")
        object.__setattr__(self, "scd_type", str(self.scd_type))

    @classmethod
    def of(cls, mapping: dict) -> "ChangeOptions":
        """Build from a metadata mapping; blank texts and empty lists mean "not set"."""
        missing = [k for k in ("keys", "sequence_by", "scd_type") if not mapping.get(k)]
        if missing:
            raise ValueError(f"change options lack mandatory {missing}")
        known = {}
        for name in cls.__dataclass_fields__:
            value = mapping.get(name)
            if value is None or value == "" or value == []:
                continue
            if name == "once" or name == "ignore_null_updates":
                value = str(value).lower() == "true"
            known[name] = tuple(value) if isinstance(value, list) else value
        return cls(**known)


def _find(columns: list[str], names) -> list[str]:
    """Resolve names to the columns as spelled in the data; SQL names ignore case."""
    by_lower = {c.lower(): c for c in columns}
    missing = [n for n in names if n.lower() not in by_lower]
    if missing:
        raise ValueError(f"no column {missing} in {columns}")
    return [by_lower[n.lower()] for n in names]


def _pick(columns: list[str], only, but) -> list[str]:
    if only:
        return [c for c in columns if c in set(_find(columns, only))]
    if but:
        dropped = {n.lower() for n in but}
        return [c for c in columns if c.lower() not in dropped]
    return list(columns)


def stored_columns(columns: list[str], opts: ChangeOptions) -> list[str]:
    """Columns of the target: the keys always, the others by column_list / except_column_list."""
    keys = _find(columns, opts.keys)
    kept = set(_pick(columns, opts.column_list, opts.except_column_list)) | set(keys)
    return [c for c in columns if c in kept]


def stored_schema(schema: T.StructType, opts: ChangeOptions) -> T.StructType:
    return T.StructType([schema[c] for c in stored_columns(schema.names, opts)])


def tracked_columns(columns: list[str], opts: ChangeOptions) -> list[str]:
    keys = set(_find(columns, opts.keys))
    values = [c for c in stored_columns(columns, opts) if c not in keys]
    return _pick(values, opts.track_history_column_list, opts.track_history_except_column_list)


def null_keeping_columns(columns: list[str], opts: ChangeOptions) -> list[str]:
    """Columns in which a NULL update keeps the older value."""
    keys = set(_find(columns, opts.keys))
    values = [c for c in stored_columns(columns, opts) if c not in keys]
    only, but = opts.ignore_null_updates_column_list, opts.ignore_null_updates_except_column_list
    if not (opts.ignore_null_updates or only or but):
        return []
    return _pick(values, only, but)


def _sequence(opts: ChangeOptions) -> Column:
    return F.expr(opts.sequence_by)


def _flag(predicate: str | None) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False)) if predicate else F.lit(False)


def rejected_changes(df: DataFrame, opts: ChangeOptions) -> DataFrame:
    """Rows that cannot be ordered."""
    source = df.where(opts.where) if opts.where else df
    return source.where(_sequence(opts).isNull())


def read_changes(df: DataFrame, opts: ChangeOptions) -> DataFrame:
    """Change rows as: keys, ``__seq``, ``__op`` and the stored values in the struct ``__row``."""
    source = df.where(opts.where) if opts.where else df
    keys = _find(df.columns, opts.keys)
    values = [c for c in stored_columns(df.columns, opts) if c not in set(keys)]
    op = (
        F.when(_flag(opts.apply_as_truncates), F.lit(TRUNCATE))
        .when(_flag(opts.apply_as_deletes), F.lit(DELETE))
        .otherwise(F.lit(UPSERT))
    )
    packed = [pack(F.col(f"`{c}`"), df.schema[c].dataType).alias(c) for c in values]
    row = F.struct(*packed) if values else F.struct(F.lit(None).cast("boolean").alias("__none"))
    return source.select(
        *[F.col(f"`{k}`") for k in keys], _sequence(opts).alias(SEQ), op.alias(OP), row.alias(ROW)
    ).where(F.col(SEQ).isNotNull())


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def pack(col: Column, dtype: T.DataType) -> Column:
    """A value that can be compared: a map as its sorted entries, a variant as its JSON text."""
    if _orderable(dtype):
        return col
    if isinstance(dtype, T.MapType) and _orderable(dtype.keyType) and _orderable(dtype.valueType):
        return F.array_sort(F.map_entries(col))
    if isinstance(dtype, T.VariantType):
        return F.to_json(col)
    raise ValueError(f"change capture cannot compare values of type {dtype.simpleString()}")


def unpack(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.MapType):
        return F.map_from_entries(col)
    return F.parse_json(col) if isinstance(dtype, T.VariantType) else col


# --- type 1 -------------------------------------------------------------------------------------
#
# Per key it is enough to know the latest upsert, the latest delete and, for columns that ignore NULL
# updates, the latest non-NULL value. All of them are maxima: partial results merge in any order, so
# the same three functions serve a batch, a stream and its stored state, and Spark combines them
# before the shuffle.


def key_state(changes: DataFrame, keys: list[str], keep_nulls: list[str]) -> DataFrame:
    upsert = F.col(OP) == UPSERT
    latest = F.struct(F.col(SEQ).alias("seq"), F.col(ROW).alias("row"))
    aggs = [
        F.max(F.when(upsert, latest)).alias("__up"),
        F.max(F.when(F.col(OP) == DELETE, F.col(SEQ))).alias("__del"),
    ]
    for i, c in enumerate(keep_nulls):
        value = F.col(ROW)[c]
        filled = F.struct(F.col(SEQ).alias("seq"), value.alias("value"))
        aggs.append(F.max(F.when(upsert & value.isNotNull(), filled)).alias(f"__n{i}"))
    return changes.where(F.col(OP) != TRUNCATE).groupBy(*keys).agg(*aggs)


def merge_states(states: DataFrame, keys: list[str], keep_nulls: list[str]) -> DataFrame:
    aggs = [F.max(c).alias(c) for c in ("__up", "__del")]
    aggs += [F.max(f"__n{i}").alias(f"__n{i}") for i in range(len(keep_nulls))]
    return states.groupBy(*keys).agg(*aggs)


def live_rows(
    state: DataFrame,
    keys: list[str],
    keep_nulls: list[str],
    schema: T.StructType,
    truncated_at: Column | None = None,
) -> DataFrame:
    """Current rows of a key state; ``schema`` lists the target's columns in order."""

    def alive(seq: Column) -> Column:
        ok = F.col("__del").isNull() | (seq > F.col("__del"))
        if truncated_at is not None:
            ok = ok & F.coalesce(seq >= truncated_at, F.lit(True))
        return ok

    out = []
    for field in schema.fields:
        c = field.name
        if c in keys:
            out.append(F.col(f"`{c}`"))
            continue
        if c in keep_nulls:
            held = F.col(f"__n{keep_nulls.index(c)}")
            value = F.when(alive(held["seq"]), held["value"])
        else:
            value = F.col("__up")["row"][c]
        out.append(unpack(value, field.dataType).alias(c))
    return state.where(F.col("__up").isNotNull() & alive(F.col("__up")["seq"])).select(*out)


def truncate_point(changes: DataFrame) -> DataFrame:
    """One row: the highest truncate sequence, NULL if there is none."""
    return changes.where(F.col(OP) == TRUNCATE).agg(F.max(SEQ).alias("at"))


def _type1(df: DataFrame, opts: ChangeOptions) -> DataFrame:
    changes = read_changes(df, opts)
    keys = _find(df.columns, opts.keys)
    keep = null_keeping_columns(df.columns, opts)
    at = truncate_point(changes).scalar() if opts.apply_as_truncates else None
    return live_rows(key_state(changes, keys, keep), keys, keep, stored_schema(df.schema, opts), at)


# --- type 2 -------------------------------------------------------------------------------------


def unique_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """One row per (keys, sequence), chosen by the tie rule."""
    return (
        changes.groupBy(*keys, SEQ)
        .agg(F.max(F.struct(F.col(OP).alias("op"), F.col(ROW).alias("row"))).alias("__best"))
        .select(*keys, SEQ, F.col("__best.op").alias(OP), F.col("__best.row").alias(ROW))
    )


def history(
    changes: DataFrame,
    keys: list[str],
    schema: T.StructType,
    tracked: list[str],
    keep_nulls: list[str],
    *,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Versions of every key from change rows as :func:`read_changes` makes them."""
    untracked = [c for c in schema.names if c not in keys and c not in tracked]

    def body(rows: DataFrame, order: KeyOrder) -> DataFrame:
        if keep_nulls:
            rows = _carry_values(rows, order, keep_nulls)
        seen = F.struct(F.col(OP).alias("op"), *[F.col(ROW)[c].alias(f"c{i}") for i, c in enumerate(tracked)])
        rows = order.previous(rows, "__prev", seen)
        before = F.col("__prev.value")
        same = [F.col(ROW)[c].eqNullSafe(before[f"c{i}"]) for i, c in enumerate(tracked)]
        unchanged = reduce(lambda a, b: a & b, same, F.lit(True))
        after_live = F.col("__prev").isNotNull() & (before["op"] == UPSERT)
        opens = (F.col(OP) == UPSERT) & ~(after_live & unchanged)
        closes = (F.col(OP) == DELETE) & after_live
        rows = rows.withColumn("__edge", F.when(opens, "open").when(closes, "close")).drop("__prev")
        is_edge = F.col("__edge").isNotNull()
        if untracked:
            # A version is named by its opening sequence; its last row brings the untracked values.
            rows = order.running_max(rows, {"__from": F.when(is_edge, F.col(SEQ))})
            aggs = [
                F.max_by(ROW, F.when(F.col(OP) == UPSERT, F.col(SEQ))).alias(ROW),
                F.max("__edge").alias("__edge"),
            ]
            if order.split:
                aggs.append(F.max(F.when(is_edge, F.col(RUN))).alias(RUN))
            edges = rows.groupBy(*keys, F.col("__from").alias(SEQ)).agg(*aggs).where(is_edge)
        else:
            edges = rows.where(is_edge)
        edges = order.next_order(edges, END).where(F.col("__edge") == "open")
        out = [
            F.col(f"`{f.name}`") if f.name in keys else unpack(F.col(ROW)[f.name], f.dataType).alias(f.name)
            for f in schema.fields
        ]
        return edges.select(*out, F.col(SEQ).alias(START), F.col(END).alias(END))

    return by_key_order(
        changes,
        keys,
        SEQ,
        lambda rows: unique_changes(rows, keys),
        body,
        hot_key_rows=hot_key_rows,
    )


def _carry_values(rows: DataFrame, order: KeyOrder, keep_nulls: list[str]) -> DataFrame:
    """Replace NULLs of ``keep_nulls`` by the key's last value since its last delete."""
    wanted = {"__gone": F.when(F.col(OP) == DELETE, F.col(SEQ))}
    for i, c in enumerate(keep_nulls):
        value = F.col(ROW)[c]
        wanted[f"__n{i}"] = F.when(
            (F.col(OP) == UPSERT) & value.isNotNull(),
            F.struct(F.col(SEQ).alias("seq"), value.alias("value")),
        )
    fields = [f.name for f in rows.schema[ROW].dataType.fields]
    rows = order.running_max(rows, wanted)
    filled = []
    for c in fields:
        if c in keep_nulls:
            held = F.col(f"__n{keep_nulls.index(c)}")
            fresh = F.col("__gone").isNull() | (held["seq"] > F.col("__gone"))
            filled.append(F.when(fresh, held["value"]).alias(c))
        else:
            filled.append(F.col(ROW)[c].alias(c))
    return rows.withColumn(ROW, F.struct(*filled)).drop(*wanted)


def _type2(df: DataFrame, opts: ChangeOptions, **limits) -> DataFrame:
    return history(
        read_changes(df, opts),
        _find(df.columns, opts.keys),
        stored_schema(df.schema, opts),
        tracked_columns(df.columns, opts),
        null_keeping_columns(df.columns, opts),
        **limits,
    )


def history_schema(
    schema: T.StructType, sequence_type: T.DataType, except_cols: list[str] | None = None
) -> T.StructType:
    """Schema of a type-2 target: excluded columns out, version bounds of the sequence's type in."""
    gone = {c.lower() for c in except_cols or []}
    fields = [f for f in schema.fields if f.name.lower() not in gone]
    bounds = [T.StructField(START, sequence_type), T.StructField(END, sequence_type)]
    return T.StructType(fields + bounds)


def apply_changes(
    df: DataFrame,
    keys: list[str] | ChangeOptions,
    sequence_by: str | None = None,
    scd_type: int | str = 1,
    *,
    hot_key_rows: int = HOT_KEY_ROWS,
    **options,
) -> DataFrame:
    """Target table of a change feed.

    Takes either ready :class:`ChangeOptions` or the keys, the sequence and its keyword options.
    """
    if df.isStreaming:
        raise ValueError("a stream needs apply_changes_stream, which keeps state between batches")
    if isinstance(keys, ChangeOptions):
        opts = keys if not options else replace(keys, **options)
    else:
        named = {k: tuple(v) if isinstance(v, list) else v for k, v in options.items()}
        opts = ChangeOptions(tuple(keys), sequence_by, scd_type, **named)
    if opts.scd_type == "1":
        return _type1(df, opts)
    return _type2(df, opts, hot_key_rows=hot_key_rows)
