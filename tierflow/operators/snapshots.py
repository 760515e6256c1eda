"""Change capture from full snapshots: each snapshot is compared with what is already stored.

Versions rise strictly and serve as the sequence. A key missing from version ``n`` ends at ``n``;
an unchanged row stays untouched; a key that occurs twice in one snapshot is an error.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.operators.cdc import END, START, ChangeOptions, pack, tracked_columns


def snapshot_options(keys, scd_type="1", only=None, but=None) -> ChangeOptions:
    return ChangeOptions(
        tuple(keys),
        "version",
        str(scd_type),
        track_history_column_list=tuple(only) if only else None,
        track_history_except_column_list=tuple(but) if but else None,
    )


def _twice(keys: list[str]) -> Column:
    told = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]))
    return F.raise_error(F.concat_ws(" ", F.lit("key occurs twice in a snapshot:"), told))


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` unchanged; a repeated key raises."""
    nr = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    return df.withColumn("__nr", nr).where(F.when(F.col("__nr") == 1, True).otherwise(_twice(keys))).drop("__nr")


def _differs(left: Column, right: Column, columns: list[str]) -> Column:
    same = [left[c].eqNullSafe(right[c]) for c in columns]
    return ~reduce(lambda a, b: a & b, same, F.lit(True))


def _paired(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old and new row of every key side by side; a shuffle of each side on the keys."""
    o = old.select(F.struct(*[F.col(f"`{c}`") for c in old.columns]).alias("o"))
    n = new.select(F.struct(*[F.col(f"`{c}`") for c in new.columns]).alias("n"))
    on = reduce(lambda a, b: a & b, (o["o"][k].eqNullSafe(n["n"][k]) for k in keys))
    return o.join(n, on, "full")


def snapshot_step_type1(state: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """Type-1 target after one snapshot: missing keys go, the others take the snapshot's values.

    That is the snapshot itself, so the stored rows need not be read at all.
    """
    return one_row_per_key(snapshot, keys).select(*state.columns)


def snapshot_changes(state: DataFrame, snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """What a snapshot does to a type-1 target: a row per inserted, updated or deleted key."""
    values = [c for c in state.columns if c not in keys]
    both = _paired(state, one_row_per_key(snapshot, keys).select(*state.columns), keys)
    kind = (
        F.when(F.col("o").isNull(), "insert")
        .when(F.col("n").isNull(), "delete")
        .when(_differs(F.col("o"), F.col("n"), values), "update")
    )
    row = F.coalesce("n", "o")
    return both.select(kind.alias("change"), *[row[c].alias(c) for c in state.columns]).where("change IS NOT NULL")


def snapshot_step_type2(state: DataFrame, snapshot: DataFrame, version: int, opts: ChangeOptions) -> DataFrame:
    """Type-2 target after one snapshot. Only open versions are compared; closed ones pass through."""
    keys = list(opts.keys)
    columns = [c for c in state.columns if c not in (START, END)]
    tracked = tracked_columns(columns, opts)
    untracked = [c for c in columns if c not in keys and c not in tracked]
    at = F.lit(version).cast("bigint")
    closed = state.where(F.col(END).isNotNull())
    current = state.where(F.col(END).isNull())
    both = _paired(current, one_row_per_key(snapshot, keys).select(*columns), keys)
    o, n = F.col("o"), F.col("n")
    gone = n.isNull()
    changed = o.isNotNull() & ~gone & _differs(o, n, tracked)
    stays = o.isNotNull() & ~gone & ~changed
    # An open version lives on (perhaps with newer untracked values) or ends here ...
    kept = F.struct(
        *[F.when(stays & F.lit(c in untracked), n[c]).otherwise(o[c]).alias(c) for c in columns],
        o[START].alias(START),
        F.when(gone | changed, at).alias(END),
    )
    # ... and a new or changed row opens one.
    opened = F.struct(*[n[c].alias(c) for c in columns], at.alias(START), F.lit(None).cast("bigint").alias(END))
    rows = F.when(o.isNull(), F.array(opened)).when(changed, F.array(kept, opened)).otherwise(F.array(kept))
    return closed.unionByName(both.select(F.inline(rows)))


def empty_history(snapshot: DataFrame) -> DataFrame:
    bounds = {START: F.lit(None).cast("bigint"), END: F.lit(None).cast("bigint")}
    return snapshot.withColumns(bounds).where("false")


def apply_snapshots(
    snapshots: Iterable[tuple[DataFrame, int]],
    keys: list[str],
    scd_type: int | str = 1,
    track_history_column_list: list[str] | None = None,
    track_history_except_column_list: list[str] | None = None,
) -> DataFrame:
    """Target after a series of snapshots, without intermediate tables.

    Type 1 needs the last snapshot only. Type 2 unions all of them: a key has at most one row per
    version, so a window over the key holds no more rows than there are snapshots.
    """
    series = list(snapshots)
    if not series:
        raise ValueError("no snapshot")
    versions = [v for _, v in series]
    if any(b <= a for a, b in zip(versions, versions[1:])):
        raise ValueError(f"snapshot versions must rise: {versions}")
    opts = snapshot_options(keys, scd_type, track_history_column_list, track_history_except_column_list)
    last, _ = series[-1]
    if opts.scd_type == "1":
        return one_row_per_key(last, keys)
    columns = last.columns
    tracked = tracked_columns(columns, opts)
    rows = reduce(
        DataFrame.unionByName, (df.withColumn("__v", F.lit(v).cast("bigint")) for df, v in series)
    )
    # What follows each version; the last one has no entry.
    pairs = [F.lit(x).cast("bigint") for ab in zip(versions, versions[1:]) for x in ab]
    follower = F.create_map(*pairs).cast("map<bigint,bigint>")
    per_key = Window.partitionBy(*keys).orderBy("__v")
    comparable = {f.name: pack(F.col(f"`{f.name}`"), f.dataType) for f in last.schema.fields}
    seen = F.struct("__v", *[comparable[c].alias(f"c{i}") for i, c in enumerate(tracked)])
    rows = rows.withColumn("__prev", F.lag(seen).over(per_key))
    before = F.col("__prev.__v")
    gap = F.try_element_at(follower, before) != F.col("__v")
    same = [comparable[c].eqNullSafe(F.col("__prev")[f"c{i}"]) for i, c in enumerate(tracked)]
    opens = (
        F.when(F.col("__prev").isNull(), True)
        .when(before == F.col("__v"), _twice(keys).cast("boolean"))
        .otherwise(gap | ~reduce(lambda a, b: a & b, same, F.lit(True)))
    )
    rows = rows.withColumn("__from", F.max(F.when(opens, F.col("__v"))).over(per_key))
    versions_of = rows.groupBy(*keys, "__from").agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in columns]), "__v").alias("__row"), F.max("__v").alias("__last")
    )
    # A version ends where its key is next seen changed or, sooner, where a snapshot misses the key.
    missed = F.try_element_at(follower, F.col("__last"))
    return versions_of.select(
        *[F.col("__row")[c].alias(c) for c in columns],
        F.col("__from").alias(START),
        missed.alias(END),
    )
