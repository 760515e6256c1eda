"""Places on a space-filling curve, so that rows near in several columns come to lie in one file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.operators.project import pinned

BITS = 6


def _number(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values; texts by their first bytes."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.substring(F.rpad(F.hex(col.cast("binary")), 14, "0"), 1, 14)
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, T.BooleanType):
        return col.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def _passed(cuts: list[float], number: Column) -> Column:
    """How many of the cuts are at or below a number; 0 for NULL."""
    return F.coalesce(F.size(F.filter(F.lit(cuts), lambda cut: cut <= number)), F.lit(0)) if cuts else F.lit(0)


def with_curve_place(df: DataFrame, columns: list[str], name: str, bits: int = BITS) -> DataFrame:
    """Add ``name``: the bits of each column's rank in turn, the highest first.

    Ranks count how many of ``2 ** bits - 1`` cuts of equal frequency (approximate, from one pass over these columns) a
    value passes, so skewed values use the curve as evenly as others. NULL has rank 0.
    """
    numbers = [_number(df, c) for c in columns]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(f"c{i}") for i, n in enumerate(numbers)]).first()
    ranks = {}
    for i, (cut, number) in enumerate(zip(cuts, numbers)):
        ranks[f"__rank{i}"] = _passed(list(cut or []), number)
    place = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            place = F.shiftleft(place, 1) + F.shiftright(rank, bit).bitwiseAND(1)
    return pinned(df, **ranks).withColumn(name, place).drop(*ranks)
