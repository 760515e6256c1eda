"""Flatten nested records into scalar columns, driven by the schema alone.

Field ``b`` of struct ``a`` becomes ``a__b`` at the end of the row and ``a`` goes away. Below the root,
arrays are exploded and empty ones keep their row; several arrays at one level multiply. At the root an
array is exploded only if it is the sole column or named by the caller, and then its rows vanish when
it is empty and its fields get no prefix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_DEPTH = 100


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _select(df: DataFrame, columns: list[tuple[str, object]]) -> DataFrame:
    names = [n.lower() for n, _ in columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"flattening would produce columns twice: {clash}")
    return df.select(*[c.alias(n) for n, c in columns])


def _explode(df: DataFrame, name: str, keep_empty: bool) -> DataFrame:
    generator = F.explode_outer if keep_empty else F.explode
    return df.select(*[generator(_quoted(c)).alias(c) if c == name else _quoted(c) for c in df.columns])


def _expand_last(df: DataFrame, name: str) -> DataFrame:
    """Replace a struct column by its fields, unprefixed, at the end."""
    dtype = df.schema[name].dataType
    if not isinstance(dtype, T.StructType):
        return df
    rest = [(c, _quoted(c)) for c in df.columns if c != name]
    return _select(df, rest + [(f, _quoted(name).getField(f)) for f in dtype.fieldNames()])


def _open_structs(df: DataFrame) -> DataFrame:
    plain, opened = [], []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StructType):
            opened += [
                (f"{field.name}__{sub}", _quoted(field.name).getField(sub)) for sub in field.dataType.fieldNames()
            ]
        else:
            plain.append((field.name, _quoted(field.name)))
    return _select(df, plain + opened) if opened else df


def _kinds(df: DataFrame, kind: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def flatten(df: DataFrame, column: str = "", max_depth: int = MAX_DEPTH) -> DataFrame:
    """``df`` without structs and arrays. ``column`` names the root column to extract, if any."""
    for level in range(max_depth + 1):
        if not df.columns:
            return df
        arrays = _kinds(df, T.ArrayType)
        if column and column in df.columns:
            if column in arrays:
                df = _explode(df, column, keep_empty=False)
            df = _expand_last(df, column)
            column = ""
        elif not column and level == 0 and arrays:
            if len(df.columns) > 1:
                raise ValueError(f"name the column to extract: arrays {arrays} among columns {df.columns}")
            df = _expand_last(_explode(df, arrays[0], keep_empty=False), arrays[0])
        elif not column:
            for name in arrays:
                df = _explode(df, name, keep_empty=True)
        elif not _kinds(df, T.StructType):
            raise ValueError(f"no column {column!r} to extract in {df.columns}")
        df = _open_structs(df)
        if not (_kinds(df, T.StructType) or _kinds(df, T.ArrayType)):
            if column:
                raise ValueError(f"no column {column!r} to extract in {df.columns}")
            return df
    raise ValueError(f"nested deeper than {max_depth} levels: {df.schema.simpleString()}")


def flatten_by_spec(df: DataFrame, flag: str | None, column: str | list[str] | None) -> DataFrame:
    """Flatten when the metadata flag says so; of a list of columns the first one counts."""
    if str(flag or "").lower() != "true":
        return df
    name = (column[0] if column else "") if isinstance(column, list) else (column or "")
    return flatten(df, name)
