"""What several operators share: the tables, the word rules, keys of texts, small frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
KEY_BITS = 60

# Byte classes for the word rule of decontamination: letters and digits in ASCII, everything above it.
ASCII_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column | str) -> Column:
    """Number of words of the text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform_key(column: Column) -> Column:
    """The first 60 bits of the MD5 of a string, as a non-negative long; -1 for NULL."""
    return F.coalesce(F.conv(F.substring(F.md5(column.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long"), F.lit(-1))


def id_key(doc_id: Column | str) -> Column:
    return uniform_key(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"))


def learned_from(doc_id: Column | str, modulus: int, held_out: int) -> Column:
    """False for the rows held out by the CRC of their id; NULL ids count as held out, as they have no CRC."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % modulus != held_out, F.lit(False))


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator, so that later uses read the value instead of computing it again."""
    row = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline(row))
