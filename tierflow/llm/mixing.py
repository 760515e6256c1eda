"""Mix sources to target weights by weighted sampling without replacement, in whole epochs and a fraction.

A document's key is exponential, ``-ln(u) / quality``, with ``u`` from the MD5 of its id, so that sorting by the key draws
documents in the order of weighted sampling (Efraimidis and Spirakis), the same in every run. A source first gives as many
complete epochs as fit its target, then the documents at the front of its order whose words fill what is left.

Prefix sums are two-level, as one source may hold any share of all rows: words per (source, bin of the key), summed up
bin by bin on the counts, then sums within a bin of about ``bin_rows`` rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import KEY_BITS, id_key, pinned, word_count
from tierflow.session import materialize

SYMBOLS = "#*$%&|<>"
LEAST_QUALITY = 0.05


def symbol_quality(text: str = "text") -> Column:
    """Share of the characters that are no symbols, at least 0.05; 1 for empty texts."""
    chars = F.length(text)
    share = 1 - F.try_divide(chars - F.length(F.translate(text, SYMBOLS, "")), chars)
    return F.coalesce(F.greatest(share, F.lit(LEAST_QUALITY)), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Target of each source: (source, source_size) -> also rank and target.

    Sources in code point order, NULL last, weigh ``weights`` in turn and share the sum of all sizes; none gets more than
    ``most`` times its size. Sharing out the excess until none is above equals: sources in the order of cap / weight are
    capped as long as the others' share, in proportion to weight, lies above their cap. One row per source only.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.lit(list(weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", most * F.col("source_size")).withColumn("place", F.row_number().over(by_room))
    ranked = ranked.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    left = F.col("total") - F.coalesce(F.sum("cap").over(by_room.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = ranked.withColumn("left", left)
    ranked = ranked.withColumn("weights", F.sum("weight").over(by_room.rowsBetween(0, Window.unboundedFollowing)))
    free = F.col("left") * F.col("weight") <= F.col("cap") * F.col("weights")
    ranked = ranked.withColumn("first", F.min(F.when(free, F.struct("place", "left", "weights"))).over(Window.partitionBy()))
    share = F.col("weight") * F.col("first.left") / F.col("first.weights")
    target = F.when(F.col("place") < F.coalesce("first.place", F.lit(2**31 - 1)), F.col("cap").cast("double")).otherwise(share)
    return ranked.select("source", "source_size", "rank", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, quality: Column | None = None, bin_rows: int = 20_000, keep: bool = False) -> DataFrame:
    """Words that the mix takes of every document.

    Gives doc_id, size, source_size, target and taken, or with ``keep`` the input's rows and columns, each repeated as
    often as it is taken. Words are counted over whole texts; a NULL or empty text has size 0 and is never taken. ``taken``
    is a multiple of the size: the whole epochs, and one more for the documents drawn. The last one is drawn if this comes
    nearer to the target. Documents that agree in key and id (repeated rows) are drawn in the order of their sizes.
    """
    quality = symbol_quality() if quality is None else quality
    u = (F.greatest(id_key("doc_id"), F.lit(0)) + 0.5) / float(2**KEY_BITS)
    computed = {"__size": word_count("text"), "__key": -F.log(u) / quality, "__d": id_key("doc_id")}
    if keep:
        packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", "text")
        rows = pinned(packed, **computed).drop("doc_id", "text")
        narrow = materialize(rows.select("source", "__size", "__key", "__d"))
    else:
        rows = narrow = materialize(docs.select("doc_id", "source", *[c.alias(n) for n, c in computed.items()]))
    per_source = narrow.groupBy("source").agg(F.sum("__size").alias("source_size"), F.count("*").alias("rows"))
    per_source = materialize(per_source)
    largest = per_source.agg(F.max("rows")).first()[0] or 0
    targets = source_targets(per_source.drop("rows"), weights, most)
    targets = targets.select(*[F.col(c).alias(f"__{c}") for c in targets.columns])
    bins = max(1, math.ceil(largest / bin_rows))
    binned = F.least(F.lit(bins - 1), F.floor(bins * (1 - F.exp(-F.col("__key"))))).cast("int")

    def placed(df: DataFrame) -> DataFrame:
        return df.join(targets, df["source"].eqNullSafe(targets["__source"])).withColumn("__bin", binned)

    per_bin = placed(narrow).groupBy("__rank", "__bin").agg(F.sum("__size").alias("words"))
    order = Window.partitionBy("__rank").orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.select("__rank", "__bin", F.coalesce(F.sum("words").over(order), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__rank", "__bin").orderBy("__key", "__d", "__size").rowsBetween(Window.unboundedPreceding, -1)
    drawn = placed(rows).withColumn("__before", F.coalesce(F.sum("__size").over(within), F.lit(0))).join(per_bin, ["__rank", "__bin"])
    epochs = F.when(F.col("__source_size") > 0, F.floor(F.col("__target") / F.col("__source_size"))).otherwise(0)
    rest = F.col("__target") - epochs * F.col("__source_size")
    more = 2 * (F.col("__start") + F.col("__before")) + F.col("__size") <= 2 * rest
    times = F.when(F.col("__size") > 0, epochs + F.when(more & (epochs < most), 1).otherwise(0)).otherwise(0)
    if keep:
        copies = drawn.withColumn("__times", times.cast("int")).filter("__times > 0")
        return copies.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__times"))).select([F.col(f"row.`{c}`") for c in docs.columns])
    return drawn.select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (times * F.col("__size")).cast("long").alias("taken"),
    )
