"""Histogram sort into shards of equal bytes.

Order: (key of the text, key of the id, id), both keys being 60 MD5 bits, so that equal texts lie together. The
splitters are found by counting: each round counts the exact bytes and rows in the cells below every open splitter (up to
12 more bits of the key a round) in one job and keeps the one cell in which it must lie, until the cell holds one key or
no more bytes than the tolerance. Counts combine before the shuffle, so a text that owns a third of all rows costs no more
than another; a cell of one text is cut by the bits of the ids at once. Then rows move once.

The driver holds about a million counts of a round and one boundary for each part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import KEY_BITS, id_key, pinned, uniform_key
from tierflow.session import materialize

STEP = 12
# Counts of a round that the driver holds; with many open cells a round looks at fewer bits of each.
MOST_COUNTS = 1 << 20


def text_size(text: str = "text") -> Column:
    """UTF-8 bytes of the text (NULL: none) plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _keys(docs: DataFrame) -> DataFrame:
    return docs.select(
        text_size().alias("size"),
        F.greatest(uniform_key(F.col("text")), F.lit(0)).alias("h"),
        F.greatest(id_key("doc_id"), F.lit(0)).alias("d"),
    )


class Splitters:
    """Boundaries of ``parts`` equal shares of the bytes, found on ``keys`` (size, h, d).

    ``bounds``: (h, d, rows below) of each splitter; rows from (h, d) on lie above.
    """

    def __init__(self, keys: DataFrame, parts: int, tolerance: int = 0):
        total, rows = keys.agg(F.sum("size"), F.count("*")).first()
        self.parts, self.total, self.rows, self.rounds = parts, total or 0, rows, 0
        found: dict[int, tuple[int, int, int]] = {}
        if not rows:
            found = {number: (0, 0, 0) for number in range(1, parts)}
        # Cells by their prefix, with what lies below them and the splitters inside: first of h, then (h, prefix of d).
        cells = {(): (0, 0, list(range(1, parts)))} if rows else {}
        one_text: dict[tuple, tuple] = {}
        for column, last in (("h", False), ("d", True)):
            used = 0
            while cells:
                bits = min(STEP, KEY_BITS - used, max(4, MOST_COUNTS.bit_length() - len(cells).bit_length()))
                counts = self._count(keys, column, used, bits, cells)
                used += bits
                inner: dict[tuple, tuple] = {}
                for cell, (bytes_below, rows_below, numbers) in cells.items():
                    listed = counts[cell]
                    at = 0
                    for number in numbers:  # ascending, so each goes on where the last one stopped
                        # The last cell that begins below the target holds the splitter.
                        while (bytes_below + listed[at].size) * parts < number * self.total:
                            bytes_below, rows_below, at = bytes_below + listed[at].size, rows_below + listed[at].n, at + 1
                        here = listed[at]
                        if here.one_h and not here.one_d and not last:
                            one_text.setdefault((here.h,), (bytes_below, rows_below, []))[2].append(number)
                        elif (here.one_h and here.one_d) or here.size <= tolerance or used == KEY_BITS:
                            end = (here.at + 1) << (KEY_BITS - used)
                            found[number] = (*((here.h, end) if last else (end, 0)), rows_below + here.n)
                        else:
                            key = (here.h, here.at) if last else (here.at,)
                            inner.setdefault(key, (bytes_below, rows_below, []))[2].append(number)
                cells = inner
            cells = one_text if not last else {}
        self.bounds = [found[i] for i in range(1, parts)]

    def _count(self, keys: DataFrame, column: str, used: int, bits: int, cells: dict) -> dict[tuple, list]:
        """The cells ``bits`` further down in each of ``cells``, in order, by one aggregation over all of them.

        Every cell has at most ``2 ** bits`` of them; ``bits`` is chosen so that all together are some million at most.
        """
        self.rounds += 1
        shift = KEY_BITS - used - bits
        prefix = [F.col("h")] if column == "d" else []
        if used:
            prefix.append(F.shiftright(column, shift + bits))
        if prefix:
            # At most one row for each splitter.
            names = [f"p{k}" for k in range(len(prefix))]
            wanted = keys.sparkSession.createDataFrame(list(cells) if used else [c[:1] for c in cells], ", ".join(f"{n} long" for n in names))
            keys = keys.withColumns(dict(zip(names, prefix))).join(F.broadcast(wanted), names, "left_semi").drop(*names)
        group = [F.shiftright(column, shift).alias("at")] + ([F.col("h").alias("text")] if column == "d" else [])
        counted = keys.groupBy(*group).agg(
            F.sum("size").alias("size"), F.count("*").alias("n"), F.min("h").alias("h"),
            (F.min("h") == F.max("h")).alias("one_h"), (F.min("d") == F.max("d")).alias("one_d"),
        )
        listed: dict[tuple, list] = {cell: [] for cell in cells}
        for row in sorted(counted.collect(), key=lambda r: r["at"]):
            above = (row["at"] >> bits,) if used else ()
            listed[((row["h"],) + above) if column == "d" else above].append(row)
        return listed

    def place(self, docs: DataFrame) -> DataFrame:
        """Add ``__h``, ``__d`` and ``__part``: the number of splitters at or below the row's key."""
        cells: dict[int, list] = {}
        for h, d, _ in self.bounds:
            cells.setdefault(h >> (KEY_BITS - STEP), []).append((h, d))
        base, table = 0, []
        for cell in range(1 << STEP):
            table.append((cell, base, cells.get(cell, [])))
            base += len(cells.get(cell, []))
        spark = docs.sparkSession
        lookup = spark.createDataFrame(table, "__cell long, __base int, __bounds array<struct<h: long, d: long>>")
        keyed = pinned(
            docs,
            __h=F.greatest(uniform_key(F.col("text")), F.lit(0)),
            __d=F.greatest(id_key("doc_id"), F.lit(0)),
        ).withColumn("__cell", F.shiftright("__h", KEY_BITS - STEP))
        here = F.struct(F.col("__h").alias("h"), F.col("__d").alias("d"))
        passed = F.size(F.filter("__bounds", lambda b: b <= here))
        # 4096 rows and parts - 1 boundaries: small whatever the input.
        return keyed.join(F.broadcast(lookup), "__cell").withColumn("__part", F.col("__base") + passed).drop("__cell", "__base", "__bounds")


def shard_documents(docs: DataFrame, shards: int = 16, rows_per_part: int = 1_000_000, tolerance: int = 0, keep: bool = False) -> DataFrame:
    """Put all documents into ``shards`` shards of near equal bytes, and number the rows of each shard.

    Gives doc_id, size, text_crc32, shard and slot, or with ``keep`` the input's columns followed by shard and slot (a
    column of such a name in the input is replaced). A shard is made of parts of about ``rows_per_part`` rows, so that
    no task sorts a whole shard. Rows with a NULL text or id take part (size 1, key 0). Rows that agree in text and
    id stay together and are numbered in any order. An empty input gives no rows.
    """
    keys = materialize(_keys(docs))
    rows = keys.count()
    per_shard = max(1, math.ceil(rows / (shards * rows_per_part)))
    splitters = Splitters(keys, shards * per_shard, tolerance)
    below = [0, *[n for _, _, n in splitters.bounds]]
    offsets = [below[p] - below[p - p % per_shard] for p in range(shards * per_shard)]
    if keep:
        source = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "text")
    else:
        source = docs.select("doc_id", "text", text_size().alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    placed = splitters.place(source).drop("text")
    number = F.row_number().over(Window.partitionBy("__part").orderBy("__h", "__d", "doc_id"))
    offset = F.element_at(F.lit(offsets), F.col("__part") + 1) if len(offsets) > 1 else F.lit(offsets[0])
    names = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")] if keep else ["doc_id", "size", "text_crc32"]
    return placed.select(
        *names,
        F.expr(f"cast(__part div {per_shard} as int)").alias("shard"),
        (number - 1 + offset).cast("long").alias("slot"),
    )
