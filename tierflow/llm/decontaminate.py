"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the test items (``width`` words; a shorter item is one window). For patterns of one length the
searcher keeps a shift table over blocks of two words: how far the search may jump when a block ends at the current word.
Where the shift is 0, the block is the suffix of some patterns; the bucket of that suffix holds them, and only these are
compared with the text, word by word. Words that no item has make a block that no pattern has, so plain text is crossed
in jumps of nearly a whole window.

Items are cut into blocks of about ``block_words`` words in all; each block of patterns goes to every task and the documents
are passed once for each block. A block's tables take some hundred MB in a task; usual test sets are a few blocks.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import ASCII_LOWER
from tierflow.session import materialize

# Lower-case A-Z, blank out every other ASCII byte that is no letter or digit.
_WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in ASCII_LOWER)

BLOCK_WORDS = 300_000

FOUND = T.StructType(
    [
        T.StructField("words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


class Searcher:
    """Wu-Manber tables for the patterns of one length, as tuples of word numbers."""

    def __init__(self, length: int, patterns: dict[tuple[int, ...], list[int]]):
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.jump), length - end)
            self.buckets[pattern[-self.block :]].append((pattern, items))

    def search(self, numbers: list[int], hits: list[tuple[int, int]], found: set[int]) -> None:
        length, back, jump, shift = self.length, self.block - 1, self.jump, self.shift
        end, n = length - 1, len(numbers)
        while end < n:
            block = (numbers[end - 1], numbers[end]) if back else (numbers[end],)
            step = shift.get(block, jump)
            if step:
                end += step
                continue
            start = end - length + 1
            window = tuple(numbers[start : end + 1])
            for pattern, items in self.buckets[block]:
                if pattern == window:
                    hits.append((start, end))
                    found.update(items)
            end += 1


class Patterns:
    """All windows of a block of items, by length, over one vocabulary (0: a word that no item has)."""

    def __init__(self, items: list[tuple[int, bytes]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            length = min(width, len(numbers))
            for start in range(len(numbers) - length + 1 if length else 0):
                owners = by_length[length][tuple(numbers[start : start + length])]
                if item_id not in owners:
                    owners.append(item_id)
        self.searchers = [Searcher(length, patterns) for length, patterns in sorted(by_length.items())]

    def search(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], list[int]]:
        """Number of words, the merged ranges of hit words (first, last), the items found."""
        words = words_of(text)
        number = self.vocabulary.get
        numbers = [number(w, 0) for w in words]
        hits: list[tuple[int, int]] = []
        found: set[int] = set()
        for searcher in self.searchers:
            searcher.search(numbers, hits, found)
        return len(words), merged(hits), sorted(found - {None}) + [None] * (None in found)


def merged(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def _item_blocks(benchmark: DataFrame, block_words: int):
    """Lists of (item_id, text); one list at a time is on the driver. Texts without words are no items."""
    block, words = [], 0
    rows = benchmark.filter("text is not null").select("item_id", F.encode("text", "UTF-8"))
    for item_id, text in rows.toLocalIterator():
        block.append((item_id, bytes(text)))
        words += len(words_of(block[-1][1]))
        if words >= block_words:
            yield block
            block, words = [], 0
    if block:
        yield block


def _scan(docs: DataFrame, block: list[tuple[int, bytes]], width: int, keep: list[str]) -> DataFrame:
    """Search every text of ``docs``; the columns of ``keep`` pass, ``__found`` is added."""
    shared = docs.sparkSession.sparkContext.broadcast((block, width))
    kind = pa.struct([("words", pa.int64()), ("hits", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("items", pa.list_(pa.int64()))])

    def search(batches):
        patterns = Patterns(*shared.value)
        for batch in batches:
            found = []
            for text in batch.column("__text"):
                n, hits, items = patterns.search(text.as_py())
                found.append({"words": n, "hits": [{"first": a, "last": b} for a, b in hits], "items": items})
            columns = [batch.column(c) for c in keep] + [pa.array(found, kind)]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "__found"])

    schema = docs.select([F.col(f"`{c}`") for c in keep]).schema.add("__found", FOUND)
    given = docs.select(*[F.col(f"`{c}`") for c in keep], F.encode("text", "UTF-8").alias("__text"))
    return given.mapInArrow(search, schema)


def find_items(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, ranges of hit words (merged, first and last) and the items with an occurring window.

    NULL and empty texts have no words and no hits; a repeated row is searched as often as it stands there. Without items
    nothing is hit. Items with a NULL id are searched like others and count as one, last in ``items``. Several blocks are
    joined by a row number that a written copy of the ids fixes; one block at a time is on the driver.
    """
    blocks = _item_blocks(benchmark, block_words)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        found = _scan(docs.select("doc_id", "text"), first, width, ["doc_id"])
        return found.select("doc_id", F.col("__found.words").alias("n_words"), F.col("__found.hits").alias("hits"), F.col("__found.items").alias("items"))
    fixed = materialize(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("__row")))
    every = materialize(_scan(fixed, first, width, ["doc_id", "__row"]))
    for block in chain([second], blocks):
        every = every.unionByName(materialize(_scan(fixed, block, width, ["doc_id", "__row"]).filter(F.size("__found.hits") > 0)))
    grouped = every.groupBy("__row").agg(
        F.first("doc_id").alias("doc_id"),
        F.max("__found.words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("__found.hits"))).alias("raw"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("__found.items")))).alias("items"),
    )
    joined = F.aggregate(
        "raw",
        F.expr("cast(array() as array<struct<first: int, last: int>>)"),
        lambda out, r: F.when((F.size(out) > 0) & (r["first"] <= F.element_at(out, -1)["last"] + 1),
            F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(F.element_at(out, -1)["first"].alias("first"), F.greatest(F.element_at(out, -1)["last"], r["last"]).alias("last"))))
        ).otherwise(F.concat(out, F.array(r))),
    )
    return grouped.select("doc_id", "n_words", joined.alias("hits"), "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 10, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any hit, all columns; one pass for each block of items."""
    # The row travels packed, so that none of its columns can clash with those made here.
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    for block in _item_blocks(benchmark, block_words):
        kept = _scan(kept, block, width, ["row", "text"]).filter(F.size("__found.hits") == 0).select("row", "text")
    return kept.select([F.col(f"row.`{c}`") for c in docs.columns])
