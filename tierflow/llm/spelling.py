"""Spelling variants: words one edit apart, found by dense tiles of code-point matrices.

Two words differ by one inserted, deleted or replaced code point if and only if the lengths of their common prefix and common
suffix reach the longer length minus one. So words are rows of padded code-point matrices, forwards and backwards, and a
tile compares all pairs of two blocks of rows at once.

Only words that share a key are laid into one tile. A word of n code points is cut into parts of about two (at most 16
parts); one edit changes one part only, so both words agree in what lies before some part and what lies behind it. Each word has the keys of its own
length (as the shorter or equal word) and of one length less (as the longer word). A pair is reported under the first key that
fits, so it comes once. Words of usual lengths under one key differ in two or three code points at one place: a group cannot
hold more words than there are such strings, and groups beyond a block are cut into blocks, each pair of blocks being a group of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import ASCII_LOWER
from tierflow.session import materialize

# Words counted in a task before they go on, rows of a block, and rows of a tile on each side.
MOST_COUNTED = 400_000
BLOCK = 4096
TILE = 512
MOST_PARTS = 16

# All bytes but letters and those of longer code points are blanks; of the latter, C3 leads U+00C0 to U+00FF.
_SPLIT = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in ASCII_LOWER)
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_RUN = re.compile("[a-zÀ-ÿ]+")


def letter_runs(text: bytes) -> Counter:
    """The letter runs of a text with their number, A-Z lower-cased."""
    runs = Counter(text.translate(_SPLIT).split())
    for word in [w for w in runs if not w.isascii() and not _PLAIN.fullmatch(w)]:
        n = runs.pop(word)
        for run in _RUN.findall(word.decode("utf-8", "replace")):
            runs[run.encode()] += n
    return runs


def count_words(docs: DataFrame, edit_every: int | None = None, most_counted: int = MOST_COUNTED) -> DataFrame:
    """(word, n): the letter runs of all texts, A-Z lower-cased, with their number.

    With ``edit_every`` a run loses a code point where that number divides the CRC-32 of ``<doc_id>:<run>``: the one at that
    CRC modulo the run's length. Tasks count up to about ``most_counted`` words before they pass them on.
    """

    def count(batches):
        counts: Counter = Counter()

        def passed():
            if counts:
                words = pa.array(list(counts), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])
                counts.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                own = letter_runs(text.as_py() or b"")
                if edit_every and doc_id is not None:
                    start = zlib.crc32(doc_id.encode() + b":")
                    for run in [w for w in own if zlib.crc32(w, start) % edit_every == 0]:
                        word = run.decode()
                        at = zlib.crc32(run, start) % len(word)
                        counts[(word[:at] + word[at + 1 :]).encode()] += own.pop(run)
                counts.update(own)
                if len(counts) >= most_counted:
                    yield from passed()
        yield from passed()

    source = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.encode("text", "UTF-8").alias("text"))
    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _parts(length: int) -> list[tuple[int, int]]:
    """[first, end) of the parts of a word of so many code points."""
    n = min(length // 2, MOST_PARTS)
    cuts = [length * k // n for k in range(n + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def keyed(words: DataFrame, least_length: int) -> DataFrame:
    """(key, word, n, length, part): a row for each key of a word; ``length`` is that of the key's shorter word."""
    lengths = words.withColumn("length", F.explode(F.array(F.length("word"), F.length("word") - 1))).filter(F.col("length") >= least_length)
    n = f"cast(least(length div 2, {MOST_PARTS}) as int)"
    parts = lengths.withColumn("part", F.explode(F.sequence(F.lit(0), F.expr(f"{n} - 1"))))
    first = F.expr(f"cast(length * part div {n} as int)")
    behind = F.expr(f"cast(length - length * (part + 1) div {n} as int)")
    key = F.xxhash64("length", "part", F.substring("word", F.lit(1), first), F.substring("word", F.length("word") - behind + 1, behind))
    return parts.select(key.alias("key"), "word", "n", "length", "part")


def blocked(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The rows with ``pair`` and ``side``: 0 and 2, but for keys with more than ``block`` rows once for each pair of blocks.

    ``side`` is then 0 in the first block of a pair, 1 in the second, and 2 where both are one block.
    """
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1")
    known = rows.join(materialize(blocks), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    several = known.withColumn("mine", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
    meeting = several.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(low == high, 2).when(F.col("mine") == low, 0).otherwise(1)
    return meeting.withColumn("pair", low * F.col("blocks") + high).withColumn("side", side).drop("mine", "other", "blocks")


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of each word forwards and backwards, padded with zeros, and the lengths."""
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    width = int(lengths.max(initial=0))
    forwards = np.zeros((len(words), width), np.uint32)
    filled = np.arange(width) < lengths[:, None]
    forwards[filled] = flat
    backwards = np.zeros_like(forwards)
    turned = lengths[:, None] - 1 - np.arange(width)
    backwards[filled] = np.take_along_axis(forwards, np.maximum(turned, 0), axis=1)[filled]
    return forwards, backwards, lengths


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of rows; the padding of one does not count for the other."""
    same = a == b
    same = np.concatenate([same, np.zeros((*same.shape[:-1], 1), bool)], axis=-1)
    return same.argmin(axis=-1)


def _near(prefix, suffix, one, two) -> np.ndarray:
    """Whether words of lengths ``one`` and ``two`` are one edit apart."""
    longer = np.maximum(one, two)
    return (np.abs(one - two) <= 1) & (np.minimum(prefix, longer) + np.minimum(suffix, longer) >= longer - 1) & ~((one == two) & (prefix >= longer))


def near_pairs(words: list[str], starts: np.ndarray, side: np.ndarray, length: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (indices) of one group whose words are one edit apart; groups begin at ``starts``.

    Words of one length class share a matrix, so a long word does not widen the rows of short ones.
    """
    classes = np.frexp(np.maximum(length, 31))[1]
    group = np.cumsum(np.bincount(starts, minlength=len(words)))
    found = []
    for c in np.unique(classes):
        rows = np.flatnonzero(classes == c)
        own = np.flatnonzero(np.r_[True, group[rows[1:]] != group[rows[:-1]]])
        x, y = _pairs_of_class([words[k] for k in rows.tolist()], own, side[rows], length[rows], part[rows])
        found.append((rows[x], rows[y]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _pairs_of_class(words: list[str], starts: np.ndarray, side: np.ndarray, length: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small groups are compared all at once, each row with the one k further; large ones tile by tile."""
    n = len(words)
    forwards, backwards, lengths = _matrices(words)
    sizes = np.diff(np.r_[starts, n])
    # Code points before and behind each row's part, and behind the part before it.
    table = np.zeros((int(length.max()) + 1, MOST_PARTS, 3), np.int32)
    for m in np.unique(length).tolist():
        parts = _parts(m)
        for k, (first, end) in enumerate(parts):
            table[m, k] = first, m - end, m - parts[k - 1][1] if k else m + 2
    first, behind, earlier = table[length, part].T
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []

    def judge(x: np.ndarray, y: np.ndarray, prefix: np.ndarray, suffix: np.ndarray) -> None:
        one, two = lengths[x], lengths[y]
        # Under the key of the shorter word's length, which both share indeed (a key is a hash), and under no earlier one.
        good = _near(prefix, suffix, one, two) & (np.minimum(one, two) == length[x]) & (length[x] == length[y]) & (part[x] == part[y])
        good &= (prefix >= first[x]) & (suffix >= behind[x]) & (suffix < earlier[x]) & ((side[x] == 2) | (side[x] != side[y]))
        left.append(x[good])
        right.append(y[good])

    small = np.repeat(sizes <= 64, sizes)
    end = np.repeat(starts + sizes, sizes)
    rows = np.flatnonzero(small)
    k = 1
    while len(rows := rows[rows + k < end[rows]]):
        for at in range(0, len(rows), 65_536):
            x = rows[at : at + 65_536]
            judge(x, x + k, _agreeing(forwards[x], forwards[x + k]), _agreeing(backwards[x], backwards[x + k]))
        k += 1
    for start, size in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        for i in range(start, start + size, TILE):
            for j in range(i, start + size, TILE):
                a, b = np.arange(i, min(i + TILE, start + size)), np.arange(j, min(j + TILE, start + size))
                prefix, suffix = _tile(forwards, a, b), _tile(backwards, a, b)
                # Enough in common for the shorter of the two possible lengths; the rest of the test looks at these only.
                x, y = np.nonzero(prefix + suffix >= length[start] - 1)
                upper = a[x] < b[y]
                x, y = x[upper], y[upper]
                judge(a[x], b[y], prefix[x, y], suffix[x, y])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _tile(matrix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common beginnings of all pairs of two blocks of rows, one column of code points at a time."""
    going = np.ones((len(a), len(b)), bool)
    common = np.zeros((len(a), len(b)), np.int16)
    for column in range(matrix.shape[1]):
        going &= matrix[a, column][:, None] == matrix[b, column][None, :]
        if not going.any():
            break
        common += going
    return common


def _groups(batches, most: int):
    """Batches of sorted rows and where their groups begin, cut between groups once there are ``most`` rows.

    A long word counts as a row for each 16 code points.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def weight(batch):
        return batch.num_rows + (pc.sum(pc.utf8_length(batch.column("word"))).as_py() or 0) // 16

    def begins(table):
        key, pair = table.column("key").to_numpy(), table.column("pair").to_numpy()
        return np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (pair[1:] != pair[:-1])])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += weight(batch)
        if rows < most:
            continue
        table = pa.Table.from_batches(held)
        starts = begins(table)
        cut = int(starts[-1])
        if cut:
            yield table.slice(0, cut), starts[:-1]
        held = table.slice(cut).to_batches()
        rows = sum(map(weight, held))
    if held:
        table = pa.Table.from_batches(held)
        yield table, begins(table)


def neighbours(words: DataFrame, least_length: int = 5, block: int = BLOCK, most_rows: int = 50_000) -> DataFrame:
    """(word, near, near_n): each pair of words one edit apart, in both directions, once; ``words``: (word, n)."""

    def compare(batches):
        for table, starts in _groups(batches, most_rows):
            names = table.column("word").combine_chunks()
            n, side, length, part = (table.column(c).to_numpy() for c in ("n", "side", "length", "part"))
            x, y = near_pairs(names.to_pylist(), starts, side, length, part)
            for at in range(0, len(x), 50_000):
                a, b = x[at : at + 50_000], y[at : at + 50_000]
                columns = [names.take(pa.array(np.r_[a, b])), names.take(pa.array(np.r_[b, a])), pa.array(np.r_[n[b], n[a]])]
                yield pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])

    rows = blocked(materialize(keyed(words, least_length)), block)
    dealt = rows.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return dealt.mapInArrow(compare, "word string, near string, near_n long")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root): where following ``form`` from every word of ``forms`` (word, form) ends.

    Each round doubles the steps a row has behind it. As a form is at least twice as frequent as its word, a chain has no more
    steps than the largest count has bits, and a handful of rounds ends it.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(further, "root", "left"))
        if moved.filter("next IS NOT NULL").isEmpty():
            return at
        at = materialize(moved.select("word", F.coalesce("next", "root").alias("root")))


def spelling_variants(
    docs: DataFrame, least_length: int = 5, least_count: int = 3, factor: int = 2, edit_every: int | None = None, block: int = BLOCK
) -> DataFrame:
    """word, form, root, n, n_near and form_n of the corpus's words.

    Words: the different letter runs (A-Z, a-z, U+00C0 to U+00FF; A-Z lower-cased) of at least ``least_length`` code points
    that occur ``least_count`` times or more. ``n_near``: number of words one edit apart. ``form``: the most frequent of
    them (ties: the smallest in code-point order) if it occurs ``factor`` times as often, else NULL. ``root``: where forms
    lead in the end, the word itself without one.

    A NULL or empty text has no words. Ids matter with ``edit_every`` only (see ``count_words``; a NULL id changes nothing);
    repeated rows count again. Other columns are not looked at. An empty table gives no rows.
    """
    if least_length < 4 or factor < 2:
        raise ValueError("words of under four code points and factors under two are not grouped")
    counted = count_words(docs, edit_every).filter((F.length("word") >= least_length) & (F.col("n") >= least_count))
    words = materialize(counted)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = neighbours(words, least_length, block).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    form_n = -F.col("best.less")
    formed = F.coalesce(form_n >= factor * F.col("n"), F.lit(False))
    told = joined.select(
        "word", F.when(formed, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, form_n).alias("form_n")
    )
    told = materialize(told)
    roots = follow(told.filter("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
