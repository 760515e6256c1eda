"""Remove repeated passages: FM-indexes over shards of the text, matching statistics by backward search.

Every window of ``width`` words is routed by the smallest hash of its ``GRAM``-word grams, a function of the window's words
alone, so equal windows meet in one shard wherever they stand. A document becomes segments: runs of windows with the same
smallest hash (a periodic text is one long segment). A smallest hash that occurs at one place only has no second window, so
such segments go no further. Of the others, each shard

* numbers its words, joins its different segments into one text, sorts the suffixes to a fixed depth, and keeps the
  Burrows-Wheeler transform as a wavelet matrix (packed bits with a count for each 64);
* streams its segments through backward search, all in step: a window is searched from its last word to its first; where
  the interval falls under two occurrences, every window over the failed stretch is passed by. This yields the maximal
  intervals of at least ``width`` words that occur twice or more.

A hash with more words than a block holds has its equal segments counted first: one of each goes on, with the count, and its
spans are joined back to all places. What is still more than a block is cut into blocks of different segments, and each pair of
blocks is a group of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.neardup import _blocked, _mix
from tierflow.session import materialize

GRAM = 8
# Words by which suffixes are ordered, beyond the width of a window, at least.
BEYOND = 29
SHARD_WORDS = 1_500_000
# Bytes of the texts that are cut into segments together.
PIECE = 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_IN_WORD = np.array([c != 32 and not 9 <= c <= 13 for c in range(256)])
# Masks of the bits below a place in a word of 64.
_BELOW = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class WordHashes:
    """64-bit hashes of all words of a text, from sums over its bytes: each times an odd number to the power of its place."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.power):
            self.power, self.inverse = (np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)]) for x in (_ODD, _ODD_INVERSE))

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The first byte, the end byte and the hash of each word; some ``PIECE`` bytes, cut between words, are looked at together."""
        firsts, ends, hashes = [], [], []
        at, whole = 0, np.frombuffer(text, np.uint8)
        while at < len(text):
            cut = _BLANK.search(text, at + PIECE)
            stop = cut.start() if cut else len(text)
            piece = whole[at:stop]
            self._grow(len(piece))
            edges = np.flatnonzero(np.diff(_IN_WORD[piece], prepend=False, append=False))
            first, end = edges[::2], edges[1::2]
            sums = np.r_[np.uint64(0), np.cumsum((piece + np.uint64(1)) * self.power[: len(piece)])]
            firsts.append(first + at)
            ends.append(end + at)
            hashes.append(_mix((sums[end] - sums[first]) * self.inverse[first]))
            at = stop
        if not firsts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.concatenate(firsts), np.concatenate(ends), np.concatenate(hashes)


def _extreme(pick, values: np.ndarray, span: int) -> np.ndarray:
    """The smallest or largest (``pick``) of each ``span`` values, by doubling."""
    have = 1
    while have < span:
        step = min(have, span - have)
        values = pick(values[: len(values) - step], values[step:])
        have += step
    return values


def segments(hashes: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, first word, end word, places of the anchor, words before the text) of each run of windows with one smallest gram hash.

    ``hashes`` are those of texts of ``lengths`` words, one behind the other, each of ``width`` words or more.
    """
    gram = min(GRAM, width)
    n = len(hashes)
    mixed = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        mixed = _mix(mixed * _ODD + hashes[k : k + n - gram + 1])
    span = width - gram + 1
    least = _extreme(np.minimum, mixed, span)
    # Windows that begin in one text and end in the next are none.
    stop = np.cumsum(lengths)
    begin, windows = stop - lengths, lengths - width + 1
    within = np.repeat(np.tile([True, False], len(lengths)), np.stack([windows, np.full(len(lengths), width - 1)], 1).ravel())[: len(least)]
    fresh = np.r_[True, least[1:] != least[:-1]]
    fresh[begin] = True
    starts = np.flatnonzero(fresh & within)
    text = np.searchsorted(begin, starts, side="right") - 1
    ends = np.minimum(np.r_[starts[1:], n], (begin + windows)[text]) + width - 1
    anchors = least[starts]
    # Grams equal to the smallest of the run, inside the run: places in the order of (hash, place), of those that are smallest anywhere.
    edge = np.zeros(span - 1, np.uint64)
    smallest = np.flatnonzero(_extreme(np.maximum, np.concatenate([edge, np.where(within, least, np.uint64(0)), edge]), span) == mixed)
    order = np.argsort(mixed[smallest], kind="stable")
    place = smallest[order]
    ranked = mixed[place]
    number = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]]) * n
    at = number[np.searchsorted(ranked, anchors)]
    places = np.searchsorted(number + place, at + ends - gram, side="right") - np.searchsorted(number + place, at + starts)
    return text, anchors, starts - begin[text], ends - begin[text], places, begin[text]


def _segmented(texts: Iterable[tuple], width: int) -> Iterator[tuple[list, bytes, np.ndarray, np.ndarray, tuple[np.ndarray, ...]]]:
    """Of (beside, text) rows, as many at once as hold ``PIECE`` bytes: what stands beside the texts of ``width`` words or more, all texts
    joined, the first and the end byte of each word of those and ``segments``."""
    hashes = WordHashes()

    def cut(rows):
        joined = b" ".join(text for _, text in rows)
        first, end, hashed = hashes.of(joined)
        begin = np.cumsum([0] + [len(text) + 1 for _, text in rows])
        lengths = np.diff(np.searchsorted(first, begin))
        long = lengths >= width
        if long.any():
            kept = np.repeat(long, lengths)
            yield [rows[k][0] for k in np.flatnonzero(long)], joined, first[kept], end[kept], segments(hashed[kept], lengths[long], width)

    rows, n = [], 0
    for beside, text in texts:
        rows.append((beside, text.as_py() or b""))
        n += len(rows[-1][1])
        if n >= PIECE:
            yield from cut(rows)
            rows, n = [], 0
    if rows:
        yield from cut(rows)


class WaveletMatrix:
    """Rank of any symbol in a sequence: a packed bitmap for each bit of the symbols, with a count for each 64 places."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.n, self.levels = len(sequence), max(1, int(symbols - 1).bit_length())
        self.bits, self.counts, self.zeros = [], [], []
        current = sequence
        for level in reversed(range(self.levels)):
            bit = ((current >> level) & 1).astype(np.uint8)
            padded = np.zeros((self.n // 64 + 1) * 64, np.uint8)
            padded[: self.n] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]].astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            ones = bit.astype(bool)
            current = np.concatenate([current[~ones], current[ones]])

        # Where the places of each symbol begin in the order that the last bit leaves.
        self.begin = np.zeros(symbols, np.int64)
        self.begin = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for k in range(self.levels):
            block = places >> 6
            rank = self.counts[k][block] + np.bitwise_count(self.bits[k][block] & _BELOW[places & 63])
            places = np.where((symbols >> (self.levels - 1 - k)) & 1, self.zeros[k] + rank, places - rank)
        return places

    def ranks(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before its two places."""
        both = self._descend(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        begin, n = self.begin[symbols], len(symbols)
        return both[:n] - begin, both[n:] - begin


class FMIndex:
    """Backward search over the different segments of a shard, each with the number of places it stands at."""

    def __init__(self, pieces: list[np.ndarray], weights: np.ndarray, symbols: int, width: int):
        """``pieces``: word numbers from 1; ``symbols``: one more than the largest; windows of ``width`` words are searched."""
        self.depth = 1 << (width + BEYOND - 1).bit_length()
        lengths = np.array([len(p) for p in pieces])
        self.first = np.r_[0, np.cumsum(lengths + 1)[:-1]]
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        for at, piece in zip(self.first, pieces):
            text[at : at + len(piece)] = piece
        order = self._suffixes(text)
        self.before = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]
        self.matrix = WaveletMatrix(text[order - 1], symbols)  # order 0 takes the last separator
        owner = np.repeat(np.arange(len(pieces)), lengths + 1)
        self.weight = np.r_[0, np.cumsum(weights[owner[order]])]
        self.text = text

    def _suffixes(self, text: np.ndarray) -> np.ndarray:
        """Suffixes in the order of their first ``depth`` words, by prefix doubling; suffixes equal so far in any order."""
        n, rank, depth = len(text), text, 1
        order = np.argsort(rank)
        while depth < self.depth:
            after = np.zeros(n, np.int64)
            after[: n - depth] = rank[depth:] + 1
            key = rank * (n + 2) + after
            order = np.argsort(key)
            sorted_key = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
            rank, depth = new, 2 * depth
            if rank[order[-1]] == n - 1:
                break
        return order

    def extend(self, places: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One backward step to the word at each of ``places``: the new intervals, and which hold two occurrences."""
        symbol = self.text[places]
        low, high = self.matrix.ranks(symbol, low, high)
        low, high = low + self.before[symbol], high + self.before[symbol]
        return low, high, self.weight[high] - self.weight[low] >= 2


def repeated_intervals(index: FMIndex, pieces: np.ndarray, lengths: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(piece, first, end) intervals whose windows all occur twice or more, covering every such window.

    All pieces go one backward step at a time. A piece looks at the window from ``s`` (``g`` = 0) and goes on behind the place
    where it fails; after a success it looks ``g`` words further to the right, and at half of that where this fails.
    """
    out: list[tuple[int, int, int]] = []
    stretch = index.depth - 2 - width
    whole = len(index.text)
    piece, length, base = pieces, lengths, index.first[pieces]
    s, g = np.zeros(len(piece), np.int64), np.zeros(len(piece), np.int64)
    end = s + width
    at, stop = end.copy(), s.copy()
    low, high = np.zeros(len(piece), np.int64), np.full(len(piece), whole, np.int64)
    while len(piece):
        new_low, new_high, fits = index.extend(base + at - 1, low, high)
        low, high, at = np.where(fits, new_low, low), np.where(fits, new_high, high), at - fits
        over = np.flatnonzero(~fits | (at <= stop))
        if not len(over):
            continue
        reached, first, last, wide = at[over] <= stop[over], at[over], end[over], g[over]
        found = over[last - first >= width]
        out += zip(piece[found].tolist(), at[found].tolist(), end[found].tolist())
        single = wide == 0
        # The window itself: behind the failure, or to the right of it as far as one search reaches.
        room = np.minimum(stretch, length[over] - s[over] - width)
        new_g = np.where(single, np.where(reached, room, 0), np.where(reached, 0, wide // 2))
        onward = np.where(single, np.where(reached, s[over] + 1, first), np.where(reached, last - width + 1, s[over] + 1))
        s[over] = np.where(new_g > 0, s[over], onward)
        g[over] = new_g
        end[over] = s[over] + width + new_g
        stop[over] = s[over] + (new_g > 0)
        at[over], low[over], high[over] = end[over], 0, whole
        live = s + width <= length
        if not live.all():
            piece, length, base, s, g, end, at, stop, low, high = (x[live] for x in (piece, length, base, s, g, end, at, stop, low, high))
    return out


def search_shard(rows: list[tuple[bytes, int, bytes, int]], width: int) -> list[tuple[bytes, int, int]]:
    """``rows``: (document, first word, words joined by blanks, places) of one shard; gives (document, first, end) to remove."""
    owners: dict[bytes, set[tuple[bytes, int]]] = {}
    weights: dict[bytes, int] = {}
    for doc, first, content, places in rows:
        owners.setdefault(content, set()).add((doc, first))
        weights[content] = weights.get(content, 0) + places
    contents = list(owners)
    numbers: dict[bytes, int] = {}
    pieces = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in c.split(b" ")], np.int64) for c in contents]
    counts = np.array([weights[c] for c in contents], np.int64)
    out = []
    for k in np.flatnonzero(counts >= 2):
        out += [(doc, first, first + len(pieces[k])) for doc, first in owners[contents[k]]]
    once = np.flatnonzero(counts == 1)
    if len(once):
        index = FMIndex(pieces, counts, len(numbers) + 1, width)
        lengths = np.array([len(pieces[k]) for k in once], np.int64)
        for k, first, end in repeated_intervals(index, once, lengths, width):
            out += [(doc, at + first, at + end) for doc, at in owners[contents[k]]]
    return out


def _anchors(docs: DataFrame, width: int) -> DataFrame:
    """(key, number, anchor, places, words) of every segment of every text."""

    def cut(batches):
        rows = (row for batch in batches for row in zip(batch.column("key").to_pylist(), batch.column("text")))
        for keys, _, _, _, (text, anchors, starts, ends, places, _) in _segmented(rows, width):
            runs = np.bincount(text, minlength=len(keys))
            number = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
            columns = [np.array(keys, np.int64)[text], number.astype(np.int32), anchors.view(np.int64), places.astype(np.int32), (ends - starts).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "number", "anchor", "places", "words"])

    return docs.select("key", F.encode("text", "UTF-8").alias("text")).mapInArrow(cut, "key long, number int, anchor long, places int, words int")


def _emit(flagged: DataFrame, width: int) -> DataFrame:
    """The flagged segments with their words: (anchor, doc, first, words, content)."""

    def cut(batches):
        rows = (((doc, numbers), text) for batch in batches for doc, text, numbers in zip(batch.column("doc").to_pylist(), batch.column("text"), batch.column("numbers").to_pylist()))
        for beside, joined, byte, stop, (text, anchors, starts, ends, _, before) in _segmented(rows, width):
            runs = np.bincount(text, minlength=len(beside))
            chosen = np.concatenate([[k + at for k in numbers if k < most] for (_, numbers), at, most in zip(beside, (np.cumsum(runs) - runs).tolist(), runs.tolist())]).astype(np.int64)
            if not len(chosen):
                continue
            owner, first, end, before = text[chosen], starts[chosen], ends[chosen], before[chosen]
            content = [b" ".join(joined[f:e].split()) for f, e in zip(byte[before + first].tolist(), stop[before + end - 1].tolist())]
            columns = [pa.array(anchors.view(np.int64)[chosen]), pa.array([beside[k][0] for k in owner.tolist()], pa.binary()), pa.array(first.astype(np.int32))]
            columns += [pa.array((end - first).astype(np.int32)), pa.array(content, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "doc", "first", "words", "content"])

    return flagged.mapInArrow(cut, "anchor long, doc binary, first int, words int, content binary")


def _search(cut: DataFrame, width: int) -> DataFrame:
    """(doc, first, end) to remove, from the shards that the partitions of ``cut`` are."""

    def search(batches):
        # A pair of blocks has rows that other pairs repeat, so it is searched by itself; all else makes one shard.
        groups: dict[tuple, list] = {}
        for b in batches:
            for anchor, pair, *row in zip(*[b.column(k).to_pylist() for k in ("anchor", "pair", "doc", "first", "content", "places")]):
                groups.setdefault((anchor, pair) if pair else (), []).append(row)
        found = [x for rows in groups.values() for x in search_shard(rows, width)]
        for at in range(0, len(found), 50_000):
            d, f, e = zip(*found[at : at + 50_000])
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array(f, pa.int32()), pa.array(e, pa.int32())], ["doc", "first", "end"])

    return cut.select("anchor", "pair", "doc", "first", "content", "places").mapInArrow(search, "doc binary, first int, end int")


def different_pieces(rows: DataFrame, shard_words: int) -> DataFrame:
    """The different segments of ``rows`` (``doc``: a segment's MD5) with their places, once for each pair of blocks."""
    pieces = rows.groupBy("anchor", "content").agg(F.count("*").alias("places"), F.max("words").alias("words"))
    pieces = materialize(pieces.withColumn("doc", F.unhex(F.md5("content"))).withColumn("first", F.lit(0)))
    blocks = pieces.groupBy("anchor").agg(F.ceil(F.sum("words") / shard_words).alias("blocks"))
    return _blocked(pieces.join(blocks, "anchor"), "blocks", "content")


def _search_hot(rows: DataFrame, width: int, shard_words: int) -> DataFrame:
    """As ``_search``, for segments of hashes with more words than a shard holds."""
    rows = materialize(rows)
    pieces = different_pieces(rows, shard_words)
    shards = max(1, -(-pieces.agg(F.sum("words")).first()[0] // shard_words))
    found = _search(pieces.repartition(shards, "anchor", "pair"), width).distinct()
    found = found.groupBy(F.col("doc").alias("piece")).agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    owners = rows.select(F.unhex(F.md5("content")).alias("piece"), "doc", "first").distinct()
    placed = owners.join(found, "piece").select("doc", F.col("first").alias("at"), F.explode("spans").alias("span"))
    return placed.select("doc", (F.col("at") + F.col("span.first")).alias("first"), (F.col("at") + F.col("span.end")).alias("end"))


def repeated_passages(docs: DataFrame, width: int = 35, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc, spans): for each different text (``doc``: its MD5) the word ranges [first, end) that repeated windows cover."""
    texts = docs.filter("text is not null").select(F.xxhash64("text").alias("key"), F.unhex(F.md5(F.encode("text", "UTF-8"))).alias("doc"), "text")
    anchors = materialize(_anchors(texts.select("key", "text"), width))
    counts = anchors.groupBy("anchor").agg(F.sum("places").alias("places"), F.sum("words").alias("words")).filter("places > 1")
    counts = materialize(counts.select("anchor", "words"))
    hot = counts.filter(F.col("words") > shard_words)
    others = counts.filter(F.col("words") <= shard_words)
    shards = max(1, -(-(others.agg(F.sum("words")).first()[0] or 0) // shard_words))

    def cut(chosen):
        numbers = anchors.join(chosen.select("anchor"), "anchor").select("key", "number").distinct().groupBy("key").agg(F.collect_list("number").alias("numbers"))
        return _emit(texts.join(numbers, "key").select("doc", F.encode("text", "UTF-8").alias("text"), "numbers"), width)

    rows = cut(others).select("anchor", "doc", "first", "content").repartition(shards, "anchor")
    found = _search(rows.withColumn("pair", F.lit(0)).withColumn("places", F.lit(1)), width)
    if not hot.isEmpty():
        found = found.unionByName(_search_hot(cut(hot), width, shard_words))
    return found.distinct().groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"))


def remove_repeats(docs: DataFrame, width: int = 35, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_words (the remaining words joined by one blank) of every document.

    A word goes if some window of ``width`` words over it has a word sequence that starts anywhere else, in the same
    document too; rows with equal texts are different places. All windows are judged on the input. A text with fewer words
    than ``width`` loses nothing; a NULL text has no words. Ids are not used, so they may be NULL or repeated.
    """
    spans = repeated_passages(docs, width, shard_words)
    keyed = docs.select("doc_id", F.encode("text", "UTF-8").alias("text")).withColumn("doc", F.unhex(F.md5("text")))
    joined = keyed.join(spans, "doc", "left").select("doc_id", "text", "spans")

    def drop(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
                words = (text.as_py() or b"").split()
                n, kept, last = len(words), [], 0
                for span in spans or ():
                    if span["first"] > last:
                        kept += words[last : span["first"]]
                    last = max(last, span["end"])
                kept += words[last:]
                out.append((n, n - len(kept), b" ".join(kept)))
            n, removed, kept = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"]
            )

    kind = docs.select("doc_id").schema["doc_id"].dataType.simpleString()
    out = joined.mapInArrow(drop, f"doc_id {kind}, n_words long, n_removed long, kept binary")
    return out.select("doc_id", "n_words", "n_removed", F.decode("kept", "UTF-8").alias("kept_words"))
