"""Find the runs (maximal periodic stretches) of every text by block convolution.

A run is a stretch of words with smallest period q, at least ``least`` words and 2q long, that neither neighbour extends. The
words i with word i = word i + q then form a region of at least q words, which holds a whole aligned block of ``b`` words
whenever q >= 2b - 1. So at each dyadic scale b, periods of [2b, 4b) are those of the aligned blocks of b words:

* a block that holds a word without a further occurrence within 4b words has no occurrence in its window and is passed by;
* for the others, the sum of squared differences to each place of the following window, sum(x^2) + sum(y^2) - 2 sum(xy), is
  computed by number-theoretic transforms modulo as many primes as make the sum exact; zeros are the block's occurrences;
* blocks in a row with one distance are a chain; as the next block on either side does not occur at that distance, a chain
  is extended by direct comparison over less than one block on each side, and its length decides.

A run of period p is found at its multiples as well: where the block lies in a known run whose period divides the distance the
occurrence is dropped at once, and equal stretches are reduced to their smallest period at the end.

Texts are taken in groups of about ``GROUP_WORDS`` words with a word of its own between them, so short texts share the
transforms. A task holds one group, or one text if that is longer; nothing is shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP_WORDS = 1 << 16
# Elements of a batch of transforms, and of a batch of comparisons.
BATCH = 1 << 18
# Primes with a large power of two below them, and a generator of each.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
LARGEST = 1 << 25  # transform length that all three primes allow

RUN = "struct<start: long, length: long, period: long>"


class Transform:
    """Number-theoretic transforms of length ``size`` of the columns of a matrix."""

    def __init__(self, size: int, prime: int, generator: int):
        self.size, self.prime = size, np.uint64(prime)
        self.forth, self.back = [], []
        half = size // 2
        while half:
            root = pow(generator, (prime - 1) // (2 * half), prime)
            self.forth.append(self._powers(root, half, prime))
            self.back.append(self._powers(pow(root, -1, prime), half, prime))
            half //= 2
        self.scale = np.uint64(pow(size, -1, prime))

    @staticmethod
    def _powers(root: int, n: int, prime: int) -> np.ndarray:
        powers = np.ones(1, np.uint64)
        while len(powers) < n:
            powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), prime)) % np.uint64(prime)])
        return powers[:n].reshape(1, n, 1)

    def _below(self, a: np.ndarray) -> np.ndarray:
        # Where a is under the prime the difference wraps around and is the larger one.
        return np.minimum(a, a - self.prime)

    def apply(self, a: np.ndarray) -> np.ndarray:
        """``a``: (size, columns), values under the prime. The result stands in bit-reversed order."""
        for powers in self.forth:
            half = powers.shape[1]
            v = a.reshape(-1, 2, half, a.shape[1])
            x, y = v[:, 0], v[:, 1]
            a = np.stack([self._below(x + y), (x + self.prime - y) * powers % self.prime], axis=1).reshape(a.shape)
        return a

    def invert(self, a: np.ndarray) -> np.ndarray:
        """From bit-reversed order back."""
        for powers in reversed(self.back):
            half = powers.shape[1]
            v = a.reshape(-1, 2, half, a.shape[1])
            x, y = v[:, 0], v[:, 1] * powers % self.prime
            a = np.stack([self._below(x + y), self._below(x + self.prime - y)], axis=1).reshape(a.shape)
        return a * self.scale % self.prime


def _transforms(size: int, values: int, known: dict) -> list[Transform]:
    """Transforms modulo primes whose product is more than any sum of squared differences of ``values`` numbers."""
    if size > LARGEST:
        raise ValueError(f"a text of more than {2 * LARGEST} words")
    chosen, product = [], 1
    for prime, generator in PRIMES:
        if product > size * values * values:
            break
        key = size, prime
        if key not in known:
            known[key] = Transform(size, prime, generator)
        chosen.append(known[key])
        product *= prime
    return chosen


def _occurrences(text: np.ndarray, starts: np.ndarray, b: int, nearest: int, known: dict) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of each zero of the squared differences, for distances from ``nearest`` to under 4b."""
    size = 4 * b
    distances = size - nearest
    values = int(text.max()) + 1
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = max(1, BATCH // size)
    for at in range(0, len(starts), step):
        here = starts[at : at + step]
        block = text[here + np.arange(b)[:, None]].astype(np.uint64)
        window = text[here + nearest + np.arange(b + distances - 1)[:, None]].astype(np.uint64)
        zero = None
        for transform in _transforms(size, values, known):
            prime = transform.prime
            p, w = block % prime, window % prime
            forth, back = np.zeros((2, size, len(here)), np.uint64)
            forth[: len(w)], back[:b] = w, p[::-1]
            product = transform.apply(forth) * transform.apply(back) % prime
            cross = transform.invert(product)[b - 1 : b - 1 + distances]
            sums = np.concatenate([np.zeros((1, len(here)), np.uint64), np.cumsum(w * w % prime, axis=0)])
            squares = (p * p % prime).sum(axis=0) + sums[b:] - sums[:-b]
            equal = squares % prime == cross * np.uint64(2) % prime
            zero = equal if zero is None else zero & equal
            if not zero.any():
                break
        distance, column = np.nonzero(zero)
        found.append((here[column], distance + nearest))
    return tuple(np.concatenate(c) for c in zip(*found))


def _reach(text: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int, most: int) -> np.ndarray:
    """How many words from ``at`` on, walking by ``step``, equal those ``distance`` later; ``most`` at most."""
    reached = np.zeros(len(at), np.int64)
    active, done, width, last = np.arange(len(at)), 0, 8, len(text) - 1
    while len(active) and done < most:
        width = min(width, most - done)
        walk = step * (done + np.arange(width))
        on = []
        for cut in range(0, len(active), max(1, BATCH // width)):
            rows = active[cut : cut + max(1, BATCH // width)]
            places = np.clip(at[rows, None] + walk, 0, last)
            equal = text[places] == text[np.minimum(places + distance[rows, None], last)]
            whole = equal.all(axis=1)
            reached[rows] = done + np.where(whole, width, equal.argmin(axis=1))
            on.append(rows[whole])
        active, done, width = np.concatenate(on), done + width, 2 * width
    return reached


def _chains(start: np.ndarray, distance: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first block, last block, distance) of blocks in a row with one distance."""
    order = np.lexsort((start, distance))
    start, distance = start[order], distance[order]
    new = np.r_[True, (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + b)]
    return start[new], start[np.r_[new[1:], True]], distance[new]


def runs_of_group(text: np.ndarray, sizes: np.ndarray, least: int = 12, known: dict | None = None) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period, of texts laid one after another.

    ``text`` holds numbers from 1; before the first text, between texts and after the last stands a number that occurs
    nowhere else. ``sizes``: words of each text. Places count from the beginning of ``text``.
    """
    if least < 6:
        raise ValueError("runs of under six words are not looked for")
    known = {} if known is None else known
    n, longest = len(text), int(sizes.max(initial=0))
    if longest < least:
        return np.zeros((0, 3), np.int64)
    text = text.astype(np.int64)
    # How far the next occurrence of the same word in the same text is; how many words the text has.
    owner = np.repeat(np.arange(len(sizes) + 1), np.r_[1, sizes + 1])
    order = np.argsort(text, kind="stable")
    gap = np.full(n, 4 * n + 4, np.int64)
    same = (text[order[1:]] == text[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    gap[np.repeat(np.r_[0, sizes], np.r_[1, sizes + 1]) < least] = 4 * n + 4
    room = np.r_[0, sizes][owner]
    found: list[np.ndarray] = []
    b = 2
    widest = np.maximum(gap[: n // 2 * 2 : 2], gap[1::2][: n // 2])
    padded = np.r_[text, np.zeros(4 * longest + 8, np.int64)]
    while b == 2 or 4 * b <= longest:
        starts = np.flatnonzero(widest < 4 * b) * b
        starts = starts[room[starts] >= (least if b == 2 else 4 * b)]
        if len(starts):
            start, distance = _occurrences(padded, starts, b, 1 if b == 2 else 2 * b, known)
            start, distance = _uncovered(start, distance, b, len(widest), found)
            if len(start):
                first, last, distance = _chains(start, distance, b)
                begin = first - _reach(padded, first - 1, distance, -1, b)
                end = last + b + _reach(padded, last + b, distance, 1, b) + distance
                length = end - begin
                good = (length >= 2 * distance) & (length >= least)
                found.append(np.stack([begin, length, distance], axis=1)[good])
        b *= 2
        pairs = len(widest) // 2
        widest = np.maximum(widest[: 2 * pairs : 2], widest[1 : 2 * pairs : 2])
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _uncovered(start: np.ndarray, distance: np.ndarray, b: int, blocks: int, found: list) -> tuple[np.ndarray, np.ndarray]:
    """Leave out occurrences inside a known run whose period divides the distance.

    At most one run of a period up to half a block covers a block. A run's own smallest period is never left out: if such a
    pair lay in a run of a period that divides it, the whole run would have that period.
    """
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    runs = runs[(runs[:, 2] <= b // 2) & (runs[:, 1] >= b)]
    if not len(runs):
        return start, distance
    period, until = np.ones(blocks, np.int64), np.zeros(blocks, np.int64)
    for begin, length, p in runs[np.argsort(-runs[:, 2])].tolist():
        one, past = -(-begin // b), (begin + length) // b
        period[one:past], until[one:past] = p, begin + length
    block = start // b
    free = (distance % period[block] != 0) | (start + distance + b > until[block])
    return start[free], distance[free]


def _grouped(texts, most: int):
    """Lists of (row, words), each of about ``most`` words."""
    group, total = [], 0
    for row, text in enumerate(texts):
        words = (text.as_py() or b"").split()
        group.append((row, words))
        total += len(words)
        if total >= most:
            yield group
            group, total = [], 0
    if group:
        yield group


def _numbered(group) -> tuple[np.ndarray, np.ndarray]:
    """The words of a group as numbers, with a number of its own between texts, and the words of each text."""
    numbers: dict[bytes, int] = defaultdict(count(1).__next__)
    sizes = np.array([len(words) for _, words in group], np.int64)
    flat = np.fromiter((numbers[w] for _, words in group for w in words), np.int64, int(sizes.sum()))
    between = np.r_[0, np.cumsum(sizes)]
    separators = len(numbers) + 1 + np.arange(len(between))
    return np.insert(flat, between, separators), sizes


def collapse_runs(docs: DataFrame, least: int = 12, group_words: int = GROUP_WORDS) -> DataFrame:
    """doc_id, n_words, runs and kept_words of every document.

    ``runs``: start, length and period, in words counted from 0, by start and period. ``kept_words``: the words outside
    any run's repetitions (a run keeps its first period), joined by one blank. Words lie between blanks, tabs, line and page
    breaks. A NULL or empty text has no words, no run and empty ``kept_words``. Ids are not used, so they may be NULL or
    repeated, and each row of equal rows gets the same answer. Other columns are not looked at. An empty table gives no rows.
    """
    if least < 6:
        raise ValueError("runs of under six words are not looked for")

    def find(batches):
        known: dict = {}
        for batch in batches:
            sizes, per_row, runs, kept = [], [], [], []
            for group in _grouped(batch.column("text"), group_words):
                text, words = _numbered(group)
                all_runs = runs_of_group(text, words, least, known)
                begins = np.r_[0, np.cumsum(words + 1)[:-1]] + 1
                bounds = np.searchsorted(all_runs[:, 0], np.r_[begins, len(text)])
                for (_, listed), begin, low, high in zip(group, begins.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = all_runs[low:high] - np.array([begin, 0, 0])
                    sizes.append(len(listed))
                    per_row.append(high - low)
                    runs.append(own)
                    kept.append(b" ".join(_without(listed, own) if high > low else listed))
            rows = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            parts = [pa.array(rows[:, k]) for k in range(3)]
            listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(per_row)], pa.int32()), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), listed, pa.array(kept, pa.binary())], ["doc_id", "n_words", "runs", "kept"]
            )

    source = docs.select("doc_id", F.encode("text", "UTF-8").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    out = source.mapInArrow(find, f"doc_id {kind}, n_words long, runs array<{RUN}>, kept binary")
    return out.select("doc_id", "n_words", "runs", F.decode("kept", "UTF-8").alias("kept_words"))


def _without(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
