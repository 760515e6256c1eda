"""Near-duplicates: banded MinHash, odd sketches on the candidates of a bucket, links confirmed on full shingle sets.

1. Every text becomes a set of 64-bit hashes of its word shingles. From the set: its size, a 128-bit digest, the MinHash
   values cut into bands, and an odd sketch - the MinHash samples folded into a bitmap that keeps the parity of what fell on
   a bit. Equal sets are one class; only the smallest id of a class goes on.
2. Classes that share a band are candidates. The XOR of two odd sketches has at most as many bits as the two MinHash samples
   differ in, so its population count bounds (and estimates) the similarity from above: pairs over the limit go. Within a
   bucket a walk compares each class reached with those not yet reached, so the links that leave it are a forest, not pairs.
3. Components of these forests are clusters. The texts of a cluster meet once, and the same kind of walk confirms links on
   the full sets, again leaving a forest; its components are the result. A link is only left untested if its ends are
   already connected by confirmed links, so no component is missed.

Buckets and clusters of any size are cut into blocks; each pair of blocks is one task's work, so no task holds more than
two blocks. MinHash can miss a link: with ``bands`` and ``band_rows(percent)`` at most about 1 in a million at the limit.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierflow.llm.common import ASCII_LOWER
from tierflow.llm.graphs import components
from tierflow.session import materialize

BANDS = 28
SKETCH_BITS = 512
BUCKET_BLOCK = 4096
CLUSTER_BLOCK_DOCS = 1024
CLUSTER_BLOCK_SHINGLES = 2_000_000


def band_rows(percent: int, bands: int = BANDS, miss: float = 1e-6) -> int:
    """The longest band for which a link at the limit is missed with a probability of at most ``miss``."""
    return max(r for r in range(1, 13) if r == 1 or (1 - (percent / 100) ** r) ** bands <= miss)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finisher for 64-bit hashes."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Shingles:
    """Texts to sorted arrays of distinct shingle hashes. Words keep their hash for the life of a task, up to a bound."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def of(self, text: bytes | None) -> np.ndarray:
        words = text.translate(ASCII_LOWER).split() if text else []
        if not words:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        n = len(words) - width + 1
        mixed = np.full(n, width, np.uint64)
        for k in range(width):
            mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n])
        return np.unique(mixed)


def minhashes(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each multiply-add-shift function, in pieces that fit the cache."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 512):
        np.minimum(best, (low[at : at + 512, None] * factors + offsets).min(axis=0), out=best)
    return best


def odd_sketch(samples: np.ndarray, bits: int = SKETCH_BITS) -> bytes:
    """Parity of the number of samples (numbered MinHash values) on each bit."""
    numbered = samples.astype(np.uint64) + (np.arange(len(samples), dtype=np.uint64) << np.uint64(32))
    counts = np.bincount((_mix(numbered) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def sketch_limit(percent: int, samples: int) -> int:
    """Most bits in which the sketches of a link may differ.

    Two samples of k values with m equal ones differ in 2 (k - m) elements, and the XOR has no more bits than that. At the
    limit m is binomial(k, percent / 100); six deviations below its mean is beyond chance.
    """
    j = percent / 100
    least = samples * j - 6 * (samples * j * (1 - j)) ** 0.5
    return int(2 * (samples - max(0.0, least)))


def functions_of(samples: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240607)
    return draw.integers(0, 2**31, samples, np.uint32) * np.uint32(2) + np.uint32(1), draw.integers(0, 2**32, samples, np.uint32)


def features(docs: DataFrame, width: int, percent: int, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, digest, bands and sketch of every document with an id."""
    rows = band_rows(percent, bands)

    def sketch(batches):
        shingles, (factors, offsets) = Shingles(width), functions_of(bands * rows)
        for batch in batches:
            out: list[tuple] = []
            for text in batch.column("text"):
                found = shingles.of(text.as_py())
                if not len(found):
                    out.append((0, None, None, None))
                    continue
                samples = minhashes(found, factors, offsets)
                grouped = samples.reshape(bands, rows)
                keys = np.arange(bands, dtype=np.uint64)
                for k in range(rows):
                    keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + grouped[:, k])
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                out.append((len(found), digest, keys.view(np.int64), odd_sketch(samples)))
            n, digests, keys, sketches = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["doc_id", "n_shingles", "digest", "bands", "sketch"],
            )

    given = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text"))
    return given.mapInArrow(sketch, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary")


def walk(n: int, neighbours) -> list[tuple[int, int]]:
    """A forest of the links among ``n`` members; ``neighbours(i, others)`` picks those of ``others`` linked with ``i``."""
    waiting, forest = np.arange(n), []
    while len(waiting):
        reached, waiting = [waiting[0]], waiting[1:]
        while reached and len(waiting):
            at = reached.pop()
            near = neighbours(at, waiting)
            if near.any():
                linked = waiting[near]
                forest += [(at, other) for other in linked]
                reached += list(linked)
                waiting = waiting[~near]
    return forest


def _groups(batches, keys: list[str]):
    """Consecutive rows with equal keys, across Arrow batches of a sorted partition."""
    rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in b.schema.names]))
    return itertools.groupby(rows, key=lambda r: r[: len(keys)])


def _blocked(df: DataFrame, blocks: str, spread: str) -> DataFrame:
    """Repeat the rows of a group of k > 1 blocks for each pair of blocks it takes part in; adds ``pair``."""
    own = F.when(F.col(blocks) > 1, F.pmod(F.xxhash64(spread), F.col(blocks))).otherwise(F.lit(0)).cast("long")
    others = F.sequence(F.lit(0).cast("long"), F.greatest(F.col(blocks) - 1, F.lit(0)).cast("long"))
    pairs = F.transform(F.filter(others, lambda o: o != own), lambda o: F.least(o, own) * F.col(blocks) + F.greatest(o, own))
    return df.withColumn("pair", F.explode(F.when(F.col(blocks) > 1, pairs).otherwise(F.array(F.lit(0).cast("long")))))


def candidate_links(classes: DataFrame, percent: int, bands: int = BANDS) -> DataFrame:
    """A forest (a, b) of each bucket's pairs whose sketches may belong to a link."""
    limit, most = sketch_limit(percent, bands * band_rows(percent, bands)), percent / 100
    exploded = classes.select("doc_id", "n_shingles", F.explode("bands").alias("key"))
    shared = exploded.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    shared = shared.withColumn("blocks", F.ceil(F.col("members") / BUCKET_BLOCK))
    members = materialize(exploded.join(shared, "key").select("key", "blocks", "doc_id"))
    members = _blocked(members, "blocks", "doc_id").join(classes.select("doc_id", "n_shingles", "sketch"), "doc_id")
    members = members.select("key", "pair", "doc_id", "n_shingles", "sketch").repartition("key", "pair").sortWithinPartitions("key", "pair", "doc_id")

    def link(batches):
        for _, rows in _groups(batches, ["key", "pair"]):
            rows = list(rows)
            ids = np.array([r[2] for r in rows], np.int64)
            sizes = np.array([r[3] for r in rows], np.float64)
            sketches = np.frombuffer(b"".join(r[4] for r in rows), np.uint64).reshape(len(rows), -1)

            def near(i, others):
                a, b = sizes[i], sizes[others]
                alike = np.minimum(a, b) >= most * np.maximum(a, b)
                return alike & (np.bitwise_count(sketches[others] ^ sketches[i]).sum(axis=1) <= limit)

            forest = walk(len(rows), near)
            if forest:
                at = np.array(forest)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[:, 0]]), pa.array(ids[at[:, 1]])], ["a", "b"])

    return members.mapInArrow(link, "a long, b long")


def parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    counts = np.bincount((_mix(shingles) % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.uint64)


def confirmed_links(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """A forest (a, b) of the links of each cluster; ``texts``: cluster, pair, doc_id, n_shingles, text (bytes).

    Before two sets are intersected, their whole sets' parity bitmaps are compared: the XOR never has more bits than the sets
    differ in, so a pair over that number is no link, for certain.
    """

    def confirm(batches):
        shingles = Shingles(width)
        for _, rows in _groups(batches, ["cluster", "pair"]):
            ids, sets = [], []
            for r in rows:
                ids.append(r[2])
                sets.append(shingles.of(r[4]))
            ids, sizes = np.array(ids, np.int64), np.array([len(s) for s in sets], np.int64)
            bits = 1 << int(min(16, max(9, np.ceil(np.log2(4 * max(1, float(np.median(sizes))))))))
            maps = np.stack([parity(s, bits) for s in sets])

            def near(i, others):
                total = sizes[others] + sizes[i]
                # 100 * both >= percent * (total - both), so both >= percent * total / (100 + percent).
                differ = total - 2 * (-(-percent * total // (100 + percent)))
                maybe = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1) <= differ
                for k in np.flatnonzero(maybe):
                    both = len(np.intersect1d(sets[i], sets[others[k]], assume_unique=True))
                    maybe[k] = 100 * both >= percent * (total[k] - both)
                return maybe

            forest = walk(len(sets), near)
            if forest:
                at = np.array(forest)
                yield pa.RecordBatch.from_arrays([pa.array(ids[at[:, 0]]), pa.array(ids[at[:, 1]])], ["a", "b"])

    return texts.mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document.

    Words are runs of non-space characters after lower-casing A-Z; a text of fewer than ``width`` words is one shingle, a NULL
    text or one without words has none and links with nothing (not even with another empty text). ``component_id``
    is the smallest id reachable over links of at least ``percent`` / 100 Jaccard similarity. Rows with a NULL id have no component and
    are kept. Rows that repeat an id count as one document per set (all have that id's component).
    """
    known = materialize(features(docs, width, percent, bands))
    filled = known.filter("n_shingles > 0")
    by_digest = filled.groupBy("digest").agg(F.min("doc_id").alias("first"))
    firsts = by_digest.select(F.col("first").alias("doc_id"), "digest")
    classes = materialize(filled.join(firsts, ["doc_id", "digest"]).dropDuplicates(["digest"]))
    candidates = candidate_links(classes, percent, bands)
    clusters = components(candidates).withColumnsRenamed({"node": "doc_id", "component": "cluster"})
    sized = materialize(clusters.join(classes.select("doc_id", "digest", "n_shingles"), "doc_id"))
    blocks = sized.groupBy("cluster").agg(
        F.ceil(F.greatest(F.count("*") / CLUSTER_BLOCK_DOCS, F.sum("n_shingles") / CLUSTER_BLOCK_SHINGLES)).alias("blocks")
    )
    placed = _blocked(sized.join(blocks, "cluster"), "blocks", "doc_id")
    # The ids grow with the input, so they are never broadcast: one plan at every size.
    texts = placed.select("cluster", "pair", "doc_id", "n_shingles").join(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text")).hint("merge"), "doc_id"
    )
    texts = texts.select("cluster", "pair", "doc_id", "n_shingles", "text").repartition("cluster", "pair").sortWithinPartitions("cluster", "pair", "doc_id")
    links = confirmed_links(texts, width, percent)
    # An id that stands in several rows ties the sets of these rows together.
    owners = filled.select("doc_id", "digest").distinct().join(by_digest, "digest")
    tied = owners.groupBy("doc_id").agg(F.min("first").alias("b"), F.max("first").alias("most")).filter("b < most")
    tied = owners.join(tied.select("doc_id", "b"), "doc_id").select(F.col("first").alias("a"), "b").filter("a > b")
    groups = components(links.union(tied))
    ids = known.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left").drop("digest")
    ids = ids.join(groups, ids["first"] == groups["node"], "left")
    component = F.coalesce("component", "first", "doc_id")
    out = ids.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))
    nameless = docs.filter("doc_id is null").select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")
    )
    return out.unionByName(nameless)


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component (its smallest id) and every document without links, all columns.

    Documents with a NULL id and those without words stay. Of rows that agree in id and text one stays.
    """
    judged = materialize(near_duplicates(docs.select("doc_id", "text"), width, percent))
    # The row travels packed, so that none of its columns can clash with those made here.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), "text")
    names = [F.col(f"row.`{c}`") for c in docs.columns]
    gone = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("gone_id")).distinct()
    left = packed.hint("merge").join(gone, F.col("id") == F.col("gone_id"), "left_anti")
    repeated = judged.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("repeated_id"))
    if repeated.isEmpty():
        return left.select(*names)
    same = F.col("id") == F.col("repeated_id")
    number = F.row_number().over(Window.partitionBy("id", F.md5(F.encode("text", "UTF-8"))).orderBy(F.lit(0)))
    several = left.join(repeated, same, "left_semi").withColumn("number", number)
    once = several.filter((F.col("number") == 1) | F.col("text").isNull()).select(*names)
    return left.join(repeated, same, "left_anti").select(*names).unionByName(once)
