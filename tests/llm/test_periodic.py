"""Periodic runs against brute force, and edge cases."""

import random

import pytest

from tierflow.llm.pattern_queries import repeat_endings
from tierflow.llm.periodic import LARGEST, PRIMES, Transform, _numbered, _occurrences, collapse_runs, runs_of_group


def brute(words, least=12):
    found = {}
    for d in range(1, len(words) // 2 + 1):
        i = 0
        while i + d < len(words):
            start = i
            while i + d < len(words) and words[i] == words[i + d]:
                i += 1
            if i - start + d >= max(least, 2 * d):
                found.setdefault((start, i - start + d), d)
            i += 1
    return sorted(((s, n, d) for (s, n), d in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words):
    gone = {i for s, n, d in brute(words) for i in range(s + d, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def words_of(draw, n):
    letters = draw.choice([1, 2, 2, 3, 5, 50])
    words = [f"w{draw.randrange(letters)}" for _ in range(n)]
    if n > 12 and draw.random() < 0.5:
        a = draw.randrange(n)
        p = 1 + (n - a) // draw.randint(2, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_groups_of_texts_match_brute_force():
    draw = random.Random(5)
    for _ in range(300):
        texts = [words_of(draw, draw.choice([0, 3, 11, 12, 13, 30, 90, 200])) for _ in range(draw.randint(1, 5))]
        text, sizes = _numbered([(k, [w.encode() for w in t]) for k, t in enumerate(texts)])
        want, begin = [], 1
        for t in texts:
            want += [(s + begin, n, d) for s, n, d in brute(t)]
            begin += len(t) + 1
        assert [tuple(r) for r in runs_of_group(text, sizes).tolist()] == want


def test_transform_is_a_cyclic_convolution_and_its_roots_are_right():
    import numpy as np

    draw = np.random.default_rng(3)
    for prime, generator in PRIMES:
        assert (prime - 1) % LARGEST == 0 and pow(generator, (prime - 1) // 2, prime) == prime - 1
        transform = Transform(16, prime, generator)
        a, b = draw.integers(0, prime, (2, 16, 3), dtype=np.uint64)
        got = transform.invert(transform.apply(a) * transform.apply(b) % np.uint64(prime))
        for c in range(3):
            for t in range(16):
                assert int(got[t, c]) == sum(int(a[k, c]) * int(b[(t - k) % 16, c]) for k in range(16)) % prime


def test_sums_beyond_one_prime_stay_exact():
    import numpy as np

    # 2013265921 divides the difference of these two numbers' squares' sum only for the first prime.
    text = np.zeros(64, np.int64)
    text[:2], text[4:6] = (1, 1), (1 + PRIMES[0][0], 1)
    start, distance = _occurrences(text, np.array([0]), 2, 1, {})
    assert not len(start)
    text[8:10] = (1, 1)
    text[4:6] = (1, 1)
    start, distance = _occurrences(text, np.array([0]), 2, 1, {})
    assert distance.tolist() == [4]


def test_degenerate_texts_end_soon():
    for words in ([b"x"] * 40_000, [b"a" if i % 1001 else b"b" for i in range(40_000)], [str(i % 9001).encode() for i in range(40_000)]):
        text, sizes = _numbered([(0, words)])
        got = runs_of_group(text, sizes).tolist()
        p = {2: 1001, 1: 1}.get(len(set(words)), 9001)
        assert [1, 40_000, p] in got
        assert len(got) == (1 if p != 1001 else 1 + 40)


@pytest.mark.parametrize("group_words", [1, 300, 1 << 16])
def test_edges(spark, group_words):
    draw = random.Random(9)
    rows = [(None, None), (1, ""), (2, " \t\n "), (3, "one"), (4, " ".join(["again"] * 12)), (4, " ".join(["again"] * 11)), (None, "a b " * 6), (5, "é ß 漢字 🙂 " * 5)]
    rows += [(k, "\n ".join(words_of(draw, 120))) for k in range(10, 30)] + [(99, " ".join(words_of(draw, 120) * 300))]
    rows += rows[-5:-1]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, runs int, kept string, n_words int").repartition(3)
    got = sorted(((r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["kept_words"]) for r in collapse_runs(df, group_words=group_words).collect()), key=str)
    want = []
    for doc_id, text in rows:
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
        if doc_id != 99:
            want.append((doc_id, len(words), tuple(brute(words)), collapsed(words)))
    assert [r for r in got if r[0] != 99] == sorted(want, key=str)
    long = next(r for r in got if r[0] == 99)
    assert long[1] == 36_000 and (0, 36_000, 120) in long[2]
    assert collapse_runs(df.filter("false")).count() == 0


def test_endings_repeat(spark):
    import zlib

    rows = [(k, " ".join(f"w{k}_{i}" for i in range(k % 37))) for k in range(400)] + [(None, "a b"), (7, None), (12, " ")]
    got = repeat_endings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    changed = 0
    for doc_id, text in rows:
        words = (text or "").split()
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            changed += 1
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert words in [(r["text"] or "").split() for r in got if r["doc_id"] == doc_id]
    assert changed > 10


def test_least_length_is_checked(spark):
    with pytest.raises(ValueError):
        collapse_runs(spark.range(1).selectExpr("id AS doc_id", "'a' AS text"), least=5)
