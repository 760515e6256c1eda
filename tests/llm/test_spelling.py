"""Spelling variants against brute force, and edge cases."""

import random
import re
import zlib
from collections import Counter

import pytest

from tierflow.llm.spelling import blocked, count_words, follow, keyed, letter_runs, near_pairs, neighbours, spelling_variants

SCHEMA = "doc_id long, text string, word string, n int, key int"


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, edit_every=None):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if edit_every and doc_id is not None and h % edit_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(close[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def vocabulary(draw, letters, size):
    return ["".join(draw.choice(letters) for _ in range(draw.randint(4, 9))) for _ in range(size)]


@pytest.mark.parametrize("seed,letters,edit_every,block", [(1, "ab", None, 4096), (2, "abcé", 7, 4096), (3, "abÿÀc", 3, 20), (4, "ab", None, 9)])
def test_matches_brute_force(spark, seed, letters, edit_every, block):
    draw = random.Random(seed)
    words = vocabulary(draw, letters, 250)
    rows = [(None if k % 11 == 0 else k, " ".join(w.title() if draw.random() < 0.1 else w for w in draw.choices(words, [1 / (1 + i) for i in range(len(words))], k=60))) for k in range(80)]
    rows += rows[:5] + [(500, None), (501, ""), (502, " 漢字abcde漢abcde×١abcde 🙂ABCDE_abcde")]
    got = [tuple(r) for r in spelling_variants(frame(spark, rows), edit_every=edit_every, block=block).collect()]
    assert sorted(got, key=str) == brute(rows, edit_every)


def test_chains_lead_to_their_root(spark):
    text = " ".join(["abcde"] * 3 + ["abcdef"] * 6 + ["abcdefg"] * 12 + ["abcdefgh"] * 24 + ["abcdefghi"] * 48)
    got = {r["word"]: r for r in spelling_variants(frame(spark, [(1, text)])).collect()}
    assert {r["root"] for r in got.values()} == {"abcdefghi"} and got["abcde"]["form"] == "abcdef" and got["abcdefghi"]["form"] is None
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(20)], "word string, form string")
    assert {r["root"] for r in follow(forms).collect()} == {"w20"}


def test_ties_take_the_smallest_form(spark):
    text = " ".join(["aacde"] * 3 + ["abcde"] * 6 + ["accde"] * 6 + ["azcde"] * 5)
    got = {r["word"]: r for r in spelling_variants(frame(spark, [(1, text)])).collect()}
    assert got["aacde"]["form"] == "abcde" and got["aacde"]["n_near"] == 3 and got["azcde"]["form"] is None and got["azcde"]["root"] == "azcde"


def test_a_large_group_in_blocks_loses_no_pair(spark):
    words = [f"prefix{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    want = sorted((v, w) for v in words for w in words if near(v, w))
    for block in (4096, 100, 30):
        assert sorted((r["word"], r["near"]) for r in neighbours(df, block=block, most_rows=97).collect()) == want
    sizes = Counter((r["key"], r["pair"]) for r in blocked(keyed(df, 5), 30).collect())
    assert max(sizes.values()) < 4 * 30


def test_colliding_keys_report_a_pair_once():
    import numpy as np

    words = ["abcdef", "abcdeg", "xxcdef", "xxcdeg", "abcdef", "abcdeg"]
    length, part = np.full(6, 6), np.array([2, 2, 2, 2, 0, 0])
    x, y = near_pairs(words, np.array([0]), np.full(6, 2), length, part)
    assert {(words[a], words[b]) for a, b in zip(x, y)} == {("abcdef", "abcdeg"), ("xxcdef", "xxcdeg")} and len(x) == 2


def test_runs_and_counts(spark):
    assert letter_runs("Ab×cd ÷xÉ ﬀ a1b".encode()) == Counter({"ab×cd".encode(): 1, "÷xÉ".encode(): 1, b"a": 1, b"b": 1})
    rows = [(k, "one two two") for k in range(20)]
    got = {r["word"]: r["n"] for r in count_words(frame(spark, rows), most_counted=1).collect()}
    assert got == {"one": 20, "two": 40}


def test_empty_and_long(spark):
    assert spelling_variants(frame(spark, []).filter("false")).count() == 0
    assert spelling_variants(frame(spark, [(1, None), (None, "a b c")])).count() == 0
    long = "z" * 20_000
    got = spelling_variants(frame(spark, [(1, " ".join([long] * 3 + [long[1:]] * 6))])).collect()
    assert {(len(r["word"]), len(r["root"]), r["n_near"]) for r in got} == {(20_000, 19_999, 1), (19_999, 19_999, 1)}
    with pytest.raises(ValueError):
        spelling_variants(frame(spark, [(1, "a")]), factor=1)
