"""The pipeline, stage by stage, against a brute-force version in plain Python."""

import hashlib
import math
import re
from collections import Counter
from pathlib import Path

import pytest
from test_edges import brute_components

import corpus_pipeline
from tierflow.llm.quality import ALL_WORDS, COMMON_WORDS, LEAST_CHARS, LEAST_OWN_SHARE, LEAST_WORDS, MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE
from tierflow.session import materialize

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def key60(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def histograms(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    letters, upper, digits = len(re.findall("[a-z]|[^\x00-\x7f]", text)), len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text))
    space, symbols = len(re.findall(r"[\x20\x09-\x0D]", text)), len(re.findall(r"[#*$%&|<>]", text))
    classes = [letters, upper, digits, space, symbols]
    classes.append(len(text) - sum(classes))
    known = Counter(w.lower() for w in words)
    return words, classes, [known[w] for w in ALL_WORDS]


def distance(p, q):
    def part(x, m):
        return x * math.log2(x / m) if x > 0 else 0.0

    return math.sqrt(max(0.0, sum(part(x, (x + y) / 2) + part(y, (x + y) / 2) for x, y in zip(p, q)) / 2))


def shares(classes, words, n):
    return [c / max(1, sum(classes)) for c in classes], [w / max(1, n) for w in words] + [max(0, n - sum(words)) / max(1, n)]


def own_share(words):
    """Share of the words that a text of few listed words repeats as prose does."""
    counts = Counter(w.lower() for w in words if any(c.isalpha() for c in w))
    often = max(3, len(words) // 100)
    few = 3 * sum(w.lower() in ALL_WORDS for w in words) < len(words)
    return sum(n for n in counts.values() if n >= often) / len(words) if few else 0.0


def brute_quality(docs):
    sums = {}
    for d in docs:
        if d["lang"] in COMMON_WORDS:
            words, classes, common = histograms(d["text"] or "")
            c, w, n = sums.setdefault(d["lang"], ([0] * 6, [0] * len(ALL_WORDS), [0]))
            for k, x in enumerate(classes):
                c[k] += x
            for k, x in enumerate(common):
                w[k] += x
            n[0] += len(words)
    known = [shares(c, w, n[0]) for c, w, n in sums.values()]
    out = []
    for d in docs:
        text = d["text"] or ""
        words, classes, common = histograms(text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        if len(words) < 50 or 100 * len(covered) > 50 * len(words):
            continue
        p, q = shares(classes, common, len(words))
        if len(text) >= LEAST_CHARS and min(distance(p, r[0]) for r in known) > MOST_CLASS_DISTANCE:
            continue
        if len(words) >= LEAST_WORDS and own_share(words) < LEAST_OWN_SHARE and min(distance(q, r[1]) for r in known) > MOST_WORD_DISTANCE:
            continue
        out.append(d["doc_id"])
    return out


def brute_clean(docs, items):
    def words(t):
        return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    patterns = set()
    for t in items:
        w = words(t)
        n = min(10, len(w))
        patterns |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    lengths = {len(p) for p in patterns}
    out = []
    for d in docs:
        w = words(d["text"])
        if not any(tuple(w[i : i + n]) in patterns for n in lengths for i in range(len(w) - n + 1)):
            out.append(d["doc_id"])
    return out


def brute_mix(docs):
    size = {d["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", d["text"])) for d in docs}
    total = Counter()
    for d in docs:
        total[d["source"]] += size[d["doc_id"]]
    weight = {s: k % 3 + 1 for k, s in enumerate(sorted(total))}
    target, free, left = {}, set(total), sum(total.values())
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * total[s]}
        if not above:
            target |= share
            break
        for s in above:
            target[s] = 3 * total[s]
            left -= target[s]
        free -= above
    times = {}
    for s in total:
        def key(d):
            symbols = len(re.findall(r"[#*$%&|<>]", d["text"]))
            quality = max(0.05, 1 - symbols / len(d["text"]))
            return -math.log((key60(str(d["doc_id"])) + 0.5) / 2**60) / quality

        before, epochs = 0, int(target[s] // total[s])
        for d in sorted((d for d in docs if d["source"] == s), key=key):
            n = size[d["doc_id"]]
            more = epochs < 3 and 2 * before + n <= 2 * (target[s] - epochs * total[s])
            times[d["doc_id"]] = epochs + more
            before += n
    return Counter({i: n for i, n in times.items() if n})


def brute_shards(docs):
    order = sorted(docs, key=lambda d: (key60(d["text"]), key60(str(d["doc_id"]))))
    sizes = [len(d["text"].encode()) + 1 for d in order]
    out, before, tied = [], 0, None
    for d, n in zip(order, sizes):
        key = (d["text"], d["doc_id"])
        # Equal rows have one key, so they go where the first one goes.
        shard = tied[1] if tied and tied[0] == key else before * 16 // sum(sizes)
        out.append((d["doc_id"], shard))
        tied, before = (key, shard), before + n
    return Counter(out)


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    expected = [
        lambda d: Counter(brute_quality(d)),
        lambda d: Counter(i for i, c in brute_components({x["doc_id"]: x["text"] for x in d}, 5, 80).items() if i == c),
        lambda d: Counter(brute_clean(d, items)),
        brute_mix,
    ]
    for (name, stage), brute in zip(corpus_pipeline.STAGES, expected):
        before = [r.asDict() for r in docs.collect()]
        docs = materialize(stage(spark, docs, SF))
        got = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        assert docs.columns == columns and got == brute(before), name
    before = [r.asDict() for r in docs.collect()]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns == [*columns, "shard", "slot"]
    assert Counter((r["doc_id"], r["shard"]) for r in last.collect()) == brute_shards(before)


def test_empty_documents_pass_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.count() == 0


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns[-2:] == ["shard", "slot"]
