"""NULLs, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierflow.llm.common import learned_from
from tierflow.llm.decontaminate import drop_contaminated, find_items
from tierflow.llm.graphs import components
from tierflow.llm.languages import identify_languages
from tierflow.llm.mixing import mix
from tierflow.llm.neardup import band_rows, drop_near_duplicates, near_duplicates
from tierflow.llm.quality import ALL_WORDS, COMMON_WORDS, keep_good, profile, quality_rules
from tierflow.llm.sharding import Splitters, _keys, shard_documents
from tierflow.llm.substrings import WordHashes, _segmented, different_pieces, remove_repeats, segments
from tierflow.llm.surrogates import distinct_surrogates, replace_personal_data
from tierflow.llm.toxicity import score_toxicity
from tierflow.llm.urls import PATTERN_RULES, PatternRule, RuleIndex, filter_urls
from tierflow.session import materialize

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string, __x int"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(n))


def edge_rows():
    base = prose(1, 200)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, base.replace(" ", "  ", 1), None, None), (4, None, "en", "b"), (None, base, "de", "b"),
        (None, None, None, None), (5, "", "de", "b"), (6, " \t\n ", "fr", ""), (7, "one", "en", "a"), (8, "one", "en", "c"), (9, prose(2, 30_000), "de", "c"),
        (10, "x" * 300_000, "en", "c"), (11, prose(3, 60), "fr", "b"), (12, "é\u00a0ß 漢字 🙂 mail a.b@c.example.org", "fr", "b"), (13, "same " * 500, "en", "a"),
    ]
    return [(*r, len(r[1] or ""), 7, "k", 1) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding_edges(docs, none):
    rows = shard_documents(docs, 4).collect()
    assert len(rows) == 16
    for r in rows:
        texts = {x[1] for x in edge_rows() if x[0] == r["doc_id"]}
        assert r["size"] in {len((t or "").encode()) + 1 for t in texts} and r["text_crc32"] in {zlib.crc32((t or "").encode()) for t in texts}
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert shard_documents(none).count() == 0
    kept = shard_documents(docs, 4, keep=True)
    assert kept.count() == 16 and kept.columns == [*docs.columns, "shard", "slot"]


def test_sharding_balances_and_parts_do_not_change_shards(spark):
    rows = [(i, "copy of one text " * 5 if i % 3 == 0 else prose(i, 5 + i % 40)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = shard_documents(df, 8).collect()
    sizes = Counter()
    for r in one:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in one)
    several = {(r["doc_id"], r["shard"], r["slot"]) for r in shard_documents(df, 8, rows_per_part=40).collect()}
    assert several == {(r["doc_id"], r["shard"], r["slot"]) for r in one}


def test_mixing_edges(docs, none):
    rows = mix(docs).collect()
    assert len(rows) == 16 and all(r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0) for r in rows)
    assert sorted(map(tuple, mix(docs, bin_rows=2).collect()), key=str) == sorted(map(tuple, rows), key=str)
    assert mix(none).count() == 0
    copies = mix(docs, keep=True)
    assert copies.columns == docs.columns
    assert copies.count() == sum(r["taken"] // r["size"] for r in rows if r["size"])


def test_mixing_reaches_its_targets(spark):
    rows = [(i, prose(i, 5 + i % 20), f"s{i % 7 if i % 2 else 0}") for i in range(700)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    source = {i: s for i, _, s in rows}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        target[source[r["doc_id"]]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 25 for s in target)
    assert abs(sum(target.values()) - sum(r["size"] for r in got)) < 1e-6


def test_quality_edges(docs, none):
    rows = {(r["doc_id"], r["n_words"]): r for r in quality_rules(docs).collect()}
    assert rows[4, 0]["base_failed"] and rows[5, 0]["base_failed"] and rows[None, 200]["n_words"] == 200
    assert rows[13, 500]["n_repeat_words"] == 500 and not rows[13, 500]["kept"]
    assert rows[9, 30_000]["n_words"] == 30_000
    assert quality_rules(none).count() == 0 and keep_good(none).count() == 0
    good = keep_good(docs)
    assert good.columns == docs.columns and good.filter("doc_id = 13").isEmpty() and quality_rules(docs).filter("kept").count() == good.count()


@pytest.mark.parametrize("junk", [1, 8, 30])
def test_texts_without_common_words_fail_however_many_they_are(spark, junk):
    draw = random.Random(junk)
    rest = prose(30, 400).split()
    clean = [" ".join(draw.choice(COMMON_WORDS["de"]) if draw.random() < 0.2 else draw.choice(rest) for _ in range(300)) for _ in range(40)]
    texts = [*clean, *[prose(500 + k, 300) for k in range(junk)], *["hot words " * 3000] * 5]
    rows = quality_rules(spark.createDataFrame([(i, "de", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")).collect()
    assert {r["doc_id"] for r in rows if r["kept"]} == set(range(40))


def test_histograms_match_brute_force_without_a_pass_for_each_class_or_word(spark):
    draw = random.Random(4)
    odd = ["The", "the", "a", "\u0130stanbul", "\u03a3\u0391\u03a3", "der", "12", "12", "--", "#tag", "x", "\u00c8", "\U0001f642", "\u0085", "$5", "\x00", "\x1c", "und,"]
    texts = [None, "", " \t", "\n\nx\n", " a b c a b c "]
    for _ in range(60):
        words = draw.sample(odd, draw.randint(1, len(odd))) + prose(draw.randint(1, 99), 200).split()[: draw.choice([0, 5, 200])]
        texts.append("".join(draw.choice(words) + draw.choice(" \n\t\x0b\r") * draw.randint(1, 2) for _ in range(draw.choice([1, 30, 150, 700]))))
    docs = profile(spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string"))
    for row in docs.collect():
        text = texts[row["doc_id"]] or ""
        words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text) if w]
        counts = Counter(w.lower() for w in words)
        kinds = Counter(_character_class(c) for c in text)
        assert row["__p"]["word_chars"] == sum(map(len, words)) and row["__p"]["chars"] == len(text)
        assert row["__p"]["classes"] == [kinds[k] for k in range(6)] and row["__p"]["words"] == [counts[w] for w in ALL_WORDS]
        frequent = sum(n for w, n in counts.items() if n >= max(3, len(words) // 100) and any(c.isalpha() for c in w))
        bare = len(words) >= 100 and 3 * sum(counts[w] for w in ALL_WORDS) < len(words)
        assert row["__p"]["own_words"] == (frequent if bare else 0)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(coalesce(text" not in plan and plan.count(" replace(") + plan.count("(replace(") <= 1


def _character_class(c):
    return 3 if c in " \t\n\x0b\x0c\r" else 4 if c in "#*$%&|<>" else 0 if c > "\x7f" or "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 5


def test_many_repeated_windows(spark):
    text = prose(5, 300)
    row = quality_rules(spark.createDataFrame([(1, "en", f"{text} {text} tail of it")], "doc_id long, lang string, text string")).first()
    assert row["n_repeat_words"] == 600 and row["base_failed"]


def test_near_duplicates_edges(docs, none):
    rows = near_duplicates(docs, 3, 85).collect()
    assert len(rows) == 16
    component = {r["doc_id"]: r["component_id"] for r in rows}
    assert component[1] == component[2] == component[3] == 1 and component[7] == component[8] == 7
    assert component[4] == 4 and component[5] == 5 and component[6] == 6 and component[None] is None
    assert near_duplicates(none).count() == 0
    left = drop_near_duplicates(docs)
    ids = sorted((r["doc_id"] for r in left.select("doc_id").collect()), key=lambda i: (i is None, i))
    assert left.columns == docs.columns and ids == [1, 4, 5, 6, 7, 9, 10, 11, 12, 13, None, None]
    doubled = drop_near_duplicates(docs.filter("doc_id = 2"))
    assert doubled.count() == 1


def brute_components(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + min(width, len(w))]) for k in range(len(w) - min(width, len(w)) + 1)} if w else set()
    parent = {i: i for i in texts}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicate_groups_match_brute_force(spark, monkeypatch, width, percent):
    import tierflow.llm.neardup as module

    monkeypatch.setattr(module, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(module, "CLUSTER_BLOCK_DOCS", 12)
    texts, draw = {}, random.Random(3)
    for group in range(6):
        words = prose(100 + group, 120).split()
        for _ in range(40):
            changed = list(words)
            for _ in range(draw.randint(0, 7)):
                changed[draw.randrange(len(changed))] = f"w{draw.randrange(10**6)}"
            texts[len(texts)] = " ".join(changed)
    got = near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), width, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute_components(texts, width, percent)


def test_band_rows_bound_the_miss():
    for percent in (80, 85, 90):
        assert (1 - (percent / 100) ** band_rows(percent)) ** 28 <= 1e-6


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[k] == 100 for k in range(100, 140)) and found[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(texts, width):
    words = [(t or "").encode().split() for t in texts]
    windows = Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {i + k for i in range(len(w) - width + 1) if windows[tuple(w[i : i + width])] > 1 for k in range(width)}
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("shard_words", [1_500_000, 300])
def test_repeats_match_brute_force(spark, shard_words):
    draw, shared = random.Random(9), prose(7, 90).split()
    texts = ["la " * 400, "la " * 100, None, "", prose(8, 34), prose(8, 34), prose(8, 35), prose(8, 35), ("ab cd ef " * 60)]
    for k in range(60):
        a, n = draw.randrange(50), draw.randint(20, 90)
        texts.append(" ".join(prose(1000 + k, draw.randint(5, 60)).split() + shared[a : a + n] + prose(2000 + k, draw.randint(0, 50)).split()))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, remove_repeats(rows, 35, shard_words).collect()))
    assert [g[1:] for g in got] == brute_repeats(texts, 35)


def test_copies_of_a_hot_passage_are_one_piece(spark):
    rows = [(1, bytes([k % 7]), k, 50, b"a copy") for k in range(500)] + [(1, b"d", k, 50, b"other %d" % k) for k in range(5)] + [(2, b"e", 0, 50, b"a single")]
    made = different_pieces(spark.createDataFrame(rows, "anchor long, doc binary, first int, words int, content binary"), 100).collect()
    # 300 different words are three blocks, and a row stands in two pairs of them.
    assert sorted((r["anchor"], bytes(r["content"]), r["places"]) for r in made) == sorted(2 * [(1, b"a copy", 500)] + 2 * [(1, b"other %d" % k, 1) for k in range(5)] + [(2, b"a single", 1)])


def test_hot_copies_match_brute_force(spark):
    text, passage = prose(21, 80), prose(22, 60)
    texts = [text] * 30 + [passage] * 30 + [f"{prose(3000 + k, k % 5)} {passage} {prose(4000 + k, k % 6)}".strip() for k in range(30)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, remove_repeats(rows, 35, 400).collect()))
    assert [g[1:] for g in got] == brute_repeats(texts, 35)


def test_sentences_repeated_at_once_match_brute_force(spark):
    texts = []
    for k in range(40):
        for period in range(9, 28):
            n = max(3 * period, 35 + period + k % 10)
            around = [prose(7000 + k, k % 7 * 6), prose(8000 + k, k % 5 * 9)]
            sentence = prose(100 * k + period, period).split()
            texts.append(" ".join([around[0], *(sentence * 5)[:n], around[1]]).strip().replace("  ", " "))
    # Texts share no surroundings: each is judged by itself.
    texts = [" ".join(f"{w}.{i}" for w in t.split()) for i, t in enumerate(texts)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in remove_repeats(rows).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 35)


def test_word_hashes_of_pieces(monkeypatch):
    text = b" a\x00 \x00a \x00\n\xc3\x84\x0b\x0cx\r\ty a  " + b"q " * 50 + b"z" * 300 + b" " + prose(3, 500).encode() + b" q end"
    whole = WordHashes().of(text)
    assert [text[f:e] for f, e in zip(*whole[:2])] == text.split() and len(set(whole[2].tolist())) == len(set(text.split()))
    for piece in (1, 7, 100):
        monkeypatch.setattr("tierflow.llm.substrings.PIECE", piece)
        assert all((a == b).all() for a, b in zip(whole, WordHashes().of(text), strict=True))
    assert [len(x) for x in WordHashes().of(b"")] == [len(x) for x in WordHashes().of(b" \t")] == [0, 0, 0]


def test_texts_are_cut_together_as_they_are_apart(monkeypatch):
    draw = random.Random(8)
    texts = [prose(k, draw.choice([0, 1, 34, 35, 36, 90, 300])).encode() for k in range(60)]
    texts += [b" ".join([*prose(500 + d, 20).encode().split(), *prose(600 + d, d).encode().split() * 4]) for d in range(9, 28)]
    draw.shuffle(texts)

    def cut(rows):
        return [
            (beside[t], anchor, first, end, places, joined[byte[at + first] : stop[at + end - 1]])
            for beside, joined, byte, stop, found in _segmented(rows, 35)
            for t, anchor, first, end, places, at in zip(*[x.tolist() for x in found])
        ]

    rows = [(k, pa.scalar(text)) for k, text in enumerate(texts)]
    together = cut(rows)
    assert together == [x for row in rows for x in cut([row])] and len({x[0] for x in together}) == sum(len(t.split()) >= 35 for t in texts)
    assert all(joined.split() == texts[k].split()[first:end] for k, _, first, end, _, joined in together) and max(x[4] for x in together) > 1
    calls, real = [], segments
    monkeypatch.setattr("tierflow.llm.substrings.segments", lambda *a: calls.append(len(a[1])) or real(*a))
    assert cut(rows) == together and len(calls) == 1


def test_short_texts_among_copies_stay(spark):
    passage = prose(1, 40)
    texts = [f"{prose(10 + k, 20)} {passage}" if k % 2 else prose(30 + k, 5) for k in range(12)]
    rows = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)).collect()
    assert all((r["n_removed"], r["kept_words"]) == ((40, prose(10 + r["doc_id"], 20)) if r["doc_id"] % 2 else (0, texts[r["doc_id"]])) for r in rows)


def test_repeats_edges(docs, none):
    rows = remove_repeats(docs).collect()
    assert len(rows) == 16 and {(r["doc_id"], r["n_words"], r["n_removed"]) for r in rows} >= {(1, 200, 200), (4, 0, 0), (7, 1, 0), (13, 500, 500), (9, 30_000, 0)}
    assert remove_repeats(none).count() == 0


def test_search_edges(spark, docs, none):
    items = spark.createDataFrame([(1, prose(1, 200)), (2, "one"), (3, None), (4, ""), (5, prose(77, 20)), (None, "same"), (2, "one")], "item_id long, text string")
    for block_words in (5_000_000, 10):
        rows = find_items(docs, items, 10, block_words).collect()
        assert len(rows) == 16
        found = {r["doc_id"]: (r["n_words"], [tuple(h) for h in r["hits"]], r["items"]) for r in rows if r["doc_id"]}
        assert found[1] == (200, [(0, 199)], [1]) and found[7] == (1, [(0, 0)], [2]) and found[4] == (0, [], []) and found[13] == (500, [], [])
        assert sorted(r["doc_id"] for r in drop_contaminated(docs, items, 10, block_words).filter("doc_id is not null").collect()) == [4, 5, 6, 9, 10, 11, 12, 13]
    assert drop_contaminated(docs, items).columns == docs.columns
    assert find_items(none, items).count() == 0 and find_items(docs, items.limit(0)).filter("size(hits) > 0").isEmpty()


def test_language_edges(docs, none):
    rows = identify_languages(docs, learned_from("doc_id", 4, 2)).collect()
    assert len(rows) == 16 and {r["doc_id"]: r["lang_pred"] for r in rows}[4] == "und" and {r["doc_id"]: r["lang_pred"] for r in rows}[6] == "und"
    assert identify_languages(none, learned_from("doc_id", 4, 2)).count() == 0
    assert {r["lang_pred"] for r in identify_languages(docs, F.lit(False)).collect()} == {"und"}


def test_toxicity_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 0), (7, 1), (None, 1), (9, None), (1, 0)], "doc_id long, toxic int")
    rows = score_toxicity(docs, labels, learned_from("doc_id", 5, 0)).collect()
    assert len(rows) == 16 and all(0 <= r["score"] <= 1 for r in rows)
    assert score_toxicity(none, labels.limit(0), learned_from("doc_id", 5, 0)).count() == 0


def test_every_match_holds_the_tokens_of_its_rule():
    for url in ("http://a.b/wp-login.php", "http://a.b/wp-login.php5", "http://a.b/wp-login.phps?x=1"):
        for rare in ("wp", "login", "php"):
            assert RuleIndex(PATTERN_RULES, {t: 9 for t in ("wp", "login", "php")} | {rare: 1}).matches(url)


def test_surrogates_edges(spark, docs, none):
    key = F.lit("k")
    rows = replace_personal_data(docs, key).collect()
    assert len(rows) == 16 and {r["doc_id"]: r["n_entities"] for r in rows}[12] == 1
    assert replace_personal_data(none, key).count() == 0
    text = "Mr. Smith, Mrs Anna Jones and ANN@Mail.example.com, ann@mail.example.com; 4845-1681-1440-7329 4845168114407329 Господин Иванов 10.0.0.1."
    once = replace_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"), key).first()["text"]
    parts = once.replace(";", ",").split(" ")
    assert once.startswith("Mr. ") and "Mrs " in once and "Господин " in once and "Smith" not in once and "Иванов" not in once
    mails = [p.strip(",") for p in parts if "@" in p]
    assert mails[0].lower() == mails[1] and mails[0][:3].isupper() and mails[1].endswith(".com")
    assert any(p.replace("-", "") == q for p in parts if p.count("-") == 3 for q in parts)


@pytest.mark.parametrize("length", [129, 256, 30_000])
def test_long_secrets_are_replaced_whole(spark, length):
    draw = random.Random(length)
    key = "".join(draw.choice("0123456789abcdef") for _ in range(length))
    token = "".join(draw.choice("abcXYZ0189-_") for _ in range(length + 471))
    text = f'key {key} and token = "e{token}.x" end'
    row = replace_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"), F.lit("k")).first()
    new = row["text"].split()
    assert row["n_entities"] == 2 and [len(w) for w in new] == [len(w) for w in text.split()] and new[0] == "key" and new[2:5] == ["and", "token", "="]
    assert key[:40] not in row["text"] and token[:40] not in row["text"] and set(new[1]) <= set("0123456789abcdef")


def test_surrogates_stay_distinct(spark):
    entities = spark.range(3000).select(F.lit("phone").alias("kind"), F.format_string("%04d", "id").alias("canon"))
    ten = distinct_surrogates(entities.limit(0), F.lit("k"))
    assert ten.isEmpty()
    few = spark.range(200).select(F.lit("name f").alias("kind"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("canon"))
    assert distinct_surrogates(few, F.lit("k")).count() == 200


def test_url_edges(spark):
    urls = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.COM/en/x?q#f"), (5, "https://www.example.com/en/"), (6, "http://sub.www.example.com/en/y"), (7, "http://x.net/fr/"),
        (8, "http://com/"), (9, "http://notexample.com/en/"), (10, "http://spam-farm.example.org/a"), (11, "http://example.com?x=/en/"), (11, "http://x.org/wp-login.php"), (None, "x://y.net/es/z"),
    ]
    df = spark.createDataFrame([(*u, "<html>", "v") for u in urls], "page_id long, url string, html string, verdict string")
    got = sorted([tuple(r)[:5] for r in filter_urls(df).collect()], key=str)
    want = [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "a.example.com", "/en/x", "example.com/en/", "block"),
        (5, "www.example.com", "/en/", "www.example.com/en/", "allow"), (6, "sub.www.example.com", "/en/y", "www.example.com/en/", "allow"), (7, "x.net", "/fr/", "net/fr/", "block"),
        (8, "com", "/", "com/", "allow"), (9, "notexample.com", "/en/", "com/", "allow"), (10, "spam-farm.example.org", "/a", None, "block"), (11, "example.com", "", None, "allow"),
        (11, "x.org", "/wp-login.php", None, "block"), (None, "y.net", "/es/z", "net/es/", "block"),
    ]
    assert got == sorted(want, key=str)
    assert filter_urls(df.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token():
    index = RuleIndex([PatternRule("a-b", ("a", "b")), PatternRule("z+", ())], {"a": 5, "b": 2})
    assert set(index.by_token) == {"b"} and len(index.always) == 1
    assert index.matches("x-a-b") and index.matches("ZZ") and not index.matches("b-a") and not index.matches(None)




def test_splitters_take_one_job_a_round(spark):
    """211 partitions without coalescing, one text in a third of the rows: few rounds, and no job for each partition."""
    held = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    rows = [(k, "one text " * 9 if k % 3 == 0 else f"text {k}") for k in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = materialize(_keys(docs))
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        spark.sparkContext.setJobGroup("splitters", "")
        found = Splitters(keys, 16)
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("splitters"))
    finally:
        spark.sparkContext.setJobGroup("", "")
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found.rounds <= 4 and jobs <= 4 * found.rounds + 4
    placed = sorted((r["h"], r["d"], r["size"]) for r in keys.collect())
    total, below = sum(p[2] for p in placed), 0
    want = []
    for h, d, size in placed:
        while len(want) < 15 and (below + size) * 16 >= (len(want) + 1) * total:
            want.append((h, d))
        below += size
    for (h, d), (upper_h, upper_d, n) in zip(want, found.bounds):
        assert placed[n - 1][:2] == (h, d) and (n == len(placed) or placed[n][:2] >= (upper_h, upper_d) > (h, d))


# Ordinary passages of languages without a word list.
FOREIGN = {
    "it": "Il paese si trova in una valle tranquilla e la strada che porta alla piazza passa accanto alla chiesa. Ogni mattina il fornaio apre la bottega e il profumo del pane "
    "si sente fino alla fontana. I bambini vanno a scuola a piedi e si fermano a guardare il mulino che gira con il vento. La domenica la gente si ritrova al mercato, dove il contadino "
    "vende la frutta e il pastore porta il formaggio. Quando arriva la sera, il sole scende dietro la montagna e la luce cambia il colore delle case. Mia nonna racconta sempre la storia "
    "di un viaggiatore che si era perso nella neve e che trovò riparo presso il mulino, dove il mugnaio gli diede una minestra calda e un letto per la notte.",
    "ru": "В старом доме на берегу реки жил рыбак и его сын. Каждое утро они выходили на берег и смотрели на воду, а потом садились в лодку и плыли на середину реки. Рыбак знал, где "
    "стоит рыба, и учил сына не спешить и ждать. Вечером они возвращались домой и варили уху на костре. Сын спрашивал, что было на реке, когда отец был молод, и рыбак рассказывал "
    "о больших пароходах и о людях, которые приезжали в деревню на ярмарку. Потом они сидели и смотрели на огонь, и на небе были видны звёзды. На другой день всё начиналось снова, и "
    "река была та же, и лодка была та же, и они были рады, что у них есть дом и есть что делать на воде и на берегу.",
    "pl": "W małym mieście nad rzeką stoi dom, w którym mieszka stary zegarmistrz. Na ścianie w jego pracowni wisi wiele zegarów i każdy z nich pokazuje inną godzinę. Ludzie mówią, że "
    "to dziwne, ale on się tylko śmieje i mówi, że czas nie jest dla wszystkich taki sam. Rano idzie na rynek i kupuje chleb, a potem siada na ławce i patrzy na gołębie. Dzieci "
    "lubią do niego przychodzić, bo opowiada im o podróżach i o tym, co widział na morzu. Wieczorem w oknie pracowni pali się światło i słychać, jak zegary biją jeden po drugim. "
    "Kto raz tam był, ten na długo pamięta ten dom i ten dźwięk, i wraca, kiedy jest w mieście, żeby się z nim przywitać.",
    "tr": "Köyün girişinde büyük bir çınar ağacı ve onun altında eski bir çeşme vardır. Yaz gelince herkes bu ağacın altında oturur ve çay içer. Dedem bana bu çeşmenin çok eski bir "
    "hikayesi olduğunu anlatmıştı. Bir gün köye bir yolcu gelmiş ve su istemiş, ama o yıl kuraklık varmış ve kuyularda su kalmamış. Yolcu elindeki değnekle yere vurmuş ve oradan su çıkmış. "
    "O günden beri bu su hiç kesilmemiş. Şimdi çocuklar çeşmenin başında oynar, kadınlar su doldurur ve yaşlılar gölgede konuşur. Akşam olunca köy sessiz olur, ama çeşmenin sesi "
    "bütün gece duyulur. Ben de her yaz köye gidince önce bu çeşmeden bir bardak su içer ve ağacın altında biraz dinlenirim. Bu köy benim için bir ev ve bir hatıradır.",
}


@pytest.mark.parametrize("label", ["own", None, "en"])
def test_prose_of_languages_without_a_list_stays(spark, label):
    draw = random.Random(4)
    rest = prose(30, 400).split()
    rows = [(i, "en", " ".join(draw.choice(COMMON_WORDS["en"]) if draw.random() < 0.3 else draw.choice(rest) for _ in range(300))) for i in range(30)]
    rows += [(100 + k, lang if label == "own" else label, text) for k, (lang, text) in enumerate(FOREIGN.items())]
    rows += [(200, label, " | ".join(prose(77, 200).split())), (201, label, prose(78, 250)), (202, "en", "### 47853805 $$$ 1139 %%% " * 3 + "12 34 56 &&& " * 40)]
    kept = {r["doc_id"] for r in quality_rules(spark.createDataFrame(rows, "doc_id long, lang string, text string")).collect() if r["kept"]}
    assert all(len(t.split()) >= 100 for t in FOREIGN.values())
    assert kept == {*range(30), *range(100, 104)}


MENTIONS = [
    f"{'a' * 70}@mail.example.com", "ann@" + ".".join("abcdefghijk") + ".com", f"x@{'y' * 80}.org", "Mr McDonald", "Ms O'Neil", "Mrs Anna-Lena Smith", "Frau Müller-Lüdenscheidt",
    f"Mr A{'b' * 60}", "Mme D’Arcy", "Herr VON BERG", "Señora Núñez",
]


@pytest.mark.parametrize("mention", MENTIONS)
def test_long_mails_and_names_of_any_shape_go_whole(spark, mention):
    text = f"of {mention}, and {mention} too"
    row = replace_personal_data(spark.createDataFrame([(1, text)], "doc_id long, text string"), F.lit("k")).first()
    title, _, rest = mention.partition(" ") if "@" not in mention else ("", "", mention)
    parts = [p for p in rest.replace("@", " ").replace(".", " ").replace("-", " ").split() if len(p) > 3 or "@" in mention and len(p) > 1 and p not in ("com", "org")]
    assert row["n_entities"] == 2 and not [p for p in parts if p in row["text"]]
    new = row["text"].removeprefix("of ").removesuffix(" too").split(", and ")
    assert new[0] == new[1] and new[0].startswith(title)


def test_used_up_forms_get_longer_surrogates(spark):
    """468 of the 676 addresses of a form are real: no distinct unreal ones of that form exist."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.io" for a in letters for b in letters[:18]]
    cards = [f"{k:013d}" for k in range(5)]
    docs = spark.createDataFrame([(k, f"write to {m} now") for k, m in enumerate(mails)] + [(1000 + k, f"card {c}.") for k, c in enumerate(cards)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in replace_personal_data(docs, F.lit("k")).collect()}
    new = [out[k].split()[2] for k in range(len(mails))]
    assert len(set(new)) == len(mails) and not set(new) & set(mails) and all(m.endswith(".io") and m.count("@") == 1 for m in new)
    assert all(len(out[1000 + k]) == len(f"card {c}.") for k, c in enumerate(cards))


def test_items_without_an_id_are_searched(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, text, 7), (2, "other words", 7), (3, "say hello", 7)], "doc_id long, text string, __id int")
    items = spark.createDataFrame([(None, text), (None, "hello"), (5, "w1 w2 w3")], "item_id long, text string")
    for block_words in (300_000, 1):
        got = {r["doc_id"]: (r["n_words"], sum(h["last"] - h["first"] + 1 for h in r["hits"]), r["items"]) for r in find_items(docs, items, block_words=block_words).collect()}
        assert got == {1: (30, 30, [5, None]), 2: (2, 0, []), 3: (2, 1, [None])}
        assert [r["doc_id"] for r in drop_contaminated(docs, items, block_words=block_words).collect()] == [2]


def test_stages_keep_columns_named_like_their_own(spark):
    names = ["__id", "__number", "row", "id", "gone_id", "repeated_id", "number", "__found", "__row", "__text"]
    rows = [(k, prose(k // 2, 80) if k < 8 else "x", *range(len(names))) for k in (0, 1, 2, 3, 4, 4, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 2, 4, 8]
    clean = drop_contaminated(docs, spark.createDataFrame([(1, "nothing of it")], "item_id long, text string"))
    assert clean.count() == 7 and clean.columns == docs.columns


@pytest.mark.parametrize("width", [1, 5, 35, 60, 63, 64, 65, 130])
def test_repeats_of_any_width(spark, width):
    draw = random.Random(width)
    texts = [" ".join(draw.choice("ab") if draw.random() < 0.97 else f"x{draw.randrange(400)}" for _ in range(draw.randint(width, 4 * width + 9))) for _ in range(6)]
    texts += [" ".join(["p q r"] * width), texts[0][: len(texts[0]) // 2], "s " * (width - 1), "t " * (width + 1)]
    windows = Counter(tuple(t.split()[i : i + width]) for t in texts for i in range(len(t.split()) - width + 1))
    got = {r["doc_id"]: r["kept_words"] for r in remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), width).collect()}
    for k, t in enumerate(texts):
        w = t.split()
        gone = {i + j for i in range(len(w) - width + 1) if windows[tuple(w[i : i + width])] > 1 for j in range(width)}
        assert got[k] == " ".join(x for i, x in enumerate(w) if i not in gone), (width, k)
