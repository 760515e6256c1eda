"""The dealt queries on the smallest tables, against their SQL or a brute-force version."""

import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_oracle import compare, duck  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
OWN = [n for n in queries() if re.match(r"op\d+_", n)]


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_all_operators_and_the_pipeline():
    assert sorted(int(n[2:].split("_")[0]) for n in OWN) == list(range(1, 1 + len(OWN))) and "pipeline" in queries()


@pytest.mark.parametrize("name", [n for n in OWN if n in oracle_sql()])
def test_query_matches_sql(spark, connection, name):
    verdict = compare(spark, connection, SF, name)
    assert verdict.startswith("ok"), verdict


def test_quality_counts_match_brute_force(spark, connection):
    got = {r["doc_id"]: r for r in queries()["op4_divergence_rules"](spark, SF).collect()}
    for doc_id, text in connection.execute("SELECT doc_id, text FROM documents").fetchall():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        row = got[doc_id]
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
        )
        assert row["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (row["kept"] and row["base_failed"])


def test_languages_of_held_out_documents(spark, connection):
    rows = queries()["op9_language_mixture"](spark, SF).collect()
    langs = dict(connection.execute("SELECT doc_id, lang FROM documents").fetchall())
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(langs) and sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_scores(spark, connection):
    rows = queries()["op2_weak_supervision"](spark, "/root/testdata/sf0.01").collect()
    marks = dict(duck("/root/testdata/sf0.01").execute("SELECT doc_id, toxic FROM labels").fetchall())
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    clean = [r["score"] for r in rows if r["held_out"] and marks.get(r["doc_id"]) == 0]
    toxic = [r["score"] for r in rows if r["held_out"] and marks.get(r["doc_id"]) == 1]
    assert sum(s >= 0.5 for s in clean) <= 0.05 * len(clean)
    assert sum(t > c for t in toxic for c in clean) >= 0.7 * len(toxic) * len(clean)


def test_personal_data_is_gone_and_the_rest_stays(spark, connection):
    planted = re.compile(r"\S+@\S+\.com|\b\d{16}\b|\+1 \(\d{3}\) 555-\d{4}|\d+\.\d+\.\d+\.\d+|[0-9a-fA-F]{40}")
    rows = {r["doc_id"]: r for r in queries()["op8_surrogates"](spark, SF).collect()}
    for doc_id, text in connection.execute("SELECT doc_id, text FROM documents").fetchall():
        found = planted.findall(text)
        assert not [m for m in found if m in rows[doc_id]["text"]]
        if not rows[doc_id]["n_entities"]:
            assert rows[doc_id]["text"] == text and not found
