"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors.

1. Voters. Lexicon voters are word beginnings and whole words that stand far more often in documents marked toxic, chosen by
   a count over all documents to learn from, beside a given list; pattern voters look at shouting, insults in the
   second person and runs of exclamation marks. A voter fires or keeps silent on a document.
2. Label model. Over the votes of all documents to learn from (marked or not), expectation-maximisation estimates for each
   voter how often it is right when it fires; marks start and anchor the estimates. Voters that fire together
   more often than their class explains are correlated; each vote counts 1 / (1 + its excess correlations), so that
   fifty forms of one word have the weight of about one.
3. Classifier. A logistic regression on vote and density features, fitted to the posterior labels of at most
   ``most_rows`` documents (the smallest hashes of their ids), gives the score. A document without any vote is scored by the intercept.

Marks are read of documents to learn from only; language, source and id are in no feature.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import ASCII_LOWER, id_key
from tierflow.session import materialize

# Insults that need no learning.
LEXICON = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")
PREFIXES = range(4, 9)
LEARNED_VOTERS = 150
# A learned voter fires on at least so many marked toxic documents, and is right at least so often.
LEAST_MARKED = 5
LEAST_ACCURACY = 0.75
ROUNDS = 15
MOST_ROWS = 20_000
# Times a mark counts against a posterior of an unmarked document.
ANCHOR = 5

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in ASCII_LOWER)
PATTERNS = {
    "addressed insult": re.compile(rb"\byou (?:are |re )?(?:an? |all )?(?:%s)\b" % "|".join(LEXICON).encode()),
    "shut up": re.compile(rb"\bshut up\b|\bgo away\b|\bget lost\b"),
    "hate": re.compile(rb"\bi hate (?:you|them|him|her)\b"),
    "exclamation run": re.compile(rb"!{3,}"),
}


def word_forms(text: bytes) -> set[bytes]:
    """Distinct whole words (ending in a blank) and word beginnings of 4 to 8 characters."""
    out: set[bytes] = set()
    for word in set(text.translate(_LETTERS).split()):
        out.add(word + b" ")
        whole = word.decode("utf-8", "ignore")
        out.update(whole[:k].encode() for k in PREFIXES if k < len(whole))
    return out


def learn_voters(marked: DataFrame, most: int = LEARNED_VOTERS) -> list[bytes]:
    """The ``most`` forms that tell marked (toxic = 1) documents best; ``marked``: text, toxic."""

    def count(batches):
        seen: dict[bytes, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist()):
                for form in word_forms(text.as_py()):
                    seen.setdefault(form, [0, 0])[toxic] += 1
                if len(seen) > 1_000_000:
                    yield flushed(seen)
                    seen.clear()
        if seen:
            yield flushed(seen)

    def flushed(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], ["form", "clean", "toxic"]
        )

    given = marked.filter("text is not null").select(F.encode("text", "UTF-8").alias("text"), F.col("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return []
    counts = given.mapInArrow(count, "form binary, clean long, toxic long").groupBy("form").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ratio = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1))
    right = (F.col("toxic") + 1) / (F.col("toxic") + F.col("clean") + 2)
    best = counts.filter((F.col("toxic") >= LEAST_MARKED) & (right >= LEAST_ACCURACY) & (ratio > 2)).orderBy((ratio * F.sqrt("toxic")).desc(), "form").limit(most)
    return sorted(bytes(r["form"]) for r in best.collect())


class Voters:
    """Fires of every voter on a text, and the density of the lexicon's words."""

    def __init__(self, forms: list[bytes]):
        own = sorted({w.encode() + b" " for w in LEXICON} | set(forms))
        self.number = {f: k for k, f in enumerate(own)}
        self.patterns = list(PATTERNS.values())
        self.size = len(own) + len(self.patterns) + 1  # the last: half of the letters are capitals

    def votes(self, text: bytes | None) -> tuple[list[int], float]:
        if not text:
            return [], 0.0
        lowered = text.translate(ASCII_LOWER)
        words = text.translate(_LETTERS).split()
        number, fired, hit = self.number, set(), 0
        forms: dict[bytes, list[int]] = {}
        for word in set(words):
            whole = word.decode("utf-8", "ignore")
            found = [number[f] for f in (word + b" ", *(whole[:k].encode() for k in PREFIXES if k < len(whole))) if f in number]
            if found:
                forms[word] = found
                fired.update(found)
        if forms:
            hit = sum(w in forms for w in words)
        base = len(number)
        fired.update(base + k for k, p in enumerate(self.patterns) if p.search(lowered))
        capitals = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        if len(words) >= 5 and capitals > 0.4 * sum(map(len, words)):
            fired.add(self.size - 1)
        return sorted(fired), hit / max(1, len(words))


def cast_votes(docs: DataFrame, forms: list[bytes], keep: list[str]) -> DataFrame:
    """Add votes (numbers of the voters that fire) and density to the columns of ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(forms)

    def vote(batches):
        voters = Voters(shared.value)
        for batch in batches:
            got = [voters.votes(t.as_py()) for t in batch.column("__text")]
            columns = [batch.column(c) for c in keep] + [pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "votes", "density"])

    schema = docs.select(*keep).schema.add("votes", T.ArrayType(T.IntegerType())).add("density", T.DoubleType())
    return docs.select(*keep, F.encode("text", "UTF-8").alias("__text")).mapInArrow(vote, schema)


class LabelModel:
    """For each voter how accurate it is (the share of toxic documents among those it fires on), and its weight.

    A silent voter says nothing: toxicity has many forms, and a document shows one of them.
    """

    def __init__(self, base: float, marked: np.ndarray, marked_toxic: np.ndarray):
        """``base``: share of toxic documents without any vote; marks per voter anchor its accuracy."""
        self.base = float(np.log(base / (1 - base)))
        self.marked, self.marked_toxic = marked, marked_toxic
        self.accuracy = np.clip((marked_toxic + 1) / (marked + 2), 0.02, 0.98)
        self.weight = np.ones(len(marked))

    def gains(self) -> np.ndarray:
        """What a vote adds to the log-odds; none speaks for a clean document."""
        return self.weight * np.maximum(0, np.log(self.accuracy / (1 - self.accuracy)) - self.base)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """``votes``: documents x voters, 0 or 1."""
        return 1 / (1 + np.exp(-np.clip(self.base + votes @ self.gains(), -30, 30)))

    def update(self, fired: np.ndarray, fired_toxic: np.ndarray) -> None:
        seen, toxic = fired + ANCHOR * self.marked, fired_toxic + ANCHOR * self.marked_toxic
        self.accuracy = np.clip((toxic + 1) / (seen + 2), 0.02, 0.98)


def _dense(lists: list[list[int]], size: int) -> np.ndarray:
    out = np.zeros((len(lists), size))
    for row, votes in enumerate(lists):
        out[row, votes] = 1
    return out


def first_model(marked: DataFrame, size: int) -> LabelModel:
    """Start from what each voter fires on among the marked documents (votes, toxic)."""
    toxic = (F.col("toxic") > 0).cast("long")
    silent = marked.filter(F.size("votes") == 0).agg(F.sum(toxic), F.count("*")).first()
    fired = marked.select(F.explode("votes").alias("voter"), toxic.alias("t")).groupBy("voter").agg(F.sum("t").alias("t"), F.count("*").alias("n"))
    seen, found = np.zeros(size), np.zeros(size)
    for r in fired.collect():  # one row for each voter
        seen[r["voter"]], found[r["voter"]] = r["n"], r["t"]
    return LabelModel(((silent[0] or 0) + 1) / ((silent[1] or 0) + 20), seen, found)


def fit_label_model(votes: DataFrame, model: LabelModel) -> LabelModel:
    """Expectation-maximisation over all rows of ``votes``; the driver holds sums by voter and by pair of voters only."""
    # Equal votes are counted together before anything else.
    patterns = materialize(votes.groupBy("votes").agg(F.count("*").alias("n")))
    size = len(model.weight)

    def sums(current: LabelModel, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
        def add(batches):
            total, together = np.zeros(2 + 2 * size), np.zeros((size, size))
            for batch in batches:
                fired = _dense(batch.column("votes").to_pylist(), size)
                n = np.asarray(batch.column("n").to_pylist(), float)
                toxic = n * current.posterior(fired)
                total += np.r_[n.sum(), toxic.sum(), n @ fired, toxic @ fired]
                if pairs:
                    together += (fired * n[:, None]).T @ fired
            found = np.r_[total, together.ravel()]
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["at", "value"])

        # Added up by place, as decimals: one job, and the same sum in any order.
        added = patterns.mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum(F.col("value").cast("decimal(28,9)")).cast("double").alias("value"))
        found = np.zeros(2 + 2 * size + size * size)
        for row in added.collect():  # at most one row for each pair of voters
            found[row["at"]] = row["value"]
        return found[: 2 + 2 * size], found[2 + 2 * size :].reshape(size, size)

    for number in range(ROUNDS):
        total, together = sums(model, number in (0, 5))
        n, toxic, fired, fired_toxic = total[0], total[1], total[2 : 2 + size], total[2 + size :]
        if not n:
            break
        before = model.accuracy
        if number:
            model.update(fired, fired_toxic)
        if number in (0, 5):
            # Excess of joint fires over what the class-conditional rates explain, as a correlation.
            on, off = fired_toxic / max(toxic, 1.0), (fired - fired_toxic) / max(n - toxic, 1.0)
            expected = toxic * np.outer(on, on) + (n - toxic) * np.outer(off, off)
            scale = np.sqrt(np.maximum(np.outer(fired, fired), 1.0))
            excess = np.clip((together - expected) / scale, 0, 1)
            np.fill_diagonal(excess, 0)
            model.weight = 1 / (1 + np.where(excess > 0.3, excess, 0).sum(axis=1))
        elif np.abs(model.accuracy - before).max() < 1e-4 and number > 6:
            break
    return model


def fit_logistic(x: np.ndarray, target: np.ndarray, rounds: int = 400, ridge: float = 1e-3) -> np.ndarray:
    """Weights (intercept last) of a logistic regression on soft labels, by accelerated gradient steps."""
    x = np.c_[x, np.ones(len(x))]
    step = 4.0 / max(1e-9, np.linalg.norm(x, 2) ** 2 / len(x) + ridge)
    w = look = np.zeros(x.shape[1])
    for k in range(rounds):
        gradient = x.T @ (1 / (1 + np.exp(-np.clip(x @ look, -30, 30))) - target) / len(x) + ridge * np.r_[look[:-1], 0]
        after = look - step * gradient
        look, w = after + k / (k + 3) * (after - w), after
    return w


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, voters: int = LEARNED_VOTERS, most_rows: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    ``learn`` holds for the rows to learn from. ``labels`` (doc_id, toxic) marks some documents; NULL marks are left out, and an id marked
    twice counts as toxic if one mark says so. NULL and empty texts get the score of a text without votes. Without
    marks only the given lexicon and the patterns vote. Rows are scored one by one, whatever their ids.
    """
    marks = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Marks grow with the input, so they are never broadcast: one plan at every size.
    taught = docs.filter(learn).select("doc_id", "text").hint("merge").join(marks, "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    forms = learn_voters(taught, voters)
    size = Voters(forms).size
    votes = materialize(cast_votes(docs.select("doc_id", learn.alias("learn"), "text"), forms, ["doc_id", "learn"]))
    model = fit_label_model(votes.filter("learn").select("votes"), first_model(votes.filter("learn").join(marks, "doc_id"), size))
    sample = votes.filter("learn").orderBy(id_key("doc_id"), "votes", "density").limit(most_rows).select("votes", "density").collect()
    fired = _dense([r["votes"] for r in sample], size)
    density = np.array([r["density"] for r in sample])
    if len(sample):
        weights = fit_logistic(np.c_[fired, np.minimum(1.0, 20 * density)], model.posterior(fired))
    else:
        weights = np.r_[model.gains(), 0.0, model.base]
    own = F.lit([float(w) for w in weights[:size]])
    margin = F.aggregate("votes", F.lit(float(weights[-1])), lambda a, v: a + F.element_at(own, v + 1))
    margin = margin + float(weights[-2]) * F.least(F.lit(1.0), 20 * F.col("density"))
    score = 1 / (1 + F.exp(-margin))
    out = votes.select("doc_id", (~F.col("learn")).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
