"""Language identification as a mixture: each text's language shares by expectation-maximisation.

A language is a distribution over hashed byte trigrams (lower-cased, a blank on either side of a word), counted over all
documents to learn from. A word's likelihood under a language is the product over its trigrams. For each text,
expectation-maximisation estimates the shares of the languages over its words; then languages are dropped one by one, the
smallest share first, as long as that does not lower the likelihood by more than the penalty for one more parameter
(half the logarithm of the number of words). The largest share of the set that is left is the prediction, and its score.

The model has ``BINS`` counts for each language: its size depends on the number of languages, not on the input.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import ASCII_LOWER

BINS = 1 << 15
MOST_LANGUAGES = 1000
ROUNDS = 25
SMOOTHING = 0.1
UNKNOWN = "und"

# Everything in ASCII that is no letter separates words.
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in ASCII_LOWER)
_CHUNK = 1 << 20


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all trigrams of a text and the number of the word each belongs to (non-decreasing)."""
    data = np.frombuffer(b" " + text.translate(_LETTERS) + b" ", np.uint8).astype(np.uint32)
    blank = data == 32
    # The trigram around each byte of a word.
    middle = np.flatnonzero(~blank[1:-1]) + 1
    code = (data[middle - 1] << 16) | (data[middle] << 8) | data[middle + 1]
    bins = ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
    begins = blank[:-1] & ~blank[1:]
    word = np.cumsum(begins)[middle - 1] - 1
    return bins, word


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages of ``docs`` (text, lang) and log-probabilities (bins x languages) from all its rows."""

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
                data = text.as_py()
                for at in range(0, len(data), _CHUNK):
                    bins, _ = trigrams(data[at : at + _CHUNK])
                    own = totals.setdefault(lang, np.zeros(BINS, np.int64))
                    np.add.at(own, bins, 1)
        for lang, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(own[at], pa.int64())], ["lang", "bin", "n"])

    given = docs.filter("lang is not null and text is not null").select("lang", F.encode("text", "UTF-8").alias("text"))
    counted = given.mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    rows = counted.toPandas()  # at most BINS rows for each language
    languages = sorted(rows["lang"].unique().tolist())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; the model is meant for {MOST_LANGUAGES} at most")
    table = np.full((BINS, max(1, len(languages))), SMOOTHING)
    for k, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        table[own["bin"].to_numpy(), k] += own["n"].to_numpy()
    return languages, np.log(table / table.sum(axis=0)).astype(np.float32)


def mixture(likelihood: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the columns of ``likelihood`` (words x languages, scaled by word) and the log-likelihood."""
    share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
    last = -np.inf
    for _ in range(ROUNDS):
        joint = likelihood * share
        total = joint.sum(axis=1)
        value = float(np.log(total).sum())
        share = (joint / total[:, None]).mean(axis=0)
        if value - last < 1e-4 * len(total) and np.isfinite(last):
            break
        last = value
    return share, value


def shares_of(text: str, log_table: np.ndarray) -> np.ndarray:
    """Share of each language in a text; a language outside the chosen set has 0."""
    data = text.encode()
    per_word = []
    for at in range(0, len(data), _CHUNK):
        bins, word = trigrams(data[at : at + _CHUNK])
        if len(bins):
            per_word.append(np.add.reduceat(log_table[bins], np.flatnonzero(np.r_[True, word[1:] != word[:-1]]), axis=0))
    if not per_word:
        return np.full(log_table.shape[1], 1.0 / log_table.shape[1])
    logs = np.concatenate(per_word).astype(np.float64)
    likelihood = np.maximum(np.exp(logs - logs.max(axis=1, keepdims=True)), 1e-30)
    chosen = np.arange(likelihood.shape[1])
    share, value = mixture(likelihood)
    penalty = 0.5 * np.log(max(2, len(likelihood)))
    while len(chosen) > 1:
        rest = np.delete(np.arange(len(chosen)), share.argmin())
        less_share, less_value = mixture(likelihood[:, chosen[rest]])
        if value - less_value > penalty:
            break
        chosen, share, value = chosen[rest], less_share, less_value
    out = np.zeros(likelihood.shape[1])
    out[chosen] = share
    return out


def predict(docs: DataFrame, languages: list[str], log_table: np.ndarray) -> DataFrame:
    """Add lang_pred and score to (doc_id, held_out, text)."""
    model = docs.sparkSession.sparkContext.broadcast((languages, log_table))

    def judge(frames):
        names, logs = model.value
        for frame in frames:
            picked, scores = [], []
            for text in frame["text"]:
                if text is None or not names or not has_letter(text):
                    picked.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                share = shares_of(text, logs)
                best = int(share.argmax())
                picked.append(names[best])
                scores.append(min(1.0, float(share[best])))
            yield pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["held_out"], "lang_pred": picked, "score": scores})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInPandas(judge, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame, learn) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    ``learn`` is the condition of the rows to learn from (text and lang only); the others are held out. A NULL text or one
    without a letter is ``und`` with score 0, and so is every text if there is nothing to learn from. Ties go to the
    language that sorts first. Rows are judged one by one, whatever their ids.
    """
    languages, table = train(docs.filter(learn).select("text", "lang"))
    return predict(docs.select("doc_id", (~learn).alias("held_out"), "text"), languages, table)
