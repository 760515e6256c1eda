"""Quality rules: counts of every text, and the divergence of its histograms from language references.

A text has two histograms: characters by class (small letters and all beyond ASCII, capitals, digits, white space, symbols,
other ASCII) and common words (a share for each listed word of each language, and the rest). A language reference is
the same histogram summed over all documents of that language that pass the base rule, so every reference is a statistic of the
whole table. A text is judged by the Jensen-Shannon distance (base 2, 0 to 1) to its nearest reference, each histogram by itself;
short texts are not judged, as their histograms are mostly chance. Distances of common words are scaled so that a text without a
listed word is ``BARE_DISTANCE`` from every reference: the limit does not hang on how many such texts a language has. A text with
frequent words of its own, as prose of any language has, is of a language without a list: its words are not judged.

Rows are read once; what is counted per document is written as a narrow table, from which references and verdicts come.
Everything is a built-in expression. Texts may have any length: trigrams are compared by 64-bit hashes in sorted order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import pinned
from tierflow.session import materialize

# Frequent function words of each language with a reference.
COMMON_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem"],
    "en": ["the", "of", "and", "to", "a", "in", "is", "it", "that", "for", "was", "on", "with", "as", "be", "at"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"],
}
ALL_WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Limits of the verdict.
MOST_CLASS_DISTANCE = 0.30
MOST_WORD_DISTANCE = 0.31
BARE_DISTANCE = 1 / 3
LEAST_CHARS = 200
LEAST_WORDS = 100
# Prose of any language: words that occur three times and make up a hundredth of it are this share of it together.
LEAST_OWN_SHARE = 0.05


def _counted(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def profile(docs: DataFrame) -> DataFrame:
    """Add ``__p``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and both histograms of every text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    inner = F.btrim(text, F.lit(SPACES))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[\\x20\\x09-\\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    split = pinned(docs, __w=words, __l=lines, __chars=F.length(text).cast("long"))
    n = F.size("__w")
    starts = F.sequence(F.lit(1), n - 2)
    trigrams = F.when(
        n >= 3,
        F.transform(starts, lambda i: F.xxhash64(F.element_at("__w", i), F.element_at("__w", i + 1), F.element_at("__w", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    split = pinned(
        split, __n=n, __v=F.transform("__w", F.lower), __solid=F.array_join("__w", ""), __t=trigrams,
        __d=(F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
    )
    # Capitals, digits, symbols and other ASCII are few in most texts: what is counted character by character is short.
    rest = F.regexp_replace("__solid", "[^\\x00-\\x60\\x7B-\\x7F]+", "")
    repeated = F.size(F.array_distinct("__t")) < F.size("__t")
    split = pinned(
        split, __r=rest, __word_chars=F.length("__solid").cast("long"), __f=F.filter("__v", lambda w: w.isin(ALL_WORDS)),
        __s=F.when(repeated, F.sort_array("__t")), __k=F.greatest(F.lit(3), F.expr("cast(__n div 100 as int)")),
    )
    # Where less than a third of the words are listed ones: the words in order, so that equal ones stand together.
    bare = (F.col("__n") >= LEAST_WORDS) & (3 * F.size("__f") < F.col("__n"))
    # Hashes that stand next to an equal one in sorted order.
    twice = F.array_distinct(F.filter("__s", lambda x, i: (i > 0) & (x == F.get("__s", F.greatest(i - 1, F.lit(0))))))
    counted = [_counted(F.col("__r"), x) for x in (UPPER, "0123456789", SYMBOLS)]
    split = pinned(
        split, __o=F.when(bare, F.sort_array("__v")), __g=F.sort_array(F.concat("__f", F.lit(ALL_WORDS))), __2=twice,
        __upper=counted[0], __digits=counted[1], __symbols=counted[2], __rest=F.length("__r").cast("long"),
    )
    few = F.filter(F.transform("__t", lambda x, i: F.when(F.array_contains("__2", x), i).otherwise(-1)), lambda p: p >= 0)
    # Many repeated windows: sort (hash, place) and mark the places whose hash has an equal neighbour.
    paired = F.when(F.size("__2") > 64, F.sort_array(F.transform("__t", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    # Each listed word stands once more than it occurs: where it begins.
    fresh = F.transform("__g", lambda w, i: F.when((i > 0) & (F.get("__g", F.greatest(i - 1, F.lit(0))) == w), -1).otherwise(i))
    split = pinned(split, __q=paired, __b=_frequent(), __h=F.filter(fresh, lambda i: i >= 0), __m=F.size("__g"))

    def neighbour(p, k):
        other = F.get("__q", F.greatest(k, F.lit(0)))
        return F.coalesce(other["x"] == p["x"], F.lit(False))

    many = F.sort_array(F.transform(F.filter("__q", lambda p, k: ((k > 0) & neighbour(p, k - 1)) | neighbour(p, k + 1)), lambda p: p["i"]))
    places = F.when(F.size("__2") > 64, many).otherwise(few)
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    chars, solid, upper, digits, symbols = (F.col(f"__{c}") for c in ("chars", "word_chars", "upper", "digits", "symbols"))
    counts = F.struct(
        F.col("__n").cast("long").alias("n_words"),
        solid.alias("word_chars"),
        symbols.alias("n_symbols"),
        F.col("__d").alias("n_dup_lines"),
        F.when(F.col("__s").isNull(), F.lit(0).cast("long")).otherwise(covered).alias("n_repeat_words"),
        chars.alias("chars"),
        F.array(solid - F.col("__rest"), upper, digits, chars - solid, symbols, F.col("__rest") - upper - digits - symbols).alias("classes"),
        F.transform("__h", lambda p, i: (F.coalesce(F.get("__h", i + 1), F.col("__m")) - p - 1).cast("long")).alias("words"),
        _own_words().alias("own_words"),
    )
    return split.select(*docs.columns, counts.alias("__p"))


def _frequent() -> Column:
    """The places of ``__o`` where a word with a letter stands that stands ``__k`` - 1 places on, too."""
    begins = F.filter("__o", lambda w, i: F.coalesce(F.get("__o", i + F.col("__k") - 1) == w, F.lit(False)))
    return F.filter(begins, lambda w: w.rlike(r"\p{L}"))


def _own_words() -> Column:
    """Number of words that are frequent in the text: each three times and a hundredth of it at least."""
    # A word of n >= k places begins n - k + 1 stretches of k.
    return F.when(F.col("__b").isNull(), 0).otherwise(F.size("__b") + F.size(F.array_distinct("__b")) * (F.col("__k") - 1)).cast("long")


def base_failed(p: str = "__p") -> Column:
    return (F.col(f"{p}.n_words") < 50) | (100 * F.col(f"{p}.n_repeat_words") > 50 * F.col(f"{p}.n_words"))


def references(profiles: DataFrame) -> list[tuple[list[float], list[float]]]:
    """Histograms of the languages with a word list, over their documents that pass the base rule: at most one row for each list."""
    known = profiles.filter(F.col("lang").isin(sorted(COMMON_WORDS)) & ~base_failed())
    sums = [F.sum(F.get("__p.classes", F.lit(i))) for i in range(6)] + [F.sum("__p.n_words")]
    sums += [F.sum(F.get("__p.words", F.lit(i))) for i in range(len(ALL_WORDS))]
    out = []
    for row in known.groupBy("lang").agg(*sums).orderBy("lang").collect():
        classes, n, words = row[1:7], row[7], row[8:]
        if n and sum(classes):
            out.append(([c / sum(classes) for c in classes], [w / n for w in words] + [max(0, n - sum(words)) / n]))
    return out


def _shares(counts: str, total: Column, rest: bool) -> Column:
    whole = F.greatest(total, F.lit(1)).cast("double")
    shares = F.transform(counts, lambda c: c / whole)
    if rest:
        known = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
        shares = F.concat(shares, F.array(F.greatest(total - known, F.lit(0)) / whole))
    return shares


def divergence(p: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance (square root of the base-2 divergence) of a histogram column to a fixed one."""

    def term(x, y):
        middle = (x + y) / 2
        return F.when(x > 0, x * F.log2(x / middle)).otherwise(0.0) + F.when(y > 0, y * F.log2(y / middle)).otherwise(0.0)

    terms = F.zip_with(p, F.lit(reference), term)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def bare_distance(reference: list[float]) -> float:
    """The distance of a text without any listed word to a reference of common words."""
    rest = reference[-1]
    return math.sqrt(max(0.0, (1 - rest + math.log2(2 / (1 + rest)) + (rest * math.log2(2 * rest / (1 + rest)) if rest else 0.0)) / 2))


def judge(profiles: DataFrame, known: list[tuple[list[float], list[float]]]) -> DataFrame:
    """Add class_distance and word_distance (to the nearest reference, NULL if not judged), base_failed and kept.

    A reference without a listed word says nothing on common words.
    """
    total = F.aggregate("__p.classes", F.lit(0).cast("long"), lambda a, c: a + c)
    shaped = pinned(profiles, __cs=_shares("__p.classes", total, False), __ws=_shares("__p.words", F.col("__p.n_words"), True))

    def nearest(each):
        return F.lit(None).cast("double") if not each else each[0] if len(each) == 1 else F.least(*each)

    by_class = F.when(F.col("__p.chars") >= LEAST_CHARS, nearest([divergence(F.col("__cs"), classes) for classes, _ in known]))
    bare = [(words, bare_distance(words)) for _, words in known if words[-1] < 1]
    prose = F.col("__p.own_words") >= LEAST_OWN_SHARE * F.col("__p.n_words")
    by_word = F.when((F.col("__p.n_words") >= LEAST_WORDS) & ~prose, nearest([divergence(F.col("__ws"), words) * (BARE_DISTANCE / most) for words, most in bare]))
    judged = pinned(shaped, class_distance=by_class, word_distance=by_word, base_failed=base_failed()).drop("__cs", "__ws")
    fits = (F.coalesce("class_distance", F.lit(0.0)) <= MOST_CLASS_DISTANCE) & (F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORD_DISTANCE)
    return judged.withColumn("kept", ~F.col("base_failed") & fits)


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, both distances and kept.

    A NULL text counts as empty: no words, so the base rule fails it. Documents of a NULL or unlisted language add
    nothing to the references but are judged like all others, by the nearest reference, in their characters; in their words only
    if they have hardly any frequent word, as lists and noise have. Without any reference (an empty table, or no listed
    language) the distances are NULL and the base rule decides alone. Repeated rows are judged apart.
    """
    profiles = materialize(profile(docs.select("doc_id", "lang", "text")).drop("text"))
    judged = judge(profiles, references(profiles))
    counts = [F.col(f"__p.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "class_distance", "word_distance", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, all columns. Each text is profiled once; the profiles are written with the rows."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "lang", "text")
    profiles = materialize(profile(rows).select("row", "lang", "__p"))
    return judge(profiles, references(profiles)).filter("kept").select([F.col(f"row.`{c}`") for c in names])
