"""Replace personal data by keyed surrogates of the same kind.

Mentions are found by one regular expression (its alternatives are the kinds, in order). A mention has a canonical form - an
e-mail in lower case, a number's digits, a name without title - and a surrogate stream hashed from the key, the
kind and that form, so all mentions of an entity, in any document and format, get the same surrogate (coreference). The
surrogate is written in the mention's format: digits for digits, letters of the same script and case for letters, separators,
titles and top-level domains as they are, valid octets, given names of the title's gender.

Distinctness is checked on the table of all different entities: where two entities share a surrogate, or a surrogate is a real
entity, all but one (or the one) draw again, until no clash is left. Texts without a sign of a mention never move; the others are
joined with their surrogates by the MD5 of the text. Everything is a built-in expression.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import pinned
from tierflow.session import materialize

# Titles and names.
TITLES_F = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Madame", "Señora", "Sra", "Госпожа")
TITLES_M = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
ASSIGNED = ("token", "TOKEN", "secret", "SECRET", "password", "PASSWORD", "api_key", "API_KEY")
GIVEN = {
    "f": ("Anna", "Clara", "Elena", "Emma", "Julia", "Laura", "Lea", "Maria", "Nora", "Olga", "Paula", "Rita", "Sara", "Sofia", "Vera", "Zoe"),
    "m": ("Adam", "Bruno", "Carlos", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Marco", "Noah", "Oscar", "Paul", "Tom", "Victor"),
    "cyrillic f": ("Анна", "Вера", "Елена", "Ирина", "Мария", "Нина", "Ольга", "Юлия"),
    "cyrillic m": ("Антон", "Борис", "Иван", "Максим", "Олег", "Павел", "Роман", "Юрий"),
}
SYLLABLES = ("ba", "be", "bo", "da", "de", "do", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "ra", "re", "ro", "ta", "te", "to")
CYRILLIC_SYLLABLES = ("ба", "бе", "бо", "да", "де", "до", "ка", "ке", "ко", "ла", "ле", "ло", "ма", "ме", "мо", "на", "не", "но", "ра", "ре", "ро", "та", "те", "то")

_EDGE = r"(?<![\p{L}\p{N}])"
_END = r"(?![\p{L}\p{N}])"
# A capital and more letters; inner capitals, apostrophes and hyphens belong to a name.
_NAME = r"\p{Lu}(?:['’-]?[\p{L}\p{M}])++"
#: Kinds in the order in which they are tried. No alternative starts inside a word, and all repeats are bounded or
#: possessive, so the search is linear in the text. Nothing that may be long has an upper bound.
KINDS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "secret": _EDGE + r"(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}+" + _END + r"|(?<=(?:" + "|".join(ASSIGNED) + r") ?[=:] ?\")[^\"\s]{8,}+(?=\")",
    "ip": r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "phone": r"(?<![\p{L}\p{N}])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,3}(?!\d)|(?<![\p{L}\p{N}+.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.])\d(?:[ -]?\d){12,18}(?!\d)",
    "name": _EDGE + "(?:" + "|".join(TITLES_F + TITLES_M) + r")\.? " + _NAME + "(?: " + _NAME + ")?" + _END,
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
_TITLE = "^(?:" + "|".join(TITLES_F + TITLES_M) + r")\.? "
_BLOCKS = 8  # of SHA-256 in a stream: 256 values


def may_hold_mentions(text: Column) -> Column:
    """True for every text with a mention, and cheap: each kind holds a digit, an @, a title or the name of an assigned secret."""
    signs = [text.contains(x) for x in ("@", *TITLES_F, *TITLES_M, *ASSIGNED)]
    return reduce(lambda a, b: a | b, signs, text.rlike("[0-9]"))


def kind_of(mention: Column) -> Column:
    """The kind of a mention, with the gender for names."""
    out = F.lit("card")
    for kind in ("name", "phone", "ip", "secret", "email"):
        test = {"name": _TITLE, "phone": r"^\+|^\(|^\d{3}[ .-]\d{3}[ .-]\d{4}$", "ip": r"^\d{1,3}(\.\d{1,3}){3}$", "secret": r"^[0-9A-Fa-f]{32,}$|^[^ ()+.-]*[^\d ()+.@-][^ ]*$", "email": "@"}[kind]
        value = F.when(mention.rlike("^(?:" + "|".join(TITLES_F) + r")\.? "), "name f").otherwise("name m") if kind == "name" else F.lit(kind)
        out = F.when(mention.rlike(test), value).otherwise(out)
    return out


def canonical(mention: Column, kind: Column) -> Column:
    digits = F.regexp_replace(mention, r"[^\d]", "")
    return (
        F.when(kind.isin("phone", "card"), digits)
        .when(kind.startswith("name"), F.lower(F.regexp_replace(mention, _TITLE, "")))
        .otherwise(F.lower(mention))
    )


def _stream(key: Column) -> Column:
    """512 hex digits from the key, the kind, the canonical form and the attempt."""
    return F.concat(*[F.sha2(F.concat_ws("\x1f", key, F.col("kind"), F.col("canon"), F.col("attempt").cast("string"), F.lit(str(k))).cast("binary"), 256) for k in range(_BLOCKS)])


def _value(at: Column) -> Column:
    """The byte of ``__stream`` at a place (from 0, wrapping)."""
    return F.conv(F.substr(F.col("__stream"), (F.pmod(at, F.lit(32 * _BLOCKS)) * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _pick(values, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (_value(at) % len(values) + 1).cast("int"))


def _spelled(form: str) -> Column:
    """Letters and digits of ``form`` replaced one by one; a letter's or digit's number among them picks the value."""
    text = F.col(form)
    tail = F.when(F.col("kind") == "email", F.regexp_extract(text, r"\.[^.]*$", 0)).otherwise("")
    head = F.substr(text, F.lit(1), F.length(text) - F.length(tail))

    def one(c, i):
        v = _value(i + 1)

        def letter(first: str, size):
            return F.char(F.lit(ord(first)) + v % size) if ord(first) < 256 else F.substr(F.lit("абвгдежзиклмнопрстуфхцчшщэюя" if first == "а" else "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ"), v % 28 + 1, F.lit(1))

        size = F.when(F.col("__hexadecimal"), 6).otherwise(26)
        return (
            F.when(c.rlike("[0-9]"), F.char(F.lit(48) + v % 10))
            .when(c.rlike(r"[\p{IsCyrillic}&&\p{Lu}]"), letter("А", 28))
            .when(c.rlike(r"\p{IsCyrillic}"), letter("а", 28))
            .when(c.rlike(r"\p{Lu}"), letter("A", size))
            .when(c.rlike(r"\p{L}"), letter("a", size))
            .otherwise(c)
        )

    # Cut at each letter and digit, so that the work follows the length of the mention and not its square.
    spelled = r"[\p{L}\p{N}\p{IsCyrillic}]"
    values = F.transform(F.regexp_extract_all(head, F.lit(spelled), F.lit(0)), one)
    replaced = F.array_join(F.flatten(F.zip_with(F.split(head, spelled, -1), values, lambda p, x: F.array(p, F.coalesce(x, F.lit(""))))), "")
    # Characters more, where the form's own are too few for all entities: letters in front, digits behind.
    more = F.filter(F.sequence(F.lit(0), F.col("extra")), lambda k: k > 0)
    digits = F.array_join(F.transform(more, lambda k: F.char(F.lit(48) + _value(k + 128) % 10)), "")
    letters = F.array_join(F.transform(more, lambda k: F.char(F.lit(97) + _value(k + 128) % F.when(F.col("__hexadecimal"), 6).otherwise(26))), "")
    numeric = F.col("kind").isin("phone", "card")
    return F.concat(F.when(numeric, "").otherwise(letters), replaced, F.when(numeric, digits).otherwise(""), tail)


def _named(form: str) -> Column:
    """Title, a given name of the gender if the mention has two names, and a family name of syllables."""
    text = F.col(form)
    cyrillic = text.rlike(r"\p{IsCyrillic}")
    woman = F.col("kind") == "name f"
    given = F.when(cyrillic, F.when(woman, _pick(GIVEN["cyrillic f"], F.lit(0))).otherwise(_pick(GIVEN["cyrillic m"], F.lit(0))))
    given = F.coalesce(given, F.when(woman, _pick(GIVEN["f"], F.lit(0))).otherwise(_pick(GIVEN["m"], F.lit(0))))
    count = F.sequence(F.lit(1), F.lit(3) + F.col("attempt"))
    family = F.initcap(F.array_join(F.transform(count, lambda k: F.when(cyrillic, _pick(CYRILLIC_SYLLABLES, k)).otherwise(_pick(SYLLABLES, k))), ""))
    bare = F.regexp_replace(text, _TITLE, "")
    return F.concat(F.regexp_extract(text, _TITLE, 0), F.when(bare.contains(" "), F.concat(given, F.lit(" "))).otherwise(""), family)


def _octets() -> Column:
    return F.concat_ws(".", *[(_value(F.lit(k)) % 254 + 1).cast("string") for k in range(4)])


def rendered(df: DataFrame, form: str, key: Column) -> DataFrame:
    """Add ``surrogate``: ``form`` (a mention or a canonical form) in the surrogate of (kind, canon, attempt, extra)."""
    hexadecimal = (F.col("kind") == "secret") & F.col(form).rlike("^[0-9A-Fa-f]+$")
    streamed = pinned(df, __stream=_stream(key), __hexadecimal=hexadecimal)
    value = F.when(F.col("kind").startswith("name"), _named(form)).when(F.col("kind") == "ip", _octets()).otherwise(_spelled(form))
    return streamed.withColumn("surrogate", value).drop("__stream", "__hexadecimal")


def with_room(entities: DataFrame) -> DataFrame:
    """Add ``extra``: how many characters longer surrogates of this form must be to be four times as many as its entities.

    A form is what a surrogate keeps: kind, separators, which places are letters and digits, an e-mail's last label.
    """
    canon = F.col("canon")
    tail = F.when(F.col("kind") == "email", F.regexp_extract(canon, r"\.[^.]*$", 0)).otherwise("")
    head = F.substr(canon, F.lit(1), F.length(canon) - F.length(tail))
    shape = F.concat(F.regexp_replace(F.regexp_replace(head, r"[0-9]", "9"), r"\p{L}", "a"), tail)
    letter = F.when((F.col("kind") == "secret") & canon.rlike("^[0-9A-Fa-f]+$"), 6.0).otherwise(26.0)
    forms = F.length(F.regexp_replace(head, r"[^0-9]", "")) + F.length(F.regexp_replace(head, r"\P{L}", "")) * F.log10(letter)
    spelled = F.col("kind").isin("email", "secret", "phone", "card")
    sized = entities.select("*", F.when(spelled, shape).alias("__shape"), letter.alias("__letter"), forms.alias("__forms"))
    more = F.when(F.col("kind").isin("phone", "card"), 1.0).otherwise(F.log10("__letter"))
    counted = sized.groupBy("kind", "__shape", "__letter", "__forms").agg(F.count("*").alias("n")).filter("__shape is not null")
    counted = counted.withColumn("extra", F.ceil((F.log10(4.0 * F.col("n")) - F.col("__forms")) / more).cast("int")).filter("extra > 0")
    # Few forms are that short; the others stay as they are.
    crowded = materialize(counted.select("kind", "__shape", "__letter", "extra"))
    joined = sized.join(crowded, ["kind", "__shape", "__letter"], "left")
    return joined.select("kind", "canon", F.coalesce("extra", F.lit(0)).alias("extra"))


def distinct_surrogates(entities: DataFrame, key: Column) -> DataFrame:
    """(kind, canon) -> attempt and extra, so that no two entities share a surrogate and no surrogate is an entity.

    Every form has several times as many surrogates as entities, so few draw again each round and none draws for ever.
    """
    state = materialize(with_room(entities)).withColumn("attempt", F.lit(0))
    while True:
        drawn = materialize(rendered(state, "canon", key).withColumn("surrogate", F.lower("surrogate")))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("first"))
        real = drawn.select("kind", F.col("canon").alias("surrogate"), F.lit(True).alias("real"))
        judged = drawn.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        clash = (F.col("canon") != F.col("first")) | F.col("real").isNotNull()
        judged = judged.select("kind", "canon", "attempt", "extra", clash.alias("clash"))
        if judged.filter("clash").isEmpty():
            return drawn.select("kind", "canon", "attempt", "extra")
        state = materialize(judged.select("kind", "canon", "extra", (F.col("attempt") + F.col("clash").cast("int")).alias("attempt")))


def replace_personal_data(docs: DataFrame, key: Column) -> DataFrame:
    """doc_id, text with surrogates, n_entities (mentions replaced) of every document.

    ``key`` is a column, so that it may come from a secret function; the same key gives the same surrogates in every run
    over the same entities. NULL texts stay NULL with no entity; texts without a mention stay as they are. Copies of a
    text get equal results. Ids are not used, so they may be NULL or repeated.
    """
    given = docs.select("doc_id", "text")
    hits = F.regexp_extract_all(F.col("text"), F.lit(PATTERN), F.lit(0))
    maybe = F.coalesce(may_hold_mentions(F.col("text")), F.lit(False))
    text_key = F.md5(F.encode("text", "UTF-8"))
    looked_at = given.filter(maybe).withColumn("text_key", text_key)
    mentions = looked_at.select("text_key", F.explode(F.array_distinct(hits)).alias("mention")).distinct()
    mentions = materialize(mentions)
    kinds = mentions.select("mention").distinct().withColumn("kind", kind_of(F.col("mention"))).withColumn("canon", canonical(F.col("mention"), F.col("kind")))
    kinds = materialize(kinds)
    attempts = distinct_surrogates(kinds.select("kind", "canon").distinct(), key)
    surrogates = rendered(kinds.join(attempts, ["kind", "canon"]), "mention", key).select("mention", "surrogate")
    maps = mentions.join(surrogates, "mention").groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("mention", "surrogate"))).alias("map"))
    # The texts without a map have no mention: only the others are cut again.
    joined = looked_at.hint("merge").join(maps, "text_key", "left")
    held = F.col("map").isNotNull()
    shaped = pinned(joined, __pieces=F.when(held, F.split(F.col("text"), PATTERN, -1)), __hits=F.when(held, hits))
    whole = F.array_join(F.flatten(F.zip_with("__pieces", "__hits", lambda p, h: F.array(p, F.coalesce(F.element_at("map", h), F.lit(""))))), "")
    changed = shaped.select("doc_id", F.when(held, whole).otherwise(F.col("text")).alias("text"), F.when(held, F.size("__hits")).otherwise(0).cast("long").alias("n_entities"))
    same = given.filter(~maybe).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"))
    return changed.unionByName(same)
