"""Secret scans: base patterns in every text, and candidates judged by who else holds them.

Beside the base patterns, which stand on their own, wider patterns propose candidates. A candidate's value is hashed, and its
hash is counted over the whole corpus: in how many repositories and for how many owners it occurs. A value that many owners
hold was copied from a common example; one that few owners hold, in a live-looking form, is a credential of its owner.

Texts are scanned once, where they lie; candidates go on as hashes without their texts. Counts go through distinct (hash,
owner, repository) and (hash, owner) rows, combined before each shuffle, so a value in a third of all rows is no hot key. To bring
the verdicts back, hashes with more than a thousandth of all candidates (at most a thousand of them) are broadcast and
the others joined, so no hash brings more than that to one task.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.session import materialize

# The base patterns, in the order in which kinds with one start are listed, and the fewest characters of each.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"(AKIA[A-Z0-9]+)", 20),
    ("hex", r"([0-9a-f]+)", 24),
)

# Wider patterns whose matches are only candidates; the value is group 1.
WIDER = (
    ("issued", r"\b((?:gh[oprsu]_|glpat-|sk_live_|xox[abprs]-|AIza)[A-Za-z0-9_-]{16,})"),
    ("bearer", r"\b[Bb]earer\x20+([A-Za-z0-9._~+/-]{16,}=*)"),
    ("jwt", r"\b(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)"),
    ("login", r"://[A-Za-z0-9._~-]+:([A-Za-z0-9._~!$&*+=-]{6,})@"),
    ("quoted", r"""["']([A-Za-z0-9+/_=-]{20,})["']"""),
)
KINDS = [kind for kind, *_ in (*BASE, *WIDER)]

# Words of values that are written to be replaced.
PLACEHOLDERS = ("example", "sample", "placeholder", "changeme", "dummy", "your", "test", "xxxx", "1234567")

#: A text without a match of this has neither a base match nor a candidate.
SIGN = "|".join(
    [r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "AKIA[A-Z0-9]{16}", "[0-9a-f]{24}", *(p.replace(r"\b", "") for _, p in WIDER)]
)

SPAN = "struct<kind: int, start: int, end: int, value: string>"


def _base_spans(text: str, compiled) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value): leftmost matches that do not overlap others of their kind; short values go."""
    found = []
    for kind, (pattern, least) in enumerate(compiled):
        for m in pattern.finditer(text):
            if len(m[1]) >= least:
                found.append((kind, m.start(), m.end(), m[1]))
    return found


def _wider_spans(text: str, compiled, base) -> list[tuple[int, int, int, str]]:
    """Values of the wider patterns that touch no base match; of two that overlap the earlier pattern's."""
    taken = sorted((s, e) for _, s, e, _ in base)
    found = []
    for kind, pattern in enumerate(compiled, len(BASE)):
        own = _apart([(kind, *m.span(1), m[1]) for m in pattern.finditer(text)], taken)
        found += own
        taken = sorted(taken + [(s, e) for _, s, e, _ in own])
    return found


def _apart(spans, taken):
    """The spans that touch none of ``taken``; both are in order, so each is read once."""
    free, at, until = [], 0, -1
    for x in spans:
        while at < len(taken) and taken[at][0] < x[2]:
            until = max(until, taken[at][1])
            at += 1
        if until <= x[1]:
            free.append(x)
    return free


def scan(docs: DataFrame, owner: str, repository: str) -> DataFrame:
    """doc_id, owner, repository and ``spans`` (kind, start, end, value) of every row; places in code points.

    The rows are those of ``docs``; texts do not go on.
    """

    def find(batches):
        # Runs of hex digits under the least length need not be visited.
        base = [(re.compile(p.replace("[0-9a-f]+", f"[0-9a-f]{{{least},}}"), re.ASCII), least) for _, p, least in BASE]
        wider = [re.compile(p, re.ASCII) for _, p in WIDER]
        for batch in batches:
            signs = pc.fill_null(pc.match_substring_regex(batch.column("text"), SIGN), False).to_pylist()
            texts = batch.column("text").cast(pa.binary())
            offsets, flat = [0], []
            for k, sign in enumerate(signs):
                if sign:
                    text = texts[k].as_py().decode("utf-8", "replace")
                    own = _base_spans(text, base)
                    flat += own + _wider_spans(text, wider, own)
                offsets.append(len(flat))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*flat) if flat else ((),) * 4, kinds)]
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(columns, ["kind", "start", "end", "value"]))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), spans], ["doc_id", "owner", "repository", "spans"])

    source = docs.select("doc_id", F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"), "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(find, f"doc_id {kind}, owner string, repository string, spans array<{SPAN}>")


def looks_live(value: Column) -> Column:
    """A value of 10 different characters or more, with letters and at least two digits, without a placeholder's words."""
    lowered = F.lower(value)
    placeholder = F.lit(False)
    for word in PLACEHOLDERS:
        placeholder = placeholder | F.contains(lowered, F.lit(word))
    different = F.size(F.array_distinct(F.split(value, "")))
    return (different >= 10) & value.rlike("[A-Za-z]") & value.rlike("[0-9].*[0-9]") & ~placeholder


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_rows, n_owners, n_repositories) of candidates (hash, owner, repository); NULL is an owner like others."""
    repositories = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owners = repositories.groupBy("hash", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    return owners.groupBy("hash").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_owners"), F.sum("r").alias("n_repositories"))


def with_verdicts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """The candidates with the counts of their hash."""
    total = counts.agg(F.sum("n_rows")).first()[0] or 0
    often = F.col("n_rows") * 1000 > total  # under a thousand hashes, whatever the input
    hot = counts.filter(often).select("hash", F.struct("n_rows", "n_owners", "n_repositories").alias("hot"))
    joined = materialize(candidates.join(F.broadcast(hot), "hash", "left"))
    names = [c for c in joined.columns if c != "hot"]
    first = joined.filter("hot IS NOT NULL").select(*names, "hot.*")
    return first.unionByName(joined.filter("hot IS NULL").select(*names).join(counts.filter(~often), "hash").select(*names, "n_rows", "n_owners", "n_repositories"))


def scan_secrets(
    docs: DataFrame, owner: str = "source", repository: str = "doc_id", most_owners: int = 2, most_repositories: int = 20
) -> DataFrame:
    """doc_id and ``spans`` of every row of ``docs``.

    A span holds kind, start, end (code points, end exclusive), hash (SHA-256 of the value), n_owners, n_repositories, live and
    base. All base matches are there. Of the wider patterns' matches only those that are live: they look so (``looks_live``), at
    most ``most_owners`` owners hold the value, in at most ``most_repositories`` repositories (an owner's repositories have
    names of their own). ``live`` is told of base matches too. Spans are in the order of start, then kind.

    A NULL text is empty. NULL owners or repositories count as one. Ids may be NULL or repeated; each row has an answer of
    its own. Other columns are not looked at. An empty table gives no rows.
    """
    # Numbered while it is written, so a row has one number however often it is read.
    found = materialize(scan(docs, owner, repository).withColumn("row", F.monotonically_increasing_id()))
    busy = found.filter(F.size("spans") > 0)
    single = busy.select("row", "owner", "repository", F.explode("spans").alias("s"))
    single = single.select("row", "owner", "repository", "s.kind", "s.start", "s.end", "s.value", F.sha2("s.value", 256).alias("hash"))
    single = single.withColumn("looks", looks_live(F.col("value"))).drop("value")
    single = materialize(single)
    counts = materialize(ownership(single))
    judged = with_verdicts(single.drop("owner", "repository"), counts)
    live = F.col("looks") & (F.col("n_owners") <= most_owners) & (F.col("n_repositories") <= most_repositories)
    base = F.col("kind") < len(BASE)
    kept = judged.withColumn("live", live).withColumn("base", base).filter("live OR base")
    span = F.struct("start", "kind", "end", "hash", "n_owners", "n_repositories", "live", "base")
    spans = kept.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    names = F.array(*[F.lit(k) for k in KINDS])
    told = F.transform(
        F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)),
        lambda s: F.struct(
            F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["hash"].alias("hash"),
            s["n_owners"].alias("n_owners"), s["n_repositories"].alias("n_repositories"), s["live"].alias("live"), s["base"].alias("base"),
        ),
    )
    listed = busy.select("row", "doc_id").join(spans, "row", "left")
    none = found.filter(F.size("spans") == 0).select("row", "doc_id", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return listed.unionByName(none).select("doc_id", told.alias("spans"))
