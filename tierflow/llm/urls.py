"""URL rules: host and path rules, and pattern rules indexed by their rarest literal token.

A pattern rule names the literal tokens (runs of letters and digits, lower case) that every match holds. Tokens are counted
over all URLs; each rule is filed under its rarest one. A URL's tokens fetch the candidate rules, and only these run their
regular expression. A rule without a literal token is a candidate for every URL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class PathRule:
    """Fits a host, all its subdomains, and paths with the prefix."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased URL; every match holds all ``tokens`` as whole tokens."""

    pattern: str
    tokens: tuple[str, ...]


PATH_RULES = (
    PathRule("com", "/", "allow"),
    PathRule("example.com", "/en/", "block"),
    PathRule("www.example.com", "/en/", "allow"),
    PathRule("net", "/es/", "block"),
    PathRule("net", "/fr/", "block"),
)

PATTERN_RULES = (
    PatternRule(r"://([a-z0-9-]+\.)*spam-farm\.", ("spam", "farm")),
    PatternRule(r"://([a-z0-9-]+\.)*(free-)?casino-[a-z0-9-]+\.", ("casino",)),
    PatternRule(r"[/.-]adult-(video|chat)s?\b", ("adult",)),
    PatternRule(r"://([a-z0-9-]+\.)*link-exchange\.", ("link", "exchange")),
    PatternRule(r"/buy-cheap-[a-z]+", ("buy", "cheap")),
    PatternRule(r"/wp-login\.php", ("wp", "login")),
    PatternRule(r"[?&]affid=[0-9]+", ("affid",)),
    PatternRule(r"://([a-z0-9-]+\.)*click-bait\.", ("click", "bait")),
    PatternRule(r"/cgi-bin/[a-z]+\.cgi", ("cgi", "bin")),
    PatternRule(r"[?&]sessionid=[0-9a-f]{16,}", ("sessionid",)),
)


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for NULL or without ://."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ? or # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def path_rule(host: Column, path: Column, rules: Sequence[PathRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; NULL if none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name, verdict = F.when(fits, rule.name).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def token_counts(urls: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many URLs each of ``tokens`` stands; one row for each listed token that occurs."""
    held = F.array_distinct(F.split(F.lower("url"), "[^a-z0-9]+"))
    found = urls.select(F.explode(F.filter(held, lambda t: t.isin(list(tokens)))).alias("token"))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


class RuleIndex:
    """Rules by rarest token."""

    def __init__(self, rules: Sequence[PatternRule], counts: dict[str, int]):
        self.by_token: dict[str, list[re.Pattern]] = {}
        self.always: list[re.Pattern] = []
        for rule in rules:
            compiled = re.compile(rule.pattern)
            if rule.tokens:
                rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(compiled)
            else:
                self.always.append(compiled)

    def matches(self, url: str | None) -> bool:
        if not url:
            return False
        url = url.lower()
        if any(p.search(url) for p in self.always):
            return True
        known = self.by_token
        return any(p.search(url) for token in TOKEN.findall(url) if token in known for p in known[token])


def filter_urls(pages: DataFrame, path_rules: Sequence[PathRule] = PATH_RULES, patterns: Sequence[PatternRule] = PATTERN_RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and matched (by a pattern rule) of every page.

    The longest host and path rule decides; without one, a pattern rule that matches blocks, and all else is allowed. A NULL
    or empty URL has an empty host and path and is allowed. Rows are judged one by one; only page_id and url are read.
    """
    urls = pages.select("page_id", "url")
    counts = token_counts(urls, sorted({t for r in patterns for t in r.tokens})) if patterns else {}
    index = pages.sparkSession.sparkContext.broadcast((tuple(patterns), counts))

    def judge(frames):
        rules = RuleIndex(*index.value)
        for frame in frames:
            frame["matched"] = pd.Series([rules.matches(u) for u in frame["url"]], dtype=bool)
            yield frame

    kind = urls.schema["page_id"].dataType.simpleString()
    judged = urls.mapInPandas(judge, f"page_id {kind}, url string, matched boolean")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = path_rule(host, path, path_rules)
    own = F.when(F.col("matched"), "block").otherwise("allow")
    return judged.select("page_id", host.alias("host"), path.alias("path"), name.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "matched")
