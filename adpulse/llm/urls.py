"""URL filtering by rules that are indexed by their rarest literal token.

Every rule is a regular expression over host + path with the literal tokens any matching url must contain. The tokens of
all rules are counted over all urls; each rule is filed under its rarest one. A url's tokens fetch the rules filed under
them, by a join, and only these rules' expressions run. Rules without a literal token are fetched by every url.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The rule table is broadcast; beyond this it is joined by a shuffle.
MAX_BROADCAST_RULES = 20_000
ANY = ""


@dataclass(frozen=True)
class Rule:
    """``pattern``: Java regular expression, searched in host + path. ``literals``: texts that any match contains as
    whole tokens (a token is a run of a-z and 0-9, after lower-casing). Rules of a higher ``tier`` go first, then
    longer names, then names in order."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    tier: int = 0

    @property
    def tokens(self) -> list[str]:
        found = {token for text in self.literals for token in re.findall("[a-z0-9]+", text.lower())}
        return sorted(found) or [ANY]


def site_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    # The end of the path may lie within a token, so that only what stands before it is sure to be whole.
    whole = re.match(r"(?s)(.*[^A-Za-z0-9])?", path)[0] if path else path
    pattern = r"^(?:[^/]*\.)?" + _quoted(host) + ("" if path.startswith("/") else "(?=/|$)") + _quoted(path)
    return Rule(host + path, verdict, pattern, (host, whole), tier=1)


def host_word_rule(verdict: str, words: str) -> Rule:
    """Fits hosts that contain the words, joined by hyphens, between dots or hyphens."""
    return Rule(f"host:{words}", verdict, r"^[^/]*(?<![a-z0-9])" + _quoted(words) + r"(?![a-z0-9])", (words,))


def _quoted(text: str) -> str:
    return "".join(c if re.fullmatch("[A-Za-z0-9/_-]", c) else f"\\x{{{ord(c):x}}}" for c in text)


# The rules a caller named.
SITE_RULES = (
    site_rule("allow", "com", "/"),
    site_rule("block", "example.com", "/en/"),
    site_rule("allow", "www.example.com", "/en/"),
    site_rule("block", "net", "/es/"),
    site_rule("block", "net", "/fr/"),
)
# What decides where no named rule fits.
HOST_WORDS = (
    "adult", "porn", "xxx", "casino", "betting", "pills", "viagra", "payday", "warez", "spam", "ads", "ad-track", "adserver",
)
GENERAL_RULES = tuple(host_word_rule("block", words) for words in HOST_WORDS)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://`` or url."""
    host = F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def _tokens(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))


def rule_index(spark: SparkSession, urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its rarest token: counted over the whole column ``tokens`` of ``urls``."""
    table = spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, r.tier, r.tokens) for r in rules],
        "rule string, verdict string, pattern string, tier int, literals array<string>",
    ).withColumn("literal", F.explode("literals"))
    literals = sized(table.select("literal").distinct(), len(rules))
    counts = (
        urls.select(F.explode("tokens").alias("literal"))
        .join(literals, "literal", "left_semi")
        .groupBy("literal")
        .agg(F.count(F.lit(1)).alias("n_urls"))
    )
    rarity = F.struct(F.coalesce("n_urls", F.lit(0)).alias("n_urls"), "literal")
    return (
        table.join(counts, "literal", "left")
        .groupBy("rule", "verdict", "pattern", "tier")
        .agg(F.min(rarity)["literal"].alias("token"))
    )


def sized(rules: DataFrame, count: int) -> DataFrame:
    return F.broadcast(rules) if count <= MAX_BROADCAST_RULES else rules


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = SITE_RULES + GENERAL_RULES, default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule, verdict, matched of every row of ``pages`` (page_id, url).

    Of the rules that fit, the highest tier wins, then the longest name, then the first name; ``matched`` names it.
    ``rule`` is null unless it is a named (tier 1) rule; without any match the verdict is ``default``. A null url or
    one without ``://`` has an empty host and path. Rows alike in page_id and url are all returned.
    """
    if len({rule.name for rule in rules}) < len(rules):
        raise ValueError("rule names must differ")
    subject = F.concat("host", "path")
    parsed = pages.select(
        F.col("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("tokens", _tokens(subject))
    index = rule_index(pages.sparkSession, parsed, rules)
    # A url is judged once however many pages have it.
    urls = parsed.select("host", "path", "tokens").distinct()
    fetched = urls.select("host", "path", F.explode(F.concat("tokens", F.array(F.lit(ANY)))).alias("token"))
    best = (
        fetched.join(sized(index, len(rules)), "token")
        .where(F.regexp_like(subject, F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.max(F.struct("tier", F.length("rule").alias("size"), "rule", "verdict")).alias("best"))
    )
    return parsed.join(best, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.tier") > 0, F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.col("best.rule").alias("matched"),
    )
