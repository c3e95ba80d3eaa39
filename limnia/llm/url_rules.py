"""URL filters: pattern rules found by their rarest literal token.

A rule is a pattern over host and path (or over all that follows ``://``): literal text, ``*``
for anything, ``^`` for a separator or the end, ``||`` at the front for the start of a host or
of one of its parent domains. Words of a pattern that stand whole in every URL it fits are its
tokens; of these, the one that is rarest in the URLs at hand files the rule. A URL's tokens
fetch candidate rules, and only these run their regular expressions. Rules without a token are
candidates for every URL.

Rules with ``decides`` come first: the longest that fits gives the verdict. Where none fits, the
URL is blocked if any other rule fits, and allowed otherwise.

The table of rules comes from a Python list, so its size is what the caller holds in memory.

Cases: a null URL, or one without ``://``, has empty host and path and no rule fits it; equal
URLs are judged once; an empty table gives no rows; other columns come through unchanged.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnia.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    pattern: str
    verdict: str
    decides: bool = False


def host_rule(rule: str, verdict: str) -> Rule:
    """A rule such as ``example.org/en/``: this host and its subdomains, paths that start so."""
    return Rule(f"||{rule}", verdict, True)


# The rules that the registered query decides by.
DECIDING = (
    host_rule("org/", "allow"),
    host_rule("example.org/es/", "block"),
    host_rule("example.org/en/1", "block"),
    host_rule("com/fr/", "allow"),
    host_rule("com/de/", "block"),
)

# What is blocked where no deciding rule fits: spam shops, gambling, adult pages, trackers, machine pages.
BLOCKING = tuple(
    Rule(p, "block")
    for p in (
        "^casino^", "^casinos^", "^bets^", "^betting^", "^poker^", "^slots^", "^lottery^", "^pills^", "^viagra^", "^pharmacy^",
        "^payday^loan", "^porn^", "^xxx^", "^escort^", "^warez^", "^torrent^", "^keygen^", "^doubleclick^", "^adserver^",
        "/wp-admin^", "/wp-login.php", "/cgi-bin/", "/login^", "/signin^", "/checkout^", "/cart^", "?*sessionid=", "/feed/rss^", ".exe^",
    )
)


def to_regex(pattern: str) -> str:
    """The regular expression of a pattern, in the syntax that Spark and other engines share."""
    out, rest = "", pattern
    if rest.startswith("||"):
        out, rest = "^([^/]*[.])?", rest[2:]
    for c in rest:
        out += {"*": ".*", "^": "([^a-zA-Z0-9]|$)" if out else "([^a-zA-Z0-9]|^)"}.get(c, c if c.isalnum() or c in "/-_=&" else f"[{c}]")
    return out


def tokens(pattern: str) -> list[str]:
    """Words that stand whole in every URL that fits."""
    anchored = pattern.startswith("||")
    text = pattern[2:] if anchored else pattern
    found = []
    for m in re.finditer("[a-zA-Z0-9]+", text):
        left = anchored if m.start() == 0 else text[m.start() - 1] != "*"
        right = m.end() < len(text) and text[m.end()] != "*"
        if left and right:
            found.append(m[0].lower())
    return sorted(set(found))


def host(url: Column) -> Column:
    after = F.substring_index(url, "://", 1)  # what stands before the first ://
    rest = F.substring(url, F.char_length(after) + 4, F.char_length(url))
    name = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.when(F.contains(url, F.lit("://")), name).otherwise("")


def after_host(url: Column) -> Column:
    """Path, query and fragment."""
    before = F.substring_index(url, "://", 1)
    rest = F.substring(url, F.char_length(before) + 4, F.char_length(url))
    return F.when(F.contains(url, F.lit("://")), F.regexp_replace(rest, "^[^/?#]*", "")).otherwise("")


def url_tokens(subject: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.translate(subject, UPPER, LOWER), "[^a-z0-9]+"), lambda t: t != ""))


def judge(pages: DataFrame, rules: tuple[Rule, ...], url_column: str = "url") -> DataFrame:
    """``pages`` with ``_host``, ``_path``, ``_rule`` (of a deciding rule) and ``_verdict``."""
    spark = pages.sparkSession
    url = F.col(url_column)
    rows = [
        (i, r.pattern.removeprefix("||"), r.verdict, r.decides, to_regex(r.pattern), tokens(r.pattern) or [""])
        for i, r in enumerate(rules)
    ]
    table = spark.createDataFrame(rows, "id int, rule string, verdict string, decides boolean, regex string, tokens array<string>")
    path = F.regexp_extract(after_host(url), "^[^?#]*", 0)
    parts = (host(url), path, after_host(url))
    urls = pages.select(url.alias("_url")).filter("_url IS NOT NULL").distinct()
    urls = urls.select("_url", *(p.alias(c) for p, c in zip(_on("_url"), ("host", "path", "after"), strict=True)))
    named = urls.select("_url", F.concat("host", "path").alias("page"), F.concat("host", "after").alias("whole"))

    # each rule is filed under its rarest token; as many rows as there are rules
    wanted = table.select("id", F.explode("tokens").alias("token"))
    seen = named.select(F.explode(url_tokens(F.col("whole"))).alias("token")).join(wanted.select("token").distinct(), "token")
    seen = seen.groupBy("token").count()
    rarest = F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), F.col("token"))).alias("token")
    # written, so that the planner knows its size when it chooses how to join it
    index = stored(wanted.join(seen, "token", "left").groupBy("id").agg(rarest).join(table.drop("tokens"), "id"))

    asked = named.select("*", F.explode(F.array_append(url_tokens(F.col("whole")), F.lit(""))).alias("token"))
    candidates = asked.join(index, "token")
    subject = F.when(F.col("decides"), F.col("page")).otherwise(F.translate("whole", UPPER, LOWER))
    fits = candidates.filter(F.regexp_like(subject, F.concat(F.lit("(?s)"), "regex")))  # a line feed is a character as any other
    best = F.max_by(F.struct("decides", "rule", "verdict"), F.struct("decides", F.char_length("rule"), F.col("rule")))
    hits = fits.groupBy("_url").agg(best.alias("_hit"))

    joined = pages.select(F.struct(*pages.columns).alias("_in"), url.alias("_key"), *(p.alias(c) for p, c in zip(parts, ("_host", "_path", "_after"), strict=True)))
    joined = joined.join(hits, F.col("_key") == F.col("_url"), "left")
    return joined.select(
        *(F.col("_in")[c].alias(c) for c in pages.columns),
        F.coalesce("_host", F.lit("")).alias("_host"),
        F.coalesce("_path", F.lit("")).alias("_path"),
        F.when(F.col("_hit.decides"), F.col("_hit.rule")).alias("_rule"),
        F.coalesce("_hit.verdict", F.lit("allow")).alias("_verdict"),
    )


def _on(column: str) -> tuple[Column, Column, Column]:
    url = F.col(column)
    return host(url), F.regexp_extract(after_host(url), "^[^?#]*", 0), after_host(url)
