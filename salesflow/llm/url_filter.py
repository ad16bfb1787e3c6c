"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` with the literal tokens
that every URL it fits must hold.  Tokens are counted over the URLs; each rule
is filed under its rarest token.  A URL is cut into tokens, the tokens fetch
the rules filed under them, and only those run their regular expressions.
DataFrame functions only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm._shared import ascii_lower, shared_table

#: The index is broadcast up to this many rules (a few hundred bytes each);
#: a larger one meets the URL tokens in a shuffled join.
BROADCAST_RULES = 20_000


class Rule(NamedTuple):
    """``listed`` rules (host and path) beat patterns; of the listed ones that
    fit a URL the longest wins, of the patterns an allow beats a block, then
    the longest wins.  ``tokens``: lower-case runs of [a-z0-9] that stand
    complete in every URL the rule fits."""

    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str
    listed: bool


def listed(name: str, verdict: str) -> Rule:
    """``host/path``: fits the host and its subdomains where the URL's path
    starts with the rule's.  The last token of the path counts only when a
    separator closes it, since the URL's may go on."""
    host, _, rest = name.partition("/")
    parts = re.findall(r"[a-z0-9]+", host)
    closed = re.findall(r"[a-z0-9]+(?=[^A-Za-z0-9])", ascii_lower_text(rest))
    return Rule(name, r"^(?:[^/]*\.)?" + re.escape(host) + re.escape("/" + rest), (*parts, *closed), verdict, True)


def pattern(text: str, verdict: str = "block") -> Rule:
    """``text`` matches anywhere in the lower-cased ``host + path``; its
    literal tokens must stand between separators (``*``: any characters)."""
    body = "".join(r"[^/]*" if c == "*" else re.escape(c) for c in text)
    whole = re.findall(r"[a-z0-9]+", text)
    loose = set(re.findall(r"\*([a-z0-9]+)|([a-z0-9]+)\*", text))
    cut = {x for pair in loose for x in pair if x}
    return Rule(text, r"(?:^|[^a-z0-9])" + body + r"(?:[^a-z0-9]|$)",
                tuple(x for x in whole if x not in cut), verdict, False)


def ascii_lower_text(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


#: Patterns of the method: where no listed rule fits, a match of one of these
#: decides; a URL that fits none is allowed.
PATTERNS = (pattern("casino"), pattern("free-bets"), pattern("cheap-pills"), pattern("porn"),
            pattern("xxx"), pattern("adult"), pattern("payday-loan*"), pattern("ads/banner*"),
            pattern("casino*/review", "allow"))

#: The listed rules of the page policy.
LISTED = (listed("net/", "block"), listed("example.net/en/", "allow"),
          listed("example.com/de/", "block"), listed("org/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased.  Path: then up to ``?``, ``#`` or the end.  Null, or without
    ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def tokens(c: Column) -> Column:
    """The distinct runs of [a-z0-9] of the lower-cased ``c``."""
    return F.array_distinct(F.filter(F.split(c, "[^a-z0-9]+"), lambda t: t != ""))


def judge_urls(pages: DataFrame, rules: Iterable[Rule] = (*LISTED, *PATTERNS), url_col: str = "url",
               id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """One row per page: ``id_col``, ``host``, ``path``, ``rule`` (the listed
    rule that decided, else null), ``pattern`` (the pattern that decided, else
    null), ``verdict``.

    Each distinct ``host + path`` is judged once, so copies of a URL cost one
    judgement and no task holds a popular host.  A null or malformed URL has
    empty parts, fits no rule and gets ``default``; an empty table gives no
    rows; equal pages give equal rows; rules of equal length tie by name.
    """
    spark = pages.sparkSession
    rules = list(rules)
    if any(not r.tokens for r in rules):
        raise ValueError("every rule needs a literal token")
    host, path = host_and_path(F.col("_url"))
    rows = (pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"))
            .select("_id", host.alias("host"), path.alias("path")))
    rows = shared_table(rows, "urls")
    urls = rows.select("host", "path").distinct().withColumn("_at", F.concat("host", "path")).withColumn(
        "_low", ascii_lower(F.col("_at")))

    wanted = sorted({t for r in rules for t in r.tokens})
    seen = (urls.select(F.explode(tokens(F.col("_low"))).alias("token"))
            .where(F.col("token").isin(wanted)) if len(wanted) <= 1000 else
            urls.select(F.explode(tokens(F.col("_low"))).alias("token")))
    counted = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    given = spark.createDataFrame(
        [(i, r.name, r.regex, list(r.tokens), r.verdict, r.listed) for i, r in enumerate(rules)],
        "rule_id int, name string, regex string, tokens array<string>, verdict string, listed boolean")
    # the rarest token of each rule; a token that no URL holds is the rarest of all
    filed = (given.withColumn("token", F.explode("tokens")).drop("tokens")
             .join(counted, "token", "left")
             .groupBy("rule_id", "name", "regex", "verdict", "listed")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    # one index entry per token: the candidate rules
    index = filed.groupBy("token").agg(F.collect_list(F.struct("name", "regex", "verdict", "listed")).alias("rules"))
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    hits = (urls.withColumn("token", F.explode(tokens(F.col("_low")))).join(index, "token")
            .withColumn("r", F.explode("rules")).where(F.expr("if(r.listed, _at, _low) rlike r.regex"))
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.col("r.listed"), (F.col("r.verdict") == "allow").alias("allow"),
                                F.length("r.name").alias("size"), F.col("r.name").alias("name")))
                 .alias("p"),
                 F.max(F.when(F.col("r.listed"), F.struct(F.length("r.name").alias("size"),
                                                          F.col("r.name").alias("name"),
                                                          F.col("r.verdict").alias("verdict")))).alias("l")))
    hits = shared_table(hits.select(
        F.col("host").alias("_h"), F.col("path").alias("_p"),
        F.col("l.name").alias("rule"),
        F.when(F.col("l").isNull(), F.col("p.name")).alias("pattern"),
        F.coalesce(F.col("l.verdict"), F.when(F.col("p.allow"), "allow").otherwise("block")).alias("v")), "verdicts")
    # the verdicts grow with the pages: a merge join, whose skewed partitions Spark splits
    out = rows.join(hits.hint("merge"), (rows["host"] == hits["_h"]) & (rows["path"] == hits["_p"]), "left")
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", "pattern",
                      F.coalesce("v", F.lit(default)).alias("verdict"))


def oracle(rules: Iterable[Rule] = (*LISTED, *PATTERNS)) -> str:
    """The same judgement as DuckDB SQL: every rule tried on every URL."""
    values = ", ".join("('{}', '{}', '{}', {})".format(r.name, r.regex.replace("'", "''"), r.verdict,
                                                       str(r.listed).lower()) for r in rules)
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH r(name, regex, verdict, listed) AS (VALUES {values}),
p AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN ''
             ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{up}', '{low}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
m AS (SELECT page_id,
             arg_max(name, length(name)) FILTER (WHERE listed) AS rule,
             arg_max(verdict, length(name)) FILTER (WHERE listed) AS rule_verdict,
             arg_max(name, (CASE WHEN verdict = 'allow' THEN 1000 ELSE 0 END) + length(name))
               FILTER (WHERE NOT listed) AS pat,
             bool_or(verdict = 'allow') FILTER (WHERE NOT listed) AS pat_allow
      FROM h JOIN r ON regexp_matches(CASE WHEN listed THEN host || path
        ELSE translate(host || path, '{up}', '{low}') END, regex) GROUP BY page_id)
SELECT h.page_id, host, path, rule, CASE WHEN rule IS NULL THEN pat END AS pattern,
       coalesce(rule_verdict, CASE WHEN pat_allow THEN 'allow' WHEN pat IS NOT NULL THEN 'block' END,
                'allow') AS verdict
FROM h LEFT JOIN m USING (page_id)"""
