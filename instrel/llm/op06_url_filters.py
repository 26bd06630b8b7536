"""URL filters: pattern rules found through their rarest literal token.

A rule is a regular expression with the tokens that every url it fits must
contain whole. Of these the one that fewest urls hold indexes the rule. The
tokens of a url fetch the rules indexed by them, and only those rules run their
expression. All of it is joins and aggregates of distinct urls.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES_SCHEMA = "rule string, pattern string, tokens array<string>, verdict string, rank int"


class Rule(NamedTuple):
    """``rank``: of the rules that fit, the highest rank wins, ties to the smaller name."""

    rule: str
    pattern: str
    tokens: list[str]
    verdict: str
    rank: int


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with all its subdomains and the paths that start with ``path``; longer rules rank higher.

    Its pattern reads the host, ``#``, and the path.
    """
    segments = path.split("/")[1:-1]
    tokens = re.findall("[A-Za-z0-9]+", " ".join([host, *segments]))
    return Rule(host + path, rf"^(?:[^#]*\.)?{re.escape(host)}#{re.escape(path)}", tokens, verdict, 1000 + len(host + path))


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame, rules: DataFrame | Sequence[Rule], default: str = "allow", id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """Host, path, winning rule and verdict of every page, ``default`` where no rule fits.

    Returns ``page_id, host, path, rule, verdict``. A pattern is matched against ``host#path#query``; neither host
    nor path can hold a ``#`` (the query begins with its ``?``, and a fragment follows). Null urls and urls without ``://`` have
    empty host and path and are judged by ``default``. Repeated pages give repeated rows. A rule without tokens is refused, as nothing could fetch it.
    Each distinct url is judged once, so a url that a third of all pages share costs one row; the
    rule table may be of any size, Spark broadcasts it only when its statistics are below the threshold.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        if any(not r.tokens for r in rules):
            raise ValueError("every rule needs a token")
        rules = spark.createDataFrame([tuple(r) for r in rules], RULES_SCHEMA)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    urls = rows.where(F.col("url").contains("://")).select("url").distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.regexp_extract("url", r"(?s)^.*?://[^?#]*(.*)$", 1).alias("query"),
    )
    spelled = F.concat_ws("#", "host", "path", "query")
    tokens = urls.select(
        "url", spelled.alias("spelled"),
        F.explode(F.array_distinct(F.regexp_extract_all(spelled, F.lit("([A-Za-z0-9]+)"), 1))).alias("token"))
    listed = rules.select("rule", "pattern", "verdict", "rank", F.explode(F.array_distinct("tokens")).alias("token"))
    counts = tokens.join(listed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count(F.lit(1)).alias("urls"))
    index = listed.join(counts, "token", "left").groupBy("rule", "pattern", "verdict", "rank").agg(
        F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))["token"].alias("token"))
    fits = tokens.join(index, "token").where(F.rlike(F.col("spelled"), F.col("pattern")))
    best = fits.groupBy("url").agg(
        F.min(F.struct((-F.col("rank")).alias("rank"), "rule", "verdict")).alias("best"))
    judged = rows.join(best, "url", "left")
    return judged.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def judge_with_sites(pages: DataFrame, sites: Sequence[Rule], patterns: Sequence[Rule], default: str = "allow") -> DataFrame:
    """As ``judge_urls`` over both lists; ``rule`` is null and ``pattern`` set where a pattern rule decided."""
    names = [r.rule for r in sites]
    judged = judge_urls(pages, [*sites, *patterns], default)
    own = F.col("rule").isin(names)
    return judged.select(
        "page_id", "host", "path", F.when(own, F.col("rule")).alias("rule"), "verdict",
        F.when(~own, F.col("rule")).alias("pattern"))
