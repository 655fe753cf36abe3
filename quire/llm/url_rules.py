"""URL filters: rules are looked up by their rarest literal token, and only rules that a url fetches run their pattern."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.llm.store import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """A pattern and what it decides.

    `||host/path` fits a host, all its subdomains and every path that begins so; letters of the path keep their case.
    Any other pattern is looked for anywhere in the lower-cased url. `*` is any text, `^` a character that is no
    letter or digit, or an end of the url.
    """
    pattern: str
    verdict: str


#: Rules for words that are spam wherever they stand in a url.
SPAM = tuple(Rule(f"^{word}^", "block") for word in (
    "casino-win", "cheap-pills", "adserver", "free-money", "hot-singles", "online-casino", "payday-loan",
    "replica-watches", "viagra", "warez"))


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def host_of(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty without :// or for null."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def compiled(spark: SparkSession, rules: DataFrame | Sequence[Rule]) -> DataFrame:
    """(pattern, verdict, on_site, regex, tokens) of each distinct rule, from rows or a table (pattern, verdict).

    tokens are those that every fitting url has as a whole: runs of letters and digits with a border on either side.
    Rules with a null pattern or verdict are left out.
    """
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([tuple(rule) for rule in rules], "pattern string, verdict string")
    body = F.regexp_replace("pattern", r"^\|\|", "")
    escaped = F.regexp_replace(body, r"([^\p{L}\p{N}*^])", r"\\$1")
    regex = F.replace(F.replace(escaped, F.lit("*"), F.lit(".*")), F.lit("^"), F.lit("(?:[^a-z0-9]|^|$)"))
    tokens = lambda before: F.regexp_extract_all(
        _ascii_lower(body), F.lit(before + "[a-z0-9]+(?=[^a-z0-9*])"), F.lit(0))
    return (rules.select("pattern", "verdict").dropna().distinct()
            .withColumn("on_site", F.startswith("pattern", F.lit("||")))
            .withColumn("regex", F.when(F.col("on_site"), F.concat(F.lit(r"^(?:[^/]*\.)?"), regex))
                        .otherwise(F.concat(F.lit("(?s)"), regex)))
            .withColumn("tokens", F.array_sort(F.array_distinct(
                F.when(F.col("on_site"), tokens("(?<![a-z0-9*])")).otherwise(tokens("(?<=[^a-z0-9*])"))))))


def matches(urls: DataFrame, rules: DataFrame | Sequence[Rule], url_column: str = "url") -> DataFrame:
    """(url, pattern, verdict) for each distinct url and each rule that fits it.

    A rule is indexed by that of its tokens which the fewest urls have (of equals the first in the alphabet); a rule
    without a whole token is tried on every url. Null urls fit nothing. Copies of a url are judged once.
    """
    distinct = urls.select(F.col(url_column).alias("url")).filter("url IS NOT NULL").distinct()
    held_tokens = F.array_distinct(F.concat(F.split(_ascii_lower(F.col("url")), "[^a-z0-9]+"), F.array(F.lit(""))))
    held = distinct.select("url", F.explode(held_tokens).alias("token"))
    # Written, as the rules are used twice below and their tokens come from a table of any size.
    known = stored(compiled(urls.sparkSession, rules).select(
        "pattern", "verdict", "on_site", "regex", F.explode(
            F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(F.array(F.lit("")))).alias("token")), "rules")
    counts = held.join(known.select("token").distinct(), "token", "left_semi").groupBy("token").agg(
        F.count("*").alias("n"))
    index = known.join(counts, "token", "left").groupBy("pattern", "verdict", "on_site", "regex").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    subject = F.when(F.col("on_site"), F.concat(host_of(F.col("url")), path_of(F.col("url")))).otherwise(
        _ascii_lower(F.col("url")))
    return (held.join(stored(index, "rule_index"), "token").filter(F.regexp_like(subject, F.col("regex")))
            .select("url", "pattern", "verdict"))


def judged(pages: DataFrame, rules: DataFrame | Sequence[Rule], url_column: str = "url") -> DataFrame:
    """All rows of `pages` with host, path, rule (the pattern that decides, or null) and verdict.

    Rules for hosts come before others, longer patterns before shorter, block before allow, then the alphabet; without
    a rule the verdict is allow, also for null urls. Columns of these four names are replaced. Rules are a table
    (pattern, verdict) of any size or a list.
    """
    order = F.struct(~F.startswith("pattern", F.lit("||")), -F.length("pattern"), F.col("verdict") != "block",
                     F.col("pattern").alias("pattern"), F.col("verdict").alias("verdict"))
    # Written before the join on the url, so that Spark may split the rows of one that repeats.
    decided = stored(matches(pages, rules, url_column).groupBy("url").agg(F.min(order).alias("best")).select(
        F.col("url").alias("_url"), F.col("best.pattern").alias("_rule"), F.col("best.verdict").alias("_verdict")), "decided")
    return (pages.drop("host", "path", "rule", "verdict")
            .join(decided, F.col(url_column) == F.col("_url"), "left")
            .withColumn("host", host_of(F.col(url_column))).withColumn("path", path_of(F.col(url_column)))
            .withColumn("rule", F.col("_rule"))
            .withColumn("verdict", F.coalesce("_verdict", F.lit("allow"))).drop("_url", "_rule", "_verdict"))
