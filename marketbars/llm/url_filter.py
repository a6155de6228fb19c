"""URL filter: host-suffix and path-prefix expressions against hashed rules.

Every URL is expanded into the expressions ``host suffix + path prefix`` that a
rule could be listed under. The expressions meet the rules in an equi-join on a
short prefix of their SHA-256; a hit counts only when the full digests agree and
the URL's path starts with the rule's. Of the rules that fit, the longest wins.

A rule is listed under its host and its path up to the last ``/``, so rules
whose path ends inside a segment are found too. URLs are expanded no deeper
than the deepest rule: a deeper expression equals no rule.

Defined cases: a null URL, or one without ``://``, has an empty host and path
and fits no rule with a host; repeated URLs are judged once and joined back;
rules with a null host or verdict are ignored, a null rule path is empty; an
empty rule table leaves every URL to the default verdict; other columns of the
pages are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import ascii_lower

PREFIX_HEX = 8          # four bytes of the digest


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.encode(F.concat(host, F.lit(" "), path), "UTF-8"), 256)


def hashed_rules(rules: DataFrame) -> DataFrame:
    """``rules(host, path, verdict)`` with their listing digest and its prefix."""
    anchor = F.regexp_extract("r_path", r"^(?s)(.*/)?", 1)
    return (rules
            .select(ascii_lower(F.col("host")).alias("r_host"),
                    F.coalesce("path", F.lit("")).alias("r_path"),
                    F.col("verdict").alias("r_verdict"))
            .where("r_host is not null and r_verdict is not null")
            .withColumn("r_digest", _digest(F.col("r_host"), anchor))
            .withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_HEX))
            .withColumn("r_labels", F.size(F.split("r_host", r"\.")))
            .withColumn("r_depth", F.length("r_path")
                        - F.length(F.replace(F.col("r_path"), F.lit("/"), F.lit("")))))


def _expressions(urls: DataFrame, labels: int, depth: int) -> DataFrame:
    """(host, path) -> one row per host suffix and path prefix, with its digest."""
    parts = F.split("host", r"\.")
    segments = F.split("path", "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1)))),
        lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size(segments) - 1, F.lit(depth))),
        lambda k: F.when(k > 0, F.concat(
            F.array_join(F.slice(segments, 1, F.greatest(k, F.lit(1))), "/"), F.lit("/")))
        .otherwise(F.lit("")))
    return (urls
            .select("host", "path", F.explode(suffixes).alias("e_host"),
                    prefixes.alias("prefixes"))
            .select("host", "path", "e_host", F.explode("prefixes").alias("e_path"))
            .withColumn("e_digest", _digest(F.col("e_host"), F.col("e_path")))
            .withColumn("e_prefix", F.substring("e_digest", 1, PREFIX_HEX)))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (null if none fits), verdict.

    Longest means the characters of host and path together; among equals the
    longer host, then ``block``.
    """
    listed = hashed_rules(rules)
    deepest = listed.agg(F.max("r_labels"), F.max("r_depth")).first()   # one row
    named = pages.select(F.col(id_col).alias(id_col), url_host(F.col(url_col)).alias("host"),
                         url_path(F.col(url_col)).alias("path"))
    if deepest[0] is None:
        return named.withColumns({"rule": F.lit(None).cast("string"),
                                  "verdict": F.lit(default)})
    fits = (_expressions(named.select("host", "path").distinct(), deepest[0], deepest[1])
            .join(listed, F.col("e_prefix") == F.col("r_prefix"))
            .where((F.col("e_digest") == F.col("r_digest"))
                   & F.startswith(F.col("path"), F.col("r_path"))))
    best = (fits.groupBy("host", "path")
            .agg(F.max(F.struct(
                (F.length("r_host") + F.length("r_path")).alias("n"),
                F.length("r_host").alias("h"),
                (F.col("r_verdict") == "block").alias("b"),
                F.concat("r_host", "r_path").alias("rule"),
                F.col("r_verdict").alias("verdict"))).alias("best")))
    return (named.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
