"""Allow and block rules for URLs: expressions of host suffix and path prefix, matched by hash prefix, then digest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.catalogue.common import table
from statloom.functions.columns import col
from statloom.llm.text import ascii_lower, let, unused, whole
from statloom.sources.tables import literal_rows

ALLOW, BLOCK = "allow", "block"
# (host, path, verdict): what the registered query applies.
RULES = [("net", "/", BLOCK), ("example.net", "/en/", ALLOW), ("example.com", "/de/", BLOCK), ("org", "/fr/", ALLOW)]
PREFIX_DIGITS = 8  # of the SHA-256 in hexadecimal: 32 bits


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return literal_rows(spark, rules, "host string, path string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in small letters. Path: from there up
    to ``?``, ``#`` or the end. Both are empty for a null url or one without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def expression(host: Column, path: Column) -> Column:
    """What is hashed. The line break keeps (a, b/c) and (a/b, c) apart."""
    return F.concat(host, F.lit("\n"), path)


def expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every host suffix at a label boundary, with every path prefix of a length that some rule has."""
    sizes = F.array(*[F.lit(n) for n in lengths])

    def suffixes(labels: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    prefixes = F.transform(F.filter(sizes, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(let(F.split(host, r"\.", -1), suffixes),
                                 lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("h"), p.alias("p")))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` (host and path of the deciding rule, else null) and ``verdict``.

    ``rules`` has ``host, path, verdict``. A rule fits its host and every subdomain if the path of the url starts with
    the path of the rule (code point by code point). The longest rule wins, by the length of host and path together;
    at equal length the longer host, then block before allow. Without a fitting rule, with a null url, or one without
    ``://``, the rule is null and the verdict ``default``; an empty host fits only a rule with an empty host. Rules
    with a null are ignored, hosts of rules compare in small letters. Equal urls get equal verdicts, repeated pages
    stay. Columns of the pages with the names of the new ones are replaced. Empty tables give empty results, or the
    default verdict for all pages.

    Distinct urls are expanded, so a url on a third of all pages counts once; expressions meet rules on 32 bits of
    their digest, then the full digest decides. Neither side is broadcast unless Spark measures it as small. The
    driver receives the distinct lengths of rule paths, which the longest path bounds.
    """
    known = (rules.dropna(subset=["host", "path", "verdict"])
             .select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"),
                     F.col("verdict").alias("rule_verdict"))
             .groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
             .withColumn("full", F.sha2(expression(F.col("rule_host"), F.col("rule_path")), 256))
             .withColumn("short", F.substring("full", 1, PREFIX_DIGITS)))
    lengths = sorted(r[0] for r in known.select(F.length("rule_path")).distinct().collect())
    asked_url, best_rule, *made = unused(pages, "asked_url", "best_rule", "made_host", "made_path", "made_rule", "made_verdict")
    host, path = host_and_path(F.col(asked_url))
    urls = pages.select(col(url).alias(asked_url)).distinct().select(asked_url, host.alias("h"), path.alias("p"))
    asked = (urls.select(asked_url, F.explode(expressions(F.col("h"), F.col("p"), lengths)).alias("e"))
             .select(asked_url, F.sha2(expression(F.col("e.h"), F.col("e.p")), 256).alias("asked"))
             .withColumn("short", F.substring("asked", 1, PREFIX_DIGITS))) if lengths else None
    order = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), "rule_verdict",
                     F.concat("rule_host", "rule_path").alias("rule"))
    new = ["host", "path", "rule", "verdict"]
    host, path = host_and_path(whole(url))
    if asked is None:
        judged = pages.withColumns(dict(zip(made, [host, path, F.lit(None).cast("string"), F.lit(default)])))
    else:
        best = (asked.join(known, "short").where(F.col("asked") == F.col("full"))
                .groupBy(asked_url).agg(F.max(order).alias(best_rule)))
        verdict = F.coalesce(F.col(best_rule)["rule_verdict"], F.lit(default))
        judged = (pages.join(best, col(url).eqNullSafe(F.col(asked_url)), "left")
                  .withColumns(dict(zip(made, [host, path, F.col(best_rule)["rule"], verdict])))
                  .drop(asked_url, best_rule))
    kept = [col(c) for c in pages.columns if c.lower() not in new]
    return judged.select(*kept, *[F.col(m).alias(n) for m, n in zip(made, new)])


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), rule_table(spark, RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


QUERIES = {"op7_urls": (op7_urls, r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
                          ('org', '/fr/', 'allow')),
best AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM parts, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)""")}
