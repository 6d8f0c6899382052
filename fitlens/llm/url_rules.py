"""URL filter: host rules, and pattern rules indexed by their rarest literal token.

A URL's tokens and the ends of its host fetch the rules that can fit it; only those are tested. Rules are tables, so their number
may grow; every distinct URL is judged once.

Pattern rules: ``*`` is any text, ``^`` a separator (anything but a letter, digit, ``_ - . %``) or the end, a leading ``||`` the
start of a host or of one of its parents, ``|`` at an end that end of the URL, a leading ``@@`` makes the rule an exception that
allows. Letter case does not count.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitlens.llm.registry import ascii_lower, query, table
from fitlens.sources.io import literal_rows

# Rules of the contract, (host, path, verdict).
HOST_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

# Patterns of pages that are no text to learn from.
PATTERNS = (
    "||ads.*^", "||adserver.*^", "||doubleclick.", "||tracker.*^", "/adserver/", "/banners/", "/popunder", "/affiliate/*/click",
    "casino^", "poker^online", "-porn-", "/porn/", "||porn.", "/xxx/", "viagra", "^sex^", "/escort/", "/payday-loan",
    "/wp-login.php", "/cgi-bin/", "^cart^checkout^", "^sessionid=", "^phpsessid=", "/login?*return", "/calendar/*/day/",
    "*.exe|", "*.zip|", "*.apk|", "@@||docs.*/adserver/", "@@/news/*casino^",
)

SEPARATOR = r"(?:[^a-z0-9_.%-]|$)"
HOST = r"^[^:/?#]*://(?:[^/?#]*\.)?"
TOKEN = r"[a-z0-9%]+"


def pattern_regex(pattern: str) -> str:
    body = pattern.removeprefix("@@").lower()
    start, body = (HOST, body[2:]) if body.startswith("||") else ("^", body[1:]) if body.startswith("|") else ("", body)
    body, end = (body[:-1], "$") if body.endswith("|") else (body, "")
    return start + "".join({"*": ".*", "^": SEPARATOR}.get(c) or re.sub(r"([^a-z0-9])", r"\\\1", c) for c in body) + end


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every URL the pattern fits has as a whole: runs of letters and digits that nothing can lengthen."""
    body = pattern.removeprefix("@@").lower()
    start = "^" if body.startswith("|") else ""
    body = body.removeprefix("||" if body.startswith("||") else "|")
    whole = start + (body[:-1] + "^" if body.endswith("|") else body)
    return [m.group() for m in re.finditer(r"(?<=[^a-z0-9%*])[a-z0-9%]+(?=[^a-z0-9%*])", whole)]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path. Null or without ``://``: both empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def pattern_index(urls: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """``(place, pattern, regex, verdict, token)``: each pattern with the one of its literal tokens that the fewest URLs have.

    Ties go to the longer, then the first token. A pattern without such a token has a null one and is tested on every URL.
    """
    spark = urls.sparkSession
    rules = literal_rows(
        spark,
        {
            "place": range(len(patterns)),
            "pattern": patterns,
            "regex": [pattern_regex(p) for p in patterns],
            "verdict": ["allow" if p.startswith("@@") else "block" for p in patterns],
            "tokens": [sorted(set(literal_tokens(p))) for p in patterns],
        },
        {"place": pa.int32(), "pattern": pa.string(), "regex": pa.string(), "verdict": pa.string(), "tokens": pa.list_(pa.string())},
    )
    by_token = rules.select("place", F.explode("tokens").alias("token"))
    seen = urls.select(F.explode(url_tokens(F.col("url"))).alias("token"))
    counts = seen.join(by_token.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (
        by_token.join(counts, "token", "left")
        .groupBy("place")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.length("token")).alias("shorter"), "token"))["token"].alias("token"))
    )
    return rules.drop("tokens").join(rarest, "place", "left")


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(url), F.lit(f"({TOKEN})"), F.lit(1)))


def judge_urls(
    pages: DataFrame,
    host_rules: Sequence[tuple[str, str, str]] = HOST_RULES,
    patterns: Sequence[str] = PATTERNS,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``(key, host, path, rule, verdict, pattern)`` for every row.

    The longest fitting host rule (host and path together; ties: the last by text, then block) gives the verdict and stands in
    ``rule``. Without one the patterns decide: a fitting exception allows, else a fitting pattern blocks, else the URL is allowed; ``pattern``
    names the first fitting one of the deciding kind, whether or not a rule overrules it. Null or empty URLs have an empty host
    and path and are allowed. Repeated rows and keys are kept one by one; extra columns are left out.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("url"))
    urls = rows.filter(F.col("url").isNotNull()).select("url").distinct()
    host, path = split_url(F.col("url"))
    parsed = urls.select("url", host.alias("host"), path.alias("path"))
    found = []
    if host_rules:
        rule_host, rule_path, verdict = zip(*host_rules)
        rules = literal_rows(
            spark, {"end": rule_host, "start": rule_path, "verdict": verdict}, dict.fromkeys(("end", "start", "verdict"), pa.string())
        ).withColumn("end", ascii_lower(F.col("end")))
        # No rule has more labels, so longer ends of a host are not needed.
        most = max(len(h.split(".")) for h in rule_host)
        labels = parsed.withColumn("labels", F.split("host", r"\."))
        ends = F.transform(
            F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(most))),
            lambda n: F.array_join(F.slice(F.col("labels"), -n, n), "."),
        )
        fits = labels.select("url", "path", F.explode(ends).alias("end")).join(rules, "end").filter(F.startswith("path", "start"))
        rule = F.concat("end", "start")
        found.append(fits.select("url", F.struct(F.length(rule).alias("n"), rule.alias("rule"), "verdict").alias("rule"), F.lit(None).cast("struct<kind:int,place:int,pattern:string>").alias("hit")))
    if patterns:
        index = pattern_index(urls, patterns)
        tested = (
            urls.select("url", F.explode(F.concat(url_tokens(F.col("url")), F.array(F.lit("")))).alias("token"))
            .join(index.withColumn("token", F.coalesce("token", F.lit(""))), "token")
            .filter(F.rlike(F.lower("url"), F.col("regex")))
        )
        kind = F.when(F.col("verdict") == "allow", 0).otherwise(1)
        found.append(tested.select("url", F.lit(None).cast("struct<n:int,rule:string,verdict:string>").alias("rule"), F.struct(kind.alias("kind"), "place", "pattern").alias("hit")))
    judged = parsed.withColumns({"rule": F.lit(None).cast("string"), "by_rule": F.lit(None).cast("string"), "kind": F.lit(None).cast("int"), "pattern": F.lit(None).cast("string")})
    if found:
        union = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        best = F.max_by("rule", F.struct("rule.n", "rule.rule", F.col("rule.verdict") == "block"))
        decided = union.groupBy("url").agg(best.alias("r"), F.min("hit").alias("h"))
        judged = decided.select("url", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("by_rule"), F.col("h.kind").alias("kind"), F.col("h.pattern").alias("pattern"))
    out = rows.join(judged.select("url", "rule", "by_rule", "kind", "pattern"), "url", "left")
    verdict = F.coalesce("by_rule", F.when(F.col("kind") == 1, "block").otherwise("allow"))
    return out.select(F.col("_key").alias(key), host.alias("host"), path.alias("path"), "rule", verdict.alias("verdict"), "pattern")


def _sql() -> str:
    """Every rule against every URL."""
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    rules = ", ".join("(" + ", ".join(map(quote, r)) + ")" for r in HOST_RULES)
    patterns = ", ".join(
        f"({i}, {quote(p)}, {quote(pattern_regex(p))}, {0 if p.startswith('@@') else 1})" for i, p in enumerate(PATTERNS)
    )
    return rf"""
WITH parsed AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parsed),
judged AS (
  SELECT *,
    (SELECT arg_max(h || p, length(h || p)) FROM (VALUES {rules}) AS r(h, p, v)
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
    (SELECT arg_max(v, length(h || p)) FROM (VALUES {rules}) AS r(h, p, v)
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS by_rule,
    (SELECT arg_min(pattern, kind * 1000000 + place) FROM (VALUES {patterns}) AS t(place, pattern, regex, kind)
     WHERE regexp_matches(lower(url), regex)) AS pattern
  FROM parts)
SELECT page_id, host, path, rule, pattern,
       coalesce(by_rule, CASE WHEN pattern IS NULL OR starts_with(pattern, '@@') THEN 'allow' ELSE 'block' END) AS verdict
FROM judged"""


@query("op6_url_rules", _sql())
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    return judge_urls(table(spark, sf_dir, "pages"))
