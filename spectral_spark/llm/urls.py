"""URL filters: host rules, and pattern rules that are found by their rarest literal token before any regular expression runs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, salted_join, stash

#: (verdict, host, path) and (verdict, pattern) as the query uses them.
HOST_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
PATTERN_RULES = (
    ("block", "^utm_*="),
    ("block", "&ref="),
    ("block", "?ref="),
    ("block", "^casino^"),
    ("block", "^adserver^"),
    ("block", "||ads."),
    ("block", "/banner/*/click"),
    ("block", "|ftp://"),
    ("allow", "?utm_source=feed|"),
    ("allow", "/newsroom/*.html|"),
)
#: Largest index (rows) that is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000


def to_regex(pattern: str) -> str:
    """A pattern as a regular expression on a lower-case url: * is any run, ^ a separator or the end, | an end of the url, || the start of a host or of one of its parts."""
    head, tail = "", ""
    if pattern.startswith("||"):
        head, pattern = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?", pattern[2:]
    elif pattern.startswith("|"):
        head, pattern = "^", pattern[1:]
    if pattern.endswith("|"):
        tail, pattern = "$", pattern[:-1]
    return head + "".join({"*": ".*", "^": r"(?:[^a-z0-9_.%-]|$)"}.get(c, re.escape(c)) for c in pattern.lower()) + tail


def whole_tokens(pattern: str) -> list[str]:
    """Literal runs of a pattern that are whole tokens of every url it matches: no * and no open end beside them."""
    inner = pattern.lower()
    fixed_head, fixed_tail = inner.startswith("|"), inner.endswith("|")
    inner = inner.strip("|")
    out = []
    for m in re.finditer(r"[a-z0-9]+", inner):
        before = inner[m.start() - 1] != "*" if m.start() else fixed_head
        after = inner[m.end()] != "*" if m.end() < len(inner) else fixed_tail
        if before and after:
            out.append(m[0])
    return sorted(set(out))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(url, "[^a-z0-9]+"), lambda t: t != ""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def match_patterns(pages: DataFrame, url_col: str = "url", rules=PATTERN_RULES) -> DataFrame:
    """(url, verdict, pattern) for each distinct url that a pattern rule matches: allow if any allow rule does, else block.

    A rule is listed under its token that the fewest distinct urls hold. A rule without whole tokens has no such list: it
    is tried on each distinct url where it lies, as an expression.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(url_col).alias("url")).where("url is not null").distinct().withColumn("low", F.lower("url"))
    rows = [(k, v, p, to_regex(p), whole_tokens(p)) for k, (v, p) in enumerate(rules)]
    table = spark.createDataFrame([r for r in rows if r[4]], "rule int, verdict string, pattern string, regex string, tokens array<string>")
    listed = table.select("rule", F.explode("tokens").alias("token"))
    hint = F.broadcast if len(rules) <= BROADCAST_ROWS else (lambda df: df)
    tokens = urls.select("url", "low", F.explode(url_tokens(F.col("low"))).alias("token"))
    counts = tokens.select("token").join(hint(listed.select("token").distinct()), "token", "left_semi").groupBy("token").count()
    rarest = listed.join(counts, "token", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), (-F.length("token")).alias("short"), "token")).alias("least"))
    index = table.join(rarest, "rule").select("verdict", "pattern", "regex", F.col("least.token").alias("token"))
    hits = tokens.join(hint(index), "token").where(F.regexp(F.col("low"), F.col("regex"))).select("url", "verdict", "pattern")
    plain = [F.when(F.regexp(F.col("low"), F.lit(x)), F.struct(F.lit(v).alias("verdict"), F.lit(p).alias("pattern"))) for _, v, p, x, own in rows if not own]
    if plain:
        hits = hits.unionByName(urls.select("url", F.explode(F.array_compact(F.array(*plain))).alias("hit")).select("url", "hit.*"))
    return hits.groupBy("url").agg(F.min("verdict").alias("verdict"), F.min(F.struct("verdict", "pattern")).alias("first")).select("url", "verdict", F.col("first.pattern").alias("pattern"))


def match_hosts(pages: DataFrame, host: Column, path: Column, url_col: str = "url", rules=HOST_RULES) -> DataFrame:
    """(url, rule, verdict) for each distinct url with a host rule: the longest whose host is the url's or a parent of it and with whose path its path begins.

    A url's host is looked up by its last labels, as many as a rule's host has: so very long hosts take no longer than reading them.
    """
    lengths = sorted({h.count(".") + 1 for _, h, _ in rules} or {1})
    parents = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in lengths]))
    table = pages.sparkSession.createDataFrame([tuple(r) for r in rules], "verdict string, under string, begin string")
    hint = F.broadcast if len(rules) <= BROADCAST_ROWS else (lambda df: df)
    urls = pages.select(F.col(url_col).alias("url"), host.alias("host"), path.alias("path")).where("host <> ''").distinct()
    found = urls.select("url", "path", F.explode(parents).alias("under")).join(hint(table), "under").where(F.startswith("path", "begin"))
    rule = F.concat("under", "begin")
    best = F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), "verdict")).alias("best")
    return found.groupBy("url").agg(best).select("url", "best.rule", "best.verdict")


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """One row per row of pages: id, host, path, rule, verdict, pattern.

    The host follows the first "://" up to / ? # or the end, A-Z in lower case; the path follows up to ? # or the end. A
    null url, or one without "://", has neither. The longest host rule whose host is the url's or a parent of it, and
    with whose path the url's path begins, decides; else the pattern rules do; else the url is allowed. pattern is the
    rule that matched, whether or not it decided. Repeated rows give repeated results; null ids and urls are kept. Other
    columns are ignored; an empty table gives an empty result.
    """
    out = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    urls = stash(out.where("url is not null").groupBy("url").agg(F.count(F.lit(1)).alias("n")), "urls")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    ruled = match_hosts(urls, host, path, "url", host_rules).withColumnRenamed("verdict", "ruled")
    hits = match_patterns(urls, "url", pattern_rules).withColumnRenamed("verdict", "judged")
    known = urls.join(ruled, "url", "left").join(hits, "url", "left")
    out = salted_join(out, known, "url", "n", out.count(), "id", how="left")
    return out.select(F.col("id").alias(id_col), host.alias("host"), path.alias("path"), "rule", F.coalesce("ruled", "judged", F.lit("allow")).alias("verdict"), "pattern")


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


_LONGEST = sorted(HOST_RULES, key=lambda r: -len(r[1] + r[2]))
ORACLE = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, url, lower(coalesce(url, '')) AS low, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
m AS (SELECT r, min(verdict) AS judged, min(verdict || chr(9) || pattern) AS first FROM p, (VALUES {", ".join("('" + v + "', '" + k + "', '" + to_regex(k) + "')" for v, k in PATTERN_RULES)}) AS k(verdict, pattern, regex) WHERE url IS NOT NULL AND regexp_matches(low, regex) GROUP BY r)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {_fits(h, q)} THEN '{h}{q}'" for _, h, q in _LONGEST)} END AS rule,
CASE {" ".join(f"WHEN {_fits(h, q)} THEN '{v}'" for v, h, q in _LONGEST)} ELSE coalesce(judged, 'allow') END AS verdict, string_split(first, chr(9))[2] AS pattern
FROM p LEFT JOIN m USING (r)
"""
