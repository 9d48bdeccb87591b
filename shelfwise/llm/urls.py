"""URL filters: host-suffix and path-prefix expressions against a rule list.

A URL's host gives its suffixes at label borders, its path gives prefixes;
each pair is one expression ``host TAB path``. Only pairs of the shapes that
some rule has (labels in the host, characters in the path) are made.
Expressions and rules are equi-joined on a short prefix of their SHA-256;
the full digest confirms a match, and of a URL's rules the longest
(host and path together) wins, then the longer host, then block over allow.

Everything is SQL functions. URLs are judged once each (distinct URLs first,
so a URL or host that fills a third of the table costs one judgement), and
the verdicts join back on the URL. Spark chooses the joins by measured size;
nothing is hinted.

Defined results: a null URL or one without ``://`` has empty host and path
and no rule, so the default verdict; repeated rows are each returned; an
empty rule list gives the default everywhere. Columns of the given frame
stay; the four added ones take fresh names when a column has theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, fresh_name, read

#: The contract's rules: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DEFAULT = "allow"
PREFIX_HEX = 8                    # short hash prefix: 32 bits

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url):
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"\A([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url):
    return F.coalesce(F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url):
    """What follows the first ``://``, else null."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule and verdict columns."""
    u = F.col("_url")
    rule = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull() & F.col("verdict").isin("allow", "block"))
    rule = rule.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))      # block beats allow
    digest = F.sha2(F.concat_ws("\t", "host", "path"), 256)
    keyed = rule.select(digest.alias("_digest"), F.substring(digest, 1, PREFIX_HEX).alias("_short"),
                        F.col("host").alias("_rule_host"), F.col("path").alias("_rule_path"), "verdict")
    # Distinct shapes are at most the longest host's labels times the longest path, whatever the number of rules.
    shapes = rule.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")).distinct().collect()
    shapes = F.array(*[F.struct(F.lit(s.labels).alias("labels"), F.lit(s.chars).alias("chars")) for s in shapes]
                     or [F.struct(F.lit(1 << 30).alias("labels"), F.lit(0).alias("chars"))])     # no rule: none fits

    distinct = pages.select(F.col(f"`{url}`").alias("_url")).filter(F.instr(u, "://") > 0).distinct()
    split = distinct.select(u, url_host(u).alias("_host"), url_path(u).alias("_path"))
    made = split.select(u, F.explode(shapes).alias("_shape"), "_host", "_path").filter(
        (F.size(F.split("_host", r"\.")) >= F.col("_shape.labels")) & (F.length("_path") >= F.col("_shape.chars")))
    expression = F.concat_ws("\t", F.expr("substring_index(_host, '.', -_shape.labels)"),
                             F.expr("substring(_path, 1, _shape.chars)"))
    made = made.select(u, F.sha2(expression, 256).alias("_own"))
    hit = made.join(keyed, F.substring("_own", 1, PREFIX_HEX) == F.col("_short")).filter(
        F.col("_own") == F.col("_digest"))
    best = hit.groupBy(u).agg(F.max(F.struct(
        (F.length("_rule_host") + F.length("_rule_path")).alias("size"), F.length("_rule_host").alias("host_size"),
        F.concat("_rule_host", "_rule_path").alias("rule"), "verdict")).alias("_best"))
    names = {c: fresh_name(pages, c) for c in ("host", "path", "rule", "verdict")}
    given = [F.col(f"p.`{c}`") for c in pages.columns]
    p = F.col(f"p.`{url}`")
    best = apart(best, "_url")                   # an exchange of its own: a URL in a third of the rows is split
    return pages.alias("p").join(best.alias("b"), p == F.col("b._url"), "left").select(
        *given, url_host(p).alias(names["host"]), url_path(p).alias(names["path"]),
        F.col("b._best.rule").alias(names["rule"]),
        F.coalesce(F.col("b._best.verdict"), F.lit(default)).alias(names["verdict"]))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every page's URL judged by the contract's four rules."""
    return judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules_frame(spark, RULES))


SQL = r"""
WITH u AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
s AS (SELECT page_id, url, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(rh, rp, rv) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
d AS (SELECT DISTINCT host, path FROM s),
m AS (SELECT host, path, arg_max(rh || rp, length(rh) + length(rp)) AS rule, arg_max(rv, length(rh) + length(rp)) AS verdict
      FROM d JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT page_id, url, s.host AS host, s.path AS path, rule, coalesce(verdict, 'allow') AS verdict
FROM s LEFT JOIN m ON s.host = m.host AND s.path = m.path
"""
