"""URL rules by host suffixes and path prefixes.

Each url is expanded to the suffixes of its host (of as many labels as rules have)
joined with the prefixes of its path (at the lengths that rules have).  Expressions
meet the rules by the first 32 bits of their SHA-256, then the full digests must
agree; the longest rule wins.  Only what rules can see of a url is expanded: the last
labels and the path's beginning, each distinct pair once, so neither a long host nor
a host with a third of all pages makes more work, and the pages' other columns are
not exchanged with the expressions.

Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: from there up to ``?``, ``#`` or the end.

Defined results: a null url, or one without ``://``, has empty host and path and
fits no rule; no rule fits: allowed; of rules of one length a block wins, then the
greater text; repeated rows are judged each; an empty table gives no rows; a very long url is
judged whole; the input's other columns pass through (its own host, path, rule and verdict are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.base import from_row, table, whole_row

# The rules that the query judges by.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)?", 1)
    return F.translate(host, _UPPER, _LOWER), path


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with `host`, `path`, `rule` (null if none fits) and `verdict`; `rules`: host, path, action."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    known = rules.select(
        F.concat("host", "path").alias("__rule"), "action", F.length("path").alias("__length"), digest(F.concat("host", F.lit("\n"), "path")).alias("__digest")
    ).withColumn("__short", F.substring("__digest", 1, 8))
    # Of the rules, not of the pages: labels of the longest host, lengths of paths.
    most = rules.agg(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0))).first()[0]
    lengths = [r[0] for r in known.select("__length").where("__length IS NOT NULL").distinct().orderBy("__length").collect()]
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(whole_row(pages), host.alias("host"), path.alias("path"))
    seen = {"__host": F.substring_index("host", ".", -most) if most else F.lit(""), "__path": F.substring("path", 1, max(lengths, default=0))}
    rows = rows.withColumns(seen)
    keys = rows.select("__host", "__path").where("__host <> ''").distinct()
    labels = F.size(F.split("__host", r"\."))
    expressions = [
        F.when((labels >= k) & (F.length("__path") >= n), F.concat(F.substring_index("__host", ".", -k), F.lit("\n"), F.substring("__path", 1, n))) for k in range(1, most + 1) for n in lengths
    ]
    spread = keys.withColumn("__expression", F.explode(F.array_compact(F.array(*expressions)))) if expressions else keys.withColumn("__expression", F.lit(None).cast("string"))
    spread = spread.withColumn("__full", digest(F.col("__expression"))).withColumn("__start", F.substring("__full", 1, 8))
    met = spread.join(known, F.col("__start") == F.col("__short")).where(F.col("__full") == F.col("__digest"))
    best = F.max(F.struct(F.length("__rule"), F.when(F.col("action") == "block", 1).otherwise(0), "__rule", "action")).alias("__best")
    found = met.groupBy("__host", "__path").agg(best)
    out = rows.join(found, ["__host", "__path"], "left")
    return out.select(
        *from_row([c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]), "host", "path", F.col("__best.__rule").alias("rule"), F.coalesce(F.col("__best.action"), F.lit(default)).alias("verdict")
    )


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = """
WITH rules(h, p, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest AS (SELECT page_id, url, row_number() OVER () AS n, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT n, page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM rest),
fits AS (SELECT n, h || p AS rule, action, row_number() OVER (PARTITION BY n ORDER BY length(h || p) DESC, action DESC, h || p DESC) AS k
  FROM parts, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM fits WHERE k = 1) USING (n)
"""
