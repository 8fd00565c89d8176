"""URL filters by host-suffix and path-prefix expressions.

A rule is a host, a path and a verdict. It fits its host and all subdomains, if the path of the url starts with the
rule's. Each url is expanded into expressions: every suffix of its host at a dot, with every prefix of its
path that ends in a slash, and with the empty prefix. A rule is filed under its host and the longest
such prefix of its own path, so that rules which end within a path segment are found too. Expressions
and rules meet by the first 32 bits of their SHA-256; then the full digests and the rest of the path are
compared. The longest rule wins (host and path together), then the longer host, then block over allow.

No host is expanded by more labels, and no path by more slashes, than some rule has: what is longer fits none, and a url of
any length costs no more than the deepest rule.

Urls are judged once per distinct host and path, so copies of one url cost nothing. Null urls, and
urls without ``://``, have an empty host and path and fit no rule. Empty labels stay labels. Null ids and
repeated rows are judged like any others, one row out for one row in. An empty rule table leaves
every url to the default verdict. Rows of rules with nulls are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakerecon.llm.frames import small

PREFIX = 8
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def expressions(urls: DataFrame, labels: int, slashes: int) -> DataFrame:
    """(host, path, digest) for the expressions of each (host, path) of up to so many labels and slashes."""
    parts, size = F.split("host", r"\."), F.size(F.split("host", r"\."))
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), size - labels + 1), size), lambda i: F.array_join(F.slice(parts, i, size), "."))
    # the last part is all that follows the deepest slash
    folders = F.split("path", "/", slashes + 1)
    paths = F.transform(
        F.sequence(F.lit(0), F.size(folders) - 1), lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(folders, F.lit(1), i), "/"), F.lit("/")))
    )
    each = urls.select("host", "path", F.explode(hosts).alias("suffix"), paths.alias("prefixes"))
    return each.select("host", "path", "suffix", F.explode("prefixes").alias("prefix")).select(
        "host", "path", _digest(F.concat_ws(" ", "suffix", "prefix")).alias("digest")
    )


def depth(rules: DataFrame) -> tuple[int, int]:
    """The most labels of a host and the most slashes of a path among the rules."""
    most = rules.agg(F.max(F.size(F.split("host", r"\."))), F.max(F.size(F.split("path", "/")) - 1)).first()
    return most[0] or 1, most[1] or 0


def filed(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with the digest that they are filed under."""
    known = rules.select("host", "path", "verdict").na.drop().distinct()
    folder = F.regexp_extract("path", r"(?s)^(.*/)?", 1)
    return known.select(
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict", _digest(F.concat_ws(" ", F.col("host"), folder)).alias("r_digest")
    ).withColumn("r_short", F.substring("r_digest", 1, PREFIX))


def judge(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = DEFAULT) -> DataFrame:
    """id, host, path, rule (host and path of the rule that wins, or null) and verdict of every row."""
    host, path = host_and_path(url_column)
    rows = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    urls = rows.select("host", "path").distinct()
    met = expressions(urls, *depth(rules)).withColumn("short", F.substring("digest", 1, PREFIX)).join(small(filed(rules)), F.col("short") == F.col("r_short"))
    fits = met.filter((F.col("digest") == F.col("r_digest")) & F.col("path").startswith(F.col("r_path")))
    rank = F.struct(
        (F.length("r_host") + F.length("r_path")).alias("length"), F.length("r_host").alias("host"), F.when(F.col("verdict") == "block", 1).otherwise(0).alias("block"), "verdict", "r_host", "r_path"
    )
    won = fits.groupBy("host", "path").agg(F.max(rank).alias("w")).select(
        F.col("host").alias("w_host"), F.col("path").alias("w_path"), F.concat("w.r_host", "w.r_path").alias("rule"), F.col("w.verdict").alias("verdict")
    )
    return rows.join(won, (F.col("host") == F.col("w_host")) & (F.col("path") == F.col("w_path")), "left").select(
        id_column, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
