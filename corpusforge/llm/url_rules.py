"""URL filters: host-suffix and path-prefix expressions matched by hash prefix.

Each URL is expanded into all (host suffix, path prefix) expressions at label
and slash boundaries. Expressions and rules meet in an equi-join on a short
prefix of their SHA-256 digest; the full digest, then the rule's own path,
confirm a match. Of the rules that fit, the longest wins (longest path for
equal length of both, then block before allow).

Expressions are made only as deep as the deepest rule, read from the rule
table by one aggregate, so a URL of thousands of labels or slashes stays
cheap and no rule is missed. Distinct (host, path) pairs are judged once: a
URL that many rows share is expanded once, and the verdict is joined back.
The rule table may be of any size; Spark broadcasts it only if it is small.

Defined cases: a null URL and one without ``://`` have an empty host and
path; no rule fits them and they get ``default``. Repeated rows each get
their verdict. An empty table gives an empty result. A rule with an empty
host fits no URL; rows of rules with a null host or action are ignored; a
null rule path counts as ``/``. Of columns other than the id and the URL
nothing is read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a digest that the join compares (32 bits).
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _directory(path: Column) -> Column:
    """A path up to its last slash."""
    return F.regexp_replace(path, r"(?s)[^/]*$", "")


def _expression(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\u0000"), folder), 256)


def _suffixes(host: Column, most: int) -> Column:
    labels = F.split(F.substring_index(host, ".", -most), r"\.", -1)
    return F.transform(labels, lambda x, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))


def _prefixes(path: Column, most: int) -> Column:
    """Prefixes of a path that end with a slash: the first ``most`` of them."""
    parts = F.slice(F.split(path, "/", most + 1), 1, most)
    n = F.least(F.length(F.regexp_replace(path, r"(?s)[^/]", "")), F.lit(most))
    ends = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.transform(ends, lambda i: F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/")))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """Per row of ``pages``: id, host, path, rule (null without one) and verdict.

    ``rules`` has the columns ``host``, ``path`` and ``action``.
    """
    given = rules.select(_ascii_lower(F.col("host")).alias("r_host"), F.coalesce("path", F.lit("/")).alias("r_path"),
                         F.col("action").alias("r_action")).where("r_host <> '' and r_action is not null").distinct()
    given = given.withColumn("r_folder", _directory(F.col("r_path")))
    deepest = given.agg(F.max(F.size(F.split("r_host", r"\.", -1))), F.max(F.length(F.regexp_replace("r_path", "(?s)[^/]", "")))).first()
    labels, slashes = max(deepest[0] or 1, 1), max(deepest[1] or 1, 1)
    given = given.withColumn("r_digest", _expression(F.col("r_host"), F.col("r_folder")))
    given = given.withColumn("r_prefix", F.substring("r_digest", 1, PREFIX_DIGITS))

    rows = pages.select(F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    urls = rows.select(F.col("host").alias("u_host"), F.col("path").alias("u_path")).distinct()
    hosts = urls.where("u_host <> ''").select("u_host", "u_path", F.explode_outer(_suffixes(F.col("u_host"), labels)).alias("e_host"))
    folders = F.concat(F.array(F.lit("")), _prefixes(F.col("u_path"), slashes))
    e = hosts.select("u_host", "u_path", "e_host", F.explode_outer(folders).alias("e_folder"))
    e = e.withColumn("e_digest", _expression(F.col("e_host"), F.col("e_folder")))
    e = e.withColumn("e_prefix", F.substring("e_digest", 1, PREFIX_DIGITS))
    met = e.join(given, F.col("e_prefix") == F.col("r_prefix"))
    met = met.where((F.col("e_digest") == F.col("r_digest")) & F.startswith("u_path", F.col("r_path")))
    size = F.length("r_host") + F.length("r_path")
    best = met.groupBy("u_host", "u_path").agg(F.max(F.struct(
        size.alias("n"), F.length("r_path").alias("p"), F.col("r_action").alias("action"),
        F.concat("r_host", "r_path").alias("rule"))).alias("best"))
    out = rows.join(best, (F.col("host") == F.col("u_host")) & (F.col("path") == F.col("u_path")), "left")
    return out.select(id_col, "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.action", F.lit(default)).alias("verdict"))
