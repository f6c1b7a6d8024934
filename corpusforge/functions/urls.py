"""URL parts (C8-C10) with the semantics of Python's ``urllib.parse.urlparse``.

Spark's ``parse_url`` differs (keeps host case and IPv6 brackets, rejects
hosts with ``_`` or spaces, gives null for a missing query), so the split is
one RFC 3986 regex plus the hostname and ``;params`` rules of ``urlparse``.
All expressions are native and RE2-compatible (no look-around, no
back-references), so the DuckDB oracle uses the very same patterns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (urlparse): leading C0 controls/space are stripped, tabs and
# line breaks removed anywhere; schemes whose last path segment may carry
# ';params'.
LEADING_JUNK = r"^[\x00-\x20]+"
UNSAFE_BYTES = r"[\t\r\n]"
URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
PARAMS_RE = r"^((?:.*/)?[^/;]*);[^/]*$"
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp",
                 "rtsp", "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _clean(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, LEADING_JUNK, ""), UNSAFE_BYTES, "")


def url_parts(url) -> Column:
    """``struct(scheme, host, path, query)``; null URL gives null parts.

    host: lower-cased, user info, port and IPv6 brackets removed, null if
    empty; path: without ``;params`` for the schemes above; query: ``""`` if
    absent.
    """
    u = _clean(_col(url))
    scheme = F.lower(F.regexp_extract(u, URL_RE, 1))
    netloc = F.regexp_extract(u, URL_RE, 2)
    raw_path = F.regexp_extract(u, URL_RE, 3)
    query = F.regexp_extract(u, URL_RE, 4)
    hostinfo = F.regexp_extract(netloc, r"^(?:.*@)?(.*)$", 1)
    bracketed = F.regexp_extract(hostinfo, r"\[([^\]]*)", 1)
    host = F.when(F.contains(hostinfo, F.lit("[")), bracketed).otherwise(
        F.substring_index(hostinfo, ":", 1))
    # Only the part before a '%' zone id is lower-cased.
    host = F.concat(F.lower(F.substring_index(host, "%", 1)),
                    F.regexp_extract(host, r"(%.*)$", 1))
    path = F.when(scheme.isin(*PARAM_SCHEMES) & F.contains(raw_path, F.lit(";")),
                  F.regexp_replace(raw_path, PARAMS_RE, "$1")).otherwise(raw_path)
    return F.when(_col(url).isNull(), F.lit(None)).otherwise(F.struct(
        scheme.alias("scheme"),
        F.nullif(host, F.lit("")).alias("host"),
        path.alias("path"),
        query.alias("query"),
    ))


def with_url_parts(df, url: str, prefix: str = "") -> "DataFrame":
    """Add ``{prefix}host, {prefix}path, {prefix}query`` to ``df`` (staged).

    Same result as ``url_parts``, but each intermediate is its own column,
    so Catalyst keeps one evaluation per row instead of inlining the shared
    sub-expressions into every consumer.
    """
    t = f"__u{prefix}"
    df = df.withColumn(t + "c", _clean(F.col(url)))
    c = F.col(t + "c")
    df = df.withColumns({t + "s": F.lower(F.regexp_extract(c, URL_RE, 1)),
                         t + "n": F.regexp_extract(c, URL_RE, 2),
                         t + "p": F.regexp_extract(c, URL_RE, 3),
                         t + "q": F.regexp_extract(c, URL_RE, 4)})
    df = df.withColumn(t + "i", F.regexp_extract(F.col(t + "n"), r"^(?:.*@)?(.*)$", 1))
    hi = F.col(t + "i")
    df = df.withColumn(t + "h", F.when(F.contains(hi, F.lit("[")), F.regexp_extract(hi, r"\[([^\]]*)", 1))
                       .otherwise(F.substring_index(hi, ":", 1)))
    h = F.col(t + "h")
    df = df.withColumn(t + "l", F.concat(F.lower(F.substring_index(h, "%", 1)),
                                         F.regexp_extract(h, r"(%.*)$", 1)))
    raw_path, scheme = F.col(t + "p"), F.col(t + "s")
    path = F.when(scheme.isin(*PARAM_SCHEMES) & F.contains(raw_path, F.lit(";")),
                  F.regexp_replace(raw_path, PARAMS_RE, "$1")).otherwise(raw_path)
    isnull = F.col(url).isNull()
    df = df.withColumns({
        prefix + "host": F.when(isnull, F.lit(None)).otherwise(F.nullif(F.col(t + "l"), F.lit(""))),
        prefix + "path": F.when(isnull, F.lit(None)).otherwise(path),
        prefix + "query": F.when(isnull, F.lit(None)).otherwise(F.col(t + "q")),
    })
    return df.drop(*[t + x for x in "csnpqihl"])


def url_host(url) -> Column:
    return url_parts(url)["host"]


def url_path(url) -> Column:
    return url_parts(url)["path"]


def url_query(url) -> Column:
    return url_parts(url)["query"]
