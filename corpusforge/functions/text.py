"""Text projections (C1, C7, C11-C16, D5 helpers) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.isspace`` (and hence ``\s`` in a
# ``str`` pattern and ``str.strip()``) treats as white space. Java's ``(?U)\s``
# lacks U+001C..U+001F and RE2's ``\s`` is ASCII only, so the class is spelt
# out; the same string works in Java regex and RE2 (DuckDB).
WS_CLASS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
WS_RUN = WS_CLASS + "{2,}"
# The non-ASCII members of WS_CLASS, as characters (for ``translate``), and
# the ASCII class: squashing maps the former to a tab, then rewrites only
# runs of two or more and lone non-space characters of the ASCII class.
WS_UNICODE_CHARS = ("\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
                    + "\u2028\u2029\u202f\u205f\u3000")
WS_ASCII_CLASS = r"[\t\n\x0b\x0c\r ]"
WS_SQUASH = WS_ASCII_CLASS + "{2,}|" + r"[\t\n\x0b\x0c\r]"
WS_EDGES = "^" + WS_CLASS + "+|" + WS_CLASS + "+$"

REPLACEMENT_CHAR = "�"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_whitespace(c) -> Column:
    """Runs of two or more white-space characters become one space, then trim.

    A lone newline or tab stays, as in the reference.
    """
    return F.regexp_replace(F.regexp_replace(_col(c), WS_RUN, " "), WS_EDGES, "")


def replacement_count(c) -> Column:
    """Number of U+FFFD characters in a string."""
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit(REPLACEMENT_CHAR), F.lit("")))


def replacement_ratio(c) -> Column:
    """Share of U+FFFD characters; null for empty strings."""
    c = _col(c)
    return replacement_count(c) / F.nullif(F.length(c), F.lit(0))


def replacement_clean(c) -> Column:
    """If any U+FFFD is present: replace each by a space, then collapse."""
    c = _col(c)
    return F.when(F.contains(c, F.lit(REPLACEMENT_CHAR)),
                  collapse_whitespace(F.replace(c, F.lit(REPLACEMENT_CHAR), F.lit(" ")))
                  ).otherwise(c)


def primary_language(c) -> Column:
    """Primary subtag: the part before the first underscore (C11)."""
    return F.substring_index(_col(c), "_", 1)


def default_text(*fields) -> Column:
    """A document's default text: its text fields joined by one space (C14)."""
    return F.concat_ws(" ", *[_col(f) for f in fields])


def code_point_length(c) -> Column:
    """Length in code points."""
    return F.length(_col(c))


def fallback_title(prefix: str, doc_id) -> Column:
    """``'<prefix> <id>'`` literals used when a corpus has no title."""
    return F.concat(F.lit(prefix + " "), _col(doc_id).cast("string"))
