"""Quality filters with skip reasons.

Instead of logging and dropping rows one by one, each row gets the first
failing reason in the reference's order; ``keep`` filters on it and
``skip_report`` counts reasons (a partial aggregate: a tiny result).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import replacement_count

MAX_REPLACEMENT_RATIO = 0.1
MIN_MAIN_CONTENT_LENGTH = 200

# Skip reasons in check order.
NO_BODY = "no_body"
EMPTY_FULL_TEXT = "empty_full_text"
TOO_MANY_REPLACEMENTS = "replacement_chars"
MAIN_TOO_SHORT = "main_content_too_short"


def skip_reason(has_body, full_text, main_text) -> Column:
    """First failing check: no body, empty text, > 10 % U+FFFD, main text < 200."""
    has_body = F.col(has_body) if isinstance(has_body, str) else has_body
    full = F.col(full_text) if isinstance(full_text, str) else full_text
    main = F.col(main_text) if isinstance(main_text, str) else main_text
    full_len = F.length(full)
    return (F.when(~F.coalesce(has_body, F.lit(False)), F.lit(NO_BODY))
             .when(F.coalesce(full_len, F.lit(0)) <= 0, F.lit(EMPTY_FULL_TEXT))
             .when(replacement_count(full) / full_len > MAX_REPLACEMENT_RATIO, F.lit(TOO_MANY_REPLACEMENTS))
             .when(F.coalesce(F.length(main), F.lit(0)) < MIN_MAIN_CONTENT_LENGTH, F.lit(MAIN_TOO_SHORT)))


def keep(df: DataFrame, reason_col: str = "skip_reason") -> DataFrame:
    return df.filter(F.col(reason_col).isNull())


def skip_report(df: DataFrame, reason_col: str = "skip_reason") -> DataFrame:
    """Rows per reason (``kept`` for rows that pass)."""
    return (df.groupBy(F.coalesce(F.col(reason_col), F.lit("kept")).alias("reason"))
              .agg(F.count(F.lit(1)).alias("n")))
