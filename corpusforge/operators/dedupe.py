"""Keyed de-duplication.

Both directions are aggregates with a map-side partial step (``min_by`` /
``max_by`` over a struct of the row), so a key holding a third of all rows
is folded inside each map task before the shuffle: no task ever receives
all rows of one key.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: Sequence[str] | str, order: Sequence[str], fn) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*keys).agg(fn(F.struct(*[F.col(c) for c in rest]), ordering).alias("__row"))
    return picked.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def keep_first(df: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order`` (first seen wins, G2/D7)."""
    return _pick(df, key, order, F.min_by)


def keep_last(df: DataFrame, key, order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order`` (last write wins, G5)."""
    return _pick(df, key, order, F.max_by)


def key_collisions(df: DataFrame, key: str = "_id", other: str = "uuid") -> DataFrame:
    """Keys shared by more than one distinct document.

    The index key keeps only 24 bits of the document hash, so distinct
    documents can collide and silently overwrite each other.
    """
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"),
                                F.countDistinct(other).alias("n_docs"))
              .filter(F.col("n_docs") > 1))
