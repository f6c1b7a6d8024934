"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words in every operator here: ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``, set for checkpoints too.

    Only a local session without that setting (tests) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new folder in the shared one and read back, for tables read column by column."""
    at = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(at)
    return df.sparkSession.read.parquet(at)


def words(text: Column) -> Column:
    """The words of a text as an array; null gives none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE, -1))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def lengths_of(text_col: str, tokens_col: str | None) -> Column:
    """Lengths of texts: their words, or what a column says (null: 0)."""
    return n_words(F.col(text_col)) if tokens_col is None else F.greatest(F.coalesce(F.col(tokens_col).cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))


def running_start(df: DataFrame, group: Sequence[str], order: str, value: str | None, out: str, slices: int = 1024) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one in its group.

    ``order`` is a hash of 63 bits (a long from 0 on, spread evenly); rows of equal ``order`` count
    as one step and get the same start. Without ``value`` rows are numbered
    from 0 instead, equal ones too. No group has to fit into one task: a
    group is cut into ``slices`` ranges of the hash, the ranges' totals (one
    narrow row each) are summed up first, and then each range by itself.
    Null group keys form a group.
    """
    part = "__slice"
    cutdf = df.withColumn(part, F.shiftrightunsigned(order, 63 - (slices - 1).bit_length()))
    keys = [f"__g{i}" for i in range(len(group))]
    totals = cutdf.groupBy(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(part).alias("__p")).agg((F.sum(value) if value else F.count("*")).alias("__total"))
    before = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__base", F.coalesce(F.sum("__total").over(before), F.lit(0))).drop("__total")
    on = F.col(part) == F.col("__p")
    for g, k in zip(group, keys):
        on = on & F.col(g).eqNullSafe(F.col(k))
    within = Window.partitionBy(*group, part).orderBy(order)
    if value:
        inside = F.coalesce(F.sum(value).over(within.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        inside = F.row_number().over(within) - 1
    joined = cutdf.join(totals, on)
    return joined.withColumn(out, F.col("__base") + inside).drop(part, "__p", "__base", *keys)


def order_hash(*cols: Column) -> Column:
    """63 bits from 0 on, for ``running_start`` and other orders by hash."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 1)
