"""Corpus and side-table sources.

All readers return lazy DataFrames with explicit schemas (no inference).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

OFFSETS_SCHEMA = StructType([StructField("doc_id", StringType()), StructField("start", LongType()),
                             StructField("end", LongType())])


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
                min_partitions: int | None = None) -> DataFrame:
    """A corpus as a DataFrame (A1): parquet, JSON lines or text.

    Splits follow ``spark.sql.files.maxPartitionBytes``. ``min_partitions``
    deals the rows anew, for a corpus that is one unsplittable file.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    return df.repartition(min_partitions) if min_partitions else df


def require_documents(df: DataFrame, name: str = "corpus") -> DataFrame:
    """Fail when the corpus has no documents (A2); one single-row probe."""
    if df.isEmpty():
        raise ValueError(f"Dataset {name} has no documents.")
    return df


def read_offsets(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """An offsets table ``(doc_id, start, end)`` (A4, native form)."""
    return spark.read.schema(OFFSETS_SCHEMA).format(fmt).load(path)


#: An entry of a legacy offsets file up to its closing brace: the quoted id and what the inner object holds.
ENTRY_RE = r'^[\s,{]*("(?:[^"\\]|\\.)*")\s*:\s*\{([^{}]*)$'


def import_offsets_dict(spark: SparkSession, path: str) -> DataFrame:
    """Import a legacy offsets file: one (gzip) JSON object ``{id: {start, end}}`` (A4).

    The file is read in pieces that end at closing braces, so Spark splits an
    uncompressed one over its tasks (a gzip file is one task's, piece by
    piece). A piece that is not one entry, or an entry without both numbers,
    fails the job, such as an id that holds a brace.
    """
    pieces = spark.read.text(path, lineSep="}").where(~F.col("value").rlike(r"^\s*$"))
    named, inner = F.regexp_extract("value", ENTRY_RE, 1), F.regexp_extract("value", ENTRY_RE, 2)
    doc_id = F.get(F.from_json(F.concat(F.lit("["), named, F.lit("]")), "array<string>"), 0)
    span = F.from_json(F.concat(F.lit("{"), inner, F.lit("}")), "start bigint, end bigint")
    found = pieces.select("value", doc_id.alias("doc_id"), span.alias("span"))
    ok = F.col("doc_id").isNotNull() & F.col("span.start").isNotNull() & F.col("span.end").isNotNull()
    # An empty object is one piece of an opening brace alone.
    found = found.where(ok | ~F.col("value").rlike(r"^\s*\{\s*$"))
    failed = F.raise_error(F.concat(F.lit("Not an entry of an offsets file: "), F.substring("value", 1, 200)))
    return found.select("doc_id", F.when(ok, F.col("span.start")).otherwise(failed.cast("bigint")).alias("start"), F.col("span.end").alias("end"))


def read_parent_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Parent-document metadata from JSON lines: ``original_document.{doc_id,title,url}`` (A5).

    ``position`` orders the lines of all files, so that of repeated entries the last one can count.
    """
    schema = StructType([StructField("original_document", StructType([
        StructField("doc_id", StringType()), StructField("title", StringType()),
        StructField("url", StringType())]))])
    df = spark.read.schema(schema).json(path)
    return df.select(F.col("original_document.doc_id").alias("doc_id"),
                     F.col("original_document.title").alias("title"),
                     F.col("original_document.url").alias("url"),
                     F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                              F.monotonically_increasing_id().alias("row")).alias("position"))


def read_line_offsets(spark: SparkSession, path: str, stem_pattern: str = r"([^/]+/[^/]+/[^/.]+)\.[^/]*$") -> DataFrame:
    """Offsets files where line *n* is the byte offset of document *n*.

    Returns ``(stem, doc_no, offset)``. Each file is small (one line per
    document of one data file) and read whole, so line numbers are exact.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.regexp_extract(F.col("_metadata.file_path"), stem_pattern, 1).alias("stem"),
        F.col("value"))
    lines = files.select("stem", F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n"))
                         .alias("doc_no", "line"))
    return lines.select("stem", F.col("doc_no").cast("bigint").alias("doc_no"),
                        F.trim("line").cast("bigint").alias("offset"))


def read_web_line_offsets(spark: SparkSession, html_path: str, txt_path: str) -> DataFrame:
    """Offsets files of both formats of a web corpus as one table.

    Returns ``(stem, doc_no, html_offset, txt_offset)``, what the web mapping
    takes; a line that only one format has keeps a null for the other.
    """
    html = read_line_offsets(spark, html_path).withColumnRenamed("offset", "html_offset")
    txt = read_line_offsets(spark, txt_path).withColumnRenamed("offset", "txt_offset")
    return html.join(txt, ["stem", "doc_no"], "full_outer")
