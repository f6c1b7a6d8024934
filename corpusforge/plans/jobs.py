"""The three entry points as Spark jobs (L1-L3).

* ``index_corpus``: route a dataset id, slice, map to records, upsert the
  meta and data tables (L1).
* ``write_actions``: the same records as files of bulk actions (A11).
* ``document_offsets``: byte range of every line of JSONL files, with the
  null/duplicate id check (L2).
* ``compressed_corpus``: per-document gzip members in part files plus the
  offsets manifest (L3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.operators.offsets import check_unique_ids, json_path, read_lines_with_offsets, slice_by_key
from corpusforge.plans import records
from corpusforge.plans.mappings import dataset_mapping
from corpusforge.sources import gzip_members, sink
from corpusforge.sources.corpus import require_documents


def index_corpus(spark: SparkSession, dataset_id: str, docs: DataFrame, meta_path: str, data_path: str,
                 bucket: str | None = None, start: int | None = None, end: int | None = None,
                 order_key: str | None = None, load: int = 1, collisions_path: str | None = None,
                 **sides) -> dict:
    """Index a corpus into the two keyed tables (L1).

    ``start``/``end`` select rows ``[start:end)`` in ``order_key`` order
    (Python slice semantics), and give the corpus order to mappings that
    keep the first row of an id. ``load`` numbers this run: a repeated run
    of one number replaces itself, a higher one replaces rows of equal
    keys. ``sides`` are the mapping's side tables (``offsets``, ``parents``,
    ``line_offsets``) and options (``text_fields``).
    """
    mapping = dataset_mapping(dataset_id)
    require_documents(docs, dataset_id)
    if start is not None or end is not None:
        if order_key is None:
            raise ValueError("A slice needs an order key (the corpus has no intrinsic order)")
        docs = slice_by_key(docs, order_key, start, end)
    if mapping.first_wins and order_key is not None:
        sides.setdefault("order_col", order_key)
    made = mapping.records(docs, bucket, **sides)
    return sink.write_index(made, meta_path, data_path, mapping.num_meta_shards,
                            mapping.num_data_shards, load, collisions_path=collisions_path)


def write_actions(spark: SparkSession, dataset_id: str, docs: DataFrame, out_path: str, meta_index: str, data_index: str,
                  bucket: str | None = None, compression: str = "gzip", **sides) -> None:
    """The written form of a corpus as files of JSON lines, as a search index's bulk loader takes them."""
    require_documents(docs, dataset_id)
    made = dataset_mapping(dataset_id).records(docs, bucket, **sides)
    records.written_actions(made, meta_index, data_index).write.mode("overwrite").option("compression", compression).text(out_path)


def document_offsets(spark: SparkSession, jsonl_path: str, out_path: str, id_field: str = "docno",
                     json_copy: str | None = None) -> DataFrame:
    """Byte offsets of every document of JSONL files (L2)."""
    offsets = read_lines_with_offsets(spark, jsonl_path, id_field)
    check_unique_ids(offsets, "doc_id")
    sink.write_offsets(offsets.select("doc_id", "start", "end", "file_path"), out_path, json_copy)
    return spark.read.parquet(out_path)


def compressed_corpus(spark: SparkSession, lines: DataFrame, order_key: str, out_dir: str,
                      manifest_path: str, num_tasks: int | None = None, id_field: str = "docno",
                      verify: bool = False, line_col: str = "line",
                      max_file_bytes: int = gzip_members.MAX_FILE_BYTES) -> DataFrame:
    """Write gzip-member part files and their offsets manifest (L3).

    ``verify``: read every document back by its byte range and compare it
    with its source line (a distributed round trip); mismatches fail the job.
    """
    written = gzip_members.write_member_files(lines, order_key, out_dir, manifest_path, num_tasks, id_field, line_col, max_file_bytes)
    if verify:
        source = lines.select(F.get_json_object(line_col, json_path(id_field)).alias("doc_id"),
                              F.col(line_col).alias("expected"))
        back = gzip_members.read_members(written, out_dir)
        bad = back.join(source, "doc_id", "full_outer").filter(
            ~F.col("line").eqNullSafe(F.col("expected"))).limit(5).collect()
        if bad:
            raise ValueError(f"Compressed corpus does not round-trip: {[r.doc_id for r in bad]}")
    return written
