"""Command line: the three jobs (index a corpus, document offsets, compressed corpus).

    python -m corpusforge index --dataset msmarco-document --docs docs/ --offsets off/ \\
        --meta out/meta --data out/data --bucket my-bucket [--start 0 --end 1000 --order-key n]
    python -m corpusforge offsets corpus.jsonl out/offsets [--docno docno]
    python -m corpusforge compress --docs docs/ --order-key doc_id --text text \\
        --out out/files --manifest out/manifest --files 64
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from corpusforge.operators.offsets import jsonl_lines
from corpusforge.plans import jobs
from corpusforge.session import get_session
from corpusforge.sources import gzip_members
from corpusforge.sources.corpus import read_corpus, read_offsets, read_parent_metadata, read_web_line_offsets


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="corpusforge")
    sub = ap.add_subparsers(dest="cmd", required=True)

    ix = sub.add_parser("index", help="map a corpus and write a load of the meta and data tables")
    ix.add_argument("--dataset", required=True)
    ix.add_argument("--docs", required=True)
    ix.add_argument("--format", default="parquet")
    ix.add_argument("--meta", required=True)
    ix.add_argument("--data", required=True)
    ix.add_argument("--bucket")
    ix.add_argument("--start", type=int)
    ix.add_argument("--end", type=int)
    ix.add_argument("--order-key")
    ix.add_argument("--load", type=int, default=1, help="number of this run; repeating a number replaces it")
    ix.add_argument("--collisions", help="folder for documents whose key another one holds (else the job fails)")
    ix.add_argument("--text", nargs="+", help="fields that make up the text, in order (default: per corpus)")
    ix.add_argument("--offsets", help="offsets table (doc_id, start, end)")
    ix.add_argument("--parents", help="JSON lines with original_document.{doc_id,title,url}")
    ix.add_argument("--line-offsets", help="table (stem, doc_no, html_offset, txt_offset)")
    ix.add_argument("--html-offsets", help="instead: line offsets files of the html format (with --txt-offsets)")
    ix.add_argument("--txt-offsets", help="line offsets files of the text format")

    of = sub.add_parser("offsets", help="byte offsets of every document of JSONL files")
    of.add_argument("path")
    of.add_argument("out")
    of.add_argument("--docno", default="docno")
    of.add_argument("--json-copy")

    cp = sub.add_parser("compress", help="per-document gzip members plus offsets manifest")
    cp.add_argument("--docs", required=True)
    cp.add_argument("--format", default="parquet")
    cp.add_argument("--order-key", required=True)
    cp.add_argument("--id-col", default="doc_id")
    cp.add_argument("--text", nargs="+", default=["text"])
    cp.add_argument("--out", required=True)
    cp.add_argument("--manifest", required=True)
    cp.add_argument("--tasks", type=int, help="tasks that write (default: as Spark shuffles)")
    cp.add_argument("--max-file-bytes", type=int, default=gzip_members.MAX_FILE_BYTES)
    cp.add_argument("--verify", action="store_true", help="read every document back and compare")

    args = ap.parse_args(argv)
    spark = get_session()
    if args.cmd == "index":
        docs = read_corpus(spark, args.docs, args.format)
        sides = {}
        if args.offsets:
            sides["offsets"] = read_offsets(spark, args.offsets)
        if args.parents:
            sides["parents"] = read_parent_metadata(spark, args.parents)
        if args.line_offsets:
            sides["line_offsets"] = spark.read.parquet(args.line_offsets)
        elif args.html_offsets and args.txt_offsets:
            sides["line_offsets"] = read_web_line_offsets(spark, args.html_offsets, args.txt_offsets)
        if args.text:
            sides["text_fields"] = tuple(args.text)
        out = jobs.index_corpus(spark, args.dataset, docs, args.meta, args.data, args.bucket, args.start, args.end,
                                args.order_key, args.load, args.collisions, **sides)
        print(json.dumps(out))
    elif args.cmd == "offsets":
        res = jobs.document_offsets(spark, args.path, args.out, args.docno, args.json_copy)
        print(json.dumps({"documents": res.count()}))
    else:
        docs = read_corpus(spark, args.docs, args.format)
        keep = [args.order_key] if args.order_key != args.id_col else []
        lines = jsonl_lines(docs.withColumn("__order", F.col(args.order_key)), args.id_col, args.text,
                            keep=["__order"] + keep)
        res = jobs.compressed_corpus(spark, lines, "__order", args.out, args.manifest, args.tasks,
                                     verify=args.verify, max_file_bytes=args.max_file_bytes)
        print(json.dumps({"documents": res.count()}))


if __name__ == "__main__":
    main()
