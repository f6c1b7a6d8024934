"""Corpus mappings and the router.

A mapping turns a corpus DataFrame into the record frame of
``records.record_columns`` plus the key ``_id``: a pure projection/join plan
that Catalyst optimises as a whole. Side tables (offsets, parent metadata)
are DataFrames joined on their keys, never driver dictionaries.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions import ids, text, urls
from corpusforge.functions.html import extract_html_fields
from corpusforge.operators import dedupe, filters
from corpusforge.plans.records import record_columns

# Corpus settings (record month, storage buckets, shard counts).
TIREX_DATASETS = ("antique", "cord19/fulltext", "cranfield", "argsme/2020-04-01/processed",
                  "medline/2004", "medline/2017", "nfcorpus", "vaswani",
                  "longeval-sci/2024-11/train", "wows/owi/2025")
WEB_TYPE = "resource"
WEB_PLAINTEXT_TYPE = "application/x-ndjson+clueweb22"
WIKIDATA_URI = "https://www.wikidata.org/wiki/"
WIKIDATA_HOST = "wikipedia.org"


@dataclass(frozen=True)
class CorpusMapping:
    """How one corpus becomes meta and data records."""
    name: str
    corpus_prefix: str
    num_data_shards: int
    num_meta_shards: int
    build: Callable[..., DataFrame] = field(repr=False)

    @property
    def first_wins(self) -> bool:
        """Whether the first row of a repeated id counts."""
        return self.name in PLAIN_SPECS and PLAIN_SPECS[self.name].first_wins

    def records(self, docs: DataFrame, bucket: str | None = None, **sides) -> DataFrame:
        return self.build(self, docs, bucket, **sides)


def _c(name_or_col) -> Column:
    return F.col(name_or_col) if isinstance(name_or_col, str) else name_or_col


def attach_offsets(docs: DataFrame, offsets: DataFrame, strict: bool = True) -> DataFrame:
    """docs ⋈ offsets on ``doc_id``; a missing offset fails the job.

    A shuffle join on ``doc_id`` (AQE turns it into a broadcast only when
    the offsets side is measured small at run time).
    """
    # Of several entries of an id the last in the file counts, and no document is doubled.
    last = offsets.groupBy(F.col("doc_id").cast("string").alias("doc_id")).agg(F.max(F.struct("start", "end")).alias("o"))
    off = last.select("doc_id", F.col("o.start").alias("off_start"), F.col("o.end").alias("off_end"))
    joined = docs.join(off, "doc_id", "left")
    if strict:
        joined = joined.withColumn("off_start", F.when(
            F.col("off_start").isNull(),
            F.raise_error(F.concat(F.lit("No offset for document "), F.col("doc_id")))
        ).otherwise(F.col("off_start")))
    return joined


def last_parents(parents: DataFrame) -> DataFrame:
    """One row for each parent document: of repeated entries the last in the order of
    ``position`` (a file's line number, where the table has it), else the greatest (E2)."""
    order = [c for c in ("position",) if c in parents.columns]
    entry = F.struct(*order, F.col("title"), F.col("url"))
    last = parents.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("parent_id")).agg(F.max(entry).alias("p"))
    return last.select("parent_id", F.col("p.title").alias("p_title"), F.col("p.url").alias("p_url"))


def last_line_offsets(line_offsets: DataFrame) -> DataFrame:
    """One row for each (stem, doc_no), as a repeated line must not double a document.

    A null does not hide an offset that another row has.
    """
    return line_offsets.groupBy(F.col("stem").alias("__stem"), F.col("doc_no").alias("__doc_no")).agg(
        F.max("html_offset").alias("html_offset"), F.max("txt_offset").alias("txt_offset"))


def _required(offset: str, doc_id: str = "doc_id") -> Column:
    return F.coalesce(offset, F.raise_error(F.concat(F.lit("No line offset for document "), F.col(doc_id), F.lit(f" ({offset})"))).cast("bigint")).alias(offset)


def missing_offsets(docs: DataFrame, offsets: DataFrame) -> DataFrame:
    """Documents without an offset entry."""
    return docs.join(offsets.select(F.col("doc_id").cast("string").alias("doc_id")), "doc_id", "left_anti")


def _plain_data(uuid: Column, doc_id: Column, body: Column, **extra) -> dict:
    data = dict(uuid=uuid, lang=F.lit("en"), warc_trec_id=doc_id, http_content_type=F.lit("text/html"),
                body=body, body_length=F.length(body), full_body=body)
    data.update(extra)
    return data


def _url_fields(url: Column, parts: str = "__url_") -> dict:
    """Data fields of a URL whose parts were added by ``urls.with_url_parts(df, .., parts)``."""
    return dict(warc_target_uri=url, warc_target_hostname=F.col(parts + "host"),
                warc_target_path=F.col(parts + "path"), warc_target_query_string=F.col(parts + "query"))


@dataclass(frozen=True)
class PlainSpec:
    year: int
    month: int
    source_file: Callable[[DataFrame], Column] | str
    warc_path: Callable[[DataFrame], Column] | str
    offset: str = "table"            # table | id | zero
    content_length: bool = True       # end - start (Q1: the documented meaning)
    url: bool = True
    title: str = "title"              # title | passage | document_or_title | none
    meta: str = "full"                # full | plaintext
    first_wins: bool = False
    wikidata: bool = False
    text_fields: tuple[str, ...] = ("text",)  # what makes up the default text, where the corpus has these fields


def _lit_or(fn_or_str, df):
    return F.lit(fn_or_str) if isinstance(fn_or_str, str) else fn_or_str(df)


def build_plain(mapping: CorpusMapping, docs: DataFrame, bucket: str | None,
                offsets: DataFrame | None = None, parents: DataFrame | None = None,
                text_fields: Sequence[str] | None = None, order_col: str | None = None) -> DataFrame:
    """Records for the plain-text corpora.

    The default text (C14) is made up of ``text_fields``; without them of the
    corpus's own fields, or of ``text`` where the documents lack these.
    """
    spec: PlainSpec = PLAIN_SPECS[mapping.name]
    if text_fields is None:
        text_fields = spec.text_fields if set(spec.text_fields) <= set(docs.columns) else ("text",)
    df = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    if spec.first_wins:
        if order_col is None:
            raise ValueError(f"{mapping.name} keeps the first row of each id: give the column of the corpus order (order_col)")
        df = dedupe.keep_first(df, "doc_id", [order_col])
    if spec.offset == "table":
        df = attach_offsets(df, offsets)
        offset, length = F.col("off_start"), F.col("off_end") - F.col("off_start")
    elif spec.offset == "id":
        df = df.withColumn("__loc", msmarco_v21_location(F.col("doc_id"), mapping.name.endswith("segmented")))
        offset, length = F.col("__loc.offset"), None
    else:
        offset, length = F.lit(0).cast("bigint"), None
    if parents is not None:
        par = last_parents(parents)
        df = df.join(par, df["parent_doc_id"].cast("string") == par["parent_id"], "left")
        df = df.withColumn("p_title", F.when(F.col("parent_id").isNull(), F.raise_error(
            F.concat(F.lit("No parent document for passage "), F.col("doc_id")))).otherwise(F.col("p_title")))
    doc_id = F.col("doc_id")
    uuid = ids.doc_uuid(mapping.corpus_prefix, doc_id)
    body = text.default_text(*text_fields)
    warc_path = _lit_or(spec.warc_path, df)
    source_file = _lit_or(spec.source_file, df)
    record_ms = ids.month_utc_ms(spec.year, spec.month)

    extra = {}
    if parents is not None:
        df = urls.with_url_parts(df, "p_url", "__url_")
        extra.update(_url_fields(F.col("p_url")), title=F.col("p_title"))
    elif spec.wikidata:
        extra.update(warc_target_uri=F.concat(F.lit(WIKIDATA_URI), F.col("wikidata_id")),
                     warc_target_hostname=F.lit(WIKIDATA_HOST))
    elif spec.url and "url" in df.columns:
        df = urls.with_url_parts(df, "url", "__url_")
        extra.update(_url_fields(F.col("url")))
    if parents is None:
        if spec.title == "title":
            extra["title"] = F.col("title")
        elif spec.title == "passage":
            extra["title"] = text.fallback_title("Passage", doc_id)
        elif spec.title == "document_or_title":
            extra["title"] = F.col("title") if "title" in df.columns else text.fallback_title("Document", doc_id)
    data = _plain_data(uuid, doc_id, body, **extra)
    if spec.meta == "plaintext":
        meta = dict(plaintext_source_file=F.lit(""), plaintext_source_offset=F.lit(0),
                    plaintext_content_type=F.lit("application/json"))
    else:
        meta = dict(source_file=source_file, source_offset=offset, content_type=F.lit("application/json"),
                    uuid=uuid, warc_trec_id=doc_id)
        if spec.content_length and length is not None:
            meta["content_length"] = length
    key = ids.index_id(record_ms, offset, ids.storage_uri(bucket, warc_path), uuid)
    return df.select(key.alias("_id"), *record_columns(meta, data))


def msmarco_v21_location(doc_id: Column, segmented: bool) -> Column:
    """Bundle file and offset encoded in a v2.1 id (B6); malformed ids fail.

    ``msmarco_v2.1_doc_{bundle}_{pos}`` (5 parts) or, segmented,
    ``msmarco_v2.1_doc_{bundle}_{doc}_{pos}`` (6 parts).
    """
    parts = F.split(doc_id, "_", -1)
    n = 6 if segmented else 5
    ok = ((F.size(parts) == n) & (parts[0] == "msmarco") & (parts[1] == "v2.1") & (parts[2] == "doc"))
    stem = "msmarco_v2.1_doc_segmented_" if segmented else "msmarco_v2.1_doc_"
    path = F.concat(F.lit(stem), parts[3], F.lit(".json"))
    return F.when(ok, F.struct(path.alias("path"), F.element_at(parts, -1).cast("bigint").alias("offset"))
                  ).otherwise(F.raise_error(F.concat(F.lit("Malformed MS MARCO v2.1 id: "), doc_id)))


def _tirex_prefix(dataset_id: str) -> str:
    return dataset_id.replace("/", "-").lower()


def _tirex_suffix(dataset_id: str) -> str:
    # Q4: the compressed OWI corpus is uploaded as '.jsonl.gz'.
    return ".jsonl.gz" if dataset_id.startswith("wows/owi/") else ".jsonl"


def _v21_path(df):
    return F.col("__loc.path")


PLAIN_SPECS: dict[str, PlainSpec] = {
    "msmarco-document": PlainSpec(2018, 1, "s3://corpus-msmarco-document-v1/corpus.jsonl", "corpus.jsonl",
                                  text_fields=("title", "body")),
    "msmarco-passage": PlainSpec(2016, 1, "s3://corpus-msmarco-passage-v1/corpus.jsonl", "corpus.jsonl",
                                 url=False, title="passage"),
    "msmarco-document-v2": PlainSpec(2021, 1, "s3://corpus-msmarco-document-v2/corpus.jsonl", "corpus.jsonl",
                                     text_fields=("title", "headings", "body")),
    "msmarco-passage-v2": PlainSpec(2021, 1, "s3://corpus-msmarco-passage-v2/corpus.jsonl", "corpus.jsonl"),
    "msmarco-document-v2.1": PlainSpec(
        2022, 1, lambda df: F.concat(F.lit("s3://corpus-msmarco-document-v2.1/"), F.col("__loc.path")),
        _v21_path, offset="id", text_fields=("title", "headings", "body")),
    "msmarco-document-v2.1/segmented": PlainSpec(
        2022, 1, lambda df: F.concat(F.lit("s3://corpus-msmarco-document-v2.1-segmented/"), F.col("__loc.path")),
        _v21_path, offset="id", text_fields=("title", "headings", "segment")),
    "vaswani/plain": PlainSpec(2010, 1, "", "documents.jsonl", offset="zero", url=False, title="none",
                               meta="plaintext"),
    "trec-tot/2024": PlainSpec(2024, 1, "s3://corpus-trec-tot-2024/corpus.jsonl", "corpus.jsonl",
                               url=False, first_wins=True, wikidata=True),
}


def tirex_mapping(dataset_id: str) -> CorpusMapping:
    prefix, suffix = _tirex_prefix(dataset_id), _tirex_suffix(dataset_id)
    name = f"tirex:{dataset_id}"
    PLAIN_SPECS[name] = PlainSpec(2018, 1, f"s3://corpora-tirex-small/{prefix}-corpus{suffix}",
                                  f"{prefix}-corpus{suffix}", title="document_or_title")
    return CorpusMapping(name, prefix, 1, 1, build_plain)


# ---------------------------------------------------------------- web (F2)

def web_doc_location(doc_id: Column) -> Column:
    """``clueweb22-{subdir}-{file}-{doc}`` -> relative file stem and line number.

    Stem: ``{subdir[0:4]}/{subdir}/{subdir}-{file}``.
    """
    parts = F.split(doc_id, "-", -1)
    subdir = parts[1]
    stem = F.concat(F.substring(subdir, 1, 4), F.lit("/"), subdir, F.lit("/"), subdir, F.lit("-"), parts[2])
    return F.struct(stem.alias("stem"), parts[3].cast("bigint").alias("doc_no"))


# The two stored formats of a web document (id, file suffix).
WEB_FORMATS = {"html": ("html", ".warc.gz"), "txt": ("txt", ".json.gz")}


def build_web(mapping: CorpusMapping, docs: DataFrame, bucket: str | None,
              line_offsets: DataFrame | None = None, keep_skipped: bool = False) -> DataFrame:
    """Records for web pages (F2): HTML fields, quality filters, nth-line offsets.

    ``docs``: ``doc_id, url, html, date, language, url_hash, record_id,
    payload_digest`` and optionally ``text`` (main content; the extracted
    article text otherwise). ``line_offsets``: ``stem, doc_no, html_offset,
    txt_offset`` (the n-th line of each format's offsets file).
    """
    df = extract_html_fields(docs, "html", prefix="x_")
    main = F.col("text") if "text" in docs.columns else F.col("x_main_text")
    df = df.withColumn("__main", main).withColumn(
        "skip_reason", filters.skip_reason("x_has_body", "x_full_text", "__main"))
    # Optimisation barrier: the filter reads a non-deterministic column, so
    # Catalyst can neither prune it nor push the filter below the extraction
    # (which would inline the whole HTML chain a second time in the filter).
    df = df.withColumn("__barrier", F.spark_partition_id())
    if not keep_skipped:
        df = df.filter(F.col("skip_reason").isNull() & (F.col("__barrier") >= 0))
    df = urls.with_url_parts(df, "url", "__url_")
    df = df.withColumn("__loc", web_doc_location(F.col("doc_id")))
    lo = last_line_offsets(line_offsets)
    df = df.join(lo, (F.col("__loc.stem") == F.col("__stem")) & (F.col("__loc.doc_no") == F.col("__doc_no")), "left")
    # A document without a line in either format's offsets file fails the job (E3); a null key would swallow it.
    df = df.withColumns({c: _required(c) for c in ("html_offset", "txt_offset")})
    doc_id = F.col("doc_id")
    uuid = ids.doc_uuid(mapping.corpus_prefix, doc_id)
    html_path = F.concat(F.lit("html/"), F.col("__loc.stem"), F.lit(WEB_FORMATS["html"][1]))
    txt_path = F.concat(F.lit("txt/"), F.col("__loc.stem"), F.lit(WEB_FORMATS["txt"][1]))
    warc_file = ids.storage_uri(bucket, html_path)
    full = text.replacement_clean(F.col("x_full_text"))
    size = F.octet_length(F.col("html"))
    meta = dict(
        uuid=uuid, source_file=warc_file, source_offset=F.col("html_offset"), warc_type=F.lit(WEB_TYPE),
        warc_target_uri=F.col("url"), warc_target_uri_hash=F.col("url_hash"), warc_date=F.col("date"),
        warc_record_id=F.col("record_id").cast("string"), warc_trec_id=doc_id,
        warc_identified_payload_type=F.lit("text/html"), warc_payload_digest=F.col("payload_digest"),
        content_type=F.lit("text/html"), content_length=size, http_date=F.col("date"),
        http_content_type=F.lit("text/html"), http_content_length=size, content_encoding=F.lit("utf8"),
        plaintext_source_file=ids.storage_uri(bucket, txt_path),
        plaintext_source_offset=F.col("txt_offset"), plaintext_content_type=F.lit(WEB_PLAINTEXT_TYPE))
    data = dict(
        uuid=uuid, lang=text.primary_language(F.col("language")), warc_date=F.col("date"),
        warc_record_id=F.col("record_id").cast("string"), warc_trec_id=doc_id,
        warc_target_uri_hash=F.col("url_hash"), http_date=F.col("date"), http_content_type=F.lit("text/html"),
        title=F.col("x_title"), meta_keywords=F.col("x_meta_keywords"), meta_desc=F.col("x_meta_desc"),
        body=F.col("__main"), body_length=F.length(F.col("__main")), full_body=full,
        headings=F.col("x_headings"), **_url_fields(F.col("url")))
    key = ids.index_id(F.unix_millis(F.col("date")), F.col("html_offset"), warc_file, uuid)
    cols = [key.alias("_id"), *record_columns(meta, data)]
    if keep_skipped:
        cols.append(F.col("skip_reason"))
    return df.select(*cols)


# ---------------------------------------------------------------- router

MAPPINGS: dict[str, CorpusMapping] = {
    name: CorpusMapping(name, prefix, data_shards, meta_shards, build_plain)
    for name, prefix, data_shards, meta_shards in [
        ("msmarco-document", "msmarco-v1-document", 40, 10),
        ("msmarco-passage", "msmarco-1-passage", 40, 10),
        ("msmarco-document-v2", "msmarco-v2-document", 40, 10),
        ("msmarco-passage-v2", "msmarco-v2-passage", 40, 10),
        ("msmarco-document-v2.1", "msmarco-v2.1-document", 40, 10),
        ("msmarco-document-v2.1/segmented", "msmarco-v2.1-document-segmented", 40, 10),
        ("vaswani/plain", "vaswani", 1, 1),
        ("trec-tot/2024", "trec-tot-2024-document", 3, 1),
    ]
}
MAPPINGS["clueweb22"] = CorpusMapping("clueweb22", "clueweb22", 40, 10, build_web)

# Prefix rules, most specific first (Q2: the reference's order made the v2.1
# mappings unreachable).
_PREFIX_RULES = ["clueweb22", "msmarco-document-v2.1/segmented", "msmarco-document-v2.1",
                 "msmarco-document-v2", "msmarco-passage-v2", "msmarco-document", "msmarco-passage"]
_EXACT_RULES = ["trec-tot/2024", "vaswani/plain"]


def dataset_mapping(dataset_id: str) -> CorpusMapping:
    """Route a dataset id to its mapping: exact TIREx set, then prefixes."""
    if dataset_id in TIREX_DATASETS:
        return tirex_mapping(dataset_id)
    if dataset_id in _EXACT_RULES:
        return MAPPINGS[dataset_id]
    for prefix in _PREFIX_RULES:
        if dataset_id.startswith(prefix):
            return MAPPINGS[prefix]
    raise NotImplementedError(f"Dataset mapping for {dataset_id} is not implemented yet.")
