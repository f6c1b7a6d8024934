"""

Every query reads the shared tables of ``sf_dir`` in full (or tables Spark
derives from them) and returns a DataFrame; ``oracle_sql`` gives the same
result as DuckDB SQL over the same tables. Column names match on both sides.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from corpusforge.functions import analyze, ids, text, urls  # noqa: E402
from corpusforge.functions.html import extract_html_fields  # noqa: E402
from corpusforge.operators import dedupe, filters, offsets, ranked, search  # noqa: E402
from corpusforge.plans import mappings, records, standins  # noqa: E402
from corpusforge.sources import gzip_members, sink  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
BUCKET = "corpus-bucket"
SLICE = (100, -100)
FILTER_LANG, FILTER_MIN, FILTER_MAX = "fr", 500, 5000
FILTER_HOST = "thther.example.org"
FILTER_SINCE, FILTER_UNTIL = "2022-01-02T00:00:00+00:00", "2022-01-06T00:00:00+00:00"
TOPK = 10
LANGS = ("en", "fr", "de", "es")
VOCABULARY_LANGS = ("fi", "hu", "it", "pt", "ru", "sv")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return standins.table(spark, sf_dir, name)


def _lst(c) -> F.Column:
    return F.array_join(c, " | ")


# ------------------------------------------------------------------ keys (B)

def q_doc_uuid(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", ids.doc_uuid("corpus", "doc_id").alias("uuid"))


def q_index_id_bits(spark, sf_dir):
    off = standins.plain_offsets(_t(spark, sf_dir, "documents"))
    return off.select("doc_id", ids.index_id_fields(ids.month_utc_ms(2018, 1), "start").alias("bits"))


def q_index_id(spark, sf_dir):
    off = standins.plain_offsets(_t(spark, sf_dir, "documents"))
    uuid = ids.doc_uuid("corpus", "doc_id")
    return off.select("doc_id", ids.index_id(ids.month_utc_ms(2018, 1), "start",
                                             ids.storage_uri(BUCKET, "corpus.jsonl"), uuid).alias("_id"))


# ------------------------------------------------------------------ text (C)

def _spaced_text(c):
    return F.concat(F.lit(" "), F.replace(F.replace(c, F.lit(". "), F.lit(".\t  ")), F.lit("\n"), F.lit(" \n\n")),
                    F.lit("\n "))


def q_collapse_whitespace(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    c = text.collapse_whitespace(_spaced_text(F.col("text")))
    return d.select("doc_id", c.alias("collapsed"), F.length(c).cast("bigint").alias("n"))


def _fffd_text():
    return (F.when(F.col("doc_id") % 7 == 0, F.replace("text", F.lit("e"), F.lit(text.REPLACEMENT_CHAR)))
             .when(F.col("doc_id") % 7 == 1, F.replace("text", F.lit("the"), F.lit(" " + text.REPLACEMENT_CHAR + " ")))
             .otherwise(F.col("text")))


def q_replacement_clean(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").withColumn("t", _fffd_text())
    ratio = text.replacement_ratio("t")
    return d.select("doc_id", text.replacement_count("t").cast("bigint").alias("n_fffd"),
                    F.round(ratio, 6).alias("ratio"),
                    (F.coalesce(ratio, F.lit(0.0)) <= filters.MAX_REPLACEMENT_RATIO).alias("keep"),
                    text.replacement_clean("t").alias("cleaned"))


def _all_urls(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select(F.lit("page").alias("src"), F.col("page_id").alias("id"), "url")
    docs = standins.plain_docs(_t(spark, sf_dir, "documents")).select(
        F.lit("doc").alias("src"), F.col("n").alias("id"), "url")
    return pages.unionByName(docs)


def q_url_parts(spark, sf_dir):
    u = urls.with_url_parts(_all_urls(spark, sf_dir), "url", "p_")
    return u.select("src", "id", F.col("p_host").alias("host"), F.col("p_path").alias("path"), F.col("p_query").alias("query"))


def _html(spark, sf_dir):
    return extract_html_fields(standins.inject_page_features(_t(spark, sf_dir, "pages")), "html")


def q_page_title(spark, sf_dir):
    return _html(spark, sf_dir).select("page_id", "title", "has_body", "html_lang")


def q_page_text(spark, sf_dir):
    return _html(spark, sf_dir).select("page_id", "full_text", "main_text")


def q_page_headings(spark, sf_dir):
    h = _html(spark, sf_dir)
    return h.select("page_id", _lst("headings").alias("headings"), F.size("headings").cast("bigint").alias("n"))


def q_page_meta(spark, sf_dir):
    h = _html(spark, sf_dir)
    return h.select("page_id", "meta_desc", _lst("meta_keywords").alias("keywords"),
                    F.size("meta_keywords").cast("bigint").alias("n_keywords"))


# ------------------------------------------------------------------ offsets (A/H/G)

def q_jsonl_offsets(spark, sf_dir):
    return standins.plain_offsets(_t(spark, sf_dir, "documents"))


def _content_ids(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select(F.md5("text").alias("content_id"), "doc_id", "lang")


def q_duplicate_ids(spark, sf_dir):
    return offsets.duplicate_ids(_content_ids(spark, sf_dir), "content_id").select(
        F.col("doc_id").alias("content_id"), F.col("n").cast("bigint").alias("n"))


def q_corpus_slice(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return offsets.corpus_slice(d, "doc_id", *SLICE).select("doc_id", "lang", "position")


def q_keep_first(spark, sf_dir):
    return dedupe.keep_first(_content_ids(spark, sf_dir), "content_id", ["doc_id"]).select(
        "content_id", "doc_id", "lang")


def q_gzip_members(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    lines = offsets.jsonl_lines(d.withColumn("__n", F.col("doc_id")), "doc_id", ["text"], keep=["__n"])
    return gzip_members.member_offsets(lines, "__n").select("doc_id", "start", "end")


# ------------------------------------------------------------------ mappings (F)

PLAIN_OUT = ["m_uuid", "m_source_file", "m_source_offset", "m_content_length", "m_content_type",
             "m_warc_trec_id", "m_plaintext_source_file", "m_plaintext_source_offset",
             "m_plaintext_content_type", "d_uuid", "d_lang", "d_warc_trec_id", "d_warc_target_uri",
             "d_warc_target_hostname", "d_warc_target_path", "d_warc_target_query_string",
             "d_http_content_type", "d_title", "d_body", "d_body_length", "d_full_body"]


def _plain(spark, sf_dir, name, kind="docs"):
    m = mappings.dataset_mapping(name)
    if kind == "passages":
        conv = _t(spark, sf_dir, "conversations")
        return m.records(standins.passages(conv), BUCKET, offsets=standins.passage_offsets(conv),
                         parents=standins.parent_documents(conv))
    docs = standins.plain_docs(_t(spark, sf_dir, "documents"))
    if kind == "v21":
        off = standins.plain_offsets(_t(spark, sf_dir, "documents")).select(
            F.col("doc_id").alias("__d"), "start")
        docs = docs.join(off, docs["doc_id"] == off["__d"]).withColumn(
            "doc_id", F.concat(F.lit("msmarco_v2.1_doc_"), F.lpad((F.col("n") / 100).cast("bigint").cast("string"), 2, "0"),
                               F.lit("_"), F.col("start").cast("string"))).drop("__d", "start")
        return m.records(docs, BUCKET)
    if kind == "v21seg":
        conv = _t(spark, sf_dir, "conversations")
        off = standins.passage_offsets(conv)
        p = standins.passages(conv).join(off, "doc_id")
        p = p.withColumn("doc_id", F.concat(
            F.lit("msmarco_v2.1_doc_"), F.lpad((F.col("conv_id") / 100).cast("bigint").cast("string"), 2, "0"),
            F.lit("_"), F.col("conv_id").cast("string"), F.lit("#"), F.col("turn").cast("string"),
            F.lit("_"), F.col("start").cast("string"))).withColumn("url", F.concat(
                F.lit("https://chat.example.org/c/"), F.col("conv_id").cast("string"))).withColumn(
            "title", F.concat(F.lit("Turn "), F.col("turn").cast("string")))
        return m.records(p.drop("start", "end"), BUCKET)
    if kind == "tot":
        d = _t(spark, sf_dir, "documents")
        docs = d.select(F.md5("text").alias("doc_id"), F.col("doc_id").alias("n"), "text",
                        F.substring_index("text", "\n", 1).alias("title"),
                        F.concat(F.lit("Q"), F.col("doc_id").cast("string")).alias("wikidata_id"))
        off = offsets.jsonl_offsets(offsets.jsonl_lines(docs, "doc_id", ["text"], keep=["n"]), "n")
        off = dedupe.keep_first(off.select("doc_id", "start", "end"), "doc_id", ["start"])
        return m.records(docs, BUCKET, offsets=off, order_col="n")
    if kind == "notitle":
        docs = docs.drop("title")
    if kind == "vaswani":
        return m.records(docs, BUCKET)
    return m.records(docs, BUCKET, offsets=standins.plain_offsets(_t(spark, sf_dir, "documents")))


def _plain_query(name, kind="docs"):
    def run(spark, sf_dir):
        return _plain(spark, sf_dir, name, kind).select(*PLAIN_OUT)
    return run


def _web_records(spark, sf_dir, pages=None, keep_skipped=False):
    pages = pages if pages is not None else _t(spark, sf_dir, "pages")
    docs = standins.web_docs(standins.inject_page_features(pages))
    m = mappings.dataset_mapping("clueweb22")
    return m.records(docs, BUCKET, line_offsets=standins.web_line_offsets(docs), keep_skipped=keep_skipped)


WEB_OUT = ["m_uuid", "m_source_file", "m_source_offset", "m_warc_type", "m_warc_target_uri",
           "m_warc_target_uri_hash", "m_warc_record_id", "m_warc_trec_id", "m_warc_payload_digest",
           "m_content_length", "m_http_content_length", "m_content_encoding", "m_plaintext_source_file",
           "m_plaintext_source_offset", "m_plaintext_content_type", "d_lang", "d_warc_target_hostname",
           "d_warc_target_path", "d_warc_target_query_string", "d_title", "d_meta_desc", "d_body",
           "d_body_length", "d_full_body"]


def q_map_web(spark, sf_dir):
    r = _web_records(spark, sf_dir)
    return r.select(*WEB_OUT, records.iso_seconds("m_warc_date").alias("m_warc_date"),
                    _lst("d_meta_keywords").alias("d_meta_keywords"), _lst("d_headings").alias("d_headings"))


def _damaged_pages(spark, sf_dir):
    p = _t(spark, sf_dir, "pages")
    kind = F.col("page_id") % 10
    html = (F.when(kind == 1, F.regexp_replace("html", r"(?s)<body>.*$", "<frameset></frameset>"))
             .when(kind == 2, F.replace("html", F.lit("</body>"), F.concat(
                 F.repeat(F.lit(text.REPLACEMENT_CHAR), F.length("html")), F.lit("</body>"))))
             .when(kind == 3, F.regexp_replace("html", r"(?s)<article>.*</article>", "<article><p>Short.</p></article>"))
             .when(kind == 4, F.regexp_replace("html", r"(?s)<body>.*$", "<body> </body>"))
             .otherwise(F.col("html")))
    return p.select("page_id", "url", html.alias("html"))


def q_quality_skip_report(spark, sf_dir):
    r = _web_records(spark, sf_dir, pages=_damaged_pages(spark, sf_dir), keep_skipped=True)
    return filters.skip_report(r).select("reason", F.col("n").cast("bigint").alias("n"))


def q_missing_offsets(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    docs = standins.plain_docs(d)
    partial = standins.plain_offsets(d.filter(F.col("lang") != "fr"))
    return mappings.missing_offsets(docs, partial).select("doc_id", "lang")


def q_two_table_index(spark, sf_dir):
    r = _plain(spark, sf_dir, "msmarco-document")
    # The key itself needs BLAKE2b, which DuckDB lacks; its parts have oracles of their own.
    return records.paired(r).select(F.col("meta.uuid").alias("meta_uuid"), F.col("data.uuid").alias("data_uuid"),
                                    F.length("_id").cast("bigint").alias("key_length"))


def q_written_actions(spark, sf_dir):
    # Both lines of every document, read back from the written form (the key needs BLAKE2b, which DuckDB lacks).
    r = _plain(spark, sf_dir, "msmarco-document")
    x = records.written_actions(r, "corpus-meta", "corpus-data")
    fields = [("_op_type", "op"), ("_index", "idx"), ("uuid", "uuid"), ("warc_trec_id", "trec_id"), ("source_offset", "source_offset"),
              ("title_lang_en", "title"), ("body_length", "body_length")]
    return x.select(*[F.get_json_object("value", f"$.{f}").alias(a) for f, a in fields],
                    F.length(F.get_json_object("value", "$._id")).cast("bigint").alias("key_length"))


def q_upsert_last_wins(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")

    def rows(docs, body, version):
        return docs.select(ids.doc_uuid("corpus", "doc_id").alias("uuid"), "doc_id", F.lit(version).cast("bigint").alias("version"),
                           F.length(body).cast("bigint").alias("body_length"))

    stored = rows(d, F.col("text"), 1)
    batch = rows(d.filter(F.col("doc_id") % 5 == 0), F.concat("text", F.lit(" (rev 2)")), 2)
    return sink.upsert(stored, batch, "uuid", ("version",))


def q_collision_losers(spark, sf_dir):
    # As for key_collisions, three documents in a row share a key.
    d = _t(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 3).cast("bigint").alias("_id"), "n_chars", "doc_id")
    return sink.collision_losers(d, "_id", ("n_chars", "doc_id")).select("_id", "doc_id")


def q_load_collisions(spark, sf_dir):
    # Two loads of which the second brings other documents under keys of the first.
    d = _t(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 3).cast("bigint").alias("_id"), ids.doc_uuid("corpus", "doc_id").alias("uuid"), "doc_id")
    return sink.foreign_rows(d.where("doc_id % 2 = 1 or doc_id % 5 = 0"), d.where("doc_id % 6 = 0")).select("_id", "uuid", "doc_id")


def q_passage_parents(spark, sf_dir):
    # Every parent twice, and the later entry counts.
    conv = _t(spark, sf_dir, "conversations")
    first = standins.parent_documents(conv).withColumn("position", F.lit(1))
    later = first.withColumn("position", F.lit(2)).withColumn("title", F.concat(F.lit("Later: "), F.coalesce("title", F.lit(""))))
    m = mappings.dataset_mapping("msmarco-passage-v2")
    r = m.records(standins.passages(conv), BUCKET, offsets=standins.passage_offsets(conv), parents=first.unionByName(later))
    return r.select("m_uuid", "d_warc_trec_id", "d_title", "d_warc_target_uri")


def q_key_collisions(spark, sf_dir):
    # Real keys hardly ever collide here: a key that three documents in a row share stands in.
    d = _t(spark, sf_dir, "documents").select(F.floor(F.col("doc_id") / 3).cast("bigint").alias("_id"), ids.doc_uuid("corpus", "doc_id").alias("uuid"))
    return dedupe.key_collisions(d).select("_id", F.col("n_rows").cast("bigint").alias("n_rows"), F.col("n_docs").cast("bigint").alias("n_docs"))


def q_typed_fields(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    length = F.when(F.col("doc_id") % 5 == 0, F.col("source")).when(F.col("doc_id") % 5 != 1, F.col("n_chars").cast("string"))
    raw = d.select("doc_id", "lang", length.alias("body_length"), F.col("n_chars").cast("string").alias("spam_rank"))
    return records.typed_fields(raw).withColumn("bad_fields", _lst("bad_fields"))


def q_parent_metadata(spark, sf_dir):
    return standins.parent_documents(_t(spark, sf_dir, "conversations"))


def q_keyword_lower(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", analyze.keyword_lower(F.upper("url")).alias("keyword"))


def _web_data(spark, sf_dir):
    return records.data_table(_web_records(spark, sf_dir))


def q_stored_view(spark, sf_dir):
    wide = records.stored_view(records.language_columns(_web_data(spark, sf_dir), LANGS))
    cols = ["uuid", "lang"] + [f"{f}_lang_{l}" for f in ("title", "meta_desc") for l in LANGS]
    return wide.select(*cols, "body_length")


def q_record_wide_json(spark, sf_dir):
    data = _web_data(spark, sf_dir)
    js = records.wide_json(data)
    x = data.select("uuid", "lang", js.alias("js"))
    return x.select("uuid", "lang",
                    F.expr("get_json_object(js, concat('$.title_lang_', lang))").alias("title"),
                    F.get_json_object("js", "$.body_length").alias("body_length"),
                    F.get_json_object("js", "$.warc_date").alias("warc_date"),
                    F.size(F.json_object_keys("js")).cast("bigint").alias("n_keys"))


# ------------------------------------------------------------------ analyzers / search (K)

def q_host_tokens(spark, sf_dir):
    u = urls.with_url_parts(_all_urls(spark, sf_dir), "url", "p_")
    return u.select("src", "id", _lst(analyze.host_tokens(F.col("p_host"))).alias("tokens"))


def q_path_tokens(spark, sf_dir):
    u = urls.with_url_parts(_all_urls(spark, sf_dir), "url", "p_")
    return u.select("src", "id", _lst(analyze.path_tokens(F.col("p_path"))).alias("tokens"))


def q_query_tokens(spark, sf_dir):
    u = urls.with_url_parts(_all_urls(spark, sf_dir), "url", "p_")
    return u.select("src", "id", _lst(analyze.query_tokens(F.col("p_query"))).alias("tokens"))


def _lang_tokens(lang):
    def run(spark, sf_dir):
        d = _t(spark, sf_dir, "documents").filter(F.col("lang") == lang)
        t = analyze.language_tokens(F.col("text"), lang)
        return d.select("doc_id", _lst(t).alias("tokens"), F.size(t).cast("bigint").alias("n"))
    return run


def _doc_terms(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return search.doc_terms(d, "doc_id", "text", lang_col="lang", languages=LANGS, mark=True)


def q_postings(spark, sf_dir):
    return search.postings(_doc_terms(spark, sf_dir)).select("term", "doc_id", "tf")


def _fielded(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").withColumn("title", F.substring_index("text", "\n", 1))
    return search.positional_postings(d, {"title": "title", "body": "text"}, lang_col="lang", languages=LANGS)


def q_postings_by_field(spark, sf_dir):
    return _fielded(spark, sf_dir).select("field", "lang", "term", "doc_id", "tf", F.element_at("positions", 1).cast("bigint").alias("first"),
                                          F.element_at("positions", -1).cast("bigint").alias("last"))


def q_phrase_matches(spark, sf_dir):
    # Each benchmark text is asked for as a phrase of its first five words, in every language.
    asked = search.query_terms(_t(spark, sf_dir, "benchmark"), "item_id", "text", LANGS)
    asked = asked.select("qid", F.lit("body").alias("field"), "lang", F.slice("tokens", 1, 5).alias("tokens"))
    return search.phrase_matches(_fielded(spark, sf_dir).where("field = 'body'"), asked).select("qid", "lang", "doc_id", "n")


def q_term_stats(spark, sf_dir):
    st = search.term_stats(search.postings(_doc_terms(spark, sf_dir)))
    return st.select("term", F.col("df").cast("bigint").alias("df"), F.col("cf").cast("bigint").alias("cf"))


def q_vocabulary_terms(spark, sf_dir):
    # The distinct words once through the chains of the languages whose stems have several stages.
    words = ranked.word_rows(_t(spark, sf_dir, "documents"), "doc_id", "text", F.lit("default"))
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("word", "n", *[analyze.language_term(F.col("word"), l).alias(f"{l}_term") for l in VOCABULARY_LANGS])


def q_host_facets(spark, sf_dir):
    return search.host_facets(_web_data(spark, sf_dir)).select("host", F.col("n").cast("bigint").alias("n"))


def q_field_filter(spark, sf_dir):
    data = records.data_table(_plain(spark, sf_dir, "msmarco-document"))
    docs = standins.plain_docs(_t(spark, sf_dir, "documents")).select(
        F.col("doc_id").alias("warc_trec_id"), F.col("lang").alias("doc_lang"))
    data = data.join(docs, "warc_trec_id").withColumn("lang", F.col("doc_lang"))
    return search.field_filter(data, lang=FILTER_LANG, min_length=FILTER_MIN, max_length=FILTER_MAX).select(
        "uuid", "warc_trec_id", "body_length")


def q_host_filter(spark, sf_dir):
    return search.field_filter(_web_data(spark, sf_dir), host=FILTER_HOST).select("uuid", "warc_target_hostname", "body_length")


def q_date_filter(spark, sf_dir):
    return search.field_filter(_web_data(spark, sf_dir), since=FILTER_SINCE, until=FILTER_UNTIL).select(
        "uuid", records.iso_seconds("warc_date").alias("warc_date"))


def q_bm25_topk(spark, sf_dir):
    # One field over all languages, and queries analysed as English, as this key's oracle has it.
    queries = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), F.lit(ranked.POOLED).alias("lang"),
                                                    analyze.language_tokens(F.col("text"), "en").alias("tokens"))
    top = ranked.bm25_topk(_t(spark, sf_dir, "documents"), queries, TOPK, lang_col="lang", languages=LANGS, pooled=True)
    return top.select("qid", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


def q_bm25_topk_by_lang(spark, sf_dir):
    # A field per language, and queries analysed in every language.
    queries = search.query_terms(_t(spark, sf_dir, "benchmark"), "item_id", "text", LANGS)
    top = ranked.bm25_topk(_t(spark, sf_dir, "documents"), queries, TOPK, lang_col="lang", languages=LANGS)
    return top.select("qid", "doc_id", "score", F.col("rank").cast("bigint").alias("rank"))


# ------------------------------------------------------------------ registry

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "doc_uuid": q_doc_uuid,
    "index_id_bits": q_index_id_bits,
    "index_id": q_index_id,
    "collapse_whitespace": q_collapse_whitespace,
    "replacement_clean": q_replacement_clean,
    "url_parts": q_url_parts,
    "page_title": q_page_title,
    "page_text": q_page_text,
    "page_headings": q_page_headings,
    "page_meta": q_page_meta,
    "jsonl_offsets": q_jsonl_offsets,
    "duplicate_ids": q_duplicate_ids,
    "corpus_slice": q_corpus_slice,
    "keep_first": q_keep_first,
    "gzip_members": q_gzip_members,
    "map_v1_document": _plain_query("msmarco-document"),
    "map_v1_passage": _plain_query("msmarco-passage"),
    "map_v2_document": _plain_query("msmarco-document-v2"),
    "map_v2_passage": _plain_query("msmarco-passage-v2", "passages"),
    "map_v21_document": _plain_query("msmarco-document-v2.1", "v21"),
    "map_v21_segmented": _plain_query("msmarco-document-v2.1/segmented", "v21seg"),
    "map_tirex": _plain_query("cranfield", "notitle"),
    "map_trec_tot": _plain_query("trec-tot/2024", "tot"),
    "map_vaswani": _plain_query("vaswani/plain", "vaswani"),
    "map_web": q_map_web,
    "quality_skip_report": q_quality_skip_report,
    "missing_offsets": q_missing_offsets,
    "two_table_index": q_two_table_index,
    "written_actions": q_written_actions,
    "upsert_last_wins": q_upsert_last_wins,
    "key_collisions": q_key_collisions,
    "collision_losers": q_collision_losers,
    "load_collisions": q_load_collisions,
    "passage_parents": q_passage_parents,
    "typed_fields": q_typed_fields,
    "parent_metadata": q_parent_metadata,
    "keyword_lower": q_keyword_lower,
    "stored_view": q_stored_view,
    "record_wide_json": q_record_wide_json,
    "host_tokens": q_host_tokens,
    "path_tokens": q_path_tokens,
    "query_tokens": q_query_tokens,
    "lang_tokens_en": _lang_tokens("en"),
    "lang_tokens_fr": _lang_tokens("fr"),
    "lang_tokens_de": _lang_tokens("de"),
    "lang_tokens_es": _lang_tokens("es"),
    "postings": q_postings,
    "postings_by_field": q_postings_by_field,
    "phrase_matches": q_phrase_matches,
    "term_stats": q_term_stats,
    "vocabulary_terms": q_vocabulary_terms,
    "host_facets": q_host_facets,
    "field_filter": q_field_filter,
    "host_filter": q_host_filter,
    "date_filter": q_date_filter,
    "bm25_topk": q_bm25_topk,
    "bm25_topk_by_lang": q_bm25_topk_by_lang,
}


try:
    from corpusforge.llm.queries import ORACLE_SQL as _LLM_SQL
    from corpusforge.llm.queries import QUERIES as _LLM_QUERIES
except ImportError:  # the subpackage is optional
    _LLM_QUERIES, _LLM_SQL = {}, {}
try:
    import corpus_pipeline as _pipeline
except ImportError:
    pass
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": _pipeline.run}
    if _pipeline.ORACLE_SQL is not None:
        _LLM_SQL = {**_LLM_SQL, "pipeline": _pipeline.ORACLE_SQL}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: web pages -> paired meta/data records (HTML, URL, ids, filters)."""
    return q_map_web(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    from oracle.sql import ORACLE_SQL
    return {**ORACLE_SQL, **_LLM_SQL}
