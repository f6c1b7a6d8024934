"""DuckDB oracle SQL for every ``queries()`` key (tables are pre-registered views)."""

from __future__ import annotations

from corpusforge.functions import text as T
from corpusforge.operators import filters as FL
from oracle import duck as D
from oracle.duck import q

BUCKET = "corpus-bucket"
LANGS = ("en", "fr", "de", "es")
VOCABULARY_LANGS = ("fi", "hu", "it", "pt", "ru", "sv")

BIGINT_COLS = {"m_source_offset", "m_content_length", "m_plaintext_source_offset", "d_body_length",
               "m_http_content_length"}


def _select(fields: dict, columns: list[str]) -> str:
    items = []
    for c in columns:
        typ = "BIGINT" if c in BIGINT_COLS else "VARCHAR"
        expr = fields.get(c)
        items.append(f"CAST({expr if expr is not None else 'NULL'} AS {typ}) AS {c}")
    return ", ".join(items)


PLAIN_OUT = ["m_uuid", "m_source_file", "m_source_offset", "m_content_length", "m_content_type",
             "m_warc_trec_id", "m_plaintext_source_file", "m_plaintext_source_offset",
             "m_plaintext_content_type", "d_uuid", "d_lang", "d_warc_trec_id", "d_warc_target_uri",
             "d_warc_target_hostname", "d_warc_target_path", "d_warc_target_query_string",
             "d_http_content_type", "d_title", "d_body", "d_body_length", "d_full_body"]


def _plain_fields(prefix, source_file, offset, length, url=True, title="title", uuid_meta=True):
    uuid = D.doc_uuid(prefix, "doc_id")
    f = {"m_uuid": uuid if uuid_meta else None, "m_source_file": source_file, "m_source_offset": offset,
         "m_content_length": length, "m_content_type": "'application/json'", "m_warc_trec_id": "doc_id",
         "d_uuid": uuid, "d_lang": "'en'", "d_warc_trec_id": "doc_id", "d_http_content_type": "'text/html'",
         "d_title": title, "d_body": "text", "d_body_length": "length(text)", "d_full_body": "text"}
    if url:
        f.update({"d_warc_target_uri": "url", "d_warc_target_hostname": "host",
                  "d_warc_target_path": "path", "d_warc_target_query_string": "query"})
    return f


def _with_url(src: str) -> str:
    return f"(SELECT *, {', '.join(D.url_columns('url'))} FROM {src})"


def _plain_sql(fields, src):
    return f"SELECT {_select(fields, PLAIN_OUT)} FROM {src}"


DOCS_OFF = f"(SELECT d.*, o.start, o.\"end\" FROM {D.plain_docs_sql()} d JOIN {D.plain_offsets_sql()} o USING (doc_id))"

PASSAGES = ("(SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS doc_id, conv_id, turn, "
            "text FROM conversations)")
PASSAGES_OFF = (f"(SELECT p.*, o.start, o.\"end\", par.title AS title, par.url AS url FROM {PASSAGES} p "
                f"JOIN {D.passage_offsets_sql()} o USING (doc_id) "
                f"JOIN {D.parent_documents_sql()} par ON par.doc_id = CAST(p.conv_id AS VARCHAR))")

V21_DOCS = (f"(SELECT 'msmarco_v2.1_doc_' || lpad(CAST(n // 100 AS VARCHAR), 2, '0') || '_' || CAST(start AS VARCHAR) "
            f"AS doc_id, lpad(CAST(n // 100 AS VARCHAR), 2, '0') AS bundle, start, text, title, url FROM {DOCS_OFF})")
V21_SEG = (f"(SELECT 'msmarco_v2.1_doc_' || lpad(CAST(conv_id // 100 AS VARCHAR), 2, '0') || '_' || "
           f"CAST(conv_id AS VARCHAR) || '#' || CAST(turn AS VARCHAR) || '_' || CAST(start AS VARCHAR) AS doc_id, "
           f"lpad(CAST(conv_id // 100 AS VARCHAR), 2, '0') AS bundle, start, text, "
           f"'Turn ' || CAST(turn AS VARCHAR) AS title, 'https://chat.example.org/c/' || CAST(conv_id AS VARCHAR) AS url "
           f"FROM (SELECT p.*, o.start FROM {PASSAGES} p JOIN {D.passage_offsets_sql()} o USING (doc_id)))")

_TOT_LINES = D.jsonl_line("md5(text)", "text")
TOT_OFF = (f"(SELECT doc_id, arg_min(start, start) AS start, arg_min(\"end\", start) AS \"end\" FROM "
           f"(SELECT json_extract_string(line, '$.docno') AS doc_id, \"end\" - b AS start, \"end\" FROM "
           f"(SELECT line, strlen(line) + 1 AS b, {D.running('strlen(line) + 1', 'doc_id')} AS \"end\" FROM "
           f"(SELECT doc_id, {_TOT_LINES} AS line FROM documents))) GROUP BY doc_id)")
TOT_DOCS = ("(SELECT cid AS doc_id, arg_min(text, doc_id) AS text, arg_min(title, doc_id) AS title, "
            "'Q' || CAST(min(doc_id) AS VARCHAR) AS wikidata_id FROM (SELECT md5(text) AS cid, doc_id, "
            "text, split_part(text, chr(10), 1) AS title FROM documents) GROUP BY cid)")

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["doc_uuid"] = f"SELECT doc_id, {D.doc_uuid('corpus', 'doc_id')} AS uuid FROM documents"
ORACLE_SQL["index_id_bits"] = (f"SELECT doc_id, {D.index_id_fields(D.month_ms(2018, 1), 'start')} AS bits "
                               f"FROM {D.plain_offsets_sql()}")

_spaced = "(' ' || replace(replace(text, '. ', '.' || chr(9) || '  '), chr(10), ' ' || chr(10) || chr(10)) || chr(10) || ' ')"
ORACLE_SQL["collapse_whitespace"] = (f"SELECT doc_id, c AS collapsed, CAST(length(c) AS BIGINT) AS n FROM "
                                     f"(SELECT doc_id, {D.collapse(_spaced)} AS c FROM documents)")

_fffd = (f"CASE WHEN doc_id % 7 = 0 THEN replace(text, 'e', {q(T.REPLACEMENT_CHAR)}) "
         f"WHEN doc_id % 7 = 1 THEN replace(text, 'the', {q(' ' + T.REPLACEMENT_CHAR + ' ')}) ELSE text END")
ORACLE_SQL["replacement_clean"] = (
    f"SELECT doc_id, CAST({D.replacement_count('t')} AS BIGINT) AS n_fffd, "
    f"round({D.replacement_count('t')} / nullif(length(t), 0), 6) AS ratio, "
    f"coalesce({D.replacement_count('t')} / nullif(length(t), 0), 0.0) <= {FL.MAX_REPLACEMENT_RATIO} AS keep, "
    f"{D.replacement_clean('t')} AS cleaned FROM (SELECT doc_id, {_fffd} AS t FROM documents)")

ALL_URLS = (f"(SELECT 'page' AS src, page_id AS id, url FROM pages UNION ALL "
            f"SELECT 'doc' AS src, n AS id, url FROM {D.plain_docs_sql()})")
ORACLE_SQL["url_parts"] = f"SELECT src, id, {', '.join(D.url_columns('url'))} FROM {ALL_URLS}"

HTML = D.html_fields_sql(D.injected_pages_sql())
ORACLE_SQL["page_title"] = (f"SELECT page_id, {D.html_title()} AS title, (html IS NOT NULL AND (has_body_tag OR NOT has_frames)) AS has_body, "
                            f"{D.html_lang('html')} AS html_lang FROM {HTML}")
ORACLE_SQL["page_text"] = f"SELECT page_id, {D.html_full_text()} AS full_text, {D.html_main_text()} AS main_text FROM {HTML}"
ORACLE_SQL["page_headings"] = (f"SELECT page_id, {D.join_list('hs')} AS headings, CAST(len(hs) AS BIGINT) AS n FROM "
                               f"(SELECT page_id, {D.html_headings()} AS hs FROM {HTML})")
_KW = (f"(SELECT *, CASE WHEN kwc IS NULL THEN []::VARCHAR[] ELSE {D.distinct_in_order('kw_all')}[1:30] END AS kws FROM "
       f"(SELECT *, {D.keyword_words('kwc')} AS kw_all FROM (SELECT *, {D.html_keyword_content()} AS kwc, "
       f"{D.html_meta_desc()} AS meta_desc FROM @SRC@)))")
ORACLE_SQL["page_meta"] = (f"SELECT page_id, meta_desc, {D.join_list('kws')} AS keywords, CAST(len(kws) AS BIGINT) AS n_keywords "
                           f"FROM {_KW.replace("@SRC@", HTML)}")

ORACLE_SQL["jsonl_offsets"] = f"SELECT doc_id, start, \"end\" FROM {D.plain_offsets_sql()}"
_CID = "(SELECT md5(text) AS content_id, doc_id, lang FROM documents)"
ORACLE_SQL["duplicate_ids"] = (f"SELECT content_id, CAST(count(*) AS BIGINT) AS n FROM {_CID} GROUP BY content_id "
                               f"HAVING count(*) > 1 OR content_id IS NULL")
ORACLE_SQL["corpus_slice"] = ("SELECT doc_id, lang, position FROM (SELECT doc_id, lang, "
                              "CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS position, count(*) OVER () AS total "
                              "FROM documents) WHERE position >= 100 AND position < total - 100")
ORACLE_SQL["keep_first"] = (f"SELECT content_id, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM {_CID} "
                            f"GROUP BY content_id")

ORACLE_SQL["map_v1_document"] = _plain_sql(_plain_fields(
    "msmarco-v1-document", "'s3://corpus-msmarco-document-v1/corpus.jsonl'", "start", "\"end\" - start"),
    _with_url(DOCS_OFF))
ORACLE_SQL["map_v1_passage"] = _plain_sql(_plain_fields(
    "msmarco-1-passage", "'s3://corpus-msmarco-passage-v1/corpus.jsonl'", "start", "\"end\" - start", url=False,
    title="'Passage ' || doc_id"), DOCS_OFF)
ORACLE_SQL["map_v2_document"] = _plain_sql(_plain_fields(
    "msmarco-v2-document", "'s3://corpus-msmarco-document-v2/corpus.jsonl'", "start", "\"end\" - start"),
    _with_url(DOCS_OFF))
ORACLE_SQL["map_v2_passage"] = _plain_sql(_plain_fields(
    "msmarco-v2-passage", "'s3://corpus-msmarco-passage-v2/corpus.jsonl'", "start", "\"end\" - start"),
    _with_url(PASSAGES_OFF))
ORACLE_SQL["map_v21_document"] = _plain_sql(_plain_fields(
    "msmarco-v2.1-document", "'s3://corpus-msmarco-document-v2.1/msmarco_v2.1_doc_' || bundle || '.json'",
    "start", None), _with_url(V21_DOCS))
ORACLE_SQL["map_v21_segmented"] = _plain_sql(_plain_fields(
    "msmarco-v2.1-document-segmented",
    "'s3://corpus-msmarco-document-v2.1-segmented/msmarco_v2.1_doc_segmented_' || bundle || '.json'",
    "start", None), _with_url(V21_SEG))
ORACLE_SQL["map_tirex"] = _plain_sql(_plain_fields(
    "cranfield", "'s3://corpora-tirex-small/cranfield-corpus.jsonl'", "start", "\"end\" - start",
    title="'Document ' || doc_id"), _with_url(DOCS_OFF))
_tot = _plain_fields("trec-tot-2024-document", "'s3://corpus-trec-tot-2024/corpus.jsonl'", "start", "\"end\" - start",
                     url=False)
_tot.update({"d_warc_target_uri": "'https://www.wikidata.org/wiki/' || wikidata_id",
             "d_warc_target_hostname": "'wikipedia.org'"})
ORACLE_SQL["map_trec_tot"] = _plain_sql(_tot, f"(SELECT d.*, o.start, o.\"end\" FROM {TOT_DOCS} d JOIN {TOT_OFF} o USING (doc_id))")
_vas = _plain_fields("vaswani", None, None, None, url=False, title=None, uuid_meta=False)
_vas.update({"m_source_file": None, "m_content_type": None, "m_warc_trec_id": None,
             "m_plaintext_source_file": "''", "m_plaintext_source_offset": "0",
             "m_plaintext_content_type": "'application/json'"})
ORACLE_SQL["map_vaswani"] = _plain_sql(_vas, D.plain_docs_sql())


# ---------------------------------------------------------------- web records

def _damaged_pages() -> str:
    k = "page_id % 10"
    html = (f"CASE WHEN {k} = 1 THEN {D.rx('html', r'(?s)<body>.*$', '<frameset></frameset>')} "
            f"WHEN {k} = 2 THEN replace(html, '</body>', repeat({q(T.REPLACEMENT_CHAR)}, length(html)) || '</body>') "
            f"WHEN {k} = 3 THEN {D.rx('html', r'(?s)<article>.*</article>', '<article><p>Short.</p></article>')} "
            f"WHEN {k} = 4 THEN {D.rx('html', r'(?s)<body>.*$', '<body> </body>')} ELSE html END")
    return f"(SELECT page_id, url, {html} AS html FROM pages)"


def web_records_sql(pages: str = "pages", keep_skipped: bool = False) -> str:
    wd = D.web_docs_sql(D.injected_pages_sql(pages))
    h = D.html_fields_sql(wd)
    f = (f"(SELECT *, {D.html_title()} AS title, {D.html_headings()} AS headings, {D.html_full_text()} AS full_text, "
         f"{D.html_main_text()} AS main_text FROM {h})")
    k = _KW.replace("@SRC@", f)
    reason = (f"CASE WHEN NOT coalesce(html IS NOT NULL AND (has_body_tag OR NOT has_frames), false) THEN {q(FL.NO_BODY)} "
              f"WHEN coalesce(length(full_text), 0) <= 0 THEN {q(FL.EMPTY_FULL_TEXT)} "
              f"WHEN {D.replacement_count('full_text')} / length(full_text) > {FL.MAX_REPLACEMENT_RATIO} "
              f"THEN {q(FL.TOO_MANY_REPLACEMENTS)} "
              f"WHEN coalesce(length(main_text), 0) < {FL.MIN_MAIN_CONTENT_LENGTH} THEN {q(FL.MAIN_TOO_SHORT)} END")
    s = f"(SELECT *, {reason} AS skip_reason, {', '.join(D.web_location_items())} FROM {k})"
    if not keep_skipped:
        s = f"(SELECT * FROM {s} WHERE skip_reason IS NULL)"
    lo = D.web_line_offsets_sql(wd)
    return (f"(SELECT s.*, lo.html_offset, lo.txt_offset, {', '.join(D.url_columns('s.url', 'u_'))} "
            f"FROM {s} s LEFT JOIN {lo} lo ON s.stem = lo.stem AND s.doc_no = lo.doc_no)")


WEB_FIELDS = {
    "m_uuid": D.doc_uuid("clueweb22", "doc_id"),
    "m_source_file": f"'s3://{BUCKET}/html/' || stem || '.warc.gz'",
    "m_source_offset": "html_offset", "m_warc_type": "'resource'", "m_warc_target_uri": "url",
    "m_warc_target_uri_hash": "url_hash", "m_warc_record_id": "CAST(record_id AS VARCHAR)",
    "m_warc_trec_id": "doc_id", "m_warc_payload_digest": "payload_digest", "m_content_length": "strlen(html)",
    "m_http_content_length": "strlen(html)", "m_content_encoding": "'utf8'",
    "m_plaintext_source_file": f"'s3://{BUCKET}/txt/' || stem || '.json.gz'",
    "m_plaintext_source_offset": "txt_offset", "m_plaintext_content_type": "'application/x-ndjson+clueweb22'",
    "d_lang": "split_part(language, '_', 1)", "d_warc_target_hostname": "u_host",
    "d_warc_target_path": "u_path", "d_warc_target_query_string": "u_query", "d_title": "title",
    "d_meta_desc": "meta_desc", "d_body": "main_text", "d_body_length": "length(main_text)",
    "d_full_body": D.replacement_clean("full_text"),
}
WEB_OUT = ["m_uuid", "m_source_file", "m_source_offset", "m_warc_type", "m_warc_target_uri",
           "m_warc_target_uri_hash", "m_warc_record_id", "m_warc_trec_id", "m_warc_payload_digest",
           "m_content_length", "m_http_content_length", "m_content_encoding", "m_plaintext_source_file",
           "m_plaintext_source_offset", "m_plaintext_content_type", "d_lang", "d_warc_target_hostname",
           "d_warc_target_path", "d_warc_target_query_string", "d_title", "d_meta_desc", "d_body",
           "d_body_length", "d_full_body"]
WEB = web_records_sql()
ORACLE_SQL["map_web"] = (f"SELECT {_select(WEB_FIELDS, WEB_OUT)}, {D.iso_seconds('date')} AS m_warc_date, "
                         f"{D.join_list('kws')} AS d_meta_keywords, {D.join_list('headings')} AS d_headings FROM {WEB}")
ORACLE_SQL["quality_skip_report"] = (
    f"SELECT coalesce(skip_reason, 'kept') AS reason, CAST(count(*) AS BIGINT) AS n FROM "
    f"{web_records_sql(_damaged_pages(), keep_skipped=True)} GROUP BY 1")
ORACLE_SQL["missing_offsets"] = (f"SELECT doc_id, lang FROM {D.plain_docs_sql()} WHERE doc_id NOT IN "
                                 f"(SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE lang <> 'fr')")
ORACLE_SQL["upsert_last_wins"] = (
    f"SELECT {D.doc_uuid('corpus', 'doc_id')} AS uuid, doc_id, CAST(version AS BIGINT) AS version, "
    f"CAST(length(t) AS BIGINT) AS body_length FROM (SELECT doc_id, arg_max(t, version) AS t, max(version) AS version "
    f"FROM (SELECT doc_id, text AS t, 1 AS version FROM documents UNION ALL "
    f"SELECT doc_id, text || ' (rev 2)' AS t, 2 AS version FROM documents WHERE doc_id % 5 = 0) GROUP BY doc_id)")

_len = "CASE WHEN doc_id % 5 = 0 THEN source WHEN doc_id % 5 <> 1 THEN CAST(n_chars AS VARCHAR) END"
ORACLE_SQL["typed_fields"] = (
    f"SELECT doc_id, lang, TRY_CAST({_len} AS BIGINT) AS body_length, TRY_CAST(n_chars AS TINYINT) AS spam_rank, "
    f"concat_ws(' | ', CASE WHEN {_len} IS NOT NULL AND TRY_CAST({_len} AS BIGINT) IS NULL THEN 'body_length' END, "
    "CASE WHEN n_chars > 127 THEN 'spam_rank' END) AS bad_fields FROM documents")
ORACLE_SQL["collision_losers"] = (
    "SELECT k AS _id, doc_id FROM (SELECT doc_id // 3 AS k, doc_id, row_number() OVER "
    "(PARTITION BY doc_id // 3 ORDER BY n_chars DESC, doc_id DESC) AS r FROM documents) WHERE r > 1")

_WEB_DATA = f"(SELECT {D.doc_uuid('clueweb22', 'doc_id')} AS uuid, split_part(language, '_', 1) AS lang, * FROM {WEB})"
_sv = ["uuid", "lang"] + [f"CASE WHEN lang = {q(l)} THEN {f} END AS {f}_lang_{l}" for f in ("title", "meta_desc")
                          for l in LANGS] + ["CAST(length(main_text) AS BIGINT) AS body_length"]
ORACLE_SQL["stored_view"] = f"SELECT {', '.join(_sv)} FROM {_WEB_DATA}"
_nonnull = ["uuid", "lang", "date", "record_id", "doc_id", "url", "u_host", "u_path", "u_query", "url_hash", "date",
            "'text/html'", "title", "kws", "meta_desc", "main_text", "main_text", "full_text", "headings"]
ORACLE_SQL["record_wide_json"] = (
    f"SELECT uuid, lang, title, CAST(length(main_text) AS VARCHAR) AS body_length, {D.iso_seconds('date')} AS warc_date, "
    f"CAST({' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in _nonnull)} AS BIGINT) AS n_keys FROM {_WEB_DATA}")

ORACLE_SQL["host_tokens"] = (f"SELECT src, id, {D.join_list(D.host_tokens('host'))} AS tokens FROM "
                             f"(SELECT src, id, {D.url_columns('url')[0]} FROM {ALL_URLS})")
ORACLE_SQL["path_tokens"] = (f"SELECT src, id, {D.join_list(D.path_tokens('path'))} AS tokens FROM "
                             f"(SELECT src, id, {D.url_columns('url')[1]} FROM {ALL_URLS})")
ORACLE_SQL["query_tokens"] = (f"SELECT src, id, {D.join_list(D.query_tokens('query'))} AS tokens FROM "
                              f"(SELECT src, id, {D.url_columns('url')[2]} FROM {ALL_URLS})")
for _l in LANGS:
    ORACLE_SQL[f"lang_tokens_{_l}"] = (
        f"SELECT doc_id, {D.join_list('t')} AS tokens, CAST(len(t) AS BIGINT) AS n FROM "
        f"(SELECT doc_id, {D.language_tokens('text', _l)} AS t FROM documents WHERE lang = {q(_l)})")

_by_lang = "CASE " + " ".join(f"WHEN lang = {q(l)} THEN {D.language_tokens('text', l)}" for l in LANGS) + \
           f" ELSE {D.language_tokens('text', 'default')} END"
_POST = (f"(SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM "
         f"(SELECT doc_id, {_by_lang} AS tokens FROM documents)) GROUP BY term, doc_id)")
ORACLE_SQL["postings"] = f"SELECT term, doc_id, CAST(tf AS BIGINT) AS tf FROM {_POST}"
ORACLE_SQL["term_stats"] = (f"SELECT term, CAST(count(*) AS BIGINT) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {_POST} "
                            f"GROUP BY term")
ORACLE_SQL["host_facets"] = (f"SELECT u_host AS host, CAST(count(*) AS BIGINT) AS n FROM {WEB} WHERE u_host IS NOT NULL "
                             f"GROUP BY u_host")
ORACLE_SQL["field_filter"] = (
    f"SELECT {D.doc_uuid('msmarco-v1-document', 'doc_id')} AS uuid, doc_id AS warc_trec_id, "
    f"CAST(length(text) AS BIGINT) AS body_length FROM {DOCS_OFF} WHERE lang = 'fr' AND length(text) >= 500 "
    f"AND length(text) <= 5000")
_web_rows = ORACLE_SQL["map_web"]
ORACLE_SQL["host_filter"] = (f"SELECT m_uuid AS uuid, d_warc_target_hostname AS warc_target_hostname, d_body_length AS body_length FROM ({_web_rows}) "
                             "WHERE d_warc_target_hostname = 'thther.example.org'")
ORACLE_SQL["date_filter"] = (f"SELECT m_uuid AS uuid, m_warc_date AS warc_date FROM ({_web_rows}) "
                             "WHERE m_warc_date >= '2022-01-02T00:00:00+00:00' AND m_warc_date < '2022-01-06T00:00:00+00:00'")
_en = D.language_tokens("text", "en")
ORACLE_SQL["bm25_topk"] = f"""
WITH dt AS (SELECT doc_id, {_by_lang} AS tokens FROM documents),
post AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM dt) GROUP BY term, doc_id),
dl AS (SELECT doc_id, len(tokens) AS dl FROM dt),
cs AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
st AS (SELECT term, count(*) AS df FROM post GROUP BY term),
qt AS (SELECT qid, term, count(*) AS qtf FROM (SELECT item_id AS qid, unnest({_en}) AS term FROM benchmark) GROUP BY qid, term),
w AS (SELECT qt.qid, qt.term, qt.qtf, ln(1 + (cs.n - st.df + 0.5) / (st.df + 0.5)) AS idf FROM qt JOIN st USING (term), cs),
sc AS (SELECT w.qid, post.doc_id, sum(w.qtf * w.idf * post.tf / (post.tf + 1.2 * (0.25 + 0.75 * dl.dl / cs.avgdl))) AS score
       FROM w JOIN post USING (term) JOIN dl USING (doc_id), cs GROUP BY w.qid, post.doc_id),
r AS (SELECT qid, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, doc_id) AS rank FROM sc)
SELECT qid, doc_id, score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 10
"""

_field = f"CASE WHEN lang IN ({', '.join(q(l) for l in LANGS)}) THEN lang ELSE 'default' END"
_asked = " UNION ALL ".join(f"SELECT item_id AS qid, {q(l)} AS field, unnest({D.language_tokens('text', l)}) AS term FROM benchmark"
                            for l in (*LANGS, "default"))
ORACLE_SQL["bm25_topk_by_lang"] = f"""
WITH dt AS (SELECT doc_id, {_field} AS field, {_by_lang} AS tokens FROM documents),
post AS (SELECT field, term, doc_id, count(*) AS tf FROM (SELECT field, doc_id, unnest(tokens) AS term FROM dt) GROUP BY ALL),
dl AS (SELECT doc_id, field, coalesce(len(tokens), 0) AS dl FROM dt),
cs AS (SELECT field, count(*) AS n, avg(dl) AS avgdl FROM dl GROUP BY field),
st AS (SELECT field, term, count(*) AS df FROM post GROUP BY ALL),
qt AS (SELECT qid, field, term, count(*) AS qtf FROM ({_asked}) GROUP BY ALL),
w AS (SELECT qid, field, term, qtf, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf, avgdl FROM qt JOIN st USING (field, term) JOIN cs USING (field)),
sc AS (SELECT qid, post.doc_id, sum(qtf * idf * tf / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS score
       FROM w JOIN post USING (field, term) JOIN dl ON dl.doc_id = post.doc_id GROUP BY qid, post.doc_id),
r AS (SELECT qid, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 6) DESC, doc_id) AS rank FROM sc)
SELECT qid, doc_id, score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 10
"""

_record_uuid = D.doc_uuid("msmarco-v1-document", "doc_id")
ORACLE_SQL["written_actions"] = (
    f"SELECT 'index' AS op, 'corpus-meta' AS idx, {_record_uuid} AS uuid, doc_id AS trec_id, CAST(start AS VARCHAR) AS source_offset, "
    f"CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS body_length, CAST(22 AS BIGINT) AS key_length FROM {DOCS_OFF} UNION ALL "
    f"SELECT 'index', 'corpus-data', {_record_uuid}, doc_id, NULL, title, CAST(length(text) AS VARCHAR), 22 FROM {DOCS_OFF}")

ORACLE_SQL["vocabulary_terms"] = (
    f"SELECT word, n, {', '.join(f'{D.fold(D.staged_stem("word", l))} AS {l}_term' for l in VOCABULARY_LANGS)} FROM "
    f"(SELECT word, count(*) AS n FROM (SELECT unnest({D.words('text')}) AS word FROM documents) GROUP BY word)")

_keyed = f"SELECT CAST(floor(doc_id / 3.0) AS BIGINT) AS _id, {D.doc_uuid('corpus', 'doc_id')} AS uuid, doc_id FROM documents"
ORACLE_SQL["load_collisions"] = (
    f"WITH k AS ({_keyed}) SELECT DISTINCT n._id, n.uuid, n.doc_id FROM k n JOIN k s ON n._id = s._id AND n.uuid <> s.uuid "
    "WHERE s.doc_id % 6 = 0 AND (n.doc_id % 2 = 1 OR n.doc_id % 5 = 0)")
ORACLE_SQL["passage_parents"] = (
    f"SELECT {D.doc_uuid('msmarco-v2-passage', 'doc_id')} AS m_uuid, doc_id AS d_warc_trec_id, 'Later: ' || coalesce(title, '') AS d_title, "
    f"url AS d_warc_target_uri FROM {PASSAGES_OFF}")

_by_lang_of = lambda x: "CASE " + " ".join(f"WHEN lang = {q(l)} THEN {D.language_tokens(x, l)}" for l in LANGS) + f" ELSE {D.language_tokens(x, 'default')} END"
_positions = " UNION ALL ".join(
    f"SELECT '{f}' AS field, {_field} AS lang, doc_id, unnest({_by_lang_of(x)}) AS term, generate_subscripts({_by_lang_of(x)}, 1) - 1 AS p FROM documents"
    for f, x in (("title", "split_part(text, chr(10), 1)"), ("body", "text")))
ORACLE_SQL["postings_by_field"] = (
    f"SELECT field, lang, term, doc_id, count(*) AS tf, min(p)::BIGINT AS \"first\", max(p)::BIGINT AS \"last\" FROM ({_positions}) GROUP BY ALL")
ORACLE_SQL["phrase_matches"] = f"""
WITH b AS (SELECT * FROM ({_positions}) WHERE field = 'body'),
a AS ({_asked.replace("unnest(", "(").replace(" AS term", " AS tokens")}),
f AS (SELECT qid, field AS lang, tokens[1:5] AS tokens FROM a WHERE len(tokens) > 0),
t AS (SELECT qid, lang, len(tokens) AS size, unnest(tokens) AS term, generate_subscripts(tokens, 1) - 1 AS i FROM f),
s AS (SELECT qid, b.lang AS lang, doc_id, size, p - i AS start, count(*) AS held FROM b JOIN t ON b.lang = t.lang AND b.term = t.term GROUP BY ALL)
SELECT qid, lang, doc_id, count(*) AS n FROM s WHERE held = size GROUP BY ALL
"""

ORACLE_SQL["two_table_index"] = (
    f"SELECT {D.doc_uuid('msmarco-v1-document', 'doc_id')} AS meta_uuid, {D.doc_uuid('msmarco-v1-document', 'doc_id')} AS data_uuid, "
    "CAST(22 AS BIGINT) AS key_length FROM documents")
ORACLE_SQL["key_collisions"] = (
    "SELECT CAST(floor(doc_id / 3.0) AS BIGINT) AS _id, count(*) AS n_rows, count(DISTINCT doc_id) AS n_docs "
    "FROM documents GROUP BY 1 HAVING count(DISTINCT doc_id) > 1")
ORACLE_SQL["keyword_lower"] = "SELECT page_id, lower(upper(url)) AS keyword FROM pages"
ORACLE_SQL["parent_metadata"] = (
    "SELECT CAST(conv_id AS VARCHAR) AS doc_id, split_part(arg_min(text, turn), chr(10), 1) AS title, "
    "'https://chat.example.org/c/' || conv_id || '?turns=' || count(*) AS url FROM conversations GROUP BY conv_id")
