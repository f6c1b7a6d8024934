"""Corpus-shaped inputs derived from the shared test tables.

The driver's tables stand in for the reference's corpora: ``documents`` for
plain corpora, ``conversations`` for passages with a parent document,
``pages`` for web pages. Fields the tables lack (URLs, titles, dates, file
layout) are derived by fixed expressions on each row's own key, the same
expressions the SQL oracle uses. Everything here is a Spark plan over the
whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusforge.functions.html import HTML_LANG_RE
from corpusforge.operators.offsets import jsonl_lines, jsonl_offsets
from corpusforge.sources.corpus import read_corpus

WEB_EPOCH_MS = 1640995200000  # 2022-01-01 UTC
HOUR_MS = 3600000


#: Session setting; unset (the default) tables are read as they are split.
MIN_PARTITIONS = "corpusforge.minPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One shared table. A session whose tables are single small files may ask for more partitions."""
    few = spark.conf.get(MIN_PARTITIONS, None)
    return read_corpus(spark, f"{sf_dir}/{name}.parquet", min_partitions=int(few) if few else None)


def plain_docs(documents: DataFrame) -> DataFrame:
    """``doc_id, text, title, url, lang, source, n``: a plain corpus."""
    return documents.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.col("doc_id").alias("n"),
        "text",
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.org/"), F.col("lang"),
                 F.lit("/doc/"), F.col("doc_id").cast("string"), F.lit(";v=1?len="),
                 F.col("n_chars").cast("string"), F.lit("#top")).alias("url"),
        "lang", "source")


def plain_offsets(documents: DataFrame) -> DataFrame:
    """Byte ranges of the documents in a JSONL file ordered by ``doc_id``."""
    lines = jsonl_lines(documents.withColumn("__n", F.col("doc_id")), "doc_id", ["text"], keep=["__n"])
    return jsonl_offsets(lines, "__n").select(F.col("doc_id").cast("string").alias("doc_id"), "start", "end")


def passages(conversations: DataFrame) -> DataFrame:
    """Passages ``doc_id = '{conv}-{turn}'`` with parent ``conv_id``."""
    return conversations.select(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("doc_id"),
        "conv_id", "turn", F.col("conv_id").alias("parent_doc_id"), "text")


def passage_offsets(conversations: DataFrame) -> DataFrame:
    p = passages(conversations)
    lines = jsonl_lines(p, "doc_id", ["text"], keep=["conv_id", "turn"])
    return jsonl_offsets(lines, ["conv_id", "turn"]).select("doc_id", "start", "end")


def parent_documents(conversations: DataFrame) -> DataFrame:
    """Parent metadata per conversation: title from its first turn, a URL.

    ``min_by`` is a partial aggregate: a huge conversation is folded map-side.
    """
    return (conversations.groupBy("conv_id")
            .agg(F.min_by("text", "turn").alias("first"), F.count(F.lit(1)).alias("turns"))
            .select(F.col("conv_id").cast("string").alias("doc_id"),
                    F.substring_index("first", "\n", 1).alias("title"),
                    F.concat(F.lit("https://chat.example.org/c/"), F.col("conv_id").cast("string"),
                             F.lit("?turns="), F.col("turns").cast("string")).alias("url")))


def web_docs(pages: DataFrame) -> DataFrame:
    """Pages as web documents with ids ``clueweb22-{subdir}-{file}-{doc}``."""
    lang = F.coalesce(F.nullif(F.regexp_extract("html", HTML_LANG_RE, 1), F.lit("")), F.lit("xx"))
    pid = F.col("page_id")
    subdir = F.concat(lang, F.lpad((pid / 10000).cast("bigint").cast("string"), 4, "0"))
    file_no = F.lpad(((pid / 100).cast("bigint") % 100).cast("string"), 2, "0")
    doc_no = F.lpad((pid % 100).cast("string"), 5, "0")
    return pages.select(
        F.concat(F.lit("clueweb22-"), subdir, F.lit("-"), file_no, F.lit("-"), doc_no).alias("doc_id"),
        "page_id", "url", "html",
        F.timestamp_millis(F.lit(WEB_EPOCH_MS) + pid * F.lit(HOUR_MS)).alias("date"),
        F.concat(lang, F.lit("_"), F.upper(lang)).alias("language"),
        F.md5("url").alias("url_hash"),
        pid.alias("record_id"),
        F.concat(F.lit("sha1:"), F.sha1("html")).alias("payload_digest"))


def web_line_offsets(docs: DataFrame) -> DataFrame:
    """``stem, doc_no, html_offset, txt_offset``: line n of each offsets file.

    Offsets restart per file; a window per file (files are bounded in size).
    """
    from corpusforge.plans.mappings import web_doc_location
    loc = web_doc_location(F.col("doc_id"))
    x = docs.select(loc["stem"].alias("stem"), loc["doc_no"].alias("doc_no"),
                    (F.octet_length("html") + 1).alias("html_bytes"),
                    (F.octet_length("url") + F.octet_length("doc_id") + 32).alias("txt_bytes"))
    w = Window.partitionBy("stem").orderBy("doc_no").rowsBetween(Window.unboundedPreceding, -1)
    return x.select("stem", "doc_no",
                    F.coalesce(F.sum("html_bytes").over(w), F.lit(0)).cast("bigint").alias("html_offset"),
                    F.coalesce(F.sum("txt_bytes").over(w), F.lit(0)).cast("bigint").alias("txt_offset"))


def inject_page_features(pages: DataFrame) -> DataFrame:
    """Add the HTML features the generated pages lack (meta tags, h2, img alt,
    a ``.title`` element, empty titles), chosen by the page key."""
    pid = F.col("page_id").cast("string")
    head_extra = F.concat(
        F.lit('<meta name="description" content="  Page '), pid, F.lit(' &amp;  more \n text ">'),
        F.lit('<meta name="keywords" content="A, b,a, Key '), pid, F.lit(',  x  y ,">'))
    html = F.col("html")
    html = F.when(F.col("page_id") % 4 != 3, F.replace(html, F.lit("</head>"),
                                                      F.concat(head_extra, F.lit("</head>")))).otherwise(html)
    body_extra = F.concat(F.lit('<article><h2 class="sub"> Part &amp; '), pid,
                          F.lit(' </h2><img src="a.png" alt="Figure '), pid,
                          F.lit('"><div class="page title">Shown '), pid, F.lit("</div>"))
    # Tags that only a reader of attribute values and matching end tags gets right.
    hard = F.concat(F.lit('<article><div data-x="a>b" class="title">Outer <div>in '), pid,
                    F.lit('</div> tail</div><p title="1 > 0">Hi wor<wbr>d</p><img data-x="x alt=no" alt="c > d">'))
    is_hard = F.col("page_id") % 5 == 2
    html = F.replace(html, F.lit("<article>"), F.when(is_hard, hard).otherwise(body_extra))
    plain = 'name="description"'
    html = F.replace(html, F.lit(plain), F.when(is_hard, F.lit(plain + ' data-x="a>b"')).otherwise(F.lit(plain)))
    html = F.when(F.col("page_id") % 3 == 0,
                  F.regexp_replace(html, r"(?s)<title>.*?</title>", "<title> </title>")).otherwise(html)
    html = F.when(F.col("page_id") % 6 == 0,
                  F.regexp_replace(html, r"(?s)<h1>.*?</h1>", "<h1></h1>")).otherwise(html)
    return pages.select("page_id", "url", html.alias("html"))
