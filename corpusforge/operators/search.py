"""Postings, field statistics, facets and filters (K7, K8, K10); ``ranked`` has BM25.

Postings are ``(term, doc_id, tf)``. The words of a document whose id no other
row has lie side by side, so each task counts them where they are and nothing
is shuffled. Where rows share an id, their postings are merged by an aggregate
keyed by the (term, document) pair, so a very common term spreads over all
reducers.
"""

from __future__ import annotations

import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusforge.functions import analyze
from corpusforge.session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Lucene/ES BM25 defaults.
K1 = 1.2
B = 0.75

#: Repeated ids that may be broadcast (more are joined by a shuffle); words a task counts at a time.
MAX_REPEATED, GATHER_ROWS = 1 << 20, 1 << 20


def _marked(docs: DataFrame, doc_col: str) -> DataFrame:
    """``docs`` with ``whole``: no other row has the row's id (null is an id here)."""
    repeated = cut(docs.groupBy(F.col(doc_col).alias("__id")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__id", F.lit(True).alias("__r")))
    side = F.broadcast(repeated) if repeated.count() <= MAX_REPEATED else repeated
    return docs.join(side, F.col(doc_col).eqNullSafe(F.col("__id")), "left").withColumn("whole", F.col("__r").isNull()).drop("__id", "__r")


def _gather(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``term``, ``tf`` and, if ``rows`` have ``position``, ``positions``: neighbouring rows of equal keys counted by term.

    Rows of equal keys must be neighbours, positions ascending; they are told
    apart by document and field, which the other keys follow. A task holds
    ``GATHER_ROWS`` rows, or those of one document.
    """
    by = [c for c in ("doc_id", "field") if c in keys]
    rows = rows.select(*keys, "term", *[c for c in ("position",) if c in rows.columns])
    fields = [T.StructField(c, rows.schema[c].dataType) for c in (*keys, "term")] + [T.StructField("tf", T.LongType())]
    if "position" in rows.columns:
        fields.append(T.StructField("positions", T.ArrayType(rows.schema["position"].dataType)))

    def first_rows(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for c in by:
            code = table.column(c).combine_chunks()
            if code.null_count or not pa.types.is_integer(code.type):
                code = code.dictionary_encode(null_encoding="encode").indices
            code = code.to_numpy()
            new[1:] |= code[1:] != code[:-1]
        return new

    def counted(table: pa.Table, new: np.ndarray):
        terms = table.column("term").combine_chunks().dictionary_encode()
        key = (np.cumsum(new) - 1) * len(terms.dictionary) + terms.indices.to_numpy()
        bits = len(key).bit_length()
        if int(key[-1]) + len(terms.dictionary) < 1 << (63 - bits):  # the row's number fits below its key
            key = np.sort(key << bits | np.arange(len(key)))
            order, key = key & ((1 << bits) - 1), key >> bits
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
        edge = np.r_[0, np.flatnonzero(key[1:] != key[:-1]) + 1, len(key)]
        out = table.select([*keys, "term"]).take(pa.array(order[edge[:-1]]))
        out = out.append_column("tf", pa.array(np.diff(edge)))
        if "position" in table.column_names:
            at = table.column("position").combine_chunks().take(pa.array(order))
            out = out.append_column("positions", pa.ListArray.from_arrays(pa.array(edge, pa.int32()), at))
        return out.to_batches(max_chunksize=1 << 16)

    def run(batches):
        held, n, limit = [], 0, GATHER_ROWS
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n < limit:
                continue
            table = pa.Table.from_batches(held)
            new = first_rows(table)
            last = int(np.flatnonzero(new)[-1])
            if last:  # the last document may go on
                yield from counted(table.slice(0, last), new[:last])
            held, n = table.slice(last).to_batches(), n - last
            limit = max(GATHER_ROWS, 2 * n)
        if held:
            table = pa.Table.from_batches(held)
            yield from counted(table, first_rows(table))
    return rows.mapInArrow(run, T.StructType(fields))


def doc_terms(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text",
              lang: str | None = None, lang_col: str | None = None,
              languages=("en", "fr", "de", "es"), keep_lang: bool = False, mark: bool = False) -> DataFrame:
    """``(doc_id, dl, term)``: one row per token occurrence; with ``keep_lang``
    also ``lang``, the language that ``lang_col`` has the text analysed in;
    with ``mark`` also ``whole``, true where all rows of the id are neighbours
    (for ``postings``, which then needs no shuffle; not to be shuffled before).

    Words are exploded first and the language filters run as plain column
    expressions on the exploded word (generated code, no lambdas). ``dl``
    (the document's token count) rides along so scoring needs no join.
    """
    if lang in analyze.BIGRAM_LANGUAGES and not lang_col:
        # CJK fields: a word yields several bigram terms, so explode those.
        toks = docs.select(F.col(doc_col).alias("doc_id"), analyze.cjk_bigrams(F.col(text_col)).alias("ts"))
        toks = toks.withColumn("dl", F.size("ts").cast("bigint"))
        return toks.select("doc_id", "dl", F.explode("ts").alias("term"))
    keep = [lang_col] if lang_col else []
    marked = ["whole"] if mark else []
    docs = _marked(docs, doc_col) if mark else docs
    # Words and their count are computed once per document, below the
    # explode (a length taken after it would re-tokenise per word).
    ws = docs.select(F.col(doc_col).alias("doc_id"), *keep, *marked, analyze.words(F.col(text_col)).alias("ws"))
    ws = ws.withColumn("dl", F.size("ws").cast("bigint"))
    # Not explode: Catalyst would then filter by the array's size first, and tokenise a second time for it.
    w = ws.select("doc_id", *keep, *marked, "dl", F.explode_outer("ws").alias("word")).filter(F.col("word").isNotNull())
    if lang_col:
        w = analyze.with_terms(w, languages, "word", lang_col)
        if keep_lang:
            return w.select("doc_id", analysed_lang(F.col(lang_col), languages).alias("lang"), "dl", "term", *marked)
    else:
        w = w.withColumn("term", analyze.language_term(F.col("word"), lang or "default"))
    # Terms are never empty: a word's apostrophe is always followed by a
    # letter, so elision leaves at least one character.
    return w.select("doc_id", "dl", "term", *marked)


def analysed_lang(lang: Column, languages=("en", "fr", "de", "es")) -> Column:
    """The language whose analyzer a row gets: its own, or ``default`` beyond ``languages``."""
    return F.when(lang.isin(*languages), lang).otherwise(F.lit("default"))


def query_terms(queries: DataFrame, query_col: str = "qid", text_col: str = "text",
                languages=("en", "fr", "de", "es")) -> DataFrame:
    """``(qid, lang, tokens)``: every query analysed once per language, and by the default analyzer."""
    by = [F.struct(F.lit(l).alias("lang"), analyze.language_tokens(F.col(text_col), l).alias("tokens"))
          for l in (*languages, "default")]
    return queries.select(F.col(query_col).alias("qid"), F.inline(F.array(*by)))


def postings(terms: DataFrame) -> DataFrame:
    """``(term, doc_id, tf, dl)`` for every term of every document (K8), and ``lang`` if ``terms`` has it.

    Terms marked ``whole`` are counted where they are; the others by a partial
    aggregate keyed by the (term, document) pair.
    """
    lang = ["lang"] if "lang" in terms.columns else []
    keys = [*lang, "term", "doc_id", "dl"]

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("tf"))
    if "whole" not in terms.columns:
        return merged(terms)
    return _gather(terms.where("whole"), [*lang, "doc_id", "dl"]).select(*keys, "tf").unionByName(merged(terms.where("not whole")))


def postings_from_tokens(tokens: DataFrame, doc_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """Postings from token arrays (for callers that already hold arrays)."""
    return postings(tokens.select(F.col(doc_col).alias("doc_id"),
                                  F.size(tokens_col).cast("bigint").alias("dl"),
                                  F.explode(tokens_col).alias("term")))


def positional_postings(docs: DataFrame, fields: dict[str, str], doc_col: str = "doc_id", lang_col: str | None = None,
                        languages=("en", "fr", "de", "es")) -> DataFrame:
    """``(field, lang, term, doc_id, tf, dl, positions)`` for every term of every field (K8).

    ``fields`` names the text column of each field. ``lang`` is the language
    whose analyzer the field got; positions count words from 0, ascending; a
    term of one document is gathered in one row, never a term of all.
    """
    lang = analysed_lang(F.col(lang_col), languages) if lang_col else F.lit("default")
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).cast("string").alias("text")) for f, c in fields.items()])
    rows = _marked(docs, doc_col).select(F.col(doc_col).alias("doc_id"), lang.alias("lang"), "whole", F.inline(texts))
    rows = rows.select("doc_id", "lang", "field", "whole", analyze.words(F.col("text")).alias("ws")).withColumn("dl", F.size("ws").cast("bigint"))
    words = rows.select("doc_id", "lang", "field", "whole", "dl", F.posexplode_outer("ws").alias("position", "word")).where("word is not null")
    terms = analyze.with_terms(words, languages)
    out = ["field", "lang", "term", "doc_id", "dl", "tf", "positions"]
    merged = terms.where("not whole").groupBy("field", "lang", "term", "doc_id", "dl").agg(
        F.count(F.lit(1)).alias("tf"), F.sort_array(F.collect_list("position")).alias("positions"))
    return _gather(terms.where("whole"), ["field", "lang", "doc_id", "dl"]).select(*out).unionByName(merged.select(*out))


POSTING_PARTS = 64


def _part(field: Column, lang: Column, term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(field, lang, term), F.lit(parts)).cast("int")


def write_postings(post: DataFrame, path: str, parts: int = POSTING_PARTS) -> None:
    """Positional postings as a table of ``parts`` folders by term hash, each file in runs by term and document.

    A folder's rows are split by size where a very common term fills it.
    """
    dealt = post.withColumn("part", _part(F.col("field"), F.col("lang"), F.col("term"), parts)).hint("rebalance", F.col("part"))
    dealt.sortWithinPartitions("part", "field", "lang", "term", "doc_id").write.mode("overwrite").partitionBy("part").parquet(path)


def read_postings(post_path: str, terms: DataFrame, parts: int = POSTING_PARTS) -> DataFrame:
    """The stored postings of ``terms`` (field, lang, term): only their folders are read, and runs of other terms are skipped."""
    spark = terms.sparkSession
    wanted = terms.select("field", "lang", "term").distinct()
    folders = [r[0] for r in wanted.select(_part(F.col("field"), F.col("lang"), F.col("term"), parts)).distinct().collect()]  # at most ``parts``
    stored = spark.read.parquet(post_path).where(F.col("part").isin(folders)).drop("part")
    return stored.join(wanted, ["field", "lang", "term"], "left_semi")


def phrase_matches(post: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(qid, field, lang, doc_id, n)``: documents that hold a phrase's terms at consecutive positions, and how often.

    ``phrases``: ``(qid, field, lang, tokens)``. A posting of the phrase's i-th
    term at position p speaks for a match at p - i; a match has all its terms.
    Postings are cut to the phrases' terms and kept. A phrase is looked for
    only where its rarest term is, and its other terms only in those
    documents. Where positions or phrases occur more than once, every
    posting's starts are counted.
    """
    named = ["qid", "field", "lang", "size"]
    term = ["field", "lang", "term"]
    doc = ["field", "lang", "doc_id"]
    asked = phrases.where(F.size("tokens") > 0).select("qid", "field", "lang", F.size("tokens").alias("size"), F.posexplode("tokens").alias("i", "term"))
    once = Window.partitionBy(*named)
    asked = cut(asked.withColumn("single", F.count(F.lit(1)).over(once) == F.col("size")))
    post = cut(post.join(asked.select(*term).distinct(), term, "left_semi").select(*term, "doc_id", "dl", "positions"))

    def same_doc(a: DataFrame, b: DataFrame, extra=()) -> Column:
        return reduce(Column.__and__, [a[c].eqNullSafe(b[c]) if c == "doc_id" else a[c] == b[c] for c in (*doc, *extra)])

    # Documents where a position has several postings: by their sums, or, where these fit one text, by their positions.
    sums = post.groupBy(*doc).agg((F.min("dl") != F.max("dl")) | (F.sum(F.size("positions")) > F.max("dl")))
    sums = sums.toDF(*doc, "odd")
    odd = cut(sums.where("odd").drop("odd"))
    plain = post.join(odd, same_doc(post, odd), "left_anti")
    gathered = plain.groupBy(*doc).agg(F.flatten(F.collect_list("positions")).alias("at"))
    odd = cut(odd.unionByName(gathered.where(F.size("at") != F.size(F.array_distinct("at"))).drop("at")))
    plain = post.join(odd, same_doc(post, odd), "left_anti")

    def all_starts(cut_post: DataFrame, which: DataFrame) -> DataFrame:
        return cut_post.join(which, term).select(*named, "doc_id", F.explode(F.transform("positions", lambda p: p - F.col("i"))).alias("start"))

    held = post.groupBy(*term).agg(F.sum(F.size("positions")).alias("cf"))
    parts = asked.where("single").join(held, term).groupBy(*named).agg(
        F.count(F.lit(1)).alias("found"), F.min(F.struct("cf", "i", "term")).alias("rare"), F.collect_list(F.struct("i", "term")).alias("parts"))
    parts = parts.where("found = size").select(*named, "parts", F.col("rare.term").alias("term"), F.col("rare.i").alias("rare_i"))
    near = plain.join(parts, term).select(*named, "doc_id", "parts", F.transform("positions", lambda p: p - F.col("rare_i")).alias("starts"))
    near = near.select(*named, "doc_id", "starts", F.inline("parts"))
    met = near.join(plain, same_doc(near, plain, ["term"])).select(
        *[near[c] for c in (*named, "doc_id")],
        F.explode(F.array_intersect("starts", F.transform("positions", lambda p: p - F.col("i")))).alias("start"))
    starts = met.unionByName(all_starts(plain, asked.where("not single"))).unionByName(
        all_starts(post.join(odd, same_doc(post, odd), "left_semi"), asked))
    found = starts.groupBy(*named, "doc_id", "start").agg(F.count(F.lit(1)).alias("held"))
    return found.where("held = size").groupBy("qid", "field", "lang", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def term_stats(post: DataFrame) -> DataFrame:
    """Per-term document frequency and collection frequency (K8)."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def host_facets(data: DataFrame, host_col: str = "warc_target_hostname") -> DataFrame:
    """Documents per exact host (``.raw`` facet, K7); a partial count."""
    return (data.filter(F.col(host_col).isNotNull())
                .groupBy(F.col(host_col).alias("host")).agg(F.count(F.lit(1)).alias("n")))


def field_filter(data: DataFrame, lang: str | None = None, min_length: int | None = None,
                 max_length: int | None = None, host: str | None = None,
                 since=None, until=None) -> DataFrame:
    """Term/range/date filters on keyword, long and date fields.

    Plain column predicates, so Catalyst pushes them into the Parquet scan.
    """
    cond = F.lit(True)
    if lang is not None:
        cond = cond & (F.col("lang") == lang)
    if min_length is not None:
        cond = cond & (F.col("body_length") >= min_length)
    if max_length is not None:
        cond = cond & (F.col("body_length") <= max_length)
    if host is not None:
        cond = cond & (F.col("warc_target_hostname") == host)
    if since is not None:
        cond = cond & (F.col("warc_date") >= F.lit(since).cast("timestamp"))
    if until is not None:
        cond = cond & (F.col("warc_date") < F.lit(until).cast("timestamp"))
    return data.filter(cond)
