"""BM25 with queries analysed in every language, against a plain loop."""

import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from corpusforge.functions import analyze
from corpusforge.operators import ranked, search

DOCS = [(1, "es", "finalmente llegaron los gatos negros"), (2, "es", "el perro duerme"), (3, "fr", "l'histoire des animaux parlée"),
        (4, "de", "die kleinen häuser stehen"), (5, "en", "gatos and histoires are words"), (6, "it", "gatos storie"),
        (7, None, "gatos"), (8, "en", "cats like houses"), (9, "es", "una gata negra"), (10, "es", None), (11, "fr", "gatos")]
QUERIES = [(1, "gatos negros"), (2, "histoires d'animal"), (3, "kleine haus häuser"), (4, "cat house"), (5, ""), (6, "gatos gatos")]


def slow_topk(spark, docs, queries, k):
    """BM25 over token arrays; each language a field with statistics of its own."""
    langs = entry.LANGS
    d = docs.select("doc_id", F.col("lang"), analyze.tokens_for_language(F.col("text"), F.col("lang"), langs).alias("t"))
    fields = defaultdict(dict)
    for r in d.collect():
        fields[r.lang if r.lang in langs else "default"][r.doc_id] = Counter(r.t or [])
    scores = defaultdict(lambda: defaultdict(float))
    for lang, texts in fields.items():
        asked = queries.select("qid", analyze.language_tokens(F.col("text"), lang).alias("t")).collect()
        avgdl = sum(c.total() for c in texts.values()) / len(texts)
        df = Counter(t for c in texts.values() for t in c)
        for q in asked:
            for t, qtf in Counter(q.t or []).items():
                idf = math.log(1 + (len(texts) - df[t] + 0.5) / (df[t] + 0.5))
                for doc, c in texts.items():
                    if c[t]:
                        scores[q.qid][doc] += qtf * idf * c[t] / (c[t] + 1.2 * (0.25 + 0.75 * c.total() / avgdl))
    return {(q, doc): (round(s, 6), n) for q, by in scores.items()
            for n, (doc, s) in enumerate(sorted(by.items(), key=lambda x: (-round(x[1], 6), x[0]))[:k], 1)}


def topk(docs, queries, k, **how):
    rows = ranked.bm25_topk(docs, search.query_terms(queries), k, lang_col="lang", **how).collect()
    return {(r.qid, r.doc_id): (r.score, r["rank"]) for r in rows}


def same(got, want):
    assert got.keys() == want.keys()
    assert all(abs(got[x][0] - want[x][0]) < 2e-6 and got[x][1] == want[x][1] for x in want)


def test_against_loop(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, lang string, text string")
    queries = spark.createDataFrame(QUERIES, "qid long, text string")
    got = topk(docs, queries, 5)
    same(got, slow_topk(spark, docs, queries, 5))
    # Blocks of two documents, batches of one query, and words too many to broadcast change nothing.
    same(topk(docs.repartition(2), queries, 5, block_docs=2, batch_queries=1, max_words=0), got)
    # Inflected words meet in their own language: as English, "negros" is "negro", posted as "negr".
    assert got[1, 1][1] == 1 and (1, 9) in got and (2, 3) in got and (3, 4) in got and (4, 8) in got
    assert {(6, d) for d in (1, 5, 6, 7, 9, 11)} & got.keys() and not any(q == 5 for q, _ in got)


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(6)
    for _ in range(300):
        n, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        lists = []
        for _ in range(int(rng.integers(1, 30))):
            at = np.flatnonzero(rng.random(n) < rng.choice([0.01, 0.2, 0.9]))
            if len(at):
                share = np.round(rng.random(len(at)) * rng.choice([0.1, 1, 20]), 1) + 0.1  # many ties
                lists.append((float(share.max()), at.astype(np.int32), share))
        whole = np.zeros(n)
        for _, at, share in lists:
            whole[at] += share
        here, score = ranked.top_of_block(lists, n, k, 1e-6)
        assert np.allclose(score, whole[here])
        last = np.sort(whole)[::-1][min(k, n) - 1]
        assert set(np.flatnonzero((whole > 0) & (whole >= last - 1e-9))) <= set(here.tolist())


def test_string_ids_ties_and_empty_tables(spark):
    docs = spark.createDataFrame([(f"d{i:02d}", "en", "same words here", "x") for i in range(30)] + [("e", "en", None, "x")],
                                 "doc_id string, lang string, text string, tid string")
    queries = spark.createDataFrame([("q", "same"), ("none", "absent"), (None, "")], "qid string, text string")
    assert [d for _, d in sorted(topk(docs.repartition(3), queries, 5, block_docs=4))] == [f"d{i:02d}" for i in range(5)]
    assert topk(docs.limit(0), queries, 5) == {} and topk(docs, queries.limit(0), 5) == {}


def test_query_has_every_language(spark, sf_dir):
    got = entry.queries()["bm25_topk_by_lang"](spark, sf_dir).collect()
    docs = entry._t(spark, sf_dir, "documents")
    queries = entry._t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("qid"), "text")
    want = slow_topk(spark, docs, queries, entry.TOPK)
    assert {(r.qid, r.doc_id) for r in got} == want.keys()
    assert all(abs(r.score - want[r.qid, r.doc_id][0]) < 2e-6 for r in got)


def test_phrases_over_stored_postings(spark, tmp_path):
    docs = spark.createDataFrame([(1, "en", "the cat sat on the mat the cat sat"), (2, "en", "cat the sat"), (3, "de", "the cat sat"), (4, None, "a a a a")],
                                 "doc_id long, lang string, text string").withColumn("title", F.lit("the cat"))
    post = search.positional_postings(docs, {"body": "text", "title": "title"}, lang_col="lang")
    search.write_postings(post, str(tmp_path / "p"), parts=8)
    phrases = spark.createDataFrame([(1, "body", "en", ["the", "cat", "sat"]), (2, "body", "default", ["a", "a"]), (3, "title", "de", ["the", "cat"]),
                                     (4, "body", "en", ["mat", "sat"]), (5, "body", "en", [])], "qid int, field string, lang string, tokens array<string>")
    want = {(1, "body", "en", 1, 2), (2, "body", "default", 4, 3), (3, "title", "de", 3, 1)}
    assert {tuple(r) for r in search.phrase_matches(post, phrases).collect()} == want
    asked = phrases.select("field", "lang", F.explode("tokens").alias("term"))
    stored = search.read_postings(str(tmp_path / "p"), asked, parts=8)
    assert {tuple(r) for r in search.phrase_matches(stored, phrases).collect()} == want
    one = search.read_postings(str(tmp_path / "p"), asked.where("term = 'mat'"), parts=8)
    assert [(r.doc_id, r.positions) for r in one.collect()] == [(1, [5])]
    assert "part#" in one._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    assert {(r.term, r.tf, r.positions[0]) for r in post.where("doc_id = 1 and field = 'body'").collect()} >= {("the", 3, 0), ("cat", 2, 1)}


def test_clustered_tables_are_read_in_part(spark, tmp_path):
    import datetime

    from corpusforge.sources import sink
    rows = spark.range(20_000).select(
        F.concat(F.lit("h"), F.col("id") % 50).alias("warc_target_hostname"), F.lit("en").alias("lang"), (F.col("id") % 977).alias("body_length"),
        F.timestamp_seconds(F.lit(1_640_995_200) + F.col("id") * 60).alias("warc_date"), F.md5(F.col("id").cast("string")).alias("body"))
    sink.write_clustered(rows, str(tmp_path / "host"), ("warc_target_hostname", "warc_date"), 16)
    sink.write_clustered(rows, str(tmp_path / "date"), ("warc_date",), 16)
    since = datetime.datetime(2022, 1, 3, tzinfo=datetime.timezone.utc)

    def read(name, **how):
        df = search.field_filter(spark.read.parquet(str(tmp_path / name)), **how)
        n = df.count()
        plan = df._jdf.queryExecution().executedPlan()
        assert n == search.field_filter(rows, **how).count() > 0
        df.collect()
        return plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    for name, how in (("host", dict(host="h7")), ("host", dict(host="h7", since=since)), ("date", dict(since=since, until=since + datetime.timedelta(hours=3)))):
        assert 0 < read(name, **how) < 20_000 / 4
