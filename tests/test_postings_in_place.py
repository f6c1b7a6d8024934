"""Postings counted where a document's words lie, merged for repeated ids, and phrases by their rarest term."""

from collections import Counter

import numpy as np

from corpusforge.operators import search

DOCS = [(1, "en", "cats cat the the cats"), (2, "fr", "l'été étés"), (3, "en", "a b a"), (3, "en", "a b a"), (None, "de", "häuser"), (None, "de", "haus"), (4, "en", None)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_whole_documents_are_not_shuffled(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, lang string, text string")
    plain = search.postings(search.doc_terms(docs, lang_col="lang"))
    for rows in (1 << 20, 3):
        monkeypatch.setattr(search, "GATHER_ROWS", rows)
        marked = search.postings(search.doc_terms(docs.coalesce(1), lang_col="lang", mark=True))
        assert Counter(map(tuple, marked.collect())) == Counter(map(tuple, plain.collect()))
        assert "MapInArrow" in _plan(marked)
    post = search.positional_postings(docs, {"body": "text"}, lang_col="lang")
    assert "MapInArrow" in _plan(post)
    got = {(r.doc_id, r.term): (r.tf, r.dl, r.positions) for r in post.collect()}
    assert got[1, "cat"] == (3, 5, [0, 1, 4]) and got[3, "a"] == (4, 3, [0, 0, 2, 2]) and got[None, "haus"][0] == 2


def test_phrases_with_frequent_terms_and_repeats(spark):
    rng = np.random.default_rng(4)
    texts = [(int(i) if i % 9 else None, "en", " ".join(rng.choice(list("aaabbcd"), int(rng.integers(1, 40))))) for i in range(60)] + [(7, "en", "a b a b c d")]
    asked = [(q, "body", "en", [str(x) for x in rng.choice(list("abcd"), int(rng.integers(1, 5)))]) for q in range(20)]
    asked += [asked[0], (None, "body", "en", ["a", "b"])]
    want = Counter()
    starts = Counter((q, len(ts), doc, p - i) for q, _, _, ts in asked for i, t in enumerate(ts) for doc, _, text in texts for p, w in enumerate(text.split()) if w == t)
    for (q, size, doc, _), n in starts.items():
        want[q, "body", "en", doc] += n == size
    phrases = spark.createDataFrame(asked, "qid int, field string, lang string, tokens array<string>")
    post = search.positional_postings(spark.createDataFrame(texts, "doc_id long, lang string, text string"), {"body": "text"}, lang_col="lang")
    assert {tuple(r)[:4]: r.n for r in search.phrase_matches(post, phrases).collect()} == {k: n for k, n in want.items() if n}
