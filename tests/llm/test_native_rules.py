"""Quality rules and URL filters against brute force."""

import math
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from corpusforge.llm import quality_llr, queries, url_rules

SF = "/root/testdata/sf0.001"


def split_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    w = split_words(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 3000 else None
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
            len(covered) if covered is not None else None)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def grams(text, buckets, spark_hash):
    w = split_words(text)
    one = [signed(xxhash.xxh64_intdigest(x.encode(), 42)) for x in w]
    return [h % buckets for h in one] + [spark_hash(a, b) % buckets for a, b in zip(one, one[1:])]


def two(a, b):
    """Spark's hash of two longs: the second is hashed with the first's hash as its seed."""
    seed = xxhash.xxh64_intdigest((a & (1 << 64) - 1).to_bytes(8, "little"), 42)
    return signed(xxhash.xxh64_intdigest((b & (1 << 64) - 1).to_bytes(8, "little"), seed))


def test_base_counts_and_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    trusted = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    buckets = 4096
    model = quality_llr.fit(docs, trusted, buckets=buckets)
    got = {r.doc_id: r for r in quality_llr.judge(docs, model, buckets=buckets).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in trusted.collect()}
    raw, fine = [0] * buckets, [0] * buckets
    for d, t in texts.items():
        for g in grams(t, buckets, two):
            raw[g] += 1
            fine[g] += d in good
    share = sum(fine) / sum(raw)
    w = [math.log(f + 10.0) - math.log(r * share + 10.0) for f, r in zip(fine, raw)]
    assert len(got) == len(texts)
    for d, t in texts.items():
        r, want = got[d], base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines) == want[:4]
        if want[4] is not None:
            assert r.n_repeat_words == want[4]
        g = grams(t, buckets, two)
        llr = sum(w[x] for x in g) / max(1, len(g))
        assert r.llr == pytest.approx(llr, abs=1e-9)
        bad = want[0] < 50 or 100 * r.n_repeat_words > 50 * want[0]
        assert r.base_failed == bad
        if abs(llr - quality_llr.THRESHOLD) > 1e-6:
            assert r.kept == (not bad and llr >= quality_llr.THRESHOLD)


def test_odd_texts(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n\t\n", "x"), (3, " \n\t\n", "x"), (None, "a b c a b c", "x"), (5, long, "x"),
            (6, "l o\n\nl o\nl  o\nl o", "x"), (7, "x " * 300, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    none = spark.createDataFrame([], "doc_id long")
    got = quality_llr.judge(docs, quality_llr.fit(docs, none)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for d, t, _ in rows:
        want = base(t)
        assert (by[d].n_words, by[d].word_chars, by[d].n_symbols, by[d].n_dup_lines) == want[:4]
    assert by[None].n_repeat_words == 6 and by[7].n_repeat_words == 300 and by[5].n_repeat_words == 0
    assert by[5].kept and not by[7].kept and all(r.llr == 0 for r in got)
    kept = quality_llr.judge(docs, quality_llr.fit(docs, none), keep_columns=True)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [5]
    empty = docs.limit(0)
    assert quality_llr.judge(empty, quality_llr.fit(empty, none)).count() == 0


def test_native_plan(spark):
    plan = queries.op9_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def slow_verdict(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(p), a, h + p) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else default


def test_urls_against_brute_force(spark):
    rules = [*queries.URL_RULES, ("a.b.c", "/x/y/", "allow"), ("b.c", "/x/y/z", "block"), ("c", "/", "block"), ("c", "", "allow"),
             ("example.org", "/deep/er/and/deeper/", "block")]
    urls = ["http://a.b.c/x/y/z", "http://A.B.C/x/y/", "http://b.c/x/y/zeta?q", "http://x.b.c", "c://c", "http://xc/", "http://net", "http://net/",
            "https://www.EXAMPLE.net/en/a", "http://example.net/en", "http://example.com/de/", "http://notexample.com/de/", "http://org/fr/x://y",
            "//example.net/en/", "mailto:x@net", "", None, None, "http://", "http:///x", "http://.net/", "http://net./", "http://a..net/", "http://example.org/deep/er/and/deeper/x#y",
            "http://net?x/", "http://net#/", "HTTP://Ä.Net/", "http://" + "a." * 5000 + "net/" + "p/" * 5000, "http://net/\nx", "http://u@net/"]
    rows = [(i, u, "junk") for i, u in enumerate(urls)] + [(None, "http://net/", "z"), (1, "http://A.B.C/x/y/", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, action string")
    got = url_rules.judge_urls(pages, table).collect()
    want = [(i, *slow_verdict(u, rules)) for i, u, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert url_rules.judge_urls(pages.limit(0), table).count() == 0
    assert url_rules.judge_urls(pages, table.limit(0)).where(F.col("rule").isNotNull() | (F.col("verdict") != "allow")).count() == 0
