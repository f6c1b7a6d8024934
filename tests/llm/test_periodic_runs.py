import hashlib
import random
import zlib

import numpy as np
import pytest

from corpusforge.llm import periodic_runs as P
from corpusforge.llm.queries import op11_periodic_runs

SF = "/root/testdata/sf0.001"


def slow_runs(w, shortest=6, repeats=4):
    n, out, spans = len(w), [], set()
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            # By ascending q a stretch is first met with its smallest period.
            if e - s >= max(shortest, repeats * q) and (s, e) not in spans:
                out.append((s, e - s, q))
                spans.add((s, e))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted_words(rng, k, n):
    w = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        if n > 10:
            a = rng.randrange(n)
            p, e = rng.randint(1, max(1, (n - a) // 3)), rng.randint(a, n)
            for i in range(a, e):
                w[i] = w[a + (i - a) % p]
    return w


def test_runs_against_all_lags():
    rng, total = random.Random(7), 0
    for _ in range(1500):
        w = planted_words(rng, rng.choice([1, 2, 3, 5, 30]), rng.randint(0, 300))
        want = slow_runs(w)
        total += len(want)
        assert P.runs_of(np.array(w, dtype=np.int64)) == want
        assert P.runs_of(np.array(w, dtype=np.int64), 9, 3) == slow_runs(w, 9, 3)
    assert total > 1000


def test_splitting_loses_no_run_and_is_stable():
    rng = random.Random(8)
    for _ in range(300):
        w = np.array(planted_words(rng, 12, 200))
        parts = P.segments(w)
        for a, b in parts:
            _, count = np.unique(w[a:b], return_counts=True)
            assert b - a >= 6 and count.min() >= 4
        for s, n, _ in slow_runs(w.tolist()):
            assert any(a <= s and s + n <= b for a, b in parts)
        # Ended early, the scan gives the same.
        assert sorted((a + s, n, q) for a, b in P.segments(w, rounds=1) for s, n, q in P.scan(w[a:b])) == sorted(P.runs_of(w))


@pytest.mark.parametrize("w,runs", [
    (np.zeros(200_000, dtype=np.int64), 1), (np.arange(200_000) % 2, 1), (np.arange(300_000) % 30_000, 1),
    (np.repeat(np.arange(20_000), 8) % 5, 20_000)])
def test_long_repetitions_are_scanned_in_bounded_time(w, runs):
    assert len([r for r in P.runs_of(w) if runs == 1 or r[2] == 1]) == runs


def slow_row(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    head = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in drop)))


COLS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_against_brute_force(spark):
    out = op11_periodic_runs(spark, SF)
    got = sorted(tuple(r) for r in out.select(*COLS).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(slow_row(r.doc_id, r.text) for r in docs)
    assert sum(r[1] for r in got) > 5


def test_odd_rows(spark):
    long = "one two three " * 20_000 + "end"
    rows = [(1, None, 1), (2, "", 2), (3, " \t\n\x0b", 3), (4, "a a a a a a", 4), (4, "a a a a a a", 4), (5, "a a a a a", 5), (None, "x y " * 9, 6),
            (6, long, 7), (7, "Ä b Ä b " * 5, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int")
    out = P.find_runs(df)
    got = {(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in out.collect()}
    assert got == {(1, 0, (), ""), (2, 0, (), ""), (3, 0, (), ""), (4, 6, ((0, 6, 1),), "a"), (5, 5, (), "a a a a a"), (None, 18, ((0, 18, 2),), "x y"),
                   (6, 60_001, ((0, 60_000, 3),), "one two three end"), (7, 10, ((0, 10, 1),), "Ä b")}
    assert out.count() == len(rows)
    empty = P.digests(P.find_runs(df.limit(0)))
    assert empty.count() == 0 and empty.columns[:8] == COLS
    assert {tuple(r)[:8] for r in P.digests(P.find_runs(df, rewrite=P.planted)).collect()} == {slow_row(d, t) for d, t, _ in rows if t != long} | {
        tuple(r)[:8] for r in P.digests(P.find_runs(df.where("doc_id = 6"), rewrite=P.planted)).collect()}
