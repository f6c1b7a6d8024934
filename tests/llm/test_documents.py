"""Line dedup, token counts, mixing, packing, toxicity, licenses and ANN against brute force."""

import hashlib
import heapq
import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusforge.llm import block_ann, length_buckets, license_align, line_dedup, queries, temperature_mix, token_counts, weak_toxicity

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(40_000))
ODD = [(1, None), (2, ""), (3, " \n\t\x0b"), (4, "One  line.\nAnd Another line, long enough\r\n"), (4, "One  line.\nAnd Another line, long enough\r\n"),
       (None, "and another LINE, long enough"), (6, "\tand another line, long enough \nx\nand another line, long enough"), (7, LONG),
       (8, "naïve Ä´s <|endoftext|> it's 12 ###")]


def odd(spark):
    rows = [(d, t, "s1" if (d or 0) % 2 else None, "z") for d, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_tokens string")


# ------------------------------------------------------------- line dedup

def slow_lines(rows):
    key = lambda x: x.encode().strip(b" \t\n\x0b\x0c\r").lower()
    at = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x).decode()) >= 20:
                at[key(x)].add(d)
    last = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in at.items() if len(v) >= 3}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_lines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = slow_lines(rows)
    assert any(x[2] for x in want)
    assert sorted(map(tuple, queries.op10_line_dedup(spark, SF).collect()), key=str) == want
    # a filter far too small only sends more lines to the exact count
    small = line_dedup.drop_repeated_lines(docs, max_bits=line_dedup.SEGMENT_BITS)
    assert sorted(map(tuple, small.collect()), key=str) == want


def test_odd_lines(spark):
    docs = odd(spark)
    assert sorted(map(tuple, line_dedup.drop_repeated_lines(docs).collect()), key=str) == slow_lines(ODD)
    kept = line_dedup.drop_repeated_lines(docs, keep_columns=True)
    assert kept.columns == docs.columns and kept.count() == len(ODD)
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0


def test_bloom_has_no_false_negatives():
    rng = random.Random(3)
    keys = [b"key %d" % rng.randrange(400) for _ in range(1000)]
    marks = line_dedup._marks(2, 1)
    import pyarrow as pa
    parts = [next(marks(iter([pa.record_batch([pa.array([b"\n".join(keys[i::5])])], names=["t"])]))) for i in range(5)]
    bits = {}
    for s in (0, 1):
        merged = next(line_dedup._merge((pa.scalar(s, pa.int32()),), [p.filter(pa.compute.equal(p.column("segment"), s)) for p in parts]))
        bits[s] = np.frombuffer(merged.column("twice")[0].as_py(), dtype=np.uint8)
    # each fifth is one document of distinct keys
    twice = [k for k, n in Counter(k for i in range(5) for k in set(keys[i::5])).items() if n > 1]
    assert set(twice) <= set(line_dedup._suspected(list(dict.fromkeys(keys)), bits, 2))


# ------------------------------------------------------------- token counts

def library_counts(rows):
    t = token_counts.load(public_tokenizers.path("word_bpe_49k.json"))
    return sorted(((d, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False))) for d, x in rows), key=str)


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 512), (300, 40), (64, 3)])
def test_tokens(spark, chunk, overlap):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") < 6000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    joined = docs.select("doc_id", "text").unionByName(odd(spark).where(F.coalesce(F.length("text"), F.lit(0)) < 6000).select("doc_id", "text"))
    rows += [(d, t) for d, t in ODD if len(t or "") < 6000]
    no_space = "".join(random.Random(5).choice("abcäß1#'") for _ in range(900))
    joined = joined.unionByName(spark.createDataFrame([(99, no_space), (98, no_space + " x " + no_space)], "doc_id long, text string"))
    rows += [(99, no_space), (98, no_space + " x " + no_space)]
    for by_word in (True, False):
        got = token_counts.count_tokens(joined, path, by_word=by_word, chunk_chars=chunk, overlap=overlap).collect()
        assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == library_counts(rows)
        assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_token_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in queries.op2_token_counts(spark, SF).collect()), key=str)
    assert got == library_counts(rows)
    big = spark.createDataFrame([(1, LONG), (2, LONG), (2, LONG)], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    assert sorted((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(big, path).collect()) == [(d, library_counts([(d, LONG)])[0][2]) for d in (1, 2, 2)]
    assert token_counts.count_tokens(big.limit(0), path).count() == 0


# ------------------------------------------------------------- mixing

def test_exponent():
    tokens = [1000, 100, 10, 0]
    a = temperature_mix.exponent_for(tokens, None, 3.0)
    assert temperature_mix.repeats(tokens, temperature_mix.weights_at(tokens, a)) == pytest.approx(3.0)
    a = temperature_mix.exponent_for(tokens, 0.8, None)
    assert temperature_mix.entropy(temperature_mix.weights_at(tokens, a)) == pytest.approx(0.8)
    assert temperature_mix.exponent_for(tokens, None, None) == 1.0
    assert temperature_mix.exponent_for(tokens, 0.0, None) == pytest.approx(1.0)


def test_mixture_against_sequential(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 40))), rng.choice(["a"] * 12 + ["b", "b", "c", None])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for how in ({}, {"budget_tokens": 5000}, {"max_repeats": None, "entropy_share": 1.0}):
        m = temperature_mix.mix(docs, block_tokens=500, **how)
        dealt = m.dealt.collect()
        for source, weight, tokens, budget, epochs, rest in m.sources:
            own = [r for r in dealt if r.source == source]
            ids = [r[0] for r in rows if r[2] == source]
            place = 0
            for e in range(epochs + 1):
                part = sorted((r for r in own if r.epoch == e), key=lambda r: r.order)
                if e < epochs:
                    assert sorted(r.id for r in part) == sorted(ids)
                else:  # up to the budget, and what begins within it
                    assert sum(r.n_tokens for r in part) >= rest and sum(r.n_tokens for r in part[:-1]) <= rest or not rest
                start = 0
                for r in part:
                    assert r.start == start and r.block == int((e * tokens + start) / max(weight * 500, 1.0))
                    start += r.n_tokens
            assert max((r.epoch for r in own), default=0) <= epochs
        again = temperature_mix.apply(docs, block_tokens=500, **how)
        assert again.columns == docs.columns
        assert Counter(r.doc_id for r in again.collect()) == Counter(r.id for r in dealt)
        if "budget_tokens" not in how:
            assert {r.id for r in dealt} == {r[0] for r in rows}


def test_mixing_odd_rows(spark):
    docs = odd(spark)
    got = temperature_mix.sequence(docs).collect()
    assert Counter(r.doc_id for r in got).keys() == Counter(d for d, _ in ODD).keys()
    assert {r.doc_id for r in temperature_mix.apply(docs).collect()} == {d for d, _ in ODD}
    assert temperature_mix.sequence(docs.limit(0)).count() == 0 and temperature_mix.apply(docs.limit(0)).count() == 0


# ------------------------------------------------------------- packing

def test_buckets_are_optimal():
    rng = random.Random(6)
    for n in (1, 2, 5, 9):
        edges = sorted(rng.sample(range(1, 60), n))
        counts = [rng.randint(1, 9) for _ in edges]
        def cost(ends):
            return sum(c * min(x for x in ends if x >= e) for e, c in zip(edges, counts))
        for most in (1, 2, 3, 20):
            best = min(cost([*c, edges[-1]]) for k in range(min(most, n)) for c in combinations(edges[:-1], k))
            got = length_buckets.best_edges(edges, counts, most)
            assert cost(got) == best and len(got) <= most


def test_packing(spark):
    lengths = [*range(0, 600, 7), 257, 258, 1023, 1025, 70_000]
    df = spark.createDataFrame([(n,) for n in lengths], "n long").select("n", length_buckets.edge(F.col("n")).alias("e"))
    for n, e in df.collect():
        assert e == max(n, 1) if n <= 256 else n <= e < n * (1 + 1 / 128) + 1
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    got = length_buckets.pack(docs, batch_tokens=4096).collect()
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(len((r.text or "").encode().split()))
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=str) == sorted(((d, n) for d, x in want.items() for n in x), key=str)
    batches = defaultdict(list)
    for r in got:
        assert r.n_tokens <= r.bucket_len
        batches[r.bucket_len, r.batch].append(r.slot)
    for (length, batch), slots in batches.items():
        room = max(1, 4096 // length)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room
        assert len(slots) == room or batch == max(b for n, b in batches if n == length)
    assert len({n for n, _ in batches}) <= 16
    assert length_buckets.pack(docs.limit(0)).count() == 0


# ------------------------------------------------------------- licenses

def test_patience():
    a, b = "a b c d e f g".split(), "x b c y e a f".split()
    assert license_align.patience(a, b) == [(1, 1), (2, 2), (4, 4), (5, 6)]
    rng = random.Random(7)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = license_align.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(i < k and j < m for (i, j), (k, m) in zip(got, got[1:]))


def test_increasing_is_longest():
    rng = random.Random(8)
    for _ in range(100):
        seq = rng.sample(range(9), rng.randint(0, 9))
        got = license_align._increasing(list(enumerate(seq)))
        best = max(k for k in range(len(seq) + 1) for c in combinations(seq, k) if list(c) == sorted(c))
        assert len(got) == best and [j for _, j in got] == sorted(j for _, j in got)


def test_licenses(spark):
    mit = license_align.TEMPLATES["mit-permission"]
    damaged = mit.replace("charge", "cost").replace("merge", "merge, adapt")
    rows = [(1, "Prose before.\n" + mit + "\nReleased under the MIT License."), (2, damaged), (3, "released under licence of the mit"),
            (4, "Licensed under the Apache License, Version 2.0.\n" * 3), (5, mit[: len(mit) // 2]), *[(10 + i, t) for i, (_, t) in enumerate(ODD)]]
    got = {r.doc_id: r for r in license_align.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].license, got[1].n_matches) == ("mit-permission", 2) and got[1].coverage == 1.0
    assert got[2].license == "mit-permission" and 0.9 <= got[2].coverage < 1
    assert got[3].license is None and got[5].license is None
    assert got[4].n_matches == 3 and len({m["first"] for m in got[4].matches}) == 3
    assert all(got[10 + i].n_matches == 0 for i in range(len(ODD)))


def test_license_query(spark):
    found = queries.op8_license_scans(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id for r in found.where("n_matches > 0").collect()}
    flat = F.lower(F.regexp_replace("text", r"[\W_]+", " "))
    want = {
        r.doc_id for r in docs.select("doc_id", flat.alias("flat")).collect()
        if any(" ".join(license_align.words(t)) in r.flat for t in license_align.TEMPLATES.values())}
    assert want and want <= got and found.count() == docs.count()


# ------------------------------------------------------------- toxicity

def test_label_model_finds_the_classes():
    rng = np.random.default_rng(9)
    y = rng.random(3000) < 0.2
    own = np.stack([np.where(y, rng.random(3000) < 0.4, rng.random(3000) < 0.002) for _ in range(6)], axis=1)
    votes = np.hstack([own, own[:, :1], own[:, :1]]).astype(float)  # two copies of the first voter
    post, learnt = weak_toxicity.label_model(votes, 0.2)
    fired = votes.any(axis=1)
    assert ((post > 0.5) == y)[fired].mean() > 0.93 and (post[~fired] < 0.5).all()
    assert learnt["together"][0, 6] > 0.9 and learnt["together"][0, 1] < 0.3


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.op5_toxicity(spark, sf)
    assert rows.count() == docs.count()
    tried = rows.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").collect()
    toxic, clean = [r for r in tried if r.toxic], [r for r in tried if not r.toxic]
    assert sum(r.predicted for r in toxic) > 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) < 0.01 * len(clean)
    assert all(0 <= r.score <= 1 for r in tried)


def test_toxicity_odd_rows(spark):
    docs = odd(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(2, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    for labels in (none, one):
        got = weak_toxicity.score(docs, weak_toxicity.fit(docs, labels)).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert weak_toxicity.score(docs.limit(0), weak_toxicity.fit(docs.limit(0), none)).count() == 0


# ------------------------------------------------------------- nearest neighbours

def slow_nearest(rows, k=20):
    good = defaultdict(list)
    for i, x in rows:
        if i is not None and x and all(v is not None and math.isfinite(v) for v in x) and any(x):
            good[i].append(x)
    good = {i: min(x) for i, x in good.items()}
    for q in sorted(good):
        if q % 20 == 0:
            score = lambda y: float(block_ann.exact(np.array([good[q]], dtype=float), np.array([y], dtype=float))[0])
            found = heapq.nsmallest(k, ((-score(y), i) for i, y in good.items() if i != q and len(y) == len(good[q])))
            yield from ((q, n, i, -s) for n, (s, i) in enumerate(found, 1))


@pytest.mark.parametrize("blocks", [{}, {"query_block": 4, "candidate_block": 30}])
def test_nearest(spark, blocks):
    rng = random.Random(10)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # a vector that many share
    rows += [(2000 + i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(25)]
    rows += [(40, None), (60, []), (20_000, [0.0] * 8), (20_020, [float("nan")] + [1.0] * 7), (20_040, [None] + [1.0] * 7), (None, [1.0] * 8),
             (20_060, [float("inf")] * 8), (20_080, [1e-300] * 8), (20_100, [1e150] * 8), rows[20], (20, [9.0] * 8)]
    df = spark.createDataFrame([(i, x, 0.5) for i, x in rows], "vec_id long, embedding array<double>, score double")
    got = block_ann.search(df, F.col("id") % 20 == 0, **blocks)
    assert sorted(map(tuple, got.collect())) == sorted(slow_nearest(rows))
    assert block_ann.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(11)
    q, c = rng.normal(size=(40, 64)), rng.normal(size=(500, 64))
    near, slack = block_ann._tile_bounds(block_ann.quantise(q), block_ann.quantise(c))
    assert (np.abs(near - q @ c.T) <= slack).all()
    lengths = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(c, axis=1)[None, :]
    assert (slack / lengths).mean() < 0.02
