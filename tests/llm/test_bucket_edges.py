"""Buckets end at lengths that documents have."""

import random
from collections import defaultdict

from corpusforge.llm import length_buckets


def test_buckets_are_as_long_as_their_longest_document(spark):
    rng = random.Random(4)
    lengths = [0, 0, 300, 1025, 1026, 70_000, *(rng.randint(257, 5000) for _ in range(200))]
    docs = spark.createDataFrame([(i, "x " * n) for i, n in enumerate(lengths)], "doc_id long, text string")
    got = length_buckets.pack(docs).collect()
    longest = defaultdict(int)
    for r in got:
        longest[r.bucket_len] = max(longest[r.bucket_len], r.n_tokens)
    assert len(got) == len(lengths) and all(n == max(length, 1) for n, length in longest.items())
    exact = sorted({max(n, 1) for n in lengths})
    best = length_buckets.best_edges(exact, [sum(max(n, 1) == e for n in lengths) for e in exact], length_buckets.MAX_BUCKETS)
    least = sum(min(e for e in best if e >= n) for n in lengths)
    assert least <= sum(r.bucket_len for r in got) < least * (1 + 1 / 128)


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert [(r.n_tokens, r.bucket_len) for r in length_buckets.pack(docs).collect()] == [(0, 1)] * 2
