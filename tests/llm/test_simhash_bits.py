import random

import numpy as np
import xxhash

from corpusforge.llm import simhash_bits as S
from corpusforge.llm.queries import op4_simhash_near_dedup

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    w = [x for x in (text or "").encode().lower().split()]
    s = [b" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, radius=4):
    up = {f: f for f in set(fps)}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    all_ = sorted(up)
    for i, a in enumerate(all_):
        for b in all_[i + 1:]:
            if (a ^ b).bit_count() <= radius:
                up[top(b)] = top(a)
    return {f: top(f) for f in all_}


def near(rng, base, n, bits):
    return [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits))) for _ in range(n)]


def test_within_counts_bits():
    rng = random.Random(1)
    q = rng.getrandbits(64)
    fps = np.array([q ^ sum(1 << b for b in rng.sample(range(64), k % 20)) for k in range(64 * 5)], dtype=np.uint64).reshape(5, 64)
    for radius in (0, 1, 3, 4, 7):
        got = S.within(S.planes_of(fps), np.full(5, q, dtype=np.uint64), radius)
        want = [[(int(x) ^ q).bit_count() <= radius for x in row] for row in fps]
        assert [[bool(int(w) >> i & 1) for i in range(64)] for w in got] == want


def test_pieces_cover():
    for radius in (0, 2, 4):
        assert len(S.piece_masks(radius)) == (radius + 2) * (radius + 1) // 2


def test_links_against_all_pairs(spark):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for n in (3, 40, 150):
        fps |= set(near(rng, rng.getrandbits(64), n, 3))
    chain = rng.getrandbits(64)
    for k in range(12):  # neighbours within the radius, ends far apart
        fps.add(chain)
        chain ^= 0b1111 << (4 * k)
    want = slow_components(fps)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    for tile in (8192, 30):
        comp = S.components(S.links(df, 4, tile)).collect()
        root = {r.node & (1 << 64) - 1: r.root for r in comp}
        groups = {}
        for f in fps:
            groups.setdefault(root.get(f, f"alone {f}"), set()).add(f)
        expect = {}
        for f, t in want.items():
            expect.setdefault(t, set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_query_against_brute_force(spark):
    rows = op4_simhash_near_dedup(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fp = {d.doc_id: slow_fingerprint(d.text) for d in docs}
    root = slow_components(fp.values())
    least = {}
    for d, f in sorted(fp.items()):
        least.setdefault(root[f], d)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in rows) == sorted((d, f"{f:016x}", least[root[f]]) for d, f in fp.items())
    assert any(r.doc_id != r.component_id for r in rows)


def test_odd_rows(spark):
    long = "one two three four five six " * 3000
    rows = [(1, None, "a"), (2, "", "b"), (3, " \t\n", "c"), (4, "Word", "d"), (4, "Word", "d"), (None, "word", "e"),
            (5, long, "f"), (6, long, "g"), (None, "Ä b c d e", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(df).collect()), key=str)
    assert len(got) == len(rows)
    by = {}
    for d, f, c in got:
        by.setdefault(f, set()).add(c)
    assert by["0" * 16] == {1} and by[f"{slow_fingerprint('word'):016x}"] == {4} and by[f"{slow_fingerprint(long):016x}"] == {5}
    assert by[f"{slow_fingerprint(chr(196) + ' b c d e'):016x}"] == {None}
    assert S.near_duplicates(df.limit(0)).count() == 0
