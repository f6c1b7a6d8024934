import numpy as np
import pytest

from corpusforge.llm import sorted_passes as S
from corpusforge.llm.queries import op13_embedding_near_dedup

SF = "/root/testdata/sf0.01"


def slow(rows, threshold=0.95):
    """Sorted (id, n_links, component_id, kept) of rows (id, vector or None) by all pairs."""
    ok = [v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for _, v in rows]
    n = len(rows)
    links = [[] for _ in rows]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                x, y = np.array(rows[i][1], dtype=float), np.array(rows[j][1], dtype=float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold or rows[i][1] == rows[j][1]:
                    links[i].append(j)
                    links[j].append(i)
    name, out = {}, []
    for i in range(n):
        if i not in name:
            part, todo = {i}, [i]
            while todo:
                for k in links[todo.pop()]:
                    if k not in part:
                        part.add(k)
                        todo.append(k)
            least = min((rows[k][0] for k in part if rows[k][0] is not None), default=None)
            name.update(dict.fromkeys(part, least))
    for i, (key, _) in enumerate(rows):
        out.append((key, len(links[i]), name[i], key is not None and key == name[i]))
    return sorted(out, key=str)


def got(df, **how):
    out = S.near_duplicates(df, **how)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def cluster(rng, n, dim, spread):
    centre = rng.standard_normal(dim)
    return [(centre + spread * rng.standard_normal(dim)).astype(np.float32).tolist() for _ in range(n)]


def test_query_against_all_pairs(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    out = sorted((tuple(r) for r in op13_embedding_near_dedup(spark, SF).collect()), key=str)
    assert out == slow(rows)


@pytest.mark.parametrize("how", [{}, {"window": 4, "block": 8, "tile": 3}, {"window": 8, "block": 64, "tile": 16}])
def test_clusters_chains_and_copies(spark, how):
    rng = np.random.default_rng(3)
    vectors = [v for n in (1, 2, 3, 9, 40) for v in cluster(rng, n, 16, 0.05)]
    vectors += [vectors[-1]] * 30  # copies
    vectors += [[2 * c for c in vectors[0]]]  # the same direction
    a, b = rng.standard_normal(16), rng.standard_normal(16)
    vectors += [(np.cos(t) * a + np.sin(t) * b).astype(np.float32).tolist() for t in np.arange(0, 2.4, 0.2)]  # neighbours link, ends do not
    rows = [(1000 - i, v) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert got(df, **how) == slow(rows)


def test_recall_of_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):  # pairs between 0.95 and 0.955, the hardest
        x, y = rng.standard_normal(64), rng.standard_normal(64)
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        y /= np.linalg.norm(y)
        c = 0.9501 + 0.005 * rng.random()
        rows += [(2 * i, x.tolist()), (2 * i + 1, (c * x + np.sqrt(1 - c * c) * y).tolist())]
    rows += [(1000 + i, rng.standard_normal(64).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r[0]: r for r in got(df, window=32, block=256)}
    found = sum(out[2 * i][1] == 1 and out[2 * i + 1][2] == 2 * i for i in range(400))
    assert found >= 390  # RECALL is 0.995 of such pairs
    assert sum(r[1] for k, r in out.items() if k >= 1000) == 0


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
            (7, one, 1), (7, one, 1), (8, [2.0, 4.0, 6.0], 1), (None, one, 1), (9, [1.0, 2.0], 1), (None, [5.0, 0.0, 0.0], 1), (None, [5.0, 0.0, 0.0], 1),
            (10, [1e200, 0.0, 1e-200], 1), (11, [1e-200, 0.0, 0.0], 1), (12, [-0.0, 1.0, 0.0], 1), (13, [0.0, 1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    out = got(df)
    by = {}
    for r in out:
        by.setdefault(r[0], []).append(r[1:])
    assert len(out) == len(rows)
    assert all(by[i] == [(0, i, True)] for i in (1, 2, 3, 4, 5, 6, 9))
    assert by[7] == [(3, 7, True)] * 2 and by[8] == [(3, 7, False)]
    assert sorted(by[None], key=str) == sorted([(3, 7, False), (3, 10, False), (3, 10, False)], key=str)
    assert by[10] == [(3, 10, True)] and by[11] == [(3, 10, False)]
    assert by[12] == [(1, 12, True)] and by[13] == [(1, 12, False)]
    assert S.near_duplicates(df.limit(0)).count() == 0


def test_passes_follow_from_the_number_of_vectors():
    counts = [S.passes_for(n) for n in (0, 1, 1000, 10**5, 10**7, 10**9)]
    assert counts == sorted(counts) and counts[0] == 1
    for n, k in zip((10**5, 10**7), counts[3:]):
        signs = np.ceil(np.log2(2 * n / S.WINDOW))
        assert 1 - (1 - (1 - np.arccos(0.95) / np.pi) ** signs) ** k >= S.RECALL
