"""The pipeline against a plain-Python run of its stages."""

import hashlib
import sys
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
from corpusforge.llm import quality_llr, simhash_bits, temperature_mix  # noqa: E402
from test_documents import slow_lines  # noqa: E402
from test_simhash_bits import slow_components, slow_fingerprint  # noqa: E402

SF = "/root/testdata/sf0.001"


def stored(df, folder, name):
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def test_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    first = stored(corpus_pipeline.quality_rules(spark, docs, SF), tmp_path, "first")
    judged = quality_llr.judge(docs, quality_llr.fit(docs, spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")))
    assert first.columns == columns
    assert {r.doc_id for r in first.collect()} == {r.doc_id for r in judged.where("kept").collect()}
    rows = [(r.doc_id, r.text) for r in first.collect()]

    second = stored(corpus_pipeline.line_deduplication(spark, first, SF), tmp_path, "second")
    assert second.columns == columns
    got = second.collect()
    assert sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in got) == sorted((d, h) for d, _, _, h in slow_lines(rows))
    assert all(r.n_chars == len(r.text) for r in got)

    third = stored(corpus_pipeline.simhash_near_dedup(spark, second, SF), tmp_path, "third")
    assert third.columns == columns
    fp = {r.doc_id: slow_fingerprint(r.text) for r in got}
    root = slow_components(fp.values())
    least = {}
    for d in sorted(fp):
        least.setdefault(root[fp[d]], d)
    kept = third.collect()
    assert sorted(r.doc_id for r in kept) == sorted(least.values()) and len(kept) < len(got)

    fourth = stored(corpus_pipeline.mix_sources(spark, third, SF), tmp_path, "fourth")
    assert fourth.columns == columns
    tokens = Counter()
    for r in kept:
        tokens[r.source] += len(r.text.encode().split())
    sources = sorted(tokens)
    shares = [tokens[s] for s in sources]
    import math
    a = temperature_mix.exponent_for(shares, temperature_mix.ENTROPY_SHARE * math.log(len(shares)), temperature_mix.MAX_REPEATS)
    w = temperature_mix.weights_at(shares, a)
    length = max(t / x for t, x in zip(shares, w))
    dealt = Counter()
    for r in fourth.collect():
        dealt[r.source] += len(r.text.encode().split())
    longest = max(len(r.text.encode().split()) for r in kept)
    for s, x in zip(sources, w):
        assert -1 <= dealt[s] - x * length <= longest
    assert {r.doc_id for r in fourth.collect()} == {r.doc_id for r in kept}

    last = corpus_pipeline.run(spark, SF)
    assert Counter(r.doc_id for r in last.collect()) == Counter(r.doc_id for r in fourth.collect())


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None), (1, "", "en", "a", 0), (None, "x", "en", "a", 1), (None, "x", "en", "a", 1), (3, "Word " * 200, "en", "b", 1000),
            (4, "Word " * 200, "en", "b", 1000), (4, "Word " * 200, "de", "b", 1000), (5, " ".join(f"w{i}" for i in range(300)), None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, given, SF)
            n = out.count()
            if name != "packing":
                assert out.columns == docs.columns
            if name in ("line_dedup", "packing"):
                assert n == given.count()
    # documents 1 (null, empty), x (null id), the copies 3 and 4, and 5
    assert sorted((r.doc_id for r in simhash_bits.keep_one(docs).collect()), key=str) == [1, 3, 5, None]


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "packing"]
