"""Extra columns whose names clash with an operator's own, lengths from a column, and long texts in proportion."""

import time

import public_tokenizers as files
from pyspark.sql import functions as F

import corpus_pipeline
from corpusforge.llm import length_buckets, license_align, temperature_mix, token_counts, weak_toxicity

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def clashing(docs, *names):
    return docs.select("*", *[F.lit(7).alias(n) for n in names])


def test_clashing_columns_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    path = files.path("word_bpe_49k.json")
    assert rows(token_counts.count_tokens(clashing(docs, "id", "n_bytes", "n_tokens", "row", "tokens"), path)) == rows(token_counts.count_tokens(docs, path))
    assert rows(length_buckets.pack(clashing(docs, "id", "n_tokens", "order", "place", "bucket_len"))) == rows(length_buckets.pack(docs))
    model = weak_toxicity.fit(docs, labels)
    assert rows(weak_toxicity.score(clashing(docs, "score", "predicted", "held_out", "toxic"), model)) == rows(weak_toxicity.score(docs, model))
    assert rows(license_align.scan(clashing(docs, "license", "matches", "id"))) == rows(license_align.scan(docs))


def test_pipeline_stages_keep_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plain, more = docs, clashing(docs, "n_words", "kept", "fp", "epoch", "block")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, more = stage(spark, plain, SF), stage(spark, more, SF)
        assert more.columns == docs.columns + ["n_words", "kept", "fp", "epoch", "block"], name
        assert rows(more.select(docs.columns)) == rows(plain), name
        assert more.where("n_words <> 7 or kept <> 7 or fp <> 7 or epoch <> 7 or block <> 7").count() == 0
        plain, more = spark.createDataFrame(plain.collect(), plain.schema), spark.createDataFrame(more.collect(), more.schema)


def test_lengths_from_a_column(spark):
    docs = spark.createDataFrame([(i, "x" * 50, "s" if i % 3 else "t", n) for i, n in enumerate([1, 5, None, 900, 900, 40, -3])], "doc_id long, text string, source string, size int")
    packed = {r.doc_id: r.n_tokens for r in length_buckets.pack(docs, tokens_col="size").collect()}
    assert packed == {0: 1, 1: 5, 2: 0, 3: 900, 4: 900, 5: 40, 6: 0}
    dealt = {r.doc_id: r.n_tokens for r in temperature_mix.sequence(docs, tokens_col="size").collect()}
    assert dealt == packed
    assert {r.doc_id for r in temperature_mix.apply(docs, tokens_col="size").collect()} == set(packed)


def test_cutting_long_texts_takes_time_in_proportion():
    def seconds(chars):
        import pyarrow as pa
        batch = pa.record_batch([pa.array([1]), pa.array(["é word " * (chars // 7)])], names=["row", "text"])
        best = 1e9
        for _ in range(3):
            t, n = time.perf_counter(), 0
            for b in token_counts._cut_text(token_counts.CHUNK_CHARS, token_counts.OVERLAP)([batch]):
                n += b.num_rows
            best = min(best, time.perf_counter() - t)
        assert n == -(-(7 * (chars // 7) - token_counts.OVERLAP) // token_counts.CHUNK_CHARS)
        return best
    short, long = seconds(8_000_000), seconds(32_000_000)
    assert long < 12 * short  # four times the text; the square would be sixteen


def test_pieces_cover_the_text():
    import pyarrow as pa
    text = "".join(chr(97 + i % 26) for i in range(1000))
    for n in (0, 1, 30, 99, 100, 101, 1000):
        batch = pa.record_batch([pa.array([5]), pa.array([text[:n]])], names=["row", "text"])
        got = [r for b in token_counts._cut_text(30, 7)([batch]) for r in b.to_pylist()]
        assert [r["no"] for r in got] == list(range(len(got))) and "".join(r["piece"][:30] for r in got[:-1]) + got[-1]["piece"] == text[:n]
