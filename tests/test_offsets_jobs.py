"""Offsets, slices, gzip members, upserts, jobs and streaming (properties + negatives)."""
import gzip
import hashlib
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import offsets
from corpusforge.plans import jobs, mappings, records, standins
from corpusforge.sources import corpus, gzip_members, sink
from corpusforge.streaming import incremental

SF = "/root/testdata/sf0.001"


def _tmp():
    return tempfile.mkdtemp(prefix="cf-test-", dir="/tmp")


def test_jsonl_offsets_contiguous_and_exact(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    off = standins.plain_offsets(docs).orderBy(F.col("start")).collect()
    rows = docs.orderBy("doc_id").collect()
    pos = 0
    for o, d in zip(off, rows):
        line = json.dumps({"docno": str(d.doc_id), "text": d.text}, ensure_ascii=False)
        assert o.doc_id == str(d.doc_id)
        assert (o.start, o.end) == (pos, pos + len(line.encode("utf-8")) + 1)
        pos = o.end


def test_read_lines_with_offsets_many_splits(spark):
    d = _tmp()
    expected = {}
    for f in range(3):
        path = os.path.join(d, f"part{f}.jsonl")
        pos = 0
        with open(path, "wb") as fh:
            for i in range(400):
                line = (json.dumps({"docno": f"f{f}-{i}", "text": "é" * (i % 37)}, ensure_ascii=False) + "\n").encode()
                fh.write(line)
                expected[(f"f{f}-{i}")] = (pos, pos + len(line))
                pos += len(line)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = offsets.read_lines_with_offsets(spark, d).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r.doc_id: (r.start, r.end) for r in got} == expected


@pytest.mark.parametrize("start,end", [(None, None), (3, 10), (-20, None), (5, -5), (-7, -2), (50, 10), (None, 500)])
def test_corpus_slice_python_semantics(spark, start, end):
    df = spark.range(0, 120).withColumnRenamed("id", "k").withColumn("k", F.col("k") * 3)
    got = [r.k for r in offsets.corpus_slice(df, "k", start, end, num_buckets=4).orderBy("k").collect()]
    assert got == list(range(0, 360, 3))[start:end]


def test_corpus_slice_string_keys(spark):
    ids = [f"doc-{i:05d}" for i in range(0, 300, 7)]
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "doc_id string")
    got = [r.doc_id for r in offsets.corpus_slice(df, "doc_id", 5, -5, num_buckets=3).orderBy("position").collect()]
    assert got == ids[5:-5]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_plan_of_running_sums_does_not_grow_with_the_buckets(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    few, many = (offsets.ordered_running_sum(df, "v", "k", num_buckets=n) for n in (2, 600))
    strip = lambda p: len("".join(c for c in p if not c.isdigit()))
    assert strip(_plan(few)) == strip(_plan(many))  # no bounds in the plan
    assert {r.k: r.start for r in many.collect()} == {i: i for i in range(2000)}


@pytest.mark.parametrize("start,end", [(None, None), (3, 10), (-20, None), (5, -5), (0, 7), (50, 10), (None, 500), (400, None), (119, 120)])
def test_slice_by_key_moves_no_documents(spark, start, end):
    rows = [(i // 7, f"t{i % 7}", "body") for i in range(120)]
    df = spark.createDataFrame(rows, "conv long, turn string, text string").repartition(5)
    got = offsets.slice_by_key(df, ["conv", "turn"], start, end, num_buckets=4)
    assert sorted(tuple(r) for r in got.collect()) == rows[start:end]
    assert "Window" not in _plan(got) and "Join" not in _plan(got)


def test_slice_by_key_pushes_its_bounds_and_needs_a_total_order(spark, tmp_path):
    spark.range(100).withColumn("x", F.lit("body")).write.parquet(str(tmp_path / "d"))
    cut = offsets.slice_by_key(spark.read.parquet(str(tmp_path / "d")), "id", 10, 20)
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThan(id,20)" in plan
    twice = spark.createDataFrame([(i // 2,) for i in range(10)], "k int")
    assert offsets.slice_by_key(twice, "k", 2, 4).count() == 2
    with pytest.raises(ValueError, match="apart"):
        offsets.slice_by_key(twice, "k", 3, None)


def test_duplicate_ids_raise(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "doc_id string")
    assert {tuple(r) for r in offsets.duplicate_ids(df, "doc_id").collect()} == {("a", 2), (None, 1)}
    with pytest.raises(ValueError):
        offsets.check_unique_ids(df, "doc_id")


def test_gzip_members_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = offsets.jsonl_lines(docs.withColumn("n", F.col("doc_id")), "doc_id", ["text"], keep=["n"])
    out = _tmp()
    manifest = gzip_members.write_member_files(lines, "n", out, out + "-members", 3).collect()
    src = {str(r.n): r.line for r in lines.collect()}
    assert len(manifest) == len(src)
    for m in manifest:
        text = gzip_members.read_member(os.path.join(out, m.part_file), m.start, m.end)
        assert text == src[m.doc_id] + "\n"
    # The concatenated members read back as ordinary gzip text.
    part = sorted(p for p in os.listdir(out) if p.endswith(".gz"))[0]
    with gzip.open(os.path.join(out, part), "rt", encoding="utf-8") as fh:
        assert all(json.loads(line)["docno"] in src for line in fh)
    # Spark's text source reads the member files back as the original lines.
    back = sorted(r.value for r in spark.read.text(os.path.join(out, "*.jsonl.gz")).collect())
    assert back == sorted(src.values())


def test_compressed_corpus_job_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    lines = offsets.jsonl_lines(docs.withColumn("n", F.col("doc_id")), "doc_id", ["text"], keep=["n"])
    base = _tmp()
    manifest = jobs.compressed_corpus(spark, lines, "n", os.path.join(base, "files"),
                                      os.path.join(base, "manifest"), 4, verify=True)
    assert manifest.count() == docs.count()
    back = gzip_members.read_members(manifest, os.path.join(base, "files"))
    assert back.count() == docs.count()


def test_member_files_by_uri_are_cut_and_read_in_stretches(spark):
    from pathlib import Path
    base = Path(_tmp()) / "deep" / "folder"
    lines = spark.range(300).select(F.col("id").alias("n"), F.concat(F.lit('{"docno": "d'), F.lpad(F.col("id").cast("string"), 3, "0"),
                                                                     F.lit('", "t": "é\\r'), F.md5(F.col("id").cast("string")), F.lit('"}')).alias("line"))
    out, table = (base / "files").as_uri(), (base / "members").as_uri()
    members = gzip_members.write_member_files(lines, "n", out, table, 2, max_file_bytes=2000)
    parts = sorted(p.name for p in (base / "files").iterdir())
    assert len(parts) > 8 and members.count() == 300  # more files than tasks
    assert sorted({r.part_file for r in members.collect()}) == parts
    back = gzip_members.read_members(members, out, read_bytes=300)
    stretches = members.select("part_file", F.floor(F.col("start") / 300)).distinct().count()
    assert stretches > 2 * len(parts)  # more tasks than files
    assert sorted(r.line for r in back.collect()) == sorted(r.line for r in lines.collect())
    whole = "".join(gzip.open(base / "files" / p, "rt", encoding="utf-8", newline="").read() for p in parts)
    assert whole == "".join(r.line + "\n" for r in lines.orderBy("n").collect())  # files follow the order
    # A smaller job in the same place leaves nothing of the larger one.
    again = gzip_members.write_member_files(lines.where("n < 5"), "n", out, table, 1)
    assert again.count() == 5 and len(list((base / "files").iterdir())) == 1


def test_a_failed_job_leaves_the_files_of_the_last_one(spark):
    from pathlib import Path
    base = Path(_tmp())
    out, table = str(base / "files"), str(base / "members")
    lines = spark.range(50).select(F.col("id").alias("n"), F.concat(F.lit('{"docno": "'), "id", F.lit('"}')).alias("line"))
    gzip_members.write_member_files(lines, "n", out, table, 2)
    before = {p: p.read_bytes() for d in (out, table) for p in Path(d).iterdir()}
    bad = lines.withColumn("line", F.when(F.col("n") == 40, F.raise_error(F.lit("lost"))).otherwise(F.concat("line", F.lit(" "))))
    with pytest.raises(Exception, match="lost"):
        gzip_members.write_member_files(bad, "n", out, table, 4)
    assert {p: p.read_bytes() for d in (out, table) for p in Path(d).iterdir()} == before


def test_upsert_last_wins_and_idempotent(spark):
    path = os.path.join(_tmp(), "t")
    b1 = spark.createDataFrame([("a", 1), ("b", 1)], "_id string, v int")
    b2 = spark.createDataFrame([("b", 2), ("c", 2), ("c", 3)], "_id string, v int")

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    assert rows(sink.upsert(b1, b2, "_id", ("v",))) == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(sink.upsert(b1, b2, "_id", ("v",), first=True)) == [("a", 1), ("b", 1), ("c", 2)]
    assert rows(sink.upsert(None, b2.limit(0), "_id")) == []
    sink.create_table(spark, path, b1.schema)
    assert rows(sink.read_table(spark, path)) == []
    sink.write_load(b1, path, 1, num_shards=3)
    sink.create_table(spark, path, b1.schema)  # leaves what is there
    for _ in range(2):  # the same load again replaces itself
        sink.write_load(b2, path, 2, num_shards=3)
        assert rows(sink.read_table(spark, path, order=("v",))) == [("a", 1), ("b", 2), ("c", 3)]
    assert rows(sink.read_table(spark, path, order=("v",), first=True)) == [("a", 1), ("b", 1), ("c", 2)]
    sink.compact(spark, path, path + "2", order=("v",))
    assert rows(sink.read_table(spark, path + "2")) == [("a", 1), ("b", 2), ("c", 3)]


def test_typed_fields_set_bad_values_aside(spark):
    df = spark.createDataFrame([("a", "12", "2024-01-02 03:04:05", "7"), ("b", "x", "never", "300"), ("c", None, None, None)],
                               "uuid string, body_length string, warc_date string, spam_rank string")
    rows = {r.uuid: r for r in records.typed_fields(df).collect()}
    assert (rows["a"].body_length, rows["a"].spam_rank, rows["a"].bad_fields) == (12, 7, [])
    assert rows["a"].warc_date.year == 2024
    assert rows["b"].bad_fields == ["body_length", "warc_date", "spam_rank"] and rows["b"].body_length is None
    assert rows["c"].bad_fields == [] and rows["c"].warc_date is None


IPS = ["1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "01.2.3.4", "::", "::1", "1::", "2001:db8::8a2e:370:7334", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7",
       "1:2:3:4:5:6:7::", "1:2:3:4:5:6:7:8::", "1::2::3", "::ffff:1.2.3.4", "1:2:3:4:5:6:1.2.3.4", "::256.1.1.1", "g::1", "", ":", "12345::"]


def test_addresses_are_checked_and_bad_rows_set_aside(spark):
    import ipaddress

    def ok(x):
        try:
            return ipaddress.ip_address(x) is not None
        except ValueError:
            return False
    raw = spark.createDataFrame([(f"u{i}", ip, str(i)) for i, ip in enumerate(IPS)] + [("n", None, "x")], "uuid string, warc_ip_address string, content_length string")
    got = {r.uuid: (r.warc_ip_address, r.bad_fields) for r in records.typed_fields(raw, "meta").collect()}
    leading_zero = {"01.2.3.4"}  # octets of one leading zero are read
    for i, ip in enumerate(IPS):
        if ip not in leading_zero:
            assert got[f"u{i}"] == ((ip, []) if ok(ip) else (None, ["warc_ip_address"])), ip
    base = _tmp()
    out = sink.write_typed(raw, os.path.join(base, "t"), os.path.join(base, "q"), "meta")
    aside = spark.read.parquet(os.path.join(base, "q")).collect()
    assert out["written"] + out["set_aside"] == len(IPS) + 1 == spark.read.parquet(os.path.join(base, "t")).count() + len(aside)
    assert json.loads([r.raw for r in aside if r.bad_fields == ["content_length"]][0]) == {"uuid": "n", "content_length": "x"}


def test_colliding_keys_fail_or_go_elsewhere(spark):
    base = _tmp()
    meta, data, lost = (os.path.join(base, x) for x in ("meta", "data", "lost"))
    d = standins.plain_docs(spark.read.parquet(f"{SF}/documents.parquet"))
    offsets = standins.plain_offsets(spark.read.parquet(f"{SF}/documents.parquet"))
    records = mappings.dataset_mapping("msmarco-document").records(d, "b", offsets=offsets)
    clash = records.withColumn("_id", F.concat(F.lit("k"), F.expr("CAST(m_warc_trec_id AS INT) DIV 3")))
    with pytest.raises(ValueError, match="shared by different documents"):
        sink.write_index(clash, meta, data, 2, 2)
    out = sink.write_index(clash, meta, data, 2, 2, collisions_path=lost)
    m, x = sink.read_index(spark, meta, data)
    assert out["key_collisions"] > 0 and out["documents"] == m.count() + sink.read_loads(spark, lost).count()
    assert out["written_meta"] == out["written_data"] == m.count()
    # Both tables hold the same document under every key.
    pairs = m.select("_id", "uuid").join(x.select("_id", F.col("uuid").alias("u")), "_id")
    assert pairs.count() == m.count() == x.count() and pairs.where("uuid <> u").count() == 0


def test_index_corpus_two_tables(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    base = _tmp()
    meta, data = os.path.join(base, "meta"), os.path.join(base, "data")
    out = jobs.index_corpus(spark, "msmarco-document", standins.plain_docs(d), meta, data, bucket="b",
                            start=10, end=-10, order_key="n", offsets=standins.plain_offsets(d))
    m, x = sink.read_index(spark, meta, data)
    assert out["documents"] == d.count() - 20 == m.count() == x.count()
    assert out["key_collisions"] == 0
    assert sorted(r._id for r in m.select("_id").collect()) == sorted(r._id for r in x.select("_id").collect())
    before = sorted(tuple(r) for r in m.collect())
    # Re-running the same job leaves the tables unchanged.
    jobs.index_corpus(spark, "msmarco-document", standins.plain_docs(d), meta, data, bucket="b",
                      start=10, end=-10, order_key="n", offsets=standins.plain_offsets(d))
    assert sorted(tuple(r) for r in sink.read_index(spark, meta, data)[0].collect()) == before


def _two_documents_one_key(spark):
    d = standins.plain_docs(spark.read.parquet(f"{SF}/documents.parquet")).where("n < 12")
    offsets = standins.plain_offsets(spark.read.parquet(f"{SF}/documents.parquet"))
    r = mappings.dataset_mapping("msmarco-document").records(d, "b", offsets=offsets)
    n = F.expr("CAST(m_warc_trec_id AS INT)")
    return (r.where(n < 6).withColumn("_id", F.concat(F.lit("k"), n)),  # k0 .. k5
            r.where(n >= 4).withColumn("_id", F.concat(F.lit("k"), F.when(n == 6, 0).otherwise(n))))  # k4, k5 again; 6 under k0


def test_collisions_between_loads_fail_or_go_elsewhere(spark):
    base = _tmp()
    meta, data, lost = (os.path.join(base, x) for x in ("meta", "data", "lost"))
    one, two = _two_documents_one_key(spark)
    assert sink.write_index(one, meta, data, 2, 2, load=1)["documents"] == 6
    before = sorted(tuple(r) for r in sink.read_index(spark, meta, data)[1].collect())
    with pytest.raises(ValueError, match="k0"):
        sink.write_index(two, meta, data, 2, 2, load=2)
    # The load that failed shows in neither table.
    assert sorted(tuple(r) for r in sink.read_index(spark, meta, data)[1].collect()) == before
    out = sink.write_index(two, meta, data, 2, 2, load=2, collisions_path=lost)
    assert (out["documents"], out["written_data"], out["key_collisions"]) == (8, 7, 1)
    m, x = sink.read_index(spark, meta, data)
    ids = {r._id: r.uuid for r in m.collect()}
    assert sorted(ids) == sorted(f"k{i}" for i in range(12) if i != 6) == sorted(r._id for r in x.collect())
    first = {r._id: r.uuid for r in one.select("_id", F.col("m_uuid").alias("uuid")).collect()}
    assert ids["k0"] == first["k0"]  # the key stays with its document
    aside = sink.read_loads(spark, lost).collect()
    assert [(r._id, r.shared_key, r.load) for r in aside] == [("k0", True, 2)]
    assert sink.stored_collisions(spark, meta, data).count() == 0
    # The same load again replaces itself and meets only other loads.
    assert sink.write_index(two, meta, data, 2, 2, load=2, collisions_path=lost) == out
    assert sink.read_loads(spark, lost).count() == 1


def test_a_load_shows_in_both_tables_or_in_none(spark):
    base = _tmp()
    meta, data = os.path.join(base, "meta"), os.path.join(base, "data")
    one, two = _two_documents_one_key(spark)
    sink.write_index(one, meta, data, 2, 2, load=1)
    # A job that ends between the two writes, or before its commit.
    sink.write_load(records.meta_table(two), meta, 2, "_id", 2, attempt=sink.new_attempt())
    assert [t.count() for t in sink.read_index(spark, meta, data)] == [6, 6]
    half = sink.new_attempt()
    sink.write_load(records.meta_table(two), meta, 1, "_id", 2, attempt=half)
    sink.write_load(records.data_table(two), data, 1, "_id", 2, attempt=half)
    assert [t.count() for t in sink.read_index(spark, meta, data)] == [6, 6]
    sink.commit_load(spark, data + "/_commits", 1, half)
    assert [t.count() for t in sink.read_index(spark, meta, data)] == [8, 8]


def test_winners_are_found_without_bodies(spark):
    path = os.path.join(_tmp(), "t")
    for load in (1, 2):
        sink.write_load(spark.range(20).select(F.col("id").cast("string").alias("_id"), F.lit("x" * 50 * load).alias("body"), F.lit(load).alias("v")), path, load)
    t = sink.read_table(spark, path)
    assert {r.v for r in t.collect()} == {2} and t.count() == 20
    scans = [line for line in t._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if "ReadSchema" in line]
    assert len(scans) >= 2 and sum("body" in line.split("ReadSchema")[1] for line in scans) == 1


def test_repeated_side_rows_double_nothing(spark):
    conv = spark.read.parquet(f"{SF}/conversations.parquet")
    m = mappings.dataset_mapping("msmarco-passage-v2")
    sides = dict(offsets=standins.passage_offsets(conv))
    parents = standins.parent_documents(conv)
    newer = parents.withColumn("title", F.concat(F.lit("new "), "title"))
    both = parents.withColumn("position", F.lit(1)).unionByName(newer.withColumn("position", F.lit(2)))
    got = m.records(standins.passages(conv), "b", parents=both, **sides).select("m_uuid", "d_title")
    assert sorted(got.collect()) == sorted(m.records(standins.passages(conv), "b", parents=newer, **sides).select("m_uuid", "d_title").collect())
    assert got.count() == conv.count()
    docs = standins.web_docs(standins.inject_page_features(spark.read.parquet(f"{SF}/pages.parquet")))
    lines = standins.web_line_offsets(docs)
    web = mappings.dataset_mapping("clueweb22")
    want = web.records(docs, "b", line_offsets=lines).count()
    assert web.records(docs, "b", line_offsets=lines.unionByName(lines)).count() == want
    half = lines.withColumn("txt_offset", F.when(F.col("doc_no") % 2 == 0, F.col("txt_offset")))
    with pytest.raises(Exception, match="No line offset.*txt_offset"):
        web.records(docs, "b", line_offsets=half).collect()


def test_parent_metadata_file_keeps_the_last_entry(spark):
    d = _tmp()
    with open(os.path.join(d, "p.jsonl"), "w") as fh:
        for i in range(400):
            fh.write(json.dumps({"original_document": {"doc_id": f"d{i % 100}", "title": f"z{400 - i}", "url": "u"}}) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = {r.parent_id: r.p_title for r in mappings.last_parents(corpus.read_parent_metadata(spark, d)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"d{i}": f"z{400 - 300 - i}" for i in range(100)}


def test_document_offsets_job(spark):
    d = _tmp()
    with open(os.path.join(d, "c.jsonl"), "w", encoding="utf-8", newline="") as fh:
        fh.write('{"docno": "x"}\n{"docno": "y", "t": "é"}\r\n{"docno": "z"}')
    out = jobs.document_offsets(spark, d, os.path.join(_tmp(), "off"))
    got = {r.doc_id: (r.start, r.end) for r in out.collect()}
    assert got == {"x": (0, 15), "y": (15, 42), "z": (42, 56)}
    with open(os.path.join(d, "c.jsonl"), "a", encoding="utf-8") as fh:
        fh.write('\n{"docno": "x"}\n')
    with pytest.raises(ValueError):
        jobs.document_offsets(spark, d, os.path.join(_tmp(), "off2"))


def test_missing_offset_fails(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    docs = standins.plain_docs(d)
    partial = standins.plain_offsets(d.filter(F.col("doc_id") != 3))
    m = mappings.dataset_mapping("msmarco-document")
    with pytest.raises(Exception, match="No offset for document 3"):
        m.records(docs, "b", offsets=partial).collect()
    assert [r.doc_id for r in mappings.missing_offsets(docs, partial).collect()] == ["3"]


def test_malformed_v21_id_fails(spark):
    df = spark.createDataFrame([("msmarco_v2.1_doc_00_123",), ("msmarco_v2_doc_00_1",)], "doc_id string")
    df = df.withColumn("text", F.lit("t")).withColumn("title", F.lit("x")).withColumn("url", F.lit("http://a/b"))
    m = mappings.dataset_mapping("msmarco-document-v2.1")
    with pytest.raises(Exception, match="Malformed"):
        m.records(df, "b").collect()
    good = df.filter(F.col("doc_id") == "msmarco_v2.1_doc_00_123")
    ok = m.records(good, "b").select("m_source_file", "m_source_offset").first()
    assert tuple(ok) == ("s3://corpus-msmarco-document-v2.1/msmarco_v2.1_doc_00.json", 123)


def test_router():
    assert mappings.dataset_mapping("msmarco-document-v2.1/segmented").name == "msmarco-document-v2.1/segmented"
    assert mappings.dataset_mapping("msmarco-document-v2.1").name == "msmarco-document-v2.1"
    assert mappings.dataset_mapping("msmarco-document-v2").name == "msmarco-document-v2"
    assert mappings.dataset_mapping("msmarco-passage").name == "msmarco-passage"
    assert mappings.dataset_mapping("clueweb22/b").name == "clueweb22"
    assert mappings.dataset_mapping("vaswani").corpus_prefix == "vaswani"
    assert mappings.dataset_mapping("argsme/2020-04-01/processed").corpus_prefix == "argsme-2020-04-01-processed"
    with pytest.raises(NotImplementedError):
        mappings.dataset_mapping("unknown/corpus")


def test_offsets_dict_import_and_line_offsets(spark):
    d = _tmp()
    with gzip.open(os.path.join(d, "o.json.gz"), "wt") as fh:
        fh.write(json.dumps({"a": {"start": 0, "end": 10}, "b": {"start": 10, "end": 25}}))
    got = sorted(tuple(r) for r in corpus.import_offsets_dict(spark, os.path.join(d, "o.json.gz")).collect())
    assert got == [("a", 0, 10), ("b", 10, 25)]
    lo = os.path.join(d, "html", "en00", "en0000")
    os.makedirs(lo)
    with open(os.path.join(lo, "en0000-01.warc.offset"), "w") as fh:
        fh.write("0\n120\n987\n")
    rows = corpus.read_line_offsets(spark, os.path.join(d, "html", "*", "*", "*.offset")).orderBy("doc_no").collect()
    assert [tuple(r) for r in rows] == [("en00/en0000/en0000-01", 0, 0), ("en00/en0000/en0000-01", 1, 120),
                                        ("en00/en0000/en0000-01", 2, 987)]


def test_offsets_dict_is_split_and_checked(spark):
    d = _tmp()
    want = {f'id "{i}"\\ é,: ': {"start": 7 * i, "end": 7 * i + 5} for i in range(5000)}
    for name, text in (("o.json", json.dumps(want)), ("spaced.json", json.dumps(want, indent=1, ensure_ascii=False))):
        path = os.path.join(d, name)
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(text)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
        try:
            table = corpus.import_offsets_dict(spark, path)
            assert table.rdd.getNumPartitions() > 8
            assert {r.doc_id: {"start": r.start, "end": r.end} for r in table.collect()} == json.loads(text)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for bad in ('{"a}b": {"start": 1, "end": 2}}', '{"a": {"start": 1}}', '{"a": 5}', "[1, 2]"):
        path = os.path.join(d, "bad.json")
        with open(path, "w") as fh:
            fh.write(bad)
        with pytest.raises(Exception, match="Not an entry"):
            corpus.import_offsets_dict(spark, path).collect()
    with open(path, "w") as fh:
        fh.write(" {} ")
    assert corpus.import_offsets_dict(spark, path).collect() == []


def test_web_mapping_from_offsets_files(spark):
    base = _tmp()
    docs = standins.web_docs(standins.inject_page_features(spark.read.parquet(f"{SF}/pages.parquet")))
    table = standins.web_line_offsets(docs)
    # Line n of a file is the offset of document n: lines between known documents are zero.
    files = {}
    for r in table.collect():
        files.setdefault(r.stem, {})[r.doc_no] = (r.html_offset, r.txt_offset)
    for stem, lines in files.items():
        for i, (fmt, ending) in enumerate((("html", "warc.offset"), ("txt", "json.offset"))):
            path = os.path.join(base, fmt, *stem.split("/")) + "." + ending
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(path, "w") as fh:
                fh.writelines(f"{lines.get(n, (0, 0))[i]}\n" for n in range(max(lines) + 1))
    back = corpus.read_web_line_offsets(spark, *(os.path.join(base, f, "*", "*", "*.offset") for f in ("html", "txt")))
    m = mappings.dataset_mapping("clueweb22")
    cols = ["_id", "m_source_offset", "m_plaintext_source_offset"]
    want, got = (sorted(tuple(r) for r in m.records(docs, "b", line_offsets=t).select(cols).collect()) for t in (table, back))
    assert want == got and len(want) > 0


def test_streaming_incremental_index(spark):
    base = _tmp()
    src = os.path.join(base, "in")
    d = spark.read.parquet(f"{SF}/documents.parquet")
    docs = standins.plain_docs(d).select("doc_id", "text", "title", "url")
    docs.filter(F.col("doc_id").cast("int") < 100).write.parquet(os.path.join(src, "b1"))
    docs.filter(F.col("doc_id").cast("int") >= 100).write.parquet(os.path.join(src, "b2"))
    m = mappings.dataset_mapping("msmarco-document-v2.1")
    # v2.1 keys carry their own location, so no side table is needed.
    v21 = docs.withColumn("doc_id", F.concat(F.lit("msmarco_v2.1_doc_00_"), F.col("doc_id")))
    v21.write.mode("overwrite").parquet(os.path.join(base, "in2"))
    q = incremental.start_incremental_index(spark, os.path.join(base, "in2"), v21.schema, m,
                                            os.path.join(base, "meta"), os.path.join(base, "data"),
                                            os.path.join(base, "ckpt"))
    q.awaitTermination(300)
    assert [t.count() for t in sink.read_index(spark, os.path.join(base, "meta"), os.path.join(base, "data"))] == [d.count()] * 2


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "m_uuid" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_records_helpers(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    r = mappings.dataset_mapping("msmarco-document").records(
        standins.plain_docs(d), "b", offsets=standins.plain_offsets(d))
    acts = records.index_actions(records.meta_table(r), "meta-idx").first()
    assert acts["_op_type"] == "index" and acts["_index"] == "meta-idx"
    wide = records.stored_view(records.language_columns(records.data_table(r), ("en", "fr")))
    assert "warc_target_query_string" not in wide.columns and "full_body_lang_en" not in wide.columns
    assert "body_lang_en" in wide.columns
    assert records.field_kind("title_lang_de") == "text:de"
    assert records.field_kind("warc_foo") == "keyword"
    assert records.field_kind("warc_ip_address", "meta") == "ip"


def test_wide_json_written_form(spark):
    import datetime
    rows = [("u1", "de", datetime.datetime(2022, 1, 2, 3, 4, 5), "T", ["k1", "k2"], None, "B", 1, "F", [])]
    df = spark.createDataFrame(rows, "uuid string, lang string, warc_date timestamp, title string, "
                                     "meta_keywords array<string>, meta_desc string, body string, body_length bigint, "
                                     "full_body string, headings array<string>")
    fields = [(n, t) for n, t in records.DATA_FIELDS if n in df.columns]
    doc = json.loads(df.select(records.wide_json(df, fields)).first()[0])
    assert doc["title_lang_de"] == "T" and doc["body_lang_de"] == "B" and doc["full_body_lang_de"] == "F"
    assert doc["meta_keywords_lang_de"] == ["k1", "k2"] and doc["headings_lang_de"] == []
    assert "meta_desc_lang_de" not in doc and "title" not in doc
    assert doc["body_length"] == "1"
    assert doc["warc_date"].endswith("+00:00") and doc["warc_date"].startswith("2022-01-02T")


@pytest.mark.parametrize("buckets", [1, 3, 11])
def test_offsets_independent_of_bucket_count(spark, buckets):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(5)
    lines = offsets.jsonl_lines(docs.withColumn("n", F.col("doc_id")), "doc_id", ["text"], keep=["n"])
    got = sorted(tuple(r) for r in offsets.jsonl_offsets(lines, "n", num_buckets=buckets)
                 .select("doc_id", "start", "end").collect())
    ref = sorted((r.doc_id, r.start, r.end) for r in standins.plain_offsets(
        spark.read.parquet(f"{SF}/documents.parquet")).collect())
    assert got == ref


def _sequential(rows, key):
    start, out = 0, {}
    for r in sorted(rows, key=key):
        out[r[:-2]] = start
        start += r[-2]
    return out


def test_running_sum_of_string_keys_with_payload(spark):
    n = 200_000
    rows = [(hashlib.md5(str(i).encode()).hexdigest(), i % 97, "p%d" % i) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, v long, payload string").repartition(8)
    got = offsets.ordered_running_sum(df, "v", "k", num_buckets=16).select("k", "start", "payload").collect()
    assert {(r.k,): r.start for r in got} == _sequential(rows, lambda r: r[0])
    assert len(got) == n


def test_running_sum_splits_a_hot_first_key(spark):
    rows = [(7 if i % 10 else i, i, i % 13, "x") for i in range(20_000)]
    df = spark.createDataFrame(rows, "conv long, turn long, v long, payload string")
    dealt = offsets.in_ranges(df, ["conv", "turn"], 16)
    sizes = [r["count"] for r in dealt.groupBy("__bucket").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 4 * 20_000 / 16
    got = offsets.ordered_running_sum(df, "v", ["conv", "turn"], num_buckets=16).collect()
    assert {(r.conv, r.turn): r.start for r in got} == _sequential(rows, lambda r: r[:2])


def test_offsets_refuse_compressed_files(spark, tmp_path):
    spark.createDataFrame([('{"docno": "a"}',)], "value string").write.option("compression", "gzip").text(str(tmp_path / "z"))
    with pytest.raises(Exception, match="uncompressed"):
        offsets.read_lines_with_offsets(spark, str(tmp_path / "z")).collect()


def test_id_field_with_a_dot(spark):
    lines = spark.createDataFrame([(1, '{"doc.no": "a"}')], "n long, line string")
    assert offsets.jsonl_offsets(lines, "n", id_field="doc.no").collect()[0].doc_id == "a"


def test_missing_line_offset_fails(spark):
    from corpusforge.plans import mappings, standins
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(20)
    docs = standins.web_docs(standins.inject_page_features(pages))
    lines = standins.web_line_offsets(docs)
    mapping = mappings.dataset_mapping("clueweb22")
    assert mapping.records(docs, "b", line_offsets=lines).count() > 0
    with pytest.raises(Exception, match="No line offset"):
        mapping.records(docs, "b", line_offsets=lines.limit(1)).collect()


def test_offsets_entry_given_twice_counts_once(spark):
    from corpusforge.plans import mappings
    docs = spark.createDataFrame([("a", "t")], "doc_id string, text string")
    off = spark.createDataFrame([("a", 0, 5), ("a", 9, 12)], "doc_id string, start long, end long")
    assert [(r.off_start, r.off_end) for r in mappings.attach_offsets(docs, off).collect()] == [(9, 12)]


def test_written_actions_job(spark):
    out = os.path.join(_tmp(), "actions")
    d = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 20")
    docs = standins.plain_docs(d)
    off = standins.plain_offsets(d)
    jobs.write_actions(spark, "msmarco-document", docs, out, "m", "x", "b", offsets=off)
    rows = {(r.m_warc_trec_id): r for r in mappings.dataset_mapping("msmarco-document").records(docs, "b", offsets=off).collect()}
    seen = 0
    for name in sorted(os.listdir(out)):
        if name.endswith(".gz"):
            with gzip.open(os.path.join(out, name), "rt", encoding="utf-8") as fh:
                lines = [json.loads(line) for line in fh]
            for meta, data in zip(lines[::2], lines[1::2], strict=True):
                r = rows[meta["warc_trec_id"]]
                assert meta == {"_op_type": "index", "_index": "m", "_id": r._id, "uuid": r.m_uuid, "source_file": r.m_source_file,
                                "source_offset": str(r.m_source_offset), "content_length": str(r.m_content_length),
                                "content_type": r.m_content_type, "warc_trec_id": r.m_warc_trec_id}
                assert (data["_index"], data["_id"], data["title_lang_en"], data["body_lang_en"]) == ("x", r._id, r.d_title, r.d_body)
                assert "title" not in data and None not in data.values()
                seen += 1
    assert seen == len(rows) == 20


def test_default_text_per_corpus(spark):
    docs = spark.createDataFrame([("1", "T", "H", "B", "plain", "http://a/b")], "doc_id string, title string, headings string, body string, text string, url string")
    off = spark.createDataFrame([("1", 0, 5)], "doc_id string, start long, end long")
    for name, want in (("msmarco-document", "T B"), ("msmarco-document-v2", "T H B"), ("cranfield", "plain")):
        m = mappings.dataset_mapping(name)
        assert m.records(docs, "b", offsets=off).first().d_body == want
        assert m.records(docs, "b", offsets=off, text_fields=("headings",)).first().d_body == "H"
        assert m.records(docs.drop("body"), "b", offsets=off).first().d_body == "plain"


def test_first_row_wins_needs_an_order(spark):
    from corpusforge.plans import mappings
    docs = spark.createDataFrame([("a", "t", "x")], "doc_id string, text string, title string")
    with pytest.raises(ValueError, match="order_col"):
        mappings.dataset_mapping("trec-tot/2024").records(docs, "b", offsets=docs)


def test_null_language_keeps_plain_names(spark):
    from corpusforge.plans import records
    table = spark.createDataFrame([("t", None)], "title string, lang string")
    for name, kind in records.DATA_FIELDS:
        if name not in table.columns:
            table = table.withColumn(name, F.lit(None).cast(kind))
    assert json.loads(table.select(records.wide_json(table)).first()[0])["title"] == "t"
