"""BM25 top-k over document blocks with MaxScore pruning (K5, K9).

1. **Vocabulary.** The distinct words of the corpus are counted and analysed
   once each, and only those whose term some query asks for are kept. The
   collection statistics of a field come from the same counts.
2. **Blocks.** The documents are cut into words a second time; words that
   matter become term numbers where they are, and each task turns its
   documents into posting lists of blocks of a bounded number of documents.
   A posting never leaves its block, and no (term, document) or (query,
   document) row is shuffled: what moves is one row for each list.
3. **Scores.** Lists meet the weights of the queries that ask for their term,
   and a block scores its own documents: the lists of a query are added in
   the order of their greatest possible share; once what the rest could add
   is below the k-th score so far, no further document can come in, and the
   rest is only looked up for those that still can (MaxScore). A block
   returns k documents a query; these are ranked in the end.

Queries are worked on in batches (``BATCH_QUERIES``), and a batch whose words
exceed ``MAX_WORDS`` joins them by a shuffle in place of a broadcast, so all
sizes beside the corpus are bounded by parameters.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import analyze
from corpusforge.operators.search import K1, B, analysed_lang
from corpusforge.session import cut

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Distinct words that a batch of queries may broadcast; queries of a batch.
MAX_WORDS, BATCH_QUERIES = 1 << 20, 2048
#: A block ends at so many documents, or so many occurrences of words that matter.
BLOCK_DOCS, BLOCK_TOKENS = 1 << 14, 1 << 22
POOLED = "all"


def word_rows(docs: DataFrame, doc_col: str, text_col: str, lang: Column) -> DataFrame:
    """(doc_id, lang, dl, word): a row for each word occurrence of each text."""
    ws = docs.select(F.col(doc_col).alias("doc_id"), lang.alias("lang"), analyze.words(F.col(text_col)).alias("ws"))
    ws = ws.withColumn("dl", F.size("ws").cast("bigint"))
    # Not explode: Catalyst would then filter by the array's size first, and tokenise a second time for it.
    return ws.select("doc_id", "lang", "dl", F.explode_outer("ws").alias("word")).where("word is not null")


def vocabulary(words: DataFrame, languages) -> DataFrame:
    """(lang, word, n, term): each distinct word of a language analysed once, by the language's own chain.

    A partial count, so a frequent word costs a row a task.
    """
    counted = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("term", analyze.term_for_language(F.col("word"), F.col("lang"), languages))


def _collect_blocks(block_docs: int, block_tokens: int, id_type: pa.DataType):
    """Rows (doc_id, dl, tid) of a task to posting lists, a row each, and a row of documents for each block."""
    schema = pa.schema([("block", pa.int64()), ("tid", pa.int64()), ("df", pa.int64()), ("docs", pa.binary()), ("tfs", pa.binary()),
                        ("ids", pa.list_(id_type)), ("lengths", pa.list_(pa.int64()))])

    def lists(block: int, known: dict, parts: list):
        doc, tid = (np.concatenate(x) for x in zip(*parts))
        terms, code = np.unique(tid, return_inverse=True)
        pair, tf = np.unique(code.astype(np.int64) * len(known) + doc, return_counts=True)
        of, doc = pair // len(known), (pair % len(known)).astype(np.int32)
        edge = np.searchsorted(of, np.arange(len(terms) + 1)).tolist()
        tf = tf.astype(np.int32)
        for at in range(0, len(terms), 4096):
            n = min(4096, len(terms) - at)
            cuts = list(zip(edge[at:at + n], edge[at + 1:at + n + 1]))
            yield pa.record_batch([pa.array([block] * n, pa.int64()), pa.array(terms[at:at + n]), pa.array([b - a for a, b in cuts], pa.int64()),
                                   pa.array([doc[a:b].tobytes() for a, b in cuts], pa.binary()),
                                   pa.array([tf[a:b].tobytes() for a, b in cuts], pa.binary()),
                                   pa.nulls(n, schema.field("ids").type), pa.nulls(n, schema.field("lengths").type)], schema=schema)
        keys = list(known)
        yield pa.record_batch([pa.array([block], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                               pa.nulls(1, pa.binary()), pa.array([[k[0] for k in keys]], schema.field("ids").type),
                               pa.array([[k[1] for k in keys]], schema.field("lengths").type)], schema=schema)

    def run(batches):
        known: dict[tuple, int] = {}
        parts, held, made, task = [], 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            ids, length, tid = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            if not len(tid):
                continue
            coded = ids.dictionary_encode()
            local = coded.indices.to_numpy().astype(np.int64) * (int(length.max()) + 1) + length
            distinct, first, which = np.unique(local, return_index=True, return_inverse=True)
            names = [(ids[int(i)].as_py(), int(length[i])) for i in first]
            if len(known) + sum(name not in known for name in names) > block_docs and known or held > block_tokens:
                yield from lists(task << 32 | made, known, parts)
                known, parts, held, made = {}, [], 0, made + 1
            number = np.array([known.setdefault(name, len(known)) for name in names], dtype=np.int64)
            parts.append((number[which], tid))
            held += len(tid)
        if parts:
            yield from lists(task << 32 | made, known, parts)
    return run


def top_of_block(lists: list[tuple[float, np.ndarray, np.ndarray]], n_docs: int, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the k best, and their scores, by MaxScore.

    A list is (greatest share, ascending documents, their shares). Documents
    within ``slack`` of the k-th score are kept too.
    """
    lists = sorted(lists, key=lambda x: -x[0])
    rest = np.r_[np.cumsum([x[0] for x in lists][::-1])[::-1], 0.0]  # what the lists from here on can add
    score = np.zeros(n_docs)
    floor, at = 0.0, 0
    while at < len(lists) and (floor <= 0 or rest[at] >= floor - slack):
        for _, docs, share in lists[at:at + 4]:
            score[docs] += share
        at += 4
        if n_docs > k and at < len(lists):
            floor = float(np.partition(score, n_docs - k)[n_docs - k])
    at = min(at, len(lists))
    here = np.flatnonzero(score + rest[at] >= floor - slack) if floor > 0 else np.flatnonzero(score > 0)
    found = score[here]
    for _, docs, share in lists[at:]:
        place = np.minimum(np.searchsorted(docs, here), len(docs) - 1)
        found += np.where(docs[place] == here, share[place], 0.0)
    keep = found > 0
    if keep.sum() > k:
        keep &= found >= np.partition(found, len(found) - k)[len(found) - k] - slack
    return here[keep], found[keep]


def _score_blocks(k: int, k1: float, b: float, precision: int, q_type: pa.DataType, id_type: pa.DataType):
    def run(rows: pa.Table) -> pa.Table:
        docs = rows.filter(pc.is_valid(rows.column("ids"))).slice(0, 1).to_pylist()[0]
        ids, length = docs["ids"], np.array(docs["lengths"], dtype=np.float64)
        # A list's shares are kept once, in no more than its own length, and weighed for one query at a time.
        asked: dict = {}
        lists = rows.filter(pc.is_valid(rows.column("qids"))).select(["docs", "tfs", "avgdl", "qids", "weights"])
        for batch in lists.to_batches(max_chunksize=64):
            for r in batch.to_pylist():
                at, tf = np.frombuffer(r["docs"], dtype=np.int32), np.frombuffer(r["tfs"], dtype=np.int32).astype(np.float64)
                share = tf / (tf + k1 * (1 - b + b * length[at] / r["avgdl"]))
                most = float(share.max())
                for q, w in zip(r["qids"], r["weights"]):
                    asked.setdefault(q, []).append((w, most, at, share))
        found = []
        for q, weighed in asked.items():
            at, score = top_of_block([(w * most, at, w * share) for w, most, at, share in weighed], len(ids), k, 2 * 10.0 ** -precision)
            ranked = sorted(zip((-np.round(score, precision)).tolist(), [ids[i] for i in at.tolist()], score.tolist()))
            found += [(q, d, s) for _, d, s in ranked[:k]]
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, t) for c, t in zip(cols, (q_type, id_type, pa.float64()))], names=["qid", "doc_id", "score"])
    return run


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}


def bm25_topk(docs: DataFrame, queries: DataFrame, k: int = 10, doc_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None,
              languages=("en", "fr", "de", "es"), pooled: bool = False, k1: float = K1, b: float = B, precision: int = 6,
              batch_queries: int = BATCH_QUERIES, max_words: int = MAX_WORDS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Top-``k`` documents per query by BM25 (K9): qid, doc_id, score, rank.

    ``queries``: ``(qid, lang, tokens)``, analysed for each field (see
    ``search.query_terms``). A text is analysed by its language, and each
    language is a field of its own: terms meet only within it, and N, the
    average length and document frequencies are the field's; the ranking is
    over all documents. ``pooled`` makes all languages one field (``lang`` of
    the queries is then ``POOLED``). Scores are rounded to ``precision``
    decimals before ranking; ties go to the smaller document; a term repeated
    in a query counts once per occurrence. Ids are long, int or string.
    """
    lang = analysed_lang(F.col(lang_col), languages) if lang_col else F.lit("default")
    words = word_rows(docs, doc_col, text_col, lang)
    field = F.lit(POOLED) if pooled else F.col("lang")
    vocab = cut(vocabulary(words, languages).withColumn("field", field))
    n_docs = docs.select(lang.alias("lang")).select(field.alias("field")).groupBy("field").agg(F.count("*").alias("n_docs"))
    stats = vocab.groupBy("field").agg(F.sum("n").alias("n_words")).join(n_docs, "field").select(
        "field", "n_docs", (F.col("n_words") / F.col("n_docs")).alias("avgdl"))
    terms = queries.select("qid", F.col("lang").alias("field"), F.explode("tokens").alias("term")).groupBy("qid", "field", "term").agg(F.count("*").alias("qtf"))
    batches = max(1, -(-queries.select("qid").distinct().count() // batch_queries))
    out = None
    for i in range(batches):
        part = terms if batches == 1 else terms.where(F.pmod(F.xxhash64("qid"), F.lit(batches)) == i)
        tops = _batch(docs, words, vocab, stats, part, doc_col, k, k1, b, precision, max_words, block_docs)
        out = tops if out is None else out.unionByName(tops)
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "doc_id")
    return (out.withColumn("score", F.round("score", precision)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


def _batch(docs, words, vocab, stats, terms, doc_col, k, k1, b, precision, max_words, block_docs) -> DataFrame:
    """(qid, doc_id, score): the k best of every block for each query of a batch."""
    q_kind, d_kind = terms.schema["qid"].dataType.simpleString(), docs.schema[doc_col].dataType.simpleString()
    numbered = cut(terms.select("field", "term").distinct().withColumn("tid", F.monotonically_increasing_id()))
    matter = cut(vocab.join(numbered, ["field", "term"]).select("lang", "word", "tid"))
    small = matter.count() <= max_words
    matched = words.join(F.broadcast(matter) if small else matter, ["lang", "word"]).select("doc_id", "dl", "tid")
    if not small:  # a shuffle join deals words: documents are put together again
        matched = matched.repartition("doc_id")
    schema = f"block long, tid long, df long, docs binary, tfs binary, ids array<{d_kind}>, lengths array<long>"
    lists = cut(matched.mapInArrow(_collect_blocks(block_docs, BLOCK_TOKENS, _ARROW[d_kind]), schema))
    dfs = lists.where("tid is not null").groupBy("tid").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = terms.join(numbered, ["field", "term"]).join(dfs, "tid").join(stats, "field").select("tid", "qid", "avgdl", (F.col("qtf") * idf).alias("w"))
    # At most one entry for each query of the batch.
    weights = weights.groupBy("tid").agg(F.first("avgdl").alias("avgdl"), F.collect_list(F.struct("qid", "w")).alias("asks"))
    weights = weights.select("tid", "avgdl", F.col("asks.qid").alias("qids"), F.col("asks.w").alias("weights"))
    met = lists.where("tid is not null").join(weights, "tid").select("block", "docs", "tfs", "ids", "lengths", "avgdl", "qids", "weights")
    tables = lists.where("tid is null").select("block", "docs", "tfs", "ids", "lengths", F.lit(None).cast("double").alias("avgdl"),
                                               F.lit(None).cast(f"array<{q_kind}>").alias("qids"), F.lit(None).cast("array<double>").alias("weights"))
    return met.unionByName(tables).groupBy("block").applyInArrow(
        _score_blocks(k, k1, b, precision, _ARROW[q_kind], _ARROW[d_kind]), f"qid {q_kind}, doc_id {d_kind}, score double")
