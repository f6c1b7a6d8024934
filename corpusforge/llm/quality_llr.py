"""Quality rules: hashed n-gram log-likelihood ratio, with deterministic thresholding.

Two multinomials over hashed word n-grams (one and two words, ``buckets``
buckets) are estimated: one from trusted documents, one from the whole raw
corpus. A document's score is the mean over its n-grams of
log p_trusted - log p_raw; it is kept if the score reaches a fixed threshold.
Both multinomials are smoothed alike: each bucket gets ``smoothing`` extra
counts in the trusted one and as large a share of the raw total in the raw
one, so buckets that are too rare to tell weigh next to nothing.
Nothing is drawn at random, and every document is judged by its whole text.

DataFrame functions only. The raw counts cover all documents and need no join.
The trusted counts cover all trusted ones: as their ids have no bound they are
not broadcast, but a bitmap of ``SIEVE_BITS`` bits of their hashes is (a scalar
subquery of that size, whatever the corpus), and only texts that pass it are
shuffled to the semi join that tells for certain. The model is one array of
``buckets`` doubles, read as a scalar subquery.

Defined cases: a null text has no words; a very long text is judged whole, as
one array of its words; a document of no words fails the
base rules and has score 0; a null id is judged like any other but is never
trusted; repeated rows are judged (and counted) one by one; an empty corpus
gives an empty result; without trusted documents every score is 0, so ``kept``
falls back to the base rules alone.
Columns beside the id and the text are ignored, whatever their names (where all
columns are kept, names beginning with ``__q_`` are this operator's own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, words

BUCKETS = 1 << 16
SMOOTHING = 10.0
THRESHOLD = -0.13
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SIEVE_BITS = 1 << 25


def _hashes(w: Column) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _pairs(h: Column) -> Column:
    """A hash of each two neighbouring words, from the words' hashes."""
    return F.transform(_rest(h, 1), lambda x, i: F.xxhash64(F.get(h, i), x))


def _rest(h: Column, start: int) -> Column:
    return F.slice(h, F.lit(start + 1), F.greatest(F.size(h) - start, F.lit(0)))


def trusted_ids(trusted: DataFrame, id_col: str) -> DataFrame:
    """The ids of ``trusted``, each once."""
    return trusted.select(F.col(id_col).alias("__t")).where("__t is not null").distinct()


def _counts(rows: DataFrame, buckets: int) -> DataFrame:
    """(b, n): one- and two-word n-grams of texts ``__text`` in each bucket."""
    d = rows.select(_hashes(words(F.col("__text"))).alias("__h"))
    # Not explode: Catalyst would then filter by the array's size below, and
    # compute the array anew there, word by word.
    grams = d.select(F.explode_outer(F.concat("__h", _pairs(F.col("__h")))).alias("__g")).where("__g is not null")
    return grams.groupBy(F.pmod("__g", F.lit(buckets)).cast("int").alias("b")).agg(F.count("*").alias("n"))


def _bit(id_: Column) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(SIEVE_BITS)) + 1


def _sieve(ids: DataFrame) -> DataFrame:
    """One row: the bitmaps of the ids' hashes in order of their numbers, null where no id is."""
    k = _bit(F.col("__t").cast("string"))
    maps = ids.groupBy(F.bitmap_bucket_number(k).alias("g")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("m"))
    last = F.lit(SIEVE_BITS).cast("long")
    every = ids.sparkSession.range(1).select(F.explode(F.sequence(F.lit(1).cast("long"), F.bitmap_bucket_number(last))).alias("g"))
    return every.join(maps, "g", "left").agg(F.sort_array(F.collect_list(F.struct("g", "m"))).alias("maps")).select(F.col("maps.m").alias("maps"))


def _may_hold(maps: Column, id_: Column) -> Column:
    """Whether an id's bit is set; false for a null id."""
    k = _bit(id_.cast("string"))
    place = F.bitmap_bit_position(k)
    byte = F.substring(F.get(maps, (F.bitmap_bucket_number(k) - 1).cast("int")), (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    # A byte has eight binary digits, the lowest bit last.
    digits = F.lpad(F.conv(F.hex(byte), 16, 2), 8, "0")
    return id_.isNotNull() & F.coalesce(F.substring(digits, (8 - place % 8).cast("int"), F.lit(1)) == "1", F.lit(False))


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> DataFrame:
    """One row ``weights``: log p_trusted - log p_raw of each bucket (null without trusted documents).

    ``trusted`` is a DataFrame with the ids of trusted documents.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    ids = trusted_ids(trusted, id_col)
    sieve = _sieve(ids)
    # The subquery is named above the condition, so Catalyst puts it in place of the column and no row carries it.
    few = rows.withColumn("__sieve", sieve.scalar()).where(_may_hold(F.col("__sieve"), F.col("__id"))).select("__id", "__text")
    # A merge join at any size: the plan, and what it moves, must not depend on how many ids there are.
    good = _counts(few.join(ids.hint("merge"), F.col("__id") == F.col("__t"), "left_semi"), buckets).withColumnRenamed("n", "good")
    counts = _counts(rows, buckets).withColumnRenamed("n", "raw").join(good, "b", "left")
    spark = docs.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("b"))
    full = every.join(counts, "b", "left").select(
        "b", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("good", F.lit(0)).alias("good"))
    model = full.agg(F.sum("raw").alias("raw_all"), F.sum("good").alias("good_all"),
                     F.sort_array(F.collect_list(F.struct("b", "raw", "good"))).alias("all"))
    share = F.col("good_all") / F.col("raw_all")
    def llr(x: Column) -> Column:
        return F.log(x["good"] + F.lit(smoothing)) - F.log(x["raw"] * share + F.lit(smoothing))
    return model.select(F.when(F.col("good_all") > 0, F.transform("all", llr)).alias("weights"))


def _window_hashes(h: Column) -> Column:
    """A 64-bit hash of each three-word window."""
    return F.transform(_rest(h, 2), lambda x, i: F.xxhash64(F.get(h, i), F.get(h, i + 1), x))


def judge(docs: DataFrame, model: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, threshold: float = THRESHOLD, min_words: int = MIN_WORDS,
          max_repeat_percent: int = MAX_REPEAT_PERCENT, keep_columns: bool = False) -> DataFrame:
    """Base counts, ``llr`` and ``kept`` of every document.

    With ``keep_columns`` all columns of ``docs`` stay and only the rows kept
    are returned (as a filter of a pipeline does), else one row per document.
    """
    text = "__q_text"
    cols = [F.col(f"`{c}`") for c in docs.columns] if keep_columns else [F.col(id_col).alias(id_col)]
    d = docs.select(*cols, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(text))
    d = d.withColumn("__q_w", words(F.col(text)))
    w = F.col("__q_w")
    d = d.withColumn("__q_n", F.size(w).cast("long")).withColumn("__q_words", _hashes(w))
    d = d.withColumn("__q_h", _window_hashes(F.col("__q_words")))
    h = F.col("__q_h")
    d = d.withColumn("__q_twice", F.size(h) > F.size(F.array_distinct(h)))
    d = d.withColumn("__q_s", F.when(F.col("__q_twice"), F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("__q_s")
    d = d.withColumn("__q_p", F.when(F.col("__q_twice"), F.sort_array(F.transform(
        F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))),
        lambda x: x["i"]))))
    p = F.col("__q_p")
    d = d.withColumn("__q_rep", F.when(F.col("__q_twice"), F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1), x + 3) - x)),
        F.lit(0), lambda a, x: a + x)).otherwise(0).cast("long"))
    def weight(gram: Column) -> Column:
        return F.coalesce(F.get("__q_weights", F.pmod(gram, F.lit(buckets)).cast("int")), F.lit(0.0))
    hw = F.col("__q_words")
    # Each word's weight and that of the pair it ends.
    both = F.transform(hw, lambda x, i: weight(x) + F.when(i > 0, weight(F.xxhash64(F.get(hw, i - 1), x))).otherwise(F.lit(0.0)))
    total = F.aggregate(both, F.lit(0.0), lambda a, x: a + x)
    grams = F.greatest(F.lit(1), 2 * F.col("__q_n") - 1)
    # Named once above this definition, so Catalyst puts the subquery itself
    # in place of the column and no row carries the array.
    d = d.withColumn("__q_weights", model.select("weights").scalar())
    d = d.withColumn("__q_llr", F.when(F.col("__q_n") > 0, total / grams).otherwise(F.lit(0.0)))
    bad = (F.col("__q_n") < min_words) | (100 * F.col("__q_rep") > max_repeat_percent * F.col("__q_n"))
    d = d.withColumn("__q_bad", bad)
    kept = ~F.col("__q_bad") & (F.col("__q_llr") >= threshold)
    if keep_columns:
        # A filter on what a generator returns stays above it; else Catalyst
        # would push the whole definition down and evaluate it twice.
        d = d.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode_outer(F.array(kept)).alias("__q_kept"))
        return d.where("__q_kept").drop("__q_kept")
    lines = F.filter(F.split(F.col(text), "\n", -1), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    d = d.withColumn("__q_lines", lines)
    found = F.struct(
        F.col("__q_n").alias("n_words"), F.length(F.translate(F.col(text), SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(F.col(text), "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long").alias("n_dup_lines"),
        F.col("__q_rep").alias("n_repeat_words"), F.col("__q_bad").alias("base_failed"), kept.alias("kept"),
        F.col("__q_llr").alias("llr"))
    # Likewise, so that callers can filter by any of these.
    return d.select(id_col, F.inline_outer(F.array(found)))
