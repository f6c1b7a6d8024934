"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

Voters are words (lexicon) and word beginnings (patterns; some ask for several
distinct words of one beginning). Candidates are
mined from a bounded sample of the labelled training rows by the likelihood
ratio of their document counts; one document of each group of near copies
counts, so a much-copied document does not make voters of its rare words. A
voter that finds its word in a text votes toxic, else it abstains; one more
voter votes clean where all others abstain.

The generative label model sees votes only. Expectation-maximisation
estimates how often each voter fires in either class; correlations of voters
among toxic rows, left over by that, lower what voters that fire together add
(a word and its beginning, say, count as one). The
posterior labels train a logistic regression on the voters' counts, which
then scores every whole text.

Learning never sees ids, languages, sources or held-out rows. The sample
(``max_train`` rows) and the voters (``max_voters``) are bounded, so what the
driver holds is too; scoring runs over all documents in Arrow batches with
nothing shuffled.

Defined cases: null and empty texts score as texts without any voter; rows of
one id are scored one by one; a null id is never held out nor trained on;
labels that disagree for an id count as toxic; without labelled rows every
score is 0; an empty table gives an empty result. Of the documents only id
and text are read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

MAX_TRAIN, MAX_VOTERS = 20_000, 512
#: A candidate's likelihood ratio at least: by documents alone, or by documents and, as a
#: toxic stem takes many endings in one text, by distinct words.
MIN_RATIO, MIN_RATIO_WITH_WORDS, MIN_WORD_RATIO = 20.0, 10.0, 40.0
MIN_PRECISION, MIN_DOCS = 0.95, 3
PREFIXES = (4, 5, 6, 7, 8)
#: A pattern also votes by finding so many distinct words at least.
TIMES = (2, 3, 4)
THRESHOLD = 0.7
WORD = re.compile(r"[^\W\d_]+")
#: Words whose voters a task remembers at most; the table starts anew when full.
TABLE_WORDS = 1 << 18


def held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(word: str) -> list[str]:
    """A word as a lexicon entry, and its beginnings as patterns."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def distinct_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def found_in(text: str | None) -> dict[str, int]:
    """All features of a text with their numbers of distinct words; ``stem*3`` says three or more."""
    found = Counter(f for w in distinct_words(text) for f in features(w))
    return found | {f"{f}{t}": n for f, n in found.items() if n > 1 for t in TIMES if t <= n}


def _sketch(text: str | None) -> str:
    """Alike for near copies: the four smallest hashes of a text's words."""
    return "-".join(f"{h:x}" for h in sorted(xxhash.xxh64_intdigest(w) for w in distinct_words(text))[:4])


def _sketches(batches):
    for b in batches:
        yield pa.record_batch([*b.columns, pa.array([_sketch(t) for t in b.column(1).to_pylist()], pa.string())], names=["toxic", "text", "sketch"])


def _feature_rows(batches):
    for b in batches:
        for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            found = found_in(text)
            yield pa.record_batch([pa.array([toxic] * len(found), pa.int32()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int32())],
                                  names=["toxic", "feature", "words"])


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_train: int) -> DataFrame:
    """(toxic, text) of at most ``max_train`` training rows, one of each group of near copies."""
    label = labels.select(F.col(id_col).alias("l"), F.col("toxic").cast("int").alias("toxic")).where("l is not null and toxic is not null")
    ids = label.where(~held_out(F.col("l"))).groupBy("l").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("l"), "l").limit(max_train)
    rows = docs.join(F.broadcast(ids), docs[id_col] == F.col("l")).select("toxic", F.col(text_col).cast("string").alias("text"))
    sketched = rows.mapInArrow(_sketches, "toxic int, text string, sketch string")
    return cut(sketched.groupBy("sketch").agg(F.max(F.struct("toxic", "text")).alias("r")).select("r.toxic", "r.text"))


def mine_voters(rows: DataFrame, max_voters: int) -> tuple[list[str], float]:
    """The features that tell toxic rows best, and the share of toxic rows."""
    total, toxic = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic or toxic == total:
        return [], float(bool(toxic))
    base = toxic / total
    counts = rows.mapInArrow(_feature_rows, "toxic int, feature string, words int").groupBy("feature").agg(
        F.count("*").cast("double").alias("n"), F.sum("toxic").cast("double").alias("k"),
        F.sum("words").cast("double").alias("wn"), F.sum(F.col("words") * F.col("toxic")).cast("double").alias("wk"))

    def ratio(n: Column, k: Column) -> Column:
        def term(seen: Column, expected: Column) -> Column:
            return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)
        return term(k, n * base) + term(n - k, n * (1 - base))
    n, k = F.col("n"), F.col("k")
    counts = counts.where((n >= MIN_DOCS) & (k / n >= MIN_PRECISION)).withColumn("ratio", ratio(n, k)).withColumn("word_ratio", ratio(F.col("wn"), F.col("wk")))
    best = counts.where((F.col("ratio") >= MIN_RATIO) | ((F.col("ratio") >= MIN_RATIO_WITH_WORDS) & (F.col("word_ratio") >= MIN_WORD_RATIO)))
    return [r.feature for r in best.orderBy(F.desc("ratio"), "feature").limit(max_voters).collect()], base


class Voters:
    """The voters that fire in a text, with their numbers of distinct words."""

    def __init__(self, names: list[str]):
        self.place = {f: i for i, f in enumerate(names)}
        self.stems = {f.rstrip("0123456789") for f in names}
        self.table: dict[str, tuple[str, ...]] = {}

    def __call__(self, text: str | None) -> dict[int, int]:
        table, found = self.table, {}
        if len(table) > TABLE_WORDS:
            table.clear()
        for w in distinct_words(text):
            fired = table.get(w)
            if fired is None:
                fired = table[w] = tuple(f for f in features(w) if f in self.stems)
            for f in fired:
                found[f] = found.get(f, 0) + 1
        names = found | {f"{f}{t}": n for f, n in found.items() if n > 1 for t in TIMES if t <= n}
        return {self.place[f]: n for f, n in names.items() if f in self.place}


def label_model(votes: np.ndarray, base: float, rounds: int = 30) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior P(toxic) of rows of votes (1: toxic, 0: abstains).

    ``base`` is the share of toxic rows. Returns the posteriors and the
    voters' firing rates by class, their correlations and the rates of silence.
    """
    any_vote = votes.any(axis=1)
    post = np.where(any_vote, 0.95, 0.02)
    together = np.zeros((votes.shape[1],) * 2)
    for step in range(rounds):
        up, down = post.sum(), (1 - post).sum()
        fire1 = (post @ votes + 0.5 * base) / (up + 1)
        fire0 = ((1 - post) @ votes + 0.5 * (1 - base) * 0.1) / (down + 1)
        if step in (0, 5, 15):  # correlations among toxic rows, left over by the model
            left = (votes - fire1) * np.sqrt(post)[:, None]
            cov = left.T @ left
            spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
            together = np.clip(cov / spread[:, None] / spread[None, :], 0, 1)
            np.fill_diagonal(together, 0)
        silent1, silent0 = (post @ ~any_vote + 0.5) / (up + 1), ((1 - post) @ ~any_vote + 0.5) / (down + 1)
        # Of voters that fire together each counts by as much as the others do not tell already.
        evidence = (votes * np.log(fire1 / fire0) / (1 + votes @ together)).sum(axis=1)
        odds = np.log(base / (1 - base)) + evidence + np.where(any_vote, 0.0, np.log(silent1 / silent0))
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post, {"fire1": fire1, "fire0": fire0, "together": together, "silent": np.array([silent1, silent0])}


def logistic(x: np.ndarray, target: np.ndarray, penalty: float = 0.1, rounds: int = 25) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression on soft labels, by Newton steps."""
    wide = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag(np.r_[np.full(x.shape[1], penalty), 1e-6])
    w = np.zeros(wide.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(wide @ w, -30, 30)))
        slope = wide.T @ (p - target) + ridge @ w
        bend = (wide * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ wide + ridge
        move = np.linalg.solve(bend, slope)
        w -= move * min(1.0, 5 / max(np.abs(move).max(), 1e-12))
        if np.abs(move).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


@dataclass
class Model:
    voters: list[str]
    weights: np.ndarray
    intercept: float
    label_model: dict[str, np.ndarray]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_train: int = MAX_TRAIN,
        max_voters: int = MAX_VOTERS) -> Model:
    rows = training_rows(docs, labels, id_col, text_col, max_train)
    names, base = mine_voters(rows, max_voters)
    if not names:
        return Model([], np.zeros(0), float(np.log(max(base, 1e-9) / max(1 - base, 1e-9))) if base else -30.0, {})

    def votes(batches):
        voters = Voters(names)
        for b in batches:
            found = [voters(t) for t in b.column(0).to_pylist()]
            yield pa.record_batch([pa.array([list(f) for f in found], pa.list_(pa.int32())), pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))], names=["voter", "times"])
    found = rows.select("text").mapInArrow(votes, "voter array<int>, times array<int>").collect()  # at most max_train rows
    times = np.zeros((len(found), len(names)))
    for i, r in enumerate(found):
        times[i, r.voter] = r.times
    post, learnt = label_model((times > 0).astype(float), base)
    weights, intercept = logistic(np.log1p(times), np.clip(post, 1e-4, 1 - 1e-4))
    return Model(names, weights, intercept, learnt)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: id, held_out, score, predicted (1 from ``threshold`` on)."""
    names, weights, intercept = model.voters, model.weights.tolist(), model.intercept

    def run(batches):
        voters = Voters(names)
        for b in batches:
            odds = np.array([intercept + sum(weights[i] * np.log1p(n) for i, n in voters(t).items()) for t in b.column(1).to_pylist()], dtype=np.float64)
            yield pa.record_batch([b.column(0), pa.array(1 / (1 + np.exp(-np.clip(odds, -50, 50))), pa.float64())], names=["id", "score"])
    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
