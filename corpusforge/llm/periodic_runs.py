"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words with smallest period q (words q
apart are identical) that holds at least ``repeats`` periods and ``shortest``
words and that no neighbouring word extends keeping the period.

Every word of such a run occurs ``repeats`` times in it at least. So a word
that occurs more rarely within its segment (at first the whole text) cannot
be in a run and splits the segment, and so does what is too short; the parts
are counted anew, until no part changes. Most texts are gone by then. The
segments that survive are scanned lag by lag: small lags over all words,
larger ones over words a lag apart, as a run of period q holds three
neighbouring multiples of q whose words equal those q further on; from there
the stretch is followed to both ends. This is near n log n in the length of a
segment. The result is exact: splitting only ever removes words that no run
can hold, and every stretch is compared word by word. (Splitting ends after
``ROUNDS`` rounds at the latest, which texts built for it can reach; what is
left is then scanned as it is, so this bounds time and changes no result.)

A text is worked on as one value by one task, in memory proportional to it.

Defined cases: null and empty texts, and those without words, have no runs
and an empty collapsed text; a text of any length is scanned whole; rows of
one id are worked on one by one and each gets a row; a null id is kept; an
empty table gives an empty result. Only the id and the text are read, so
other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST, REPEATS = 6, 4
#: Lags up to this are scanned over all words; rounds of splitting.
DENSE_LAGS, ROUNDS = 16, 64

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def word_numbers(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    number: dict[bytes, int] = {}
    return np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)


def segments(ids: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """[start, end) of the stretches in which every word occurs ``repeats`` times at least."""
    place = np.arange(len(ids))
    segment = np.zeros(len(ids), dtype=np.int64)
    for _ in range(rounds):
        if not len(place):
            break
        pair = segment * (int(ids.max()) + 1) + ids
        _, which, count = np.unique(pair, return_inverse=True, return_counts=True)
        keep = count[which] >= repeats
        kept = place[keep]
        # A new segment starts where a word went or an old segment ended.
        fresh = np.r_[True, (np.diff(kept) > 1) | (np.diff(segment[keep]) > 0)][:len(kept)]
        name = np.cumsum(fresh) - 1
        size = np.bincount(name, minlength=1)
        long = size[name] >= shortest if len(name) else np.zeros(0, dtype=bool)
        if len(kept) == len(place) and long.all():
            break
        place, ids, segment = kept[long], ids[keep][long], name[long]
    if not len(place):
        return []
    cuts = np.flatnonzero(np.r_[True, np.diff(segment) > 0, True])
    return [(int(place[a]), int(place[b - 1]) + 1) for a, b in zip(cuts[:-1], cuts[1:])]


def _agree(w: np.ndarray, at: int, lag: int, step: int) -> int:
    """How many words from ``at`` on (``step`` 1) or before it (-1) equal those ``lag`` further on."""
    done, width = 0, 16
    most = len(w) - lag - at if step > 0 else at
    while done < most:
        n = min(width, most - done)
        lo = at + done if step > 0 else at - done - n
        differ = w[lo:lo + n] != w[lo + lag:lo + lag + n]
        if differ.any():
            return done + int(np.argmax(differ if step > 0 else differ[::-1]))
        done, width = done + n, width * 4
    return done


def scan(w: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a segment, by ascending lag."""
    n = len(w)
    found: dict[tuple[int, int], int] = {}
    # The longest run that covers a word, of those whose multiples of the period are lags too, and its length.
    inside, reach = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
    runs: list[tuple[int, int, int]] = []

    def take(start: int, end: int, lag: int) -> None:
        if (start, end) in found or end - start < max(shortest, repeats * lag):
            return  # a multiple of a smaller period covers the same stretch
        found[start, end] = lag
        runs.append((start, end - start, lag))
        if end - start >= 2 * repeats * lag:
            more = reach[start:end] < end - start
            inside[start:end][more] = len(runs) - 1
            reach[start:end][more] = end - start

    for lag in range(1, n // repeats + 1):
        if lag <= DENSE_LAGS:
            same = np.r_[False, w[:-lag] == w[lag:], False]
            edge = np.flatnonzero(same[1:] != same[:-1])
            size = edge[1::2] - edge[::2]
            for k in np.flatnonzero(size + lag >= max(shortest, repeats * lag)).tolist():
                take(int(edge[2 * k]), int(edge[2 * k + 1]) + lag, lag)
            continue
        anchors = w[::lag]
        same = anchors[1:] == anchors[:-1]
        chain = np.flatnonzero(np.logical_and.reduce([same[k:len(same) - repeats + 2 + k] for k in range(repeats - 1)])) if len(same) >= repeats - 1 else ()
        k = 0
        while k < len(chain):
            at = int(chain[k]) * lag
            known = int(inside[at])
            start, length, period = runs[known] if known >= 0 else (0, 0, 1)
            if lag % period == 0 and at + lag < start + length and length >= lag + period:
                behind = start + length - lag  # the stretch of this lag is that run's
            else:
                right = _agree(w, at, lag, 1)
                if right >= lag:
                    take(at - _agree(w, at, lag, -1), at + right + lag, lag)
                behind = at + max(right, 1)
            k = int(np.searchsorted(chain, -(-behind // lag)))
    return runs


def runs_of(ids: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> list[tuple[int, int, int]]:
    """All runs of a text's words, by start, then period."""
    out = [(a + s, n, q) for a, b in segments(ids, shortest, repeats) for s, n, q in scan(ids[a:b], shortest, repeats)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Whether each word stays: those of a run's first period do, unless another run drops them."""
    drop = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return np.cumsum(drop)[:n] == 0


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, repeats: int = REPEATS,
              rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row of ``docs``: id, n_words, runs (by start, then period) and the collapsed text.

    ``repeats`` is at least 3. ``rewrite`` may change a row's words before the search.
    """
    if repeats < 3 or shortest < repeats:
        raise ValueError("repeats must be 3 or more, and shortest not below it")

    def run(batches):
        for batch in batches:
            counts, found, collapsed = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = (text.as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(key, words)
                runs = runs_of(word_numbers(words), shortest, repeats) if len(words) >= shortest else []
                if runs:
                    stay = kept_words(len(words), runs)
                    words, n = [w for w, s in zip(words, stay.tolist()) if s], len(words)
                else:
                    n = len(words)
                counts.append(n)
                found.append([{"start": s, "length": m, "period": q} for s, m, q in runs])
                collapsed.append(b" ".join(words))
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(found, pa.list_(RUN)),
                                   pa.array(collapsed, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    out = rows.mapInArrow(run, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return out.withColumnRenamed("id", id_col)


def planted(key: object, words: list[bytes]) -> list[bytes]:
    """The words with a periodic tail for one id in ten, by the contract's rule; a null id keeps its words."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + [unit[i % p] for i in range(n - a)]


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns of ``find_runs``: how many runs, the longest one, and hashes of runs and collapsed text."""
    # The greatest length wins, then the smallest start, then the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    x = found.withColumn("__best", best)
    length, period = F.col("__best.length"), -F.col("__best.p")
    return x.select(id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("__best.s")).alias("start"), length.alias("length"), period.alias("period"),
                    F.expr("(1000 * __best.length) div (-__best.p)").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words")
