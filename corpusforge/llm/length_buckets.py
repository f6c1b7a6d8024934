"""Packing into optimal length buckets.

The global histogram of document lengths decides: dynamic programming chooses
at most ``max_buckets`` bucket lengths that minimise the padding of all
documents together. Inside each bucket documents are dealt, in an order by
hash, into batches of at most ``batch_tokens`` padded tokens (one document at
least).

The histogram has one bin for each length up to 256 and 128 bins for each
doubling beyond, so it has at most a few thousand rows whatever the corpus;
it alone reaches the driver. A bin's edge is its longest document, so every
bucket is as long as its longest document; the choice counts documents by
their bin's edge, so the padded tokens exceed the least possible by less than
1/128. A bucket may hold any share of the documents:
their numbers come from counts over slices of the hash order
(``running_start``), never from one task per bucket.

Lengths are white-space words of the text, unless a column of lengths is given
(``tokens_col``, from ``token_counts`` say): a text without spaces is one word
however long it is, so a token budget that has to hold for a tokenizer needs
that tokenizer's counts.

Defined cases: null and empty texts (and null lengths) have 0 tokens and take a
place of length 1 at least; very long texts make a bucket's length and a batch
of their own; rows alike get places of their own; null ids are kept; an empty
table gives an empty result. Only the id, the text and the lengths are read, so
other columns may have any name.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lengths_of, order_hash, running_start

MAX_BUCKETS = 16
BATCH_TOKENS = 1 << 16
SEED = 23


def edge(n: Column) -> Column:
    """The upper end of a length's bin: the length itself up to 256, else rounded up to 8 leading bits."""
    low = F.greatest(n - 1, F.lit(0).cast("long"))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), F.greatest(F.length(F.bin(low)) - 8, F.lit(0)))
    return F.greatest(F.floor(low / step).cast("long") * step + step, F.lit(1).cast("long"))


def best_edges(edges: list[int], counts: list[int], most: int) -> list[int]:
    """At most ``most`` of the ascending ``edges``, the last included, that minimise the sum of
    every document's bucket length; of equals the fewest buckets."""
    n = len(edges)
    if n == 0:
        return []
    e = np.array(edges, dtype=np.float64)
    upto = np.concatenate([[0.0], np.cumsum(np.array(counts, dtype=np.float64))])
    cost = e * upto[1:]  # one bucket over bins 0..j
    froms = []
    for _ in range(1, min(most, n)):
        # a bucket over bins i+1..j behind the best for 0..i
        new, at = np.empty(n), np.zeros(n, dtype=np.int64)
        for j in range(n):
            options = np.concatenate([[e[j] * upto[j + 1]], cost[:j] + e[j] * (upto[j + 1] - upto[1:j + 1])])
            at[j] = int(options.argmin())
            new[j] = options[at[j]]
        if new[-1] >= cost[-1]:
            break
        cost = new
        froms.append(at)
    chosen, j = [n - 1], n - 1
    for at in reversed(froms):
        if at[j] == 0:
            break
        j = int(at[j]) - 1
        chosen.append(j)
    return [int(edges[i]) for i in reversed(chosen)]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_buckets: int = MAX_BUCKETS,
         batch_tokens: int = BATCH_TOKENS, seed: int = SEED, tokens_col: str | None = None) -> DataFrame:
    """Per row of ``docs``: id, n_tokens (words, or ``tokens_col``), bucket_len, batch (from 0 in each bucket) and slot (from 0 in each batch)."""
    rows = cut(docs.select(F.col(id_col).alias("id"), lengths_of(text_col, tokens_col).alias("n_tokens"),
                           order_hash(F.lit(seed), F.col(id_col), F.col(text_col)).alias("order")))
    longest = F.greatest(F.max("n_tokens"), F.lit(1).cast("long"))
    histogram = rows.groupBy(edge(F.col("n_tokens")).alias("bin")).agg(longest.alias("edge"), F.count("*").alias("n")).orderBy("bin").collect()
    lengths = best_edges([r.edge for r in histogram], [r.n for r in histogram], max_buckets)
    ends = F.array(*[F.lit(x).cast("long") for x in lengths]) if lengths else F.array(F.lit(1).cast("long"))
    bucketed = rows.withColumn("bucket_len", F.array_min(F.filter(ends, lambda x: x >= F.col("n_tokens"))))
    placed = running_start(bucketed, ["bucket_len"], "order", None, "place")
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(batch_tokens) / F.col("bucket_len")).cast("long"))
    return placed.select(F.col("id").alias(id_col), "n_tokens", "bucket_len", F.floor(F.col("place") / room).cast("long").alias("batch"),
                         (F.col("place") % room).alias("slot"))
