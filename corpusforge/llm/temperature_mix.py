"""Mixing sources to target weights by temperature.

Source token shares p are raised to an exponent and normalised; the exponent
(0: all sources alike, 1: as they are) is bisected until the mixture meets a
target entropy, then raised, if need be, until no source is repeated more
than ``max_repeats`` times. The weights are realised as block permutations:
each source is dealt in epochs, each epoch in an order of its own by hash,
the last one up to the source's budget; and blocks of ``block_tokens`` tokens
take from each source its weight's worth of consecutive documents, mixed by
hash inside the block.

Without a token budget the mixture is as long as needed for every source to
be dealt whole at least once, so no document is lost; with one, sources over
their share end early. A document that begins within the budget is dealt.

A source may hold any share of the rows: positions come from sums over slices
of the hash order (``running_start``), never from one task per source. The
table of sources (at most ``max_sources`` rows, an error beyond) is all that
reaches the driver, and all that is broadcast.

Tokens are white-space words of the text, unless a column of lengths is given
(``tokens_col``, from ``token_counts`` say): a text without spaces is one word
however long it is.

Defined cases: null sources are a source; null and empty texts have no tokens
and no weight, and are dealt with their neighbours (a source of no tokens:
once); a very long text is dealt whole, in a block that it may overfill; rows
alike in id and text are dealt together; an empty table gives an empty result.
The operator reads only id, text, source and lengths, so other columns may have
any name (``apply`` keeps them; names beginning with ``__m_`` are its own).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, lengths_of, order_hash, running_start

MAX_REPEATS = 2.0
ENTROPY_SHARE = 0.95
BLOCK_TOKENS = 1 << 18
MAX_SOURCES = 100_000
SEED = 17


def weights_at(tokens: list[int], exponent: float) -> list[float]:
    """Normalised shares to the power of ``exponent``; sources of no tokens weigh nothing."""
    total = sum(tokens)
    raw = [(t / total) ** exponent if t else 0.0 for t in tokens]
    return [r / math.fsum(raw) for r in raw] if total else [0.0 for _ in tokens]


def entropy(weights: list[float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights if w)


def repeats(tokens: list[int], weights: list[float]) -> float:
    """How often the most repeated source is dealt while the least repeated one is dealt once."""
    rates = [w / t for t, w in zip(tokens, weights) if t]
    return max(rates) / min(rates) if rates else 1.0


def _bisect(right) -> float:
    """The smallest exponent in [0, 1] at which ``right`` holds, if it holds from there on."""
    lo, hi = 0.0, 1.0
    if right(lo):
        return lo
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if right(mid) else (mid, hi)
    return hi


def exponent_for(tokens: list[int], target_entropy: float | None, max_repeats: float | None) -> float:
    """The exponent whose mixture has the target entropy (or the nearest within
    [0, 1]); raised to the smallest that keeps to ``max_repeats``."""
    at = 1.0 if target_entropy is None and max_repeats is None else 0.0
    if target_entropy is not None:
        at = _bisect(lambda a: entropy(weights_at(tokens, a)) <= target_entropy)
    if max_repeats is not None:
        at = max(at, _bisect(lambda a: repeats(tokens, weights_at(tokens, a)) <= max_repeats))
    return at


@dataclass
class Mixture:
    exponent: float
    #: source, weight, tokens, budget, whole epochs, tokens of the part of an epoch that follows
    sources: list[tuple]
    #: id, source, n_tokens, key, epoch, order, start, block: a row for each time a document is dealt
    dealt: DataFrame


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        entropy_share: float | None = ENTROPY_SHARE, max_repeats: float | None = MAX_REPEATS,
        budget_tokens: int | None = None, block_tokens: int = BLOCK_TOKENS, max_sources: int = MAX_SOURCES, seed: int = SEED, tokens_col: str | None = None) -> Mixture:
    """``entropy_share``: the target entropy as a part of the largest possible, log of the number of sources."""
    rows = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), lengths_of(text_col, tokens_col).alias("n_tokens"),
                           F.xxhash64(id_col, text_col).alias("key")))
    found = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).orderBy(F.col("source").asc_nulls_first()).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"over {max_sources} sources")
    tokens = [r.tokens for r in found]
    some = sum(1 for t in tokens if t)
    target = None if entropy_share is None else entropy_share * math.log(max(some, 1))
    exponent = exponent_for(tokens, target, max_repeats) if some else 1.0
    weights = weights_at(tokens, exponent)
    length = budget_tokens if budget_tokens is not None else max([t / w for t, w in zip(tokens, weights) if t], default=0.0)
    plan = []
    for r, w in zip(found, weights):
        budget = round(w * length)
        epochs, rest = divmod(budget, r.tokens) if r.tokens else (1, 0)
        plan.append((r.source, w, r.tokens, budget, epochs, rest))
    kind = docs.schema[source_col].dataType.simpleString()
    table = docs.sparkSession.createDataFrame(plan, f"p_source {kind}, weight double, tokens long, budget long, epochs long, rest long")
    each = rows.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("p_source")))
    last = F.col("epochs") + F.when(F.col("rest") > 0, 1).otherwise(0)
    each = each.where(last > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last - 1)))
    each = each.withColumn("order", order_hash(F.lit(seed), F.col("epoch"), F.col("key")))
    placed = running_start(each, ["source", "epoch"], "order", "n_tokens", "start")
    placed = placed.where((F.col("epoch") < F.col("epochs")) | (F.col("start") < F.col("rest")))
    share = F.greatest(F.col("weight") * block_tokens, F.lit(1.0))
    block = F.floor((F.col("epoch") * F.col("tokens") + F.col("start")) / share).cast("long")
    return Mixture(exponent, plan, placed.select("id", "source", "n_tokens", "key", "epoch", "order", "start", block.alias("block")))


def sequence(docs: DataFrame, id_col: str = "doc_id", seed: int = SEED, **how) -> DataFrame:
    """Per dealt document: id, source, n_tokens, epoch, block and ``slot``; sorted
    by block, slot and id the rows are the mixture."""
    dealt = mix(docs, id_col, seed=seed, **how).dealt
    return dealt.select(F.col("id").alias(id_col), "source", "n_tokens", "epoch", "block",
                        order_hash(F.lit(seed), F.col("block"), F.col("epoch"), F.col("key")).alias("slot"))


def apply(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture deals it.

    Of a source's last, partial epoch the greatest order dealt is enough to
    tell which rows it holds, so texts are not shuffled.
    """
    mixture = mix(docs, id_col, text_col, source_col, seed=seed, **how)
    kind = docs.schema[source_col].dataType.simpleString()
    tops = mixture.dealt.groupBy("source").agg(F.max(F.struct("epoch", "order")).alias("top")).collect()  # a row for each source
    top = {(r.source, r.top.epoch): r.top.order for r in tops}
    plan = [(s, e, top.get((s, e), -1) if rest else -1) for s, _, _, _, e, rest in mixture.sources]
    table = docs.sparkSession.createDataFrame(plan, f"__m_source {kind}, __m_epochs long, __m_top long")
    joined = docs.join(F.broadcast(table), F.col(source_col).eqNullSafe(F.col("__m_source")))
    order = order_hash(F.lit(seed), F.col("__m_epochs"), F.xxhash64(id_col, text_col))
    times = (F.col("__m_epochs") + F.when(order <= F.col("__m_top"), 1).otherwise(0)).cast("int")
    again = F.array_repeat(F.lit(1), times)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode_outer(again).alias("__m_one")).where("__m_one is not null").drop("__m_one")
