"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are 64-bit SimHashes over word shingles; two are linked if they
differ in at most ``radius`` bits, and a document's component is named by the
smallest id reachable over links.

Equal fingerprints collapse first, so copies cost nothing further. The 64
bits are cut into ``radius + 2`` pieces: two fingerprints within the radius
agree on two pieces at least, so each fingerprint enters one block for each
pair of pieces, and no link is lost. Inside blocks distances come from bit
planes: plane b holds bit b of 64 fingerprints in one machine word, a
carry-save counter of three planes with an overflow adds up 64 differences at
a time, and a block is abandoned once all its distances exceed the radius.

A block returns a spanning forest of its links, not all pairs: breadth-first,
each fingerprint is reached once. A block over ``tile`` rows is cut into
tiles and every two tiles meet in a task of their own, so no block has to fit
into one task. Components come from rounds of large-star and small-star over
the forest's edges, each round cut by a checkpoint.

Defined cases: null and empty texts have fingerprint zero, linked like any
other; a null id has a fingerprint and links but never names a component (a
component of null ids only has a null name); rows of one id are linked by
their texts only, and each gets a row; an empty table gives an empty result.
Only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 8192
#: Tasks over which the rows of one node or component are dealt where they meet its name.
SPLIT = 8
#: Shingle hashes of a long text that are counted at a time.
PART = 1 << 16


def shingle_hashes(text: bytes | None, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of each shingle of a text, in arrays of at most PART."""
    joined = b" ".join((text or b"").lower().split())
    if not joined:
        return
    spaces = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts = np.r_[0, spaces + 1]
    ends = np.r_[spaces, len(joined)][min(size, len(starts)) - 1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), PART):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + PART].tolist(), ends[at:at + PART].tolist())], dtype=np.uint64)


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Bit b is 1 if set in over half of the shingles' hashes."""
    total, counts = 0, np.zeros(64, dtype=np.int64)
    for h in shingle_hashes(text, size):
        total += len(h)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0]) if total else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """Columns ``id``, ``th`` (a hash of id and text) and ``fp`` (64 bits as a long), a row for each of ``docs``."""
    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, size) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fp.view(np.int64), pa.int64())], names=["id", "th", "fp"])
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("th"), F.col(text_col).cast("binary").alias("t")).mapInArrow(run, f"id {kind}, th long, fp long")


# ---------------------------------------------------------------- bit planes

def planes_of(fps: np.ndarray) -> np.ndarray:
    """Vertical form of rows of 64 fingerprints: [rows, 64] words to [64, rows],
    where bit i of word [b, r] is bit b of fingerprint i of row r."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(len(fps), 64, 8), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)[:, :, 0]


def within(planes: np.ndarray, asked: np.ndarray, radius: int) -> np.ndarray:
    """Of each row of planes [64, rows], the fingerprints (a bit each) within
    ``radius`` of the row's ``asked`` [rows].

    Differences are added four planes at a time: a carry-save adder turns
    three of them into a sum and a carry, and these go into counters of the
    weights 1, 2 and 4. Rows whose distances all exceed the radius are left.
    """
    rows = planes.shape[1]
    out = np.zeros(rows, dtype=np.uint64)
    live = np.arange(rows)
    one, two, four, over = (np.zeros(rows, dtype=np.uint64) for _ in range(4))
    asked = asked.astype(np.uint64)
    for b in range(0, 63, 3):
        x, y, z = (planes[b + k, live] ^ (np.uint64(0) - (asked >> np.uint64(b + k) & np.uint64(1))) for k in range(3))
        low, high = x ^ y ^ z, (x & y) | (z & (x ^ y))
        carry = one & low
        one = one ^ low
        high, more = high ^ carry, high & carry
        carry = two & high
        two = two ^ high
        more, spill = more ^ carry, more & carry
        over = over | spill | (four & more)
        four = four ^ more
        if b % 9 == 6:
            gone = _beyond(one, two, four, over, radius)
            stay = np.flatnonzero(~gone)
            if len(stay) < 0.7 * len(live):
                live, asked, one, two, four, over = live[stay], asked[stay], one[stay], two[stay], four[stay], over[stay]
                if not len(live):
                    return out
    last = planes[63, live] ^ (np.uint64(0) - (asked >> np.uint64(63) & np.uint64(1)))
    carry, one = one & last, one ^ last
    carry, two = two & carry, two ^ carry
    over, four = over | (four & carry), four ^ carry
    out[live] = ~_exceeds(one, two, four, over, radius)
    return out


def _exceeds(one, two, four, over, radius: int) -> np.ndarray:
    """A bit for each counter over ``radius`` (at most 7)."""
    more, equal = np.zeros_like(one), ~np.zeros_like(one)
    for plane, weight in ((four, 4), (two, 2), (one, 1)):
        if radius & weight:
            equal = equal & plane
        else:
            more = more | (equal & plane)
            equal = equal & ~plane
    return over | more


def _beyond(one, two, four, over, radius: int) -> np.ndarray:
    return _exceeds(one, two, four, over, radius) == ~np.uint64(0)


def _bit_numbers(words: np.ndarray) -> np.ndarray:
    """Places of the bits set in consecutive words."""
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), bitorder="little"))


def large_forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (places) of a breadth-first spanning forest of one block."""
    n = len(fps)
    padded = np.r_[fps, np.zeros(-n % 64, dtype=np.uint64)].reshape(-1, 64)
    planes = planes_of(padded)
    todo = np.packbits(np.r_[np.ones(n, bool), np.zeros(-n % 64, bool)], bitorder="little").view(np.uint64).copy()
    edges: list[tuple[int, int]] = []
    for seed in range(n):
        if not todo[seed >> 6] >> np.uint64(seed & 63) & np.uint64(1):
            continue
        todo[seed >> 6] &= ~(np.uint64(1) << np.uint64(seed & 63))
        queue = [seed]
        while queue:
            at = queue.pop()
            rows = np.flatnonzero(todo)
            if not len(rows):
                break
            near = within(planes[:, rows], np.full(len(rows), fps[at]), radius) & todo[rows]
            if near.any():
                todo[rows] &= ~near
                found = [int(rows[k >> 6]) * 64 + int(k & 63) for k in _bit_numbers(near)]
                edges += [(at, k) for k in found]
                queue += found
    return edges


def small_links(fps: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (row, i, j) with i < j of many blocks of at most 64 fingerprints, a row each."""
    planes = planes_of(fps)
    found = []
    for lane in range(int(sizes.max()) - 1):
        rows = np.flatnonzero(sizes > lane + 1)
        near = within(planes[:, rows], fps[rows, lane], radius)
        later = ~np.uint64(0) << np.uint64(lane + 1)
        held = np.where(sizes[rows] < 64, (np.uint64(1) << (sizes[rows] % 64).astype(np.uint64)) - np.uint64(1), ~np.uint64(0))
        near &= later & held
        hit = np.flatnonzero(near)
        if len(hit):
            bit = _bit_numbers(near[hit])
            found.append((rows[hit[bit >> 6]], np.full(len(bit), lane), bit & 63))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))


def _forest_of_small(row: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which links join parts of a row that earlier ones have not joined."""
    up: dict[tuple[int, int], tuple[int, int]] = {}

    def top(x):
        while x in up:
            x = up[x]
        return x
    keep = np.zeros(len(row), dtype=bool)
    for k, (r, a, b) in enumerate(zip(row.tolist(), i.tolist(), j.tolist())):
        x, y = top((r, a)), top((r, b))
        if x != y:
            up[y] = x
            keep[k] = True
    return keep


def _edges(blocks: list[np.ndarray], radius: int) -> pa.RecordBatch:
    low, high = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    small = [b for b in blocks if len(b) <= 64]
    if small:
        sizes = np.array([len(b) for b in small])
        fps = np.zeros((len(small), 64), dtype=np.uint64)
        fps[np.arange(64)[None, :] < sizes[:, None]] = np.concatenate(small)
        row, i, j = small_links(fps, sizes, radius)
        keep = _forest_of_small(row, i, j)
        low.append(fps[row[keep], i[keep]])
        high.append(fps[row[keep], j[keep]])
    for b in blocks:
        if len(b) > 64 and (edges := large_forest(b, radius)):
            at = np.array(edges)
            low.append(b[at[:, 0]])
            high.append(b[at[:, 1]])
    return pa.record_batch([pa.array(np.concatenate(x).view(np.int64)) for x in (low, high)], names=["u", "v"])


def _block_links(radius: int):
    """Over rows sorted by block: the spanning forests' edges."""
    def run(batches):
        held, key, blocks, rows = [], None, [], 0
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "piece", "a", "b")], axis=1)
            fps = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(fps):
                continue
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(fps)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                now = tuple(keys[lo].tolist())
                if now != key:
                    if held:
                        blocks.append(np.concatenate(held))
                        rows += len(blocks[-1])
                    held, key = [], now
                    if len(blocks) >= 8192 or rows >= 1 << 17:
                        yield _edges(blocks, radius)
                        blocks, rows = [], 0
                held.append(fps[lo:hi])
        if held:
            blocks.append(np.concatenate(held))
        if blocks:
            yield _edges(blocks, radius)
    return run


def piece_masks(radius: int) -> list[int]:
    """A mask for each pair of the ``radius + 2`` pieces, as signed 64 bits."""
    bounds = [round(64 * k / (radius + 2)) for k in range(radius + 3)]
    pieces = [(1 << hi) - (1 << lo) for lo, hi in zip(bounds, bounds[1:])]
    masks = [a | b for a, b in combinations(pieces, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges ``u``, ``v`` that connect what links of at most ``radius`` bits
    connect, from distinct fingerprints ``fp``."""
    if not 0 <= radius <= 7:
        raise ValueError("radius must be from 0 to 7")
    masks = piece_masks(radius)
    keyed = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("piece")) for t, m in enumerate(masks)])).alias("k"))
    keyed = keyed.select("fp", "k.t", "k.piece")
    sizes = keyed.groupBy("t", "piece").agg(F.count("*").alias("n")).where("n > 1")
    met = keyed.join(sizes, ["t", "piece"])
    # Blocks up to the tile size stay whole; of larger ones each pair of tiles is a block.
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    other = F.when(tiles > 1, F.filter(F.sequence(F.lit(0), tiles - 1), lambda x: x != own)).otherwise(F.array(own))
    spread = met.select("t", "piece", "fp", own.alias("own"), F.explode_outer(other).alias("other"))
    spread = spread.select("t", "piece", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp")
    dealt = spread.repartition("t", "piece", "a", "b").sortWithinPartitions("t", "piece", "a", "b", "fp")
    return dealt.mapInArrow(_block_links(radius), "u long, v long").distinct()


def _split_join(rows: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with the one row that ``per_key`` has of each key, a key's rows dealt over SPLIT tasks."""
    dealt = rows.withColumn("__deal", F.pmod(F.xxhash64(*rows.columns), F.lit(SPLIT)).cast("int"))
    copies = per_key.withColumn("__deal", F.explode(F.sequence(F.lit(0), F.lit(SPLIT - 1))))
    return dealt.join(copies, [key, "__deal"]).drop("__deal")


def _star(edges: DataFrame) -> DataFrame:
    """One round of large-star, then small-star, over edges (u, v).

    A node of very many edges is reduced map-side, and its edges meet the result in SPLIT tasks.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = _split_join(both.where("v > u"), least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    small = _split_join(down, least, "u")
    return small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's smallest node) of all nodes with an edge."""
    state = cut(edges)
    seen = None
    while True:
        now = tuple(state.agg(F.count("*"), F.sum(F.hash("u", "v")), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == seen:
            break
        seen, state = now, cut(_star(state))
    stars = state.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Per row of ``docs``: id, fingerprint (16 hex digits) and component_id."""
    marked, named = _components_of(docs, id_col, text_col, size, radius, tile)
    return marked.join(named, marked["fp"] == named["f"]).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS,
             tile: int = TILE) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, that of its smallest id.

    Of several rows of that id the one of the smallest hash stays; of
    components of null ids only, one row each.
    """
    marked, named = _components_of(docs, id_col, text_col, size, radius, tile)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)], F.col(id_col).alias("d"),
                       F.xxhash64(id_col, text_col).alias("th"))
    inside = marked.join(named, marked["fp"] == named["f"])
    first = inside.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("z"), "id", "th")).alias("k")).select("k.id", F.col("k.th").alias("kh"))
    kept = rows.join(first, (F.col("th") == F.col("kh")) & F.coalesce(F.col("d") == F.col("id"), F.col("d").isNull() & F.col("id").isNull())).drop("id", "kh")
    cols = [f"c{i}" for i in range(len(docs.columns))]
    one = kept.dropDuplicates(["th", "d"])  # dealt by th already
    return one.select(*[F.col(c).alias(n) for c, n in zip(cols, docs.columns)])


def _components_of(docs: DataFrame, id_col: str, text_col: str, size: int, radius: int, tile: int) -> tuple[DataFrame, DataFrame]:
    """(id, th, fp) of every row, and the root and component_id of every fingerprint ``f``."""
    marked = cut(fingerprints(docs, id_col, text_col, size))
    nodes = marked.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(nodes.select("fp"), radius, tile))
    linked = nodes.join(roots, nodes["fp"] == roots["node"]).select("fp", "least", "root")
    names = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = _split_join(linked, names, "root").select(F.col("fp").alias("f"), "root", "component_id")
    alone = nodes.join(roots, nodes["fp"] == roots["node"], "left_anti")
    return marked, named.unionByName(alone.select(F.col("fp").alias("f"), F.col("fp").alias("root"), F.col("least").alias("component_id")))
