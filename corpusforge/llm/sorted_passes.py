"""Near duplicates of vectors by sorted projection passes.

In each pass every vector gets the signs of its projections on a pass's own
random directions, concatenated into one number, and all vectors are ordered
by it. Near vectors agree on the first signs often and then lie close
together, so each vector is compared with the ``window`` next ones of the
order, by its cosine in double precision on the original components; only
pairs of at least ``threshold`` are united. What one pass parts by an early
sign another one brings together. Two vectors at the threshold agree on a
sign with probability 1 - arccos(threshold) / pi; from this, the number of
vectors and the window follows how many passes find such a pair with
probability ``RECALL`` (pairs above the threshold are found more often).

The order is global: rows are ranked by (length, pass, number) over ranges
that Spark deals, and cut into blocks of ``block`` neighbours, each with the
first ``window`` rows of the next one, so no window ends at a task's border.
A block returns which of its rows hang together (one row each), and
components come from rounds of large-star and small-star.

A window bounds how many partners one pass can show, so links are not
counted there: within a component all pairs are compared, block by block, and
every link between its members counts, whatever the number of partners.
Components up to ``tile`` distinct vectors are packed into shared groups, of
larger ones each two tiles meet in a group of their own. That cost is
quadratic in the *distinct* vectors of one component, as exact numbers of
links are; equal vectors collapse first and cost nothing further.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths never link; rows
of equal vectors link with each other; rows of one id each get a row and
count as rows; a null id has links but never names a component (one of null
ids only has a null name) and is not kept; an empty table gives an empty
result. Only the id and the vector are read, so other columns may have any
name; no text is read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.operators.offsets import positions

from .common import cut
from .simhash_bits import components

THRESHOLD = 0.95
#: Probability to compare a pair at the threshold at least once.
RECALL = 0.995
WINDOW, BLOCK, TILE = 1024, 8192, 2048
SIGNS = 48
SEED = 20


def passes_for(n: int, threshold: float = THRESHOLD, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes that compare a pair at the threshold with probability ``recall``.

    In an order of n vectors those that agree on the first b signs are n / 2^b, which is
    half a window for the b taken here.
    """
    signs = max(0, math.ceil(math.log2(max(1, 2 * n / window))))
    once = (1 - math.acos(threshold) / math.pi) ** signs
    return 1 if once >= recall else math.ceil(math.log(1 - recall) / math.log(1 - once))


def directions(dim: int, passes: int, signs: int = SIGNS, seed: int = SEED) -> np.ndarray:
    """Random directions, a column for each pass and sign; more passes begin with the same ones."""
    return np.random.default_rng([seed, dim]).standard_normal((passes * signs, dim)).T


def _sort_keys(passes: int, signs: int):
    """Rows (v, dim, x) to a row (v, dim, pass, key) for each pass."""
    def run(batches):
        known: dict[int, np.ndarray] = {}
        place = np.int64(1) << np.arange(signs - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            dims, v = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            flat = _components(batch.column(2))
            edge = np.r_[0, np.cumsum(dims)]
            for dim in np.unique(dims).tolist():
                if dim not in known:
                    known[dim] = directions(dim, passes, signs)
                rows = np.flatnonzero(dims == dim)
                for at in range(0, len(rows), 1024):
                    part = rows[at:at + 1024]
                    x = flat[edge[part][:, None] + np.arange(dim)]
                    keys = ((x @ known[dim]) > 0).reshape(len(part), passes, signs) @ place
                    yield pa.record_batch([pa.array(np.repeat(v[part], passes)), pa.array(np.full(len(part) * passes, dim, np.int32)),
                                           pa.array(np.tile(np.arange(passes, dtype=np.int32), len(part))), pa.array(keys.ravel())],
                                          names=["v", "dim", "pass", "key"])
    return run


def _components(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of the pairs (row i of x, row j of y)."""
    dot = np.einsum("ij,ij->i", x[i], y[j])
    return dot / (np.sqrt(np.einsum("ij,ij->i", x, x))[i] * np.sqrt(np.einsum("ij,ij->i", y, y))[j])


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # tiny and huge components must not underflow or overflow
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def near(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of unit length with at least the threshold: by one product, doubtful ones again."""
    product = x @ y.T
    i, j = np.nonzero(product >= threshold - 1e-12)
    doubt = np.flatnonzero(product[i, j] < threshold + 1e-12)
    if len(doubt):
        keep = np.ones(len(i), dtype=bool)
        keep[doubt] = cosines(x, y, i[doubt], j[doubt]) >= threshold
        i, j = i[keep], j[keep]
    return i, j


def hang_together(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows reaches over the pairs."""
    least = np.arange(n)
    while len(i):
        low = np.minimum(least[i], least[j])
        before = least.copy()
        np.minimum.at(least, least[i], low)
        np.minimum.at(least, least[j], low)
        least = least[least]
        if (least == before).all():
            break
        apart = least[i] != least[j]
        i, j = i[apart], j[apart]
    while (least[least] != least).any():
        least = least[least]
    return least


def _windows(threshold: float, window: int):
    """A block of neighbours to (u, v): each row that hangs together with an earlier one."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("position")
        v, dims = rows.column("v").to_numpy(), rows.column("dim").to_numpy()
        flat = _components(rows.column("x").combine_chunks())
        edge = np.r_[0, np.cumsum(dims)]
        us, vs = [], []
        for dim in np.unique(dims).tolist():  # rows of one length are neighbours
            here = np.flatnonzero(dims == dim)
            x = unit(flat[edge[here][:, None] + np.arange(dim)])
            least = np.arange(len(x))
            for at in range(0, len(x), 512):
                i, j = near(x[at:at + 512], x[at:at + 512 + window], threshold)
                ok = (j > i) & (j <= i + window)
                found = hang_together(len(x), least[at + i[ok]], least[at + j[ok]])
                least = found[least]
            low = np.flatnonzero(least < np.arange(len(x)))
            us.append(v[here][low])
            vs.append(v[here][least[low]])
        return pa.table([pa.array(np.concatenate(z), pa.int64()) for z in (us, vs)], names=["u", "v"])
    return run


def _count_links(threshold: float):
    """Rows (root, tile, v, n, x) of whole components, or of two tiles of one, to (v, links)."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("root", "ascending"), ("tile", "ascending")])
        v, n, root, tile = (rows.column(c).to_numpy() for c in ("v", "n", "root", "tile"))
        dims = rows.column("dim").to_numpy()
        flat = _components(rows.column("x").combine_chunks())
        edge = np.r_[0, np.cumsum(dims)]
        links = np.zeros(len(v), dtype=np.int64)
        two = bool(rows.column("big")[0].as_py()) and rows.column("a")[0].as_py() != rows.column("b")[0].as_py()
        cuts = np.flatnonzero(np.r_[True, root[1:] != root[:-1], True])
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            x = unit(flat[edge[lo]:edge[hi]].reshape(hi - lo, -1))  # a component has one length
            parts = np.flatnonzero(tile[lo:hi] != tile[lo]) if two else []
            if two and not len(parts):
                continue
            first = range(int(parts[0])) if two else range(hi - lo)
            other = np.arange(parts[0], hi - lo) if two else np.arange(hi - lo)
            for at in range(first.start, first.stop, 512):
                mine = np.arange(at, min(at + 512, first.stop))
                i, j = near(x[mine], x[other], threshold)
                i, j = mine[i], other[j]
                if not two:
                    i, j = i[i != j], j[i != j]
                np.add.at(links, lo + i, n[lo + j])
                if two:
                    np.add.at(links, lo + j, n[lo + i])
        return pa.table([pa.array(v, pa.int64()), pa.array(links, pa.int64())], names=["v", "links"])
    return run


def united(distinct: DataFrame, n: int, threshold: float, window: int, block: int, recall: float, signs: int = SIGNS) -> DataFrame:
    """``node`` and ``root`` of the distinct vectors (v, dim, x) that the passes link with another."""
    keys = distinct.select("v", "dim", "x").mapInArrow(_sort_keys(passes_for(n, threshold, window, recall), signs), "v long, dim int, pass int, key long")
    ranked = positions(cut(keys), ["dim", "pass", "key", "v"])
    at, inside = F.expr(f"position div {block}"), F.col("position") % block
    # The first rows of a block are also the last ones of the block before.
    to = F.when((inside < window) & (at > 0), F.array(at, at - 1)).otherwise(F.array(at))
    dealt = ranked.select("v", "position", F.explode(to).alias("block")).join(distinct.select("v", "dim", "x"), "v")
    edges = dealt.groupBy("block").applyInArrow(_windows(threshold, window), "u long, v long").distinct()
    return components(edges)


def link_counts(members: DataFrame, n: int, threshold: float, tile: int) -> DataFrame:
    """(v, links) of the members (root, v, n, dim, x) of components of two distinct vectors at least."""
    sizes = members.groupBy("root").agg(F.count("*").alias("m"))
    sized = members.join(sizes, "root")
    tiles = F.ceil(F.col("m") / tile).cast("int")
    own = F.pmod(F.xxhash64("v"), tiles).cast("int")
    met = sized.select("root", "v", "n", "dim", "x", own.alias("tile"), (tiles > 1).alias("big"),
                       F.explode(F.when(tiles > 1, F.sequence(F.lit(0), tiles - 1)).otherwise(F.array(F.lit(0)))).alias("other"))
    shared = F.pmod(F.xxhash64("root"), F.lit(max(1, n // tile))).cast("long")  # small components share groups
    met = met.withColumn("k", F.when(F.col("big"), F.col("root")).otherwise(shared)).withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other"))
    return met.groupBy("big", "k", "a", "b").applyInArrow(_count_links(threshold), "v long, links long").groupBy("v").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD,
                    window: int = WINDOW, block: int = BLOCK, tile: int = TILE, recall: float = RECALL, signs: int = SIGNS) -> DataFrame:
    """Per row of ``vectors``: id, n_links (other rows linked directly), component_id and kept."""
    if not 0 < threshold <= 1 or window > block:
        raise ValueError("the threshold must be above 0 and up to 1, and a window no longer than a block")
    x = F.col("x")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.coalesce((F.size(x) > 0) & finite & F.exists(x, lambda c: c != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("x")).withColumn("usable", usable)
    distinct = rows.where("usable").groupBy("x").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    distinct = cut(distinct.select(F.monotonically_increasing_id().alias("v"), F.size("x").alias("dim"), "x", "least", "n"))
    n = distinct.count()
    roots = cut(united(distinct, n, threshold, window, block, recall, signs))
    members = distinct.join(roots, distinct["v"] == roots["node"]).select("root", "v", "n", "dim", "x", "least")
    links = link_counts(members, n, threshold, tile)
    names = members.groupBy("root").agg(F.min("least").alias("component_id"))
    named = members.select("root", "v").join(names, "root").select("v", "component_id").join(links, "v")
    classes = distinct.select("v", "x", "n", "least").join(named, "v", "left").select(
        "x", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    linked = rows.where("usable").join(classes, "x").select("id", "n_links", "component_id")
    alone = rows.where("not usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                            F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
