"""Line dedup with two Bloom filters and exact confirmation.

1. Every task marks the 64-bit hashes of its documents' line keys in two
   Bloom filters, once-seen and twice-seen, cut into segments of fixed size;
   segments meet by number, where what was once seen by two tasks becomes
   twice seen. No text and no id is shuffled for this.
2. The twice-seen filter, of a size bounded by ``max_bits``, is broadcast.
   A document without any suspected line is finished where it was read. Only
   suspected lines are shuffled, with their whole key, to be counted exactly
   and to choose the document that keeps them.
3. Documents of suspected lines meet the keys that they lose and drop them.

A Bloom filter has no false negatives, so no repeat is missed; false
positives only send more lines to the exact count. The filter's size follows
the corpus (``BITS_PER_LINE``) up to ``max_bits``; beyond, it fills up, more
lines are counted exactly, and the result stays the same.

A line's key is the line stripped of ASCII white space at both ends with A-Z
lower-cased. Keys of ``min_chars`` code points or more in ``min_docs``
documents or more lose all their lines but in the largest id that holds them.

Defined cases: a null or empty text is one empty line; rows of one id are one
document for counts, and all keep or lose lines alike; a null id is one
document, smaller than all others; an empty table gives an empty result. Only
the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MIN_CHARS = 20
MIN_DOCS = 3
BITS_PER_LINE = 16
#: Bits of a segment (64 KiB), and of the whole twice-seen filter at most (128 MiB).
SEGMENT_BITS = 1 << 19
MAX_BITS = 1 << 30
HASHES = 3


def line_key(line: bytes) -> bytes:
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def _keys(text: bytes | None, min_chars: int) -> list[bytes]:
    """The distinct keys of a text that are long enough, in order."""
    found = dict.fromkeys(line_key(x) for x in (text or b"").split(b"\n") if len(x) >= min_chars)
    return [k for k in found if _long_enough(k, min_chars)]


def _places(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash and its HASHES bit places there."""
    segment = (hashes >> np.uint64(40)) % np.uint64(segments)
    step = (hashes >> np.uint64(20)) | np.uint64(1)
    places = (hashes[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) % np.uint64(SEGMENT_BITS)
    return segment.astype(np.int64), places.astype(np.int64)


def _marks(segments: int, min_chars: int):
    schema = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def packed(places: np.ndarray) -> bytes:
        return np.unique(places).astype(np.uint32).tobytes()

    def flush(hashes: list[int]) -> pa.RecordBatch:
        h, n = np.unique(np.array(hashes, dtype=np.uint64), return_counts=True)
        segment, places = _places(h, segments)
        order = np.argsort(segment, kind="stable")
        segment, places, n = segment[order], places[order], n[order]
        cuts = np.flatnonzero(np.diff(segment)) + 1
        rows = []
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(segment)]):
            # A bit that two different keys set here counts as seen twice, as it would across tasks.
            own, times = np.unique(places[lo:hi], return_counts=True)
            rows.append((int(segment[lo]), own.astype(np.uint32).tobytes(),
                         packed(np.concatenate([own[times > 1], places[lo:hi][n[lo:hi] > 1].ravel()]))))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: list[int] = []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                hashes += [xxhash.xxh64_intdigest(k) for k in _keys(text, min_chars)]
                if len(hashes) >= 1 << 20:
                    yield flush(hashes)
                    hashes = []
        if hashes:
            yield flush(hashes)
    return run


def _merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ORs one segment's marks; what is set anew in the once filter is seen twice."""
    once = np.zeros(SEGMENT_BITS, dtype=bool)
    twice = np.zeros(SEGMENT_BITS, dtype=bool)
    for batch in batches:
        for one, two in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist()):
            at = np.frombuffer(one, dtype=np.uint32)
            twice[at[once[at]]] = True
            once[at] = True
            twice[np.frombuffer(two, dtype=np.uint32)] = True
    yield pa.record_batch([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(twice, bitorder="little").tobytes()], pa.binary())],
                          names=["segment", "twice"])


def twice_seen(docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS, max_bits: int = MAX_BITS) -> tuple[DataFrame, int]:
    """The twice-seen filter, a row (segment, twice) for each segment, and the number of segments."""
    texts = docs.select(F.col(text_col).cast("binary").alias("text"))
    n = docs.select(F.sum(F.length(text_col) - F.length(F.replace(text_col, F.lit("\n"), F.lit(""))) + 1)).first()[0] or 1
    segments = max(1, min(max_bits, n * BITS_PER_LINE) // SEGMENT_BITS)
    marks = texts.mapInArrow(_marks(segments, min_chars), "segment int, once binary, twice binary")
    return marks.groupBy("segment").applyInArrow(_merge, "segment int, twice binary"), segments


def _suspect(segments: int, filter_bc, min_chars: int):
    """Of each document, the suspected keys (no row for a document without any)."""
    def run(batches):
        bits = filter_bc.value
        for batch in batches:
            ids, keys = [], []
            for i, text in zip(batch.column(0), batch.column(1).to_pylist()):
                own = _suspected(_keys(text, min_chars), bits, segments)
                ids += [i.as_py()] * len(own)
                keys += own
            yield pa.record_batch([pa.array(ids, batch.schema.field(0).type), pa.array(keys, pa.binary())], names=["id", "key"])
    return run


def _suspected(keys: list[bytes], bits: dict[int, np.ndarray], segments: int) -> list[bytes]:
    if not keys:
        return []
    h = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
    segment, places = _places(h, segments)
    return [k for k, s, p in zip(keys, segment.tolist(), places.tolist())
            if (own := bits.get(s)) is not None and all(own[x >> 3] >> (x & 7) & 1 for x in p)]


def _dropped(text: bytes | None, lost: set[bytes]) -> tuple[int, int, bytes]:
    lines = (text or b"").split(b"\n")
    if not lost:
        return len(lines), 0, text or b""
    kept = [x for x in lines if line_key(x) not in lost]
    return len(lines), len(lines) - len(kept), b"\n".join(kept)


def _finish(with_text: bool, columns: int):
    """Drops the lines of the keys in ``lost`` (the last column) from the text (the one before)."""
    def run(batches):
        for batch in batches:
            done = [_dropped(t, set(x or ())) for t, x in zip(batch.column(columns).to_pylist(), batch.column(columns + 1).to_pylist())]
            out = [batch.column(i) for i in range(columns)]
            if with_text:
                null = [t is None for t in batch.column(columns).to_pylist()]
                out.append(pa.array([None if z else x[2].decode("utf-8", "replace") for x, z in zip(done, null)], pa.string()))
            else:
                out += [pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64()),
                        pa.array([hashlib.sha256(x[2]).hexdigest() for x in done], pa.string())]
            yield pa.record_batch(out, names=[f"c{i}" for i in range(len(out))])
    return run


def _split(segments: int, filter_bc, min_chars: int, suspected: bool):
    """The rows of documents with (or without) a suspected line."""
    def run(batches):
        bits = filter_bc.value
        for batch in batches:
            mask = [bool(_suspected(_keys(t, min_chars), bits, segments)) == suspected for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield batch.filter(pa.array(mask, pa.bool_()))
    return run


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                        min_docs: int = MIN_DOCS, max_bits: int = MAX_BITS, keep_columns: bool = False, length_col: str | None = None) -> DataFrame:
    """Per row of ``docs``: id, n_lines, n_dropped and kept_sha256; with ``keep_columns``
    instead the columns of ``docs``, the text without the dropped lines (a null stays null) and ``length_col``,
    if there is one, the new text's length in code points.
    """
    spark = docs.sparkSession
    marks, segments = twice_seen(docs, text_col, min_chars, max_bits)
    # At most max_bits / 8 bytes, whatever the corpus.
    twice = {r.segment: np.frombuffer(r.twice, dtype=np.uint8) for r in cut(marks).toLocalIterator()}
    bits = spark.sparkContext.broadcast(twice)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()
    found = cut(rows.mapInArrow(_suspect(segments, bits, min_chars), f"id {id_type}, key binary"))
    counted = found.distinct().groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
    # Cut, so that the join reads both sides from plain exchanges and a key that a third of all
    # documents hold can be split.
    repeated = cut(counted.where(F.col("n") >= min_docs).select("key", "keeper"))
    losers = found.join(repeated, "key").where(~F.col("id").eqNullSafe(F.col("keeper")))
    lost = losers.groupBy(F.col("id").alias("lost_id")).agg(F.collect_set("key").alias("lost"))

    names = docs.columns if keep_columns else [id_col]
    kept = [n for n in names if not keep_columns or n != text_col]
    cols = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(kept)]
    wide = docs.select(*cols, F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("text"))
    schema = ", ".join(f"c{i} {docs.schema[n].dataType.simpleString()}" for i, n in enumerate(kept))
    mid = f"{schema}, __id {id_type}, text binary"
    # Documents without a suspected line are finished where they are read.
    clean = wide.mapInArrow(_split(segments, bits, min_chars, False), mid).withColumn("lost", F.lit(None).cast("array<binary>")).drop("__id")
    dirty = wide.mapInArrow(_split(segments, bits, min_chars, True), mid)
    dirty = dirty.join(lost, F.col("__id").eqNullSafe(F.col("lost_id")), "left").select(*[f"c{i}" for i in range(len(kept))], "text", "lost")
    n = len(kept)
    tail = f"c{n} string" if keep_columns else f"c{n} long, c{n + 1} long, c{n + 2} string"
    out = clean.unionByName(dirty).mapInArrow(_finish(keep_columns, n), f"{schema}, {tail}" if schema else tail)
    if keep_columns:
        place = {name: f"c{i}" for i, name in enumerate(kept)} | {text_col: f"c{n}"}
        shown = {c: F.col(place[c]) for c in docs.columns}
        if length_col in shown:
            shown[length_col] = F.length(shown[text_col]).cast(docs.schema[length_col].dataType)
        return out.select(*[x.alias(c) for c, x in shown.items()])
    return out.select(F.col("c0").alias(id_col), F.col("c1").alias("n_lines"), F.col("c2").alias("n_dropped"), F.col("c3").alias("kept_sha256"))
