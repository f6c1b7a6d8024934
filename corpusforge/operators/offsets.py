"""Ordered scans: byte offsets and positions.

Running sums over a whole corpus are computed in two levels so no single
task ever sees all rows:

1. rows are assigned to *buckets* that follow the scan order (an input split
   of a file, or a range of a sortable key, stored with the row);
2. a window per bucket gives the running sum inside the bucket (one shuffle
   on the bucket key, balanced by construction);
3. bucket totals (one row per bucket) are prefix-summed in a tiny window and
   joined back. The totals table has one row per bucket, so its size is
   bounded by the bucket count, not by the data.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.session import cut

# JSON string escapes (RFC 8259): quote, backslash and the C0 controls.
_JSON_SHORT = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
               ("\b", "\\b"), ("\f", "\\f")]
JSON_ESCAPES = _JSON_SHORT + [(chr(i), "\\u%04x" % i) for i in range(32)
                              if chr(i) not in "\n\r\t\b\f"]


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def in_ranges(df: DataFrame, keys: Sequence[str], num_buckets: int | None = None, bucket_col: str = "__bucket") -> DataFrame:
    """``df`` dealt into ranges of the *whole* order key, with each row's range number stored beside it.

    Spark samples the bounds itself while it shuffles, so they reach neither
    this process nor the plan, however many ranges there are; a first key
    that most rows share is split by the next ones, and rows of equal keys
    share a range. The rows are written to the checkpoint folder, so every
    branch of a plan, and a repeated task, sees the same ranges.
    """
    dealt = df.repartitionByRange(num_buckets, *keys) if num_buckets else df.repartitionByRange(*keys)
    return cut(dealt.withColumn(bucket_col, F.spark_partition_id()))


def running_sum(df: DataFrame, value, order_cols: Sequence, bucket_cols: Sequence[str],
                bucket_order: Sequence | None = None, reset_cols: Sequence[str] = (),
                start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Add ``start``/``end``: exclusive and inclusive running sums of ``value``.

    ``bucket_cols`` must follow the scan order (every row of a bucket comes
    after every row of the buckets ordered before it, within ``reset_cols``);
    ``bucket_order`` orders buckets (default: the bucket columns). The sum
    restarts for each value of ``reset_cols`` (for example per file).
    """
    value = F.col(value) if isinstance(value, str) else value
    bucket_order = list(bucket_order) if bucket_order else list(bucket_cols)
    w = (Window.partitionBy(*bucket_cols).orderBy(*_cols(order_cols))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = df.withColumn("__v", value.cast("bigint")).withColumn("__local_end", F.sum("__v").over(w))
    # A partial sum of narrow rows; only the rows themselves pay for the window.
    totals = df.groupBy(*reset_cols, *bucket_cols).agg(F.sum(value.cast("bigint")).alias("__total"))
    wt = (Window.partitionBy(*reset_cols).orderBy(*_cols(bucket_order))
          .rowsBetween(Window.unboundedPreceding, -1))
    base = totals.select(*reset_cols, *bucket_cols,
                         F.coalesce(F.sum("__total").over(wt), F.lit(0)).cast("bigint").alias("__base"))
    out = x.join(base, [*reset_cols, *bucket_cols], "inner")
    return (out.withColumn(end_col, F.col("__base") + F.col("__local_end"))
               .withColumn(start_col, F.col(end_col) - F.col("__v"))
               .drop("__v", "__local_end", "__base"))


def ordered_running_sum(df: DataFrame, value, order_key, num_buckets: int | None = None,
                        start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Running sum of ``value`` in the order of a sortable key.

    ``order_key`` is a column name or a list of names, of any orderable
    types; buckets are ranges of the full key. All columns of ``df`` are
    written once on the way: give narrow rows.
    """
    keys = [order_key] if isinstance(order_key, str) else list(order_key)
    return running_sum(in_ranges(df, keys, num_buckets), value, keys, ["__bucket"], start_col=start_col,
                       end_col=end_col).drop("__bucket")


def positions(df: DataFrame, order_key, num_buckets: int | None = None,
              col: str = "position") -> DataFrame:
    """0-based position of each row in the order of ``order_key`` (H2)."""
    return (ordered_running_sum(df, F.lit(1), order_key, num_buckets, start_col=col,
                                end_col="__pos_end").drop("__pos_end"))


def resolve_slice(total: int, start: int | None, end: int | None) -> tuple[int, int]:
    """Python slice bounds ``[start:end)`` resolved against ``total`` rows."""
    s, e, _ = slice(start, end).indices(total)
    return s, max(s, e)


def _slice_bounds(df: DataFrame, start: int | None, end: int | None) -> tuple[int, int | None]:
    """The slice from the front; rows are counted only for a negative bound."""
    if (start is not None and start < 0) or (end is not None and end < 0):
        return resolve_slice(df.count(), start, end)
    return start or 0, end


def corpus_slice(df: DataFrame, order_key, start: int | None = None,
                 end: int | None = None, num_buckets: int | None = None) -> DataFrame:
    """Rows ``[start:end)`` of the corpus in ``order_key`` order, with their ``position`` (A3).

    Python slice semantics, negatives included. For narrow rows, as all of
    them are dealt by the key; ``slice_by_key`` takes whole documents.
    """
    s, e = _slice_bounds(df, start, end)
    pos = positions(df, order_key, num_buckets, col="position")
    cond = F.col("position") >= F.lit(s)
    if e is not None:
        cond = cond & (F.col("position") < F.lit(e))
    return pos.filter(cond)


def slice_by_key(df: DataFrame, order_key, start: int | None = None, end: int | None = None,
                 num_buckets: int | None = None) -> DataFrame:
    """Rows ``[start:end)`` in ``order_key`` order (A3), whole documents unmoved.

    Only the keys are ranked. The keys at the two bounds (one row each)
    become a filter on the corpus, which Spark pushes into the scan. The key
    must tell rows apart: bounds on a repeated or null key are an error.
    """
    keys = [order_key] if isinstance(order_key, str) else list(order_key)
    s, e = _slice_bounds(df, start, end)
    if e is not None and e <= s:
        return df.limit(0)
    at = [p for p in (s or None, e) if p is not None]
    if not at:
        return df
    # A bound's neighbour has another key, or equal rows would be parted.
    wanted = [p for b in at for p in (b - 1, b)]
    found = positions(df.select(*keys), keys, num_buckets).where(F.col("position").isin(wanted)).collect()
    key_of = {r["position"]: tuple(r[k] for k in keys) for r in found}
    for b in at:
        if b in key_of and (key_of[b] == key_of[b - 1] or any(v is None for v in key_of[b])):
            raise ValueError(f"The order key {keys} does not tell the rows at position {b} apart")

    def literal(key):
        return [F.lit(v).cast(df.schema[k].dataType) for v, k in zip(key, keys)]

    def from_on(key):
        """Rows whose key is not before ``key``; the first column's part can be pushed down."""
        whole = F.struct(*[F.col(k) for k in keys]) >= F.struct(*[v.alias(k) for v, k in zip(literal(key), keys)])
        return (F.col(keys[0]) >= literal(key)[0]) & whole if len(keys) > 1 else F.col(keys[0]) >= literal(key)[0]

    def before(key):
        whole = F.struct(*[F.col(k) for k in keys]) < F.struct(*[v.alias(k) for v, k in zip(literal(key), keys)])
        head = F.col(keys[0]).isNull() | (F.col(keys[0]) <= literal(key)[0])
        return head & whole if len(keys) > 1 else F.col(keys[0]).isNull() | (F.col(keys[0]) < literal(key)[0])
    if s:
        df = df.where(from_on(key_of[s])) if s in key_of else df.limit(0)
    if e is not None and e in key_of:
        df = df.where(before(key_of[e]))
    return df


_RARE_CONTROL_RE = r"[\x00-\x07\x0b\x0e-\x1f]"


def json_string(c) -> Column:
    """A JSON string literal for a string column (quotes and escapes).

    The ``\\u00XX`` escapes of rare control characters run only for values
    that contain one (a single scan), not as 25 passes over every value.
    """
    c = F.col(c) if isinstance(c, str) else c
    short = c
    for raw, esc in _JSON_SHORT:
        short = F.replace(short, F.lit(raw), F.lit(esc))
    full = short
    for raw, esc in JSON_ESCAPES[len(_JSON_SHORT):]:
        full = F.replace(full, F.lit(raw), F.lit(esc))
    body = F.when(c.rlike(_RARE_CONTROL_RE), full).otherwise(short)
    return F.concat(F.lit('"'), body, F.lit('"'))


def jsonl_lines(docs: DataFrame, id_col: str, text_cols: Sequence[str], id_field: str = "docno",
                keep: Sequence[str] = ()) -> DataFrame:
    """Serialise documents as JSON lines ``{"docno": "...", "text": "..."}``."""
    parts = [F.lit("{"), json_string(F.lit(id_field)), F.lit(": "), json_string(F.col(id_col).cast("string"))]
    for c in text_cols:
        parts += [F.lit(", "), json_string(F.lit(c)), F.lit(": "), json_string(F.col(c))]
    parts.append(F.lit("}"))
    return docs.select(*keep, F.concat(*parts).alias("line"))


def json_path(field: str) -> str:
    """The JSON path of a top-level field, whatever characters its name has."""
    return f"$['{field}']"


def jsonl_offsets(lines: DataFrame, order_key, id_field: str = "docno",
                  line_col: str = "line", num_buckets: int | None = None) -> DataFrame:
    """``(doc_id, start, end)`` byte range of every line of a JSONL corpus.

    Each line takes its UTF-8 bytes plus one newline; ``order_key`` is the
    line order.
    """
    keys = [order_key] if isinstance(order_key, str) else list(order_key)
    x = lines.select(*keys, F.get_json_object(F.col(line_col), json_path(id_field)).alias("doc_id"),
                     (F.octet_length(F.col(line_col)) + 1).alias("__bytes"))
    # Narrow rows, written once: the lines are serialised and measured a single time.
    return ordered_running_sum(cut(x), "__bytes", keys, num_buckets).select(*keys, "doc_id", "start", "end")


# Endings of files that Spark would decompress while reading.
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst|xz)$"


def read_lines_with_offsets(spark, path: str, id_field: str = "docno") -> DataFrame:
    """Byte ranges of the lines of JSONL files, computed from a distributed read.

    Every input split of a file is a bucket: rows of a split arrive in file
    order, and ``_metadata.file_block_start`` orders the splits. The lines are
    read and parsed once, into narrow rows (id, length) that are written to the
    checkpoint folder; only these are shuffled. Lines end at ``\\n`` (a preceding
    ``\\r`` counts as part of the line); the last line ends at the file size.
    """
    # lineSep='\n': a '\r' before the newline stays in the value, so
    # octet_length + 1 is the exact line size for LF and CRLF files alike.
    raw = spark.read.text(path, lineSep="\n").select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("row_in_split"),
    )
    x = raw.select("file_path", "block_start", "file_size", "row_in_split",
                   F.get_json_object("value", json_path(id_field)).alias("doc_id"),
                   F.when(F.lower("file_path").rlike(COMPRESSED), F.raise_error(F.concat(
                       F.lit("Byte offsets need uncompressed files: "), F.col("file_path"))).cast("int"))
                    .otherwise(F.octet_length("value") + 1).alias("__bytes"))
    out = running_sum(cut(x), "__bytes", ["row_in_split"], ["file_path", "block_start"],
                      bucket_order=["block_start"], reset_cols=["file_path"])
    return out.select("file_path", "doc_id", "start",
                      F.least(F.col("end"), F.col("file_size")).alias("end"))


def duplicate_ids(df: DataFrame, id_col: str) -> DataFrame:
    """Ids that are null or occur more than once, with their counts (G1).

    A partial (map-side) count, so a hot id costs one row per task.
    """
    return (df.groupBy(F.col(id_col).alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
              .filter((F.col("n") > 1) | F.col("doc_id").isNull()))


def check_unique_ids(df: DataFrame, id_col: str, show: int = 5) -> None:
    """Raise if any id is null or repeated; the message lists a few offenders."""
    bad = duplicate_ids(df, id_col).limit(show).collect()
    if bad:
        raise ValueError(f"Documents contain duplicate or null document ids: {[tuple(r) for r in bad]}")
