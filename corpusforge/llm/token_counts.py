"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text over ``chunk_chars`` is cut into chunks that overlap, each encoded
with offsets in a task of its own. Two neighbours are spliced at a boundary
that both encodings share and that is stable: the text has white space just
before it, where the tokenizer's pre-tokenizer splits in any context, and
both encodings start a token there. Where an overlap holds no such place
(long runs without white space) the document's overlaps are widened fourfold
and it is encoded again, until every pair aligns; an overlap as wide as the
text encodes it whole, so this ends. No chunk has to fit with its whole text
into one task.

Shorter texts are encoded whole. With ``by_word`` (for tokenizers that drop
white space and never join what it separates, as the word BPE does) the
counts of words of a text are kept in a bounded table, so common words are
encoded once; words are cut at ASCII white space only, which every
white-space class contains.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); special
strings inside texts are handled as the library's default; rows of one id
each get a row; a null id is kept; an empty table gives an empty result. Only
the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

CHUNK_CHARS, OVERLAP = 1 << 15, 1 << 9
MAX_TOKENS = 2048
#: Words whose counts a task holds at most; the table starts anew when full.
TABLE_WORDS = 1 << 18


def load(path: str):
    """The tokenizer of a file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _count_words(tokenizer, words: list[bytes]) -> list[int]:
    """Tokens of each word, from one encoding of them with spaces between."""
    starts, at, parts = [], 0, []
    for w in words:
        s = w.decode("utf-8")
        starts.append(at)
        at += len(s) + 1
        parts.append(s)
    e = tokenizer.encode(" ".join(parts), add_special_tokens=False)
    first = np.array([o[0] for o in e.offsets], dtype=np.int64)
    return np.bincount(np.searchsorted(starts, first, side="right") - 1, minlength=len(words)).tolist()


class WordTable:
    """Counts of texts as sums over their words, words encoded once."""

    def __init__(self, tokenizer, most: int = TABLE_WORDS):
        self.tokenizer, self.most, self.counts = tokenizer, most, {}

    def __call__(self, texts: list[bytes]) -> list[int]:
        lists = [t.split() for t in texts]
        known = self.counts
        new = list({w for words in lists for w in words if w not in known})
        if len(known) + len(new) > self.most and known:
            known = self.counts = {}
            new = list({w for words in lists for w in words})
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            known.update(zip(part, _count_words(self.tokenizer, part)))
        return [sum(map(known.__getitem__, words)) for words in lists]


def _whole(path: str, by_word: bool):
    """Rows (.., text) to rows (.., tokens)."""
    def run(batches):
        tokenizer = load(path)
        count = WordTable(tokenizer) if by_word else (
            lambda texts: [len(e) for e in tokenizer.encode_batch([t.decode("utf-8") for t in texts], add_special_tokens=False)])
        for batch in batches:
            texts, out = [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()], []
            for at in range(0, len(texts), 64):
                out += count(texts[at:at + 64])
            yield pa.record_batch([*batch.columns[:-1], pa.array(out, pa.int64())], names=[*batch.schema.names[:-1], "tokens"])
    return run


def stable_starts(text: str, offsets: list[tuple[int, int]], lo: int, hi: int) -> tuple[list[int], list[int]]:
    """Places in [lo, hi) where a token starts after white space, and the tokens before each."""
    places, before, last = [], [], -1
    for i, (a, _) in enumerate(offsets):
        if a >= hi:
            break
        if a >= lo and a != last and a > 0 and text[a - 1] in " \t\n\x0b\x0c\r":
            places.append(a)
            before.append(i)
        last = a
    return places, before


def _pieces(path: str, chunk: int):
    """Encodes chunks; of each the tokens and the stable starts in the overlaps at its head and tail."""
    schema = pa.schema([("row", pa.int64()), ("no", pa.int64()), ("tokens", pa.int64()), ("head", pa.list_(pa.int64())),
                        ("head_n", pa.list_(pa.int64())), ("tail", pa.list_(pa.int64())), ("tail_n", pa.list_(pa.int64()))])

    def run(batches):
        tokenizer = load(path)
        for batch in batches:
            out = []
            for row, no, overlap, text in zip(*(batch.column(c).to_pylist() for c in ("row", "no", "overlap", "piece"))):
                e = tokenizer.encode(text, add_special_tokens=False)
                base = no * chunk
                head = stable_starts(text, e.offsets, 0, overlap)
                tail = stable_starts(text, e.offsets, chunk, len(text))
                out.append((row, no, len(e), [base + p for p in head[0]], head[1], [base + p for p in tail[0]], tail[1]))
            cols = list(zip(*out)) or [()] * 7
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
    return run


def _cut_text(chunk: int, overlap: int):
    """Rows (row, text) to overlapping pieces; a text is decoded once and each piece copied from its place."""
    schema = pa.schema([("row", pa.int64()), ("no", pa.int64()), ("overlap", pa.int32()), ("piece", pa.string())])

    def run(batches):
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                n = max(1, -(-(len(text) - overlap) // chunk))
                for at in range(0, n, 32):
                    numbers = range(at, min(at + 32, n))
                    yield pa.record_batch([pa.array([row] * len(numbers), pa.int64()), pa.array(numbers, pa.int64()), pa.array([overlap] * len(numbers), pa.int32()),
                                           pa.array([text[k * chunk:(k + 1) * chunk + overlap] for k in numbers], pa.string())], schema=schema)
    return run


def _spliced(huge: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """(row, tokens) of huge texts; tokens are null where two chunks share no stable start."""
    pieces = huge.select("row", "text").mapInArrow(_cut_text(chunk, overlap), "row long, no long, overlap int, piece string")
    coded = pieces.repartition("row", "no").mapInArrow(_pieces(path, chunk), "row long, no long, tokens long, head array<long>, head_n array<long>, tail array<long>, tail_n array<long>")
    coded = coded.dropDuplicates(["row", "no"])
    order = Window.partitionBy("row").orderBy("no")
    coded = coded.withColumn("next_head", F.lead("head").over(order)).withColumn("next_n", F.lead("head_n").over(order)).withColumn("final", F.lead("no").over(order).isNull())
    # The latest common start: both encodings have run the longest alone there.
    place = F.array_max(F.array_intersect("tail", "next_head"))
    coded = coded.withColumn("place", place)
    end = F.when(F.col("final"), F.col("tokens")).otherwise(F.get("tail_n", (F.array_position("tail", F.col("place")) - 1).cast("int")))
    skip = F.when(F.col("final"), F.lit(0).cast("long")).otherwise(F.get("next_n", (F.array_position("next_head", F.col("place")) - 1).cast("int")))
    return coded.select("row", (end - skip).alias("part")).groupBy("row").agg(
        F.when(F.count("part") == F.count("*"), F.sum("part")).alias("tokens"))


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", by_word: bool = False,
                 chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Per row of ``docs``: id, n_bytes, n_tokens and over_limit (more than ``max_tokens``)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    n_bytes = F.octet_length("text").cast("long").alias("n_bytes")
    kind = docs.schema[id_col].dataType.simpleString()
    short = rows.where(F.length("text") <= chunk_chars).select("id", n_bytes, F.col("text").cast("binary"))
    short = short.mapInArrow(_whole(path, by_word), f"id {kind}, n_bytes long, tokens long")
    # Rows that look alike get the same key and the same count.
    huge = rows.where(F.length("text") > chunk_chars).withColumn("row", F.xxhash64("id", "text"))
    texts = huge.select("row", "text")
    done = cut(_spliced(texts, path, chunk_chars, overlap))
    found, wide = done.where("tokens is not null"), overlap
    left = done.where("tokens is null").select("row")
    while left.limit(1).count():
        wide *= 4
        again = texts.join(left, "row", "left_semi")
        done = cut(_spliced(again, path, max(chunk_chars, wide), wide))
        found, left = found.unionByName(done.where("tokens is not null")), done.where("tokens is null").select("row")
    long = huge.select("id", n_bytes, "row").join(found, "row").select("id", "n_bytes", "tokens")
    out = short.unionByName(long)
    return out.select(F.col("id").alias(id_col), "n_bytes", F.col("tokens").alias("n_tokens"), (F.col("tokens") > max_tokens).alias("over_limit"))
