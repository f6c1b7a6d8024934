"""Windows that are words: each new word of a block is encoded, not each text."""

import copy
import re
import sys
from types import SimpleNamespace

import public_tokenizers as files
import pyarrow as pa
import pytest

from corpusforge.llm import token_windows as T

A, B = files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model")

TEXTS = ["plain words and plain words", "a  b   c\n\n d\t e\t\tf", "lines\nof text \n with  ends \n", " lead and trail  ", "\n", "  ", "\t",
         "code();\r\n\tif (x) {\r\n    y;\r\n}", "a\r b\r\rc \r", "nbsp\xa0 x \xa0 y\xa0\n z", "odd\x1c s \x1f t\x85 u", "mongol᠎ v ᠎ w᠎\n\n x​  y",
         "wide　x 　 y 漢字 漢 字\n", "don't I'll 'tis we 've", "literal ▁ mark", "▁", "x▁ y", "<|endoftext|> </s> <s>", "1 2 12 3.14 ,", "žába Ünï ſ",
         "null\x00 byte\x00", "w" * 3000 + " " + "w" * 3000, "word " * 300]


@pytest.fixture()
def sides(monkeypatch):
    monkeypatch.setattr(T, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    return T.load(A, B, files.PATTERN)


def rows(sides, texts, monkeypatch, block_windows=T.BLOCK_WINDOWS):
    """The documents' rows, and the counts of all linked pairs."""
    monkeypatch.setattr(T, "load", lambda *_: sides)
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["id", "t"])
    out = [r for b in T._blocks(A, B, files.PATTERN, pa.int64(), block_windows)([batch]) for r in b.to_pylist()]
    docs = [tuple(r[c] for c in ("id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")) for r in out if r["kind"] == 0]
    counts = {}
    for r in out:
        if r["kind"] == 2 and r["n"]:  # windows of documents without tokens count nothing
            counts[r["a"], r["b"]] = counts.get((r["a"], r["b"]), 0) + r["n"]
    return docs, counts


def by_anchors(sides):
    """The sides as if words could not be cut out: whole texts are encoded and cut at anchors."""
    out = []
    for side in sides:
        side = copy.copy(side)
        side.encode = copy.copy(side.encode)
        side.encode.cuttable = False
        out.append(side)
    return tuple(out)


def test_each_new_word_is_encoded_once(sides, monkeypatch):
    """Failed before: every text was encoded whole by both libraries."""
    seen = [0, 0]

    class Counting(type(sides[1].encode)):
        def __call__(self, text):
            seen[1] += len(text)
            return super().__call__(text)

    class CountingA(type(sides[0].encode)):
        def __call__(self, text):
            seen[0] += len(text)
            return super().__call__(text)

    own = []
    for side, kind in zip(sides, (CountingA, Counting)):
        side = copy.copy(side)
        side.encode = copy.copy(side.encode)
        side.encode.__class__ = kind
        own.append(side)
    words = [f"word{i}" for i in range(50)]
    texts = [" ".join(words[i:] + words[:i]) for i in range(50)]
    docs, _ = rows(tuple(own), texts, monkeypatch, block_windows=200)  # the memo outlives blocks
    assert len({d[1:3] for d in docs}) == 1 and docs[0][1] > 50
    assert max(seen) < 4 * len(texts[0])


def test_words_give_what_whole_texts_give(sides, monkeypatch):
    assert all(s.encode.cuttable for s in sides)
    for texts in (TEXTS, TEXTS[::-1], [f"{p}{q}" for p in TEXTS for q in TEXTS if len(p) + len(q) < 100]):
        for size in (T.BLOCK_WINDOWS, 7):
            assert rows(sides, texts, monkeypatch, size) == rows(by_anchors(sides), texts, monkeypatch, size)


def test_small_memo_and_long_words(sides, monkeypatch):
    want = rows(sides, TEXTS, monkeypatch)
    monkeypatch.setattr(T, "MEMO_WINDOWS", 5)
    assert rows(sides, TEXTS, monkeypatch, 7) == want
    monkeypatch.setattr(T, "MEMO_CHARS", 3)
    assert rows(sides, TEXTS, monkeypatch, 7) == want


def test_long_words_weigh_as_many_windows(sides):
    block, (window,) = T.Block(), T.align_words(T.Aligner(*sides), [" " + "漢字" * 5000])
    block.number("w", window)
    assert block.held >= len(window[2]) // (8 * T.WINDOW_LINKS) > 100


def test_words_join_to_the_text(sides):
    for text in TEXTS:
        words = T.words_of(text)
        assert "".join(words) == " " + text
        if not T.ANY_UNSURE.search(text):
            assert words == T.WORD_CUT.split(" " + text)
    white = {chr(c) for c in range(sys.maxunicode + 1) if re.match(r"\s", chr(c))}
    assert all(T.ANY_UNSURE.match(c) for c in white - set(" \t\n\v\f"))
    assert not any(T.ANY_UNSURE.match(c) for c in " \t\n\v\faé漢▁")
