"""Cross-tokenizer alignment by white-space-token anchors.

Both tokenizers encode a whole text; tokens are byte ranges of it. A place
where tokens of both end and the next token of both is marked with a space is
an anchor: whatever aligns on one side of it does not depend on the other
side. Anchors are verified on the token ends themselves, and a document is
aligned only where the joined token bytes of both sides are its bytes. They
cut a document into windows of token ids, nearly always a word, and a window's
alignment (its groups between shared ends, and its links between overlapping
tokens) depends on the ids alone, so it is memoised by its two id tuples.

A tokenizer that never joins a character and white space behind it (checked on
both files) gives a word, with the white space before it, the same tokens in
every text: its window needs no look at the text around it. There the windows
are the words themselves, a block looks them up by their characters, and only
words that it has not met are encoded, all of a document's in one go. Their
bytes are checked word by word.

Corpus-wide counts of linked id pairs need one count per pair and a look
back. Documents are written in blocks of a bounded number of windows: of each
document its totals and the numbers of its windows within the block, of each
block its windows' pairs, and of each distinct pair of the block one row with
its count. Only these pair rows are summed over the corpus and sent back, so
a pair that every document holds costs a row a block. A block then adds up
its documents by its own pairs' counts. Tokenising runs once: the blocks are
a written table in the shared folder.

Texts over ``PIECE_CHARS`` are encoded in pieces, cut only at a space between
two characters that are no white space, where neither tokenizer can join (the
first one's pattern starts a new word there, and no piece of the second one's
vocabulary holds a space mark after another character, which is checked);
tokens are those of the whole text, in bounded memory of the libraries.

Defined cases: texts that are null, empty, or whose joined bytes on either
side differ from a space and the text have no tokens, zero counts and an
empty digest; special strings inside texts are plain text; very long texts
make a block of their own, and a window of many links counts as several; rows of one id are aligned one by one and each
gets a row; a null id is kept; an empty table gives an empty result. Only the
id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Windows of a block, and alignments a task holds at most (the memo starts anew when full).
BLOCK_WINDOWS, MEMO_WINDOWS = 1 << 20, 3 << 17
#: Longer words are aligned again by each block, and links beyond these weigh as one more window each time.
MEMO_CHARS, WINDOW_LINKS = 64, 64
PIECE_CHARS = 1 << 18
#: Where both tokenizers start a new token in any context.
SAFE_CUT = re.compile(r"(?<=[^\s\x00-\x20\x7f-\xa0]) (?=[^\s\x00-\x20\x7f-\xa0])")
#: Characters that both pattern engines are known to class alike (tests hold them against each other).
PLAIN = re.compile(r"[\t-\r\x20-\x7e\xa1-\xac\xae-ſ]*")
#: White space before which words are cut, and other white space, some of which pieces hold behind a
#: character, with what some pattern engines may take for it: no cut is made behind those.
WHITE = "\\t-\\f "
UNSURE = "\\x00-\\x08\\x0d-\\x1f\\x7f-\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u2064\\u3000\\ufeff"
ANY_UNSURE = re.compile(f"[{UNSURE}]")
#: White space and a word; and, in texts with unsure characters, the cuts between words.
WORD, WORD_CUT = re.compile(f"[{WHITE}]+[^{WHITE}]*"), re.compile(f"(?<=[^{UNSURE}{WHITE}])(?=[{WHITE}])")


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable character: itself where
    it is printable Latin-1, else the next free one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file: ids of texts, and the bytes of each id.

    Plain texts are encoded by a faster library with the file's own
    vocabulary as ranks. That gives the same ids if the merges are in the
    order of the ids and the merges encode each entry as itself: then a merge
    by joined bytes is a merge by pairs. Both are checked on the file, else
    the file's own library encodes all texts.
    """

    def __init__(self, path: str, pattern: str | None = None):
        from tokenizers import Tokenizer
        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        self.own.encode_special_tokens = True
        alphabet = byte_alphabet()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        special = {t["content"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for entry, i in vocab.items():
            if entry not in special:
                self.bytes[i] = bytes(alphabet[c] for c in entry)
        #: Whether words are those of the byte-level pattern, none of which holds white space behind another character.
        self.cuttable = spec.get("normalizer") is None and spec["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.fast = None
        if pattern is not None and self._merges_by_id(spec, vocab, special):
            import tiktoken
            ranks = {self.bytes[i]: i for e, i in vocab.items() if e not in special}
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _merges_by_id(self, spec: dict, vocab: dict, special: set) -> bool:
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [vocab.get(a + b, -1) for a, b in merges]
        if any(a >= b for a, b in zip(made, made[1:])) or made[:1] != [256]:
            return False
        model = self.own.model
        return all([t.id for t in model.tokenize(e)] == [i] for e, i in vocab.items() if e not in special)

    def __call__(self, text: str) -> tuple[np.ndarray, bool]:
        """Ids, and whether it is certain that their bytes are the text's: the faster library only merges bytes."""
        if self.fast is not None and PLAIN.fullmatch(text):
            return np.array(self.fast.encode_ordinary(text), dtype=np.int32), True
        return np.array(self.own.encode(text, add_special_tokens=False).ids, dtype=np.int32), False


class Pieces:
    """A sentencepiece model with byte fallback, which adds the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) or self.model.is_unknown(i)
                      else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        #: Whether the white space of ``WHITE`` can only begin a piece, so that a text may be cut before it.
        self.cuttable = not any(re.search("[▁\t-\f]", p.lstrip("▁\t\n\v\f")) for p in names)

    def __call__(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), dtype=np.int32)


class Side:
    """A tokenizer and what is asked of its ids: byte lengths and space marks."""

    def __init__(self, tokenizer):
        self.encode, self.bytes = tokenizer, tokenizer.bytes
        self.length = np.array([len(b) for b in self.bytes], dtype=np.int64)
        self.marked = np.array([b[:1] == b" " for b in self.bytes])


_LOADED: dict = {}


def load(path_a: str, path_b: str, pattern: str | None) -> tuple[Side, Side]:
    """Both sides, loaded once a worker."""
    key = (path_a, path_b, pattern)
    if key not in _LOADED:
        _LOADED[key] = Side(ByteLevel(path_a, pattern)), Side(Pieces(path_b))
    return _LOADED[key]


def encode_both(a: Side, b: Side, text: str, piece_chars: int = PIECE_CHARS) -> tuple[np.ndarray, np.ndarray, bool] | None:
    """Ids of both sides, and whether the first one's bytes are certain; None where
    the byte lengths are not that of a space and the text."""
    pieces, at = [], 0
    if len(text) > piece_chars and b.encode.cuttable:
        for cut in SAFE_CUT.finditer(text):
            if cut.start() - at >= piece_chars:
                pieces.append(text[at:cut.start()])
                at = cut.end()
    pieces.append(text[at:])
    found = [(*a.encode(" " + piece), b.encode(piece)) for piece in pieces]  # each lacks the space before it, as the text does
    x, y = (found[0][k] if len(found) == 1 else np.concatenate([f[k] for f in found]) for k in (0, 2))
    size = 1 + (len(text) if text.isascii() else len(text.encode()))
    return (x, y, all(f[1] for f in found)) if a.length[x].sum() == b.length[y].sum() == size else None


def _between(first: int | None, middle: np.ndarray, last: int | None = None) -> np.ndarray:
    """The values with one before and one behind them, where given."""
    out = np.empty(len(middle) + (first is not None) + (last is not None), dtype=np.int64)
    lo = int(first is not None)
    out[lo:lo + len(middle)] = middle
    if first is not None:
        out[0] = first
    if last is not None:
        out[-1] = last
    return out


def cuts(a: Side, b: Side, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of both sides at which windows begin, and the ends: the anchors.

    Both sides have the same length in bytes; that they are the same bytes is
    verified window by window (``Block``).
    """
    end_a, end_b = np.cumsum(a.length[x]), np.cumsum(b.length[y])
    here = np.zeros(int(end_a[-1]) + 1, dtype=np.int8)
    here[end_a] = 1
    here[end_b] += 2
    shared_a, shared_b = here[end_a[:-1]] == 3, here[end_b[:-1]] == 3
    # The k-th shared end is the same place on both sides.
    mark_a, mark_b = a.marked[x[1:]][shared_a], b.marked[y[1:]][shared_b]
    both = mark_a & mark_b
    at_a, at_b = np.flatnonzero(shared_a)[both] + 1, np.flatnonzero(shared_b)[both] + 1
    return _between(0, at_a, len(x)), _between(0, at_b, len(y))


def id_names(x: np.ndarray, y: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[bytes]:
    """Of each window both id tuples as one value: the ids of one side, then the complements of the other's."""
    n_a, n_b = np.diff(at_a), np.diff(at_b)
    both = np.empty(len(x) + len(y), dtype=np.int32)
    both[np.arange(len(x)) + np.repeat(at_b[:-1], n_a)] = x
    both[np.arange(len(y)) + np.repeat(at_a[1:], n_b)] = ~y
    raw, edge = both.tobytes(), (4 * (at_a + at_b)).tolist()
    return [raw[i:j] for i, j in zip(edge, edge[1:])]


AlignedWindow = tuple[int, bytes, bytes, bytes | None, int, int]


class Aligner:
    """Alignments of windows: groups, their digest text, the linked (a, b) as a << 32 | b in eight bytes, one
    for each link, the window's bytes (None where the sides differ), and its tokens on both sides."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.ids = max(len(a.bytes), len(b.bytes))
        self.text = [f"{sep}{i}".encode() for sep in ("", ",", "|", ";") for i in range(self.ids)]

    def __call__(self, x: np.ndarray, y: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[AlignedWindow]:
        """Of windows laid end to end, which begin at tokens ``at_a`` and ``at_b`` (the ends included)."""
        end_a, end_b = np.cumsum(self.a.length[x]), np.cumsum(self.b.length[y])
        here = np.zeros(int(end_a[-1]) + 1, dtype=np.int8)
        here[end_a] = 1
        here[end_b] += 2
        ends = np.flatnonzero(here)  # a link for each stretch between neighbouring ends of either side
        of_a, of_b, shared = here[ends] & 1, here[ends] >> 1, here[ends] == 3
        links = x[np.cumsum(of_a) - of_a].astype(np.int64) << 32 | y[np.cumsum(of_b) - of_b]
        window_end = end_a[at_a[1:] - 1]
        link_at = _between(0, np.searchsorted(ends, window_end) + 1)
        group_at = _between(0, np.cumsum(shared))[link_at].tolist()
        first_a = _between(0, np.flatnonzero(here[end_a] == 3) + 1)
        first_b = _between(0, np.flatnonzero(here[end_b] == 3) + 1)
        x, y = x.astype(np.int64), y.astype(np.int64)
        code_a, code_b = x + self.ids, y + self.ids  # a comma before each, but
        code_a[first_a[:-1]] = x[first_a[:-1]] + 3 * self.ids
        code_a[at_a[:-1]] = x[at_a[:-1]]
        code_b[first_b[:-1]] = y[first_b[:-1]] + 2 * self.ids
        code = np.empty(len(x) + len(y), dtype=np.int64)
        code[np.arange(len(x)) + np.repeat(first_b[:-1], np.diff(first_a))] = code_a
        code[np.arange(len(y)) + np.repeat(first_a[1:], np.diff(first_b))] = code_b
        parts, pairs, text = code.tolist(), links.tobytes(), self.text.__getitem__
        token_at, link_at = (at_a + at_b).tolist(), (8 * link_at).tolist()
        raw_a, raw_b = (b"".join(map(side.bytes.__getitem__, v.tolist())) for side, v in ((self.a, x), (self.b, y)))
        edge = _between(0, window_end).tolist()
        alike = raw_a == raw_b
        raw = [raw_a[i:j] if alike or raw_a[i:j] == raw_b[i:j] else None for i, j in zip(edge, edge[1:])]
        n_a, n_b = np.diff(at_a).tolist(), np.diff(at_b).tolist()
        return [(group_at[k + 1] - group_at[k], b"".join(map(text, parts[token_at[k]:token_at[k + 1]])), pairs[link_at[k]:link_at[k + 1]], raw[k],
                 n_a[k], n_b[k])
                for k in range(len(at_a) - 1)]

    def some(self, x: np.ndarray, y: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, wanted: list[int]) -> list[AlignedWindow]:
        """Of the windows ``wanted`` of a document."""
        wanted = np.array(wanted, dtype=np.int64)

        def gather(v, at):
            lo = at[wanted]
            n = at[wanted + 1] - lo
            edge = _between(0, np.cumsum(n))
            return v[np.arange(edge[-1]) + np.repeat(lo - edge[:-1], n)], edge
        (x, at_a), (y, at_b) = gather(x, at_a), gather(y, at_b)
        return self(x, y, at_a, at_b)


def words_of(text: str) -> list[str]:
    """A space and the text, cut where white space follows another character."""
    return WORD_CUT.split(" " + text) if ANY_UNSURE.search(text) else WORD.findall(" " + text)


#: Of a word whose bytes differ on some side.
UNLIKE: AlignedWindow = (0, b"", b"", None, 0, 0)


def align_words(aligner: Aligner, words: list[str]) -> list[AlignedWindow]:
    """Windows of words as ``words_of`` gives them; one that ends in white space has to be the last."""
    both = encode_both(aligner.a, aligner.b, "a" + "".join(words))
    if both is not None:
        x, y, _ = both
        raw = [word.encode() for word in words]
        ends = np.cumsum([2, *map(len, raw)])  # the first is that of the letter before them
        end_a, end_b = np.cumsum(aligner.a.length[x]), np.cumsum(aligner.b.length[y])
        last_a, last_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        if (end_a[last_a] == ends).all() and (end_b[last_b] == ends).all():
            found = aligner(x, y, _between(0, last_a + 1), _between(0, last_b + 1))[1:]
            return [w if w[3] == r else UNLIKE for w, r in zip(found, raw)]
    if len(words) == 1:
        return [UNLIKE]
    return [align_words(aligner, [word])[0] for word in words]


NO_WINDOWS = np.zeros(0, dtype=np.int32)


class Block:
    """Documents gathered until they hold enough windows."""

    def __init__(self):
        self.numbers: dict[str | bytes, int] = {}  # by the word, or by both id tuples
        self.windows: list[AlignedWindow] = []
        self.texts: list[bytes] = []
        self.unlike: set[int] = set()  # windows whose sides differ
        self.docs: list[tuple] = []
        self.held = 0

    def number(self, name: str | bytes, window: AlignedWindow) -> None:
        self.numbers[name] = number = len(self.texts)
        if window[3] is None:
            self.unlike.add(number)
        self.windows.append(window)
        self.texts.append(window[1])
        self.held += len(window[2]) // (8 * WINDOW_LINKS)

    def holds(self, found: list[int], text: str, certain: bool) -> bool:
        """Whether both sides' bytes are a space and the text: they are alike in every window, and the first one's are."""
        if self.unlike and not self.unlike.isdisjoint(found):
            return False
        return certain or b"".join([self.windows[f][3] for f in found]) == b" " + text.encode()

    def add(self, key, found: list[int], numbered: np.ndarray) -> None:
        sha = hashlib.sha256(b";".join(map(self.texts.__getitem__, found))).hexdigest() if found else ""
        self.docs.append((key, sha, numbered))
        self.held += len(found) + 1

    def rows(self, name: int, id_type: pa.DataType):
        """Record batches of the block: its documents, its windows' pairs, and its distinct pairs."""
        groups, n_a, n_b = (np.array([w[k] for w in self.windows], dtype=np.int64) for k in (0, 4, 5))
        sizes = np.array([len(w[2]) >> 3 for w in self.windows], dtype=np.int64)
        seen = np.bincount(np.concatenate([d[2] for d in self.docs]), minlength=len(groups))
        flat = np.frombuffer(b"".join([w[2] for w in self.windows]), dtype=np.int64)
        pairs, code = np.unique(flat, return_inverse=True)
        counts = np.bincount(code, weights=np.repeat(seen, sizes), minlength=len(pairs)).astype(np.int64)
        schema = block_schema(id_type)
        for at in range(0, len(self.docs), 1024):
            ids, shas, found = zip(*self.docs[at:at + 1024])
            sums = {col: [int(v[f].sum()) for f in found] for col, v in (("n_a", n_a), ("n_b", n_b), ("n_groups", groups), ("n_links", sizes))}
            yield _batch(schema, len(ids), block=name, kind=0, id=ids, groups_sha256=shas, codes=[f.tobytes() for f in found], **sums)
        yield _batch(schema, 1, block=name, kind=1, codes=[code.astype(np.int32).tobytes()], sizes=[sizes.astype(np.int32).tobytes()])
        for at in range(0, len(pairs), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield _batch(schema, len(pairs[part]), block=name, kind=2, a=pairs[part] >> 32, b=pairs[part] & 0xFFFFFFFF, n=counts[part],
                         code=np.arange(len(pairs), dtype=np.int64)[part])


def block_schema(id_type: pa.DataType) -> pa.Schema:
    return pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("id", id_type), ("n_a", pa.int64()), ("n_b", pa.int64()),
                      ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("codes", pa.binary()),
                      ("sizes", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("code", pa.int64())])


def _batch(schema: pa.Schema, rows: int, **given) -> pa.RecordBatch:
    cols = []
    for f in schema:
        v = given.get(f.name)
        cols.append(pa.array([v] * rows, f.type) if isinstance(v, int) else pa.nulls(rows, f.type) if v is None else pa.array(v, f.type))
    return pa.record_batch(cols, schema=schema)


def _blocks(path_a: str, path_b: str, pattern: str | None, id_type: pa.DataType, block_windows: int):
    """Documents (id, text) to the rows of their blocks."""
    def run(batches):
        a, b = load(path_a, path_b, pattern)
        part, made = TaskContext.get().partitionId(), 0
        aligner, memo = Aligner(a, b), {}
        by_words = a.encode.cuttable and b.encode.cuttable
        block = Block()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                both, names, certain = None, [], True
                if (s := text.as_py()) and by_words:
                    names = words_of(s)
                elif s and (both := encode_both(a, b, s)) is not None:
                    x, y, certain = both
                    at_a, at_b = cuts(a, b, x, y)
                    names = id_names(x, y, at_a, at_b)
                found = list(map(block.numbers.get, names, repeat(-1)))
                numbered = np.array(found, dtype=np.int32)
                missing = np.flatnonzero(numbered < 0).tolist()
                if missing:
                    first: dict[str | bytes, int] = {}
                    for k in missing:
                        first.setdefault(names[k], k)
                    new = [name for name in first if name not in memo]
                    if len(memo) + len(new) > MEMO_WINDOWS and memo:
                        memo.clear()
                        new = list(first)
                    fresh = {}
                    if new:
                        fresh = dict(zip(new, align_words(aligner, new) if by_words else aligner.some(x, y, at_a, at_b, [first[name] for name in new])))
                        memo.update(fresh if not by_words else {name: w for name, w in fresh.items() if len(name) <= MEMO_CHARS})
                    for name in first:
                        block.number(name, fresh[name] if name in fresh else memo[name])
                    for k in missing:
                        found[k] = numbered[k] = block.numbers[names[k]]
                if names and block.holds(found, s, certain):
                    block.add(key, found, numbered)
                else:
                    block.add(key, [], NO_WINDOWS)
                if block.held >= block_windows:
                    yield from block.rows(part << 32 | made, id_type)
                    block, made = Block(), made + 1
        if block.docs:
            yield from block.rows(part << 32 | made, id_type)

    def without_collector(batches):
        # The tables hold no cycles; looking for some in them again and again takes most of the time.
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()
    return without_collector


def _sums(kind: str):
    """A block's documents and its pairs' corpus-wide counts to the documents' sums."""
    def run(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        is_table = docs.column("kind").to_numpy() == 1
        table = docs.filter(pa.array(is_table)).to_pylist()[0]
        code, sizes = np.frombuffer(table["codes"], dtype=np.int32), np.frombuffer(table["sizes"], dtype=np.int32)
        by = np.zeros((2, pairs.num_rows), dtype=np.int64)
        at = pairs.column("code").to_numpy()
        by[0, at], by[1, at] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy()
        starts = np.r_[0, np.cumsum(sizes)]
        total = [np.r_[0, np.cumsum(x[code])] for x in by]
        window = [t[starts[1:]] - t[starts[:-1]] for t in total]
        rest = docs.filter(pa.array(~is_table))
        found = [np.frombuffer(c, dtype=np.int32) for c in rest.column("codes").to_pylist()]
        sums = [pa.array([int(w[f].sum()) for f in found], pa.int64()) for w in window]
        return pa.table([*(rest.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")), sums[1], sums[0], rest.column("groups_sha256")],
                        names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
    return run


def align_tokens(docs: DataFrame, path_a: str, path_b: str, pattern: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``path_a`` is a byte-level BPE file, ``path_b`` a sentencepiece model;
    ``pattern`` is the first one's word pattern, where a faster library may
    use it (see ``ByteLevel``).
    """
    blocks = _written_blocks(docs, path_a, path_b, pattern, id_col, text_col, block_windows)
    kind = docs.schema[id_col].dataType.simpleString()
    counted = blocks.where("kind = 2").join(pair_counts(blocks), ["a", "b"]).select(
        F.col("block").alias("home"), "code", "count", F.col("best").cast("long").alias("best"))
    held = blocks.where("kind < 2").select("block", "kind", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "sizes")
    out = held.groupBy("block").cogroup(counted.groupBy("home")).applyInArrow(
        _sums(kind), f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("id", id_col)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``a``, ``b``, ``count`` (links of the pair corpus-wide) and ``best``: whether it is the greatest of its ``b``.

    The window of an id holds at most one row for each id of the other vocabulary.
    """
    counts = blocks.where("kind = 2").groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def _written_blocks(docs: DataFrame, path_a: str, path_b: str, pattern: str | None, id_col: str, text_col: str, block_windows: int) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    id_type = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()
    schema = (f"block long, kind int, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, "
              "sizes binary, a long, b long, n long, code long")
    return written(rows.mapInArrow(_blocks(path_a, path_b, pattern, id_type, block_windows), schema), "token-blocks")
