import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as files
import pytest

from corpusforge.llm import token_windows as T
from corpusforge.llm.queries import op12_token_alignment

SF = "/root/testdata/sf0.001"
A, B = files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model")
COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def sides():
    return T.load(A, B, files.PATTERN)


def slow_tokens(text):
    """(id, bytes) of both sides from the libraries alone, or None."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders
    if not text:
        return None
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    level = T.byte_alphabet()
    assert decoders.ByteLevel().decode([k for k, v in level.items() if v < 128]) == bytes(v for v in level.values() if v < 128).decode()
    x = [(i, bytes(level[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    raw = b" " + text.encode()
    return (x, y) if b"".join(z for _, z in x) == raw == b"".join(z for _, z in y) else None


def slow_align(texts):
    per, counts = [], Counter()
    for text in texts:
        both = slow_tokens(text)
        if both is None:
            per.append((0, 0, 0, [], ""))
            continue
        spans = []
        for side in both:
            at, out = 0, []
            for i, z in side:
                out.append((at, at + len(z), i))
                at += len(z)
            spans.append(out)
        links = [(i, j) for p, q, i in spans[0] for r, s, j in spans[1] if p < s and r < q]
        ends = sorted({q for _, q, _ in spans[0]} & {q for _, q, _ in spans[1]})
        groups = []
        for lo, hi in zip([0] + ends, ends):
            groups.append("|".join(",".join(str(i) for p, q, i in s if lo <= p and q <= hi) for s in spans))
        counts.update(links)
        per.append((len(both[0]), len(both[1]), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = Counter()
    for (_, j), c in counts.items():
        best[j] = max(best[j], c)
    return [(a, b, g, len(l), sum(counts[x] == best[x[1]] for x in l), sum(counts[x] for x in l), sha) for a, b, g, l, sha in per]


def test_byte_table_and_fast_library(sides, spark):
    a, b = sides
    assert a.encode.fast is not None and b.encode.cuttable
    assert b"".join(a.bytes[i] for i in a.encode.own.encode("žába 漢\n x").ids) == "žába 漢\n x".encode()
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [f"{x}{chr(c)}{y}" for c in range(0x180) for x, y in (("", ""), ("a", "a"), (" ", " "), ("  ", "b"), ("1", "1"), (".", "."), ("'", "s"))]
    for t in texts:
        ids, certain = a.encode(" " + t)
        assert not certain or b"".join(a.bytes[i] for i in ids) == b" " + t.encode()
        assert ids.tolist() == a.encode.own.encode(" " + t, add_special_tokens=False).ids


def test_pieces_of_long_texts_give_the_tokens_of_the_whole(sides, spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text]
    texts += ["漢字 kana  two   three \n four\t five", " lead", "x" * 999 + " y " * 50, "a  b 　c d"]
    for t in texts:
        cut, whole = T.encode_both(*sides, t, 40), T.encode_both(*sides, t)
        assert cut is whole is None or all((p == q).all() for p, q in zip(cut[:2], whole[:2], strict=True))


def test_windows_cover_and_agree(sides):
    a, b = sides
    text = "Alignment of unbelievably  odd words: façade, naïveté, 12345 and x==y\n\tdone " * 3
    x, y = (np.array(v, dtype=np.int32) for v in T.encode_both(a, b, text)[:2])
    at_a, at_b = T.cuts(a, b, x, y)
    assert len(at_a) == len(at_b) > 20
    join = lambda s, v: b"".join(s.bytes[i] for i in v)
    for k in range(len(at_a) - 1):
        p, q = join(a, x[at_a[k]:at_a[k + 1]]), join(b, y[at_b[k]:at_b[k + 1]])
        assert p == q and p[:1] == b" "
    aligner = T.Aligner(a, b)
    whole = aligner(x, y, at_a, at_b)
    assert whole[3:6] == aligner.some(x, y, at_a, at_b, [3, 4, 5])
    assert whole == [aligner(x[i:j], y[k:l], np.array([0, j - i]), np.array([0, l - k]))[0] for i, j, k, l in zip(at_a, at_a[1:], at_b, at_b[1:])]


TEXTS = [None, "", "a", "Hello <|endoftext|> </s> world", "▁ is no space", "tabs\tand\nlines  and   spaces ", " ", "漢字 and émigré", "same same same", "same same same",
         "x" * 3000, "null\x00byte", "straße   nbsp 　 wide"]


def test_odd_rows_against_brute_force(spark):
    rows = [(i if i != 7 else None, t, "n_a") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string")
    want = sorted(((i if i != 7 else None, *r) for i, r in enumerate(slow_align(TEXTS))), key=str)
    for size in (T.BLOCK_WINDOWS, 3):  # all in a block, and a few to each
        got = T.align_tokens(df.coalesce(1), A, B, files.PATTERN, block_windows=size)
        assert got.columns == COLS and sorted((tuple(r) for r in got.collect()), key=str) == want
    assert T.align_tokens(df.limit(0), A, B).count() == 0
    plain = T.align_tokens(df, A, B)  # without the faster library
    assert sorted((tuple(r) for r in plain.collect()), key=str) == want


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = [tuple(r) for r in op12_token_alignment(spark, SF).orderBy("doc_id").collect()]
    short = [d for d in docs if len(d.text or "") < 1200][:40]
    # Counts need the whole corpus, the rest of a row only its text.
    of = {r[0]: r for r in got}
    for d, want in zip(short, slow_align([d.text for d in short])):
        assert of[d.doc_id][1:5] == want[:4] and of[d.doc_id][7] == want[6]
    assert len(got) == len(docs)
    some = spark.createDataFrame([(d.doc_id, d.text) for d in short], "doc_id long, text string")
    assert [tuple(r)[1:] for r in T.align_tokens(some, A, B, files.PATTERN).orderBy("doc_id").collect()] == slow_align([d.text for d in short])
