from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter

import pytest

from tests.llm.corpus import documents, empty, multiset, rows
from vecindad.llm import alignment

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def plain():
    """Both tokenizers as their libraries run them, on whole texts."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    letters = alignment._byte_of_letter()

    def tokens(text: str):
        one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            two.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        return one, two

    return tokens


def brute(tokens, text):
    """(n_a, n_b, groups, links) of a text by byte offsets."""
    if not text:
        return 0, 0, [], []
    one, two = tokens(text)
    if not b"".join(x for _, x in one) == b"".join(x for _, x in two) == (" " + text).encode():
        return 0, 0, [], []

    def ends(parts):
        at, out = 0, {}
        for i, data in parts:
            at += len(data)
            out[at] = i
        return out

    first, second = ends(one), ends(two)
    cuts = [0, *sorted({*first} & {*second})]
    links = [(first[e], second[e]) for e in cuts[1:]]
    groups = []
    for side in (first, second):
        parts = [[] for _ in cuts]
        for e in sorted(side):
            parts[bisect_left(cuts, e)].append(side[e])
        groups.append(parts[1:])
    groups = list(zip(*groups, strict=True))
    n_a, n_b = (sum(len(g[k]) for g in groups) for k in (0, 1))
    return n_a, n_b, groups, links


AWKWARD = [
    "<|endoftext|> <s> </s> <unk> <0x41> <0x0A>",
    "a▁b",
    "  two  spaces \n  and\t\ttabs \r\n end ",
    "don't we'll 12345 3.14 !!?? ...",
    "日本語のテキスト и русский текст",
    "emoji 👩‍👩‍👧 é ﬁ Å nbsp　wide",
    " ", "\n", "\n\n x", "x \n  y", "\x1c!\x1d", "﻿bom",
    "Straße façade naïve œuvre",
]


def test_against_brute_force(spark, plain):
    data = rows()
    for k, text in enumerate(AWKWARD):
        data.append((1000 + k, text, "en", "s", 0, "x", 1, 2))
    data.append(data[-1])
    found = {}
    for row in alignment.alignment(documents(spark, data)).collect():
        found.setdefault((row["doc_id"], row["groups_sha256"]), []).append(row)
    plans = [(r[0], brute(plain, r[1])) for r in data]
    counts = Counter(link for _, (_, _, _, links) in plans for link in links)
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    expected = []
    for doc, (n_a, n_b, groups, links) in plans:
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        best = sum(counts[x] == highest[x[1]] for x in links)
        digest = hashlib.sha256(written.encode()).hexdigest() if n_a else ""
        expected.append((doc, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest))
    got = [tuple(r) for rs in found.values() for r in rs]
    assert multiset(got) == multiset(expected)


def test_cut_texts_equal_whole_ones(plain):
    """Random texts of many kinds of character, cut or not, have the tokens of the libraries."""
    rng = random.Random(3)
    letters = list("abcdeiou  \n\t.,'12ßéñ€—") + ["'s", "'ll", "\r", "\r\n", ";\r", " \r", "  ", " \n ", "日", "я", " ", "\x1f", "<s>"]
    two = alignment.Aligner(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
    assert len(two.parts("some words;\r\nof a text\n")) == 5
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(3000)]
    for at in range(0, len(texts), 150):
        some = texts[at : at + 150]
        for text, chunks in zip(some, two.align(some), strict=True):
            assert "".join(two.parts(text)) == " " + text
            n_a, n_b, groups, _ = brute(plain, text)
            if chunks is None:
                assert n_a == 0, repr(text)
                continue
            written = b";".join(c.text for c in chunks).decode()
            assert written == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups), repr(text)
            assert (sum(c.n_a for c in chunks), sum(c.n_b for c in chunks)) == (n_a, n_b)


def test_spans_cover_the_text(spark):
    some = [(1, "Some words, and Größe."), (2, None), (3, "a▁b")]
    got = alignment.spans(spark.createDataFrame(some, "doc_id long, text string")).orderBy("doc_id", "start").collect()
    assert {r["doc_id"] for r in got} == {1}
    assert got[0]["start"] == 0 and got[-1]["end"] == len(" Some words, and Größe.".encode())
    assert all(x["end"] == y["start"] for x, y in zip(got, got[1:], strict=False))


def test_empty_table(spark):
    frame = alignment.alignment(empty(spark))
    assert frame.count() == 0 and frame.columns[0] == "doc_id"
