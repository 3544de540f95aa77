from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.corpus import documents, empty, rows
from vecindad.llm import packing

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")


def encode(text):
    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return whole.encode(text or "", add_special_tokens=False).ids + [packing.END]


def test_round_trip(spark):
    pieces = packing.pack(documents(spark)).collect()
    expected = sorted(zlib.crc32(np.array(encode(r[1]), "<u4").tobytes()) for r in rows() if len(encode(r[1])) <= 2048)
    whole = sorted(p.ids_crc32 for p in pieces if p.start == 0 and p.length == p.doc_tokens)
    for value in whole:
        assert value in expected
    assert sum(p.length for p in pieces) == sum(len(encode(r[1])) for r in rows())

    windows = defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
    padded = 0
    for parts in windows.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        padded += at & (at - 1) != 0
    assert padded <= 3  # one for each partition


def test_ids_of_cut_documents(spark):
    text = " ".join(f"word{k} Straße" for k in range(3000))
    some = [(1, text, None, None, None, None, None, None), (2, "Ω≈ç √ <|endoftext|> İ", None, None, None, None, None, None)]
    pieces = packing.pack(documents(spark, some)).collect()
    for doc, ids in ((1, encode(text)), (2, encode(some[1][1]))):
        ids, at = np.array(ids, "<u4"), 0
        for p in sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_step_groups_are_even():
    packer = packing.Packer()
    rng = np.random.default_rng(0)
    for k in range(3000):
        packer.add(k, np.ones(rng.integers(1, 3000), "<u4"))
    sizes = defaultdict(int)
    for tier, window in packer.windows(True):
        sizes[tier] += 1
        if tier in packing.TIERS and sizes:
            assert sum(len(p.ids) for p in window) <= tier
    assert set(sizes) <= set(packing.TIERS)


def test_empty(spark):
    assert packing.pack(empty(spark)).count() == 0
