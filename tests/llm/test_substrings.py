from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from tests.llm.corpus import SPACED, documents, empty, multiset, rows
from vecindad.llm import substrings


def removed(texts, window):
    split = [SPACED.findall(t or "") for t in texts]
    count = Counter(tuple(w[k : k + window]) for w in split for k in range(len(w) - window + 1))
    for w in split:
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        yield w, gone


@pytest.mark.parametrize("window", [35, 6])
def test_against_brute_force(spark, window):
    got = substrings.repeated(documents(spark), window).collect()
    expected = []
    for row, (w, gone) in zip(rows(), removed([r[1] for r in rows()], window), strict=True):
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        expected.append((row[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert multiset(map(tuple, got)) == multiset(expected)
    assert 0 < sum(e[2] for e in expected) < sum(e[1] for e in expected)


def test_clean_keeps_the_other_words(spark):
    docs = documents(spark)
    got = substrings.clean(docs)
    assert got.columns == docs.columns
    expected = [
        (row[0], [x for k, x in enumerate(w) if k not in gone])
        for row, (w, gone) in zip(rows(), removed([r[1] for r in rows()], 35), strict=True)
    ]
    assert multiset((r.doc_id, SPACED.findall(r.text or "")) for r in got.collect()) == multiset(expected)


def test_empty(spark):
    assert substrings.repeated(empty(spark)).count() == 0
