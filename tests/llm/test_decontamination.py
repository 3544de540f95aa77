from __future__ import annotations

import hashlib

import numpy as np

from tests.llm.corpus import ALNUM, LOWER, documents, empty, multiset, rows
from vecindad.llm import decontamination

ITEMS = "item_id long, text string, n long"


def words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def items():
    texts = [r[1] for r in rows()]
    return [
        (1, " ".join(texts[0].split()[5:40]), 0),
        (2, "not, in: any text of this corpus at all really none", 0),
        (3, "One two THREE", 0),
        (4, None, 0),
        (5, "?!", 0),
        (11, " ".join(texts[8].split()[3:13]).upper(), 0),
        (11, " ".join(texts[8].split()[3:13]).upper(), 0),
        (12, "x x x x x x x x x x x x", 0),
    ]


def brute(texts):
    windows: dict[tuple, set] = {}
    for item, text, _ in items():
        w = words(text)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    for doc, text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    found |= windows[tuple(w[k : k + size])]
                    hit.update(range(k, k + size))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield doc, len(w), len(hit), len(found), digest, bool(hit)


def test_against_brute_force(spark):
    got = decontamination.contamination(documents(spark), spark.createDataFrame(items(), ITEMS)).collect()
    assert multiset(map(tuple, got)) == multiset(brute([r[:2] for r in rows()]))
    assert any(r.contaminated for r in got)


def test_blocks_give_the_same(spark, monkeypatch):
    bench = spark.createDataFrame(items(), ITEMS)
    whole = multiset(map(tuple, decontamination.contamination(documents(spark), bench).collect()))
    small = decontamination.blocks
    monkeypatch.setattr(decontamination, "blocks", lambda frame: small(frame, 40))
    assert multiset(map(tuple, decontamination.contamination(documents(spark), bench).collect())) == whole


def test_clean_leaves_no_window(spark):
    docs, bench = documents(spark), spark.createDataFrame(items(), ITEMS)
    cleaned = decontamination.clean(docs, bench)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    again = decontamination.contamination(cleaned.where("doc_id in (0, 8)"), bench)
    assert again.where("contaminated").count() == 0
    assert decontamination.without("a b, c d", np.array([1, 2])) == "a  d"


def test_empty(spark):
    nothing = spark.createDataFrame([], ITEMS)
    assert decontamination.contamination(documents(spark), nothing).where("contaminated").count() == 0
    assert decontamination.contamination(empty(spark), spark.createDataFrame(items(), ITEMS)).count() == 0


def test_index_finds_every_place():
    rng = np.random.default_rng(3)
    text = np.append(rng.integers(1, 6, 500), 0).astype(np.int64)
    index = decontamination.FMIndex(text, 6)
    phrases = rng.integers(1, 6, (40, 4))
    low, high = index.ranges(phrases)
    for line, a, b in zip(phrases, low, high, strict=True):
        found = sorted(index.locate(np.arange(a, b)).tolist())
        assert found == [k for k in range(len(text) - 3) if (text[k : k + 4] == line).all()]
