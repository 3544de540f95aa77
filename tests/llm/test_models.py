"""Fitted operators: held-out accuracy, exact base scores, and the awkward cases."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.corpus import LOWER, SPACED, documents, empty, fold, multiset, rows
from vecindad.llm import class_ngrams, rule_ensemble, toxicity
from vecindad.llm.words import byte_codes, spaced, words

LABELS = "doc_id long, quality int, toxic int, text string"


def accuracy(scores: dict, truth: dict, threshold: float) -> float:
    held = [k for k in truth if fold(k, 5) == 0]
    assert len(held) > 40
    return sum((scores[k] >= threshold) == truth[k] for k in held) / len(held)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(9)
    some, truth = [], {}
    for k in range(400):
        sentences = [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(2, 9))]
        toxic, junk = k % 4 == 0, k % 5 == 1
        if toxic:
            sentences.insert(rng.randrange(len(sentences)), f"you {rng.choice(['idiotic', 'idioting', 'scum'])} w1")
        text = ". ".join(sentences) + "."
        some.append((k, text.replace(" ", "### ") if junk else text, None, None, None, None, None, None))
        truth[k] = (not junk, toxic)
    some += [(1000, None, None, None, None, None, None, None), (1001, "", None, None, None, None, None, None), some[0]]
    labels = [(k, int(q), int(t), "clash") for k, (q, t) in truth.items()] + [(None, 1, 1, ""), (5000, 1, 1, ""), (1, None, None, "")]
    return some, labels, truth


def test_toxicity(spark, labelled):
    some, labels, truth = labelled
    docs, known = documents(spark, some), spark.createDataFrame(labels, LABELS)
    got = toxicity.scored(docs, toxicity.fit(docs, known)).collect()
    assert len(got) == len(some)
    scores = {r.doc_id: r.score for r in got}
    assert accuracy(scores, {k: t for k, (_, t) in truth.items()}, 0.5) > 0.95
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5) for r in got)
    assert scores[1000] == scores[1001] == 0
    for r in got:
        if r.doc_id in truth and truth[r.doc_id][1] and r.predicted:
            assert all("idiot" in s or "scum" in s for s in r.sentences)
    none = toxicity.fit(docs, known.where("toxic = 0"))
    assert {r.score for r in toxicity.scored(docs, none).collect()} == {0.0}
    assert toxicity.scored(empty(spark), toxicity.fit(docs, known)).count() == 0


def test_rule_ensemble(spark, labelled):
    some, labels, truth = labelled
    docs, known = documents(spark, some), spark.createDataFrame(labels, LABELS)
    got = rule_ensemble.scored(docs, known).collect()
    assert len(got) == len(some) and all(0 <= r.score <= 1 for r in got)
    assert accuracy({r.doc_id: r.score for r in got}, {k: q for k, (q, _) in truth.items()}, 0.3) > 0.95
    one = rule_ensemble.scored(docs, known.where("quality = 1")).collect()
    assert all(r.score > 0.99 for r in one)
    assert {r.score for r in rule_ensemble.scored(docs, known.where("quality = 7")).collect()} == {0.5}


def test_rules_of_a_printed_tree():
    text = "Tree\n  If (feature 0 <= 1.5)\n   If (feature 1 > 2.0)\n    Predict: 0.0\n   Else (feature 1 <= 2.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n"
    a, b = rule_ensemble.FEATURES[:2]
    assert rule_ensemble.tree_rules(text) == [
        ((a, False, 1.5),),
        ((a, False, 1.5), (b, True, 2.0)),
        ((a, False, 1.5), (b, False, 2.0)),
        ((a, True, 1.5),),
    ]
    assert rule_ensemble.simplified(((a, True, 1.0), (b, False, 3.0), (a, True, 2.0))) == tuple(
        sorted([(a, True, 2.0), (b, False, 3.0)])
    )


def base_scores(some):
    split = [SPACED.findall((r[1] or "").translate(LOWER)) + ["\n"] for r in some]
    count = Counter(w for r, own in zip(some, split, strict=True) if fold(r[0], 7) != 2 for w in own)
    total, types = sum(count.values()), len(count)
    for r, own in zip(some, split, strict=True):
        score = sum(math.log10((count[w] + 1) / (total + types + 1)) for w in own)
        yield r[0], fold(r[0], 7) == 2, len(own), sum(count[w] > 0 for w in own), total, round(score, 6)


def coded(text) -> list[int]:
    """The hashes that the operator knows the words of a text by, and the end."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    w = words(raw, np.array([0, len(raw)]), spaced(), byte_codes(True))
    return [int(c) for c in w.code.view(np.int64)] + [int(class_ngrams.END.view(np.int64))]


def class_scores(some, kind, other, k):
    """Scores of the formula in plain Python, from the class of each word; unseen words have their bucket's."""
    split = [coded(r[1]) for r in some]
    held = [fold(r[0], 7) == 2 for r in some]
    count = Counter(w for h, s in zip(held, split, strict=True) if not h for w in s)
    end = split[0][-1]

    def classes(s):
        return [kind[w] if w in kind else other[w] for w in [end, *s]]

    pairs, tokens, types = Counter(), Counter(), Counter(kind[w] for w in count)
    for h, s in zip(held, split, strict=True):
        if not h:
            c = classes(s)
            pairs.update(zip(c, c[1:]))
            tokens.update(c[1:])
    follow = Counter()
    for (a, _), n in pairs.items():
        follow[a] += n
    for s in split:
        c = classes(s)
        yield sum(
            math.log10((pairs[a, b] + class_ngrams.SMOOTHING) / (follow[a] + class_ngrams.SMOOTHING * k))
            + math.log10((count[w] + 1) / (tokens[b] + types[b] + 1))
            for w, a, b in zip(s, c, c[1:])
        )


@pytest.mark.parametrize("common", [1e-6, 2e-3, 0.5])
def test_class_ngrams(spark, monkeypatch, common):
    """Base and class scores equal plain Python's, wherever a word is looked up."""
    monkeypatch.setattr(class_ngrams, "COMMON_SHARE", common)
    monkeypatch.setattr(class_ngrams, "CORE_SHARE", 4e-3)
    fitted = []
    fit = class_ngrams.fit
    monkeypatch.setattr(class_ngrams, "fit", lambda *a: fitted.append(fit(*a)) or fitted[0])
    some = rows()
    got = class_ngrams.scored(documents(spark), classes=6, rounds=2).collect()
    assert multiset((*tuple(r)[:5], round(r.base_score, 6)) for r in got) == multiset(base_scores(some))
    model, kinds = fitted[0]
    kind = {r.word: r.kind for r in kinds.collect()}
    other = {}
    for r in some:
        raw = np.frombuffer((r[1] or "").encode(), np.uint8)
        w = words(raw, np.array([0, len(raw)]), spaced(), byte_codes(True))
        code, bucket, _ = class_ngrams._sequence(w, raw)
        other |= zip((int(c) for c in code.view(np.int64)), (int(c) for c in model.bucket_kind[bucket]), strict=True)
    want = class_scores(some, kind, other, 6)
    assert multiset((r.doc_id, round(r.score, 6)) for r in got) == multiset(
        (r[0], round(s, 6)) for r, s in zip(some, want, strict=True)
    )
    # Rare words have their bucket's class, others a class of their own choice.
    split = [coded(r[1]) for r in some if fold(r[0], 7) != 2]
    count = Counter(w for s in split for w in s)
    assert set(kind) == set(count)
    assert all(kind[w] == other[w] for w in count if count[w] < class_ngrams.OWN)
    assert any(kind[w] != other[w] for w in count if count[w] >= class_ngrams.OWN)


def test_words_are_placed_where_the_likelihood_grows_most():
    rng = np.random.default_rng(3)
    k = 5
    matrix = rng.integers(20, 200, (k, k)).astype(float)
    f = class_ngrams._xlogx
    slots, n, first, own, want = [], [], [0], [], []
    for _ in range(30):
        some = np.sort(rng.choice(2 * k, rng.integers(2, 7), replace=False))
        times = rng.integers(1, 9, len(some))
        context = np.zeros(2 * k)
        context[some] = times
        left, right = context[:k], context[k:]
        home = int(rng.integers(k))
        # Cells and sums that hold the word, with it and without it.
        gains = []
        for j in range(k):
            value = 0.0
            for column, more in ((matrix[:, j], left), (matrix[j], right)):
                out = np.maximum(column - more, 0) if j == home else column
                value += (f(out + more) - f(out))[more > 0].sum()
            for sums in (matrix.sum(0), matrix.sum(1)):
                out = sums[j] - left.sum() if j == home else sums[j]
                value -= float(f(out + left.sum()) - f(out))
            gains.append(value)
        want.append(int(np.argmax(gains)))
        slots += list(some)
        n += list(times)
        first.append(len(slots))
        own.append(home)
    got = class_ngrams.place_words(np.array(slots), np.array(n), np.array(first), np.array(own), matrix)
    assert list(got) == want and len(set(want)) > 1


def test_exchange_finds_classes():
    """Units of two languages that never mix end up apart, and the likelihood grows."""
    rng = np.random.default_rng(0)
    n, k = 40, 2
    counts = np.zeros((n, n))
    for a in range(n):
        for b in range(n):
            if a % 2 == b % 2:
                counts[a, b] = rng.integers(1, 20)
    assigned = rng.integers(0, k, n)

    def matrix():
        hot = np.eye(k)[assigned]
        return hot.T @ counts @ hot

    def value(m):
        f = class_ngrams._xlogx
        return f(m).sum() - f(m.sum(0)).sum() - f(m.sum(1)).sum()

    before = value(matrix())
    for _ in range(10):
        hot = np.eye(k)[assigned]
        units = [(u, np.concatenate([counts[:, u] @ hot, counts[u] @ hot])) for u in range(n)]
        for u, c in class_ngrams.exchange_units(units[:1], assigned, matrix()).items():
            assigned[u] = c
        for u in range(n):
            hot = np.eye(k)[assigned]
            context = np.concatenate([counts[:, u] @ hot, counts[u] @ hot])
            assigned[u] = class_ngrams.exchange_units([(u, context)], assigned, matrix())[u]
    assert value(matrix()) > before
    assert len({tuple(assigned[::2]), tuple(assigned[1::2])}) == 2
    assert len(set(assigned[::2])) == len(set(assigned[1::2])) == 1


def test_class_ngrams_of_nothing(spark):
    assert class_ngrams.scored(empty(spark)).count() == 0
