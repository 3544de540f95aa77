from __future__ import annotations

import re
from collections import Counter

import numpy as np

from tests.llm.corpus import SPACED, documents, empty, multiset, rows
from vecindad.llm import outliers


def base(text):
    text = text or ""
    w = SPACED.findall(text)
    count = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    again = {j for k in range(len(w) - 7) if count[tuple(w[k : k + 8])] > 1 for j in range(k, k + 8)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed


def test_base_against_brute_force(spark):
    some = rows() + [(900, "a # b\n" * 30 + "c d e f g h i j " * 3, "en", "s", 1, None, None, None)]
    got = outliers.judged(documents(spark, some)).collect()
    assert multiset(tuple(r)[:7] for r in got) == multiset((r[0], *base(r[1])) for r in some)
    assert all(not r.kept for r in got if r.base_failed)


def test_junk_is_rejected_and_clean_texts_stay(spark):
    rng = np.random.default_rng(2)
    some = []
    for k in range(400):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(40, 300))]
        junk = k % 10 == 0
        text = " ".join(w + "###" if junk else w for w in words)
        some.append((k, text, "en" if k % 2 else None, "s1" if k % 3 else None, 0, None, None, None))
    got = {r.doc_id: r.kept for r in outliers.judged(documents(spark, some)).collect()}
    assert not any(got[k] for k in range(0, 400, 10))
    assert sum(got[k] for k in range(400) if k % 10) >= 358


def test_distance_is_the_mahalanobis_distance(spark):
    rng = np.random.default_rng(1)
    x = rng.multivariate_normal([0, 1, 2, 3], np.diag([1, 2, 0.5, 1]) + 0.2, 2000)
    frame = spark.createDataFrame(x.tolist(), list(outliers.X)).selectExpr("*", "'en' lang", "'s' source")
    known = [r for r in outliers.estimates(frame).collect() if r._key == "[]"][0]
    mean = np.array([known[f"_m{i}"] for i in range(4)])
    factor = np.array([[known[f"_l{i}{j}"] if j <= i else 0.0 for j in range(4)] for i in range(4)])
    assert np.allclose(mean, [0, 1, 2, 3], atol=0.12)
    assert np.allclose(factor @ factor.T, np.diag([1, 2, 0.5, 1]) + 0.2 + np.eye(4) * outliers.FLOOR, atol=0.4)


def test_empty(spark):
    assert outliers.judged(empty(spark)).count() == 0


def test_quantiles():
    assert abs(outliers.chi2_quantile(0.95, 4) - 9.4877) < 1e-3
    assert abs(outliers.chi2_cdf(12.5916, 6) - 0.95) < 1e-4
