from __future__ import annotations

from tests.llm.corpus import LOWER, SPACED, documents, empty, multiset, rows
from vecindad.llm import jaccard_join
from vecindad.llm.components import components


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()


def brute(some, percent):
    sets = [shingles(r[1]) for r in some]
    root = list(range(len(some)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    for k, row in enumerate(some):
        ids = [some[m][0] for m in range(len(some)) if find(m) == find(k) and some[m][0] is not None]
        yield row[0], len(sets[k]), min(ids, default=row[0])


def family(n, changes):
    base = [f"b{k}" for k in range(60)]
    for k in range(n):
        words = list(base)
        for c in range(changes * (k % 4)):
            words[(k * 7 + c * 13) % 60] = f"c{k}x{c}"
        yield (1000 + k, " ".join(words), None, None, None, None, None, None)


def test_against_brute_force(spark):
    got = jaccard_join.linked(documents(spark)).collect()
    assert multiset(map(tuple, got)) == multiset(brute(rows(), 85))


def test_families_without_a_centre(spark):
    some = list(family(40, 1))[1:]
    for percent in (60, 70, 85):
        got = jaccard_join.linked(documents(spark, some), 4, percent).collect()
        assert multiset(map(tuple, got)) == multiset(brute(some, percent))


def test_representatives(spark):
    docs = documents(spark)
    kept = jaccard_join.representatives(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    links = {(d, c) for d, n, c in brute(rows(), 85) if n}
    empty_ids = [d for d, n, _ in brute(rows(), 85) if not n]
    assert multiset(ids) == multiset(sorted({c for _, c in links}) + empty_ids)


def test_empty(spark):
    assert jaccard_join.linked(empty(spark)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(100, 101)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(31), 0), 100: 100, 101: 100}
