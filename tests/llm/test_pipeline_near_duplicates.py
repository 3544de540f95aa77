from __future__ import annotations

import corpus_pipeline
from tests.llm.corpus import LOWER, SPACED, documents, rows


def shingles(text, size=5):
    w = SPACED.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def similarity(one, two, size=5):
    a, b = shingles(one, size), shingles(two, size)
    return len(a & b) / len(a | b)


def kept(some):
    """Brute force at five words and 0.8: the least id of each component, and texts without words."""
    sets = [shingles(r[1]) for r in some]
    root = list(range(len(some)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for k, row in enumerate(some):
        if sets[k]:
            groups.setdefault(find(k), []).append(row[0])
    first = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    return sorted(first + [r[0] for r, s in zip(some, sets, strict=True) if not s], key=str)


def planted():
    """Pairs that only five words and 0.8 link, and pairs just below 0.8."""
    some = []
    for k, more in enumerate((36, 38, 40, 42, 44, 52, 60)):
        base = [f"p{k}w{n}" for n in range(200)]
        some.append((2000 + 10 * k, " ".join(base), "en", "s", 0, None, None, None))
        some.append((2001 + 10 * k, " ".join(base + [f"p{k}x{n}" for n in range(more)]), "en", "s", 0, None, None, None))
    return some


def test_stage_against_brute_force(spark):
    pairs = planted()
    near = [similarity(pairs[k][1], pairs[k + 1][1]) for k in range(0, len(pairs), 2)]
    assert all(0.8 <= s < 0.85 for s in near[:5]) and all(s < 0.8 for s in near[5:])
    assert all(similarity(pairs[k][1], pairs[k + 1][1], 4) < 0.85 for k in range(0, len(pairs), 2))
    some = rows() + pairs
    got = [r.doc_id for r in corpus_pipeline.near_duplicates(spark, documents(spark, some), "").select("doc_id").collect()]
    assert sorted(got, key=str) == kept(some)
    assert {2000 + 10 * k for k in range(5)} <= set(got) and not {2001 + 10 * k for k in range(5)} & set(got)
