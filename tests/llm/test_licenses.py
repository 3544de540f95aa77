from __future__ import annotations

import pytest

from tests.llm.corpus import ALNUM, LOWER, documents, empty, multiset, rows
from vecindad.llm import licenses

LINES = [
    "Released under the MIT License.",
    "x Licensed under the Apache License, Version 2.0. Under THE mit license",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "All rights reserved.",
    "under the mit licenses; apache license 2; cc by the nc",
    "Redistribution and use in source and binary forms, with or without modification, are permitted",
]


def base(text):
    w = ALNUM.findall((text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k : k + len(p)] == p:
                at.append(k)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def corpus():
    some = rows()
    for k, line in enumerate(LINES):
        some.append((500 + k, f"{some[k][1]}\n{line}\n{some[k + 1][1]}", "en", "s", 0, None, None, None))
    return some


def test_base_against_brute_force(spark):
    got = licenses.scan(documents(spark, corpus())).collect()
    assert multiset(tuple(r)[:6] for r in got) == multiset((r[0], *base(r[1])) for r in corpus())
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_labels_of_the_index(spark):
    got = {r.doc_id: r for r in licenses.scan(documents(spark, corpus())).collect()}
    labels = [got[500 + k].labels for k in range(len(LINES))]
    assert labels == ["mit", "apache-2,mit", "cc-by-nc", "gpl-3", "all-rights-reserved", "", "bsd"]
    assert got[0].labels == "" and got[0].score == 0


def test_empty(spark):
    assert licenses.scan(empty(spark)).count() == 0


def labels(text):
    """Brute force: every template at every place of the text, and the base phrases."""
    w = ALNUM.findall((text or "").translate(LOWER))
    found = set(filter(None, base(text)[4].split(",")))
    for label, template, key in licenses.TEMPLATES:
        t, k = template.split(), key.split()
        first = next(n for n in range(len(t)) if t[n : n + len(k)] == k)
        for start in range(-len(t), len(w)):
            at = dict(enumerate(w[max(start, 0) : start + len(t)], max(start, 0)))
            there = {(x, n) for n, x in enumerate(t) if at.get(start + n) == x}
            if 2 * len(there) >= len(t) and all((x, first + n) in there for n, x in enumerate(k)):
                found.add(label)
    return ",".join(sorted(found))


def test_many_licences_against_brute_force(spark):
    by = {}
    for label, template, _ in licenses.TEMPLATES:
        by[label] = template
    mixes = [
        ("mit", "bsd", "all-rights-reserved"),
        ("bsd", "isc", "all-rights-reserved"),
        ("bsd", "gpl", "all-rights-reserved"),
        ("mit", "gpl", "bsd", "isc", "unlicense"),
        tuple(by),
    ]
    plain = rows()
    some = plain * 8
    some = [(k, *r[1:]) for k, r in enumerate(some)]
    for k, mix in enumerate(mixes):
        text = "\n".join(f"{by[x]}\nw{n} w{n + 1}" for n, x in enumerate(mix))
        some.append((9000 + k, text, "en", "s", 0, None, None, None))
    for k in range(0, len(plain), 3):
        some.append((8000 + k, f"{plain[k][1]} all rights reserved", "en", "s", 0, None, None, None))
    # Half of a template around its key phrase, in a file with others.
    half = " ".join(by["isc"].split()[10:])
    some.append((9100, f"{by['bsd']}\n{by['gpl']}\n{half}", "en", "s", 0, None, None, None))
    got = {r.doc_id: r.labels for r in licenses.scan(documents(spark, some)).collect()}
    want = {r[0]: labels(r[1]) for r in some}
    assert got == want
    assert all(set(mix) <= set(want[9000 + k].split(",")) for k, mix in enumerate(mixes))


def test_many_places_of_one_file(spark):
    """A long file of one licence, beside others, and lines that only begin like it."""
    many = "all rights reserved\n" * 4000
    some = [
        (1, many, "en", "s", 0, None, None, None),
        (2, f"{many}{licenses.TEMPLATES[1][1]} {many}", "en", "s", 0, None, None, None),
        (3, "all rights\nreserved all\n" * 10 + "rights", "en", "s", 0, None, None, None),
        (4, "gnu general public license " * 500 + "version 3", "en", "s", 0, None, None, None),
    ]
    got = {r.doc_id: r.labels for r in licenses.scan(documents(spark, some)).collect()}
    assert got[1] == "all-rights-reserved" and got[2] == "all-rights-reserved,mit"
    assert (got[3], got[4]) == (labels(some[2][1]), labels(some[3][1]))


def test_templates_as_an_argument(spark):
    templates = [("x", "alpha beta alpha gamma delta epsilon", "beta alpha"), ("y", "beta", "beta")]
    texts = ["alpha beta alpha gamma", "ALPHA beta", "beta alpha", "gamma delta epsilon", "no word of them", ""]
    some = [(k, x, "en", "s", 0, None, None, None) for k, x in enumerate(texts)]
    got = {r.doc_id: r for r in licenses.scan(documents(spark, some), templates, {"gamma delta": "g"}).collect()}
    assert [got[k].labels for k in range(6)] == ["x,y", "y", "y", "g", "", ""]
    assert got[0].score == 1 and got[3].n_base == 1
    with pytest.raises(ValueError, match="key phrase"):
        licenses.scan(documents(spark, some), [("z", "alpha beta", "gamma")])
