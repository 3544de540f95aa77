from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from tests.llm.corpus import documents, multiset, rows

from vecindad.llm import decontamination, jaccard_join, substrings, toxicity

#: Names that the steps use inside, one in capitals.
NAMES = [
    "_key", "_node", "_unique", "_hit", "_items", "_id", "_hash", "_text", "_rows", "_STAYS", "_first",
    "_score", "_sentences", "_gone",
]


def some():
    chosen = rows()
    return [*chosen[:6], *chosen[40:44], chosen[50], chosen[51], *chosen[-4:]]


@pytest.fixture(scope="module")
def steps(spark):
    labels = spark.createDataFrame([(k, 0, k % 2) for k in range(20)], "doc_id long, quality int, toxic int")
    phrase = " ".join(some()[1][1].split()[3:18])
    benchmark = spark.createDataFrame([("b", phrase)], "item_id string, text string")
    model = toxicity.fit(documents(spark, some()), labels)
    return {
        "toxicity": lambda docs: toxicity.clean(docs, model),
        "near": lambda docs: jaccard_join.representatives(docs, shingle=5, percent=80),
        "repeated": substrings.clean,
        "benchmark": lambda docs: decontamination.clean(docs, benchmark),
        "score": lambda docs: toxicity.score(docs, model),
    }


@pytest.mark.parametrize("name", ["toxicity", "near", "repeated", "benchmark"])
def test_columns_of_the_caller_stay(spark, steps, name):
    docs = documents(spark, some())
    marked = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce("doc_id", F.lit(-1))) for c in NAMES})
    plain, got = steps[name](docs).collect(), steps[name](marked)
    assert got.columns == marked.columns
    got = got.collect()
    assert multiset(tuple(r) for r in plain) == multiset(tuple(r)[: len(docs.columns)] for r in got)
    for r in got:
        assert all(r[c] == f"{c} {-1 if r.doc_id is None else r.doc_id}" for c in NAMES)


def test_columns_of_the_score(spark, steps):
    docs = documents(spark, some()).withColumns({"_score": F.lit("x"), "_sentences": F.lit("y")})
    got = steps["score"](docs)
    assert got.columns == [c for c in docs.columns if c[0] != "_"] + ["_score", "_sentences"]
    assert all(0 <= r._score <= 1 for r in got.collect())
