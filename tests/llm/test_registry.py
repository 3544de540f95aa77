from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from tools.compare import differences, open_tables
from vecindad.llm.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_names():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twins(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), open_tables(FOLDER), ORACLE[name]) is None


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its predecessor's rows: columns stay, rejected rows go, clean rows stay."""
    from tests.llm.corpus import documents
    from vecindad.llm import decontamination, jaccard_join, substrings
    from vecindad.llm.tables import stored

    pytest.importorskip("public_tokenizers")
    folder = str(tmp_path)
    docs = documents(spark)
    spark.createDataFrame([(1, "w1 w2 w3 w4")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(k, 1, int(k < 0)) for k in range(5)], "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, folder))
        assert docs.columns == before.columns
        counts.append(docs.count())
    assert counts[1] == counts[0] and counts[2] < counts[1] and counts[2] == counts[3] == counts[4]
    assert docs.where("n_chars <> length(text)").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert pieces.where("start = 0").count() == counts[4]
    again = jaccard_join.linked(stored(corpus_pipeline.near_duplicates(spark, documents(spark), folder)))
    assert again.where("component_id <> doc_id").count() == 0
    assert substrings.repeated(docs).where("n_removed > 0").count() <= 2
    assert decontamination.contamination(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).where("contaminated").count() == 0
