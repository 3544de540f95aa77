"""The corpus pipeline: stages over ``documents``, each stored before the next reads it.

1. toxicity: documents that the noisy-or model rejects go.
2. near_duplicates: of the documents that links on shingles of five words with a
   similarity of 0.8 or more lead to, the one with the least id stays (one row of it, if
   rows repeat).
3. repeated_passages: words covered by windows of 35 words that occur anywhere else go.
4. decontamination: passages of benchmark windows go.
5. packing: pieces of token sequences.

A document is kept with what is left of its text, also if that is empty, and n_chars
follows the text.  All stages but the last return the columns of their input.

All but the last take smaller Arrow batches, as Spark writes large row groups beside the
Python workers; that bounds memory and changes no result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm import decontamination, jaccard_join, packing, substrings, toxicity
from vecindad.llm.tables import read, stored


#: Arrow batches of all stages but the last.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
_usual: dict[str, str] = {}


def _small_batches(spark: SparkSession) -> None:
    for key, value in SMALL_BATCHES.items():
        _usual.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)


def _usual_batches(spark: SparkSession) -> None:
    while _usual:
        spark.conf.set(*_usual.popitem())


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("n_chars")))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Also while the result is written, which is after this returns.
    _small_batches(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The stage's own contract; four words and 85 % are that of op9 alone.
    _small_batches(spark)
    return jaccard_join.representatives(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return _counted(substrings.clean(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return _counted(decontamination.clean(docs, read(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _usual_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontaminated),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
