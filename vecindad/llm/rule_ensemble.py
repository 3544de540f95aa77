"""Quality by a sparse rule ensemble over text statistics.

Trees of a random forest are cut into rules: the path to each node is a conjunction of
comparisons of statistics.  A lasso logistic regression over all rules gives most of
them no weight; the others are compiled into one Spark column expression, so scoring
is part of the scan's generated code.  Forest and regression are trained by Spark on all
labelled rows of the training folds; only rules and weights reach the driver, at most
2^(depth+1) for each tree.

Defined results: null and empty texts have all statistics at 0 and get the score of
those; repeated rows are scored each; labels of unknown ids and null labels are not
used; with one label only, every score is that label, and 0.5 without any; an empty
table gives no row; other columns are left out.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.statistics import with_statistics
from vecindad.llm.tables import fold, read, stored

FOLDS = 5
THRESHOLD = 0.3
TREES, DEPTH = 20, 4
LASSO = 5e-4

FEATURES = (
    "log_words",
    "word_length",
    "symbol_rate",
    "dup_line_rate",
    "repeat_rate",
    "upper_rate",
    "digit_rate",
    "mark_rate",
    "distinct_rate",
    "line_length",
    "stop_rate",
)

#: Comparisons (feature, above, value) that must all hold.
Rule = tuple[tuple[str, bool, float], ...]


class Ensemble(NamedTuple):
    rules: list[tuple[Rule, float]]
    bias: float


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every text, all between finite bounds and never null."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    made = {
        "log_words": F.log1p("n_words"),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": F.col("n_symbols") / chars,
        "dup_line_rate": F.col("n_dup_lines") / lines,
        "repeat_rate": F.col("n_repeat_words") / words,
        "upper_rate": F.regexp_count(text, F.lit("[A-Z]")) / chars,
        "digit_rate": F.regexp_count(text, F.lit("[0-9]")) / chars,
        "mark_rate": F.regexp_count(text, F.lit("[!?;:]")) / chars,
        "distinct_rate": F.size(F.array_distinct("_words")) / words,
        "line_length": F.log1p(F.col("n_words") / lines),
        "stop_rate": F.regexp_count(text, F.lit("[.,]")) / words,
    }
    return with_statistics(rows).select("doc_id", *[value.cast("double").alias(name) for name, value in made.items()])


def tree_rules(description: str) -> list[Rule]:
    """The path to each node of a tree, from its printed form."""
    rules, path = [], []
    for line in description.splitlines():
        m = re.match(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$", line)
        if m:
            depth = len(m[1])
            path = [p for p in path if p[0] < depth]
            path.append((depth, (FEATURES[int(m[2])], m[3] == ">", float(m[4]))))
            rules.append(tuple(c for _, c in path))
    return rules


def simplified(rule: Rule) -> Rule:
    """One comparison for each feature and side, in order of the features."""
    bounds: dict[tuple[str, bool], float] = {}
    for name, above, value in rule:
        old = bounds.get((name, above), value)
        bounds[name, above] = max(old, value) if above else min(old, value)
    return tuple((name, above, value) for (name, above), value in sorted(bounds.items()))


def condition(rule: Rule) -> Column:
    tests = [F.col(name) > value if above else F.col(name) <= value for name, above, value in rule]
    return reduce(lambda a, b: a & b, tests)


def compiled(model: Ensemble) -> Column:
    """The score as one column expression."""
    terms = [F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0)) for rule, weight in model.rules]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(model.bias))))


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Ensemble:
    """``rows``: the features and ``y``."""
    shares = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(shares) < 2:
        only = next(iter(shares), None)
        return Ensemble([], 0.0 if only is None else 40.0 if only else -40.0)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows).select("x", "y")
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=7, minInstancesPerNode=10, maxBins=64
    ).fit(vectors)
    found = {simplified(rule) for tree in forest.trees for rule in tree_rules(tree.toDebugString)}
    rules = sorted(found)
    if not rules:
        return Ensemble([], 0.0)
    tests = rows.select(F.array(*[condition(r).cast("double") for r in rules]).alias("r"), "y")
    from pyspark.ml.functions import array_to_vector

    line = LogisticRegression(featuresCol="x", labelCol="y", regParam=lasso, elasticNetParam=1.0, maxIter=60)
    model = line.fit(stored(tests).select(array_to_vector("r").alias("x"), F.col("y").cast("double")))
    weights = model.coefficients.toArray()
    return Ensemble([(r, float(w)) for r, w in zip(rules, weights, strict=True) if w], float(model.intercept))


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != 0))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(label).cast("double").alias("y"))
    )
    rows = stored(features(docs))
    # Read once for each level of the trees and each step of the regression.
    training = stored(rows.join(known, "doc_id").select(*FEATURES, "y"))
    score = compiled(fit(training))
    return rows.select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
    )


def op2_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    return scored(read(spark, folder, "documents"), read(spark, folder, "labels"))
