"""Robust multivariate outliers: minimum covariance determinant by language and source.

Statistics of a text become a vector of logarithms of rates, each with a small count
added, so that one repeated line in a clean text is no outlier.  For each language and source,
each language, and all rows, concentration steps look for the three quarters of the
rows with the least scatter: from medians and quartile ranges, distances are taken,
the nearest rows kept, their mean and covariance estimated, and so on.  The
estimate is made consistent for normal vectors, reweighted once, and rows farther
than the quantile of the chi-squared distribution are rejected.  A row is judged by
its language and source if these have MIN_ROWS rows or more, else by its language,
else by all rows.

All of it is DataFrame code.  Quantiles come from counts in fixed bins, so a group of
any size is a bounded number of rows after the map-side combine, and no step gathers a
group's rows.  A small part of each unit is added to the variances, as the rows of a
group may all have the same value.

Defined results: null and empty texts have no words and fail the base rule; null
languages and sources are a group of their own; repeated rows count and are judged
each; with fewer than MIN_FIT rows that pass the base rule, all of them are kept; an
empty table gives no row; other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecindad.llm.statistics import with_statistics
from vecindad.llm.tables import read, stored

STEPS = 4
SHARE = 0.75
MIN_ROWS = 50
MIN_FIT = 10
#: Quantiles of the chi-squared distribution: rows for the reweighted estimate, and rows kept.
REWEIGHT, KEEP = 0.975, 0.99999
#: Added to each variance.
FLOOR = 0.1
#: Widths of the bins for values, and for logarithms of squared distances.
VALUE_BIN, DISTANCE_BIN = 0.02, 0.01

VECTOR = {
    "_x0": lambda: F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
    "_x1": lambda: F.log((F.col("n_symbols") + 0.5) / (F.col("word_chars") + 1)),
    "_x2": lambda: F.log((F.col("n_dup_lines") + 1) / (F.col("n_lines") + 2)),
    "_x3": lambda: F.log((F.col("n_repeat_words") + 20) / (F.col("n_words") + 20)),
}
X = tuple(VECTOR)
D = len(X)


def chi2_cdf(x: float, degrees: int) -> float:
    """For an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for k in range(1, degrees // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, degrees) < share else (low, middle)
    return low


def base(docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        with_statistics(rows)
        .drop("text", "_words")
        .withColumn("base_failed", failed)
        .select(
            "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed"
        )
    )


def _keys() -> list[Column]:
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    return [F.to_json(F.array(lang, source)), F.to_json(F.array(lang)), F.lit("[]")]


def _by_bin(rows: DataFrame, keys: list[str], value: Column, width: float, shares: dict[str, float]) -> DataFrame:
    """For each key the upper edge of the bin that holds each share of the rows."""
    counts = rows.groupBy(*keys, F.floor(value / width).alias("_bin")).agg(F.count("*").alias("_n"))
    over = Window.partitionBy(*keys)
    total = F.sum("_n").over(over)
    run = F.sum("_n").over(over.orderBy("_bin"))
    edges = {name: F.min(F.when(F.col("_run") >= share * F.col("_total"), F.col("_bin") + 1)) for name, share in shares.items()}
    return (
        counts.withColumns({"_run": run, "_total": total})
        .groupBy(*keys)
        .agg(*[(e * width).alias(name) for name, e in edges.items()], F.max("_total").alias("_rows"))
    )


def _start(levels: DataFrame) -> DataFrame:
    """Centre and scale of each key from medians and quartiles, as a diagonal factor."""
    long = levels.select("_key", F.posexplode(F.array(*X)).alias("_i", "_v"))
    quartiles = _by_bin(long, ["_key", "_i"], F.col("_v"), VALUE_BIN, {"_low": 0.25, "_mid": 0.5, "_high": 0.75})
    scale = F.sqrt(F.pow((F.col("_high") - F.col("_low")) / 1.349, 2) + FLOOR)
    parts = []
    for i in range(D):
        parts.append(F.max(F.when(F.col("_i") == i, F.col("_mid"))).alias(f"_m{i}"))
        parts.append(F.max(F.when(F.col("_i") == i, scale)).alias(f"_l{i}{i}"))
    zeros = [F.lit(0.0).alias(f"_l{i}{j}") for i in range(D) for j in range(i)]
    return quartiles.groupBy("_key").agg(*parts).select("*", *zeros)


def _estimate(near: DataFrame, factor: float) -> DataFrame:
    """Mean of each key and the Cholesky factor of its covariance times ``factor``."""
    pairs = [(i, j) for i in range(D) for j in range(i + 1)]
    moments = near.groupBy("_key").agg(
        *[F.avg(x).alias(f"_m{i}") for i, x in enumerate(X)],
        *[F.covar_pop(X[i], X[j]).alias(f"_c{i}{j}") for i, j in pairs],
    )
    for i, j in pairs:
        rest = F.col(f"_c{i}{j}") * factor + (FLOOR if i == j else 0.0)
        for k in range(j):
            rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
        # Column by column the entries above are known.
        value = F.sqrt(F.greatest(rest, F.lit(FLOOR / 100))) if i == j else rest / F.col(f"_l{j}{j}")
        moments = moments.withColumn(f"_l{i}{j}", value)
    return moments.select("_key", *[f"_m{i}" for i in range(D)], *[f"_l{i}{j}" for i, j in pairs])


def _distance(at=F.col) -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: list[Column] = []
    for i, x in enumerate(X):
        rest = F.col(x) - at(f"_m{i}")
        for k in range(i):
            rest = rest - at(f"_l{i}{k}") * solved[k]
        solved.append(rest / at(f"_l{i}{i}"))
    return sum((s * s for s in solved), F.lit(0.0))


def estimates(rows: DataFrame) -> DataFrame:
    """Mean, factor and number of rows of each key."""
    levels = stored(rows.select(F.explode(F.array(*_keys())).alias("_key"), *X))
    factor = SHARE / chi2_cdf(chi2_quantile(SHARE, D), D + 2)
    now = _start(levels)
    for _ in range(STEPS):
        now = stored(now)
        measured = levels.join(now, "_key").select("_key", *X, F.log(_distance() + 1e-9).alias("_d"))
        # One row per group, stored: its size is known when the rows are joined with it.
        edge = stored(_by_bin(measured, ["_key"], F.col("_d"), DISTANCE_BIN, {"_edge": SHARE}))
        now = _estimate(measured.join(edge, "_key").where("_d < _edge"), factor)
    now = stored(now)
    near = levels.join(now, "_key").where(_distance() <= chi2_quantile(REWEIGHT, D)).select("_key", *X)
    counts = levels.groupBy("_key").agg(F.count("*").alias("_rows"))
    return stored(_estimate(near, 1.0).join(counts, "_key"))


def judged(docs: DataFrame) -> DataFrame:
    """Statistics, the base rule, and the verdict of every document."""
    rows = stored(base(docs))
    vectors = rows.withColumns({name: make() for name, make in VECTOR.items()})
    known = estimates(vectors.where("not base_failed"))
    names = [c for c in known.columns if c not in ("_key", "_rows")]
    for level, key in enumerate(_keys()):
        enough = MIN_ROWS if level < 2 else MIN_FIT
        of = known.where(F.col("_rows") >= enough).select(
            F.col("_key").alias(f"_key{level}"), F.struct(*names).alias(f"_of{level}")
        )
        vectors = vectors.withColumn(f"_key{level}", key).join(of, f"_key{level}", "left")
    vectors = vectors.withColumn("_of", F.coalesce("_of0", "_of1", "_of2"))
    distance = _distance(lambda name: F.col("_of")[name])
    limit = chi2_quantile(KEEP, D)
    return vectors.withColumn("distance", F.when(~F.col("base_failed"), distance)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"),
        F.sqrt("distance").alias("distance"),
    )


def op1_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return judged(read(spark, folder, "documents"))
