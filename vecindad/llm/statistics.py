"""Statistics of texts as column expressions.

Words are runs of characters other than space and TAB..CR.  A null text has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 8


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def with_statistics(rows: DataFrame, words: str = "_words") -> DataFrame:
    """``rows`` (with text) and n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, and the words.

    Everything stays within a row: an array as long as the text, sorted where windows repeat.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACES, "")) > 0)
    size = REPEAT_WINDOW
    # One hash per window; the windows of a text are told apart by it.
    hashes = F.when(
        F.size(words) >= size,
        F.transform(F.sequence(F.lit(1), F.size(words) - (size - 1)), lambda i: F.xxhash64(F.slice(words, i, size))),
    )
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ordered = F.when(repeats, F.array_sort(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    sorted_, count = F.col("_sorted"), F.size("_sorted")
    places = F.array_sort(
        F.transform(
            F.filter(
                F.transform(
                    sorted_,
                    lambda x, k: F.struct(
                        x["i"].alias("i"),
                        (
                            ((k > 0) & (F.get(sorted_, k - 1)["h"] == x["h"]))
                            | ((k < count - 1) & (F.get(sorted_, k + 1)["h"] == x["h"]))
                        ).alias("twice"),
                    ),
                ),
                lambda x: x["twice"],
            ),
            lambda x: x["i"],
        )
    )
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct((i + size).alias("end"), (a["n"] + F.least(F.lit(size), i + size - a["end"])).alias("n")),
        lambda a: a["n"],
    )
    return (
        rows.withColumn(words, word_array(F.col("text").cast("string")))
        .withColumn("_hashes", hashes)
        .withColumn("_sorted", ordered)
        .withColumn("_places", places)
        .withColumn("_lines", lines)
        .withColumns(
            {
                "n_words": F.size(words).cast("long"),
                "word_chars": F.length(F.array_join(words, "")).cast("long"),
                "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
            }
        )
        .drop("_hashes", "_sorted", "_places", "_lines")
    )
