"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

Sentences end at full stops, marks and line ends.  A sentence's score is a logistic
function of its words and word beginnings (4 to 10 bytes); a document's score is the
noisy-or of its sentences.  Only documents carry labels; the sentence weights are
those that make the document scores most likely, so they also say where the
offending sentences stand.

Fitting uses a sample of labelled rows bounded by ``SAMPLE`` for each label, taken by
the hash of the id, weighted back to the shares of all labelled rows.  Candidate
features are counted on the executors; the FEATURES with the strongest lift are
fitted on the driver.  Scoring is one pass over all texts with no shuffle.

Defined results: null and empty texts have no sentence and score 0; repeated rows
are scored each; labels of unknown ids, and null labels, are not used; without rows of
both labels every score is 0; other columns are left out or kept by score().
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import fold, own_names, read
from vecindad.llm.words import alphanumeric, byte_codes, mixed, powers, slices, words

#: Labelled rows of each label that are fitted, at most.
SAMPLE = 5000
#: Features fitted, at most.
FEATURES = 4000
BEGINNINGS = range(4, 11)
FOLDS = 5
THRESHOLD = 0.5
_FILTER_BITS = 20


class Model(NamedTuple):
    """Sorted feature hashes with their weights, and the bias of every sentence."""

    feature: np.ndarray
    weight: np.ndarray
    bias: float


class Sentences(NamedTuple):
    """Of a slice: features of words, their sentences (0..), each text's first sentence, byte spans."""

    feature: np.ndarray
    sentence: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _ends() -> np.ndarray:
    mask = np.zeros(256, bool)
    mask[[0x0A, 0x21, 0x2E, 0x3F]] = True
    return mask


def sentences(raw: np.ndarray, offsets: np.ndarray) -> Sentences:
    codes = byte_codes(True)
    w = words(raw, offsets, alphanumeric(), codes)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(w.first))
    stops = np.concatenate([[0], np.cumsum(_ends()[raw])])[w.start] + owner
    fresh = np.diff(stops, prepend=-1) > 0
    sentence = np.cumsum(fresh) - 1
    opens = np.flatnonzero(fresh)
    first = np.searchsorted(owner[opens], np.arange(len(offsets)))
    ends = w.end[np.append(opens[1:], len(stops)) - 1] if len(opens) else w.end
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(codes[raw] * powers(len(raw)), out=sums[1:])
    back = powers(len(raw) + 1, True)
    feature, where = [w.code], [sentence]
    for size in BEGINNINGS:
        long = np.flatnonzero(w.end - w.start > size)
        start = w.start[long]
        feature.append(mixed((sums[start + size] - sums[start]) * back[start] + np.uint64(1000 + size)))
        where.append(sentence[long])
    return Sentences(np.concatenate(feature), np.concatenate(where), first, w.start[opens], ends)


def _known(feature: np.ndarray, sentence: np.ndarray, model: Model, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(model feature, sentence) of the features that the model has, each once in a sentence."""
    if not len(model.feature):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    may = np.flatnonzero(table[feature & np.uint64((1 << _FILTER_BITS) - 1)])
    at = np.minimum(np.searchsorted(model.feature, feature[may]), len(model.feature) - 1)
    same = model.feature[at] == feature[may]
    pair = np.unique(sentence[may[same]] * len(model.feature) + at[same])
    return pair % len(model.feature), pair // len(model.feature)


def _table(feature: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << _FILTER_BITS, bool)
    table[feature & np.uint64((1 << _FILTER_BITS) - 1)] = True
    return table


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> tuple[DataFrame, dict[int, float]]:
    """A bounded sample of labelled documents (text, y), and the weight of each label in it."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold(F.col("doc_id"), FOLDS) != 0))
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(label).cast("int").alias("y"))
    )
    counts = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample) for y in (0, 1)]
    total = sum(counts.values()) or 1
    weights = {y: n / total / min(n, sample) for y, n in counts.items()}
    # Two samples of bounded size: no more than 2 * sample ids.
    chosen = F.broadcast(parts[0].union(parts[1]))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    return rows.join(chosen, "_id").select("text", "y"), weights


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES) -> Model:
    rows, weights = training_rows(docs, labels, label, sample)
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    if len(weights) < 2:
        return nothing

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_numpy()
            for at, to, raw, offsets in slices(batch.column(0)):
                s = sentences(raw, offsets)
                text = np.searchsorted(s.first, s.sentence, side="right") - 1
                once = np.unique(s.feature + mixed(text.astype(np.uint64)), return_index=True)[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.feature[once].view(np.int64)), pa.array(y[at + text[once]].astype(np.int64))],
                    names=["feature", "y"],
                )

    counted = rows.mapInArrow(count, "feature long, y long").groupBy("feature").agg(
        F.sum("y").alias("in"), F.count("*").alias("all")
    )
    size = rows.groupBy("y").count().collect()
    n = {r["y"]: r["count"] for r in size}
    if len(n) < 2:
        return nothing
    lift = F.log(((F.col("in") + 0.5) / (n[1] + 1)) / ((F.col("all") - F.col("in") + 0.5) / (n[0] + 1)))
    best = (
        counted.where("in >= 3")
        .select("feature", (lift * F.sqrt("in")).alias("power"), lift.alias("lift"))
        .where("lift > 0.7")
        .orderBy(F.desc("power"), "feature")
        .limit(features)
        .collect()
    )
    feature = np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
    shell = Model(feature, np.zeros(len(feature)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast((shell, _table(feature)))

    def restrict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column(1).to_pylist()
            out: list[list] = [[], [], [], []]
            for at, to, raw, offsets in slices(batch.column(0)):
                s = sentences(raw, offsets)
                which, sentence = _known(s.feature, s.sentence, *shared.value)
                ends = np.searchsorted(sentence, s.first)
                for k in range(to - at):
                    a, b = ends[k], ends[k + 1]
                    out[0].append(y[at + k])
                    out[1].append(int(s.first[k + 1] - s.first[k]))
                    out[2].append((sentence[a:b] - s.first[k]).astype(np.int32))
                    out[3].append(which[a:b].astype(np.int32))
            kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["y", "n", "sentence", "feature"]
            )

    bags = rows.mapInArrow(restrict, "y int, n int, sentence array<int>, feature array<int>").collect()
    bags.sort(key=lambda r: (r["y"], r["n"], r["sentence"], r["feature"]))
    return _noisy_or(bags, feature, weights)


def _noisy_or(bags: list, feature: np.ndarray, weights: dict[int, float], rounds: int = 300, decay: float = 1e-5) -> Model:
    """Weights and bias by Adam on the weighted log-likelihood of the document labels."""
    y = np.array([b["y"] for b in bags], float)
    share = np.array([weights[b["y"]] for b in bags])
    share /= share.sum()
    bag, sentence, which, plain = [], [], [], np.zeros(len(bags))
    made = 0
    for k, b in enumerate(bags):
        own, place = np.unique(np.array(b["sentence"], np.int64), return_inverse=True)
        plain[k] = b["n"] - len(own)
        bag.append(np.full(len(own), k))
        sentence.append(place + made)
        which.append(np.array(b["feature"], np.int64))
        made += len(own)
    bag, sentence, which = (np.concatenate(x).astype(np.int64) for x in (bag, sentence, which))
    w = np.zeros(len(feature) + 1)
    w[-1] = -6.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        z = np.bincount(sentence, w[which], made) + w[-1]
        none = np.bincount(bag, _softplus(z), len(bags)) + plain * _softplus(w[-1])
        off = np.exp(-none)
        pull = share * np.where(y > 0, -off / np.maximum(1 - off, 1e-9), 1.0)
        slope = pull[bag] / (1 + np.exp(-z))
        grad = np.append(
            np.bincount(which, slope[sentence], len(feature)),
            slope.sum() + (pull * plain).sum() / (1 + np.exp(-w[-1])),
        )
        grad[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return Model(feature, w[:-1], float(w[-1]))


SCORED = "score double, sentences array<string>"


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``_score``, and in ``_sentences`` those that score ``threshold`` or more by themselves.

    Columns of the input with these two names are left out; ``clean`` keeps them.
    """
    docs = docs.drop("_score", "_sentences")
    shared = docs.sparkSession.sparkContext.broadcast((model, _table(model.feature)))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = shared.value
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            found: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for at, to, raw, offsets in slices(batch.column(place)):
                s = sentences(raw, offsets)
                which, sentence = _known(s.feature, s.sentence, model, table)
                z = np.full(len(s.start), model.bias)
                z += np.bincount(sentence, model.weight[which], len(s.start)) if len(which) else 0
                none = np.concatenate([[0.0], np.cumsum(_softplus(z))])[s.first]
                scores[at:to] = 1 - np.exp(-np.diff(none))
                for k in np.flatnonzero(z >= np.log(threshold / (1 - threshold))):
                    row = at + int(np.searchsorted(s.first, k, side="right")) - 1
                    found[row].append(raw[s.start[k] : s.end[k]].tobytes().decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores.clip(0, 1)), pa.array(found, pa.list_(pa.string()))],
                names=[*batch.schema.names, "_score", "_sentences"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{kept}, _score double, _sentences array<string>")


def scored(docs: DataFrame, model: Model) -> DataFrame:
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return score(chosen, model).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        rejected(F.col("_score")).cast("int").alias("predicted"),
        F.col("_sentences").alias("sentences"),
    )


@own_names
def clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows that the model rejects."""
    return score(docs, model).where(~rejected(F.col("_score"))).select(*docs.columns)


def rejected(score: Column) -> Column:
    return score >= THRESHOLD


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    return scored(docs, fit(docs, read(spark, folder, "labels")))
