"""Brown class n-grams: words in classes, log10 P(text) from class transitions and word emissions.

    P(word | before) = P(class | class before) * P(word | class)
    P(class | before) = (N(before, class) + a) / (N(before) + a K)
    P(word | class)   = (c(word) + 1) / (N(class) + V(class) + 1)

Every word seen OWN times or more in training has a class of its own choice; so the words
with classes grow with the corpus.  Classes come from exchange clustering in Brown's order, the most
frequent words first:

1. The core, words with CORE_SHARE of all tokens (at most 1 / CORE_SHARE), and the buckets
   that stand for all other words (by their last three bytes) are exchanged: in each round
   half of them, in PARTS parts, move one after the other to the class that
   raises the class bigram likelihood most, and all class counts are taken anew.  Rounds
   end when the likelihood rises by less than TOLERANCE in two of them, or after ROUNDS.
2. Each other word is taken out of its bucket's class and put where the likelihood grows
   most, by the classes found before and after it in the whole training corpus; its
   contexts are at most 2 K numbers, combined in the shuffle.

Words rarer than OWN, and unseen ones, have the class of their bucket.  The class bigrams are
then counted anew with the classes of all words.

Plan: words with COMMON_SHARE of all tokens or more (at most a million at any size) are
broadcast with counts and classes; rarer ones are looked up by joins on the word, with the
classes beside them, and neighbours that are both rare by a join for each.  The
share decides where a word is looked up, not what comes out.  One pass over the texts stores what both
the class bigrams and the scores are made of.  A word's identity is a 64-bit hash.

Defined results: null and empty texts are one token, the end; repeated rows count and
are scored each; a null id counts as an empty text for the fold; an empty table gives
no row; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import fold, read, stored
from vecindad.llm.words import Words, byte_codes, mixed, slices, spaced, words

CLASSES = 64
BUCKETS = 2048
#: Occurrences from which a word has a class of its own choice.
OWN = 3
CORE_SHARE = 1e-5
COMMON_SHARE = 1e-6
#: Rounds of exchange at most, and the rise of the likelihood (a share of it) that ends them.
ROUNDS = 24
TOLERANCE = 1e-4
#: Context rows of a batch that are combined at once.
COMBINED = 1 << 19
#: Units are exchanged in so many parts at once.
PARTS = 8
SMOOTHING = 0.5
FOLDS, HELD = 7, 2
END = np.uint64(0x0E1D0E1D0E1D0E1D)


def _sequence(w: Words, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts with an end after each: codes, buckets, and where each text begins (one more)."""
    n = len(w.first) - 1
    at = np.arange(len(w.code)) + np.repeat(np.arange(n), np.diff(w.first))
    code = np.full(len(w.code) + n, END)
    bucket = np.zeros(len(code), np.int64)
    code[at] = w.code
    lower = byte_codes(True)
    ending = np.zeros(len(w.code), np.uint64)
    for back in (1, 2, 3):
        inside = w.end - back >= w.start
        ending = mixed(ending + np.where(inside, lower[raw[np.maximum(w.end - back, 0)]], 1).astype(np.uint64))
    bucket[at] = (ending % np.uint64(BUCKETS)).astype(np.int64)
    return code, bucket, w.first + np.arange(n + 1)


def _batches(column: pa.Array):
    for at, to, raw, offsets in slices(column):
        w = words(raw, offsets, spaced(), byte_codes(True))
        yield at, to, *_sequence(w, raw)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, bucket, n) of all tokens; one row per word of a slice before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, code, bucket, _ in _batches(batch.column(0)):
                word, first, n = np.unique(code, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(word.view(np.int64)), pa.array(bucket[first]), pa.array(n)], names=["word", "bucket", "n"]
                )

    counted = docs.select("text").mapInArrow(run, "word long, bucket long, n long")
    return counted.groupBy("word").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n"))


class Core(NamedTuple):
    """The most frequent words (sorted hashes) and their units; other words are their buckets."""

    code: np.ndarray
    unit: np.ndarray
    n_units: int

    def units(self, code: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The unit of each word, and which words are of the core."""
        at, same = _found(self.code, code)
        return np.where(same, self.unit[at], bucket), same


class Common(NamedTuple):
    """Words (sorted hashes) known without a join, with counts and classes; the end is among them."""

    code: np.ndarray
    n: np.ndarray
    kind: np.ndarray


class Model(NamedTuple):
    common: Common
    #: Classes of the buckets; log10 of each class's emission divisor.
    bucket_kind: np.ndarray
    divisor: np.ndarray
    tokens: int
    types: int


def _found(known: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each hash stands in a sorted, non-empty array, and whether it does."""
    at = np.minimum(np.searchsorted(known, code), len(known) - 1)
    return at, known[at] == code


def _bigrams(docs: DataFrame, core: Core) -> DataFrame:
    """(first, second, n) of units, the end standing before each text."""
    shared = docs.sparkSession.sparkContext.broadcast(core)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core = shared.value
        for batch in batches:
            parts = []
            for _, _, code, bucket, first in _batches(batch.column(0)):
                unit, _ = core.units(code, bucket)
                before = np.empty_like(unit)
                before[1:] = unit[:-1]
                before[first[:-1]] = core.n_units - 1
                parts.append(before * core.n_units + unit)
            if parts:
                pair, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair // core.n_units), pa.array(pair % core.n_units), pa.array(n)],
                    names=["first", "second", "n"],
                )

    counted = docs.select("text").mapInArrow(run, "first long, second long, n long")
    return counted.groupBy("first", "second").agg(F.sum("n").alias("n"))


def _contexts(bigrams: DataFrame, assigned: np.ndarray, classes: int) -> DataFrame:
    """(unit, slot, n): how often each class stands before (slot 0..) and after (slot classes..) a unit."""
    shared = bigrams.sparkSession.sparkContext.broadcast(assigned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = 2 * classes
        for batch in batches:
            first, second, n = (c.to_numpy() for c in batch.columns)
            key = np.concatenate([second * wide + shared.value[first], first * wide + classes + shared.value[second]])
            key, place = np.unique(key, return_inverse=True)
            total = np.bincount(place, np.concatenate([n, n])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key // wide), pa.array(key % wide), pa.array(total)], names=["unit", "slot", "n"]
            )

    return bigrams.mapInArrow(run, "unit long, slot long, n long").groupBy("unit", "slot").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """What the class bigram log-likelihood depends on."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def exchange_units(units: list[tuple[int, np.ndarray]], assigned: np.ndarray, matrix: np.ndarray) -> dict[int, int]:
    """Classes of some units after one pass over them, each taken out of its class and put where
    the class bigram likelihood grows most.  A unit is (number, class counts before and after it)."""
    m, k = matrix.copy(), len(matrix)
    moved = {}
    for unit, context in units:
        left, right, own = context[:k], context[k:], int(assigned[unit])
        m[:, own] = np.maximum(m[:, own] - left, 0)
        m[own, :] = np.maximum(m[own, :] - right, 0)
        total, own_total = m.sum(0), left.sum()
        plain = _xlogx(m)
        gain = (
            (_xlogx(m + left[:, None]) - plain).sum(0)
            + (_xlogx(m + right[None, :]) - plain).sum(1)
            - 2 * (_xlogx(total + own_total) - _xlogx(total))
        )
        best = int(gain.argmax())
        best = best if gain[best] > gain[own] + 1e-6 else own
        m[:, best] += left
        m[best, :] += right
        moved[unit] = best
    return moved


def exchange(bigrams: DataFrame, start: np.ndarray, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the units after some rounds, and the class bigram counts."""
    assigned = start.copy()
    spark = bigrams.sparkSession
    reached, still = -np.inf, 0
    for turn in range(rounds + 1):
        contexts = stored(_contexts(bigrams, assigned, classes))
        by_class = np.zeros((classes, classes))
        shared = spark.sparkContext.broadcast(assigned)

        def own(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                unit, slot, n = (c.to_numpy() for c in batch.columns)
                after = slot >= classes
                key = shared.value[unit[after]] * classes + slot[after] - classes
                key, place = np.unique(key, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(np.bincount(place, n[after]).astype(np.int64))], names=["cell", "n"]
                )

        # At most classes * classes rows.
        for r in contexts.mapInArrow(own, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
            by_class[divmod(r["cell"], classes)] = r["n"]
        value = likelihood(by_class)
        still = 0 if value > reached + TOLERANCE * abs(value) else still + 1
        reached = max(reached, value)
        # Two rounds, as each moves one half of the units.
        if turn == rounds or still == 2:
            return assigned, by_class
        table = spark.sparkContext.broadcast((assigned, by_class))

        def move(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            assigned, by_class = table.value
            units = []
            for batch in batches:
                for unit, slots, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    context = np.zeros(2 * classes)
                    context[slots] = counts
                    units.append((unit, context))
            moved = exchange_units(units, assigned, by_class)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(moved), pa.int64()), pa.array(list(moved.values()), pa.int64())], names=["unit", "to"]
            )

        # A fixed number of parts, sorted: the same moves on any cluster.
        moves = (
            contexts.groupBy("unit")
            .agg(F.collect_list(F.struct("slot", "n")).alias("c"))
            .where((F.xxhash64("unit") + F.lit(turn)) % 2 == 0)
            .select("unit", F.col("c.slot").alias("slot"), F.col("c.n").alias("n"))
            .repartition(PARTS, "unit")
            .sortWithinPartitions("unit")
            .mapInArrow(move, "unit long, to long")
        )
        # One row per unit: at most 1 / CORE_SHARE + BUCKETS + 1.
        for r in moves.collect():
            assigned[r["unit"]] = r["to"]
    raise AssertionError


def _word_contexts(docs: DataFrame, core: Core, assigned: np.ndarray, classes: int) -> DataFrame:
    """(word, bucket, slot, n) of all words outside the core: the classes before and after them."""
    shared = docs.sparkSession.sparkContext.broadcast((core, assigned))

    def combined(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        code, bucket, slot = (np.concatenate(c) for c in zip(*parts, strict=True))
        _, one, n = np.unique(code + mixed(slot.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(code[one].view(np.int64)), pa.array(bucket[one].astype(np.int32)), pa.array(slot[one]), pa.array(n)],
            names=["word", "bucket", "slot", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core, assigned = shared.value
        parts, held = [], 0
        for batch in batches:
            for _, _, code, bucket, first in _batches(batch.column(0)):
                unit, of_core = core.units(code, bucket)
                kind = assigned[unit]
                before = np.empty_like(kind)
                before[1:] = kind[:-1]
                before[first[:-1]] = assigned[core.n_units - 1]
                # The end is of the core and closes each text, so another word has one after it.
                at = np.flatnonzero(~of_core)
                slot = np.concatenate([before[at], kind[at + 1] + classes]).astype(np.int32)
                parts.append((np.tile(code[at], 2), np.tile(bucket[at], 2), slot))
                held += len(slot)
                if held >= COMBINED:
                    yield combined(parts)
                    parts, held = [], 0
        if parts:
            yield combined(parts)

    emitted = docs.select("text").mapInArrow(run, "word long, bucket int, slot int, n long")
    return emitted.groupBy("word", "slot").agg(F.min("bucket").alias("bucket"), F.sum("n").alias("n"))


def place_words(slots: np.ndarray, n: np.ndarray, first: np.ndarray, own: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The class of each word, taken out of class ``own`` and put where the likelihood grows most.

    A word's contexts are the entries from one value of ``first`` to the next: slots below K are
    classes before it, from K on classes after it.  Ties go to ``own``, then to the smallest class.
    """
    k = len(matrix)
    wide = np.vstack([matrix, matrix.T])
    owner = np.repeat(np.arange(len(own)), np.diff(first))
    times = np.bincount(owner, np.where(slots < k, n, 0), len(own))

    def gain(have: np.ndarray, more: np.ndarray, home: np.ndarray) -> np.ndarray:
        every = np.arange(len(have))
        less = have.copy()
        less[every, home] = np.maximum(less[every, home] - more, 0)
        return _xlogx(less + more[:, None]) - _xlogx(less)

    cells = gain(wide[slots], n.astype(float), own[owner])
    total = np.zeros((len(own), k))
    np.add.at(total, owner, cells)
    for sums in (matrix.sum(0), matrix.sum(1)):
        total -= gain(np.tile(sums, (len(own), 1)), times, own)
    best = total.argmax(1)
    every = np.arange(len(own))
    return np.where(total[every, best] > total[every, own] + 1e-6, best, own)


def _placed(contexts: DataFrame, bucket_kind: np.ndarray, by_class: np.ndarray) -> DataFrame:
    """(word, kind) of the words outside the core that are seen OWN times or more."""
    classes = len(by_class)
    shared = contexts.sparkSession.sparkContext.broadcast((bucket_kind, by_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_kind, by_class = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            slots, counts = batch.column(2), batch.column(3)
            first = np.concatenate([[0], np.cumsum(slots.value_lengths().to_numpy())])
            kinds = []
            # A thousand words at once: at most 128 thousand contexts of K numbers each, usually few.
            for at in range(0, batch.num_rows, 1000):
                cut = first[at : at + 1001]
                span = slice(cut[0], cut[-1])
                kinds.append(
                    place_words(
                        slots.flatten().to_numpy()[span],
                        counts.flatten().to_numpy()[span],
                        cut - cut[0],
                        bucket_kind[batch.column(1).to_numpy()[at : at + 1000]],
                        by_class,
                    )
                )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(kinds))], names=["word", "kind"])

    return (
        contexts.groupBy("word")
        # At most 2 K entries, one for each slot.
        .agg(
            F.min("bucket").alias("bucket"),
            F.collect_list(F.struct("slot", "n")).alias("c"),
            F.sum(F.when(F.col("slot") < classes, F.col("n"))).alias("times"),
        )
        .where(F.col("times") >= OWN)
        .select("word", "bucket", F.col("c.slot").alias("slot"), F.col("c.n").alias("n"))
        .mapInArrow(run, "word long, kind long")
    )


def fit(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model of these documents but for its class bigrams, and (word, n, kind) of all their words."""
    spark = docs.sparkSession
    counts = stored(word_counts(docs))
    sums = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("types")).first()
    tokens, types = sums["tokens"] or 0, sums["types"]
    end = F.lit(int(END.view(np.int64)))
    # At most 1 / CORE_SHARE rows.
    rows = counts.where((F.col("n") >= max(1, tokens * CORE_SHARE)) & (F.col("word") != end)).select("word", "n").toArrow()
    code, n = rows["word"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    code = code[np.lexsort((code, -n))]
    n_units = BUCKETS + len(code) + 1
    code = np.append(code, END)
    unit = BUCKETS + np.arange(len(code))
    order = np.argsort(code)
    core = Core(code[order], unit[order], n_units)
    bigrams = stored(_bigrams(docs, core))
    assigned, by_class = exchange(bigrams, np.arange(n_units) % classes, classes, rounds)
    bucket_kind = assigned[:BUCKETS]

    placed = _placed(_word_contexts(docs, core, assigned, classes), bucket_kind, by_class)
    of_core = spark.createDataFrame(pa.table({"word": core.code.view(np.int64), "kind": assigned[core.unit]}))
    of_bucket = spark.createDataFrame(pa.table({"bucket": np.arange(BUCKETS), "other": bucket_kind}))
    kinds = stored(
        counts.join(placed.union(of_core), "word", "left")
        # BUCKETS rows.
        .join(F.broadcast(of_bucket), "bucket")
        .select("word", "n", F.coalesce("kind", "other").alias("kind"))
    )

    per_class = np.zeros((2, classes))
    for r in kinds.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        per_class[:, r["kind"]] = r["n"], r["types"]
    # At most 1 / COMMON_SHARE rows.
    rows = kinds.where((F.col("n") >= max(1, tokens * COMMON_SHARE)) & (F.col("word") != end)).toArrow()
    ends = kinds.where(F.col("word") == end).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    code = np.append(rows["word"].to_numpy().view(np.uint64), END)
    n = np.append(rows["n"].to_numpy(), ends)
    kind = np.append(rows["kind"].to_numpy(), assigned[n_units - 1]).astype(np.int16)
    order = np.argsort(code)
    common = Common(code[order], n[order], kind[order])
    return Model(common, bucket_kind, np.log10(per_class.sum(0) + 1), tokens, types), kinds


DOCUMENT, RARE, PAIR = 0, 1, 2
PIECES = (
    "tag int, doc_id long, held_out boolean, _key long, n_tokens long, common long, base double, own double, "
    "cell array<int>, times array<int>, word long, second long, before int, after int, other int, second_other int, n int"
)


def _pieces(docs: DataFrame, model: Model, classes: int) -> DataFrame:
    """What class bigrams and scores are made of, by ``tag``: a document's counts and sums over common
    words; its rare words with the classes beside them (-1: rare too); its pairs of rare words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    all_types = np.log10(model.tokens + model.types + 1)
    schema = _arrow_schema()

    def piece(tag: int, size: int, **columns) -> pa.RecordBatch:
        columns["tag"] = np.full(size, tag, np.int32)
        arrays = []
        for f in schema:
            c = columns.get(f.name)
            if c is None:
                arrays.append(pa.nulls(size, f.type))
            else:
                arrays.append(c if isinstance(c, pa.Array) else pa.array(c, f.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def once(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One place of each distinct row, and how often it occurs."""
        key = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = mixed(key + c.astype(np.uint64) + np.uint64(1))
        _, one, n = np.unique(key, return_index=True, return_counts=True)
        return one, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        end = m.common.kind[_found(m.common.code, np.array([END]))[0][0]]
        for batch in batches:
            keys, held = batch.column(2).to_numpy(), batch.column(1)
            for at, to, code, bucket, first in _batches(batch.column(3)):
                place, same = _found(m.common.code, code)
                n = np.where(same, m.common.n[place], 0)
                kind = np.where(same, m.common.kind[place], -1).astype(np.int64)
                other = m.bucket_kind[bucket]
                before = np.empty_like(kind)
                before[1:] = kind[:-1]
                before[first[:-1]] = end
                owner = np.repeat(np.arange(to - at), np.diff(first))
                seen = np.log10(n + 1.0)

                both = np.flatnonzero((kind >= 0) & (before >= 0))
                cell, times = np.unique(
                    (owner[both] * classes + before[both]) * classes + kind[both], return_counts=True
                )
                offsets = np.searchsorted(cell, np.arange(to - at + 1) * classes * classes).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32)))
                    for v in (cell % (classes * classes), times)
                ]
                sums = [
                    np.add.reduceat(v.astype(float), first[:-1])
                    for v in (n > 0, seen - all_types, np.where(same, seen - m.divisor[kind], 0))
                ]
                yield piece(
                    DOCUMENT, to - at, doc_id=batch.column(0).slice(at, to - at), held_out=held.slice(at, to - at),
                    _key=keys[at:to], n_tokens=np.diff(first), common=sums[0].astype(np.int64), base=sums[1], own=sums[2],
                    cell=lists[0], times=lists[1],
                )

                rare = np.flatnonzero(~same)
                one, times = once(code[rare], owner[rare], before[rare] + 1, kind[rare + 1] + 1)
                one = rare[one]
                yield piece(
                    RARE, len(one), held_out=held.take(pa.array(at + owner[one])), _key=keys[at + owner[one]],
                    word=code[one].view(np.int64), before=before[one], after=kind[one + 1], other=other[one], n=times,
                )

                pair = np.flatnonzero((kind < 0) & (before < 0))
                one, times = once(code[pair - 1], code[pair], owner[pair])
                one = pair[one]
                yield piece(
                    PAIR, len(one), held_out=held.take(pa.array(at + owner[one])), _key=keys[at + owner[one]],
                    word=code[one - 1].view(np.int64), second=code[one].view(np.int64), other=other[one - 1],
                    second_other=other[one], n=times,
                )

    return docs.select("doc_id", "held_out", "_key", "text").mapInArrow(run, PIECES)


def _arrow_schema() -> pa.Schema:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in PIECES.split(", "))])


def _class_bigrams(parts: DataFrame, rare: DataFrame, pairs: DataFrame, classes: int) -> np.ndarray:
    """Class bigrams of the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy(), len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["cell", "n"])

    def cells(frame: DataFrame, before: str, after: str) -> DataFrame:
        known = frame.where((F.col(before) >= 0) & (F.col(after) >= 0) & ~F.col("held_out"))
        return known.select((F.col(before) * classes + F.col(after)).cast("long").alias("cell"), F.col("n").cast("long").alias("n"))

    counted = (
        parts.where((F.col("tag") == DOCUMENT) & ~F.col("held_out"))
        .select("cell", "times")
        .mapInArrow(run, "cell long, n long")
        .union(cells(rare, "before", "kind"))
        .union(cells(rare, "kind", "after"))
        .union(cells(pairs, "kind", "second_kind"))
    )
    out = np.zeros((classes, classes))
    # At most classes * classes rows.
    for r in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[divmod(r["cell"], classes)] = r["n"]
    return out


def _rare_sums(rare: DataFrame, pairs: DataFrame, model: Model, transition: np.ndarray) -> DataFrame:
    """(_key, _log, _own, _known): what rare words add to the base score, the score and the known words."""
    shared = rare.sparkSession.sparkContext.broadcast((model.divisor, transition))

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        divisor, transition = shared.value
        for batch in batches:
            before, after, kind, times, count = (c.to_numpy() for c in batch.columns[1:])
            seen = np.log10(count + 1.0)
            own = seen - divisor[kind]
            own += np.where(before >= 0, transition[before, kind], 0) + np.where(after >= 0, transition[kind, after], 0)
            columns = [batch.column(0), pa.array(times * seen), pa.array(times * own), pa.array(times * (count > 0).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "_log", "_own", "_known"])

    def pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, transition = shared.value
        for batch in batches:
            kind, second, times = (c.to_numpy() for c in batch.columns[1:])
            none = np.zeros(len(kind))
            columns = [batch.column(0), pa.array(none), pa.array(times * transition[kind, second]), pa.array(none.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "_log", "_own", "_known"])

    schema = "_key long, _log double, _own double, _known long"
    both = (
        rare.select("_key", "before", "after", "kind", "n", "count")
        .mapInArrow(words_of, schema)
        .union(pairs.select("_key", "kind", "second_kind", "n").mapInArrow(pairs_of, schema))
    )
    return both.groupBy("_key").agg(*[F.sum(c).alias(c) for c in ("_log", "_own", "_known")])


def scored(docs: DataFrame, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
    ).withColumn("_key", F.xxhash64("doc_id", "text"))
    model, kinds = fit(texts.where("not held_out"), classes, rounds)
    parts = stored(_pieces(texts, model, classes))
    first = kinds.select("word", F.col("n").alias("count"), F.col("kind").alias("_first"))
    after = kinds.select(F.col("word").alias("second"), F.col("kind").alias("_second"))
    kind = F.coalesce("_first", "other").cast("long").alias("kind")
    rare = stored(
        parts.where(F.col("tag") == RARE)
        .join(first, "word", "left")
        .select("_key", "held_out", "before", "after", "n", kind, F.coalesce("count", F.lit(0)).alias("count"))
    )
    pairs = stored(
        parts.where(F.col("tag") == PAIR)
        .join(first, "word", "left")
        .join(after, "second", "left")
        .select("_key", "held_out", "n", kind, F.coalesce("_second", "second_other").cast("long").alias("second_kind"))
    )
    by_class = _class_bigrams(parts, rare, pairs, classes)
    follow = by_class.sum(1, keepdims=True)
    transition = np.log10((by_class + SMOOTHING) / (follow + SMOOTHING * classes))
    shared = docs.sparkSession.sparkContext.broadcast(transition.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, times = batch.column(6), batch.column(7)
            owner = np.repeat(np.arange(batch.num_rows), cell.value_lengths().to_numpy())
            moves = np.bincount(owner, shared.value[cell.flatten().to_numpy()] * times.flatten().to_numpy(), batch.num_rows)
            score = pa.array(batch.column(5).to_numpy() + moves)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], score], names=["doc_id", "_key", "n_tokens", "_common", "_base", "_score"]
            )

    local = (
        parts.where(F.col("tag") == DOCUMENT)
        .select("doc_id", "_key", "n_tokens", "common", "base", "own", "cell", "times")
        .mapInArrow(run, "doc_id long, _key long, n_tokens long, _common long, _base double, _score double")
    )
    # Rows that share a key are the same row again; their sums come out as many times too large.
    same = parts.where(F.col("tag") == DOCUMENT).groupBy("_key").agg(F.count("*").alias("_rows"))
    rest = (
        _rare_sums(rare, pairs, model, transition)
        .join(same, "_key")
        .select("_key", *[(F.col(c) / F.col("_rows")).alias(c) for c in ("_log", "_own", "_known")])
    )
    score = F.col("_score") + F.coalesce("_own", F.lit(0.0))
    return local.join(rest, "_key", "left").select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD).alias("held_out"),
        "n_tokens",
        (F.col("_common") + F.coalesce(F.col("_known").cast("long"), F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_log", F.lit(0.0))).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )


def op3_class_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return scored(read(spark, folder, "documents"))
