"""Benchmark decontamination by an FM-index of every training shard.

A shard is one Arrow batch of documents.  Its words become symbols of the test
phrases' vocabulary; a word outside it ends every match, so only runs of known
words at least as long as the shortest phrase are indexed, which loses nothing.
The index is the Burrows-Wheeler transform of the runs in a wavelet matrix with
rank counts per level, symbol offsets, and suffix positions sampled at every
eighth text position.  All phrases are searched backwards at once; rows found
are located by walking to the nearest sample; overlapping spans are merged.

Phrases are a stated query set: they are taken in blocks of bounded bytes, each
broadcast and searched in all documents before the next one is read.  Documents
are never shuffled.

Defined results: null texts have no words and no hits; null or empty items match
nothing; repeated rows are judged each on its own; an item id that repeats counts
once; an empty benchmark hits nothing; other columns are left out (clean() keeps
all columns of its input).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import own_names, read, stored
from vecindad.llm.words import alphanumeric, byte_codes, slices, words

WINDOW = 10
#: UTF-8 bytes of the items of one block; an item beyond it is a block of its own.
BLOCK_BYTES = 4_000_000
SAMPLE = 8
_FILTER_BITS = 20

_END, _BREAK, _FIRST = 0, 1, 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector with counts per level."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = []
        order = symbols.astype(np.int64)
        for shift in range(max(1, int(n_symbols - 1).bit_length()) - 1, -1, -1):
            bits = (order >> shift) & 1
            ones = np.zeros(len(order) + 1, np.int32)
            np.cumsum(bits, out=ones[1:])
            zeros = len(order) - int(ones[-1])
            self.levels.append((shift, ones, zeros))
            order = np.concatenate([order[bits == 0], order[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position."""
        low = np.zeros_like(at)
        for shift, ones, zeros in self.levels:
            bit = (symbol >> shift) & 1 == 1
            at = np.where(bit, zeros + ones[at], at - ones[at])
            low = np.where(bit, zeros + ones[low], low - ones[low])
        return at - low

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its rank there."""
        symbol, low = np.zeros_like(at), np.zeros_like(at)
        for shift, ones, zeros in self.levels:
            bit = ones[at + 1] > ones[at]
            symbol |= bit.astype(np.int64) << shift
            at = np.where(bit, zeros + ones[at], at - ones[at])
            low = np.where(bit, zeros + ones[low], low - ones[low])
        return symbol, at - low


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by prefix doubling; the last symbol is the unique least."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class FMIndex:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        order = suffix_array(symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.transform = WaveletMatrix(symbols[order - 1], n_symbols)
        self.sampled = np.flatnonzero(order % SAMPLE == 0)
        self.position = order[self.sampled]

    def ranges(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose suffixes begin with each phrase (one per line), by backward search."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.before[-1], np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            low[alive] = self.before[symbol] + self.transform.rank(symbol, low[alive])
            high[alive] = self.before[symbol] + self.transform.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        dead = np.ones(len(phrases), bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the nearest sampled suffix."""
        found = np.zeros(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            k = np.searchsorted(self.sampled, at)
            hit = (k < len(self.sampled)) & (self.sampled[np.minimum(k, len(self.sampled) - 1)] == at)
            found[open_[hit]] = self.position[k[hit]] + steps
            open_, at = open_[~hit], at[~hit]
            symbol, rank = self.transform.access(at)
            at = self.before[symbol] + rank
            steps += 1
        return found


class Phrases(NamedTuple):
    """The windows of a block of items over their vocabulary of word codes."""

    vocabulary: np.ndarray
    filter: np.ndarray
    #: For each window length: symbols (one window a line) and the items of each.
    windows: list[tuple[np.ndarray, list[tuple[str, ...]]]]


def phrases(items: list[tuple[str, str]], window: int = WINDOW) -> Phrases:
    found: dict[int, dict[tuple[int, ...], set[str]]] = {}
    texts = pa.array([t for _, t in items], pa.string())
    for at, _, raw, offsets in slices(texts):
        w = words(raw, offsets, alphanumeric(), byte_codes(True))
        for k in range(len(offsets) - 1):
            codes = w.code[w.first[k] : w.first[k + 1]].tolist()
            size = min(window, len(codes))
            for i in range(len(codes) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(tuple(codes[i : i + size]), set()).add(items[at + k][0])
    vocabulary = np.unique(np.array([c for g in found.values() for key in g for c in key], np.uint64))
    table = np.zeros(1 << _FILTER_BITS, bool)
    table[vocabulary & np.uint64((1 << _FILTER_BITS) - 1)] = True
    return Phrases(
        vocabulary,
        table,
        [
            (np.searchsorted(vocabulary, np.array(list(g), np.uint64)) + _FIRST, [tuple(sorted(s)) for s in g.values()])
            for g in found.values()
        ],
    )


def _symbols(code: np.ndarray, known: Phrases) -> np.ndarray:
    """Symbol of each word, 0 outside the vocabulary."""
    out = np.zeros(len(code), np.int64)
    may = np.flatnonzero(known.filter[code & np.uint64((1 << _FILTER_BITS) - 1)])
    at = np.minimum(np.searchsorted(known.vocabulary, code[may]), len(known.vocabulary) - 1)
    same = known.vocabulary[at] == code[may]
    out[may[same]] = at[same] + _FIRST
    return out




def search(texts: pa.Array, known: Phrases) -> tuple[np.ndarray, list[np.ndarray], list[set[str]]]:
    """Of each text: words, the hit words as sorted numbers, and the items found."""
    n_texts = len(texts)
    shortest = min((p.shape[1] for p, _ in known.windows), default=1)
    first, symbols, origin, n_words = [np.zeros(1, np.int64)], [], [], 0
    for _, _, raw, offsets in slices(texts):
        w = words(raw, offsets, alphanumeric(), byte_codes(True))
        first.append(w.first[1:] + n_words)
        if len(known.vocabulary) and len(w.code):
            symbol = _symbols(w.code, known)
            starts = np.zeros(len(symbol), bool)
            starts[0] = True
            starts[w.first[:-1][w.first[:-1] < len(symbol)]] = True
            starts[1:] |= (symbol[1:] == 0) | (symbol[:-1] == 0)
            run = np.flatnonzero(starts)
            length = np.diff(np.append(run, len(symbol)))
            for a, n in zip(*(x[(length >= shortest) & (symbol[run] > 0)] for x in (run, length)), strict=True):
                symbols += [symbol[a : a + n], [_BREAK]]
                origin += [np.arange(n_words + a, n_words + a + n), [-1]]
        n_words += len(w.code)
    bounds = np.concatenate(first)
    hit: list[np.ndarray] = [np.zeros(0, np.int64)] * n_texts
    items: list[set[str]] = [set() for _ in range(n_texts)]
    if not symbols:
        return np.diff(bounds), hit, items
    text = np.append(np.concatenate(symbols), _END).astype(np.int64)
    place = np.append(np.concatenate(origin), -1).astype(np.int64)
    index = FMIndex(text, len(known.vocabulary) + _FIRST)
    marks = np.zeros(n_words + 1, np.int32)
    for lines, owners in known.windows:
        low, high = index.ranges(lines)
        count = high - low
        which = np.repeat(np.arange(len(lines)), count)
        if not len(which):
            continue
        rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        at = place[index.locate(rows)]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + lines.shape[1], -1)
        owner = np.searchsorted(bounds, at, side="right") - 1
        for pair in np.unique(owner * len(lines) + which):
            items[pair // len(lines)].update(owners[pair % len(lines)])
    covered = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
    owner = np.searchsorted(bounds, covered, side="right") - 1
    for k in np.unique(owner):
        hit[k] = covered[owner == k] - bounds[k]
    return np.diff(bounds), hit, items


def blocks(benchmark: DataFrame, size: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items with a text, in blocks of bounded bytes."""
    block, held = [], 0
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null")
    for row in rows.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        held += len(row["text"].encode())
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


_FOUND = "_n_words long, _hit array<long>, _items array<string>"


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (with a column text) and the words hit in each row by any block, as _n_words, _hit, _items."""
    out = docs.withColumns(
        {
            "_n_words": F.lit(None).cast("long"),
            "_hit": F.lit(None).cast("array<long>"),
            "_items": F.lit(None).cast("array<string>"),
        }
    )
    done = 0
    for block in blocks(benchmark):
        if done:
            out = stored(out)
        out, done = _search_block(out, phrases(block, window)), done + 1
    return out if done else _search_block(out, phrases([], window))


def _search_block(docs: DataFrame, known: Phrases) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(known)
    at = {name: docs.columns.index(name) for name in ("text", "_hit", "_items")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, hit, items = search(batch.column(at["text"]), shared.value)
            for k, (old, ids) in enumerate(
                zip(batch.column(at["_hit"]).to_pylist(), batch.column(at["_items"]).to_pylist(), strict=True)
            ):
                if old:
                    hit[k] = np.union1d(hit[k], old)
                items[k] |= set(ids or ())
            columns = list(batch.columns[:-3]) + [
                pa.array(n_words, pa.int64()),
                pa.array(hit, pa.list_(pa.int64())),
                pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words hit, items found and their digest."""
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return matches(chosen, benchmark, window).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.size("_hit").cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.size("_hit") > 0).alias("contaminated"),
    )


@own_names
def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the merged spans: from a span's first word to its last, both included."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = batch.column(len(batch.columns) - 2)
            texts = batch.column(at).to_pylist()
            for k, numbers in enumerate(hit.to_pylist()):
                if numbers:
                    texts[k] = without(texts[k], np.array(numbers))
            columns = list(batch.columns[:-3])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-3])

    return matches(docs, benchmark, window).mapInArrow(run, docs.schema)


def without(text: str, numbers: np.ndarray) -> str:
    """The text without the words of these numbers and what stands between neighbours."""
    raw = text.encode()
    view = np.frombuffer(raw, np.uint8)
    w = words(view, np.array([0, len(raw)]), alphanumeric(), None)
    opens = np.flatnonzero(np.diff(numbers, prepend=-2) > 1)
    closes = np.append(opens[1:] - 1, len(numbers) - 1)
    kept, at = [], 0
    for a, b in zip(w.start[numbers[opens]], w.end[numbers[closes]], strict=True):
        kept.append(raw[at:a])
        at = b
    return b"".join([*kept, raw[at:]]).decode()


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
