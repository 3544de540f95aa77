"""Long repeated passages by a compacted De Bruijn graph of token k-mers.

A window is 35 consecutive words.  The k-mers (18 words) that are least by hash
in some window are its anchors: about one word in ten, chosen by content alone,
so equal windows have equal anchors at equal places, and neighbours overlap or
touch.  Anchors are the nodes of the graph; each step from an anchor to the next
one, with its distance, is an edge.

1. Nodes: occurrences of each anchor, and whether all of them are followed
   (preceded) by one and the same edge.  Map-side combine; one row per node.
2. Repeated nodes go back to the documents by a join; each document compacts its
   runs of nonbranching edges into paths.  All occurrences of a node on such a
   path run along the whole path, so every window inside it is known to repeat.
3. Windows that begin with a repeated anchor but reach over a path's end are
   verified by their 128-bit hash and source: those counted once are unique.
4. Words covered by repeated windows are removed.

Hot passages are combined before the shuffle in 1 and 3; the join in 2 is an
ordinary sort-merge join, open to the adaptive skew split.  What comes back to a
document is never longer than the document.

Defined results: null texts have no words (digest of the empty text); repeated
rows are documents of their own and so repeat each other; null ids stay null;
documents under 35 words lose nothing; an empty table gives no row; other columns
are left out (clean() keeps all columns of its input).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import own_names, read, row_key, stored
from vecindad.llm.words import Words, byte_codes, mixed, slices, spaced, windows, words

WINDOW = 35
_SECOND = 0x5851F42D4C957F2D


def _sliding(values: np.ndarray, size: int, pick: Callable) -> np.ndarray:
    """Least or greatest of each ``size`` consecutive values, by doubling."""
    out, width = values, 1
    while width * 2 <= size:
        out, width = pick(out[:-width], out[width:]), width * 2
    rest = size - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


class Anchors(NamedTuple):
    """Of a slice: for each word whether a window starts there, and the least k-mer of that
    window; the anchors' places and hashes; the number of words a k-mer has."""

    valid: np.ndarray
    least: np.ndarray
    at: np.ndarray
    code: np.ndarray
    same: np.ndarray
    k: int


def anchors(w: Words, window: int) -> Anchors | None:
    k = window // 2 + 1
    n = len(w.code) - window + 1
    if n <= 0:
        return None
    valid = np.ones(n, bool)
    for b in w.first[1:-1]:
        valid[max(0, b - window + 1) : b] = False
    kmers = windows(w.code, k)
    least = _sliding(kmers, window - k + 1, np.minimum)[:n]
    # A k-mer is an anchor if it is the least of a valid window that holds it.
    width = window - k + 1
    held = np.zeros(n + 2 * (width - 1), np.uint64)
    held[width - 1 : width - 1 + n] = np.where(valid, least, 0)
    at = np.flatnonzero(_sliding(held, width, np.maximum) == kmers[: n + width - 1])
    owner = np.searchsorted(w.first, at, side="right")
    return Anchors(valid, least, at, kmers[at], owner[1:] == owner[:-1], k)


def _edges(a: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """The edge after and before each anchor; 0 at the ends of a text."""
    after, before = np.zeros(len(a.at), np.uint64), np.zeros(len(a.at), np.uint64)
    gap = np.diff(a.at).astype(np.uint64)
    after[:-1] = np.where(a.same, mixed(a.code[1:] * np.uint64(3) + gap), 0)
    before[1:] = np.where(a.same, mixed(a.code[:-1] * np.uint64(5) + gap), 0)
    return after, before


class Judged(NamedTuple):
    known: np.ndarray
    open: np.ndarray


def judge(a: Anchors, node: np.ndarray, out: np.ndarray, into: np.ndarray, window: int) -> Judged:
    """Starts of windows known to repeat, and of those to verify.  node: repeated anchors, sorted."""

    def lookup(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(node, code), len(node) - 1)
        return node[place] == code, place

    nothing = np.zeros(0, np.int64)
    if not len(node) or not len(a.at):
        return Judged(nothing, nothing)
    repeated, place = lookup(a.code)
    link = a.same & repeated[:-1] & repeated[1:] & out[place[:-1]] & into[place[1:]]
    path = np.concatenate([[0], np.cumsum(~link)])
    opens = np.flatnonzero(np.diff(path, prepend=-1))
    closes = np.append(opens[1:] - 1, len(path) - 1)
    marks = np.zeros(len(a.least) + 1, np.int64)
    low, high = a.at[opens], np.minimum(a.at[closes] + a.k - window + 1, len(a.least))
    inside = (high > low) & repeated[opens]
    np.add.at(marks, low[inside], 1)
    np.add.at(marks, high[inside], -1)
    known = np.cumsum(marks[:-1]) > 0
    # The least k-mer stays the same over many windows: it is looked up once for each run.
    run = np.flatnonzero(np.concatenate([[True], a.least[1:] != a.least[:-1]]))
    may = np.repeat(lookup(a.least[run])[0], np.diff(np.append(run, len(a.least))))
    return Judged(np.flatnonzero(known & a.valid), np.flatnonzero(may & a.valid & ~known))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _slices(column: pa.Array):
    for at, to, raw, offsets in slices(column):
        yield at, to, raw, offsets, words(raw, offsets, spaced(), byte_codes(False))


def nodes(docs: DataFrame, window: int) -> DataFrame:
    """Anchors found twice or more: node, and whether its edge out and in is always the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, _, w in _slices(batch.column(0)):
                if (a := anchors(w, window)) is not None and len(a.at):
                    after, before = _edges(a)
                    yield pa.RecordBatch.from_arrays(
                        [_signed(a.code), _signed(after), _signed(before)], names=["node", "after", "before"]
                    )

    return (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(run, "node long, after long, before long")
        .groupBy("node")
        .agg(
            F.count("*").alias("n"),
            F.min("after").alias("after"),
            F.max("after").alias("last_after"),
            F.min("before").alias("before"),
            F.max("before").alias("last_before"),
        )
        .where("n > 1")
        .select(
            "node",
            F.when(F.col("after") == F.col("last_after"), 1).otherwise(0).cast("byte").alias("out"),
            F.when(F.col("before") == F.col("last_before"), 1).otherwise(0).cast("byte").alias("into"),
        )
    )


def _places(docs: DataFrame, window: int) -> DataFrame:
    """(node, _key): the different anchors of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for at, _, _, _, w in _slices(batch.column(1)):
                if (a := anchors(w, window)) is not None and len(a.at):
                    owner = np.searchsorted(w.first, a.at, side="right") - 1
                    once = np.unique(a.code + mixed(owner.astype(np.uint64)), return_index=True)[1]
                    yield pa.RecordBatch.from_arrays(
                        [_signed(a.code[once]), pa.array(keys[at + owner[once]])], names=["node", "_key"]
                    )

    return docs.select("_key", F.col("text").cast("string").alias("text")).mapInArrow(run, "node long, _key long")


def _marked(docs: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """Documents with a row key, and the repeated nodes of each key."""
    keyed = docs.withColumn("_key", row_key(F.col("doc_id"), F.col("text")))
    # Stored, so that both sides of the join are shuffled for it alone and hot nodes can be split.
    found = stored(nodes(docs, window))
    marks = (
        _places(keyed, window)
        .join(found, "node")
        .groupBy("_key")
        .agg(F.collect_set(F.struct("node", "out", "into")).alias("_nodes"))
        .select("_key", F.col("_nodes.node").alias("_node"), F.col("_nodes.out").alias("_out"), F.col("_nodes.into").alias("_into"))
    )
    return keyed, stored(marks)


def _flat(column: pa.Array, at: int, to: int, kind) -> np.ndarray:
    part = column.slice(at, to - at)
    return part.flatten().to_numpy(zero_copy_only=False).astype(kind)


def _judged(batch: pa.RecordBatch, names: list[str], window: int):
    """Slices of a batch of marked documents, judged by the nodes of their rows."""
    column = {name: batch.column(names.index(name)) for name in ("text", "_node", "_out", "_into")}
    for at, to, raw, offsets, w in _slices(column["text"]):
        node = _flat(column["_node"], at, to, np.int64).view(np.uint64)
        node, first = np.unique(node, return_index=True)
        out = _flat(column["_out"], at, to, np.int8)[first] > 0
        into = _flat(column["_into"], at, to, np.int8)[first] > 0
        a = anchors(w, window)
        nothing = np.zeros(0, np.int64)
        yield at, to, raw, offsets, w, judge(a, node, out, into, window) if a else Judged(nothing, nothing)


def unique_windows(marked: DataFrame, window: int) -> DataFrame:
    """Of the windows to verify, those that occur once: their hashes by key."""
    names = marked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(names.index("_key")).to_numpy()
            for at, _, _, _, w, judged in _judged(batch, names, window):
                if len(judged.open):
                    key = keys[at + np.searchsorted(w.first, judged.open, side="right") - 1]
                    hashes = [_signed(windows(w.code, window, salt)[judged.open]) for salt in (0, _SECOND)]
                    yield pa.RecordBatch.from_arrays([*hashes, pa.array(key)], names=["_one", "_two", "_key"])

    return (
        marked.mapInArrow(run, "_one long, _two long, _key long")
        .groupBy("_one", "_two")
        .agg(F.count("*").alias("n"), F.min("_key").alias("_key"))
        .where("n = 1")
        .groupBy("_key")
        .agg(F.collect_list("_one").alias("_unique"))
    )


def _removal(docs: DataFrame, window: int, make: Callable, schema) -> DataFrame:
    """``make(batch, judged slices)`` on documents joined with what is known of their windows."""
    keyed, marks = _marked(docs, window)
    marked = keyed.join(marks, "_key", "left")
    found = marked.join(unique_windows(marked, window), "_key", "left")
    names = found.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unique = batch.column(names.index("_unique"))

            def removed():
                for at, to, raw, offsets, w, judged in _judged(batch, names, window):
                    starts = judged.known
                    if len(judged.open):
                        once = _flat(unique, at, to, np.int64).view(np.uint64)
                        again = ~np.isin(windows(w.code, window)[judged.open], once)
                        starts = np.concatenate([starts, judged.open[again]])
                    marks = np.zeros(len(w.start) + 1, np.int64)
                    np.add.at(marks, starts, 1)
                    np.add.at(marks, starts + window, -1)
                    yield at, to, raw, offsets, w, np.cumsum(marks[:-1]) > 0

            yield make(batch, names, removed())

    return found.mapInArrow(run, schema)


def _kept(raw: np.ndarray, w: Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kept words joined by one space, all texts of a slice; and where each text's part begins."""
    keep = np.flatnonzero(~gone)
    owner = np.searchsorted(w.first, keep, side="right") - 1
    last = np.ones(len(keep), bool)
    last[:-1] = owner[1:] != owner[:-1]
    size = w.end[keep] - w.start[keep] + ~last
    ends = np.cumsum(size)
    take = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(w.start[keep], size)
    out = raw[np.minimum(take, len(raw) - 1)] if len(take) else np.zeros(0, np.uint8)
    out[ends[~last] - 1] = 0x20
    bounds = np.concatenate([[0], ends])[np.searchsorted(owner, np.arange(len(w.first)), side="left")]
    return out, bounds


def repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: words, words removed, and the digest of what is kept."""

    def make(batch: pa.RecordBatch, names: list[str], parts) -> pa.RecordBatch:
        n_words, n_removed, digests = [], [], []
        for _, to, raw, _, w, gone in parts:
            n_words.append(np.diff(w.first))
            n_removed.append(np.diff(np.concatenate([[0], np.cumsum(gone)])[w.first]))
            out, bounds = _kept(raw, w, gone)
            digests += [
                hashlib.sha256(out[a:b]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
            ]
        none = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(names.index("doc_id")),
                pa.array(np.concatenate(n_words or none), pa.int64()),
                pa.array(np.concatenate(n_removed or none), pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return _removal(chosen, window, make, "doc_id long, n_words long, n_removed long, kept_sha256 string")


@own_names
def clean(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the repeated words and the white space after each of them."""
    columns = docs.columns

    def make(batch: pa.RecordBatch, names: list[str], parts) -> pa.RecordBatch:
        texts = batch.column(names.index("text")).to_pylist()
        for at, to, raw, offsets, w, gone in parts:
            for k in np.unique(np.searchsorted(w.first, np.flatnonzero(gone), side="right") - 1).tolist():
                a, b = w.first[k], w.first[k + 1]
                ends = np.append(w.start[a + 1 : b], offsets[k + 1])
                opens = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0) == 1)
                closes = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), append=0) == -1)
                kept, place = [], offsets[k]
                for i, j in zip(opens.tolist(), closes.tolist(), strict=True):
                    kept.append(raw[place : w.start[a + i]].tobytes())
                    place = ends[j]
                texts[at + k] = b"".join([*kept, raw[place : offsets[k + 1]].tobytes()]).decode()
        arrays = [batch.column(names.index(c)) for c in columns]
        arrays[columns.index("text")] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(arrays, names=columns)

    return _removal(docs, window, make, docs.schema)


def op6_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated(read(spark, folder, "documents"))
