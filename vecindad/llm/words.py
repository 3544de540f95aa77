"""Word spans and rolling hashes of many texts at once, on their UTF-8 bytes.

All functions take plain NumPy arrays; Spark hands them Arrow batches.  Words
are maximal runs of "word bytes"; both word classes used here treat every byte
of a multi-byte character alike, so byte work equals code point work.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Texts of one slice hold about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class Words(NamedTuple):
    """Words of a slice: byte spans, hashes, and the first word of each text (one more at the end)."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    first: np.ndarray


@cache
def spaced() -> np.ndarray:
    """Word bytes: all but space and TAB..CR."""
    mask = np.ones(256, bool)
    mask[[0x20, *range(0x09, 0x0E)]] = False
    return mask


@cache
def alphanumeric() -> np.ndarray:
    """Word bytes: ASCII letters and digits, and all bytes beyond ASCII."""
    mask = np.zeros(256, bool)
    mask[0x30:0x3A] = mask[0x41:0x5B] = mask[0x61:0x7B] = mask[0x80:] = True
    return mask


@cache
def byte_codes(lower: bool, seed: int = 0) -> np.ndarray:
    """A 64-bit code for each byte; with ``lower`` A-Z have those of a-z."""
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95 + 2 * seed))
    if lower:
        codes[0x41:0x5B] = codes[0x61:0x7B]
    return codes


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}
#: Powers kept in a worker; a longer text has its own.
KEPT_POWERS = 1 << 21


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base, or of its inverse, modulo 2^64."""
    key = "inverse" if inverse else "base"
    if len(_powers.get(key, ())) < n:
        steps = np.full(max(n, 1 << 16), _INVERSE if inverse else _BASE, np.uint64)
        steps[0] = 1
        if n > KEPT_POWERS:
            return np.cumprod(steps)
        _powers[key] = np.cumprod(steps)
    return _powers[key][:n]


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values)), out=out[1:])
    return out


def slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, bytes, offsets) of consecutive texts; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield at, to, raw[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    give_back()


@cache
def _trim():
    """glibc's malloc_trim, where there is one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda pad: 0


def give_back() -> None:
    """Freed memory goes back to the system: a Python worker outlives its task, and others need the room."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def words(raw: np.ndarray, offsets: np.ndarray, mask: np.ndarray, codes: np.ndarray | None) -> Words:
    """The words of a slice; no word goes from one text into the next."""
    inside = mask[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(raw), bool)
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    before[cuts] = False
    after[cuts - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, offsets)
    if codes is None:
        return Words(start, end, np.zeros(0, np.uint64), first)
    sums = _sums(codes[raw])
    code = mixed((sums[end] - sums[start]) * powers(len(raw) + 1, True)[start] + (end - start).astype(np.uint64))
    return Words(start, end, code, first)


def windows(code: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; runs over a text's end are the caller's to drop."""
    if len(code) < size:
        return np.zeros(0, np.uint64)
    values = mixed(code + np.uint64(salt)) if salt else code
    sums = _sums(values)
    n = len(code) - size + 1
    return mixed((sums[size:] - sums[:n]) * powers(n, True) + np.uint64(size))


def spread(starts: np.ndarray, size: int | np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of ``starts``."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + size, n), -1)
    return np.cumsum(marks)[:n] > 0
