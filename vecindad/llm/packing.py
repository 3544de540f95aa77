"""Hierarchical multi-length packing of tokenized documents.

Documents are routed to context-size tiers (powers of two): a document longer
than the longest tier gives full windows of that tier, and its rest goes to the
smallest tier that holds it.  Tiers are packed from long to short.  A window
opens with a document of its tier; its gap takes the longest whole documents
of shorter tiers that fit, then the head of one more document, whose rest is
routed again.  So every window is full; what no window can be filled with is
carried to the next block, and at the end of a partition cut into windows of
falling tiers.  At most one window per partition is padded.

Windows of a tier are dealt to step groups of equal tokens, so a training step
sees one window length and a constant amount of work.

There is no shuffle: each partition packs its own rows in blocks of bounded
size, and a lost task gives the same rows again.

Defined results: null and empty texts are one token (the end id); every row is
packed, repeated rows too; a null id stays null; an empty table gives no row;
other columns are left out.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from vecindad.llm.tables import read

TIERS = (2048, 1024, 512, 256, 128, 64)
#: Tokens of one step group: windows of one tier that add up to this.
STEP_TOKENS = 65_536
#: A block is packed when it holds this many tokens.
BLOCK_TOKENS = 1_000_000
#: Words kept with their ids in a worker; then the memory starts anew.
KNOWN_WORDS = 250_000
END = 1
_END = np.array([END], "<u4").tobytes()

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)

# Texts of these characters alone are not changed by NFC, and their lower case is plain.
_OTHER = re.compile(r"[^\x00-\x7f\xc0-\xff]")
_SPACED = re.compile(r"[^ \t-\r]+")
# Fixed by the tokenizer: its split pattern, for those characters.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+", re.ASCII)


class WordTokenizer:
    """Ids of a text by way of its words: each new word is tokenized once.

    The split is done here for plain Latin text; any other text is cut at
    white space, where the tokenizer joins nothing, and each chunk is given whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._model = self._whole.model
        self._byte = _byte_letters()
        self._parts: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text and the end."""
        known, out = self._parts, []
        if _OTHER.search(text) or "<|" in text:
            known = self._chunks
            for chunk in _SPACED.findall(text):
                got = known.get(chunk)
                if got is None:
                    got = self._keep(known, chunk, self._whole.encode(chunk, add_special_tokens=False).ids)
                out.append(got)
            return self._joined(out)
        for part in _PARTS.findall(text.lower()):
            got = known.get(part)
            if got is None:
                letters = "".join([self._byte[b] for b in part.encode()])
                got = self._keep(known, part, [t.id for t in self._model.tokenize(letters)])
            out.append(got)
        return self._joined(out)

    @staticmethod
    def _joined(parts: list[bytes]) -> np.ndarray:
        parts.append(_END)
        return np.frombuffer(b"".join(parts), "<u4")

    @staticmethod
    def _keep(known: dict, key: str, ids: list[int]) -> bytes:
        if len(known) >= KNOWN_WORDS:
            known.clear()
        known[key] = value = np.array(ids, "<u4").tobytes()
        return value


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for byte in range(256):
        out.append(chr(byte if byte in plain else 256 + extra))
        extra += byte not in plain
    return out


@cache
def tokenizer(path: str | None) -> WordTokenizer:
    """One per worker process."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    return WordTokenizer(path)


class Piece:
    __slots__ = ("doc", "ids", "start", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, n: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:n], self.total),
            Piece(self.doc, self.start + n, self.ids[n:], self.total),
        )


class Packer:
    """Packs the documents of one partition; ``windows`` yields (tier, pieces)."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = tiers
        self._routed: dict[int, list[Piece]] = {t: [] for t in tiers}
        self._ready: list[tuple[int, list[Piece]]] = []
        self.tokens = 0

    def add(self, doc, ids: np.ndarray) -> None:
        piece = Piece(doc, 0, ids, len(ids))
        while len(piece.ids) >= self.tiers[0]:
            head, piece = piece.cut(self.tiers[0])
            self._ready.append((self.tiers[0], [head]))
        self._route(piece)
        self.tokens += len(ids)

    def _route(self, piece: Piece) -> None:
        n = len(piece.ids)
        if n:
            tier = min((t for t in self.tiers if t >= n), default=self.tiers[0])
            self._routed[tier].append(piece)

    def windows(self, last: bool) -> Iterator[tuple[int, list[Piece]]]:
        """Full windows of what has been added; the rest too if it is the last call."""
        yield from self._ready
        self._ready = []
        pieces = dict(enumerate(p for t in self.tiers for p in self._routed[t]))
        self._routed = {t: [] for t in self.tiers}
        # Lengths with the pieces' numbers: the longest that fits is found by bisection.
        sizes = sorted((len(p.ids), k) for k, p in pieces.items())
        number = len(pieces)
        rest: list[Piece] = []
        for tier in self.tiers:
            while sizes and (sizes[-1][0] > tier // 2 or tier == self.tiers[-1]):
                window = [pieces.pop(sizes.pop()[1])]
                gap = tier - len(window[0].ids)
                while gap and sizes:
                    at = bisect_right(sizes, (gap, number)) - 1
                    if at >= 0:
                        piece = pieces.pop(sizes.pop(at)[1])
                    else:
                        piece, tail = pieces.pop(sizes.pop(0)[1]).cut(gap)
                        pieces[number] = tail
                        insort(sizes, (len(tail.ids), number))
                        number += 1
                    window.append(piece)
                    gap -= len(piece.ids)
                if gap:
                    rest += window
                else:
                    yield tier, window
        yield from self._join(rest, last)

    def _join(self, rest: list[Piece], last: bool) -> Iterator[tuple[int, list[Piece]]]:
        """Windows of the longest tier from pieces that filled none, cut where a window ends."""
        tier = self.tiers[0]
        total = sum(len(p.ids) for p in rest)
        rest = rest[::-1]
        while total >= (1 if last else tier):
            size = next((t for t in self.tiers if t <= total), total)
            window, gap = [], size
            while gap:
                piece = rest.pop()
                if len(piece.ids) > gap:
                    piece, tail = piece.cut(gap)
                    rest.append(tail)
                window.append(piece)
                gap -= len(piece.ids)
            total -= size
            yield (size if size in self.tiers else tier), window
        for piece in rest:
            self._route(piece)
        self.tokens = total


def pack(docs: DataFrame, path: str | None = None, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text), with its window, tier and step group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        words, packer = tokenizer(path), Packer(tiers)
        made = 0
        by_tier = dict.fromkeys(tiers, 0)

        def rows(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal made
            columns: list[list] = [[] for _ in range(9)]
            for tier, window in packer.windows(last):
                group = base + (tiers.index(tier) << 28) + by_tier[tier] * tier // STEP_TOKENS
                by_tier[tier] += 1
                offset = 0
                for p in window:
                    row = (p.doc, p.start, len(p.ids), zlib.crc32(p.ids), p.total, base + made, offset, tier, group)
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                    offset += len(p.ids)
                made += 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            names = [c.split()[0] for c in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, words.ids(text.as_py() or ""))
                if packer.tokens >= BLOCK_TOKENS:
                    yield from rows(False)
        yield from rows(True)

    chosen = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECES)


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read(spark, folder, "documents"))
