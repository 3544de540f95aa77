"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled whole, so copies meet and are counted; every distinct text is
tokenized and aligned once.  How often two ids end together is counted with the
copies as weights, each text is measured against those counts, and the measures go
back to the documents by the text's SHA-256.

A text is read as a space and itself.  Both tokenizers are cut between a character
and the ASCII white space after it, unless a piece holds that white space: no token of
theirs reaches over such a place, so what stands between two cuts is aligned by itself,
and a worker keeps the result for the next time.  Where a vocabulary or a text does not allow such cuts (other white space,
characters that engines may class in different ways) the text is aligned whole.

The counts of id pairs are joined with the pairs of each text; Spark broadcasts them if
their stored table is small, and shuffles otherwise.

Defined results: null and empty texts, and texts whose token bytes do not give them back
(say, with U+2581), have no tokens, zeros and an empty hash; repeated rows count as
copies and are returned each; a null id stays null; ties for an id's highest count are
all highest; an empty table gives no row; other columns are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.tables import read, stored

#: Cut texts kept with their alignment in a worker; then the memory starts anew.
KNOWN_CHUNKS = 250_000
#: Texts of about so many bytes are aligned together.
SLICE_BYTES = 2_000_000

# Fixed by the byte-level vocabulary: how text is split before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: What a piece vocabulary writes for a space.
_SPACE = "\u2581"
# White space beyond ASCII, and what some engines take for it.
_WHOLE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
# Characters whose class (letter, number, other) is the same in every engine.
_PLAIN = re.compile(r"[\x00-\u024f\u2010-\u2027\u2030-\u203a\u20ac]*")


class Chunk(NamedTuple):
    """Numbers of tokens and groups, the groups as text, links as (a << 32 | b) in 8 bytes each, and the groups."""

    n_a: int
    n_b: int
    n_groups: int
    text: bytes
    links: bytes


def _byte_of_letter() -> dict[str, int]:
    """The byte that each printable letter of a byte-level vocabulary stands for."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in plain)
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(others)}}


class ByteTokenizer:
    """Ids and bytes of a byte-level vocabulary; special tokens are ordinary text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters = _byte_of_letter()
        self.bytes = {i: bytes(letters[c] for c in piece) for piece, i in model["vocab"].items() if all(c in letters for c in piece)}
        self._path, self._whole = path, None
        self._ranked = self._by_rank(model)

    def _by_rank(self, model: dict):
        """The same vocabulary as ranks, if its ids are in the order of its merges."""
        import tiktoken

        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"].get(a + b, -1) for a, b in pairs]
        if any(x >= y for x, y in zip(ids, ids[1:], strict=False)):
            return None
        first = {c: model["vocab"].get(c) for c in _byte_of_letter()}
        if None in first.values() or (ids and max(first.values()) >= ids[0]):
            return None
        known = {*first.values(), *ids}
        ranks = {data: i for i, data in self.bytes.items() if i in known}
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self._ranked is not None and _PLAIN.fullmatch(text):
            return self._ranked.encode_ordinary(text)
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._path)
            self._whole.encode_special_tokens = True
        return self._whole.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """Ids and bytes of a piece vocabulary that puts a space before its text."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size())]
        self.bytes = {
            i: bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in pieces
        }
        self._space = model.piece_to_id(_SPACE)
        plain = [p for i, p in pieces if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        # White space that pieces hold is no place to cut.
        held = "".join(sorted({c for p in plain for c in re.findall("[\t-\r ]", p)}))
        more = f"(?:[{re.escape(held)}][\t-\r ]*[^\t-\r ]*)*" if held else ""
        probe = "a  b\n c "
        able = " " not in held and not any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p in plain)
        if able and b"".join(self.bytes[i] for i in model.encode(probe)) == b" " + probe.encode():
            self.cuts = re.compile(f"[\t-\r ]*[^\t-\r ]+{more}|[\t-\r ]+")
        else:
            self.cuts = None

    def ids(self, text: str) -> list[int]:
        """Ids of a text that begins with white space, which the model itself puts before a text."""
        if text == " ":
            return [self._space]
        if text[0] == " ":
            return self._model.encode(text[1:], num_threads=1)
        ids = self._model.encode(text, num_threads=1)
        return ids[1:] if ids and ids[0] == self._space else [0]


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteTokenizer(path_a), PieceTokenizer(path_b)
        self._known: dict[str, Chunk | None] = {}
        # By id, and whether it is the last of its group: the id as text and what follows it.
        self._written, self._sizes, self._shift = [], [], 0
        for side, end in ((self.a, "|"), (self.b, ";")):
            top = max(side.bytes) + 1
            self._sizes.append(np.array([len(side.bytes.get(i, b"")) for i in range(top)]))
            self._shift = len(self._written)
            self._written += [f"{i}{c}".encode() for i in range(top) for c in (",", end)]

    def groups(self, text: str) -> list[tuple[list[int], list[int], int]] | None:
        """(ids of A, ids of B, bytes) of each group of a text that begins with white space."""
        ids = self.a.ids(text), self.b.ids(text)
        parts = [[t.bytes.get(i, b"") for i in x] for t, x in zip((self.a, self.b), ids, strict=True)]
        if not (b"".join(parts[0]) == b"".join(parts[1]) == text.encode()):
            return None
        out, at = [], [0, 0]
        begun, ends = [0, 0], [0, 0]
        while at[0] < len(parts[0]) or at[1] < len(parts[1]):
            side = 0 if ends[0] <= ends[1] else 1
            ends[side] += len(parts[side][at[side]])
            at[side] += 1
            if ends[0] == ends[1]:
                out.append((ids[0][begun[0] : at[0]], ids[1][begun[1] : at[1]], len(b"".join(parts[0][begun[0] : at[0]]))))
                begun = list(at)
        return out

    def _alone(self, text: str) -> Chunk | None:
        groups = self.groups(text)
        if groups is None:
            return None
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b, _ in groups)
        links = np.array([a[-1] << 32 | b[-1] for a, b, _ in groups], "<i8").tobytes()
        return Chunk(sum(len(a) for a, _, _ in groups), sum(len(b) for _, b, _ in groups), len(groups), written.encode(), links)

    def _together(self, texts: list[str]) -> list[Chunk | None]:
        """Plain chunks that end with no white space, aligned as one text: it has cuts between them."""
        whole = "".join([" x", *texts])
        ids = [np.array(side.ids(whole), np.int64) for side in (self.a, self.b)]
        raw = whole.encode()
        if any(b"".join([side.bytes.get(i, b"") for i in x.tolist()]) != raw for side, x in zip((self.a, self.b), ids, strict=True)):
            return [self._alone(text) for text in texts]
        stops = [np.cumsum(size[x]) for size, x in zip(self._sizes, ids, strict=True)]
        ends, *last = np.intersect1d(*stops, assume_unique=True, return_indices=True)
        # Tokens in the order A of a group, B of it: A of group g follow all B of the groups before.
        of = [np.searchsorted(ends, stop) for stop in stops]
        before = [np.concatenate([[0], x + 1]) for x in last]
        places = [np.arange(len(of[0])) + before[1][of[0]], np.arange(len(of[1])) + before[0][of[1] + 1]]
        order = np.zeros(len(of[0]) + len(of[1]), np.int64)
        for k in (0, 1):
            final = np.zeros(len(of[k]), np.int64)
            final[last[k]] = 1
            order[places[k]] = ids[k] * 2 + final + k * self._shift
        table = self._written
        pieces = [table[i] for i in order.tolist()]
        links = (ids[0][last[0]] << 32 | ids[1][last[1]]).astype("<i8").tobytes()
        sizes = [2, *[len(t.encode()) for t in texts]]
        cuts = np.searchsorted(ends, np.cumsum(sizes)) + 1
        tokens = [x[cuts].tolist() for x in before]
        cuts = cuts.tolist()
        out = []
        for k in range(len(texts)):
            g, h = cuts[k], cuts[k + 1]
            a, b, c, d = tokens[0][k], tokens[0][k + 1], tokens[1][k], tokens[1][k + 1]
            out.append(Chunk(b - a, d - c, h - g, b"".join(pieces[a + c : b + d])[:-1], links[8 * g : 8 * h]))
        return out

    def parts(self, text: str) -> list[str]:
        """The text with its space, cut where both tokenizers begin anew."""
        whole = " " + text
        return [whole] if self.b.cuts is None or _WHOLE.search(text) else self.b.cuts.findall(whole)

    def align(self, texts: list[str]) -> list[list[Chunk] | None]:
        """The chunks of each text; None if its tokens do not give it back."""
        known = self._known
        if len(known) >= KNOWN_CHUNKS:
            known.clear()
        parts = [self.parts(text) for text in texts]
        new = list(dict.fromkeys([p for some in parts for p in some if p not in known]))
        plain = [p for p in new if self.b.cuts and not p[-1].isspace() and _PLAIN.fullmatch(p) and not _WHOLE.search(p)]
        made = dict(zip(plain, self._together(plain), strict=True))
        made.update((p, self._alone(p)) for p in new if p not in made)
        get = known.get
        out = []
        for some in parts:
            chunks = [get(p) or made.get(p) for p in some]
            out.append(None if None in chunks else chunks)
        known.update((p, c) for p, c in made.items() if c is not None and len(p) <= 64)
        return out


@cache
def aligner(path_a: str | None, path_b: str | None) -> Aligner:
    """One per worker process."""
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    return Aligner(path_a, path_b)


ALIGNED = (
    "text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "links array<struct<a:int,b:int,n:int>>"
)
_LINK = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int32())])


def _batch(rows: list[tuple], links: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(c) for c, _ in links])]).astype(np.int32)
    code = np.concatenate([c for c, _ in links] or [np.zeros(0, np.int64)])
    times = np.concatenate([n for _, n in links] or [np.zeros(0, np.int64)])
    flat = pa.StructArray.from_arrays(
        [pa.array((code >> 32).astype(np.int32)), pa.array(code.astype(np.int32)), pa.array(times.astype(np.int32))],
        fields=list(_LINK),
    )
    kinds = [pa.binary(), *[pa.int64()] * 5, pa.string()]
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in re.split(r", (?=\w+ )", ALIGNED)])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of SLICE_BYTES bytes or more, but for the last."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for k, size in enumerate(sizes.tolist(), 1):
        held += size
        if held >= SLICE_BYTES or k == len(sizes):
            yield at, k
            at, held = k, 0


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per distinct text that has words to align: its copies, measures and links (each id pair once, n times)."""
    text = F.col("text").cast("string")
    texts = docs.select(text.alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = aligner(path_a, path_b)
        for batch in batches:
            for at, to in _slices(batch.column(0)):
                some = batch.column(0).slice(at, to - at).to_pylist()
                copies = batch.column(1).slice(at, to - at).to_pylist()
                rows, links = [], []
                for text, n, chunks in zip(some, copies, two.align(some), strict=True):
                    if chunks is None:
                        continue
                    code = np.frombuffer(b"".join([c.links for c in chunks]), "<i8")
                    groups = hashlib.sha256(b";".join([c.text for c in chunks])).hexdigest()
                    sizes = sum([c.n_a for c in chunks]), sum([c.n_b for c in chunks]), len(code), len(code)
                    rows.append((hashlib.sha256(text.encode()).digest(), n, *sizes, groups))
                    links.append(np.unique(code, return_counts=True))
                if rows:
                    yield _batch(rows, links)

    return texts.mapInArrow(run, ALIGNED)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(a, b, count, best) of ``aligned`` texts: links of two ids in the corpus, copies included; best: the highest of b.

    An id of B has no more rows than A has ids.
    """
    counted = texts.select("copies", F.inline("links")).groupBy("a", "b").agg(F.sum(F.col("n") * F.col("copies")).alias("count"))
    highest = counted.groupBy("b").agg(F.max("count").alias("_most"))
    return counted.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("_most")).alias("best"))


def measured(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``aligned`` texts with n_best and count_sum against stored pair counts."""
    sums = (
        texts.select("text_key", F.inline("links"))
        .join(pairs, ["a", "b"])
        .groupBy("text_key")
        .agg(
            F.sum(F.when(F.col("best"), F.col("n").cast("long"))).alias("n_best"),
            F.sum(F.col("n") * F.col("count")).alias("count_sum"),
        )
    )
    return texts.drop("links", "copies").join(sums, "text_key", "left")


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document: numbers of tokens, groups and links, and how common its links are in the corpus."""
    texts = stored(aligned(docs, path_a, path_b))
    pairs = stored(pair_counts(texts))
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(F.col("text").cast("string").cast("binary"), 256)).alias("text_key"),
    )
    return keyed.join(measured(texts, pairs), "text_key", "left").select(
        "doc_id",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in MEASURES],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )


def spans(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document and group: byte span in the space and text, ids of A, ids of B."""
    schema = "doc_id long, start long, end long, a array<int>, b array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = aligner(path_a, path_b)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                groups = [two.groups(part) for part in two.parts(text)] if text else []
                if not groups or None in groups:
                    continue
                flat = [g for part in groups for g in part]
                ends = np.cumsum([size for _, _, size in flat])
                sizes = np.array([size for _, _, size in flat])
                columns = [pa.array([doc] * len(flat), pa.int64()), pa.array(ends - sizes), pa.array(ends)]
                columns += [pa.array([g[k] for g in flat], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "end", "a", "b"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment(read(spark, folder, "documents"))
