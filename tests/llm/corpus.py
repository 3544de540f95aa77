"""A small corpus with the awkward cases, and plain word splits."""

from __future__ import annotations

import random
import re
import zlib

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, n long, token long"


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds


def _sentence(rng: random.Random, n: int, vocabulary: int = 300) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.2 else f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def rows() -> list[tuple]:
    """Rows of SCHEMA: copies, near copies, long passages, short, empty, null and repeated rows; clashing column names."""
    rng = random.Random(5)
    passage = _sentence(rng, 60)
    texts: list[str | None] = []
    for k in range(40):
        words = _sentence(rng, rng.randrange(20, 200))
        if k % 4 == 0:
            at = rng.randrange(len(words))
            words[at:at] = passage
        texts.append(" ".join(words).replace(" w1 ", " W1.\n"))
    for k in range(0, 10, 2):
        words = texts[k].split(" ")
        words[len(words) // 2] = "changed"
        texts += [texts[k], " ".join(words)]
    texts += [None, "", " \t\n", "one", "one two three", "ONE two three", "a b " * 60, "x " * 40, "é\x0bü\x0cß", "€ 𝄞 \x00 ok"]
    texts.append(" ".join(_sentence(rng, 4000)))
    out = []
    for k, text in enumerate(texts):
        out.append((k, text, "en" if k % 3 else None, f"s{k % 2}", len(text or ""), "clash", 7, 8))
    out.append(out[3])
    out.append(out[44])
    out.append((None, texts[5], None, None, None, None, None, None))
    out.append((None, None, None, None, None, None, None, None))
    return out


def documents(spark, some: list[tuple] | None = None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def multiset(values) -> list:
    return sorted(values, key=repr)
