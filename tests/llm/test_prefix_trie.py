from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from tests.llm.corpus import multiset
from vecindad.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, digest int, depth string, value long"


def conversations() -> list[tuple]:
    rng = random.Random(9)
    some = ["hi", "how", "é𝄞", "", None, "x" * 5000]
    out = []
    for base in (0, 100, 300, -200):
        for k in range(base, base + 30):
            if k == 300:
                continue  # a group without its base
            for turn in range(rng.randrange(0, 8)):
                out.append((k, turn, rng.choice(["user", "assistant", None]), rng.choice(some)))
    out += [(200, t, "user", f"long {t % 7}") for t in range(3000)]
    out += [(201, t, "user", f"long {t % 7}") for t in range(2500)]
    out += [(k, t, "user", f"same {t}") for k in range(400, 480) for t in range(7)]
    out += [(500, None, "user", "null turn"), (500, 1, "user", "one"), (500, 1, "user", "one"), (500, 1, "assistant", "tie")]
    out += [(None, 1, "user", "nobody's")]
    return [(*row, 1, "clash", 2) for row in out]


def brute(rows) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), digest, role, text))
    turns = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        rest = abs(c) % 100 * (1 if c > 0 else -1)
        built[c] = tuple(turns.get(c - rest, [])[:h] + turns[c][h:])
    numbers: dict[tuple, int] = {}
    nodes: dict[int, dict] = {}
    parents: dict[int, int | None] = {}

    def node(key, parent, depth, text):
        if key not in numbers:
            numbers[key] = len(numbers)
            parents[numbers[key]] = parent
            nodes[numbers[key]] = {"members": [], "ends": [], "children": 0, "depth": depth, "text": text}
            if parent is not None:
                nodes[parent]["children"] += 1
        return numbers[key]

    for c in sorted(built):
        at = node((), None, 0, "")
        nodes[at]["members"].append(c)
        for d, turn in enumerate(built[c], 1):
            at = node((at, turn), at, d, turn[1])
            nodes[at]["members"].append(c)
        nodes[at]["ends"].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for k in sorted(nodes, reverse=True):  # children have larger numbers
        n = nodes[k]
        leaves[k] += n["children"] == 0
        saved[k] += (len(n["members"]) - 1) * len(n["text"])
        if parents[k] is not None:
            leaves[parents[k]] += leaves[k]
            saved[parents[k]] += saved[k]
    return [
        (
            min(n["members"]),
            n["depth"],
            None if parents[k] is None else min(nodes[parents[k]]["members"]),
            len(n["members"]),
            n["children"],
            leaves[k],
            saved[k],
            hashlib.sha256(",".join(map(str, n["ends"])).encode()).hexdigest(),
        )
        for k, n in nodes.items()
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def found(trie):
    return multiset(tuple(r) for r in trie.select(*prefix_trie.NODE).collect())


def test_against_brute_force(spark):
    rows = conversations()
    assert found(prefix_trie.trie(frame(spark, rows))) == multiset(brute(rows))


def test_long_conversations_lie_in_several_partitions(spark):
    rows = conversations()
    numbered = prefix_trie._numbered(prefix_trie._turns(frame(spark, rows)), 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        kept = spark.createDataFrame(numbered.collect(), numbered.schema)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = {(r["conv"], r["part"]) for r in kept.select("conv", "part").collect()}
    assert len([p for c, p in parts if c == 200]) > 1
    placed = prefix_trie._placed(kept, 0).where("conv = 200").orderBy("place").collect()
    assert [r["place"] for r in placed] == list(range(1, 3001))
    base, value = prefix_trie.base_of(0), 0
    for r in placed:
        assert prefix_trie.number(bytes(r["before"])) == value
        value = (value + prefix_trie.number(bytes(r["digest"])) * pow(base, r["place"], prefix_trie.PRIME)) % prefix_trie.PRIME
        assert prefix_trie.number(bytes(r["value"])) == value


def test_mixed_fingerprints_are_done_again(spark, monkeypatch):
    """With 1 as base the order of turns does not count: such nodes are seen, and another base is taken."""
    rows = [r for r in conversations() if r[0] is not None and abs(r[0]) < 130]
    for conv, last in ((601, "ab"), (602, "ba")):
        rows += [(conv, t, "user", text, 1, "", 1) for t, text in enumerate(["z"] * 5 + list(last))]
    plain = prefix_trie.base_of
    monkeypatch.setattr(prefix_trie, "base_of", lambda seed: plain(seed) if seed else 1)
    data = frame(spark, rows)
    placed = prefix_trie._placed(prefix_trie._numbered(prefix_trie._turns(data), 0), 0)
    first = prefix_trie._nodes(prefix_trie._members(placed, prefix_trie._conversations(placed), 0))
    assert first.where("mixed").count() > 0
    assert found(prefix_trie.trie(data)) == multiset(brute(rows))


def test_turn_references(spark):
    rows = conversations()
    convs = defaultdict(int)
    for row in rows:
        convs[row[0]] += 1
    for r in prefix_trie.trie(frame(spark, rows)).where("depth > 0").select("turn_of", "turn_at").collect():
        assert 1 <= r["turn_at"] <= convs[r["turn_of"]]


def test_empty_table_and_no_ids(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.trie(frame(spark, [(None, 1, "a", "b", 1, "", 1)])).count() == 0


def test_turnless_conversations_end_in_the_root(spark):
    alone = next(k for k in range(101, 200) if zlib.crc32(str(k).encode()) % 6 == 5)
    rows = [(alone, 0, "user", "gone", 1, "", 1), (900, 0, "user", "kept", 1, "", 1)]
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie.trie(frame(spark, rows)).collect()}
    root = got[(alone, 0)]
    assert root["n_convs"] == 2 and root["ends_sha256"] == hashlib.sha256(str(alone).encode()).hexdigest()
    assert multiset(brute(rows)) == found(prefix_trie.trie(frame(spark, rows)))
