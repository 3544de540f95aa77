"""Similarity join of documents on word shingles, filtered by several global token orders.

Two sets with 100 |A and B| >= p |A or B| share a token within the first
n - ceil(p n / 100) + 1 tokens of both, under any order of all tokens.  Three orders
are used, and a pair must pass all of them before its sets are compared:

* rare first: the tokens of one residue class of the hash come first, by document
  count, then the others by hash.  Prefixes nearly always lie within that class, so
  only a quarter of all tokens is counted; common lines and passages come last;
* ascending hash and descending hash: the two ends of a sorted set, at no cost.

Sets that are equal are one node from the start, so groups of copies cost one row.
Sets with a partner in the counted class are loaded, and tokens that no other of them
has bound what a set can share; sets that cannot link are left out.  The others are
put in the rare-first order of all their tokens, and the rank of a shared token bounds
what two sets share from it on.  First every member of a token's group is paired with
the one that has the fewest tokens of its own, the centre of a family of near copies;
verified links give components.  Then only members that share a token but not yet a
component are paired, within the same bounds: no link between components is lost, and
no group is expanded into all its pairs.

Counts of tokens, joins and labels are distributed and stored in the shared folder;
a token or node is a 64-bit hash.

Defined results: texts without words have no shingles, and are linked with nothing;
fewer words than a shingle are one shingle; repeated rows are one node; a null id is
its own component unless linked, and is never a component's name if a number is at
hand; an empty table gives no row; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.llm.components import components
from vecindad.llm.tables import own_names, read, row_key, stored
from vecindad.llm.words import byte_codes, mixed, slices, spaced, windows, words

SHINGLE = 4
PERCENT = 85
#: The rare-first order counts tokens of one residue in so many.
CLASSES = 4


def prefix(n, percent: int):
    """Tokens of a set of n that must hold a shared one (numbers, arrays or columns)."""
    return n - (n * percent + 99) // 100 + 1


def sets(column: pa.Array, shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text that has words."""
    for at, to, raw, offsets in slices(column):
        w = words(raw, offsets, spaced(), byte_codes(True))
        code = windows(w.code, shingle)
        for k in range(to - at):
            a, b = int(w.first[k]), int(w.first[k + 1])
            if b - a >= shingle:
                part = np.sort(code[a : b - shingle + 1])
                yield at + k, part[np.concatenate([[True], part[1:] != part[:-1]])]
            elif b > a:
                yield at + k, windows(w.code[a:b], b - a)


def node_of(tokens: np.ndarray) -> int:
    """The set's own hash: equal for equal sets alone."""
    total = mixed(tokens).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mixed(np.array([total]))[0].view(np.int64))


def _texts(docs: DataFrame) -> DataFrame:
    key = row_key(F.col("doc_id"), F.col("text"))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        key.alias("_key"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("_text"),
    )


def _nodes(texts: DataFrame, shingle: int) -> DataFrame:
    """Each document's node, set size, and tokens in the counted class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, 3), np.int64)
            for row, tokens in sets(batch.column(2), shingle):
                out[row] = node_of(tokens), len(tokens), np.count_nonzero(tokens % np.uint64(CLASSES) == 0)
            empty = out[:, 1] == 0
            columns = [batch.column(0), batch.column(1), batch.column(3), pa.array(out[:, 0], mask=empty)]
            columns += [pa.array(out[:, 1]), pa.array(out[:, 2])]
            names = ["doc_id", "_key", "_text", "node", "n", "held"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts.mapInArrow(run, "doc_id long, _key long, _text long, node long, n long, held long")


def _tokens(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(token, node): the counted class of each set, and what its prefix takes beyond it.

    Copies within a batch are left out: their node has its tokens already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[int] = set()
            parts, owners = [], []
            for _, tokens in sets(batch.column(0), shingle):
                node = node_of(tokens)
                if node in seen:
                    continue
                seen.add(node)
                counted = tokens % np.uint64(CLASSES) == 0
                chosen = tokens[counted]
                more = prefix(len(tokens), percent) - len(chosen)
                if more > 0:
                    chosen = np.concatenate([chosen, tokens[~counted][:more]])
                parts.append(chosen)
                owners.append((node, len(chosen)))
            if parts:
                nodes = np.array(owners, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(parts).view(np.int64)),
                        pa.array(np.repeat(nodes[:, 0], nodes[:, 1])),
                    ],
                    names=["token", "node"],
                )

    return texts.select("text").mapInArrow(run, "token long, node long")


def _prefixes(texts: DataFrame, sizes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(token, node, n): the shared tokens of each prefix in the rare-first order."""
    counts = _tokens(texts, shingle, percent).groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    counted = F.pmod(F.expr("token"), F.lit(CLASSES)) == 0
    # Unsigned and signed hashes have the same residue, as 2^64 is a multiple of the number of classes.
    by_node = (
        _tokens(texts, shingle, percent)
        .join(counts, "token")
        .groupBy("node")
        .agg(
            F.collect_set(F.struct(F.when(counted, "df").otherwise(None).alias("df"), "token")).alias("_shared"),
        )
        .join(sizes, "node")
    )
    inside = F.filter("_shared", lambda x: x["df"].isNotNull())
    beyond = F.filter("_shared", lambda x: x["df"].isNull())
    need = prefix_column(F.col("n"), percent)
    own = F.col("held") - F.size(inside)
    take = F.greatest(F.lit(0), F.least(need, F.col("held")) - own).cast("int")
    return (
        by_node.select(
            "node",
            "n",
            F.concat(F.slice(F.array_sort(inside), F.lit(1), take), beyond).alias("_first"),
        )
        .select("node", "n", F.explode("_first.token").alias("token"))
    )


def prefix_column(n, percent: int):
    return n - F.floor((n * percent + 99) / 100) + 1


def _loaded(nodes: DataFrame, texts: DataFrame, homes: DataFrame, shingle: int) -> DataFrame:
    """The sorted sets of these nodes, read again from one document of each.  homes: one row key for each node."""
    keys = homes.join(nodes, "node").select("_key").distinct()

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {node_of(tokens): tokens.tobytes() for _, tokens in sets(batch.column(0), shingle)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], names=["node", "tokens"]
            )

    # Rows that share a key may have other sets too: only these nodes are kept, each once.
    rows = texts.join(keys, "_key", "left_semi").select("text").mapInArrow(load, "node long, tokens binary")
    return rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))


def _verified(pairs: DataFrame, loaded: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = batch.column(2), batch.column(3)
            good = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                one = np.frombuffer(first[k].as_buffer(), np.uint64)
                two = np.frombuffer(second[k].as_buffer(), np.uint64)
                good[k] = links(one, two, percent)
            yield batch.select([0, 1]).filter(pa.array(good))

    left = loaded.select(F.col("node").alias("a"), F.col("tokens").alias("_one"))
    right = loaded.select(F.col("node").alias("b"), F.col("tokens").alias("_two"))
    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .select("a", "b", "_one", "_two")
        .mapInArrow(compare, "a long, b long")
    )


def _exploded(loaded: DataFrame) -> DataFrame:
    """(token, node) of all tokens of loaded sets."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(1)]
            if parts:
                nodes = np.repeat(batch.column(0).to_numpy(), [len(x) for x in parts])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts)), pa.array(nodes)], names=["token", "node"])

    return loaded.select("node", "tokens").mapInArrow(tokens, "token long, node long")


def _alone(loaded: DataFrame) -> DataFrame:
    """(node, alone): tokens that no other loaded set has."""
    return (
        _exploded(loaded)
        .groupBy("token")
        .agg(F.count("*").alias("_df"), F.min("node").alias("node"))
        .where("_df = 1")
        .groupBy("node")
        .agg(F.count("*").alias("alone"))
    )


def _ranked(loaded: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, may, rank): the prefix of each loaded set in the rare-first order of all its
    tokens, counted among the loaded sets; may: tokens that others have."""
    counts = _exploded(loaded).groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = (
        _exploded(loaded)
        .join(counts, "token")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("_shared"))
        .join(sizes, "node")
    )
    may = F.size("_shared")
    length = F.greatest(F.lit(0), prefix_column(F.col("n"), percent) - (F.col("n") - may)).cast("int")
    return (
        shared.select("node", "n", may.alias("may"), F.slice("_shared.token", F.lit(1), length).alias("_first"))
        .select("node", "n", "may", F.posexplode("_first").alias("_i", "token"))
        .select("token", "node", "n", "may", (F.col("n") - F.col("may") + F.col("_i")).alias("rank"))
    )


def links(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link: the prefixes of both hash orders first, then all of them."""
    p, q = prefix(len(one), percent), prefix(len(two), percent)
    if not _common(one[:p], two[:q]) or not _common(one[-p:], two[-q:]):
        return False
    both = _common(one, two)
    return 100 * both >= percent * (len(one) + len(two) - both)


def _common(one: np.ndarray, two: np.ndarray) -> int:
    x = np.concatenate([one, two])
    x.sort(kind="stable")
    return int(np.count_nonzero(x[1:] == x[:-1]))


def _fit(one: tuple, two: tuple, percent: int):
    """Whether two sets (n, may, rank of a shared token) may link by that token.

    They have to share ``need`` tokens: as many must be shared with others at all, and as
    many must be left from the shared token on, if it is the first one in the order.
    """
    (n, may, rank), (m, may_, rank_) = (map(F.col, names) for names in (one, two))
    need = F.ceil((n + m) * percent / (100 + percent) - 1e-9)
    return (F.least(may, may_) >= need) & (n - rank >= need) & (m - rank_ >= need)


def _components(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, _text, node, n), and each node's component with its least id."""
    texts = _texts(docs)
    rows = stored(_nodes(texts, shingle))
    homes = rows.where("node is not null").groupBy("node").agg(
        F.min("_key").alias("_key"), F.min("doc_id").alias("least"), F.min("n").alias("n"), F.min("held").alias("held")
    )
    prefixes = stored(_prefixes(texts, homes.select("node", "n", "held"), shingle, percent))

    loaded = stored(_loaded(prefixes.select("node").distinct(), texts, homes, shingle))
    sizes = homes.select("node", "n")
    able = (
        loaded.join(_alone(loaded), "node", "left")
        .join(sizes, "node")
        .where(100 * (F.col("n") - F.coalesce("alone", F.lit(0))) >= percent * F.col("n"))
    )
    ranked = stored(_ranked(stored(able.select("node", "tokens")), sizes, percent))
    mine, theirs = ("n", "may", "rank"), ("_n", "_may", "_rank")
    centre = (
        ranked.groupBy("token")
        .agg(F.min(F.struct((1 - F.col("may") / F.col("n")).alias("own"), "node", "n", "may", "rank")).alias("_c"), F.count("*").alias("_m"))
        .where("_m > 1")
        .select("token", F.col("_c.node").alias("b"), *[F.col(f"_c.{x}").alias(f"_{x}") for x in mine])
    )
    fit = _fit(mine, theirs, percent)
    stars = ranked.withColumnRenamed("node", "a").join(centre, "token").where((F.col("a") != F.col("b")) & fit)
    first = stored(_verified(stars.select("a", "b").distinct(), loaded, percent))

    labelled = ranked.join(components(first), "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = (
        labelled.groupBy("token")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
        .where("_low <> _high")
    )
    still = stored(labelled.join(several.select("token"), "token", "left_semi"))
    other = still.select(
        "token", F.col("node").alias("b"), F.col("component").alias("_other"), *[F.col(x).alias(f"_{x}") for x in mine]
    )
    rest = (
        still.withColumnRenamed("node", "a")
        .join(other, "token")
        .where((F.col("component") < F.col("_other")) & fit)
        .select("a", "b")
        .distinct()
    )
    second = _verified(rest, loaded, percent)
    groups = components(first.union(second))

    named = homes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = stored(named.join(names, "component").select("node", "component", "component_id"))
    return rows, named


def linked(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per document: set size and the least id among all that links lead to."""
    rows, named = _components(docs, shingle, percent)
    return rows.join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


@own_names
def representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the least id, then the least hash of its text.

    Rows without words are linked with nothing and stay.
    """
    rows, named = _components(docs, shingle, percent)
    member = rows.join(named, "node").groupBy("doc_id", "_text", "component_id", "component").agg(F.count("*").alias("_rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text"))
    chosen = member.groupBy("component").agg(first.alias("_first"))
    stays = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text").eqNullSafe(F.col("_first"))
    member = stored(member.join(chosen, "component").select("doc_id", "_text", "_rows", stays.alias("_stays")))

    def listed(some: DataFrame, how: str, of: DataFrame) -> DataFrame:
        one = some.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"))
        same = of["doc_id"].cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(of["text"]) == F.col("_hash"))
        return of.join(one, same, how)

    kept = listed(member.where("not _stays"), "left_anti", docs)
    twice = member.where("_stays and _rows > 1")
    if twice.isEmpty():
        return kept
    return listed(twice, "left_anti", kept).unionByName(
        listed(twice, "left_semi", kept).dropDuplicates(["doc_id", "text"])
    )


def op9_jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return linked(read(spark, folder, "documents"))
