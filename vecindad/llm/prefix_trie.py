"""Prefix trie of conversations whose heads are taken from another conversation.

Conversation c is rebuilt from the first turns of a base conversation and its own turns
after as many.  No rebuilt text is made: the fingerprint of a sequence of turns is an
element of a monoid (length n and value v = sum of t_i B^i modulo a prime of 127 bits, with
(n, v)(m, w) = (n + m, v + B^n w)), so the fingerprint of a rebuilt prefix follows from
those of the base's head, of c's own prefix, and of the part of it that is left out.

Turns are numbered, and their prefixes multiplied, in range partitions of (conversation,
turn); a conversation that lies in several of them gets the product of the parts before.
So a conversation may hold any share of all rows.  Texts are digested where they are
read and never shuffled.

A node is a (depth, fingerprint).  Its members refer to stored turns; their last turns
must have one SHA-256 (of role and text) and their parents one fingerprint, so equal
sequences follow from the root down.  If a fingerprint joins different ones, all is
done again with another B.

The members of a node are contained in those of its parent, so a conversation is the
least member (the owner) of its nodes from some depth to its end.  Sums over a subtree
are then sums over members: each brings the total of the nodes it owns, and the owner
leaves out those above.

Defined results: turns are ordered by turn (null first), then by digest, and repeated rows
are repeated turns; null role and text are empty; rows without a conv_id are no
conversation's; a conversation without turns after rebuilding ends in the root; an
empty table gives no row; other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vecindad.llm.tables import read, stored

#: Base conversations have ids divisible by GROUP; a head has fewer turns than HEADS.
GROUP = 100
HEADS = 6
#: Prime modulus and bytes of a fingerprint.
PRIME = 2**127 - 1
_SIZE = 16
#: Nodes of one conversation are summed in blocks of so many.
BLOCK = 1024
#: Ids of the members that end in a node are hashed in pieces of so many bytes.
PIECE = 1 << 18
EMPTY = bytes(_SIZE)


def base_of(seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"base {seed}".encode()).digest(), "big") % PRIME


def number(data: bytes) -> int:
    return int.from_bytes(data, "big") % PRIME


def written(value: int) -> bytes:
    return value.to_bytes(_SIZE, "big")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        F.unhex(digest).alias("digest"),
        F.length(text).cast("long").alias("chars"),
        # Equal turns can be dealt to several partitions, too.
        F.monotonically_increasing_id().alias("row"),
    )


_NUMBERED = "conv long, part int, place long, digest binary, chars long, before binary, value binary"


def _numbered(turns: DataFrame, seed: int) -> DataFrame:
    """Turns with their place in the part of their conversation that lies in one range partition, and
    the products of that part up to the turn before and the turn."""
    order = ["conv", F.col("turn").asc_nulls_first(), "digest", "row"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, part = base_of(seed), TaskContext.get().partitionId()
        conv, place, power, value = None, 0, 1, 0
        for batch in batches:
            places, befores, values = [], [], []
            for c, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if c != conv:
                    conv, place, power, value = c, 0, 1, 0
                place += 1
                power = power * base % PRIME
                befores.append(written(value))
                value = (value + number(digest) * power) % PRIME
                places.append(place)
                values.append(written(value))
            columns = [batch.column(0), pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())]
            columns += [batch.column(1), batch.column(2), pa.array(befores, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _NUMBERED.split(", ")])

    return ranged.mapInArrow(run, _NUMBERED)


def _offsets(numbered: DataFrame, seed: int) -> DataFrame:
    """(conv, part, shift, lead): turns before a part of a conversation, and their product.

    Only conversations in several partitions have rows: no more than partitions, twice.
    """
    parts = numbered.groupBy("conv", "part").agg(
        F.max("place").alias("turns"), F.max(F.struct("place", "value"))["value"].alias("value")
    )
    several = parts.groupBy("conv").agg(F.count("*").alias("_n"), F.sort_array(F.collect_list(F.struct("part", "turns", "value"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = base_of(seed)
        for batch in batches:
            out: list[tuple] = []
            for conv, listed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shift, lead = 0, 0
                for p in listed:
                    out.append((conv, p["part"], shift, written(lead)))
                    lead = (lead + pow(base, shift, PRIME) * number(p["value"])) % PRIME
                    shift += p["turns"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            columns = zip(*out, strict=True) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["conv", "part", "shift", "lead"]
            )

    return several.where("_n > 1").select("conv", "parts").mapInArrow(run, "conv long, part int, shift long, lead binary")


_JOINED = "conv long, place long, digest binary, chars long, before binary, value binary"


def _placed(numbered: DataFrame, seed: int) -> DataFrame:
    """Turns with their place in the whole conversation and the products of its prefixes."""
    rows = numbered.join(_offsets(numbered, seed), ["conv", "part"], "left").select(
        "conv", "place", "digest", "chars", "before", "value", "shift", "lead"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = base_of(seed)
        for batch in batches:
            *kept, shifts, leads = batch.columns
            moved = np.flatnonzero(shifts.fill_null(0).to_numpy(zero_copy_only=False))
            if len(moved):
                place = kept[1].to_numpy().copy()
                both = [kept[4].to_pylist(), kept[5].to_pylist()]
                powers: dict[int, int] = {}
                for k in moved.tolist():
                    shift, lead = shifts[k].as_py(), number(leads[k].as_py())
                    power = powers.get(shift) or powers.setdefault(shift, pow(base, shift, PRIME))
                    place[k] += shift
                    for values in both:
                        values[k] = written((lead + power * number(values[k])) % PRIME)
                kept = [kept[0], pa.array(place), *kept[2:4], *[pa.array(v, pa.binary()) for v in both]]
            yield pa.RecordBatch.from_arrays(kept, names=[c.split()[0] for c in _JOINED.split(", ")])

    return rows.mapInArrow(run, _JOINED)


def _conversations(placed: DataFrame) -> DataFrame:
    """(conv, turns, head, cut, lead, left): a row per conversation.

    head: the base's first turns that it takes; cut: own turns that are left out; lead and
    left: products of the two.
    """
    entry = F.struct("place", "value", "digest", "chars", "before")
    own = placed.groupBy("conv").agg(
        F.count("*").alias("turns"),
        # At most HEADS - 1 turns of each.
        F.sort_array(F.collect_list(F.when(F.col("place") < HEADS, entry))).alias("first"),
    )
    base = own.select(F.col("conv").alias("base"), F.col("first").alias("_first"))
    wanted = own.withColumn("base", F.col("conv") - F.col("conv") % GROUP).withColumn("cut", head_length(F.col("conv")))
    joined = wanted.join(base, "base", "left")
    head = F.coalesce(F.slice("_first", F.lit(1), F.col("cut").cast("int")), F.array().cast("array<" + _entry_type() + ">"))
    left = F.least(F.col("cut"), F.col("turns")).cast("int")
    nothing = F.lit(bytearray(EMPTY))
    return joined.select("conv", "turns", "base", head.alias("head"), left.cast("long").alias("cut"), "first").withColumns(
        {
            "lead": F.when(F.size("head") > 0, F.element_at("head", -1)["value"]).otherwise(nothing),
            "left": F.when(F.col("cut") > 0, F.try_element_at("first", F.col("cut").cast("int"))["value"]).otherwise(nothing),
            "length": F.size("head") + F.col("turns") - F.col("cut"),
        }
    ).drop("first")


def _entry_type() -> str:
    return "struct<place:bigint,value:binary,digest:binary,chars:bigint,before:binary>"


_MEMBERS = "conv long, depth long, value binary, parent binary, digest binary, chars long, of long, at long"


def _members(placed: DataFrame, convs: DataFrame, seed: int) -> DataFrame:
    """A row for each conversation and depth: fingerprint, parent's fingerprint, and the last turn by reference (of, at)."""
    heads = convs.select("conv", "base", F.inline("head")).select(
        "conv",
        F.col("place").alias("depth"),
        "value",
        F.col("before").alias("parent"),
        "digest",
        "chars",
        F.col("base").alias("of"),
        F.col("place").alias("at"),
    )
    tails = placed.join(convs.select("conv", "cut", F.size("head").alias("taken"), "lead", "left"), "conv").where("place > cut")
    tails = tails.select("conv", "place", "digest", "chars", "before", "value", "cut", "taken", "lead", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = base_of(seed)
        moves = [pow(base, k - HEADS, PRIME) for k in range(2 * HEADS)]
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in (4, 5, 6, 7, 8, 9)]
            values, parents = [], []
            for before, value, cut, taken, lead, left in zip(*columns, strict=True):
                if cut == taken and lead == left:  # the head is the conversation's own
                    values.append(value)
                    parents.append(before)
                    continue
                # lead, then what follows the part left out: (value - left) / B^cut, moved behind lead.
                move, lead, left = moves[taken - cut + HEADS], number(lead), number(left)
                values.append(written((lead + (number(value) - left) * move) % PRIME))
                parents.append(written((lead + (number(before) - left) * move) % PRIME))
            place, cut, taken = (batch.column(k).to_numpy() for k in (1, 6, 7))
            rows = [batch.column(0), pa.array(place - cut + taken), pa.array(values, pa.binary()), pa.array(parents, pa.binary())]
            rows += [batch.column(2), batch.column(3), batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays(rows, names=[c.split()[0] for c in _MEMBERS.split(", ")])

    return heads.unionByName(tails.mapInArrow(run, _MEMBERS))


def _nodes(members: DataFrame) -> DataFrame:
    """One row per node; ``mixed`` where different sequences have one fingerprint."""
    return members.groupBy("depth", "value").agg(
        F.min("conv").alias("owner"),
        F.count("*").alias("n_convs"),
        F.min("parent").alias("parent"),
        F.max("chars").alias("chars"),
        F.min("of").alias("of"),
        F.min(F.struct("of", "at"))["at"].alias("at"),
        ((F.min("digest") != F.max("digest")) | (F.min("parent") != F.max("parent"))).alias("mixed"),
    )


def _ends(convs: DataFrame, members: DataFrame) -> DataFrame:
    """(conv, depth, value): the node in which each conversation ends."""
    root = convs.where("length = 0").select("conv", F.col("length").alias("depth"), F.lit(bytearray(EMPTY)).alias("value"))
    last = members.join(convs.select("conv", F.col("length").alias("depth")), ["conv", "depth"]).select("conv", "depth", "value")
    return root.unionByName(last)


def _hashed(ends: DataFrame) -> DataFrame:
    """(depth, value, ends_sha256) of the nodes in which conversations end.

    Ids are sorted over all partitions and joined to pieces of text there; the pieces of
    a node are then hashed one after the other, as SHA-256 demands, and never held together.
    """
    ordered = ends.repartitionByRange("depth", "value", "conv").sortWithinPartitions("depth", "value", "conv").select("depth", "value", "conv")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0
        out: list[tuple] = []

        def close() -> None:
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for depth, value, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (depth, value) != node or size >= PIECE:
                    close()
                    node, ids, size = (depth, value), [], 0
                ids.append(conv)
                size += len(str(conv)) + 1
            yield batch_of(out)
            out.clear()
        close()
        yield batch_of(out)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string()]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["depth", "value", "first", "ids"]
        )

    texts = ordered.mapInArrow(pieces, "depth long, value binary, first long, ids string")
    dealt = texts.repartition("depth", "value").sortWithinPartitions("depth", "value", "first")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        out: list[tuple] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 3
            made = [pa.array(list(c), k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.string()), strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(made, names=["depth", "value", "ends_sha256"])

        for batch in batches:
            for depth, value, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (depth, value) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, value), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield rows()
        if node is not None:
            out.append((*node, state.hexdigest()))
        yield rows()

    return dealt.mapInArrow(hashes, "depth long, value binary, ends_sha256 string")


def _sums_before(nodes: DataFrame) -> DataFrame:
    """Nodes with ``above``: what their owner's nodes above them save.  Depths are dense, so blocks are bounded."""
    block = nodes.withColumn("block", F.floor(F.col("depth") / BLOCK))
    totals = block.groupBy("owner", "block").agg(F.sum("saves").alias("_sum"))
    earlier = Window.partitionBy("owner").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("owner", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("owner", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    return (
        block.withColumn("_inside", F.coalesce(F.sum("saves").over(inside), F.lit(0)))
        .join(totals, ["owner", "block"])
        .withColumn("above", F.col("_inside") + F.col("_before"))
        .drop("block", "_inside", "_before")
    )


def _fingerprints(conversations: DataFrame, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conversations, members, nodes), stored; tried with another base until no node is mixed."""
    while True:
        numbered = stored(_numbered(_turns(conversations), seed))
        placed = stored(_placed(numbered, seed))
        convs = stored(_conversations(placed))
        members = stored(_members(placed, convs, seed))
        nodes = stored(_nodes(members))
        if nodes.where("mixed").isEmpty():
            return convs, members, nodes
        seed += 1


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame, seed: int = 0) -> DataFrame:
    """One row per node, with the stored turn (turn_of, turn_at) that it ends with."""
    convs, members, inner = _fingerprints(conversations, seed)
    root = convs.agg(F.min("conv").alias("owner"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"),
        F.lit(bytearray(EMPTY)).alias("value"),
        "owner",
        "n_convs",
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("chars"),
        F.lit(None).cast("long").alias("of"),
        F.lit(None).cast("long").alias("at"),
    )
    nodes = root.unionByName(inner.drop("mixed"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("value").alias("parent"), F.col("owner").alias("parent_conv_id"))
    below = inner.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("value")).agg(F.count("*").alias("n_children"))
    nodes = stored(
        nodes.join(above, ["depth", "parent"], "left")
        .join(below, ["depth", "value"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        .withColumn("saves", (F.col("n_convs") - 1) * F.col("chars"))
    )
    owned = nodes.groupBy(F.col("owner").alias("conv")).agg(
        F.sum("saves").alias("total"), F.sum(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaves")
    )
    # Conversations that own nothing bring nothing; the root has all of them.
    brought = (
        members.select("conv", "depth", "value")
        .unionByName(convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(bytearray(EMPTY)).alias("value")))
        .join(owned, "conv")
        .groupBy("depth", "value")
        .agg(F.sum("total").alias("total"), F.sum("leaves").alias("n_leaves"))
    )
    ends = _hashed(_ends(convs, members))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        _sums_before(nodes)
        .join(brought, ["depth", "value"])
        .join(ends, ["depth", "value"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("total") - F.col("above")).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
            F.col("of").alias("turn_of"),
            F.col("at").alias("turn_at"),
        )
    )


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie(read(spark, folder, "conversations")).select(*NODE)
