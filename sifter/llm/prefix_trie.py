"""Conversation prefix trie from vertical bitmaps.

Turns are known by the md5 of role and text and placed by a range sort, so a conversation of any
length is numbered by many tasks. Conversations are rebuilt by joins on ids. Shards of a few thousand
conversations in order of id, and bands of 64 turns, then hold an index of (position, turn) to
bitsets of conversations. Depth first, a node's bitset is intersected with the postings of the turns
that its members have next: the results are its children, their popcounts and the lists of
conversations that end there. A node is named by its depth and by the exclusive or of the hashes of
(position, turn) on its path, so a band starts where the one before it ended without walking it
again, and shards agree on names. Equal nodes of several shards are added up by Spark.

Sums over subtrees need no step per level: each node counts for its smallest member alone, a
conversation's total is what counts for it, and a node's sum is the total of its members, less what
its smallest member has above the node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Conversations of a shard's bitset, turns of a band.
SHARD, BAND = 4096, 64
#: Rebuilt conversations take fewer than so many turns from another one.
PREFIX, FAMILY = 9, 5
KEY = ["depth", "k1", "k2"]

NODES = "depth long, k1 long, k2 long, p1 long, p2 long, n long, conv_id long, bytes long, members array<long>, ends array<long>"


def _hashes(depth: Column | str, turn: str) -> list[Column]:
    return [F.xxhash64(depth, turn).alias("h1"), F.xxhash64(turn, depth).alias("h2")]


def placed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, at (from 1), turn (md5 of role and text), bytes, and the row's partition of the sort.

    Rows are sorted by ranges and numbered in each range, then ranges are offset, so no conversation
    needs one task. Ties of a turn come by role, then by the turn's digest."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialise(
        rows.select("conv_id", F.col("digest").alias("turn"), "bytes", F.monotonically_increasing_id().alias("row"))
        .withColumn("part", F.shiftright("row", 33)),
        "trie-turns",
    )


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), turn, bytes, length of the rebuilt conversations; one without turns
    has a row of depth 0."""
    rows = placed_turns(conversations)
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("own"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("own").over(earlier), F.lit(0)))
    h = F.crc32(F.col("conv_id").cast("string")) % PREFIX
    convs = counts.groupBy("conv_id").agg(F.sum("own").alias("n"))
    convs = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = convs.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
    convs = materialise(convs.select("conv_id", "base", "h", "taken", "length"), "trie-convs")
    parts = materialise(counts.join(convs, "conv_id"), "trie-parts")
    # a conversation's rows in one partition of the sort, so a long one is many keys
    place = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("row"))
    rows = rows.join(parts, ["conv_id", "part"]).withColumn("at", F.col("before") + place)
    rows = materialise(rows.select("conv_id", "at", "turn", "bytes", "h", "taken", "length"), "trie-placed")
    whole = F.col("conv_id") % FAMILY == 0  # it takes its first turns from itself
    own = rows.where(whole | (F.col("at") > F.col("h"))).select(
        "conv_id", F.when(whole, F.col("at")).otherwise(F.col("taken") + F.col("at") - F.col("h")).alias("depth"), "turn", "bytes", "length"
    )
    first = rows.where(whole & (F.col("at") < PREFIX)).select(F.col("conv_id").alias("base"), F.col("at").alias("depth"), "turn", "bytes")
    heirs = convs.where("conv_id <> base").select("conv_id", "base", "taken", "length")
    taken = heirs.join(first, "base").where("depth <= taken").select(own.columns)
    bare = convs.where("length = 0").select(
        "conv_id", F.lit(0).alias("depth"), F.unhex(F.lit("")).alias("turn"), F.lit(0).alias("bytes"), "length"
    )
    return own.unionByName(taken).unionByName(bare)


class _Shard:
    """Postings of the conversations of a shard in one band of turns."""

    def __init__(self, first: int):
        self.first = first  # the depth the band begins at
        self.convs: list[tuple] = []  # conv_id, length, names at the band's start
        self.turns: list[list[tuple]] = []  # of each: turn, bytes, h1, h2
        self.postings: dict[tuple, int] = {}
        self.there: list[int] = []  # by position: who has a turn
        self.ends: dict[int, int] = {}  # by depth: who ends

    def add(self, conv: tuple, turns: list[tuple]) -> None:
        bit = 1 << len(self.convs)
        for k, (turn, *_) in enumerate(turns):
            self.postings[k, turn] = self.postings.get((k, turn), 0) | bit
            if k == len(self.there):
                self.there.append(0)
            self.there[k] |= bit
        self.ends[conv[1]] = self.ends.get(conv[1], 0) | bit
        self.convs.append(conv)
        self.turns.append(turns)

    def ids(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.convs[low.bit_length() - 1][0])
            bits ^= low
        return out

    def node(self, members: int, depth: int, name: tuple, parent: tuple, size: int) -> tuple:
        ids = self.ids(members)
        return depth, *name, *parent, members.bit_count(), ids[0], size, ids, self.ids(members & self.ends.get(depth, 0))

    def nodes(self) -> Iterator[tuple]:
        starts: dict[tuple, int] = {}
        for i, (_, _, *name) in enumerate(self.convs):
            starts[tuple(name)] = starts.get(tuple(name), 0) | 1 << i
        for name, members in starts.items():
            if self.first == 0:
                yield self.node(members, 0, name, (None, None), 0)
            stack = [(members, 0, name)]
            while stack:
                members, k, name = stack.pop()
                rest = members & self.there[k] if k < len(self.there) else 0
                while rest:
                    turn, size, h1, h2 = self.turns[(rest & -rest).bit_length() - 1][k]
                    child = rest & self.postings[k, turn]
                    rest ^= child
                    own = (name[0] ^ h1, name[1] ^ h2)
                    yield self.node(child, self.first + k + 1, own, name, size)
                    stack.append((child, k + 1, own))


def _walk(batches: Iterator[pa.RecordBatch], most: int, width: int) -> Iterator[pa.RecordBatch]:
    """Nodes of the shards of one partition: rows sorted by band, conv_id and depth; ``most``
    conversations of a shard, ``width`` turns of a band."""
    kinds = [pa.int64()] * 8 + [pa.list_(pa.int64())] * 2
    names = ["depth", "k1", "k2", "p1", "p2", "n", "conv_id", "bytes", "members", "ends"]

    def out(shard: _Shard) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for x in shard.nodes():
            held.append(x)
            if len(held) == 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names=names)

    shard, conv, turns = None, None, []
    for batch in batches:
        for band, own, depth, turn, size, h1, h2, length, k1, k2 in zip(*(c.to_pylist() for c in batch.columns)):
            if conv is None or conv[0] != own or shard.first != band * width:
                if conv is not None:
                    shard.add(conv, turns)
                if shard is None or shard.first != band * width or len(shard.convs) == most:
                    if shard is not None:
                        yield from out(shard)
                    shard = _Shard(band * width)
                conv, turns = (own, length, k1, k2), []
            if depth:
                turns.append((turn, size, h1, h2))
    if conv is not None:
        shard.add(conv, turns)
        yield from out(shard)


def shard_nodes(rebuilt: DataFrame, most: int = SHARD, width: int = BAND) -> DataFrame:
    """The nodes of every shard (NODES), from rebuilt turns: members and ends are lists in ascending order."""
    rows = rebuilt.withColumns({"band": F.expr(f"(greatest(depth, 1) - 1) div {width}"), "h1": _hashes("depth", "turn")[0], "h2": _hashes("depth", "turn")[1]})
    rows = materialise(rows, "trie-rebuilt")
    # names at the start of later bands: what the bands before them add up to
    long = rows.where(F.col("length") > width).groupBy("conv_id", "band").agg(F.bit_xor("h1").alias("k1"), F.bit_xor("h2").alias("k2"))
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(long.select("conv_id", "band", *(F.bit_xor(k).over(earlier).alias(k) for k in ("k1", "k2"))).where("band > 0"), "trie-bands")
    zero = F.lit(0).cast("long")
    columns = ["band", "conv_id", "depth", "turn", "bytes", "h1", "h2", "length", "k1", "k2"]
    low = rows.where("band = 0").withColumns({"k1": zero, "k2": zero}).select(columns)
    high = rows.where("band > 0").join(starts, ["conv_id", "band"]).select(columns)
    dealt = low.unionByName(high).repartitionByRange("band", "conv_id").sortWithinPartitions("band", "conv_id", "depth")
    return dealt.mapInArrow(partial(_walk, most=most, width=width), NODES)


def _end_hashes(found: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, from the shards' lists: those of a node come in
    order of their first id, in a stream, so no list is held whole."""
    ends = found.where(F.size("ends") > 0).select(*KEY, "ends", F.element_at("ends", 1).alias("first"))
    ends = ends.repartition(*KEY).sortWithinPartitions(*KEY, "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = digest = None
        for batch in batches:
            done: list[tuple] = []
            for depth, k1, k2, ids, _ in zip(*(c.to_pylist() for c in batch.columns)):
                between = b","
                if (depth, k1, k2) != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest, between = (depth, k1, k2), hashlib.sha256(), b""
                digest.update(between + ",".join(map(str, ids)).encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=[*KEY, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, digest.hexdigest())], names=[*KEY, "ends_sha256"])

    return ends.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def _above(nodes: DataFrame) -> DataFrame:
    """``saved`` of each shared node and of those above it that count for the same conversation, less
    its own: what a total of its smallest member holds too much. Summed by bands, then inside them."""
    rows = nodes.where("n > 1").withColumn("band", F.expr(f"depth div {BAND}"))
    whole = rows.groupBy("conv_id", "band").agg(F.sum("saved").alias("sum"))
    earlier = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("conv_id", "band", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "band").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("saved").over(inside), F.lit(0)))
    return rows.join(whole, ["conv_id", "band"]).select(*KEY, (F.col("inside") + F.col("before")).alias("above"))


def prefix_trie(conversations: DataFrame, most: int = SHARD, width: int = BAND) -> DataFrame:
    """One row per node of the rebuilt conversations' trie: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without an id are in no conversation and left out. Null turns come first; turns that tie
    come by role, then by the md5 of role and text. A null role or text is empty; rows that repeat
    are turns of their own; texts of any length count whole. A table without ids gives no rows, not
    even a root. Other columns are ignored.
    """
    found = materialise(shard_nodes(rebuilt_turns(conversations), most, width), "trie-shards")
    nodes = found.groupBy(*KEY).agg(
        F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2")
    )
    nodes = materialise(nodes.withColumn("saved", (F.col("n") - 1) * F.col("bytes")), "trie-nodes")
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
    nodes = nodes.join(below.agg(F.count("*").alias("children")), KEY, "left").fillna(0, "children")
    nodes = materialise(nodes, "trie-children")
    totals = nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved"), F.sum((F.col("children") == 0).cast("long")).alias("leaves"))
    totals = materialise(totals.where("saved > 0 OR leaves > 0"), "trie-totals")

    shared = nodes.where("n > 1").select(*KEY)
    members = found.join(shared, KEY, "left_semi").select(*KEY, F.explode("members").alias("conv_id"))
    sums = members.join(totals, "conv_id").groupBy(*KEY).agg(F.sum("saved").alias("sum"), F.sum("leaves").alias("leaves"))
    sums = sums.join(_above(nodes), KEY).withColumn("sum", F.col("sum") - F.col("above")).drop("above")

    least = nodes.agg(F.min("conv_id")).first()[0]  # the root's
    parents = nodes.where("depth > 0 AND children > 0").select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    columns = [*nodes.columns, "parent"]
    placed = (
        nodes.where("depth = 0").withColumn("parent", F.lit(None).cast("long"))
        .unionByName(nodes.where("depth = 1").withColumn("parent", F.lit(least).cast("long")))
        .unionByName(nodes.where("depth > 1").join(materialise(parents, "trie-parents"), ["depth", "p1", "p2"]).select(columns))
    )
    full = placed.join(sums, KEY, "left").join(_end_hashes(found), KEY, "left")
    return full.select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("sum", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
