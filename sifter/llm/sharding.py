"""Sharding: balanced label propagation, DataFrame operations only.

Documents with equal texts are linked. A linked document's label is its shard; in each round it
moves to the shard that holds most of its neighbours: in exchange for a document that wants to go the
other way, or as far as that shard's quota lasts. Since the members of one group are interchangeable, the state is a table of counts by (group, shard), far
smaller than the links. After the rounds a group gathers in its fullest shard; groups beyond a
shard's quota move on, whole, to shards with free places. Documents without links fill the free places at the end, so the counts of
any two shards differ by one at most (law ``rows``).

Large groups, of an eighth of a shard or more, are seated before the others, whole as long as some
shard has room for them; there are at most some 16 of them a shard. Only a group larger than a
shard, or than the room any shard has left, is cut, into pieces as large as the shards can hold.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, number_rows


def seat_large(sizes: dict[str, int], room: list[int]) -> list[tuple[str, int, int]]:
    """(group, shard, n): the largest group first, in the fullest shard that holds all of it; if none
    does, as much as fits goes to the emptiest one and the remainder waits for its turn.

    ``room``, the free places of each shard, is brought up to date."""
    seats = []
    heap = [(-m, gid) for gid, m in sizes.items()]
    heapq.heapify(heap)
    while heap:
        m, gid = heapq.heappop(heap)
        m = -m
        fits = [s for s, free in enumerate(room) if free >= m]
        shard = min(fits, key=room.__getitem__) if fits else max(range(len(room)), key=room.__getitem__)
        n = min(m, room[shard])
        seats.append((gid, shard, n))
        room[shard] -= n
        if n < m:
            heapq.heappush(heap, (n - m, gid))
    return seats


def by_shard(values: list[int], shard: str = "shard") -> Column:
    """The value of the row's shard."""
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), F.col(shard) + 1)


def intervals(free: list[int], lowest: list[int]) -> Column:
    """Free places of all shards as intervals of a running number: structs (shard, hi, lo), where a
    number k in the interval is the shard's place k - lo."""
    upto, out = 0, []
    for shard, n in enumerate(free):
        upto += n
        out.append(F.struct(F.lit(shard).alias("shard"), F.lit(upto).alias("hi"), F.lit(upto - n - lowest[shard]).alias("lo")))
    return F.array(*out)


def propagate(state: DataFrame, caps: list[int], rounds: int) -> DataFrame:
    """``state``: (node, shard, n). Rounds of moves to the node's fullest shard under quotas ``caps``.

    Two shards exchange as many movers as want to go either way, less what chance may add to either
    side, so full shards go on trading; beyond that a shard takes movers while it has free places. If
    more want to move than may, those with the smallest hash of (node, shard) do.
    """
    for turn in range(rounds):
        best = state.groupBy("node").agg(
            F.max(F.struct("n", F.xxhash64("node", "shard").alias("h"), "shard")).alias("best")
        )
        wishes = state.join(best, "node").select("node", "shard", "n", F.col("best.shard").alias("to"))
        load = state.groupBy("shard").agg(F.sum("n").alias("load"))
        want = wishes.where("shard != to").groupBy("shard", "to").agg(
            F.sum("n").cast("double").alias("want"), F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("chance")
        )
        # at most a row for each two shards from here on
        want = materialise(want, "shard-wishes")
        back = want.select(F.col("to").alias("shard"), F.col("shard").alias("to"), F.col("want").alias("back"), F.col("chance").alias("other"))
        even = F.least("want", "back") - F.greatest("chance", "other")
        trade = want.join(back, ["shard", "to"], "left").withColumn("trade", F.greatest(F.lit(0.0), F.coalesce(even, F.lit(0.0))))
        left = trade.groupBy("to").agg(F.sum(F.col("want") - F.col("trade")).alias("left"))
        room = left.join(load.withColumnRenamed("shard", "to"), "to", "left").select(
            "to", F.greatest(F.lit(0.0), F.try_divide(by_shard(caps, "to") - F.coalesce("load", F.lit(0)), F.col("left"))).alias("free")
        )
        rest = (F.col("want") - F.col("trade")) * F.least(F.lit(1.0), F.coalesce("free", F.lit(0.0)))
        room = trade.join(room, "to").select("shard", "to", ((F.col("trade") + rest) / F.col("want")).alias("share"))
        lot = F.pmod(F.xxhash64("node", "shard", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        moved = wishes.join(F.broadcast(room), ["shard", "to"], "left").withColumn(
            "shard", F.when(F.coalesce("share", F.lit(0.0)) > lot, F.col("to")).otherwise(F.col("shard"))
        )
        state = materialise(moved.groupBy("node", "shard").agg(F.sum("n").alias("n")), "shard-state")
    return state


def balanced_shards(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 40, rounds: int = 3
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text plus 16; a null text has none, crc 0 and no links; empty texts
    are equal texts. Law ``rows``: shard counts differ by at most one; slots are gapless from 0 in
    each shard; grown_shard is null. Repeated rows and null ids are rows like any other (rows equal
    in every column take their slots in no fixed order). An empty table gives an empty result.
    """
    base = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
            F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
            F.sha2(F.col(text), 256).alias("gid"),
            F.monotonically_increasing_id().alias("rid"),
        ),
        "shard-base",
    )
    total = base.count()
    quota = [total // shards + (shard < total % shards) for shard in range(shards)]
    groups = materialise(
        base.where("gid is not null").groupBy("gid").agg(F.count("*").alias("m")).where("m > 1"), "shard-groups"
    )

    # at most 8 groups of so many rows fill a shard
    is_large = F.col("m") * 8 >= max(1, total // shards)
    room = list(quota)
    seats = seat_large({r["gid"]: r["m"] for r in groups.where(is_large).collect()}, room)
    large = groups.where(is_large).select(F.col("gid").alias("node"))
    members = base.join(F.broadcast(large), base["gid"] == large["node"]).select("rid", "doc_id", "node")
    numbered = number_rows(materialise(members, "shard-large"), ["node"], ["doc_id", "rid"], "k")
    upto: dict[str, int] = {}
    spans = []
    for gid, shard, n in seats:
        lo = upto.get(gid, 0)
        upto[gid] = lo + n
        spans.append((gid, lo, lo + n, shard))
    # a seat a row, at most 16 and a cut a shard
    table = ", ".join(f"('{gid}', {lo}L, {hi}L, {shard})" for gid, lo, hi, shard in spans) or "('', 0L, 0L, 0)"
    seated = docs.sparkSession.sql(f"SELECT * FROM VALUES {table} AS t(node, lo, hi, shard)")
    at = numbered.join(F.broadcast(seated), "node").where("k >= lo and k < hi").select("rid", "doc_id", "shard")
    firm = number_rows(materialise(at, "shard-seated"), ["shard"], ["doc_id", "rid"], "slot").select("rid", "shard", "slot")

    # the others begin anywhere in the room that is left
    taken = [q - free for q, free in zip(quota, room)]
    lot = F.pmod(F.xxhash64("rid", "doc_id", F.lit(7)), F.lit(max(1, sum(room))))
    linked = materialise(
        base.join(groups.where(~is_large).drop("m"), "gid").select(
            "rid",
            "doc_id",
            F.col("gid").alias("node"),
            F.filter(intervals(room, taken), lambda p: p["hi"] > lot)[0]["shard"].alias("shard"),
        ),
        "shard-linked",
    )
    state = propagate(linked.groupBy("node", "shard").agg(F.count("*").alias("n")), room, rounds)

    # at last a node gathers where most of it is; what a shard has no room for stays together and moves on
    best = state.groupBy("node").agg(F.max(F.struct("n", F.xxhash64("node", "shard").alias("h"), "shard")).alias("best"))
    placed = linked.drop("shard").join(best.select("node", F.col("best.shard").alias("shard")), "node")
    loose = number_rows(materialise(placed, "shard-placed"), ["shard"], ["node"], "slot", ("doc_id", "rid")).where(F.col("slot") < by_shard(room))
    loose = loose.select("rid", "shard", (F.col("slot") + by_shard(taken)).alias("slot"))
    slots = materialise(firm.unionByName(loose), "shard-slots")

    # the rest, in hash order and equal texts together, fills the free places: intervals of a running
    # number, one a shard
    tag = F.coalesce("gid", F.concat(F.lit("row "), F.col("rid").cast("string")))
    rest = materialise(base.withColumn("tag", tag).join(slots.select("rid", "shard", "slot"), "rid", "left"), "shard-rest")
    used = {r["shard"]: r["n"] for r in slots.groupBy("shard").agg(F.count("*").alias("n")).collect()}  # ``shards`` rows
    lowest = [used.get(shard, 0) for shard in range(shards)]
    seat = intervals([q - n for q, n in zip(quota, lowest)], lowest)
    numbered = number_rows(rest.where("shard is null").drop("shard", "slot"), [], ["tag"], "k", ("doc_id", "rid"))
    filled = numbered.withColumn("seat", F.filter(seat, lambda p: p["hi"] > F.col("k"))[0]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.col("seat.shard").alias("shard"),
        (F.col("k") - F.col("seat.lo")).alias("slot"),
    )
    done = rest.where("shard is not null").select("doc_id", "size", "text_crc32", "shard", "slot")
    return done.unionByName(filled).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
