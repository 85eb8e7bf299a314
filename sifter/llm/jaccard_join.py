"""N-gram Jaccard join: count vectors in an R-tree.

Only shingles that another document has can add to an overlap. Blocks of documents send their
distinct shingle hashes, with counts, to owners and learn each one's document frequency; a document
of n shingles whose shared ones are fewer than t * n links with nothing and is done. The others
are joined:

1. Equal sets make one class, joined by its first member.
2. A class's shared shingles, hashed into GROUPS groups, give a vector of group counts. The overlap
   of two sets is at most the sum over groups of the smaller count.
3. Classes meet in buckets, one for each of their n - ceil(t * n) + 1 rarest shingles (two sets as
   similar as t share one of those). In a bucket the vectors are points of an R-tree; a pair of
   nodes is followed while the bound, with the nodes' largest counts and smallest sizes, allows t.
4. Surviving pairs are verified on their shingle sets; links give components.

A bucket of many near copies would hold the square of their number in pairs. So first, in two
rounds, classes are grouped by the smallest hash of their shared shingles (by several hashes) and
verified only against a few leaders of their groups; what that connects needs no more pairs. The
join proper then follows pairs of classes that are not connected yet. Buckets above CELL members are
cut into cells, each pair of cells a piece of work. Nothing is left out, no bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .components import components
from .lm_scoring import Block, WORD, by_owner, expand, make_blocks, pack_keys, sorted_counts, squeeze, unpack_keys

SHINGLE = 5
GROUPS = 64
#: Link when NUMERATOR * union <= 100 * intersection.
NUMERATOR = 75
#: Shingle hashes an owner sums up, about.
OWNER_KEYS = 2_000_000
#: Members of a bucket treated as one piece; leaders of a group, and the hashes of each round.
CELL, LEADERS = 4096, 4
ROUNDS = ((0, 1, 2), (3, 4, 5))
#: Text of a block; its shingle hashes take ten times the memory.
BLOCK = 4 << 20
LEAF, FAN = 16, 16


def shingles(block: Block) -> Iterator[np.ndarray]:
    """Of each document in turn the sorted distinct shingle hashes; empty without words."""
    parts = [(h, d) for h, d in block.words()][:-1]  # the last part holds the ends
    h = np.concatenate([np.zeros(0, np.uint64), *(x for x, _ in parts)])
    doc = np.concatenate([np.zeros(0, np.int64), *(x for _, x in parts)])
    n = len(h)
    roll = np.zeros(max(0, n - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        roll = (roll ^ h[k : k + len(roll)]) * np.uint64(0x9FB21C651E98DF25)
        roll ^= roll >> np.uint64(31)
    cuts = np.searchsorted(doc, np.arange(len(block.length) + 1)).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= SHINGLE:
            yield np.unique(roll[a : b - SHINGLE + 1])
        elif b > a:  # the whole sequence as one
            x = np.uint64(b - a)
            for w in h[a:b]:
                x = np.uint64((int(x ^ w) * 0xD6E8FEB86659FD93) & (2**64 - 1))
                x ^= x >> np.uint64(29)
            yield np.array([x], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def need(sizes):
    """Least overlap for sizes a + b = ``sizes``: 100 o >= 75 (a + b - o)."""
    return -(-NUMERATOR * sizes // (100 + NUMERATOR))


def vector(tokens: np.ndarray) -> np.ndarray:
    group = (tokens * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
    return np.bincount(group.astype(np.int64), minlength=GROUPS).astype(np.int32)


# ---- the R-tree


class RTree:
    """Points packed by size, then by their widest coordinate; nodes hold the largest coordinates
    and the smallest size below them."""

    def __init__(self, sizes: np.ndarray, points: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        slab = LEAF * FAN
        wide = points[:, int(np.argmax(points.var(axis=0)))]
        order = order[np.lexsort((wide[order], np.arange(len(order)) // slab))]
        self.order = order
        self.high, self.least = [points[order]], [sizes[order]]
        width = LEAF
        while len(self.least[-1]) > 1:
            begin = np.arange(0, len(self.least[-1]), width)
            self.high.append(np.maximum.reduceat(self.high[-1], begin, axis=0))
            self.least.append(np.minimum.reduceat(self.least[-1], begin))
            width = FAN

    def width(self, level: int) -> int:
        return LEAF if level == 1 else FAN

    def join(self, other: RTree | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of points (i, j) that the bound allows; without ``other`` those with i before j."""
        right = other or self
        # both trees from the same height down
        top = max(len(self.least), len(right.least)) - 1
        i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
        for level in range(top, -1, -1):
            a, b = min(level, len(self.least) - 1), min(level, len(right.least) - 1)
            keep = []
            for k in range(0, len(i), 1 << 14):
                x, y = i[k : k + (1 << 14)], j[k : k + (1 << 14)]
                bound = np.minimum(self.high[a][x], right.high[b][y]).sum(axis=1)
                keep.append(bound >= need(self.least[a][x].astype(np.int64) + right.least[b][y]))
            keep = np.concatenate(keep) if keep else np.zeros(0, bool)
            i, j = i[keep], j[keep]
            if level:
                i, j = self._children(i, j, level, right)
                if other is None:
                    i, j = i[i <= j], j[i <= j]
        if other is None:
            i, j = i[i < j], j[i < j]
        return self.order[i], right.order[j]

    def _children(self, i, j, level, right):
        def spread(tree, nodes):
            if level >= len(tree.least):  # lower than the other tree: stays
                return nodes[:, None], np.ones((len(nodes), 1), bool)
            below = nodes[:, None] * tree.width(level) + np.arange(tree.width(level))
            return below, below < len(tree.least[level - 1])

        x, x_ok = spread(self, i)
        y, y_ok = spread(right, j)
        both = x_ok[:, :, None] & y_ok[:, None, :]
        return np.broadcast_to(x[:, :, None], both.shape)[both], np.broadcast_to(y[:, None, :], both.shape)[both]


def bucket_pairs(comp, size, points, cell):
    """Pairs (places) of one bucket's, or one pair of cells', members that the bound allows and that
    lie in different components."""
    if (cell == cell[0]).all():
        i, j = RTree(size, points).join()
    else:
        one, two = np.flatnonzero(cell == cell.min()), np.flatnonzero(cell != cell.min())
        i, j = RTree(size[one], points[one]).join(RTree(size[two], points[two]))
        i, j = one[i], two[j]
    keep = comp[i] != comp[j]
    return i[keep], j[keep]


def first_meeting(token: int, keys: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether ``token`` is the smallest bucket key the members at i and j have in common: a pair is
    reported in one bucket, however many it meets in."""
    sets = {k: frozenset(keys[k].tolist()) for k in np.unique(np.concatenate([i, j])).tolist()}
    return np.array([min(sets[a] & sets[b]) == token for a, b in zip(i.tolist(), j.tolist())], bool)


# ---- the Spark jobs


def frequencies(blocks: DataFrame, owners: int) -> DataFrame:
    """(block, owner, df): document frequencies of the block's distinct shingles of that owner."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body, length, held in zip(*(batch.column(c).to_pylist() for c in ("block", "body", "length", "held"))):
                sets = list(shingles(Block(body, length, held)))
                keys, counts = sorted_counts(np.concatenate([np.zeros(0, np.uint64), *sets]))
                del sets
                rows = [
                    (owner, name, pack_keys(keys[at]), squeeze(counts[at].astype("<i4")))
                    for owner, at in enumerate(by_owner(keys, WORD, owners))
                    if len(at)
                ]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=["owner", "block", "keys", "counts"])

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [unpack_keys(k) for k in pdf["keys"]]
        keys = np.concatenate(lists)
        n = np.concatenate([expand(c, "<i4") for c in pdf["counts"]]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
        df = np.empty(len(keys), np.int64)
        df[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(np.append(first, len(keys))))
        cuts = np.cumsum([len(x) for x in lists])[:-1]
        return pd.DataFrame({"block": pdf["block"], "owner": pdf["owner"], "df": [squeeze(x.astype("<i8")) for x in np.split(df, cuts)]})

    sent = blocks.select("block", "body", "length", "held").mapInArrow(send, "owner long, block long, keys binary, counts binary")
    return sent.groupBy("owner").applyInPandas(count, "block long, owner long, df binary")


_DOC = "rid long, doc_id long, n long, set_hash binary, prefix int, tokens array<long>, points array<int>"


def reduce_documents(blocks: DataFrame, answers: DataFrame, owners: int) -> DataFrame:
    """Per document its size and, where it can link at all, its shared shingles, rarest first, how
    many of them are bucket keys, the group counts and a hash of the set."""

    def run(blob: pd.DataFrame, answered: pd.DataFrame) -> Iterator[pd.DataFrame]:
        frames = []
        for row in blob.itertuples():
            block = Block(row.body, row.length, row.held)
            sets = list(shingles(block))
            keys, _ = sorted_counts(np.concatenate([np.zeros(0, np.uint64), *sets]))
            df = np.zeros(len(keys), np.int64)
            places = by_owner(keys, WORD, owners)
            for owner, got in zip(answered["owner"], answered["df"]):
                df[places[owner]] = expand(got, "<i8")
            out = {c: [] for c in ("set_hash", "prefix", "tokens", "points")}
            for own in sets:
                n = len(own)
                seen = df[np.searchsorted(keys, own)]
                shared = seen > 1
                count = int(shared.sum())
                if not n or 100 * count < NUMERATOR * n:
                    for x in out.values():
                        x.append(None)
                    continue
                tokens = own[shared]
                tokens = tokens[np.lexsort((tokens, seen[shared]))]
                out["set_hash"].append(digest(own) if count == n else np.int64(row.block << 20 | len(out["tokens"])).tobytes())
                out["prefix"].append(n - -(-NUMERATOR * n // 100) + 1 - (n - count))
                out["tokens"].append(tokens.view(np.int64))
                out["points"].append(vector(tokens))
            base = row.block << 20
            head = {
                "rid": base + np.arange(len(sets)),
                "doc_id": pd.arrays.IntegerArray(np.frombuffer(row.doc_ids, "<i8").copy(), np.frombuffer(row.missing, np.uint8).astype(bool)),
                "n": [len(x) for x in sets],
            }
            out["prefix"] = pd.array(out["prefix"], "Int32")
            frames.append(pd.DataFrame(head | out))
        return pd.concat(frames) if frames else pd.DataFrame(columns=["rid", "doc_id", "n", "set_hash", "prefix", "tokens", "points"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, _DOC)


def digest(keys: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(keys.tobytes(), digest_size=16).digest()


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    sides = [classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"t_{s}")) for s in "ab"]
    both = pairs.select("a", "b").join(sides[0], "a").join(sides[1], "b")
    overlap = F.size(F.array_intersect("t_a", "t_b"))
    return both.where(100 * overlap >= NUMERATOR * (F.col("n_a") + F.col("n_b") - overlap)).select("a", "b")


def leader_pairs(classes: DataFrame, comp: DataFrame, turns: tuple[int, ...]) -> DataFrame:
    """Distinct pairs (a, b) of a class and a leader of one of its groups that lie in different
    components and that the bound allows. A group's classes come in a random order, its leaders
    first; however large it is, only they are held while the others pass."""
    key = lambda t: F.xxhash64(F.lit(t), F.array_min(F.transform("tokens", lambda x: F.xxhash64(x, F.lit(t)))))
    rows = classes.join(comp, "rep", "left").select(
        F.explode(F.array(*map(key, turns))).alias("token"), "rep", F.coalesce("comp", "rep").alias("comp"), "n", "points"
    )
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "token").sortWithinPartitions("token", F.xxhash64("rep", "token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            frame = batch.to_pandas()
            if not len(frame):
                continue
            frame = pd.concat([held, frame], ignore_index=True) if held is not None else frame
            token, rep, comp, size = (frame[c].to_numpy(np.int64) for c in ("token", "rep", "comp", "n"))
            points = np.stack(frame["points"].to_numpy())
            at = np.arange(len(frame))
            first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            begin = np.repeat(first, np.diff(np.append(first, len(frame))))
            found = []
            for k in range(LEADERS):
                i = at[(begin + k < at) & (comp[np.minimum(begin + k, len(frame) - 1)] != comp)]
                j = begin[i] + k
                bound = np.minimum(points[i], points[j]).sum(axis=1)
                keep = bound >= need(size[i] + size[j])
                found.append(np.stack([rep[i[keep]], rep[j[keep]]], axis=1))
            found = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
            held = frame.iloc[first[-1] : first[-1] + LEADERS]

    return rows.mapInArrow(run, "a long, b long").distinct()


def bucket_join(postings: DataFrame, classes: DataFrame, comp: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of classes in different components that meet in a bucket and that the
    bound allows."""
    known = postings.join(comp, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    known = materialise(known, "join-postings")
    stats = known.groupBy("token").agg(
        F.count("*").alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.min("rep").alias("a"), F.max("rep").alias("b"),
    ).where("low <> high")
    stats = materialise(stats, "join-buckets")
    two = stats.where("m = 2").select("a", "b").distinct()
    cells = F.ceil(F.col("m") / CELL).cast("int")
    large = known.join(stats.where("m > 2").select("token", cells.alias("cells")), "token")
    # every pair of cells is a piece
    large = large.withColumn("cell", F.pmod(F.xxhash64("rep"), F.col("cells")).cast("int"))
    large = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    large = large.withColumn("piece", F.least("cell", "other") * F.col("cells") + F.greatest("cell", "other"))
    points = classes.select("rep", "n", "points", F.slice("tokens", 1, F.col("prefix")).alias("keys"))
    rows = large.join(points, "rep").select("token", "piece", "cell", "rep", "comp", "n", "points", "keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.DataFrame] = []

        def flush(frame: pd.DataFrame) -> pa.RecordBatch:
            """Pairs of whole pieces."""
            token, piece, rep, comp, size, cell = (frame[c].to_numpy(np.int64) for c in ("token", "piece", "rep", "comp", "n", "cell"))
            points, keys = np.stack(frame["points"].to_numpy()), frame["keys"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (piece[1:] != piece[:-1]), [True]]))
            found = [np.zeros((0, 2), np.int64)]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                i, j = bucket_pairs(comp[a:b], size[a:b], points[a:b], cell[a:b])
                new = first_meeting(int(token[a]), keys[a:b], i, j)
                found.append(np.stack([rep[a:b][i[new]], rep[a:b][j[new]]], axis=1))
            both = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            frame = batch.to_pandas()
            if not len(frame):
                continue
            frame = pd.concat([*held, frame], ignore_index=True)
            # the last piece may go on in the next batch
            same = (frame["token"] == frame["token"].iloc[-1]) & (frame["piece"] == frame["piece"].iloc[-1])
            tail = int(same.to_numpy().argmax())
            if tail:
                yield flush(frame.iloc[:tail])
            held = [frame.iloc[tail:]]
        if held:
            yield flush(held[0])

    parts = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "token", "piece").sortWithinPartitions("token", "piece", "rep")
    return dealt.mapInArrow(run, "a long, b long").unionByName(two).distinct()


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Texts are lower-cased (A-Z); words are runs of anything but ASCII white space; the set is that
    of distinct 5-word shingles, of a shorter text its whole sequence. Two documents link when 100 *
    intersection >= 75 * union. component_id is the smallest doc_id reachable by links, itself
    included (null ids do not count; all null: null). Null texts, and texts without words, have
    empty sets and link with nothing. Repeated rows are documents of their own, linked with each
    other if they have words. An empty table gives no rows.

    Shingles are told apart by 64-bit hashes, whatever the size of the table, so two documents link
    or not by their own texts alone.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lit(False).alias("held"), F.col(text).alias("text"))
    blocks = materialise(make_blocks(rows, BLOCK), "join-blocks")
    total = int(docs.agg(F.sum(F.octet_length(text))).first()[0] or 0) // 4 + 1
    owners = max(16, -(-total // OWNER_KEYS))
    reduced = materialise(reduce_documents(blocks, frequencies(blocks, owners), owners), "join-documents")

    able = reduced.where("tokens is not null")
    first = able.groupBy("set_hash").agg(F.min("rid").alias("rep"))
    classes = able.join(first.select("rep"), able["rid"] == F.col("rep"), "left_semi")
    classes = materialise(classes.select(F.col("rid").alias("rep"), "n", "prefix", "tokens", "points"), "join-classes")
    postings = classes.select("rep", F.explode(F.slice("tokens", 1, F.col("prefix"))).alias("token"))
    several = postings.groupBy("token").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    postings = materialise(postings.join(several.select("token"), "token", "left_semi"), "join-postings")

    spark = docs.sparkSession
    comp = spark.createDataFrame([], "rep long, comp long")
    links = spark.createDataFrame([], "a long, b long")
    for turns in [*ROUNDS, None]:
        pairs = leader_pairs(classes, comp, turns) if turns else bucket_join(postings, classes, comp)
        found = materialise(verified(pairs, classes), "join-found")
        if not found.isEmpty():
            links = links.unionByName(found)
            comp = components(links).select(F.col("id").alias("rep"), F.col("component").alias("comp"))

    # classes to documents: every member of a class has its component's smallest id
    member = able.select("rid", "doc_id", "set_hash").join(first, "set_hash").join(comp, "rep", "left")
    member = member.select("rid", "doc_id", F.coalesce("comp", "rep").alias("comp"))
    low = member.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    found = member.join(low, "comp").select("rid", "component_id")
    return reduced.select("rid", "doc_id", F.col("n").alias("n_shingles")).join(found, "rid", "left").select(
        "doc_id", "n_shingles", F.when(F.col("component_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )
