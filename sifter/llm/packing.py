"""Packing: order-preserving dynamic programming over window cuts.

Documents in id order make one stream of tokens, cut into sequences of at most ``size``. Cuts may
fall at document ends (free), at sentence ends (a small penalty) and, where a sentence is longer
than a sequence, inside it (a larger one). With p the places where cuts may fall, the least cost is

    best[j] = penalty[j] + min over p[j] - size <= p[i] < p[j] of best[i] + size - (p[j] - p[i])

The minimum of best[i] + p[i] over a sliding window comes from a monotone queue, so a stream of n
places takes n steps. A sequence whose length is a power of two needs no padding: those transitions
are found by binary search. After the program, a sequence whose padding costs more than cutting it
into powers of two is cut so: that only lowers the cost of the program's plan, which need not be the
least that plans with such cuts could have.

Ranges of ids make the partitions. A partition is planned in stretches of about a million tokens;
the last sequence of a stretch opens the next, so only a partition's last sequence can be short.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, shuffle_partitions
from .tokens import encoder, slices

#: Costs in tokens of padding: of a cut at a sentence end, of one inside a sentence, of a sequence.
SENTENCE, INSIDE, SEQUENCE = 8, 64, 2
STRETCH = 1 << 20


def plan_cuts(place: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Indices of ``place`` (ascending from 0, gaps of at most ``size``) where sequences end."""
    n = len(place)
    exact: dict[int, list[int]] = {}
    power = 1
    while power < size:
        at = np.searchsorted(place, place - power)
        for j in np.flatnonzero((at < np.arange(n)) & (place[np.minimum(at, n - 1)] == place - power)).tolist():
            exact.setdefault(j, []).append(int(at[j]))
        power *= 2
    p, cost = place.tolist(), (penalty + SEQUENCE).tolist()
    best, origin = [0] * n, [0] * n
    queue: deque = deque([(0, 0, 0)])  # (best + place, place, index), ascending in the first
    for j in range(1, n):
        here = p[j]
        while queue[0][1] < here - size:
            queue.popleft()
        key, _, i = queue[0]
        least = key + size - here
        for k in exact.get(j, ()):
            if best[k] < least:
                least, i = best[k], k
        least += cost[j]
        best[j], origin[j] = least, i
        key = least + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, here, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(j)
        j = origin[j]
    return cuts[::-1]


def plan(ids: np.ndarray, doc_ends: np.ndarray, sentence: np.ndarray, size: int) -> list[int]:
    """Ends of sequences in the stream ``ids``. ``sentence``: by id, whether it ends a sentence."""
    total = len(ids)
    kind = np.zeros(total + 1, np.int64)
    kind[1:][sentence[ids]] = 1
    kind[doc_ends] = 2
    kind[[0, total]] = 2
    place = np.flatnonzero(kind)
    gap = np.diff(place)
    wide = np.flatnonzero(gap > size)
    if len(wide):
        more = [np.arange(place[i] + size, place[i + 1], size) for i in wide]
        place = np.unique(np.concatenate([place, *more]))
    penalty = np.array([INSIDE, SENTENCE, 0])[kind[place]]
    return place[plan_cuts(place, penalty, size)].tolist()


def powers(length: int, size: int) -> list[int]:
    """Lengths to cut a sequence of ``length`` into: itself, or its powers of two if that is cheaper."""
    if length & (length - 1) == 0 or (length.bit_count() - 1) * (INSIDE + SEQUENCE) >= size - length:
        return [length]
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids.

    A document is its text's ids (null: an empty text) and ``end_id``; start counts its ids before
    the piece, doc_tokens all of them; ids holds the piece as little-endian unsigned 32-bit numbers.
    Sequences have at most ``size`` (a power of two) tokens. sequence_id is the partition times
    2**32 plus a running number. Null ids come first; repeated rows are packed each; other columns
    are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        sentence = np.array([n.removesuffix("</w>")[-1:] in set(".!?") and n != "" for n in enc.names])
        sequence = TaskContext.get().partitionId() << 32
        held: list[tuple] = []  # (doc_id, start, doc_tokens, ids): pieces not yet packed
        count = 0

        def pack_held(last: bool) -> pa.RecordBatch | None:
            nonlocal held, count, sequence
            stream = np.concatenate([h[3] for h in held])
            upto = np.cumsum([len(h[3]) for h in held])
            ends = [0, *plan(stream, upto, sentence, size)]
            keep = len(ends) - 1 if last else len(ends) - 2
            rows: list[tuple] = []
            k, used = 0, 0  # piece, and its tokens used
            for a, b in zip(ends[:keep], ends[1 : keep + 1]):
                for length in powers(b - a, size):
                    offset = 0
                    while offset < length:
                        name, start, whole, ids = held[k]
                        take = min(length - offset, len(ids) - used)
                        rows.append((name, start + used, take, whole, sequence, offset, ids[used : used + take].astype("<u4").tobytes()))
                        offset, used = offset + take, used + take
                        if used == len(ids):
                            k, used = k + 1, 0
                    sequence += 1
            rest = held[k:]
            if used:
                name, start, whole, ids = rest[0]
                rest[0] = (name, start + used, whole, ids[used:])
            held, count = rest, sum(len(h[3]) for h in rest)
            if not rows:
                return None
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for a, b, texts in slices(batch.column("text")):
                for name, x in zip(names[a:b], enc.encode(texts)):
                    held.append((name, 0, len(x) + 1, np.append(x, np.uint32(end_id))))
                    count += len(x) + 1
                if count >= STRETCH and (out := pack_held(False)):
                    yield out
        if held and (out := pack_held(True)):
            yield out
        give_back()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    return ranged.mapInArrow(
        run, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
