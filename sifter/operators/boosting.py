"""Newton boosting of regression trees on Spark (N4, N5, N7, N8; squared error).

A round grows one tree, level by level. A level is one pass over the rows: tasks sum gradients and
Hessians by (node, feature, bin), Spark adds the sums up, and each node's best split is searched where
its sums meet, so the driver gets one row per node and feature. Several fits over the same rows, such
as the folds of a cross-validation, share every pass.

* Gain is ``GL^2/(HL+lam) + GR^2/(HR+lam) - G^2/(H+lam)``; a split needs ``gamma`` of it (the split
  loss) and ``least`` rows on either side. Leaves weigh ``-G/(H+lam)``, times the rate.
* Columns are drawn once a tree, rows once a tree by a hash of the key: neither depends on partitions.
* Missing values go to the side with the larger gain, at each split.
* Categories are split natively: levels in order of their weight, on either side at most MAX_SET of
  them. A level is known by its hash, so no vocabulary is built, in the driver or elsewhere.
* A task sends one row per (node, feature) with the sums of all its codes, and these rows meet by node
  in one shuffle, so a pass's rows grow with tasks and nodes, not with codes. Where categories have
  more than WIDE levels, Spark adds the sums up by code first.
* Rows are kept in blocks: a record holds the codes of BLOCK rows, a narrow column a feature, and
  their scores a fit. A pass reads bytes it computes with. Features of few codes share a table, so
  that a row's sums cost one addition a table; a tree tells for each cell of a table which of its
  leaves remain possible, and the one that all tables leave is the row's.
* Gradients are whole multiples of a power of two, so sums are exact in any order, and a task that
  runs again, or elsewhere, gives the same tree.
* Every KEEP rounds the rows' scores are written; in between they follow from the trees since, which
  takes less than reading the scores of many fits.
* With a validation part, its error is a by-product of each round's first pass, and a fit ends
  ``patience`` rounds after its best round: no later tree is grown.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.operators.ranks import measured

MISSING = -1
MAX_SET, KEEP = 64, 20
#: Rows of a block, rows a task works on at a time, rows looked up at a time (they and their trees
#: stay in the processor's cache), cells of a table that features share; levels beyond which sums are
#: added up by code before they meet.
BLOCK, CHUNK, STEP, CELLS, WIDE = 1 << 14, 1 << 14, 1 << 12, 1024, 4096
#: Blocks are large values: row groups of few of them, so that a task holds little and files split evenly.
FILES = {"compression": "none", "parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
#: The original's settings (rounds, rate, depth, row and column shares, split loss, rounds of patience).
ROUNDS, RATE, DEPTH, SUBSAMPLE, COLSAMPLE, GAMMA, PATIENCE = 2000, 0.01, 5, 0.7, 0.8, 0.1, 50


@dataclass
class Node:
    """A leaf while ``feature`` is None. Left: codes up to ``cut``, or those in ``codes`` (not in
    them, unless ``inside``); missing ones as ``missing_left`` says."""

    value: float = 0.0
    feature: int | None = None
    cut: int = 0
    codes: np.ndarray | None = None
    inside: bool = True
    missing_left: bool = False
    left: int = 0
    right: int = 0
    gain: float = 0.0


Tree = list[Node]
NODE = [("value", "f8"), ("feature", "i4"), ("cut", "i8"), ("codes", "i8"), ("inside", "?"), ("missing_left", "?"), ("left", "i4"), ("right", "i4")]


class _Sent(list):
    """A tree that tasks get as a few bytes; a worker reads each one once."""

    sent: tuple | None = None
    leaves: tuple | None = None

    def __reduce__(self):
        if self.sent is None:
            cells = [
                (n.value, -1 if n.feature is None else n.feature, n.cut, -1 if n.codes is None else len(n.codes), n.inside, n.missing_left, n.left, n.right)
                for n in self
            ]
            self.sent = np.array(cells, NODE).tobytes(), b"".join(np.asarray(n.codes, np.int64).tobytes() for n in self if n.codes is not None)
        return _received, self.sent


@lru_cache(maxsize=1 << 12)
def _received(cells: bytes, codes: bytes) -> _Sent:
    left, at, tree = np.frombuffer(codes, np.int64), 0, _Sent()
    for value, feature, cut, size, *rest in np.frombuffer(cells, NODE).tolist():
        tree.append(Node(value, None if feature < 0 else feature, cut, None if size < 0 else left[at : at + size], *rest))
        at += max(size, 0)
    tree.sent = cells, codes
    return tree


def _land(tree: Tree, size: int, goes_left: Callable[[Node, np.ndarray], np.ndarray]) -> np.ndarray:
    """The node each of ``size`` rows ends in; only a node's own rows are tested there."""
    at = np.zeros(size, np.int32)
    waiting = [(0, np.arange(size))]
    while waiting:
        k, here = waiting.pop()
        node = tree[k]
        if node.feature is None:
            at[here] = k
            continue
        left = goes_left(node, here)
        waiting += [(node.left, here[left]), (node.right, here[~left])]
    return at


def land(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The node each row of codes (rows, features) ends in."""

    def goes_left(node: Node, here: np.ndarray) -> np.ndarray:
        v = x[here, node.feature]
        left = v <= node.cut if node.codes is None else np.isin(v, node.codes) == node.inside
        return np.where(v == MISSING, node.missing_left, left)

    return _land(tree, len(x), goes_left)


def values(tree: Tree) -> np.ndarray:
    return np.array([n.value for n in tree])


def drawn(hashes: np.ndarray, round_: int, seed: int, share: float) -> np.ndarray:
    """Which rows a round learns from: a hash of the row's hash, the round and the seed."""
    if share >= 1:
        return np.ones(len(hashes), bool)
    z = hashes.astype(np.uint64) + np.uint64((round_ * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))) < np.uint64(int(share * 2**64))


def columns_of(round_: int, seed: int, n: int, share: float) -> list[int]:
    """The features a round may split on."""
    rng = np.random.default_rng([seed, round_])
    return sorted(rng.choice(n, max(1, int(share * n)), replace=False).tolist())


def best_split(code: np.ndarray, g: np.ndarray, n: np.ndarray, categorical: bool, lam: float, least: int) -> tuple | None:
    """(gain, cut, codes, inside, missing_left, G left, rows left) from sums by code, or None.

    All cuts with missing values on the right, then all with them on the left; the first of the best
    counts. Codes are in ascending order; levels are ordered by weight, then code."""
    gone = code == MISSING
    gm, nm = g[gone].sum(), n[gone].sum()
    code, g, n = code[~gone], g[~gone], n[~gone]
    if categorical:
        order = np.lexsort((code, -g / (n + lam)))
        code, g, n = code[order], g[order], n[order]
    if not len(code):
        return None
    gl, nl = np.cumsum(g), np.cumsum(n)
    ga, na = gl[-1] + gm, nl[-1] + nm
    gl, nl = np.concatenate([gl, gl + gm]), np.concatenate([nl, nl + nm])
    gr, nr = ga - gl, na - nl
    gain = gl * gl / (nl + lam) + gr * gr / (nr + lam) - ga * ga / (na + lam)
    size = np.arange(1, len(code) + 1)
    wide = np.minimum(size, len(code) - size) > MAX_SET if categorical else np.zeros(len(code), bool)
    gain[(nl < least) | (nr < least) | np.concatenate([wide, wide])] = -np.inf
    k = int(np.argmax(gain))
    if gain[k] == -np.inf:
        return None
    cut = k % len(code)
    inside = not categorical or cut + 1 <= MAX_SET
    codes = None if not categorical else code[: cut + 1] if inside else code[cut + 1 :]
    return float(gain[k]), int(code[cut]), codes, inside, k >= len(code), float(gl[k]), float(nl[k])


@dataclass
class _Pass:
    """What the tasks of one pass need."""

    rate_trees: list[list[Tree]]  # finished trees since the scores were written, by fit
    growing: list[Tree]
    frontier: list[list[int]]  # nodes to split, by fit
    features: list[int]
    categorical: list[bool]
    widths: list[int]  # of numeric features: bins, and one for missing values
    held: list[int]  # the lot each fit leaves out
    round: int
    seed: int
    subsample: float
    g_scale: float
    e_scale: float
    measure: bool
    base: Sequence[float] = ()  # the scores while none are written


SUMS = "fit int, node int, feature int, code array<long>, g array<long>, n array<long>"


def _packed(x: np.ndarray) -> pa.Array:
    """A binary value for each row of a matrix of 8-byte numbers: read and sent much faster than lists."""
    size, width = len(x), 8 * x.shape[1]
    offsets = np.arange(0, size * width + 1, max(width, 1), dtype=np.int32)[: size + 1]
    return pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))])


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """The matrix of ``_packed``; there is a row at least."""
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, kind, (int(ends[-1]) - int(ends[0])) // 8, int(ends[0])).reshape(len(column), -1)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about CHUNK."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= CHUNK:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


class _Coded:
    """Codes of rows by feature, as narrow as they go, so that a test of all rows costs little: 0 for
    missing values, else the bin and one. Levels are numbered in order of their hashes, and a split on
    categories is tested once a level."""

    def __init__(self, size: int, codes: list[np.ndarray | None], levels: list[np.ndarray | None]):
        self.size, self.codes, self.levels = size, codes, levels

    @classmethod
    def of(cls, x: Sequence[np.ndarray], categorical: list[bool], widths: list[int]) -> _Coded:
        """From the codes of each feature."""
        codes, levels = [], []
        for v, kind, width in zip(x, categorical, widths):
            if kind:
                coded = pa.array(np.ascontiguousarray(v)).dictionary_encode()
                known = coded.dictionary.to_numpy()
                order = np.argsort(known)
                place = np.empty(len(order), np.min_scalar_type(max(len(order) - 1, 0)))
                place[order] = np.arange(len(order))
                codes.append(place[coded.indices.to_numpy()])
                levels.append(known[order])
            else:
                codes.append((v + 1).astype(np.min_scalar_type(width)))
                levels.append(None)
        return cls(len(x[0]) if len(x) else 0, codes, levels)

    @classmethod
    def joined(cls, parts: list[_Coded]) -> _Coded:
        if len(parts) == 1:
            return parts[0]
        codes, levels = [], []
        for j, first in enumerate(parts[0].levels):
            own, known = [p.codes[j] for p in parts], first
            if first is not None and not all(np.array_equal(p.levels[j], first) for p in parts):
                known = np.unique(np.concatenate([p.levels[j] for p in parts]))
                narrow = np.min_scalar_type(len(known) - 1)
                own = [np.searchsorted(known, p.levels[j]).astype(narrow)[c] for p, c in zip(parts, own)]
            codes.append(np.concatenate(own))
            levels.append(known)
        return cls(sum(p.size for p in parts), codes, levels)

    def take(self, rows: np.ndarray, features: set[int] | None = None) -> _Coded:
        """Some rows, of some features."""
        codes = [c.take(rows) if features is None or j in features else None for j, c in enumerate(self.codes)]
        return _Coded(len(rows), codes, self.levels)

    def goes_left(self, node: Node, here: np.ndarray) -> np.ndarray:
        levels = self.levels[node.feature]
        width = node.cut + 3 if levels is None else len(levels)
        left = _goes_left(node, width, levels)
        code = self.codes[node.feature][here]
        return left[np.minimum(code, width - 1) if levels is None else code]


def _goes_left(node: Node, width: int, levels: np.ndarray | None) -> np.ndarray:
    """Of each code of the node's feature, whether it goes left."""
    if levels is None:
        left = np.arange(width) <= node.cut + 1
        left[0] = node.missing_left
    else:
        left = np.full(width, not node.inside)
        at = np.searchsorted(levels, node.codes)
        at[at == width] = 0
        left[at[levels[at] == node.codes]] = node.inside
        gone = np.searchsorted(levels, MISSING)
        if gone < width and levels[gone] == MISSING:
            left[gone] = node.missing_left
    return left


def _tables(features: Iterable[int], width: dict[int, int]) -> list[list[int]]:
    """Features that share a table: as many as CELLS allow, the widest first."""
    out: list[list[int]] = []
    for j in sorted(features, key=lambda j: (-width[j], j)):
        for own in out:
            if math.prod(width[i] for i in own) * width[j] <= CELLS:
                own.append(j)
                break
        else:
            out.append([j])
    return out


class _Layout:
    """The tables of rows that have the same levels. Those of ``first`` come first, without other features."""

    def __init__(self, coded: _Coded, first: Iterable[int], rest: Iterable[int], widths: list[int]):
        self.levels, self.first = coded.levels, set(first)
        self.width = {j: widths[j] if coded.levels[j] is None else len(coded.levels[j]) for j in {*first, *rest}}
        self.tables = _tables(self.first, self.width) + _tables({*rest} - self.first, self.width)
        self.sizes = [math.prod(self.width[j] for j in own) for own in self.tables]

    def suits(self, coded: _Coded) -> bool:
        return all(known is None or np.array_equal(known, own) for known, own in zip(self.levels, coded.levels))

    def cells(self, coded: _Coded) -> list[np.ndarray]:
        """The cell of each row in each table."""
        out = []
        for own in self.tables:
            at = np.zeros(coded.size, np.int64)
            for j in own:
                at *= self.width[j]
                at += coded.codes[j]
            out.append(at)
        return out


def _leaves(tree: Tree) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """A tree's leaves and, of each split, the bits of the leaves on its left and right."""
    if getattr(tree, "leaves", None):
        return tree.leaves
    ends: list[int] = []
    sides: dict[int, tuple[int, int]] = {}

    def under(k: int) -> int:
        if tree[k].feature is None:
            ends.append(k)
            return 1 << (len(ends) - 1)
        sides[k] = under(tree[k].left), under(tree[k].right)
        return sides[k][0] | sides[k][1]

    under(0)
    if isinstance(tree, _Sent):
        tree.leaves = ends, sides
    return ends, sides


#: By the bits of a word: a factor that tells its powers of two apart in their highest bits, and how many those are.
FACTOR = {32: (0x077CB531, 5), 64: (0x03F79D71B4CB0A89, 6)}


class _Look:
    """Where rows end in each of some trees. A split takes the leaves on its other side out, so that one
    bit remains of all; trees of more than 64 leaves are walked."""

    def __init__(self, trees: list[Tree], layout: _Layout):
        found = [_leaves(t) for t in trees]
        most = max(len(ends) for ends, _ in found)
        self.trees, self.walked, self.tables = trees, most > 64, []
        self.size = max(map(len, trees)) if self.walked else 32 if most <= 32 else 64  # places of a tree
        kind = np.uint64 if self.size == 64 else np.uint32
        self.first = (np.arange(len(trees)) * self.size).astype(kind)
        if self.walked:
            self.places = [np.arange(len(t)) for t in trees]
            self.ends = self.places
            return
        self.factor, bits = kind(FACTOR[self.size][0]), FACTOR[self.size][1]
        self.shift = kind(self.size - bits)
        every = (self.factor << np.arange(self.size, dtype=kind)) >> self.shift
        self.ends, self.places = [ends for ends, _ in found], [every[: len(ends)].astype(int) for ends, _ in found]
        full = [(1 << len(ends)) - 1 for ends in self.ends]
        splits: dict[int, list] = {}
        for m, (_, sides) in enumerate(found):
            for k, (on_left, on_right) in sides.items():
                splits.setdefault(trees[m][k].feature, []).append((m, trees[m][k], kind(full[m] ^ on_right), kind(full[m] ^ on_left)))
        for t, own in enumerate(layout.tables):
            left = None
            for i, j in enumerate(own):
                if j not in splits:
                    continue
                # by tree, so that a split works on a run of codes
                remain = np.repeat(np.array(full, kind)[:, None], layout.width[j], axis=1)
                for m, node, if_left, if_right in splits[j]:
                    _narrow(remain[m], node, layout.levels[j], if_left, if_right)
                remain = remain.T.reshape(*(layout.width[j] if a == i else 1 for a in range(len(own))), len(trees))
                left = remain if left is None else left & remain
            if left is not None:
                left = np.broadcast_to(left, (*(layout.width[j] for j in own), len(trees)))
                self.tables.append((t, np.ascontiguousarray(left).reshape(layout.sizes[t], len(trees))))

    def at(self, coded: _Coded, cells: list[np.ndarray], own: slice) -> np.ndarray:
        """(rows, trees) of some rows: places in what ``by_end`` gives."""
        size = len(range(coded.size)[own])
        if self.walked:
            goes_left = lambda node, here: coded.goes_left(node, here + own.start)
            ends = np.stack([_land(t, size, goes_left) for t in self.trees], axis=1).astype(self.first.dtype)
        elif not self.tables:
            ends = np.zeros((size, len(self.trees)), self.first.dtype)
        else:
            ends = None
            for t, table in self.tables:
                got = table.take(cells[t][own], axis=0, mode="clip")
                ends = got if ends is None else np.bitwise_and(ends, got, out=ends)
            ends *= self.factor
            ends >>= self.shift
        ends += self.first
        return ends.astype(np.intp)

    def by_end(self, nodes: list[np.ndarray]) -> np.ndarray:
        """What is given for the nodes of each tree, by the places of its leaves."""
        out = np.zeros((len(self.trees), self.size), nodes[0].dtype)
        for m, (ends, places) in enumerate(zip(self.ends, self.places)):
            out[m, places] = nodes[m][ends]
        return out.ravel()


def _narrow(remain: np.ndarray, node: Node, levels: np.ndarray | None, if_left: int, if_right: int) -> None:
    """Takes the leaves that a split excludes out of those that remain for each code."""
    if levels is None:
        remain[0] &= if_left if node.missing_left else if_right
        remain[1 : node.cut + 2] &= if_left
        remain[node.cut + 2 :] &= if_right
        return
    remain &= np.where(_goes_left(node, len(levels), levels), if_left, if_right)


class _Sum:
    """What rounds of trees add to the scores of each fit. Trees of several rounds are looked up at once."""

    def __init__(self, rounds: list[list[Tree]], layout: _Layout):
        each = max(1, 32 // len(rounds[0])) if rounds else 1
        self.fits = len(rounds[0]) if rounds else 0
        self.looks = [_Look([t for trees in rounds[k : k + each] for t in trees], layout) for k in range(0, len(rounds), each)]
        self.values = [look.by_end([values(t) for t in look.trees]) for look in self.looks]

    def add(self, to: np.ndarray, coded: _Coded, cells: list[np.ndarray], own: slice) -> None:
        """Round after round to ``to`` (rows, fits), which are some of the rows."""
        for look, given in zip(self.looks, self.values):
            found = given.take(look.at(coded, cells, own), mode="clip")
            for k in range(0, found.shape[1], self.fits):
                to += found[:, k : k + self.fits]


def _steps(size: int) -> list[slice]:
    return [slice(a, a + STEP) for a in range(0, size, STEP)]


def _used(trees: Iterable[Tree]) -> set[int]:
    return {node.feature for tree in trees for node in tree if node.feature is not None}


def _rounds(fits: list[list[Tree]]) -> list[list[Tree]]:
    """Trees of each round, of all fits; a fit that has ended adds nothing."""
    return [[trees[r] if r < len(trees) else [Node()] for trees in fits] for r in range(max(map(len, fits), default=0))]


BLOCKS = (
    "hash binary, lot binary, y binary, codes array<binary>, levels array<binary>, n long, low double, high double, "
    "lots array<int>, totals array<double>, counts array<long>"
)


def _blocks(batches: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]], categorical: list[bool], widths: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks, with what is asked of all labels: their number, ends and, by lot, sums."""
    kinds = {"binary": pa.binary(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    fields = []
    for part in BLOCKS.split(", "):
        name, kind = part.split()
        fields.append(pa.field(name, pa.list_(kinds[kind[6:-1]]) if kind.startswith("array") else kinds[kind]))
    for batch, x in batches:
        hashes, lot, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hash", "lot", "y"))
        out = []
        for a in range(0, batch.num_rows, BLOCK):
            own = slice(a, a + BLOCK)
            coded = _Coded.of([v[own] for v in x], categorical, widths)
            lots, at, counts = np.unique(lot[own], return_inverse=True, return_counts=True)
            levels = [b"" if v is None else v.tobytes() for v in coded.levels]
            out.append((
                *(np.ascontiguousarray(v[own]).tobytes() for v in (hashes, lot, y)), [c.tobytes() for c in coded.codes], levels,
                len(at), float(y[own].min()), float(y[own].max()), lots, np.bincount(at, y[own]), counts,
            ))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), fields)], schema=pa.schema(fields))


@dataclass
class _Chunk:
    """Rows a task works on: blocks as they were read, or plain rows."""

    coded: _Coded
    hashes: np.ndarray
    lot: np.ndarray
    y: np.ndarray
    score: np.ndarray | None  # (rows, fits)
    blocks: list[pa.RecordBatch]
    sizes: list[int]

    @classmethod
    def of_rows(cls, batch: pa.RecordBatch, categorical: list[bool], widths: list[int]) -> _Chunk:
        plain = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("hash", "lot", "y")]
        coded = _Coded.of(_matrix(batch.column("x"), np.int64).T, categorical, widths)
        return cls(coded, *plain, _matrix(batch.column("score"), np.float64), [], [])

    @classmethod
    def of_blocks(cls, blocks: list[pa.RecordBatch], categorical: list[bool]) -> _Chunk:
        sizes = [b.column("n")[0].as_py() for b in blocks]
        together = lambda parts: parts[0] if len(parts) == 1 else np.concatenate(parts)
        hashes, lot, y = (
            together([np.frombuffer(b.column(c)[0].as_buffer(), kind) for b in blocks])
            for c, kind in (("hash", np.int64), ("lot", np.int32), ("y", np.float64))
        )
        score = None
        if "score" in blocks[0].schema.names:
            parts = [np.frombuffer(b.column("score")[0].as_buffer(), np.float64) for b in blocks]
            score = together([p.reshape(n, -1) for p, n in zip(parts, sizes)])
        parts = []
        for b, n in zip(blocks, sizes):
            columns = [v.as_buffer() for v in b.column("codes")[0].values]
            codes = [np.frombuffer(v, f"u{v.size // n}") for v in columns]
            levels = [np.frombuffer(v.as_buffer(), np.int64) if kind else None for v, kind in zip(b.column("levels")[0].values, categorical)]
            parts.append(_Coded(n, codes, levels))
        return cls(_Coded.joined(parts), hashes, lot, y, score, blocks, sizes)


def _chunks(batches: Iterator[pa.RecordBatch], categorical: list[bool], widths: list[int]) -> Iterator[_Chunk]:
    """Blocks, or plain rows, by about CHUNK rows."""
    held, size = [], 0
    for batch in batches:
        if "x" in batch.schema.names:
            yield _Chunk.of_rows(batch, categorical, widths)
            continue
        for i in range(batch.num_rows):
            held.append(batch.slice(i, 1))
            size += batch.column("n")[i].as_py()
            if size >= CHUNK:
                yield _Chunk.of_blocks(held, categorical)
                held, size = [], 0
    if size:
        yield _Chunk.of_blocks(held, categorical)


class _Sums:
    """Gradient sums and numbers of rows of one task, by (fit, feature, node, code)."""

    def __init__(self, job: _Pass):
        self.job, self.nodes = job, [len(f) for f in job.frontier]
        self.parts: dict[tuple, list] = {}
        self.layout: _Layout | None = None
        self.dense: dict[tuple, np.ndarray] = {}

    def begin(self, layout: _Layout) -> None:
        self.flush()
        self.layout = layout

    def add(self, m: int, cells: list[np.ndarray], slot: np.ndarray, g: np.ndarray) -> None:
        """Rows of fit ``m`` whose node is number ``slot - 1`` of the frontier, none for 0."""
        rows = np.flatnonzero(slot) if 2 * np.count_nonzero(slot) < len(slot) else None
        if rows is not None:
            slot, g = slot[rows], g[rows]
        for t, (own, width) in enumerate(zip(self.layout.tables, self.layout.sizes)):
            if own[0] not in self.layout.first:
                continue
            key = slot * width
            key += cells[t] if rows is None else cells[t].take(rows)
            known = self.layout.levels[own[0]]
            if known is not None and width > CELLS:
                key, at = np.unique(key, return_inverse=True)
                sums = np.zeros((2, len(key)), np.int64)
                np.add.at(sums[0], at, g)
                sums[1] = np.bincount(at, minlength=len(key))
                real = key >= width
                self.parts.setdefault((m, own[0]), []).append((key[real] // width - 1, known[key[real] % width], *sums[:, real]))
                continue
            size = (self.nodes[m] + 1) * width
            if (m, t) not in self.dense:
                self.dense[m, t] = np.zeros((2, size), np.int64)
            np.add.at(self.dense[m, t][0], key, g)
            np.add.at(self.dense[m, t][1], key, 1)

    def flush(self) -> None:
        """The sums of each feature from those of the tables."""
        for (m, t), sums in self.dense.items():
            own, width = self.layout.tables[t], self.layout.width
            cube = sums.reshape(2, self.nodes[m] + 1, *(width[j] for j in own))[:, 1:]
            for i, j in enumerate(own):
                g, n = (s.ravel() for s in cube.sum(axis=tuple(a + 2 for a in range(len(own)) if a != i)))
                there = np.flatnonzero(n)
                code, known = there % width[j], self.layout.levels[j]
                self.parts.setdefault((m, j), []).append((there // width[j], code - 1 if known is None else known[code], g[there], n[there]))
        self.dense = {}

    def all(self) -> Iterator[tuple]:
        """(fit, feature, node, code, sum of g, rows), in order of nodes and codes."""
        self.flush()
        for (m, j), parts in sorted(self.parts.items()):
            yield m, j, *_merged(*(np.concatenate(p) for p in zip(*parts)))


def _sums(batches: Iterator[pa.RecordBatch], job: _Pass) -> Iterator[pa.RecordBatch]:
    """Gradient sums of one task; node -1 holds the squared error of a fit's own validation rows."""
    sums, fits = _Sums(job), range(len(job.held))
    marks = [np.zeros(len(tree), np.int64) for tree in job.growing]
    for m in fits:
        marks[m][job.frontier[m]] = np.arange(1, len(job.frontier[m]) + 1)
    rounds = _rounds(job.rate_trees)
    used = _used(t for trees in rounds for t in trees) | _used(job.growing) | set(job.features)
    errors = np.zeros((len(job.held), 2), np.int64)
    layout, room = None, np.empty((2, len(job.held), 0), np.int64)
    for chunk in _chunks(batches, job.categorical, job.widths):
        if layout is None or not layout.suits(chunk.coded):
            layout = _Layout(chunk.coded, job.features, used, job.widths)
            since, growing = _Sum(rounds, layout), _Look(job.growing, layout)
            slots = growing.by_end(marks)
            sums.begin(layout)

        def scored(coded: _Coded, cells: list[np.ndarray], rows: np.ndarray, own: slice) -> np.ndarray:
            added = np.zeros((len(rows[own]), len(job.held)))
            since.add(added, coded, cells, own)
            return (np.array(job.base) if chunk.score is None else chunk.score.take(rows[own], axis=0)) + added

        if job.measure:
            rows = np.flatnonzero(np.isin(chunk.lot, job.held))
            coded = chunk.coded.take(rows, used)
            cells = layout.cells(coded)
            for own in _steps(len(rows)):
                off, lot = scored(coded, cells, rows, own) - chunk.y[rows[own], None], chunk.lot[rows[own]]
                for m, held in enumerate(job.held):
                    mine = off[lot == held, m]
                    errors[m] += [np.rint(mine**2 * job.e_scale).astype(np.int64).sum(), len(mine)]
        if not any(job.frontier):
            continue
        rows = np.flatnonzero(drawn(chunk.hashes, job.round, job.seed, job.subsample))
        coded, lot, y = chunk.coded.take(rows, used), chunk.lot.take(rows), chunk.y.take(rows)
        cells = layout.cells(coded)
        if room.shape[2] < len(rows):
            room = np.empty((2, len(job.held), len(rows)), np.int64)
        slot, g = room[:, :, : len(rows)]
        for own in _steps(len(rows)):
            off = scored(coded, cells, rows, own)
            off -= y[own, None]
            off *= job.g_scale
            g[:, own] = np.rint(off, out=off).T
            slot[:, own] = slots.take(growing.at(coded, cells, own), mode="clip").T
        for m in fits:
            if job.frontier[m]:
                slot[m, lot == job.held[m]] = 0
                sums.add(m, cells, slot[m], g[m])
    out = [(m, j, *rest) for m, j, *rest in sums.all()]
    if job.measure:
        out += [(m, -1, np.array([-1]), np.array([0]), *errors[m : m + 1].T) for m in fits]
    names = ["fit", "node", "feature", "code", "g", "n"]
    for m, j, node, code, g, n in out:
        begin = np.flatnonzero(np.diff(node, prepend=-2))  # nodes ascend
        if not len(begin):
            continue
        size, offsets = len(begin), pa.array(np.append(begin, len(node)).astype(np.int32))
        plain = [np.full(size, m, np.int32), node[begin].astype(np.int32), np.full(size, j, np.int32)]
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(v), pa.int64())) for v in (code, g, n)]
        yield pa.RecordBatch.from_arrays([*map(pa.array, plain), *lists], names=names)


def _merged(group: np.ndarray, code: np.ndarray, g: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums by (group, code), in that order."""
    order = np.lexsort((code, group))
    group, code, g, n = group[order], code[order], g[order], n[order]
    first = np.flatnonzero((np.diff(group, prepend=group[:1] - 1) != 0) | (np.diff(code, prepend=code[:1]) != 0))
    if not len(first):
        return group, code, g, n
    return group[first], code[first], np.add.reduceat(g, first), np.add.reduceat(n, first)


SPLITS = (
    "fit int, node int, feature int, g double, n double, gain double, cut long, codes array<long>, inside boolean, "
    "missing_left boolean, gl double, nl double"
)


def _search(categorical: list[bool], lam: float, least: int, scale: float):
    kinds = [pa.int32()] * 3 + [pa.float64()] * 3 + [pa.int64(), pa.list_(pa.int64()), pa.bool_(), pa.bool_(), pa.float64(), pa.float64()]
    names = [part.split()[0] for part in SPLITS.split(", ")]

    def run(table: pa.Table) -> pa.Table:
        """The best split of each feature, from all sums of one node."""
        fit, node = table.column("fit")[0].as_py(), table.column("node")[0].as_py()
        feature, code = table.column("feature").to_numpy(), table.column("code").combine_chunks()
        if pa.types.is_list(code.type):
            feature = np.repeat(feature, pc.list_value_length(code).to_numpy(zero_copy_only=False))
            parts = (code.flatten(), *(table.column(c).combine_chunks().flatten() for c in ("g", "n")))
        else:
            parts = code, table.column("g"), table.column("n")
        feature, code, g, n = _merged(feature, *(p.to_numpy() for p in parts))
        rows = []
        bounds = np.flatnonzero(np.diff(feature, prepend=feature[0] - 1, append=feature[-1] + 1))
        for a, b in zip(bounds[:-1], bounds[1:]):
            j = int(feature[a])
            if node < 0:
                rows.append((fit, node, j, float(g[a:b].sum()), float(n[a:b].sum()), *[None] * 7))
                continue
            real = g[a:b] / scale
            found = best_split(code[a:b], real, n[a:b], categorical[j], lam, least)
            rest = (None,) * 7 if found is None else (*found[:2], None if found[2] is None else found[2].tolist(), *found[3:])
            rows.append((fit, node, j, float(real.sum()), float(n[a:b].sum()), *rest))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return run


class Boosted:
    """A fit: bins of the numeric features, trees, and the errors of its rounds."""

    def __init__(self, numeric: list[str], categorical: list[str], edges: list[np.ndarray], base: float):
        self.numeric, self.categorical, self.edges, self.base = numeric, categorical, edges, base
        self.trees: list[Tree] = []
        self.errors: list[float] = []
        self.rounds_tried = 0
        self.blocks: DataFrame | None = None  # the rows it was made from, those left out among them

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    @property
    def rounds_kept(self) -> int:
        return len(self.trees)

    def predict(self, df: DataFrame, key: str) -> DataFrame:
        """``key, pred_log, prediction`` (expm1, negatives clamped to 0: D10, D12). Levels and values
        not seen in the fit go where the splits send what they do not name; columns may be null."""
        return predict_each(df, key, [self], F.lit(0))

    def importances(self, spark) -> DataFrame:
        """``(feature, importance)``: mean gain of a feature's splits, as a share of all features'."""
        total, count = np.zeros(len(self.features)), np.zeros(len(self.features))
        for node in (n for t in self.trees for n in t if n.feature is not None):
            total[node.feature] += node.gain
            count[node.feature] += 1
        mean = total / np.maximum(count, 1)
        share = mean / (mean.sum() or 1.0)
        return spark.createDataFrame([(f, float(s)) for f, s in zip(self.features, share)], "feature string, importance double")


def predict_each(df: DataFrame, key: str, fits: list[Boosted], which: Column) -> DataFrame:
    """As ``Boosted.predict``, every row by the fit whose number is ``which``; the fits are of one call of ``boost``."""
    bases, forests = np.array([f.base for f in fits]), [[_Sent(t) for t in f.trees] for f in fits]

    first = fits[0]
    kinds, widths = _shape(first.numeric, first.categorical, first.edges)

    score = _scorer(forests, bases, widths)

    def run(batches: Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        for batch, x in batches:
            f = score(_Coded.of(x, kinds, widths), batch.column("lot").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(f)], names=["key", "pred_log"])

    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("pred_log", T.DoubleType())])
    scored = encode(df, first.numeric, first.categorical, first.edges, [F.col(key).alias("key"), which.cast("int").alias("lot")], run, schema)
    return scored.select(F.col("key").alias(key), "pred_log", F.greatest(F.expm1("pred_log"), F.lit(0.0)).alias("prediction"))


def predict_left_out(fits: list[Boosted], held: Sequence[int]) -> DataFrame:
    """``lot, label, pred_log`` of the rows in a lot that one of the fits leaves out, by that fit, from
    the blocks of one call of ``boost``: as ``predict_each`` gives, without coding the rows again."""
    first, lots = fits[0], np.array(held)
    kinds, widths = _shape(first.numeric, first.categorical, first.edges)
    score = _scorer([[_Sent(t) for t in f.trees] for f in fits], np.array([f.base for f in fits]), widths)
    order = np.argsort(lots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, kinds, widths):
            rows = np.flatnonzero(np.isin(chunk.lot, lots))
            lot = chunk.lot[rows]
            f = score(chunk.coded.take(rows), order[np.searchsorted(lots[order], lot)])
            yield pa.RecordBatch.from_arrays([pa.array(lot), pa.array(chunk.y[rows]), pa.array(f)], names=["lot", "label", "pred_log"])

    return first.blocks.mapInArrow(run, "lot int, label double, pred_log double")


def _scorer(forests: list[list[Tree]], bases: np.ndarray, widths: list[int]) -> Callable[[_Coded, np.ndarray], np.ndarray]:
    """Scores of rows, each by the fit of its number."""
    used = [_used(trees) for trees in forests]
    known: dict[int, tuple] = {}

    def score(coded: _Coded, which: np.ndarray) -> np.ndarray:
        f = bases[which]
        for m in np.unique(which).tolist():
            if not forests[m]:
                continue
            if m not in known or not known[m][0].suits(coded):
                layout = _Layout(coded, used[m], (), widths)
                known[m] = layout, _Sum([[t] for t in forests[m]], layout)
            layout, forest = known[m]
            rows = np.flatnonzero(which == m)
            own = coded.take(rows, used[m])
            cells, added = layout.cells(own), np.zeros((len(rows), 1))
            for some in _steps(len(rows)):
                forest.add(added[some], own, cells, some)
            f[rows] += added[:, 0]
        return f

    return score


def _shape(numeric: Sequence[str], categorical: Sequence[str], edges: list[np.ndarray]) -> tuple[list[bool], list[int]]:
    """Which features are categorical; codes of the numeric ones: bins, and one for missing values."""
    return [False] * len(numeric) + [True] * len(categorical), [len(e) + 2 for e in edges] + [0] * len(categorical)


def bin_edges(df: DataFrame, numeric: Sequence[str], bins: int) -> list[np.ndarray]:
    """Upper ends of each numeric feature's bins, from one mergeable sketch: quantiles of the known
    values. A value that is rarer than a bin may share one."""
    if not numeric:
        return []
    probs = [i / bins for i in range(1, bins)]
    known = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    row = df.agg(*[F.percentile_approx(known(c), probs, 20 * bins).alias(f"e{i}") for i, c in enumerate(numeric)]).first()
    return [np.unique(np.array(row[f"e{i}"] or [], float)) for i in range(len(numeric))]


def encode(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], edges: list[np.ndarray], keep: Sequence[Column],
    then: Callable[[Iterator], Iterator] | None = None, schema: T.StructType | str | None = None,
) -> DataFrame:
    """``keep`` and ``x``, the row's codes: a bin of each numeric feature, a hash of each level; or what
    ``then`` makes of batches of ``keep`` and the codes by feature."""
    raw = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"raw{i}") for i, c in enumerate(numeric)]
    level = [F.when(F.col(c).isNull(), F.lit(MISSING)).otherwise(F.xxhash64(F.col(c).cast("string"))).alias(f"level{i}") for i, c in enumerate(categorical)]
    kept = df.select(*keep).schema
    rows = df.select(*keep, *raw, *level)
    first = len(kept)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        for batch in _joined(batches):
            x = []
            for i, c in enumerate(batch.columns[first:]):
                v = c.to_numpy(zero_copy_only=False)
                x.append(np.where(np.isnan(v), MISSING, np.searchsorted(edges[i], v)) if i < len(edges) else v)
            yield pa.RecordBatch.from_arrays(batch.columns[:first], names=kept.names), x

    def listed(batches: Iterator) -> Iterator[pa.RecordBatch]:
        for batch, x in batches:
            size, width = batch.num_rows, len(x)
            flat = np.array(x, np.int64).reshape(width, size).T.ravel()
            codes = pa.ListArray.from_arrays(pa.array(np.arange(0, size * width + 1, max(width, 1), dtype=np.int32)[: size + 1]), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=[*batch.schema.names, "x"])

    if then is None:
        then, schema = listed, T.StructType([*kept, T.StructField("x", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(lambda batches: then(coded(batches)), schema)


def stopped(errors: Sequence[float], patience: int) -> bool:
    """``patience`` rounds have passed since the first of the best."""
    return len(errors) - 1 - int(np.argmin(errors)) >= patience if errors else False


def boost(
    df: DataFrame, key: str, label: Column, numeric: Sequence[str], categorical: Sequence[str], lot: Column | None = None,
    held: Sequence[int] = (-2,), rounds: int = ROUNDS, rate: float = RATE, depth: int = DEPTH, subsample: float = SUBSAMPLE,
    colsample: float = COLSAMPLE, gamma: float = GAMMA, lam: float = 1.0, least: int = 1, bins: int = 256, seed: int = 42,
    patience: int | None = None,
) -> list[Boosted]:
    """One fit for each number in ``held``: it learns from the rows whose ``lot`` is another one, and
    its error is measured on the rest; with ``patience`` it ends that many rounds after its best one
    and keeps the trees up to there. Rows without a label are left out; without rows the fit is empty
    and predicts 0."""
    numeric, categorical, held = list(numeric), list(categorical), list(held)
    df = df.withColumn("_y", label.cast("double")).where(F.col("_y").isNotNull())
    edges = bin_edges(df, numeric, bins)
    lots = F.coalesce(lot, F.lit(-1)) if lot is not None else F.lit(-1)
    keep = [F.xxhash64(F.col(key)).alias("hash"), lots.cast("int").alias("lot"), F.col("_y").alias("y")]
    kinds, widths = _shape(numeric, categorical, edges)
    blocks = encode(df, numeric, categorical, edges, keep, lambda batches: _blocks(batches, kinds, widths), BLOCKS)
    cores = df.sparkSession.sparkContext.defaultParallelism
    state = measured(blocks.repartition(cores), "boost-rows", **FILES)  # as many files of one size: a task each
    each = [F.try_divide(*(F.sum(F.when(F.col("lots") != h, F.col(c))) for c in ("totals", "counts"))).alias(f"b{m}") for m, h in enumerate(held)]
    facts = state.select("low", "high", F.inline(F.arrays_zip("lots", "totals", "counts")))
    facts = facts.agg(F.sum("counts").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), *each).first()
    fits = [Boosted(numeric, categorical, edges, facts[f"b{m}"] or 0.0) for m in range(len(held))]
    for fit in fits:
        fit.blocks = state
    if not facts["n"]:
        return fits
    spread = 2 * max(facts["high"] - facts["low"], 1e-300)
    exact = lambda most: 2.0 ** min(40, 61 - math.ceil(math.log2(facts["n"] * most + 1e-300)))
    g_scale, e_scale = exact(spread), exact(spread**2)
    state = state.select("hash", "lot", "y", "codes", "levels", "n")
    base = [f.base for f in fits]
    pending: list[list[Tree]] = [[] for _ in held]
    live = [True] * len(held)

    wide = bool(categorical) and max(df.agg(*map(F.approx_count_distinct, categorical)).first()) > WIDE

    def run(job: _Pass) -> list:
        sums = state.mapInArrow(lambda batches: _sums(batches, job), SUMS)
        if wide:
            sums = sums.select("fit", "node", "feature", F.inline(F.arrays_zip("code", "g", "n")))
            sums = sums.groupBy("fit", "node", "feature", "code").agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        groups = sum(map(len, job.frontier)) + len(held) * job.measure
        sums = sums.repartition(max(1, min(groups, cores)), "fit", "node")
        return sums.groupBy("fit", "node").applyInArrow(_search(kinds, lam, least, g_scale), SPLITS).collect()

    for r in range(rounds + 1):
        growing: list[Tree] = [[Node()] for _ in held]
        frontier = [[0] if on and r < rounds else [] for on in live]
        features = columns_of(r, seed, len(kinds), colsample)
        for level in range(depth):
            measure = level == 0 and r > 0 and patience is not None
            if not any(frontier) and not measure:
                break
            job = _Pass(pending, [_Sent(t) for t in growing], frontier, features, kinds, widths, held, r, seed, subsample, g_scale, e_scale, measure, base)
            found = run(job)
            if measure:
                for x in found:
                    if x["node"] < 0 and live[x["fit"]] and x["n"]:
                        fits[x["fit"]].errors.append(math.sqrt(x["g"] / e_scale / x["n"]))
                        if stopped(fits[x["fit"]].errors, patience):
                            live[x["fit"]], frontier[x["fit"]] = False, []
            frontier = _grow(growing, frontier, found, lam, rate, gamma)
        if r == rounds or not any(live):
            break
        for m in range(len(held)):
            if live[m]:
                fits[m].trees.append(growing[m])
                fits[m].rounds_tried = r + 1
                pending[m].append(_Sent(growing[m]))
        if len(pending[live.index(True)]) >= KEEP and (r + 1 < rounds or patience is not None):
            state = measured(_advanced(state, pending, kinds, widths, base), "boost-scores", **FILES)
            pending = [[] for _ in held]
    if patience is not None:
        for fit in fits:
            if fit.errors:
                fit.trees = fit.trees[: int(np.argmin(fit.errors)) + 1]
    return fits


def _grow(growing: list[Tree], frontier: list[list[int]], found: list, lam: float, rate: float, gamma: float) -> list[list[int]]:
    """Split the nodes of the frontier that gain enough; returns their children."""
    best: dict[tuple, object] = {}
    for x in sorted((x for x in found if x["node"] >= 0), key=lambda x: x["feature"]):
        k = x["fit"], frontier[x["fit"]][x["node"]] if frontier[x["fit"]] else -1
        if k[1] < 0:
            continue
        tree = growing[x["fit"]]
        if k[1] == 0:
            tree[0].value = -x["g"] / (x["n"] + lam) * rate
        if x["gain"] is not None and (k not in best or x["gain"] > best[k]["gain"]):
            best[k] = x
    after: list[list[int]] = [[] for _ in growing]
    for (m, k), x in sorted(best.items(), key=lambda item: item[0]):
        if x["gain"] < gamma or x["gain"] <= 1e-6:
            continue
        tree, node = growing[m], growing[m][k]
        node.feature, node.gain, node.cut, node.inside, node.missing_left = x["feature"], x["gain"], x["cut"], x["inside"], x["missing_left"]
        node.codes = None if x["codes"] is None else np.array(x["codes"], np.int64)
        node.left, node.right = len(tree), len(tree) + 1
        for g, n in ((x["gl"], x["nl"]), (x["g"] - x["gl"], x["n"] - x["nl"])):
            tree.append(Node(-g / (n + lam) * rate))
        after[m] += [node.left, node.right]
    return after


def _advanced(state: DataFrame, pending: list[list[Tree]], categorical: list[bool], widths: list[int], base: list[float]) -> DataFrame:
    """The blocks with their rows' scores after the pending trees."""
    names = ["hash", "lot", "y", "codes", "levels", "n", "score"]
    rounds = _rounds(pending)
    used = _used(t for trees in rounds for t in trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = None
        for chunk in _chunks(batches, categorical, widths):
            if layout is None or not layout.suits(chunk.coded):
                layout = _Layout(chunk.coded, used, (), widths)
                since = _Sum(rounds, layout)
            score = np.tile(base, (chunk.coded.size, 1)) if chunk.score is None else chunk.score.copy()
            cells = layout.cells(chunk.coded)
            for own in _steps(len(score)):
                since.add(score[own], chunk.coded, cells, own)
            ends = np.cumsum(chunk.sizes)
            own = pa.array([score[b - n : b].tobytes() for b, n in zip(ends, chunk.sizes)], pa.binary())
            blocks = pa.concat_batches(chunk.blocks)
            yield pa.RecordBatch.from_arrays([*(blocks.column(c) for c in names[:-1]), own], names=names)

    return state.mapInArrow(run, T.StructType([*state.schema.fields[:6], T.StructField("score", T.BinaryType())]))

