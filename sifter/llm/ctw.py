"""Context-tree weighting over bytes: the numeric part, on sorted arrays.

A byte is decided bit by bit, high bit first. Each of the 255 bit decisions has its own tree of
contexts, the bytes before, nearest first, to DEPTH. A node counts its zeros and ones; its block
probability by Krichevsky and Trofimov is

    Pe(z, o) = G(z + 1/2) G(o + 1/2) / (pi G(z + o + 1))

and the weighted one Pw = Pe at DEPTH, else (Pe + product of the children's Pw) / 2. So a node's
share of stopping, given the counts, is Pe / (2 Pw), and a bit's probability is the mixture over
the depths of its context's path of (o + 1/2) / (z + o + 1). Depths never visited take no part.

All counts follow from the numbers of *grams*: DEPTH context bytes, nearest in the highest place,
and the byte that followed. In sorted order the grams of a context are neighbours.
"""

from __future__ import annotations

import numpy as np

#: Context bytes; a gram is one byte longer and fits 64 bits up to DEPTH 7.
DEPTH = 5
PAD = b"\n" * DEPTH
_HALF_LOG_2PI = 0.5 * np.log(2 * np.pi)


def grams(stream: np.ndarray) -> np.ndarray:
    """The gram at each place of a byte stream from DEPTH on."""
    b = stream.astype(np.uint64)
    n = len(b) - DEPTH
    key = b[DEPTH:].copy()
    for k in range(1, DEPTH + 1):
        key |= b[DEPTH - k : DEPTH - k + n] << np.uint64(8 * (DEPTH - k + 1))
    return key


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x >= 1/2 (Stirling's series after a shift by 6)."""
    shift = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    y = x + 6
    z = 1 / (y * y)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y
    return (y - 0.5) * np.log(y) - y + _HALF_LOG_2PI + series - np.log(shift)


_SMALL = 4096
_HALVES, _WHOLES = log_gamma(np.arange(_SMALL) + 0.5), log_gamma(np.arange(_SMALL) + 1.0)


def log_pe(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    def half(n):
        out = _HALVES[np.minimum(n, _SMALL - 1)]
        big = n >= _SMALL
        out[big] = log_gamma(n[big] + 0.5)
        return out

    total = zeros + ones
    whole = _WHOLES[np.minimum(total, _SMALL - 1)]
    big = total >= _SMALL
    whole[big] = log_gamma(total[big] + 1.0)
    return half(zeros) + half(ones) - whole - np.log(np.pi)


def shorten(keys: np.ndarray, depth: int, to: int) -> np.ndarray:
    """Grams of ``depth`` context bytes cut to the ``to`` nearest."""
    low = keys & np.uint64(255)
    return ((keys >> np.uint64(8 * (depth - to + 1))) << np.uint64(8)) | low


def merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


class Level:
    """The nodes at one depth and bit: keys (context, byte so far) and counts of zeros and ones."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, bit: int):
        shift = np.uint64(8 - bit)
        nodes = keys >> shift  # sorted, as keys are
        first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else np.zeros(0, np.int64)
        one = ((keys >> (shift - np.uint64(1))) & np.uint64(1)).astype(np.int64)
        self.keys = nodes[first]
        total = np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)
        self.ones = np.add.reduceat(counts * one, first) if len(first) else total
        self.zeros = total - self.ones

    @classmethod
    def of(cls, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> Level:
        level = cls.__new__(cls)
        level.keys, level.zeros, level.ones = keys, zeros, ones
        return level

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``keys`` and whether they are there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys


def node_keys(keys: np.ndarray, bit: int) -> np.ndarray:
    return keys >> np.uint64(8 - bit)


def up(nodes: np.ndarray, bit: int) -> np.ndarray:
    """Node keys of a depth cut to the depth above: the farthest context byte goes."""
    low = nodes & np.uint64((1 << bit) - 1)
    return ((nodes >> np.uint64(bit + 8)) << np.uint64(bit)) | low


def counts_by_depth(keys: np.ndarray, counts: np.ndarray, depth: int, to: int) -> dict[int, tuple]:
    """Gram counts at every depth from ``depth`` up to ``to``."""
    out = {depth: (keys, counts)}
    for d in range(depth - 1, to - 1, -1):
        keys, counts = merge(shorten(keys, d + 1, d), counts)
        out[d] = (keys, counts)
    return out


def weigh(level: Level, below: tuple | None, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """(log Pw, share of stopping) of a level's nodes. ``below``: (keys, log Pw) of the depth below."""
    pe = log_pe(level.zeros, level.ones)
    if below is None:
        return pe, np.ones(len(pe))
    keys, pw_below = below
    at, _ = level.find(up(keys, bit))
    split = np.bincount(at, weights=pw_below, minlength=len(pe))
    pw = np.logaddexp(pe, split) - np.log(2)
    return pw, np.exp(pe - pw) / 2


def levels_of(keys: np.ndarray, counts: np.ndarray, to: int) -> list[dict[int, Level]]:
    """All levels from grams of DEPTH context bytes up to depth ``to``."""
    by_depth = counts_by_depth(keys, counts, DEPTH, to)
    return [{d: Level(*kc, bit) for d, kc in by_depth.items()} for bit in range(8)]


class Tree:
    """Nodes of some neighbouring depths for the bit decisions of some contexts.

    ``levels``: by bit and depth. ``below``: by bit (keys, log Pw) of the depth under the deepest,
    if there is one. ``pw_top``: the same of the shallowest.
    """

    def __init__(self, levels: list[dict[int, Level]], below: list | None = None):
        self.levels, self.depths = levels, sorted(levels[0])
        self.stop: list[dict] = []
        self.pw_top: list[tuple] = []
        for bit in range(8):
            under, stop = below[bit] if below else None, {}
            for d in reversed(self.depths):
                pw, stop[d] = weigh(self.levels[bit][d], under, bit)
                under = (self.levels[bit][d].keys, pw)
            self.stop.append(stop)
            self.pw_top.append(under)

    def mix(self, above: list | None = None) -> None:
        """``mixed``: by bit and depth the probability of a one if the path ends here. ``under``: by
        bit (keys, mixed so far, weight left) of the deepest level, the ``above`` of the next tree."""
        self.mixed, self.under = [], []
        for bit in range(8):
            by_depth, over = {}, above[bit] if above else None
            for d in self.depths:
                level = self.levels[bit][d]
                kt = (level.ones + 0.5) / (level.zeros + level.ones + 1)
                acc, left = np.zeros(len(kt)), np.ones(len(kt))
                if over is not None:
                    at = np.searchsorted(over[0], up(level.keys, bit))
                    acc, left = over[1][at], over[2][at]
                stop = self.stop[bit][d]
                by_depth[d] = acc + left * kt
                over = (level.keys, acc + left * stop * kt, left * (1 - stop))
            self.mixed.append(by_depth)
            self.under.append(over)

    def log_prob(self, keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(ln probability of the bits whose node is in this tree, how many bits those are) of grams."""
        out, done = np.zeros((8, len(keys))), np.zeros((8, len(keys)), bool)
        for d in reversed(self.depths):
            cut = shorten(keys, depth, d) if d < depth else keys
            for bit in range(8):
                todo = np.flatnonzero(~done[bit])
                if not len(todo):
                    continue
                at, hit = self.levels[bit][d].find(node_keys(cut[todo], bit))
                todo, at = todo[hit], at[hit]
                one = (cut[todo] >> np.uint64(7 - bit)) & np.uint64(1)
                p = self.mixed[bit][d][at]
                out[bit, todo] = np.log(np.where(one == 1, p, 1 - p))
                done[bit, todo] = True
        return out, done
