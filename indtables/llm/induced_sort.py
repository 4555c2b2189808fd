"""External induced suffix sorting (after eSAIS: Bingmann, Fischer, Osipov,
2013) with numpy.

Suffixes of type S* (smaller than the next one, after a larger one) are sorted
first: their substrings are named in order, and the string of names is sorted
by the same method, or in memory once it is short. Then a priority queue
carries tuples (first symbol, rank of the next suffix, place): the smallest
symbol's tuples are taken off in order of rank, which is the order of their
suffixes, and each one puts its predecessor into the queue. One ascending pass
induces type L from S*, one descending pass type S from L. The queue keeps a
run of tuples per symbol; over ``memory`` tuples the runs go to files of a
scratch folder, which is removed at the end."""

from __future__ import annotations

import os
import tempfile
from collections import defaultdict

import numpy as np

# Strings of names up to this many symbols are sorted in memory.
IN_MEMORY = 1 << 21
# Shorter texts are not worth a pass.
SHORT = 1 << 12
# Tuples that a queue holds in memory.
QUEUE_TUPLES = 1 << 22


def _by_symbol(symbols: np.ndarray) -> np.ndarray:
    """Stable order; a radix sort where symbols are small."""
    if len(symbols) and symbols.max() < 1 << 16:
        symbols = symbols.astype(np.uint16)
    return np.argsort(symbols, kind="stable")


class Queue:
    """Tuples (symbol, rank, place), taken off one symbol at a time."""

    def __init__(self, folder: str, memory: int, kind: type):
        self.folder, self.memory, self.kind, self.held = folder, memory, kind, 0
        self.runs: dict[int, list[np.ndarray]] = defaultdict(list)
        self.files: set[int] = set()

    def push(self, symbol: np.ndarray, rank: np.ndarray, place: np.ndarray) -> None:
        if not len(symbol):
            return
        order = _by_symbol(symbol)
        symbol, rows = symbol[order], np.stack((rank[order], place[order]), axis=1)
        cuts = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
        for s, part in zip(symbol[np.concatenate(([0], cuts))].tolist(), np.split(rows, cuts)):
            self.runs[s].append(part)
        self.held += len(symbol)
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        for s, parts in self.runs.items():
            with open(os.path.join(self.folder, f"{id(self)}-{s}"), "ab") as f:
                for part in parts:
                    part.tofile(f)
            self.files.add(s)
        self.runs.clear()
        self.held = 0

    def take(self, symbol: int) -> np.ndarray:
        """Places of the symbol's tuples, by rank."""
        parts = self.runs.pop(symbol, [])
        self.held -= sum(map(len, parts))
        if symbol in self.files:
            path = os.path.join(self.folder, f"{id(self)}-{symbol}")
            parts.append(np.fromfile(path, self.kind).reshape(-1, 2))
            os.remove(path)
            self.files.discard(symbol)
        if not parts:
            return np.zeros(0, self.kind)
        rows = np.concatenate(parts)
        return rows[np.argsort(rows[:, 0]), 1]


def _doubling(text: np.ndarray, depth: int | None) -> np.ndarray:
    """Suffix array in memory, by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key)
        ordered = key[order]
        new = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == n - 1 or depth is not None and width >= depth:
            return order


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S; the last, shortest one is S."""
    n = len(text)
    kind = np.zeros(n, bool)
    kind[-1] = True
    differs = np.flatnonzero(text[:-1] != text[1:])
    # a place takes the type of the next place that differs from its successor
    if len(differs):
        kind[: differs[-1] + 1] = np.repeat(text[differs] < text[differs + 1], np.diff(differs, prepend=-1))
    return kind


def _names(text: np.ndarray, kind: np.ndarray, star: np.ndarray) -> np.ndarray:
    """Ordered names of the S* substrings, each up to the next S*; symbols are
    compared with their types, so none is a prefix of another."""
    symbols = (2 * text + kind).astype(">u4")
    ends = np.concatenate((star[1:] + 1, [len(text)]))
    hashed = np.zeros(len(star), np.uint64)
    left, step = ends - star, 0
    active = np.arange(len(star))
    with np.errstate(over="ignore"):
        while len(active):
            value = symbols[star[active] + step].astype(np.uint64) + np.uint64(1)
            h = (hashed[active] ^ value) * np.uint64(0x9E3779B97F4A7C15)
            hashed[active] = h ^ (h >> np.uint64(29))
            step += 1
            active = active[left[active] > step]
    _, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
    order = sorted(range(len(first)), key=lambda i: symbols[star[first[i]] : ends[first[i]]].tobytes())
    name = np.empty(len(first), np.int64)
    name[order] = np.arange(len(first))
    return name[inverse]


def _induce(text: np.ndarray, kind: np.ndarray, seeds: np.ndarray, upward: bool, folder: str, memory: int) -> list[np.ndarray]:
    """One pass. ``seeds``: places in suffix order that are given; returns the
    induced places by symbol, in the pass's direction."""
    queue = Queue(folder, memory, seeds.dtype.type)
    out: list[np.ndarray] = []
    sign = 1 if upward else -1
    seeds = seeds if upward else seeds[::-1]
    by_symbol = text[seeds]
    cuts = np.concatenate(([0], np.flatnonzero(by_symbol[1:] != by_symbol[:-1]) + 1, [len(seeds)]))
    given = {int(by_symbol[a]): (a, b) for a, b in zip(cuts, cuts[1:])} if len(seeds) else {}
    rank = 0
    symbols = np.unique(text)
    for s in (symbols if upward else symbols[::-1]).tolist():

        def put(places: np.ndarray, rank: int) -> np.ndarray:
            """Predecessors of the other kind to the queue; those that start
            with this symbol too are returned: they come next."""
            numbers = np.arange(rank, rank + len(places), dtype=places.dtype)
            ok = places > 0
            before, numbers = places[ok] - 1, numbers[ok]
            ok = kind[before] != upward
            before, numbers = before[ok], numbers[ok]
            c = text[before]
            same = c == s
            queue.push(c[~same], numbers[~same], before[~same])
            return before[same]

        # induced ones of this symbol come before given ones in both directions
        todo = queue.take(s)
        while len(todo):
            out.append(todo)
            following = put(todo, rank)
            rank += len(todo)
            todo = following
        if s in given:
            a, b = given[s]
            put(seeds[a:b], rank)  # their predecessors start with another symbol
            rank += b - a
    return out


def suffix_array(
    text: np.ndarray,
    depth: int | None = None,
    in_memory: int = IN_MEMORY,
    memory: int = QUEUE_TUPLES,
    folder: str | None = None,
    short: int = SHORT,
) -> np.ndarray:
    """Places of all suffixes in order. ``text``: numbers >= 0. With ``depth``
    only that many first symbols decide; suffixes that agree so far come in
    any order."""
    if folder is None:
        with tempfile.TemporaryDirectory(prefix="induced-") as folder:
            return suffix_array(text, depth, in_memory, memory, folder, short)
    if len(text) <= max(short, 2):
        return _doubling(np.asarray(text), depth) if len(text) else np.zeros(0, np.int64)
    number = np.int32 if len(text) < (1 << 30) else np.int64  # places and symbols
    text = np.append(np.asarray(text, number) + number(1), number(0))  # an end smaller than all
    kind = _types(text)
    star = (np.flatnonzero(kind[1:] & ~kind[:-1]) + 1).astype(number)
    names = _names(text, kind, star)
    if len(star) and names.max() == len(star) - 1:
        order = np.argsort(names)
    else:  # a name stands for two symbols at least
        depth = None if depth is None else depth // 2 + 1
        order = suffix_array(names, depth, in_memory, memory, folder, in_memory)
    star = star[order]
    del names, order
    none = np.zeros(0, number)
    large = np.concatenate([none, *_induce(text, kind, star, True, folder, memory)])
    # the descending pass starts from type L and the end itself
    seeds = np.append(number(len(text) - 1), large)
    del star
    small = np.concatenate([none, *_induce(text, kind, seeds, False, folder, memory)])[::-1]
    del seeds
    small = small[small != len(text) - 1]
    # within a symbol type L precedes type S
    both = np.concatenate((large, small))
    return both[_by_symbol(text[both])]


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in
    ``order``, counted up to ``depth``; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    if len(text) and text.min() >= 0 and text.max() < 255:  # eight symbols at once; what follows the end is smaller than all
        data = np.zeros(len(text) + depth + 8, np.uint8)
        data[: len(text)] = text + 1
        words = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        for step in range(0, depth, 8):
            differ = words[order[alive] + step] ^ words[order[alive - 1] + step]
            ends = differ != 0
            lowest = differ[ends] & (~differ[ends] + np.uint64(1))  # the lowest bit that differs
            out[alive[ends]] += (np.frexp(lowest.astype(np.float64))[1] - 1) // 8
            alive = alive[~ends]
            out[alive] += 8
            if not len(alive):
                break
        return np.minimum(out, depth, out=out)
    for step in range(depth):
        a, b = order[alive] + step, order[alive - 1] + step
        ok = np.maximum(a, b) < len(text)
        alive, a, b = alive[ok], a[ok], b[ok]
        alive = alive[text[a] == text[b]]
        out[alive] += 1
        if not len(alive):
            break
    return out
