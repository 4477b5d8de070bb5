"""Order of the suffixes of a large integer string by induced sorting with queues on disk."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

# Bytes of queued positions that stay in memory before they move to a file.
IN_MEMORY = 64 << 20


class BucketQueue:
    """A priority queue of positions by first symbol that keeps the order of arrival within a symbol.

    Induction visits symbols in order and finds the positions of each bucket in the
    order of their suffixes, so arrival order is suffix order. Buckets that do not
    fit in memory lie in one file as chunks.
    """

    def __init__(self, folder: str) -> None:
        self._chunks: dict[int, list[np.ndarray | tuple[int, int]]] = {}
        self._file = tempfile.TemporaryFile(dir=folder)
        self._bytes = 0

    def push(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        if not len(symbols):
            return
        order = np.argsort(symbols, kind="stable")
        symbols, positions = symbols[order], positions[order]
        starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(symbols)]):
            self._chunks.setdefault(int(symbols[start]), []).append(positions[start:end])
        self._bytes += positions.nbytes
        if self._bytes > IN_MEMORY:
            self._spill()

    def _spill(self) -> None:
        self._file.seek(0, os.SEEK_END)
        for chunks in self._chunks.values():
            for i, chunk in enumerate(chunks):
                if isinstance(chunk, np.ndarray):
                    chunks[i] = (self._file.tell(), len(chunk))
                    self._file.write(chunk.tobytes())
        self._bytes = 0

    def pop(self, symbol: int) -> list[np.ndarray]:
        found = []
        for chunk in self._chunks.pop(symbol, ()):
            if not isinstance(chunk, np.ndarray):
                self._file.seek(chunk[0])
                chunk = np.frombuffer(self._file.read(8 * chunk[1]), np.int64)
            else:
                self._bytes -= chunk.nbytes
            found.append(chunk)
        return found


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (type S); the last symbol must be the only 0 and is S."""
    steps = np.sign(np.diff(text))
    at = np.where(steps != 0, np.arange(len(steps)), len(steps))
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return np.append(steps[np.minimum(nearest, len(steps) - 1)] > 0, True)


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: np.ndarray, folder: str) -> Iterator[tuple[bool, np.ndarray]]:
    """From seeds (starts of S runs, in order) all suffixes: chunks of L positions upwards, then of S positions downwards."""
    queue = BucketQueue(folder)
    seed_bounds = np.searchsorted(text[seeds], symbols, side="left"), np.searchsorted(text[seeds], symbols, side="right")
    larger: list[list[np.ndarray]] = []

    def before(positions: np.ndarray, wanted_small: bool) -> np.ndarray:
        previous = positions[positions > 0] - 1
        return previous[small[previous] == wanted_small]

    for i, symbol in enumerate(symbols.tolist()):
        own: list[np.ndarray] = []
        waves = queue.pop(symbol)
        while waves:
            wave = np.concatenate(waves)
            own.append(wave)
            previous = before(wave, False)
            first = text[previous]
            same = first == symbol
            # Within the bucket the predecessors follow in the same order; the others wait for their symbol.
            waves = [previous[same]] if same.any() else []
            queue.push(first[~same], previous[~same])
        previous = before(seeds[seed_bounds[0][i] : seed_bounds[1][i]], False)
        queue.push(text[previous], previous)
        larger.append(own)
        for chunk in own:
            yield False, chunk
    queue = BucketQueue(folder)
    for i in range(len(symbols) - 1, -1, -1):
        symbol = int(symbols[i])
        waves = queue.pop(symbol)
        while waves:
            wave = np.concatenate(waves)
            yield True, wave
            previous = before(wave, True)
            first = text[previous]
            same = first == symbol
            waves = [previous[same]] if same.any() else []
            queue.push(first[~same], previous[~same])
        for chunk in reversed(larger[i]):
            previous = before(chunk[::-1], True)
            queue.push(text[previous], previous)


def _ordered(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: np.ndarray, folder: str) -> np.ndarray:
    """All positions in the order of their suffixes, as far as the order of the seeds decides it."""
    upward: list[np.ndarray] = []
    downward: list[np.ndarray] = []
    for is_small, chunk in _induce(text, small, seeds, symbols, folder):
        (downward if is_small else upward).append(chunk)
    end = np.array([len(text) - 1])
    rising = np.concatenate([*upward, np.zeros(0, np.int64)])
    falling = np.concatenate([*downward, np.zeros(0, np.int64)])[::-1]
    # L suffixes of a symbol come before the S suffixes of it.
    both = np.concatenate([rising, falling])
    rank = np.concatenate([text[rising] * 2, text[falling] * 2 + 1])
    return np.concatenate([end, both[np.argsort(rank, kind="stable")]])


def _names(text: np.ndarray, starts: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the substrings from each start to the next one, equal where they are; in the order of ``starts``."""
    place = np.searchsorted(starts, ordered)
    lengths = np.append(np.diff(starts), 1)[place] + 1
    lengths[place == len(starts) - 1] = 1
    differ = np.append(True, lengths[1:] != lengths[:-1])
    open_pairs = np.flatnonzero(~differ)
    depth = 0
    while len(open_pairs):
        open_pairs = open_pairs[lengths[open_pairs] > depth]
        unequal = text[ordered[open_pairs] + depth] != text[ordered[open_pairs - 1] + depth]
        differ[open_pairs[unequal]] = True
        open_pairs = open_pairs[~unequal]
        depth += 1
    names = np.empty(len(starts), np.int64)
    names[place] = np.cumsum(differ)
    return names, int(differ.sum())


def _order_in_memory(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a reduced string, by doubling."""
    rank = np.unique(text, return_inverse=True)[1]
    step = 1
    while True:
        after = np.zeros(len(text), np.int64)
        after[: len(text) - step] = rank[step:] + 1
        key = rank * (len(text) + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
        rank = np.empty(len(text), np.int64)
        rank[order] = new
        if new[-1] == len(text) - 1:
            return order
        step *= 2


def suffix_order(text: np.ndarray, folder: str | None = None, base: int = 4_000_000) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes.

    ``text`` holds numbers of at least 0 and ends with its only 0. Starts of rising
    runs are sorted by a first induction, named by the substrings between them, and
    ordered by recursion on the string of names (in memory once that has at most
    ``base`` symbols); a second induction orders all others. Queues of positions lie
    in ``folder`` beyond a bound.
    """
    with tempfile.TemporaryDirectory(dir=folder) as scratch:
        small = _smaller_than_next(text)
        starts = np.flatnonzero(small[1:] & ~small[:-1]) + 1
        symbols = np.unique(text)
        if not len(starts):
            return np.arange(len(text) - 1, -1, -1)
        seeds = starts[np.argsort(text[starts], kind="stable")]
        draft = _ordered(text, small, seeds, symbols, scratch)
        is_start = np.zeros(len(text), bool)
        is_start[starts] = True
        names, distinct = _names(text, starts, draft[is_start[draft]])
        if distinct < len(names):
            if len(names) <= base:
                ranked = _order_in_memory(names)
            else:
                ranked = suffix_order(np.append(names, 0), folder, base)[1:]
        else:
            ranked = np.argsort(names)
        return _ordered(text, small, starts[ranked], symbols, scratch)


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int, among: np.ndarray | None = None) -> np.ndarray:
    """Length of the common prefix of each suffix in order with the one before it, up to ``most``.

    With ``among``, a mask of positions, only where both suffixes begin at such a position; 0 elsewhere.
    """
    length = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order)) if among is None else np.flatnonzero(among[order[1:]] & among[order[:-1]]) + 1
    for depth in range(most):
        ahead = np.maximum(order[live], order[live - 1]) + depth < len(text)
        live = live[ahead]
        live = live[text[order[live] + depth] == text[order[live - 1] + depth]]
        if not len(live):
            break
        length[live] = depth + 1
    return length
