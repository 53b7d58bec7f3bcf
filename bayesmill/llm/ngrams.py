"""Sets of word n-grams as 64-bit hashes, and their exact comparison in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

REMEMBERED_WORDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: str | bytes | None, hashes: WordHashes, n: int) -> np.ndarray:
    """The distinct n-gram hashes of a text, sorted; a shorter text is one n-gram, a wordless one has none.

    ``bytes.split`` parts at ASCII white space and ``bytes.lower`` maps A-Z alone, as the contract has it.
    """
    words = [] if text is None else (text.encode() if isinstance(text, str) else text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(n, len(w))
    x = np.full(len(w) - k + 1, k, np.uint64)
    for j in range(k):
        x = mix(x + w[j:len(w) - k + 1 + j])
    return np.unique(x)


def parts(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Batches in parts, which bounds what a task holds of its n-grams."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows of each key, for batches sorted by it; a run must fit a task."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for s, e in zip(cuts, cuts[1:], strict=False):
            if held and keys[s] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(s, e - s))
            last = keys[s]
    if held:
        yield pa.Table.from_batches(held)


def linked(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``sets``: across the two sides, or among all if there is one side.

    The sparse product, row by row: a row's n-grams add up their posting lists, which gives its overlap with every
    other row of the block.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(column, kind="stable")
    posting, starts = row[order], np.concatenate(([0], np.cumsum(np.bincount(column))))
    offsets, across, root = np.concatenate(([0], np.cumsum(sizes))), bool(side.any()), list(range(len(sets)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    forest = []
    for i in range(len(sets)):
        if across and side[i]:
            continue
        cols = column[offsets[i]:offsets[i + 1]]
        counts = starts[cols + 1] - starts[cols]
        at = np.repeat(starts[cols] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        overlap = np.bincount(posting[at], minlength=len(sets))
        enough = (100 + percent) * overlap >= percent * (sizes[i] + sizes)  # the bound that the sizes give
        enough &= overlap > 0
        enough[:i + 1] &= across
        if across:
            enough &= side > 0
        for j in np.flatnonzero(enough).tolist():
            a, b = top(i), top(j)
            if a != b:
                root[b] = a
                forest.append((i, j))
    return forest
