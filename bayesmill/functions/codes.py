"""Byte-dump codes and their n-grams, vectorised over the batches of a task.

A code is a whitespace token of exactly two characters; it is held as one
integer. N-grams are counted for many files at once: positions of a file become
integer keys (its codes as digits of an alphabet), equal keys are counted by
sorting, and only distinct grams are written out as strings.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HALF = 21                # bits of a character
MOST_CODES = 12          # of a gram; its key must fit 64 bits
KEY_BITS = 62


def codes(text: str) -> np.ndarray:
    """The codes of a text in order, whitespace being space and the control characters 9 to 13."""
    ascii_only = text.isascii()
    raw = np.frombuffer(text.encode("ascii"), np.uint8) if ascii_only else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.ones(len(raw) + 4, bool)
    blank[1:len(raw) + 1] = (raw == 32) | ((raw >= 9) & (raw <= 13))
    at = np.flatnonzero(blank[:-3] & ~blank[1:-2] & ~blank[2:-1] & blank[3:])
    return raw[at].astype(np.int64) << HALF | raw[at + 1].astype(np.int64)


def written(code: np.ndarray) -> list[str]:
    return [chr(c >> HALF) + chr(c & (1 << HALF) - 1) for c in code.tolist()]


def joined(code: np.ndarray) -> str:
    pairs = np.stack([code >> HALF, code & (1 << HALF) - 1], axis=1)
    return pairs.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def parted(text: str) -> np.ndarray:
    """The codes of ``joined`` text."""
    ascii_only = text.isascii()
    raw = np.frombuffer(text.encode("ascii"), np.uint8) if ascii_only else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return raw[::2].astype(np.int64) << HALF | raw[1::2].astype(np.int64)


def _alphabet(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes, rising, and each code's place among them."""
    low = (1 << HALF) - 1
    if len(flat) and int((flat >> HALF).max()) < 128 and int((flat & low).max()) < 128:
        small = (flat >> HALF << 7) | (flat & low)
        held = np.flatnonzero(np.bincount(small, minlength=1 << 14))
        place = np.zeros(1 << 14, np.int64)
        place[held] = np.arange(len(held))
        return held >> 7 << HALF | held & 127, place[small]
    letters, place = np.unique(flat, return_inverse=True)
    return letters, place.astype(np.int64)


class Grams:
    """Counts of the n-grams of one size in a chunk: ``owner``, ``key`` and ``n`` of each distinct pair, by owner."""

    def __init__(self, letters: np.ndarray, size: int, owner: np.ndarray, key: np.ndarray, n: np.ndarray):
        self.letters, self.size, self.owner, self.key, self.n = letters, size, owner, key, n

    def names(self, key: np.ndarray, sep: str = "") -> pa.Array:
        names, digits = pa.array(written(self.letters), pa.string()), []
        for _ in range(self.size):
            key, digit = np.divmod(key, max(1, len(self.letters)))
            digits.append(names.take(pa.array(digit)))
        return digits[0] if self.size == 1 else pc.binary_join_element_wise(*reversed(digits), sep)


def count_grams(parts: Sequence[np.ndarray], size: int, owners: Sequence[int] | None = None) -> Iterator[Grams]:
    """N-grams of each part (codes of one owner, by default its place), in one chunk or several."""
    if not 1 <= size <= MOST_CODES:
        raise ValueError(f"grams of 1 to {MOST_CODES} codes")
    owners = list(range(len(parts))) if owners is None else list(owners)
    flat = np.concatenate([*parts, np.empty(0, np.int64)])
    letters, place = _alphabet(flat)
    lengths = np.array([len(p) for p in parts], np.int64)
    if len(parts) and max(1, len(letters)) ** size * len(parts) >= 1 << KEY_BITS:
        if len(parts) > 1:
            half = len(parts) // 2
            yield from count_grams(parts[:half], size, owners[:half])
            yield from count_grams(parts[half:], size, owners[half:])
        else:
            half = len(flat) // 2
            yield from count_grams([flat[:half + size - 1]], size, owners)
            yield from count_grams([flat[half:]], size, owners)
        return
    last = len(flat) - size + 1
    if last < 1:
        return
    key = place[:last].copy()
    for k in range(1, size):
        key = key * len(letters) + place[k:last + k]
    part = np.repeat(np.arange(len(parts)), lengths)
    whole = part[:last] == part[size - 1:]
    span = len(letters) ** size
    pair = part[:last][whole] * span + key[whole]
    if span * len(parts) <= 4 * len(pair):  # as many counters cost less than a sort
        n = np.bincount(pair)
        found = np.flatnonzero(n)
        n = n[found]
    else:
        found, n = np.unique(pair, return_counts=True)
    part, key = np.divmod(found, span)
    yield Grams(letters, size, np.array(owners, np.int64)[part], key, n)
