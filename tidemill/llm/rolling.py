"""Hashes of words and of sliding windows, for many texts at once.

Texts are laid end to end in one array and worked on without a Python loop
per word. The hash of a stretch is a difference of prefix sums, scaled back
to its start, so any window of any length costs one subtraction. Sums modulo 2**64
cancel on strings that are built by doubling, from a thousand letters on, so words
that are long enough for that are hashed from their bytes one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=U64)
#: Longer words (in bytes) are hashed one by one.
LONG_WORD = 64
#: Texts are handled in slabs of about so many bytes; a longer text is a slab of its own.
SLAB_BYTES = 1 << 20


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes in the given ranges (ends included)."""
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Everything but space and \t \n \v \f \r.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Letters, digits and whatever is not ASCII.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_powers = (np.ones(1, U64), np.ones(1, U64))


def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to ``n``."""
    global _powers
    if len(_powers[0]) <= n:
        size = max(n + 1, SLAB_BYTES + 4096)
        up, down = np.full(size, _BASE, U64), np.full(size, _BASE_INVERSE, U64)
        up[0] = down[0] = 1
        _powers = (np.cumprod(up), np.cumprod(down))
    return _powers


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over all output bits."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x7FB5D329728EA185)
    h ^= h >> U64(27)
    h *= U64(0x81DADEF4BC2DD44D)
    h ^= h >> U64(33)
    return h


class Prefix:
    """Prefix sums over a sequence of values; gives the hash of any stretch."""

    def __init__(self, values: np.ndarray):
        up, self._down = _scales(len(values))
        self.sums = np.empty(len(values) + 1, U64)
        self.sums[0] = 0
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self._down[start])

    def windows(self, size: int) -> np.ndarray:
        """The hash of every window of ``size`` values."""
        n = max(0, len(self.sums) - size)
        return mixed((self.sums[size : size + n] - self.sums[:n]) * self._down[:n])


def sliding(a: np.ndarray, size: int, pick=np.minimum) -> np.ndarray:
    """The least (or greatest) of every window of ``size`` neighbours."""
    n = len(a) - size + 1
    if n <= 0:
        return a[:0]
    have = 1
    while have * 2 <= size:
        a = pick(a[: len(a) - have], a[have:])
        have *= 2
    return pick(a[:n], a[size - have : size - have + n])


def slabs(rows: Iterable[tuple], text_at: int = 1) -> Iterator[list[tuple]]:
    """Rows in lists whose texts add up to about ``SLAB_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[text_at])
        if size >= SLAB_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Slab:
    """Texts end to end. ``bounds`` has the first unit of each text, and the end."""

    data: np.ndarray
    bounds: np.ndarray


@dataclass
class Words(Slab):
    """The words of a slab: byte ranges and hashes; ``bounds`` counts words.

    A text begins at its byte in ``text_at`` and is followed by a line feed.
    """

    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    text_at: np.ndarray
    prefix: Prefix


def bytes_of(texts: list[bytes]) -> Slab:
    data = np.frombuffer(b"".join(texts), np.uint8)
    return Slab(data, np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64))))


def words_of(texts: list[bytes], word_bytes: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """Words are maximal runs of ``word_bytes``; ``lower`` folds A-Z first."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 1, np.int8)
    inside[1:] = word_bytes[data]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if len(start) > len(end):
        end = np.append(end, len(data))
    text_starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))
    prefix = Prefix(_BYTE_VALUES[data])
    hashes = prefix.stretch(start, end)
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        hashes[i] = int.from_bytes(blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return Words(data, np.searchsorted(start, text_starts), start, end, hashes, text_starts, prefix)


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


@dataclass
class Runs:
    """Maximal runs of neighbouring windows with the same least k-gram.

    ``text`` is the text's place in the slab; ``first`` and ``last`` are the
    run's first window and the one after its last, as units of the slab.
    ``again`` tells that the k-gram may occur twice within the run.
    """

    text: np.ndarray
    key: np.ndarray
    first: np.ndarray
    last: np.ndarray
    content: np.ndarray
    again: np.ndarray


def window_runs(prefix: Prefix, bounds: np.ndarray, window: int, gram: int, repeats: bool = False) -> Runs:
    """Cut the windows of every text into runs that share their least k-gram.

    The least k-gram depends on a window's content alone. Equal windows
    therefore have equal keys, wherever they stand.
    """
    h = prefix.windows(gram)
    span = window - gram + 1
    least = sliding(h, span)
    lengths = np.diff(bounds)
    long = np.flatnonzero(lengths >= window)
    lo, hi = bounds[long], bounds[long + 1] - window + 1
    if not len(long):
        none = np.zeros(0, np.int64)
        return Runs(none, none.astype(U64), none, none, none.astype(U64), none.astype(bool))
    edge = np.zeros(len(least) + 1, np.int8)
    edge[lo] = 1
    inside = np.zeros(len(least) + 1, np.int32)
    np.add.at(inside, lo, 1)
    np.add.at(inside, hi, -1)
    inside = np.cumsum(inside[:-1]) > 0
    turn = edge[:-1].astype(bool)
    turn[1:] |= least[1:] != least[:-1]
    first = np.flatnonzero(turn & inside)
    of = np.searchsorted(lo, first, side="right") - 1
    last = np.minimum(np.append(first[1:], len(least)), hi[of])
    key = least[first]
    content = prefix.stretch(first, last + window - 1)
    again = np.zeros(len(first), bool)
    if repeats:
        worst = np.zeros(len(least) + 2 * (span - 1), U64)
        worst[span - 1 : span - 1 + len(least)] = least
        at = np.flatnonzero(h == sliding(worst, span, np.maximum)[: len(h)])
        same = np.zeros(len(at) + 1, np.int64)
        same[2:] = np.cumsum(h[at[1:]] == h[at[:-1]])
        a, b = np.searchsorted(at, first), np.searchsorted(at, last - 1 + span)
        again = (b > a) & (same[np.maximum(b, 1)] - same[np.minimum(a + 1, len(at))] > 0)
    return Runs(long[of], key, first, last, content, again)
