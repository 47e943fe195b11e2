"""Periodic runs of words: squares from a suffix automaton with link-cut access.

A run is a stretch of words with a smallest period q (words q apart are equal), at
least ``least`` words and two periods long, that no neighbouring word extends.

1. Every word of a run stands in a window of ``least // 2`` words that occurs again
   in the same run. So words are left out that stand in no repeated window; what is
   left are stretches, in which this is asked again. No run is lost: it lies within
   one stretch. Most texts have no stretch at all.
2. A stretch is read word by word into a suffix automaton. The strings that end at
   the last word are the path from the newest state to the root along suffix links.
   The strings of a state know where they last ended; states that agree, one after
   another on a path, are one segment, kept as a splay tree (a link-cut tree whose
   preferred paths are these segments). Reading a word recolours the path with its
   own place: segments on it are cut below the path, and joined.
3. A segment that is recoloured tells the longest string that ended at an earlier
   place e and ends now at i. Is it at least i - e long, its two occurrences touch or
   overlap: a square of period i - e. This is the smallest period, and the string's
   length tells how far to the left the period reaches. While the square goes on
   from word to word, the run grows; all squares of a run have one period, and two
   runs of one period never overlap by a period.

Words are compared by their bytes, never by a hash. A text that is null or empty has
no words and no runs. Repeated rows are treated alike. A worker holds one text, and
one stretch's automaton: about a kilobyte for each of its words.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import rolling as R
from tidemill.llm.common import besides, prepared
from tidemill.llm.common import col as named

RESULT = "struct<n_words:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:binary>"
#: How often stretches are narrowed; more would only save time.
NARROWINGS = 3
NONE = -1


def stretches(numbers: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Where runs may be: stretches of words in which each stands in a window that the stretch repeats."""
    if len(numbers) < 2 * window:
        return []
    value = R.mixed(numbers.astype(R.U64) + R.U64(1))
    hashed = R.Prefix(value).windows(window)  # equal windows have equal hashes; a collision costs time, nothing else
    at, group = np.arange(len(hashed)), np.zeros(len(hashed), np.int64)
    for _ in range(NARROWINGS):
        key = hashed[at] + R.mixed(group.astype(R.U64) + R.U64(1))
        rising = np.sort(key)
        twice = np.unique(rising[1:][rising[1:] == rising[:-1]])
        if not len(twice):
            return []
        again = twice[np.minimum(np.searchsorted(twice, key), len(twice) - 1)] == key
        at = at[again]
        group = np.concatenate(([0], np.cumsum(np.diff(at) > window)))
        if again.all():
            break
    first = np.flatnonzero(np.diff(group, prepend=-1))
    last = np.append(first[1:], len(at)) - 1
    found = zip(at[first].tolist(), (at[last] + window).tolist(), strict=True)
    return [(a, b) for a, b in found if b - a >= 2 * window]


class Automaton:
    """A suffix automaton whose suffix links are a link-cut tree; ``segments`` are its preferred paths.

    ``ended`` is kept at the top of each splay tree: where the strings of its
    segment last ended. In a splay tree, states stand in the order of their length.
    """

    def __init__(self):
        self.size, self.link, self.moves = [0], [NONE], [{}]
        self.left, self.right, self.up, self.ended = [NONE], [NONE], [NONE], [NONE]
        self.newest, self.at = 0, 0

    def _state(self, size: int, moves: dict) -> int:
        self.size.append(size)
        self.moves.append(moves)
        for column in (self.link, self.left, self.right, self.up, self.ended):
            column.append(NONE)
        return len(self.size) - 1

    def _to_top(self, x: int) -> None:
        """Make ``x`` the top of its splay tree."""
        left, right, up = self.left, self.right, self.up
        y = up[x]
        while y != NONE and (left[y] == x or right[y] == x):
            z = up[y]
            if z != NONE and (left[z] == y or right[z] == y):
                self._over(y if (left[z] == y) == (left[y] == x) else x)
            self._over(x)
            y = up[x]

    def _over(self, x: int) -> None:
        """Rotate ``x`` over its parent."""
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner != NONE:
            up[inner] = y
        if z != NONE and left[z] == y:
            left[z] = x
        elif z != NONE and right[z] == y:
            right[z] = x
        else:
            self.ended[x] = self.ended[y]
        up[y], up[x] = x, z

    def read(self, word: int) -> list[tuple[int, int]]:
        """Append a word; the period and the start of every square's repetition that ends with it."""
        size, link, moves = self.size, self.link, self.moves
        new = self._state(size[self.newest] + 1, {})
        p = self.newest
        while p != NONE and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        if p == NONE:
            link[new] = 0
        else:
            q = moves[p][word]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                link[new] = self._split(p, q, word)
        self.up[new] = link[new]
        self.newest = new
        return self._recolour(new)

    def _split(self, p: int, q: int, word: int) -> int:
        """The shorter strings of ``q`` become a state of their own, just before it in its segment."""
        size, link, moves, left, up = self.size, self.link, self.moves, self.left, self.up
        part = self._state(size[p] + 1, moves[q].copy())
        link[part], link[q] = link[q], part
        while p != NONE and moves[p].get(word) == q:
            moves[p][word] = part
            p = link[p]
        self._to_top(q)
        left[part] = left[q]
        if left[q] != NONE:
            up[left[q]] = part
        left[q], up[part] = part, q
        return part

    def _recolour(self, new: int) -> list[tuple[int, int]]:
        now, self.at = self.at, self.at + 1
        size, right, up, ended = self.size, self.right, self.up, self.ended
        squares = []
        below, state = new, up[new]
        while state != NONE:
            self._to_top(state)
            before, longest = ended[state], size[state]
            period = now - before
            if period <= longest:
                squares.append((period, now - longest - period + 1))
            if right[state] != NONE:
                ended[right[state]] = before  # strings longer than those on the path keep their place
            right[state] = below
            below, state = state, up[state]
        ended[below] = now
        return squares


def runs_of(numbers: list[int], least: int = 12) -> list[tuple[int, int, int]]:
    """Start, length and period of all runs of a sequence, by start and period."""
    automaton, growing, found = Automaton(), {}, []
    for i, number in enumerate(numbers):
        for period, start in automaton.read(number):
            run = growing.get(period)
            if run is not None and run[1] == i - 1:
                run[1] = i
                continue
            if run is not None:
                found.append((run[0], run[1] - run[0] + 1, period))
            growing[period] = [start, i]
    found += [(a, b - a + 1, period) for period, (a, b) in growing.items()]
    return sorted((a, n, p) for a, n, p in found if n >= max(least, 2 * p))


def runs_in(words: list[bytes], least: int = 12) -> list[tuple[int, int, int]]:
    """The runs of a text's words."""
    if len(words) < least:
        return []
    seen: dict[bytes, int] = {}
    numbers = np.fromiter(map(seen.setdefault, words, count()), np.int64, len(words))
    if len(seen) == len(words):
        return []
    found = []
    for a, b in stretches(numbers, least // 2):
        found += [(a + start, length, period) for start, length, period in runs_of(numbers[a:b].tolist(), least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


def find_runs(docs: DataFrame, least: int = 12, text_col: str = "text", result: str = "periods") -> DataFrame:
    """``docs`` with a struct column ``result``: number of words, runs, and the text with each run collapsed to one period."""
    prepared(docs.sparkSession)

    @F.pandas_udf(RESULT)
    def found(texts: pd.Series) -> pd.DataFrame:
        out = []
        for raw in texts:
            words = (raw or b"").split()  # bytes are split at space and \t \n \v \f \r
            runs = runs_in(words, least)
            out.append((len(words), [{"start": a, "length": n, "period": p} for a, n, p in runs], collapsed(words, runs)))
        return pd.DataFrame(out, columns=["n_words", "runs", "collapsed"])

    found = found.asNondeterministic()  # it isn't; but so Spark runs it once, however often its fields are read
    return docs.select(*besides(docs, result), found(named(text_col).cast("string").cast("binary")).alias(result))

