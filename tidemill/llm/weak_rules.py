"""Quality rules under weak supervision.

Each rule reads the counts of a text and votes good (1), bad (-1) or abstains
(0). No rule decides alone. Expectation-maximisation estimates how each rule
votes on good and on bad texts, without labels: texts are counted by their
pattern of votes, so the fit sees a table of at most 3 ** rules rows, whatever
the corpus. The posterior probability of good replaces "all rules must pass".
Texts that fail the base checks are decided and have no part in the fit.

Null texts are empty and fail the base checks, like all texts under
``min_words`` words or with more than half of their words in repeated
three-word windows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import rolling as R
from tidemill.llm.common import besides, prepared, unused
from tidemill.llm.common import col as named

#: How much likelier a good vote may be on good texts than on bad ones.
GOOD_VOTE = 1.5
STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper", "n_bare_words", "n_symbol_words"]
_SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
_CHARACTER = (np.arange(256) & 0xC0) != 0x80
_UPPER = R.byte_set((0x41, 0x5A))
_LETTER = R.byte_set((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xFF))  # and whatever is not ASCII, by its first byte


def _per(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between neighbouring bounds."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeated(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which hashes occur before within the same text (the first is not counted), and which occur twice at all."""
    key = R.mixed(hashes ^ R.mixed(of.astype(R.U64) + R.U64(1)))
    order = np.argsort(key, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order[1:]] == key[order[:-1]]
    again, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order], twice[order] = same[:-1], same[:-1] | same[1:]
    return np.stack((again, twice))


def counts(texts: list[bytes]) -> pd.DataFrame:
    """The ``STATS`` of each text."""
    w = R.words_of(texts)
    n_words = np.diff(w.bounds)
    # a text's bytes end before the line feed that follows it
    ends = np.stack((w.text_at[:-1], w.text_at[1:] - 1), axis=1).ravel()
    per_text = lambda table: _per(table[w.data], ends)[::2]
    word_of = np.repeat(np.arange(len(texts)), n_words)
    characters = np.concatenate(([0], np.cumsum(_CHARACTER[w.data])))
    in_words = np.concatenate(([0], np.cumsum(characters[w.end] - characters[w.start])))
    bare = np.concatenate(([0], np.cumsum(R.ALPHANUMERIC[w.data])))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[w.data])))
    breaks = np.flatnonzero(w.data == 10)
    line_at = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
    filled = np.searchsorted(w.start, breaks) > np.searchsorted(w.start, line_at)
    a, b = line_at[filled], breaks[filled]
    line_of = np.searchsorted(w.text_at, a, side="right") - 1
    again = _repeated(w.prefix.stretch(a, b), line_of)[0] if len(a) else np.zeros(0, bool)
    triple = R.Prefix(w.hashes).windows(3)
    at = np.flatnonzero(np.arange(len(triple)) + 3 <= w.bounds[1:][word_of[: len(triple)]]) if len(triple) else np.zeros(0, np.int64)
    twice = at[_repeated(triple[at], word_of[at])[1]] if len(at) else at
    cover = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + 3, -1)
    count = lambda of: np.bincount(of, minlength=len(texts))
    return pd.DataFrame({
        "n_words": n_words,
        "word_chars": in_words[w.bounds[1:]] - in_words[w.bounds[:-1]],
        "n_symbols": per_text(_SYMBOL),
        "n_lines": count(line_of),
        "n_dup_lines": count(line_of[again]),
        "n_repeat_words": _per(np.cumsum(cover[:-1]) > 0, w.bounds),
        "n_letters": per_text(_LETTER),
        "n_upper": per_text(_UPPER),
        "n_bare_words": _per(bare[w.end] == bare[w.start], w.bounds),
        "n_symbol_words": _per(symbols[w.end] > symbols[w.start], w.bounds),
    })


def _counted(texts: pd.Series) -> pd.DataFrame:
    out = [counts([t or b"" for _, t in rows]) for rows in R.slabs(((0, t or b"") for t in texts))]
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=STATS)


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(s: Column) -> list[Column]:
    """The rules, over a struct of ``STATS``. Rules without evidence abstain."""
    part = lambda a, b: s[a] / F.greatest(s[b], F.lit(1))
    return [
        _vote(s.n_words < 20, s.n_words >= 50),
        _vote((part("word_chars", "n_words") < 2) | (part("word_chars", "n_words") > 15), part("word_chars", "n_words").between(3, 10)),
        _vote(part("n_symbols", "n_words") > 0.2, part("n_symbols", "n_words") < 0.05),
        _vote(part("n_dup_lines", "n_lines") > 0.5, s.n_dup_lines == 0),
        _vote(part("n_repeat_words", "n_words") > 0.4, part("n_repeat_words", "n_words") < 0.1),
        _vote((s.n_letters >= 20) & (part("n_upper", "n_letters") > 0.4), (s.n_letters >= 20) & (part("n_upper", "n_letters") < 0.2)),
        _vote(part("n_bare_words", "n_words") > 0.15, s.n_bare_words == 0),
        _vote(part("n_symbol_words", "n_words") > 0.1, part("n_symbol_words", "n_words") < 0.02),
        _vote((s.n_words > 0) & (part("n_letters", "word_chars") < 0.78), part("n_letters", "word_chars") > 0.92),
    ]


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100, prior: float = 0.8) -> tuple[float, np.ndarray]:
    """The share of good texts, and per rule and class (bad, good) the probability of a good vote if it votes.

    Every rule keeps its direction: good votes are never likelier on bad texts.
    """
    v = np.array([p for p, _ in patterns])
    n = np.array([c for _, c in patterns], float)
    good = np.where((v == -1).any(axis=1), 0.1, prior)
    chance = np.full((v.shape[1], 2), 0.5)
    share = prior
    for _ in range(rounds):
        for c, belongs in enumerate((1 - good, good)):
            yes, no = ((belongs * n) @ (v == x) for x in (1, -1))
            chance[:, c] = (yes + 1) / (yes + no + 2)
        chance[:, 0] = np.minimum(chance[:, 0], chance[:, 1])
        now = (good @ n + 1) / (n.sum() + 2)
        gain = gains(chance)
        odds = np.log(now / (1 - now)) + (v == -1) @ gain[:, 0] + (v == 1) @ gain[:, 1]
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if abs(now - share) < 1e-9:
            break
        share = now
    return now, chance


def gains(chance: np.ndarray) -> np.ndarray:
    """What a bad and a good vote of each rule add to the log odds of good.

    Bad texts of one kind get the good votes of the rules for other kinds, so a
    good vote counts as at most ``GOOD_VOTE`` times as likely on good texts.
    """
    bad = np.log((1 - chance[:, 1]) / (1 - chance[:, 0]))
    return np.stack((bad, np.minimum(np.log(chance[:, 1] / chance[:, 0]), np.log(GOOD_VOTE))), axis=1)


def judged(docs: DataFrame, min_words: int = 50, text_col: str = "text", result: str = "rules") -> DataFrame:
    """``docs`` with a struct column ``result``: the counts, ``base_failed``, ``votes``, ``p_good`` and ``kept``."""
    prepared(docs.sparkSession)
    (stats,) = unused(docs, "counts")
    kind = "struct<" + ",".join(f"{c}:long" for c in STATS) + ">"
    text = F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary")
    s = F.col(stats)
    counted = lambda df: df.withColumn(stats, F.pandas_udf(_counted, kind)(text))
    failed = (s.n_words < min_words) | (s.n_repeat_words * 100 > s.n_words * 50)
    pattern = counted(docs.select(named(text_col))).filter(~failed).select(F.array(*votes(s)).alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    seen = [(tuple(r.v), r.n) for r in pattern.collect()]  # 3 ** rules rows at most
    share, chance = estimate(sorted(seen)) if seen else (0.5, np.full((len(votes(s)), 2), 0.5))
    odds = F.lit(math.log(share / (1 - share)))
    for (bad, fine), vote in zip(gains(chance).tolist(), votes(s), strict=True):
        odds = odds + F.when(vote == -1, bad).when(vote == 1, fine).otherwise(0.0)
    good = 1 / (1 + F.exp(-odds))
    value = F.struct(*[s[c].alias(c) for c in STATS], failed.alias("base_failed"), F.array(*votes(s)).alias("votes"), good.alias("p_good"), (~failed & (good >= 0.5)).alias("kept"))
    return counted(docs).select(*besides(docs, result), value.alias(result))
