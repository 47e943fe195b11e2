"""Plain versions of the operators, one text after another, to compare with."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def covered(n: int, starts: list[int], size: int) -> list[bool]:
    out, upto = [False] * n, 0
    for s in sorted(starts):
        for i in range(max(s, upto), s + size):
            out[i] = True
        upto = max(upto, s + size)
    return out


def phrase_dedup(rows, window=50):
    """``rows`` are (id, text); ids are numbers."""
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    owner = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            owner[k] = min(d, owner.get(k, d))
    out = []
    for d, w in words:
        gone = covered(len(w), [i for i in range(len(w) - window + 1) if owner[tuple(w[i : i + window])] < d], window)
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def suffix_cut(texts: list[bytes], size=400):
    """For each text, which bytes go."""
    seen = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    return [covered(len(t), [i for i in range(len(t) - size + 1) if seen[t[i : i + size]] > 1], size) for t in texts]


def long_repeats(text: bytes, gone: list[bool], min_words=50, min_bytes=400):
    """``gone`` without the runs that have too few words and bytes."""
    out, i = [False] * len(text), 0
    while i < len(text):
        j = i
        while j < len(text) and gone[j]:
            j += 1
        if j - i >= min_bytes or len(text[i:j].split()) >= min_words:
            out[i:j] = [True] * (j - i)
        i = max(j, i + 1)
    return out


def suffix_dedup(rows, size=400):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (d, _), t, gone in zip(rows, texts, suffix_cut(texts, size), strict=True):
        spans = sum(g and not before for g, before in zip(gone, [False, *gone], strict=False))
        out.append((d, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone, strict=True) if not g))))
    return out


def shingles(text, size):
    w = WORD.findall((text or "").translate(LOWER))
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def near_duplicates(rows, size=4, percent=80):
    """(id, set size, component) of every row; ids are distinct."""
    sets = {d: shingles(t, size) for d, t in rows}
    top = {d: d for d in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    places = defaultdict(list)
    for d, s in sorted(sets.items()):
        common = Counter()
        for x in s:
            common.update(places[x])
            places[x].append(d)
        for e, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = root(d), root(e)
                top[max(a, b)] = min(a, b)
    return [(d, len(sets[d]), root(d)) for d, _ in rows]


def contamination(rows, benchmark, window=13):
    """(id, words, hit, items) of every row."""
    wins = defaultdict(set)
    for item, t in benchmark:
        w = ALPHANUMERIC.findall((t or "").translate(LOWER))
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            wins[tuple(w[i : i + n])].add(str(item))
    sizes = {len(k) for k in wins}
    out = []
    for d, t in rows:
        w = ALPHANUMERIC.findall((t or "").translate(LOWER))
        hit, items = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wins:
                    items |= wins[tuple(w[i : i + n])]
                    hit[i : i + n] = [True] * n
        out.append((d, len(w), sum(hit), sorted(items)))
    return out


def rule_counts(text):
    """words, characters in words, symbols, repeated lines, words in repeated three-word windows."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    gone = covered(len(w), [i for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1], 3)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(gone)


def shares(sizes: dict, weights=(3, 1, 2), share=1.5, most=2):
    """Targets per source, by repeated sharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, fixed = {s: 0.0 for s in order}, set(s for s in order if not sizes[s])
    while len(fixed) < len(order):
        left = share * sum(sizes.values()) - sum(target[s] for s in fixed)
        free = [s for s in order if s not in fixed]
        for s in free:
            target[s] = left * weight[s] / sum(weight[x] for x in free)
        over = [s for s in free if target[s] > most * sizes[s]]
        if not over:
            break
        for s in over:
            target[s] = most * sizes[s]
            fixed.add(s)
    return target


def looped(words, doc):
    """The words of every tenth document, repeated with a period from some place on."""
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words, least=12):
    """(start, length, period) of every run: each period tried, the smallest kept."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if j > i and length >= max(least, 2 * q) and not any(part[d:] == part[: length - d] for d in range(1, q)):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def periods(rows):
    """(id, runs, longest run's start, length, period, exponent, digests) of every row."""
    out = []
    for d, t in rows:
        words = looped(WORD.findall(t or ""), d)
        found = runs(words)
        gone = {i for a, n, q in found for i in range(a + q, a + n)}
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        milli = 1000 * top[1] // top[2] if found else None
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(found), *top, milli, sha("".join(f"{a},{n},{q}\n" for a, n, q in found)), sha(kept)))
    return out


def audit(rows, labels):
    """One tuple per part, order and step; ``rows`` are (id, text, part), ``labels`` id to (good, toxic)."""
    least = {}
    far = 1 << 63
    for d, t, _ in rows:
        least[t or ""] = min(least.get(t or "", far), far if d is None else d)
    parts = defaultdict(list)
    for d, t, part in rows:
        t = t or ""
        w = WORD.findall(t)
        copy = (far if d is None else d) > least[t]
        fails = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)), copy)
        parts[part or ""].append(({"ABCDE"[i] for i, f in enumerate(fails) if f}, *labels.get(d, (False, False))))
    out = []
    for part, docs in parts.items():
        steps, total = [], Counter()
        for order in permutations("ABCDE"):
            left = docs
            for i, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failing = sum(f in x[0] for x in docs)
                total[f] += len(gone)
                alone = sum(x[0] == {f} for x in docs)
                steps.append((part, "".join(order), i + 1, f, len(left), len(gone), failing - len(gone), alone, sum(x[1] for x in gone), sum(x[2] for x in gone)))
        out += [(*s, total[s[3]]) for s in steps]
    return out
