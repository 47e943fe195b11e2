"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding.

A text is split by a pattern; each match is encoded by itself. Merging the
neighbours of lowest rank first, the leftmost of equals, gives a sequence of
tokens in which every two neighbours would also be the encoding of their own
bytes; and a sequence with this property is the encoding. So a transducer can
read bytes from left to right:

* Nondeterministic, it is at a node of the vocabulary's trie, and knows the token
  before. At a node that is a token which may follow that token, it may emit it
  and start from the root again. Of all ways to read a string, one ends at the root.
* Determinised, its state holds all live ways at once, with what they would emit.
  What all of them would emit is emitted; the rest waits. A way lives no longer
  than the longest token, which bounds the lookahead. States and moves are made
  when they are first needed, and whether a token may follow another is found by
  replaying the merges of both, side by side.

A match that is itself a token is that token, even if no merges lead to it.

Decoding runs a state machine for UTF-8 over the tokens as they come: characters
are handed out when complete, and what is ill-formed becomes U+FFFD, one for each
maximal part. Its moves, too, are made when they are first needed, one for a
state and a token.

Null texts are empty and give no tokens; null ids decode to nothing; an id that is
not in the vocabulary decodes to the bytes of U+FFFD. Texts that are not UTF-8 are
read with U+FFFD in place of what is ill-formed. No text is cut; a worker holds
one text and its tokens, and its tables are emptied when they grow past their bounds.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from contextlib import contextmanager
from itertools import islice

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import besides, prepared
from tidemill.llm.common import col as named

#: Moves (of the transducer, and of the decoder) and encoded matches that a worker keeps. A match met again after it
#: was dropped takes 5 to 14 microseconds, one that is kept 0.2, so there is more room for matches.
MOST_MOVES = 400_000
MOST_PIECES = 800_000
#: Longer matches are not kept, only encoded.
LONGEST_PIECE = 64
#: Longer texts are split into matches block by block.
LONG_TEXT = 1 << 20
NEVER = 1 << 62
WAYS = -1
REPLACEMENT = b"\xef\xbf\xbd"
DECODED = "struct<bytes:binary,text:string>"

# Well-formed UTF-8 (the Unicode Standard, table 3-7): first bytes, the range of the
# second byte, how many more follow it. Fixed values.
WELL_FORMED = (
    (0xC2, 0xDF, 0x80, 0xBF, 0),
    (0xE0, 0xE0, 0xA0, 0xBF, 1),
    (0xE1, 0xEC, 0x80, 0xBF, 1),
    (0xED, 0xED, 0x80, 0x9F, 1),
    (0xEE, 0xEF, 0x80, 0xBF, 1),
    (0xF0, 0xF0, 0x90, 0xBF, 2),
    (0xF1, 0xF3, 0x80, 0xBF, 2),
    (0xF4, 0xF4, 0x80, 0x8F, 2),
)


def ranks_of(data: bytes) -> dict[bytes, int]:
    """The ranks of a rank file: one token in base 64 and its rank in each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


class Merges:
    """The ranks, and what merging does within a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._replayed: dict[int, tuple | None] = {}
        self.known: dict[int, bool] = {}  # by the token before << 32 | the token

    def replay(self, token: int) -> tuple | None:
        """The ranks merged on the way to ``token``, and its first and last part before each of them.

        Null if merging its bytes does not end in the token.
        """
        if token not in self._replayed:
            parts = [bytes([b]) for b in self.tokens[token]]
            merged, firsts, lasts = [], [parts[0]], [parts[-1]]
            while len(parts) > 1:
                rank, at = min((self.ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
                if rank == NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                merged.append(rank)
                firsts.append(parts[0])
                lasts.append(parts[-1])
            self._replayed[token] = ([*merged, NEVER], firsts, lasts) if len(parts) == 1 else None
        return self._replayed[token]

    def may_follow(self, before: int, token: int) -> bool:
        """Whether ``token`` can stand after ``before`` (-1: at the start of a match).

        Both are merged side by side, the lowest rank first. They can't be
        neighbours if a merge across their border would come before all others.
        """
        pair = before << 32 | token
        may = self.known.get(pair)
        if may is None:
            if len(self.known) >= MOST_MOVES:
                self.known.clear()
            right = self.replay(token)
            may = self.known[pair] = right is not None and (before < 0 or self._apart(self.replay(before), right))
        return may

    def _apart(self, left: tuple, right: tuple) -> bool:
        i = j = 0
        while True:
            here, there = left[0][i], right[0][j]
            across = self.ranks.get(left[2][i] + right[1][j], NEVER)
            if across < here and across <= there and across != NEVER:  # of equal ranks, the leftmost is merged
                return False
            if here == there == NEVER:
                return True
            if here <= there:
                i += 1
            else:
                j += 1


class Transducer:
    """Reads bytes, emits tokens; its states and moves are made when they are needed.

    A state is a mapping of bytes to moves (the next state, the tokens emitted); at
    ``WAYS`` it holds its ways: (node of the trie << 8, token before it, tokens that wait).
    The last way is the one at the root, the encoding of what was read.
    """

    def __init__(self, merges: Merges):
        self.merges = merges
        child: dict[int, int] = {}
        token_at = [-1]
        inner = set()
        for token, rank in merges.ranks.items():
            node = 0
            for byte in token:
                inner.add(node)
                key = node << 8 | byte
                if key not in child:
                    child[key] = len(token_at)
                    token_at.append(-1)
                node = child[key]
            token_at[node] = rank
        #: Where a byte leads from a node: the next node << 8, the token it is, if any, and whether the trie goes on there.
        self.steps = {key: (node << 8, token_at[node], node in inner) for key, node in child.items()}
        self.forget()

    def forget(self) -> None:
        for state in getattr(self, "states", {}).values():
            state.clear()  # states lead to each other; so they are freed at once
        ways = ((0, -1, ()),)
        self.start, self.moves = {WAYS: ways}, 0
        self.states = {ways: self.start}

    def move(self, state: dict, byte: int) -> tuple[dict, tuple]:
        """Make the move from ``state`` by ``byte``."""
        ways, last, ended = [], -1, ()
        steps, merges = self.steps, self.merges
        known = merges.known
        for node, before, waiting in state[WAYS]:
            step = steps.get(node | byte)
            if step is None:
                continue
            to, token, goes_on = step
            if goes_on:
                ways.append((to, before, waiting))
            if last < 0 <= token:  # every byte is a token, so some way ends here
                may = known.get(before << 32 | token)
                if merges.may_follow(before, token) if may is None else may:
                    last, ended = token, (*waiting, token)
        agreed = len(ended)
        for _, _, waiting in ways:
            agreed = min(agreed, len(waiting))
            while waiting[:agreed] != ended[:agreed]:
                agreed -= 1
            if not agreed:
                break
        emitted = ended[:agreed]
        ways.append((0, last, ended))
        to = tuple([(node, before, waiting[agreed:]) for node, before, waiting in ways] if agreed else ways)
        following = self.states.get(to)
        if following is None:
            following = self.states[to] = {WAYS: to}
        made = state[byte] = (following, emitted)
        self.moves += 1
        return made

    def run(self, piece: bytes) -> list[int]:
        """The tokens of one match."""
        whole = self.merges.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.moves > MOST_MOVES:
            self.forget()
        state, out = self.start, []
        for byte in piece[:-1]:
            state, emitted = state.get(byte) or self.move(state, byte)
            if emitted:
                out += emitted
        out += self.end(state, piece[-1]) if piece else ()
        return out

    def end(self, state: dict, byte: int) -> tuple:
        """What is still to be emitted if ``byte`` is the last. Only the way at the root counts, so no move is made."""
        made = state.get(byte)
        if made is not None:
            return made[1] + made[0][WAYS][-1][2]
        for node, before, waiting in state[WAYS]:
            step = self.steps.get(node | byte)
            if step is not None and step[1] >= 0 and self.merges.may_follow(before, step[1]):
                return (*waiting, step[1])
        raise ValueError(f"byte {byte} is not in the vocabulary")


class Encoder(dict):
    """Texts to tokens. As a mapping, it keeps the tokens of matches met lately, as 32-bit numbers end to end.

    When it has half of what may be kept, it starts anew, but takes over from
    ``older``, the half before, whatever is met again.
    """

    def __init__(self, transducer: Transducer, pattern: str):
        super().__init__()
        self.transducer, self.pattern = transducer, regex.compile(pattern)
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        tokens = self.older.get(piece)
        if tokens is None:
            tokens = array("i", self.transducer.run(piece.encode("utf-8", "replace"))).tobytes()
            if len(piece) > LONGEST_PIECE:
                return tokens
        if len(self) >= MOST_PIECES // 2:
            self.older = dict(self)
            self.clear()
        self[piece] = tokens
        return tokens

    def encode(self, text: str) -> np.ndarray:
        if len(text) < LONG_TEXT:
            return self._tokens(self.pattern.findall(text))
        found, parts = (m.group() for m in self.pattern.finditer(text)), []
        while pieces := list(islice(found, LONG_TEXT >> 4)):
            parts.append(self._tokens(pieces))
        return np.concatenate(parts)

    def _tokens(self, pieces: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), np.int32)


class Utf8Machine:
    """Bytes in, characters out as soon as they are complete.

    The state is what is left of an open character: the ranges its next bytes
    have to be in. Bytes of an open character are held by the caller.
    """

    def __init__(self):
        more = (0x80, 0xBF)
        self.opens = {}
        for lo, hi, least, most, others in WELL_FORMED:
            for first in range(lo, hi + 1):
                self.opens[first] = ((least, most), *[more] * others)

    def read(self, held: bytes, data: bytes) -> tuple[bytes, str]:
        """What is held after ``data``, and the characters completed by it."""
        out = []
        state = self.state_of(held)
        open_bytes = bytearray(held)
        for byte in data:
            if state:
                if state[0][0] <= byte <= state[0][1]:
                    open_bytes.append(byte)
                    state = state[1:]
                    if not state:
                        out.append(open_bytes.decode())
                        open_bytes.clear()
                    continue
                out.append("�")  # the open character ends here; the byte is read anew
                open_bytes.clear()
            state = self.opens.get(byte, ())
            if state:
                open_bytes.append(byte)
            else:
                out.append(chr(byte) if byte < 0x80 else "�")
        return bytes(open_bytes), "".join(out)

    def state_of(self, held: bytes) -> tuple:
        return self.opens[held[0]][len(held) - 1 :] if held else ()


class Decoder:
    """Tokens to text, piece by piece; ``moves`` are kept per state and token.

    Tokens that neither begin nor end within a character lead from no open
    character to none, so between characters they are read side by side.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.machine, self.moves = tokens, Utf8Machine(), {}
        most = max(tokens, default=-1)
        self.sorted = np.array(sorted(tokens), np.int64) if most >= 4 * len(tokens) + 1024 else None  # ids far apart are searched for
        self.unknown = most + 1 if self.sorted is None else len(tokens)
        self.bytes = np.full(self.unknown + 1, REPLACEMENT, object)
        for at, i in enumerate(sorted(tokens)):
            self.bytes[i if self.sorted is None else at] = tokens[i]
        self.texts = np.full(self.unknown + 1, None, object)
        self.single = np.ones(self.unknown + 1, bool)  # tokens to be read by themselves: those others and those not met so far
        self.held = b""

    def places(self, ids) -> np.ndarray:
        """Where the tables have ``ids``."""
        ids = np.asarray(ids)
        if ids.dtype.kind not in "iu":
            ids = np.array([int(i) if i in self.tokens else -1 for i in ids.tolist()], np.int64)
        if self.sorted is not None:
            at = np.minimum(np.searchsorted(self.sorted, ids), self.unknown - 1)
            return np.where(self.sorted[at] == ids, at, self.unknown)
        if len(ids) and (ids.min() < 0 or ids.max() >= self.unknown):
            return np.where((ids >= 0) & (ids < self.unknown), ids, self.unknown)
        return ids

    def bytes_of(self, ids) -> bytes:
        return b"".join(self.bytes.take(self.places(ids)).tolist())

    def feed(self, ids) -> str:
        """The characters that are complete after ``ids``."""
        at = self.places(ids)
        out, read = self.texts.take(at).tolist(), 0
        alone = np.flatnonzero(self.single[at]).tolist()
        for first in [0, *alone] if self.held else alone:
            if first < read:
                continue
            for read in range(first, len(out)):  # as far as the end of an open character
                out[read] = self._step(int(at[read]))
                if not self.held:
                    break
            read += 1
        return "".join(out)

    def _step(self, at: int) -> str:
        move = self.moves.get((self.held, at))
        if move is None:
            if len(self.moves) >= MOST_MOVES:
                self.moves.clear()
            move = self.moves[self.held, at] = self.machine.read(self.held, self.bytes[at])
            if not self.held and not move[0]:
                self.texts[at], self.single[at] = move[1], False
        self.held = move[0]
        return move[1]

    def finish(self) -> str:
        """End the text: a character that is still open becomes U+FFFD."""
        left, self.held = ("�" if self.held else ""), b""
        return left


@contextmanager
def _no_collection():
    """Nothing here leaves cycles behind, and looking for some in a million tuples costs a third of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_compiled: dict[str, Merges | Encoder | Decoder] = {}


def _merges(name: str, data: bytes) -> Merges:
    """The vocabulary ``name``, compiled once in each worker."""
    if name not in _compiled:
        _compiled.clear()
        _compiled[name] = Merges(ranks_of(data))
    return _compiled[name]


def _encoder(name: str, data: bytes, pattern: str) -> Encoder:
    key = f"{name} {pattern}"
    if key not in _compiled:
        _compiled[key] = Encoder(Transducer(_merges(name, data)), pattern)
    return _compiled[key]


def _decoder(name: str, data: bytes) -> Decoder:
    key = f"{name} decoder"
    if key not in _compiled:
        _compiled[key] = Decoder(_merges(name, data).tokens)
    return _compiled[key]


def _vocabulary(df: DataFrame, path: str):
    """A rank file, read by the driver and sent to the workers once: it is a vocabulary, about 1 MB."""
    with open(path, "rb") as file:
        data = file.read()
    return hashlib.sha256(data).hexdigest(), df.sparkSession.sparkContext.broadcast(data)


def _texts(texts: pd.Series, encoder: Encoder) -> list[np.ndarray]:
    return [encoder.encode((raw or b"").decode("utf-8", "replace")) for raw in texts]


def _read(ids, decoder: Decoder) -> tuple[bytes, str]:
    return decoder.bytes_of(ids), decoder.feed(ids) + decoder.finish()


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", result: str = "ids") -> DataFrame:
    """``docs`` with ``result``, the tokens of each text (``array<int>``) by the rank file at ``path``."""
    prepared(docs.sparkSession)
    name, shared = _vocabulary(docs, path)

    @F.pandas_udf("array<int>")
    def encoded(texts: pd.Series) -> pd.Series:
        with _no_collection():
            return pd.Series(_texts(texts, _encoder(name, shared.value, pattern)), dtype=object)

    encoded = encoded.asNondeterministic()  # it isn't; but so Spark runs it once, and not once more for whatever reads the ids
    return docs.select(*besides(docs, result), encoded(named(text_col).cast("string").cast("binary")).alias(result))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", result: str = "decoded") -> DataFrame:
    """``tokens`` with ``result``: the bytes that the ids stand for, and the text the decoder reads from them."""
    prepared(tokens.sparkSession)
    name, shared = _vocabulary(tokens, path)

    @F.pandas_udf(DECODED)
    def decoded(ids: pd.Series) -> pd.DataFrame:
        with _no_collection():
            decoder = _decoder(name, shared.value)
            out = [_read([] if some is None else some, decoder) for some in ids]
        return pd.DataFrame(out, columns=["bytes", "text"])

    return tokens.select(*besides(tokens, result), decoded(named(ids_col)).alias(result))


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text", result: str = "coded") -> DataFrame:
    """``docs`` with ``result``: each text's ``ids``, and the ``bytes`` and ``text`` read back from the ids.

    The same as ``encode`` and ``decode`` one after the other, but one worker does both.
    """
    prepared(docs.sparkSession)
    name, shared = _vocabulary(docs, path)

    @F.pandas_udf("struct<ids:array<int>,bytes:binary,text:string>")
    def coded(texts: pd.Series) -> pd.DataFrame:
        with _no_collection():
            ids = _texts(texts, _encoder(name, shared.value, pattern))
            decoder = _decoder(name, shared.value)
            out = [(some, *_read(some, decoder)) for some in ids]
        return pd.DataFrame(out, columns=["ids", "bytes", "text"])

    coded = coded.asNondeterministic()  # as above
    return docs.select(*besides(docs, result), coded(named(text_col).cast("string").cast("binary")).alias(result))
