"""Byte-level BPE: what a worker keeps and what it makes anew; decoding side by side."""

import random

import numpy as np
import public_tokenizers
import pytest

from tidemill.llm import bpe_transducer as bpe


@pytest.fixture(scope="module")
def merges():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return bpe.Merges(bpe.ranks_of(file.read()))


def test_matches_met_again_are_taken_over(merges, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 8)
    encoder, met = bpe.Encoder(bpe.Transducer(merges), public_tokenizers.PATTERN), []
    run = encoder.transducer.run
    monkeypatch.setattr(encoder.transducer, "run", lambda piece: met.append(piece) or run(piece))
    text = "".join(f" oftenmet once{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    encoder.encode(text)
    assert met.count(b" oftenmet") == 1 and len(met) == 201
    assert len(encoder) + len(encoder.older) <= 8


def test_the_last_byte_makes_no_move(merges):
    transducer = bpe.Transducer(merges)
    piece = b" qzvxkj"
    tokens = transducer.run(piece)
    assert b"".join(merges.tokens[t] for t in tokens) == piece and len(tokens) > 1
    assert transducer.moves == len(piece) - 1
    assert bpe.Transducer(merges).run(piece + b"w") == transducer.run(piece + b"w")
    assert transducer.run(piece) == tokens and transducer.run(b"") == []


@pytest.mark.parametrize("gap", [1, 3, 100_000])
@pytest.mark.parametrize("seed", range(3))
def test_decoding_as_plain_lookup(seed, gap):
    """Dense ids, ids with gaps and ids far apart; unknown ids; tokens that begin or end within a character."""
    rng = random.Random(seed)
    scraps = ["é", "漢", "😀", "a", "bc", " ", "�"]
    made = {"".join(rng.choices(scraps, k=4)).encode()[rng.randrange(4) : rng.randrange(4, 9)] for _ in range(60)}
    tokens = {i * gap: t for i, t in enumerate(sorted(made))}
    decoder = bpe.Decoder(tokens)
    choice = [*tokens, *tokens, -1, -7, max(tokens) + 1, 2**31 - 1, 1 if gap > 1 else -2]
    for _ in range(60):
        ids = rng.choices(choice, k=rng.randrange(30))
        data = b"".join(tokens.get(i, bpe.REPLACEMENT) for i in ids)
        for given in (ids, np.array(ids, np.int32), np.array(ids, np.float64), np.array(ids, object)):
            assert decoder.bytes_of(given) == data
            assert decoder.feed(given) + decoder.finish() == data.decode("utf-8", "replace")
        cut = rng.randrange(len(ids) + 1)
        assert decoder.feed(ids[:cut]) + decoder.feed(ids[cut:]) + decoder.finish() == data.decode("utf-8", "replace")
    assert decoder.bytes_of(np.array([np.nan])) == bpe.REPLACEMENT and bpe.Decoder({}).bytes_of([3]) == bpe.REPLACEMENT
