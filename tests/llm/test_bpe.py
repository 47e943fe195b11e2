"""Byte-level BPE against the tiktoken library; decoding against Python's own decoder."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import plain
from tidemill.llm import bpe_transducer as bpe
from tidemill.llm.queries import QUERIES

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
OTHER = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ranks(path):
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(MULTI), special_tokens={})


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(ranks(MULTI))


@pytest.fixture
def encoder(merges):
    return bpe.Encoder(bpe.Transducer(merges), public_tokenizers.PATTERN)


SCRAPS = ["ab", "th", "e", "ing", "  ", "\n", "\t", "1", "9", "é", "漢", "字", "😀", "'s", "'LL", "_", "=", "-", "aa", "ÿ", "́", " ", "\x1c", "<|endoftext|>"]


def test_tables_as_the_library(spark, tables, library):
    got = {r.doc_id: r for r in QUERIES["op11_byte_bpe"](spark, SMALL).collect()}
    docs = tables.documents.select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for doc, text in docs:
        ids, row = library.encode_ordinary(text or ""), got[doc]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256, row.same_text) == (len(ids), plain.sha(",".join(map(str, ids))), plain.sha(text or ""), True)


@pytest.mark.parametrize("seed", range(5))
def test_random_texts(encoder, library, seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choice(SCRAPS) for _ in range(rng.randrange(50)))
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_any_code_point(encoder, library):
    text = " ".join(f"a{chr(c)}b {chr(c)}" for c in range(0, 0x3000) if not 0xD800 <= c < 0xE000)
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 30_000, "abcab" * 6_000, " " * 10_000, "\n \n" * 5_000, "漢" * 9_000, "=" * 5_000 + "-" * 5_000])
def test_long_matches(encoder, library, text):
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_long_text_block_by_block(encoder, library, monkeypatch):
    monkeypatch.setattr(bpe, "LONG_TEXT", 64)
    text = "".join(random.Random(3).choice(SCRAPS) for _ in range(900))
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_tables_that_overflow(merges, library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_MOVES", 40)
    monkeypatch.setattr(bpe, "MOST_PIECES", 3)
    encoder, decoder = bpe.Encoder(bpe.Transducer(merges), public_tokenizers.PATTERN), bpe.Decoder(merges.tokens)
    text = "".join(random.Random(4).choice(SCRAPS) for _ in range(900))
    ids = encoder.encode(text).tolist()
    assert ids == library.encode_ordinary(text) and len(encoder) <= 3
    assert decoder.feed(ids) + decoder.finish() == text


def plain_merges(piece, table):
    """Merging as it is defined: the pair of lowest rank, the leftmost of equals."""
    parts = [bytes([b]) for b in piece]
    if piece in table:
        return [table[piece]]
    while True:
        found = [(table[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in table]
        if not found:
            return [table[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(12))
def test_made_up_vocabularies(seed):
    """Ranks in any order: parts may rank above their whole, and tokens may be out of reach of the merges."""
    rng = random.Random(seed)
    made = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(25)}
    order = [bytes([b]) for b in range(256)] + sorted(made)
    rng.shuffle(order)
    table = {t: i for i, t in enumerate(order)}
    transducer = bpe.Transducer(bpe.Merges(table))
    for _ in range(300):
        piece = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 25)))
        assert transducer.run(piece) == plain_merges(piece, table), piece


def test_tokens_are_emitted_within_the_longest_token(merges):
    transducer = bpe.Transducer(merges)
    longest = max(map(len, merges.ranks))
    state = transducer.start
    for byte in bytes(random.Random(2).choice(b"etaoin") for _ in range(3_000)):
        state, _ = state.get(byte) or transducer.move(state, byte)
        waiting = state[bpe.WAYS][-1][2]
        assert sum(len(merges.tokens[t]) for t in waiting) <= 2 * longest


@pytest.mark.parametrize("seed", range(4))
def test_decoding_ill_formed_bytes(seed):
    """However the bytes are cut up, the text is what a decoder with replacement gives."""
    rng = random.Random(seed)
    single = bpe.Decoder({i: bytes([i]) for i in range(256)})
    for _ in range(300):
        data = b"".join(rng.choice([bytes([rng.randrange(256)]), "é".encode(), "漢".encode(), "😀".encode()[: rng.randrange(5)], b"\xed\xa0\x80", b"\xf4\x90"]) for _ in range(12))
        text = ""
        for i in range(0, len(data), 3):
            text += single.feed(list(data[i : i + 3]))
        assert text + single.finish() == data.decode("utf-8", "replace")


def test_odd_rows(spark, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "é ü 漢字 😀" * 3, "x"), (3, "é ü 漢字 😀" * 3, "x"), (None, "one two", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("decoded", F.lit(7)).withColumn("held", F.lit(0))
    coded = bpe.encode(docs, MULTI, public_tokenizers.PATTERN)
    assert sorted(coded.columns) == sorted(docs.columns)
    both = bpe.round_trip(docs, MULTI, public_tokenizers.PATTERN, result="decoded")
    key = lambda r: repr((r[0], r[1]))
    pairs = zip(sorted(bpe.decode(coded, MULTI).collect(), key=key), sorted(both.collect(), key=key), strict=True)
    for row, other in pairs:
        assert (row.ids, row.decoded.text, row.decoded.bytes) == (other.decoded.ids, other.decoded.text, other.decoded.bytes)
        assert row.ids == library.encode_ordinary(row.text or "")
        assert (row.decoded.text, bytes(row.decoded.bytes)) == (row.text or "", (row.text or "").encode())


def test_empty_table_null_and_unknown_ids(spark):
    none = spark.createDataFrame([], "text string")
    assert bpe.decode(bpe.encode(none, MULTI, public_tokenizers.PATTERN), MULTI).count() == 0
    ids = spark.createDataFrame([(None,), ([],), ([50_300, 64],)], "ids array<int>")
    texts = [r.decoded.text for r in bpe.decode(ids, MULTI).collect()]
    assert texts[:2] == ["", ""] and texts[2][0] == "�" and len(texts[2]) == 2


def test_another_vocabulary(spark):
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(OTHER), special_tokens={})
    docs = spark.createDataFrame([("The quick brown fox, jumping.\n\n  over 12 dogs' backs",)], "text string")
    row = bpe.encode(docs, OTHER, public_tokenizers.PATTERN, result="tokens").first()
    assert row.tokens == own.encode_ordinary(row.text)
