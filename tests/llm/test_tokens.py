"""Packing and byte-level BPE against the tokenizer libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from tests.llm.helpers_llm import awkward, documents, prose
from touchline.llm.op1_packing import best_two_fit, pack, place, token_pieces
from touchline.llm.op4_byte_bpe import Replay, decode, encode, read_ranks

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")
ODD = ["aaaaaaa aaaa aaa aa banananananana's", "İstanbul ﬁ x y \x1cq 12 é ÀÖß", "don't 'tis x'S it''s ..'s",
       "a1b2C3É9é!!", "'", "\x00", "日本語 é×ü÷", "   \u0085", "   lead", "trail   ", "a \n b\n\n\nc  d", "x\t y 　z"]


@pytest.fixture(scope="module")
def rows():
    return awkward() + list(enumerate(ODD, 100))


def test_pieces_equal_the_tokenizer(spark, rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(WORD)
    want = []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start:start + 2048]
            want.append((i or -1, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()), own))
    found = token_pieces(documents(spark, rows), WORD, with_ids=True).collect()
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in found) == sorted(want)


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_is_gapless_and_tight(spark, rows):
    found = pack(documents(spark, rows), WORD).collect()
    n = check_places(found, 2048)
    assert len(found) == token_pieces(documents(spark, rows), WORD).count()
    assert n == -(-sum(r.length for r in found) // 2048)
    assert pack(documents(spark, []), WORD).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_places_of_random_lengths(spark, seed):
    random.seed(seed)
    lengths = [random.choice([random.randint(1, 100), 37, 100]) for _ in range(400)]
    pieces = spark.createDataFrame([(i // 3, i % 3, 0, n, 0) for i, n in enumerate(lengths)],
                                   "doc_id long, piece int, start long, length long, ids_crc32 long")
    found = place(pieces, 100).collect()
    assert len(found) == 400
    gaps = []       # best fit decreasing, piece by piece
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 100) - n)
    assert check_places(found, 100) <= 1.01 * len(gaps) + 1


def test_exchange_fills_a_gap():
    # greedy takes 60 + 30 and leaves 10; 20 and 20 fill what the 30 had more tightly
    plan = best_two_fit({60: 1, 30: 1, 20: 2}, 100)
    assert plan[0] == ([60, 20, 20], 1)
    assert sum(n * times for pattern, times in plan for n in pattern) == 130


def test_bpe_equals_the_library(spark, rows):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE, "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = decode(encode(documents(spark, rows), BYTE, P.PATTERN), BYTE).collect()
    got = sorted((r.doc_id or -1, list(r.ids), bytes(r.decoded)) for r in found)
    assert got == sorted((i or -1, library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    assert encode(documents(spark, []), BYTE, P.PATTERN).count() == 0


def test_replay_equals_merging_each_word_alone():
    random.seed(5)
    replay = Replay(read_ranks(BYTE))
    found = [prose(k, 3).encode() for k in range(300)] + [bytes(random.choices(range(256), k=9)) for _ in range(2000)] \
        + [b"aaaaaaa", b"abababab", b"aabaabaab", b"z"]
    assert replay(found) == [replay._one(w) for w in found]


def test_replay_with_a_pair_older_than_its_merge():
    ranks = {bytes([c]): c for c in range(256)} | {b"bc": 300, b"abc": 301, b"ab": 302, b"cd": 303}
    replay = Replay(ranks)
    words = [b"abc", b"abab", b"abcd", b"cabd", b"ababcabc"]
    assert replay(words) == [replay._one(w) for w in words]
