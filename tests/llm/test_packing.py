"""Packing: patterns against brute force, pieces against plain tokenisation."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.corpus import SCHEMA, documents
from tillspark.llm import packing
from tillspark.llm.tokens import ByteTokens


def least_cost(pieces: tuple[int, ...], capacity: int) -> int:
    """Least padded tokens over all ways to share out the pieces, by trying every set for the first piece."""

    @cache
    def best(left: tuple[int, ...]) -> int:
        if not left:
            return 0
        first, rest = left[0], left[1:]
        found = 1 << 60
        for mask in range(1 << len(rest)):
            own = [x for i, x in enumerate(rest) if mask >> i & 1]
            if first + sum(own) <= capacity:
                other = tuple(x for i, x in enumerate(rest) if not mask >> i & 1)
                found = min(found, packing.padded(first + sum(own), capacity) + best(other))
        return found

    return best(tuple(sorted(pieces, reverse=True)))


@pytest.mark.parametrize("seed", range(12))
def test_patterns_take_all_pieces_near_the_least_cost(seed):
    rng = random.Random(seed)
    capacity = 12
    pieces = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))]
    patterns = packing.whole_patterns(Counter(pieces), capacity)
    taken: Counter = Counter()
    for p in patterns:
        assert p.times > 0 and p.fill() <= capacity
        for length, n in p.lengths.items():
            taken[length] += n * p.times
    assert taken == Counter(pieces)
    cost = sum(packing.padded(p.fill(), capacity) * p.times for p in patterns)
    basis, used = packing.linear_program(dict(Counter(pieces)), capacity)
    bound = sum(packing.padded(sum(x * n for x, n in own.items()), capacity) * u for own, u in zip(basis, used, strict=True))
    least = least_cost(tuple(pieces), capacity)
    assert bound <= least * (1 + 2 * packing.SLACK) + 1e-6
    assert least <= cost <= least + 2 * capacity


def test_many_pieces_have_little_padding():
    rng = np.random.default_rng(3)
    lengths, counts = np.unique(np.minimum(2048, rng.lognormal(6, 1.2, 40_000).astype(int) + 1), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist(), strict=True))
    patterns = packing.whole_patterns(histogram)
    tokens = sum(x * n for x, n in histogram.items())
    assert sum(p.fill() * p.times for p in patterns) == tokens
    assert sum(packing.padded(p.fill(), packing.SEQUENCE) * p.times for p in patterns) < tokens * 1.002


def test_prices_match_a_plain_recursion():
    lengths, prices = np.array([2, 3, 7]), np.array([1.0, 2.5, 5.0])
    best, last = packing._priced(prices, lengths, 15)
    plain = [0.0] + [float("-inf")] * 15
    for fill in range(1, 16):
        plain[fill] = max([plain[fill - x] + p for x, p in zip(lengths.tolist(), prices.tolist(), strict=True) if x <= fill], default=float("-inf"))
    assert best.tolist() == plain
    assert all(sum(k * n for k, n in packing._unwound(f, last).items()) == f for f in range(16) if plain[f] > float("-inf"))


@pytest.mark.parametrize("plain", [True, False])
def test_parts_have_the_ids_of_whole_texts(plain):
    with open(packing.vocabulary_file(), encoding="utf-8") as file:
        definition = file.read()
    tokenizer = Tokenizer.from_str(definition)
    tokenizer.encode_special_tokens = plain
    rng = random.Random(9)
    letters = [*" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　​﻿\x00\x7f'std 12\xe9\xf6abc中文!?.-_<|>", "<|endoftext|>", "'ll", " 's"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(0, 40))) for _ in range(4000)]
    encoder = ByteTokens(definition, plain)
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
        assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def check_packed(rows, capacity, texts):
    """All contracts of a packing of (doc_id, text) rows, against plain tokenisation."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    ids_of = {}
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        ids_of.setdefault((doc, len(ids)), []).append(ids)
        expected[doc, len(ids)] += len(ids)
    covered = Counter()
    sequences = {}
    for r in rows:
        covered[r["doc_id"], r["doc_tokens"]] += r["length"]
        crcs = {zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for ids in ids_of[r["doc_id"], r["doc_tokens"]]}
        assert r["ids_crc32"] in crcs
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert covered == expected
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at <= capacity


@pytest.mark.parametrize("capacity", [64, 2048])
def test_documents_are_packed_whole(spark, capacity):
    rows = [*documents(seed=4), (900, "<|endoftext|> inside <|endoftext|>", "en", "a", 1), (901, "word " * 3000, "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = packing.packed(docs, capacity=capacity).collect()
    check_packed(got, capacity, [(r[0], r[1]) for r in rows])
    pieces = Counter((r["doc_id"], r["doc_tokens"], r["start"]) for r in got)
    assert max(n for (doc, *_), n in pieces.items() if doc != rows[4][0] and doc is not None) == 1


def test_nothing_and_columns_that_clash(spark):
    docs = spark.createDataFrame([(7, None, 1, "x"), (8, "two words", 2, "y"), (None, "", 3, "z")], "doc_id int, text string, rank int, block string")
    got = packing.packed(docs).collect()
    check_packed(got, packing.SEQUENCE, [(7, None), (8, "two words"), (None, "")])
    assert {r["doc_id"] for r in got} == {7, 8, None}
    assert packing.packed(docs.limit(0)).count() == 0
