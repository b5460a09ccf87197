"""Alignment of two tokenizers against a plain version, and products against numpy's."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.corpus import SCHEMA, documents
from tillspark.llm import alignment
from tillspark.llm.tokens import byte_of_character


def plain_tokens(text, a, b):
    """(id, first byte, byte after) of every token of both tokenizers, or None."""
    if not text:
        return None
    whole, of = (" " + text).encode(), byte_of_character()
    out = []
    encoded = a.encode(" " + text, add_special_tokens=False)
    spelled_a = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in encoded.ids]
    spelled_b = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        is_byte = len(piece) == 6 and piece.startswith("<0x")
        spelled_b.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
    for spelled in (spelled_a, spelled_b):
        if b"".join(x for _, x in spelled) != whole:
            return None
        at, tokens = 0, []
        for i, x in spelled:
            tokens.append((i, at, at + len(x)))
            at += len(x)
        out.append(tokens)
    return out


def plain_alignment(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    tokens = [(doc, plain_tokens(text, a, b)) for doc, text in rows]
    linked = [[(x[0], y[0]) for x in t[0] for y in t[1] if x[1] < y[2] and y[1] < x[2]] if t else [] for _, t in tokens]
    counts = Counter(p for own in linked for p in own)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for (doc, t), own in zip(tokens, linked, strict=True):
        if not t:
            out.append((doc, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        ends = sorted({x[2] for x in t[0]} & {y[2] for y in t[1]})
        groups, low, shared = [], 0, 0
        for end in ends:
            one, two = ([x for x in side if low < x[2] <= end] for side in t)
            groups.append(",".join(str(x[0]) for x in one) + "|" + ",".join(str(y[0]) for y in two))
            shared += len(one) * len(two)
            low = end
        best = sum(counts[p] == most[p[1]] for p in own)
        out.append((doc, len(t[0]), len(t[1]), len(ends), len(own), best, sum(counts[p] for p in own), hashlib.sha256(";".join(groups).encode()).hexdigest(), shared))
    return sorted(out, key=str)


ODD = [
    (700, "<|endoftext|> is plain here"), (701, "▁already marked"), (702, "tab\tand space　wide"), (703, "日本語のテキスト 😀 emoji 👩‍👩‍👧"),
    (704, "é combining"), (705, " leading and  double"), (706, "<0x41> <s> </s>"), (707, "\x00\x01"), (708, "ﬁ ligature ①"), (709, " "), (710, "\n"), (711, "𝔘" * 50),
]


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1]) for r in documents(seed=5, n=60)] + ODD


@pytest.mark.parametrize(("block", "piece"), [(alignment.BLOCK, alignment.PIECE), (3000, 700)])
def test_alignment_matches_a_plain_one(spark, monkeypatch, rows, block, piece):
    monkeypatch.setattr(alignment, "BLOCK", block)
    monkeypatch.setattr(alignment, "PIECE", piece)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = alignment.aligned(docs).collect()
    assert sorted(map(tuple, got), key=str) == plain_alignment(rows)
    assert any(r["n_best"] < r["n_links"] for r in got)


def test_links_are_the_pairs_that_overlap_or_share_a_group(spark, rows):
    docs = spark.createDataFrame(rows[:20] + ODD, "doc_id long, text string")
    expected = {r[0]: (r[4], r[8]) for r in plain_alignment(rows[:20] + ODD)}
    overlaps, shared = alignment.links(docs).collect(), alignment.links(docs, groups=True).collect()
    assert Counter(r["doc_id"] for r in overlaps) == Counter({d: n for d, (n, _) in expected.items() if n})
    assert Counter(r["doc_id"] for r in shared) == Counter({d: n for d, (_, n) in expected.items() if n})
    assert {(r["doc_id"], r["place_a"], r["place_b"]) for r in overlaps} <= {(r["doc_id"], r["place_a"], r["place_b"]) for r in shared}


@pytest.mark.parametrize("entries", [1 << 22, 5])
def test_products_match_dense_ones(monkeypatch, entries):
    monkeypatch.setattr(alignment, "ENTRIES", entries)
    rng = np.random.default_rng(entries)
    for _ in range(20):
        x, y = rng.random((rng.integers(1, 9), 7)) < 0.4, rng.random((7, rng.integers(1, 9))) < 0.4
        left, right = (alignment.Csr(np.append(0, np.cumsum(m.sum(axis=1))), np.nonzero(m)[1]) for m in (x, y))
        out = alignment.product(left, right, y.shape[1])
        dense = np.zeros((x.shape[0], y.shape[1]), int)
        dense[np.repeat(np.arange(x.shape[0]), np.diff(out.indptr)), out.indices] = out.counts
        assert (dense == x.astype(int) @ y.astype(int)).all()
        turned = left.transposed(7)
        back = np.zeros((7, x.shape[0]), bool)
        back[np.repeat(np.arange(7), np.diff(turned.indptr)), turned.indices] = True
        assert (back == x.T).all()


def test_nothing_and_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, None, 5, "p"), (None, "", 6, "q"), (2, "same text", 7, "r"), (2, "same text", 8, "s")], "doc_id int, text string, block int, pairs string")
    got = sorted(map(tuple, alignment.aligned(docs).collect()), key=str)
    assert got == plain_alignment([(1, None), (None, ""), (2, "same text"), (2, "same text")])
    assert alignment.aligned(docs.limit(0)).count() == 0
