"""Alignment of two tokenizers on the same texts by products of incidence matrices.

A token is incident with the bytes it covers.  With the tokens of one tokenizer
as rows and the bytes of the text as columns, A times the transpose of B has an
entry for every two tokens that overlap.  Where tokens of both end at the same
byte the text is cut into groups; the transpose of groups by tokens of A times
groups by tokens of B has an entry for every two tokens that share a group.

The matrices are compressed sparse rows made from token lengths.  Products go
row by row: a row of the result is the sum of the right rows that the left row's
entries name.

How often two ids are linked in all texts is summed by Spark.  Each block of
texts contributes every pair it has once, with a count, and gets the sums back
by a join; the texts' own lists of pairs wait in a stored table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, partial

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.blocks import packed, unpacked
from tillspark.llm.tables import stored
from tillspark.llm.tokens import ByteTokens
from tillspark.llm.words import pieces

#: Text bytes that a task aligns at a time, and bytes of a block, one text at least.
PIECE, BLOCK = 1 << 20, 16 << 20  # a piece has fewer than 2 ** 23 texts, so that text and pair of ids fit a number
#: Entries of a product that are made at a time.
ENTRIES = 1 << 22
#: Bits of an id in a pair of ids.
ID_BITS = 20


def vocabulary_files() -> tuple[str, str]:
    """The two tokenizers used unless a caller names others."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Csr:
    """Rows of a matrix of ones and counts: row i has columns ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    counts: np.ndarray | None = None

    @classmethod
    def spans(cls, lengths: np.ndarray) -> Csr:
        """Row i has the next ``lengths[i]`` columns."""
        indptr = np.append(0, np.cumsum(lengths))
        return cls(indptr, np.arange(indptr[-1]))

    def transposed(self, n_columns: int) -> Csr:
        row = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        order = np.argsort(self.indices, kind="stable") if (np.diff(self.indices) < 0).any() else slice(None)
        return Csr(np.append(0, np.cumsum(np.bincount(self.indices, minlength=n_columns))), row[order])

    def row_sizes_of_product(self, right: Csr) -> np.ndarray:
        """Terms that every row of the product with ``right`` sums."""
        terms = np.append(0, np.cumsum(np.diff(right.indptr)[self.indices]))
        return terms[self.indptr[1:]] - terms[self.indptr[:-1]]


def product_parts(left: Csr, right: Csr, n_columns: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row, column and value of the entries of a product, some rows at a time."""
    terms = np.append(0, np.cumsum(left.row_sizes_of_product(right)))
    low, n = 0, len(left.indptr) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(terms, terms[low] + ENTRIES, "right")) - 1)
        own = left.indices[left.indptr[low] : left.indptr[high]]
        sizes = right.indptr[own + 1] - right.indptr[own]
        row = np.repeat(np.repeat(np.arange(low, high), np.diff(left.indptr[low : high + 1])), sizes)
        if len(sizes) and sizes.min() == sizes.max() == 1:
            column = right.indices[right.indptr[own]]
        else:
            at = np.repeat(right.indptr[own] - np.append(0, np.cumsum(sizes)[:-1]), sizes) + np.arange(sizes.sum())
            column = right.indices[at]
        key = row * n_columns + column
        if (key[1:] < key[:-1]).any():
            key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key = key[first]
        yield key // n_columns, key % n_columns, np.diff(np.append(first, len(row)))
        low = high


def product(left: Csr, right: Csr, n_columns: int) -> Csr:
    parts = list(product_parts(left, right, n_columns))
    rows, columns, counts = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
    indptr = np.append(0, np.cumsum(np.bincount(rows, minlength=len(left.indptr) - 1)))
    return Csr(indptr, columns, counts)


@dataclass
class Aligned:
    """Tokens of consecutive texts by both tokenizers, and the texts they are of; ``groups`` are ends of bytes that both have."""

    a: np.ndarray
    b: np.ndarray
    bytes_a: np.ndarray
    bytes_b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray

    def __post_init__(self) -> None:
        ends_a, ends_b = np.cumsum(self.bytes_a), np.cumsum(self.bytes_b)
        self.groups = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(self.groups, ends_a), np.searchsorted(self.groups, ends_b)

    def overlaps(self) -> Csr:
        """Tokens of A by tokens of B: the bytes they share."""
        n_bytes = int(self.bytes_a.sum())
        return product(Csr.spans(self.bytes_a), Csr.spans(self.bytes_b).transposed(n_bytes), len(self.b))

    def group_factors(self) -> tuple[Csr, Csr]:
        """Tokens of A by groups, and groups by tokens of B."""
        per_a, per_b = (np.bincount(g, minlength=len(self.groups)) for g in (self.group_a, self.group_b))
        return Csr.spans(per_a).transposed(len(self.a)), Csr.spans(per_b)

    def shared_groups(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        left, right = self.group_factors()
        return product_parts(left, right, len(self.b))

    def group_links(self) -> np.ndarray:
        """Per token of A the number of tokens of B in its group."""
        left, right = self.group_factors()
        return left.row_sizes_of_product(right)

    def spelled(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids in decimal, A's then B's of every group, each followed by its separator; where each text's tokens end."""
        n_groups = len(self.groups)
        per_a, per_b = (np.append(0, np.cumsum(np.bincount(g, minlength=n_groups))) for g in (self.group_a, self.group_b))
        place_a = np.arange(len(self.a)) + per_b[self.group_a]
        place_b = np.arange(len(self.b)) + per_a[self.group_b + 1]
        n = len(self.a) + len(self.b)
        ids, sign, text = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8), np.zeros(n, np.int64)
        for place, own, group, of, mark in ((place_a, self.a, self.group_a, self.text_a, "|"), (place_b, self.b, self.group_b, self.text_b, ";")):
            ids[place], text[place] = own, of
            sign[place[np.flatnonzero(np.diff(group, append=n_groups))]] = ord(mark)
        digits, widths = decimals(int(ids.max(initial=0)))
        out, width = digits[ids], widths[ids]
        out[np.arange(n), width] = sign
        flat = out[np.arange(8) <= width[:, None]]
        return flat, np.append(0, np.cumsum(np.bincount(text, width + 1))).astype(np.int64)


@cache
def decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of the numbers up to ``most``, and how many there are."""
    numbers = np.arange(most + 1)
    width = np.searchsorted(10 ** np.arange(1, 8), numbers, "right") + 1
    out = np.zeros((most + 1, 8), np.uint8)
    for k in range(7):
        out[:, k] = numbers // 10 ** np.maximum(width - 1 - k, 0) % 10 + ord("0")
    return out, width


class Tokenizers:
    """Both tokenizers and the bytes of their ids, made once per task."""

    def __init__(self, definition: str, model: bytes) -> None:
        self.a = ByteTokens(definition, plain=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes_a = self.a.bytes_of
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.length_a, self.length_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))

    def align(self, texts: list[str | None]) -> Aligned:
        """Tokens of all texts that both tokenizers spell in full; the others have none."""
        some = [(i, t) for i, t in enumerate(texts) if t]
        own_a = self.a.encode([" " + t for _, t in some])
        own_b = self.b.encode([t for _, t in some], num_threads=1) if some else []
        kept: list[tuple[int, np.ndarray, np.ndarray]] = []
        for (i, text), x, y in zip(some, own_a, own_b, strict=True):
            whole, x = (" " + text).encode(), np.frombuffer(x, "<u4").astype(np.int64)
            if b"".join([self.bytes_b[k] for k in y]) == whole and b"".join([self.bytes_a[k] for k in x.tolist()]) == whole:
                kept.append((i, x, np.array(y, np.int64)))
        a, b = (np.concatenate([k[j] for k in kept]) if kept else np.zeros(0, np.int64) for j in (1, 2))
        number = np.array([k[0] for k in kept], np.int64)
        text_a, text_b = (np.repeat(number, np.array([len(k[j]) for k in kept], np.int64)) for j in (1, 2))
        return Aligned(a, b, self.length_a[a], self.length_b[b], text_a, text_b)


DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_group_links long, groups_sha256 string"
BLOCKS = f"block long, {DOC}, pairs binary, times binary"


class Block:
    """Texts of a block, their pairs of ids by number, and all pairs with their counts."""

    def __init__(self, number: int) -> None:
        self.number, self.bytes = number, 0
        self.rows: list[tuple] = []
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, ids: list[int | None], aligned: Aligned) -> None:
        n = len(ids)
        links = aligned.overlaps()
        per_a, per_b = (np.bincount(t, minlength=n) for t in (aligned.text_a, aligned.text_b))
        row = np.repeat(np.arange(len(aligned.a)), np.diff(links.indptr))
        text = aligned.text_a[row]
        per_link = np.bincount(text, minlength=n)
        group_end = np.flatnonzero(np.diff(aligned.group_a, append=len(aligned.groups)))
        per_group = np.bincount(aligned.text_a[group_end], minlength=n)
        shared = np.bincount(aligned.text_a, aligned.group_links(), minlength=n).astype(np.int64)
        flat, ends = aligned.spelled()
        ends = np.append(ends, np.full(n + 1 - len(ends), ends[-1]))
        data = flat.tobytes()
        digests = [hashlib.sha256(data[ends[i] : ends[i + 1] - 1]).hexdigest() if ends[i + 1] > ends[i] else "" for i in range(n)]
        # Every text's different pairs and how often it has them.
        pair_bits = 2 * ID_BITS
        key = text << pair_bits | aligned.a[row] << ID_BITS | aligned.b[links.indices]
        key.sort()
        first = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.diff(np.append(first, len(key)))
        of_text, pair = key[first] >> pair_bits, key[first] & (1 << pair_bits) - 1
        self.parts.append((pair, times))
        edges = np.searchsorted(of_text, np.arange(n + 1))
        for i in range(n):
            own = slice(edges[i], edges[i + 1])
            self.rows.append((ids[i], int(per_a[i]), int(per_b[i]), int(per_group[i]), int(per_link[i]), int(shared[i]), digests[i], pair[own], times[own]))

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The texts' rows, and a row without counts for the block's own pairs."""
        keys = np.concatenate([p[0] for p in self.parts] or [np.zeros(0, np.int64)])
        kinds, index = np.unique(keys, return_inverse=True)
        counts = np.bincount(index, np.concatenate([p[1] for p in self.parts] or [np.zeros(0)]), minlength=len(kinds)).astype(np.int64)
        out = [(self.number, *r[:7], packed(np.searchsorted(kinds, r[7]).astype(np.int32)), _squeezed(r[8])) for r in self.rows]
        out.append((self.number, *[None] * 7, packed(kinds), _squeezed(counts)))
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        columns = [c.split() for c in BLOCKS.split(", ")]
        for low in range(0, len(out), 4096):
            part = list(zip(*out[low : low + 4096], strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(v, types[t]) for v, (_, t) in zip(part, columns, strict=True)], [c for c, _ in columns])


def _squeezed(numbers: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(numbers.astype(np.uint32).view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unsqueezed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view(np.uint32).ravel().astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], definition: str, model: bytes) -> Iterator[pa.RecordBatch]:
    tokenizers, task, n = Tokenizers(definition, model), TaskContext.get().partitionId(), 0
    block = Block(task << 32)
    for batch in batches:
        for part in pieces(batch, "text", PIECE):
            texts = part.column("text").to_pylist()
            block.add(part.column("doc_id").to_pylist(), tokenizers.align(texts))
            block.bytes += sum(len(t or "") for t in texts)
            if block.bytes > BLOCK:
                yield from block.batches()
                n += 1
                block = Block((task << 32) + n)
    if block.rows:
        yield from block.batches()


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block and pair of ids."""
    for batch in batches:
        for block, pairs, times in zip(*(batch.column(c).to_pylist() for c in ("block", "pairs", "times")), strict=True):
            keys = unpacked(pairs, np.int64)
            arrays = [np.full(len(keys), block), np.arange(len(keys), dtype=np.int32), keys & (1 << ID_BITS) - 1, keys, _unsqueezed(times)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["block", "number", "b", "pair", "n"])


PAIRS = "block long, number int, b long, pair long, n long"


def _summed(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Texts of a block with the counts of their links in all texts."""
    number = answers.column("number").to_numpy()
    total, best = np.zeros(len(number), np.int64), np.zeros(len(number), bool)
    total[number], best[number] = answers.column("total").to_numpy(), answers.column("best").to_numpy()
    sums, bests = [], []
    for pairs, times in zip(texts.column("pairs").to_pylist(), texts.column("times").to_pylist(), strict=True):
        own, n = unpacked(pairs, np.int32), _unsqueezed(times)
        sums.append(int((total[own] * n).sum()))
        bests.append(int((best[own] * n).sum()))
    kept = texts.drop_columns(["block", "pairs", "times"])
    return kept.append_column("n_best", pa.array(bests, pa.int64())).append_column("count_sum", pa.array(sums, pa.int64()))


def _definitions(a: str | None, b: str | None) -> tuple[str, bytes]:
    files = vocabulary_files()
    with open(a or files[0], encoding="utf-8") as one, open(b or files[1], "rb") as other:
        return one.read(), other.read()


def aligned(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """Per document the numbers of its tokens, groups and links, how common its links are, and the checksum of its groups.

    A text that is null, empty or not spelled in full by both tokenizers has
    zeros and no checksum.  Documents with the same or no doc_id are documents of
    their own; columns but doc_id and text are not read.
    """
    definition, model = _definitions(a, b)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    blocks = stored(rows.mapInArrow(partial(_blocks, definition=definition, model=model), BLOCKS), "aligned")
    asked = blocks.filter("n_a is null").select("block", "pairs", "times").mapInArrow(_pairs, PAIRS)
    totals = asked.groupBy("pair", "b").agg(F.sum("n").alias("total"))
    totals = stored(totals, "pair-counts")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    named = totals.join(most, "b").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = asked.select("block", "number", "pair").join(named, "pair").select("block", "number", "total", "best")
    texts = blocks.filter("n_a is not null")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_summed, f"{DOC}, n_best long, count_sum long").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"
    )


def _links(batches: Iterator[pa.RecordBatch], definition: str, model: bytes, groups: bool) -> Iterator[pa.RecordBatch]:
    tokenizers = Tokenizers(definition, model)
    for batch in batches:
        for part in pieces(batch, "text", PIECE):
            ids, own = np.array(part.column("doc_id").to_pylist(), object), tokenizers.align(part.column("text").to_pylist())
            first_a, first_b = (np.searchsorted(t, np.arange(part.num_rows)) for t in (own.text_a, own.text_b))
            n_bytes = int(own.bytes_a.sum())
            overlap = product_parts(Csr.spans(own.bytes_a), Csr.spans(own.bytes_b).transposed(n_bytes), len(own.b))
            for row, column, value in own.shared_groups() if groups else overlap:
                text = own.text_a[row]
                arrays = [pa.array(ids[text], pa.int64()), pa.array(row - first_a[text]), pa.array(column - first_b[text]), pa.array(own.a[row]), pa.array(own.b[column]), pa.array(value)]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "place_a", "place_b", "a", "b", "weight"])


def links(docs: DataFrame, groups: bool = False, a: str | None = None, b: str | None = None) -> DataFrame:
    """One row per link: places and ids of the two tokens, and the bytes they share, or with ``groups`` that they share one."""
    definition, model = _definitions(a, b)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    made = partial(_links, definition=definition, model=model, groups=groups)
    return rows.mapInArrow(made, "doc_id long, place_a long, place_b long, a long, b long, weight long")
