"""Packing of tokenised documents into sequences of a fixed number of tokens, as a cutting-stock problem.

A document longer than a sequence is cut into whole sequences and a rest; rests
and shorter documents are the pieces to combine.  Only how many pieces there are
of each length matters for that, so the problem has the size of a sequence,
whatever the number of documents.

A pattern is a set of lengths that fit a sequence together.  A linear program
over patterns takes every piece once and minimises the padded tokens.  Its
patterns are generated as needed: the program's dual values are prices of
lengths, and a knapsack recursion over exact fills finds the patterns that are
worth more than they cost.  A sequence whose fill is a power of two isn't padded
and costs its fill.

The whole parts of the solution are taken, then patterns of large fractions
while all their pieces are there, and what is left is filled piece by piece.
Pieces of a length are ranked through all tasks, and ranks become places in
sequences by arithmetic: nothing is collected but the histogram of lengths.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillspark.llm.tables import stored
from tillspark.llm.tokens import ByteTokens
from tillspark.llm.words import pieces

SEQUENCE, END = 2048, 1
#: The program ends when padding is below this share of all tokens, or when no pattern lowers it by as much.
SLACK = 3e-4
#: Patterns that one pricing may add, and those that the program may add in all; more would lower padding further.
PER_PRICING, MOST_PATTERNS = 40, 2000
#: How ids count for checksums.
ID = np.dtype("<u4")
#: Text bytes that a task tokenises at a time.
TEXT_BYTES = 1 << 20

CUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, block long, local_rank long"


def vocabulary_file() -> str:
    """The tokenizer used unless a caller names another: byte-level pairs of the public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@dataclass
class Pattern:
    """Pieces per length that share a sequence, and the number of sequences that are filled like that."""

    lengths: dict[int, int]
    times: int

    def fill(self) -> int:
        return sum(length * n for length, n in self.lengths.items())


def padded(fill: int, capacity: int) -> int:
    """Tokens that a sequence takes: all it could hold, unless its fill is a power of two."""
    return fill if fill & (fill - 1) == 0 else capacity


def _start(counts: dict[int, int], capacity: int) -> tuple[list[dict[int, int]], list[float]]:
    """Patterns that use up all pieces, the longest lengths first; each but the last uses up a length of its own.

    Together with a pattern of their own for lengths that end at the same time
    they are a basis: one for each length, independent of each other.
    """
    left = {length: float(counts[length]) for length in sorted(counts, reverse=True)}
    found, times, ended = [], [], set()
    order = np.array(list(left))
    alive = np.ones(len(order), bool)
    while alive.any():
        rest, own = capacity, {}
        while rest:
            fits = order[alive & (order <= rest)]
            fits = [x for x in fits[:1].tolist()] if not own else [x for x in fits.tolist() if left[x] > own.get(x, 0)][:1]
            if not fits:
                break
            length = fits[0]
            n = int(max(1, min(rest // length, left[length] - own.get(length, 0))))
            own[length] = own.get(length, 0) + n
            rest -= n * length
        t = min(left[x] / n for x, n in own.items())
        for x, n in own.items():
            left[x] -= t * n
        out = [x for x in own if left[x] <= 1e-9]
        found.append(own)
        times.append(t)
        for x in out[1:]:
            found.append({x: capacity // x})
            times.append(0.0)
        for x in out:
            alive[order == x] = False
            ended.add(x)
    return found, times


def _priced(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best worth of every exact fill, and the last length it is made of (0: no such fill)."""
    by_length = np.full(capacity + 1, -np.inf)
    by_length[lengths] = prices
    best, last = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, np.int64)
    best[0] = 0.0
    for fill in range(1, capacity + 1):
        worth = best[fill - 1 :: -1][:fill] + by_length[1 : fill + 1]
        k = int(worth.argmax())
        if worth[k] > -np.inf:
            best[fill], last[fill] = worth[k], k + 1
    return best, last


def _unwound(fill: int, last: np.ndarray) -> dict[int, int]:
    out: Counter = Counter()
    while fill:
        out[int(last[fill])] += 1
        fill -= int(last[fill])
    return dict(out)


def _new_patterns(prices: np.ndarray, lengths: np.ndarray, capacity: int, cost: np.ndarray) -> list[tuple[float, dict[int, int]]]:
    """Patterns worth more than they cost, the best first: the best of every fill, and the best full one with every length."""
    best, last = _priced(prices, lengths, capacity)
    found: dict[tuple, tuple[float, dict[int, int]]] = {}
    gains = best - cost
    fills = np.flatnonzero(gains > 1e-7)
    wanted = [(float(gains[f]), int(f), 0) for f in fills[np.argsort(-gains[fills])][:PER_PRICING]]
    with_each = best[capacity - lengths] + prices - cost[capacity]
    wanted += [(float(with_each[i]), int(capacity - lengths[i]), int(lengths[i])) for i in np.argsort(-with_each)[:PER_PRICING] if with_each[i] > 1e-7]
    for gain, fill, extra in wanted:
        own = Counter(_unwound(fill, last))
        if extra:
            own[extra] += 1
        found[tuple(sorted(own.items()))] = (gain, dict(own))
    return sorted(found.values(), key=lambda x: -x[0])[:PER_PRICING]


def _inverse(basis: list[dict[int, int]], at: dict[int, int]) -> np.ndarray:
    """Inverse of the matrix of starting patterns: each contains a length of its own that no later one has."""
    m = len(basis)
    own, seen = [0] * m, set()
    for k in range(m - 1, -1, -1):
        own[k] = next(length for length in basis[k] if length not in seen)
        seen.update(basis[k])
    within: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    for k, pattern in enumerate(basis):
        for length, n in pattern.items():
            within[at[length]].append((k, n))
    out = np.zeros((m, m))
    for k in range(m):
        row, mine = at[own[k]], 1
        out[k, row] = 1.0
        for j, n in within[row]:
            if j == k:
                mine = n
            else:
                out[k] -= n * out[j]
        out[k] /= mine
    return out


def linear_program(counts: dict[int, int], capacity: int) -> tuple[list[dict[int, int]], np.ndarray]:
    """Patterns and how often each is used, in fractions: the least padded tokens for all pieces, up to ``SLACK``.

    A revised simplex method with an explicit inverse of the basis.  Patterns
    have few lengths, so no step needs a product of matrices.
    """
    lengths = np.array(sorted(counts))
    at = {int(x): i for i, x in enumerate(lengths)}
    demand = np.array([counts[int(x)] for x in lengths], float)
    cost = np.array([padded(f, capacity) if f else 0 for f in range(capacity + 1)], float)

    def cost_of(own: dict[int, int]) -> float:
        return cost[sum(length * n for length, n in own.items())]

    def gain_of(own: dict[int, int]) -> float:
        return sum(prices[at[length]] * n for length, n in own.items()) - cost_of(own)

    basis, used = _start(counts, capacity)
    inverse = _inverse(basis, at)
    used = np.array(used)
    costs = np.array([cost_of(p) for p in basis])
    prices = (costs[:, None] * inverse).sum(axis=0)
    total = float((lengths * demand).sum())
    added, pool = 0, []
    while added < MOST_PATTERNS:
        now = float((costs * used).sum())
        if now <= total * (1 + SLACK):
            break
        pool = sorted(((gain_of(own), i, own) for i, (_, _, own) in enumerate(pool)), reverse=True, key=lambda x: x[:2])
        if not pool or pool[0][0] <= 1e-7:
            pool = [(gain, i, own) for i, (gain, own) in enumerate(_new_patterns(prices, lengths, capacity, cost))]
            # Prices lowered by the best gain are worth no more than any pattern costs: a bound on what is left to save.
            if not pool or now * (1 - 1 / (1 + pool[0][0] / min(capacity, max(1, int(lengths[0]))))) < SLACK * total:
                break
        gain, _, own = pool.pop(0)
        change = np.zeros(len(lengths))
        for length, n in own.items():
            change += n * inverse[:, at[length]]
        up = change > 1e-9
        if not up.any():
            continue
        ratio = np.full(len(change), np.inf)
        ratio[up] = used[up] / change[up]
        out = int(ratio.argmin())
        step = ratio[out]
        used = np.maximum(used - step * change, 0)
        used[out] = step
        basis[out], costs[out] = own, cost_of(own)
        row = inverse[out] / change[out]
        change[out] = 0
        moved = np.flatnonzero(np.abs(change) > 1e-12)
        inverse[moved] -= change[moved, None] * row
        inverse[out] = row
        prices = prices - gain * row
        added += 1
    return basis, used


def _filled(left: dict[int, int], capacity: int) -> dict[int, int]:
    """The longest piece left and those that fill the rest of a sequence best."""
    first = max(left)
    own, rest = Counter({first: 1}), capacity - first
    reach, steps = 1, []
    full = 1 << rest
    for length in sorted(left, reverse=True):
        n, k = left[length] - (length == first), 1
        while n > 0 and length * k <= rest and not reach & full:
            k = min(k, n)
            steps.append((length, k, reach))
            reach |= (reach << length * k) & ((full << 1) - 1)
            n, k = n - k, k * 2
        if reach & full:
            break
    fill = reach.bit_length() - 1
    for length, k, before in reversed(steps):
        if not before >> fill & 1:
            own[length] += k
            fill -= length * k
    return dict(own)


def whole_patterns(counts: dict[int, int], capacity: int = SEQUENCE) -> list[Pattern]:
    """Patterns with whole numbers of sequences that take every piece exactly once."""
    left = {length: n for length, n in counts.items() if n}
    if not left:
        return []
    basis, used = linear_program(left, capacity)
    taken: Counter = Counter()

    def take(own: dict[int, int], times: int) -> None:
        taken[tuple(sorted(own.items()))] += times
        for length, n in own.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]

    whole = np.floor(used + 1e-6).astype(np.int64)
    for own, times in zip(basis, whole.tolist(), strict=True):
        times = min([times, *(left.get(length, 0) // n for length, n in own.items())])
        if times:
            take(own, times)
    parts = used - whole
    for i in np.argsort(-parts, kind="stable").tolist():
        if parts[i] > 1e-6 and all(left.get(length, 0) >= n for length, n in basis[i].items()):
            take(basis[i], 1)
    while left:
        own = _filled(left, capacity)
        take(own, min(left[length] // n for length, n in own.items()))
    return [Pattern(dict(own), times) for own, times in taken.items()]


def _cut(batches: Iterator[pa.RecordBatch], definition: str, capacity: int) -> Iterator[pa.RecordBatch]:
    """Pieces of every document with the checksum of their ids, numbered per length within the task."""
    tokens, ranks, block = ByteTokens(definition, plain=False), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
    end = np.array([END], ID).tobytes()
    for batch in batches:
        for part in pieces(batch, "text", TEXT_BYTES):
            rows = []
            for doc, ids in zip(part.column("doc_id").to_pylist(), tokens.encode([t or "" for t in part.column("text").to_pylist()]), strict=True):
                ids += end
                n = len(ids) // ID.itemsize
                for start in range(0, n, capacity):
                    own = ids[start * ID.itemsize : (start + capacity) * ID.itemsize]
                    rows.append((doc, start, len(own) // ID.itemsize, zlib.crc32(own), n))
            columns = list(zip(*rows, strict=True))
            lengths = np.array(columns[2], np.int64)
            order = np.argsort(lengths, kind="stable")
            first = np.flatnonzero(np.diff(lengths[order], prepend=-1))
            within = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
            rank = np.empty(len(order), np.int64)
            rank[order] = within + ranks[lengths[order]]
            ranks += np.bincount(lengths, minlength=capacity + 1)
            arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array(np.full(len(rows), block)), pa.array(rank)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "block", "local_rank"])


def _segments(patterns: list[Pattern]) -> np.ndarray:
    """Which ranks of a length go to which sequences: length, first rank, first sequence, pieces per sequence, their offset."""
    ranks: Counter = Counter()
    rows, sequence = [], 0
    for pattern in patterns:
        offset = 0
        for length, n in sorted(pattern.lengths.items(), reverse=True):
            rows.append((length, ranks[length], sequence, n, offset))
            ranks[length] += n * pattern.times
            offset += n * length
        sequence += pattern.times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placed(batches: Iterator[pa.RecordBatch], segments: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of every piece from its rank among those of its length."""
    groups = {int(x): segments[segments[:, 0] == x] for x in np.unique(segments[:, 0])}
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        first = np.flatnonzero(np.diff(length[order], prepend=-1))
        for own in np.split(order, first[1:]):
            if len(own):
                of = groups[int(length[own[0]])]
                _, low, base, n, at = of[np.searchsorted(of[:, 1], rank[own], "right") - 1].T
                sequence[own] = base + (rank[own] - low) // n
                offset[own] = at + (rank[own] - low) % n * length[own]
        kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*PACKED])


PACKED = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def packed(docs: DataFrame, vocabulary: str | None = None, capacity: int = SEQUENCE) -> DataFrame:
    """One row per piece of a document: where it starts and ends, the checksum of its ids, its sequence and place there.

    Every document ends with the id ``END``; a null or empty text has only that.
    Documents with the same or no doc_id are documents of their own, and columns
    but doc_id and text are not read.  An empty table gives no rows.
    """
    with open(vocabulary or vocabulary_file(), encoding="utf-8") as file:
        definition = file.read()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    cut = stored(rows.mapInArrow(partial(_cut, definition=definition, capacity=capacity), CUT), "pieces")

    # At most one row per task and length; the sums are one row per length.
    counts = stored(cut.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    segments = _segments(whole_patterns(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("block", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["block", "length"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    placed = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    return placed.mapInArrow(partial(_placed, segments=segments), ", ".join(f"{c} long" for c in PACKED))
