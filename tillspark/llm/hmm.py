"""Hidden Markov language model over words, trained by Baum-Welch counts from all partitions.

A hidden state emits a symbol per token.  The most frequent words, and the end of
a text, are symbols of their own; every other word is emitted through the class of
its ending, and then with its share of that class, (c + 1) of (N + V + 1) for the
class's training tokens N and different words V, which leaves room for unknown
words.  So a text's probability is that of its symbols under the hidden Markov
model times the shares of its rarer words.

Words are counted exactly: every block of documents sends its different words to
the tasks for their ranges of hashes, and is answered with their counts.  Words
are known by 64-bit hashes.  Every round of Baum-Welch covers all training texts,
whose symbols are written once: each task sums expected counts, and Spark adds them
up, until the likelihood settles.  There texts are cut into stretches of SEGMENT
tokens.  Scoring cuts nothing: a scaled forward recursion
runs over whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.blocks import in_blocks, packed, unpacked
from tillspark.llm.language_id import remainder
from tillspark.llm.tables import stored
from tillspark.llm.words import bytes_of, mix, pieces, word_hashes, words_of

STATES = 8
#: Words that are symbols of their own, and classes of endings for the others.
TOP_WORDS, CLASSES = 2048, 512
SEGMENT = 256
#: Stretches that a task holds in memory at a time.
TOGETHER = 2048
#: Training ends when so many rounds in a row have each raised the log probability of a symbol by less: one alone may be a saddle.
SETTLED, CALM = 1e-5, 3
#: Scales of the forward recursion whose product stays a normal number: after 1e13 training tokens the least is about 1e-24.
LOGS = 8
#: Tokens that every state is taken to have emitted besides, at the symbols' shares.
SMOOTH = 100.0
#: Different words that a task for a range of hashes counts, about.
PART_WORDS = 1 << 19
BYTES_PER_WORD = 6


@dataclass
class Symbols:
    """Symbols of words: sorted hashes of the top words, then the end, then the classes; classes' training tokens and words."""

    top: np.ndarray
    tokens: np.ndarray
    words: np.ndarray

    @property
    def end(self) -> int:
        return len(self.top)

    @property
    def n(self) -> int:
        return len(self.top) + 1 + CLASSES

    def of(self, hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Symbol of every word."""
        if not len(self.top):
            return self.end + 1 + classes
        at = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
        return np.where(self.top[at] == hashes, at, self.end + 1 + classes)


@dataclass
class Model:
    """Chances of the first state, of the next state by state, and of each symbol (row) by state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def tokens(column: pa.Array):
    """Words of a column in lower case: spans, hashes, and the class of each word's last two bytes and length."""
    words = words_of(column, lower=True)
    if not len(words.starts):
        return words, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    length = words.ends - words.starts
    last = words.buf[words.ends - 1].astype(np.uint64)
    before = np.where(length > 1, words.buf[words.ends - np.minimum(length, 2)], 0).astype(np.uint64)
    kind = mix(last * np.uint64(256) + before + (np.minimum(length, 12) // 4).astype(np.uint64) * np.uint64(65536))
    return words, word_hashes(words), (kind % np.uint64(CLASSES)).astype(np.int64)


COUNTED = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("hash", pa.binary()), ("class", pa.binary()), ("n", pa.binary())])
TOTALS = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("n", pa.binary()), ("stats", pa.binary()), ("top", pa.binary())])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _different(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, class and training count of every different word of a block, by hash."""
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for piece in pieces(table, "text"):
        words, hashes, classes = tokens(piece.column("text"))
        learn = np.repeat(np.array(piece.column("learn"), bool), words.per_text())
        kinds, first, index = np.unique(hashes, return_index=True, return_inverse=True)
        found.append((kinds, classes[first], np.bincount(index, learn, len(kinds)).astype(np.int64)))
    hashes, classes, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    kinds, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    return kinds, classes[first], np.bincount(index, counts, len(kinds)).astype(np.int64)


def _edges(hashes: np.ndarray, parts: int) -> np.ndarray:
    part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1))


def _count(table: pa.Table, parts: int) -> pa.Table:
    block = table.column("block")[0].as_py()
    hashes, classes, counts = _different(table)
    edges = _edges(hashes, parts)
    rows = []
    for p in range(parts):
        cut = slice(edges[p], edges[p + 1])
        if cut.start < cut.stop:
            rows.append((p, block, packed(hashes[cut]), packed(classes[cut].astype(np.int16)), packed(counts[cut].astype(np.int32))))
    return _rows(COUNTED, rows)


def _total(table: pa.Table) -> pa.Table:
    """Add up one range of hashes; answer each block with its words' totals.

    The first row also has the range's training tokens and words by class, and
    its most frequent words with count and class.
    """
    asked = [[unpacked(d, t) for d in table.column(c).to_pylist()] for c, t in (("hash", np.uint64), ("class", np.int16), ("n", np.int32))]
    hashes, classes, counts = (np.concatenate(x) for x in asked)
    kinds, first, index = np.unique(hashes, return_index=True, return_inverse=True)
    totals = np.bincount(index, counts, len(kinds)).astype(np.int64)
    classes = classes[first].astype(np.int64)
    stats = np.stack([np.bincount(classes, totals, CLASSES), np.bincount(classes, totals > 0, CLASSES)]).astype(np.int64)
    known = np.flatnonzero(totals)
    best = known[np.lexsort((kinds[known], -totals[known]))[:TOP_WORDS]]
    top = np.stack([kinds[best].view(np.int64), totals[best], classes[best]]) if len(best) else np.zeros((3, 0), np.int64)
    ends = np.append(0, np.cumsum([len(h) for h in asked[0]]))
    part = table.column("part")[0].as_py()
    rows = []
    for k, block in enumerate(table.column("block").to_pylist()):
        n = totals[index[ends[k] : ends[k + 1]]]
        rows.append((part, block, packed(n), stats.tobytes() if not k else None, top.tobytes() if not k else None))
    return _rows(TOTALS, rows)


def _symbols(totals: DataFrame) -> tuple[Symbols, int, int]:
    """Symbols, training words and different training words, from what the ranges of hashes have reported."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, tops = np.zeros((2, CLASSES), np.int64), [np.zeros((3, 0), np.int64)]
        for batch in batches:
            for one, top in zip(batch.column("stats").to_pylist(), batch.column("top").to_pylist(), strict=True):
                stats += np.frombuffer(one, np.int64).reshape(2, -1)
                tops.append(np.frombuffer(top, np.int64).reshape(3, -1))
            tops = [best(np.concatenate(tops, axis=1))]
        yield pa.RecordBatch.from_arrays([pa.array([stats.tobytes()]), pa.array([tops[0].tobytes()])], ["stats", "top"])

    def best(top: np.ndarray) -> np.ndarray:
        return top[:, np.lexsort((top[0], -top[1]))[:TOP_WORDS]]

    reports = totals.filter("stats is not null").select("stats", "top").mapInArrow(add, "stats binary, top binary")
    stats, top = np.zeros((2, CLASSES), np.int64), np.zeros((3, 0), np.int64)
    for row in reports.toLocalIterator():
        stats = stats + np.frombuffer(bytes(row["stats"]), np.int64).reshape(2, -1)
        top = best(np.concatenate([top, np.frombuffer(bytes(row["top"]), np.int64).reshape(3, -1)], axis=1))
    in_classes = stats - np.stack([np.bincount(top[2], top[1], CLASSES), np.bincount(top[2], minlength=CLASSES)]).astype(np.int64)
    return Symbols(np.sort(top[0].view(np.uint64)), *in_classes), int(stats[0].sum()), int(stats[1].sum())


def sequences(column: pa.Array, symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts one after the other, each with its end, and the positions where texts begin."""
    words, hashes, classes = tokens(column)
    return with_ends(symbols.of(hashes, classes), words.per_text(), symbols.end)


def with_ends(own: np.ndarray, n: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Words' symbols of texts of n words each, with an end after each text, and the positions where texts begin."""
    first = np.append(0, np.cumsum(n + 1))
    out = np.full(int(first[-1]), end, np.int64)
    out[np.arange(len(own)) + np.repeat(np.arange(len(n)), n)] = own
    return out, first


def segments(sequence: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of up to SEGMENT symbols: a padded row each, its length, and whether a text begins there."""
    n = np.diff(first)
    parts = -(-n // SEGMENT)
    of = np.repeat(np.arange(len(n)), parts)
    nth = np.arange(len(of)) - np.repeat(np.append(0, np.cumsum(parts)[:-1]), parts)
    begin = first[of] + nth * SEGMENT
    length = np.minimum(SEGMENT, first[of + 1] - begin)
    order = np.argsort(-length, kind="stable")
    begin, length, nth = begin[order], length[order], nth[order]
    at = begin[:, None] + np.arange(int(length.max(initial=0)))
    return sequence[np.minimum(at, len(sequence) - 1)], length, nth == 0


def baum_welch(model: Model, rows: np.ndarray, length: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected first states, moves and emissions of padded stretches, longest first."""
    return expected_counts(model, rows, length, begins)[:3]


def expected_counts(model: Model, rows: np.ndarray, length: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected first states, moves and emissions of padded stretches, longest first, and the log of their probability.

    Emissions are divided by each symbol's scale on the way ahead, so that the
    products of both ways are chances without further scaling.
    """
    k = len(model.start)
    starts, moves, emissions, chance = np.zeros(k), np.zeros((k, k)), np.zeros((len(model.emit), k)), 0.0
    rest = (model.start @ np.linalg.matrix_power(model.move, 8)).astype(np.float32)
    first, emit = np.where(begins, model.start.astype(np.float32)[:, None], rest[:, None]), np.ascontiguousarray(model.emit.T, np.float32)
    move, ones = model.move.astype(np.float32), np.ones(k, np.float32)
    turned = np.ascontiguousarray(move.T)
    for low in range(0, len(rows), TOGETHER):
        own = length[low : low + TOGETHER]
        n, width = len(own), int(own[0])
        symbols = np.ascontiguousarray(rows[low : low + n, :width].T, np.intp)
        live = np.searchsorted(-own, -np.arange(width), "left")  # rows that are longer than t
        seen, ahead, scales = np.empty((width, k, n), np.float32), np.zeros((width, k, n), np.float32), np.ones((width, n), np.float32)
        state = first[:, low : low + n]
        for t in range(width):
            m = live[t]
            now, at, scale = ahead[t, :, :m], seen[t, :, :m], scales[t, :m]
            np.take(emit, symbols[t, :m], axis=1, out=at, mode="clip")
            np.multiply(state[:, :m], at, out=now)
            np.maximum(ones @ now, np.float32(1e-30), out=scale)
            now /= scale
            at /= scale
            state = turned @ now
        chance += float(np.log(scales).sum(dtype=np.float64))
        back = np.ones((k, n), np.float32)
        for t in range(width - 1, 0, -1):
            m = live[t]
            ahead[t, :, :m] *= back[:, :m]
            after = seen[t, :, :m]
            after *= back[:, :m]
            moves += ahead[t - 1, :, :m] @ after.T
            back[:, :m] = move @ after
        ahead[0] *= back
        starts += ahead[0][:, begins[low : low + n]].sum(axis=1, dtype=np.float64)
        flat = symbols.ravel()
        for j in range(k):
            emissions[:, j] += np.bincount(flat, ahead[:, j].ravel(), len(emissions))
    return starts, moves * model.move, emissions, chance


def improved(starts: np.ndarray, moves: np.ndarray, emissions: np.ndarray) -> Model:
    """Model with the most likely chances for expected counts, smoothed so that everything stays possible."""
    share = (emissions.sum(axis=1) + 1) / (emissions.sum() + len(emissions))
    emissions = emissions + SMOOTH * share[:, None]
    starts, moves = starts + 1, moves + 1
    return Model(starts / starts.sum(), moves / moves.sum(axis=1, keepdims=True), emissions / emissions.sum(axis=0))


def first_model(symbols: Symbols, states: int) -> Model:
    """Model that knows nothing: states stay likely, and emissions differ at random."""
    draw = np.random.Generator(np.random.PCG64(3))
    move = np.full((states, states), 0.05 / max(1, states - 1))
    np.fill_diagonal(move, 0.95)
    emit = draw.random((symbols.n, states)) + 0.5
    return Model(np.full(states, 1 / states), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _encoded(batches: Iterator[pa.RecordBatch], symbols: Symbols) -> Iterator[pa.RecordBatch]:
    """Symbols of every text, as numbers of two bytes."""
    for batch in batches:
        for piece in pieces(batch, "text", 1 << 20):
            sequence, first = sequences(piece.column("text"), symbols)
            data = pa.py_buffer(sequence.astype(np.int16).tobytes())
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), piece.num_rows, [None, pa.py_buffer((2 * first).astype(np.int64).tobytes()), data])
            yield pa.RecordBatch.from_arrays([column.cast(pa.binary())], ["symbols"])


def _expected(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Baum-Welch counts of a task's texts and the log of their probability, as places and values of one vector."""
    k = len(model.start)
    total = np.zeros(k + k * k + len(model.emit) * k + 1)
    for batch in batches:
        for piece in pieces(batch, "symbols", 1 << 20):
            buf, offsets = bytes_of(piece.column("symbols"))
            found = expected_counts(model, *segments(buf.view(np.int16), offsets // 2))
            total += np.concatenate([np.ravel(x) for x in found])
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], ["place", "value"])


def train(texts: DataFrame, n: int, symbols: Symbols, states: int = STATES, settled: float = SETTLED) -> Model:
    """Train on n rows (text) until CALM rounds in a row each raise the log probability of a symbol by less than ``settled``; without texts, the model that knows nothing."""
    model, k = first_model(symbols, states), states
    if not n:
        return model
    encoded = stored(texts.select("text").mapInArrow(partial(_encoded, symbols=symbols), "symbols binary"), "symbols")
    before, calm = -math.inf, 0
    while calm < CALM:
        sums = encoded.mapInArrow(partial(_expected, model=model), "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
        total = np.zeros(k + k * k + symbols.n * k + 1)
        total[sums.column("place").to_numpy()] = sums.column("value").to_numpy()
        starts, moves, emissions = total[:k], total[k : k + k * k].reshape(k, k), total[k + k * k : -1].reshape(-1, k)
        model = improved(starts, moves, emissions)
        chance = total[-1] / emissions.sum()
        calm = calm + 1 if chance - before < settled else 0
        before = chance
    return model


def log10_forward(model: Model, sequence: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 probability of every whole sequence: forward recursion, scaled to sum 1 after each symbol.

    Texts are columns and states rows; the logarithms of up to LOGS scales are taken at once, from their product.
    """
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    begin, n = first[:-1][order], length[order]
    width = int(n.max(initial=0))
    live = np.searchsorted(-n, -np.arange(width), "left")
    emit, turned = np.ascontiguousarray(model.emit.T), np.ascontiguousarray(model.move.T)
    out, scales, ones = np.zeros(len(n)), np.ones(len(n)), np.ones(len(model.start))
    state = np.repeat(model.start[:, None], len(n), axis=1)
    for t in range(width):
        m = live[t]
        now = np.take(emit, sequence[begin[:m] + t], axis=1, mode="clip")
        now *= state[:, :m]
        scale = ones @ now
        scales[:m] *= scale
        if t % LOGS == LOGS - 1:
            out += np.log10(scales)
            scales[:] = 1
        now /= scale
        state = turned @ now
    out += np.log10(scales)
    back = np.empty_like(out)
    back[order] = out
    return back


SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(table: pa.Table, answers: pa.Table, model: Model, symbols: Symbols, n: int, v: int, ends: int) -> pa.Table:
    """Scores of a block's texts, for which ``answers`` have the counts of its different words."""
    if not table.num_rows:
        return pa.table({c.split()[0]: pa.array([], pa.int64() if "long" in c else pa.float64()) for c in SCORED.split(", ")})
    known = dict(zip(answers.column("part").to_pylist(), answers.column("n").to_pylist(), strict=True))
    read = []
    for piece in pieces(table, "text"):
        words, own, classes = tokens(piece.column("text"))
        read.append((words.per_text(), own, classes.astype(np.int16)))
    hashes = np.unique(np.concatenate([own for _, own, _ in read]))
    counts = np.concatenate([np.zeros(0, np.int64), *(unpacked(known[p], np.int64) for p in sorted(known))])
    share = np.log10(symbols.tokens + symbols.words + 1.0)
    out = []
    for n_words, own, classes in read:
        symbol = symbols.of(own, classes)
        count = counts[np.searchsorted(hashes, own)]
        log = np.log10(count + 1.0)
        rare = np.where(symbol > symbols.end, log - share[classes], 0.0)
        edges = np.append(0, np.cumsum(n_words))
        per = lambda x: np.diff(np.append(0, np.cumsum(x))[edges])
        n_tokens = n_words + 1
        base = per(log) + math.log10(ends + 1) - n_tokens * math.log10(n + v + 1)
        chance = log10_forward(model, *with_ends(symbol, n_words, symbols.end))
        out.append((n_tokens, per(count > 0) + (ends > 0), base, chance + per(rare)))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)]
    names = [c.split()[0] for c in SCORED.split(", ")]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    return pa.table([table.column("id"), *(pa.array(c, t) for c, t in zip(columns, types[1:], strict=True))], names=names)


def scored(docs: DataFrame, folds: int = 7, held_out: int = 2) -> DataFrame:
    """Scores of all documents by models of those outside of the held-out fold.

    doc_id, held_out, n_tokens and n_known (the end counts as a token),
    train_tokens, base_score (words alone) and score, log10 probabilities.  A
    null text is empty: its only token is the end.  A null doc_id is not held out.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("id"), "text", (remainder(F.col("doc_id"), folds) != held_out).alias("learn"))
    own = own.withColumn("n_bytes", F.octet_length("text").cast("long"))
    table = in_blocks(own, ["id", "text", "learn", "n_bytes"])
    facts = table.agg(F.sum("n_bytes"), F.sum(F.col("learn").cast("long"))).first()
    parts = max(1, -(-(facts[0] or 0) // BYTES_PER_WORD // PART_WORDS // 4))
    ends = int(facts[1] or 0)

    read = table.select("id", "text", "learn", "block")
    counted = read.groupBy("block").applyInArrow(lambda own: _count(own, parts), _ddl(COUNTED))
    totals = stored(counted.groupBy("part").applyInArrow(_total, _ddl(TOTALS)), "word-totals")
    symbols, words, different = _symbols(totals)
    learn = table.filter("learn").select(F.coalesce("text", F.lit("")).alias("text"))
    model = train(learn, ends, symbols)

    n, v = words + ends, different + (ends > 0)

    def score(own: pa.Table, answered: pa.Table) -> pa.Table:
        return _score(own, answered, model, symbols, n, v, ends)

    answers = totals.select("part", "block", "n")
    rows = read.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORED)
    return rows.select(
        "doc_id", (remainder(F.col("doc_id"), folds) == held_out).alias("held_out"), "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
    )
