"""Language identification by piece probabilities, summed over all segmentations.

Every language has its own probabilities for the pieces of one fixed public
vocabulary.  The probability of a word in a language is the sum over all ways to
cut it into pieces, which a forward algorithm computes; a text's is the product
over its words.  The probabilities are trained by expectation-maximisation: the
expected number of times each piece is used, over all segmentations of all words
of the training texts, from forward and backward sums.

Words are lower-cased in A-Z and start with a space, as the vocabulary's do.
Pieces of up to MAX_PIECE bytes count; single bytes are among them, so every
text has segmentations.  A word longer than MAX_WORD bytes is cut there.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.words import pieces, word_hashes, words_of

MAX_PIECE, MAX_WORD = 10, 28
#: Rounds over a sample of about so many training texts, chosen by hash, and then over all of them.
SAMPLE_TEXTS, SAMPLE_ROUNDS, ROUNDS = 20_000, 2, 1
#: Pseudo-count of every piece in every language.
SMOOTH = 0.05
#: Different words that a task keeps at a time.
KNOWN_WORDS = 300_000
#: Words that are cut into pieces at a time.
GROUP_WORDS = 50_000
UNKNOWN = "und"


def vocabulary_file() -> str:
    """The vocabulary used unless a caller names another: byte-level pieces for many languages."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def load_vocabulary(path: str) -> list[bytes]:
    """Pieces of a vocabulary file with one base64 piece and rank a line; those that no word can have are left out."""
    with open(path, "rb") as lines:
        found = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    gaps = b" \t\n\r\x0b\x0c"
    usable = {p.lower() for p in found if len(p) <= MAX_PIECE and not any(b in gaps for b in p[1:]) and p[:1] not in (b"\t", b"\n", b"\r", b"\x0b", b"\x0c")}
    return sorted(usable | {bytes([b]) for b in range(256)})


class Beginnings:
    """Beginnings that sorted byte strings have in common, each once, in places by length and order; the empty one is place 0."""

    def __init__(self, strings: list[bytes]) -> None:
        self.lengths = np.array([len(x) for x in strings], np.int64)
        longest = int(self.lengths.max(initial=0))
        inside = np.arange(longest) < self.lengths[:, None]
        codes = np.zeros(inside.shape, np.int16)
        codes[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
        new = np.ones(inside.shape, bool)
        np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1, out=new[1:])
        new = np.ascontiguousarray((new & inside).T)
        rows = [np.flatnonzero(x) for x in new]
        #: Number of every string's beginning among those of a length.
        self.number = np.cumsum(new, axis=1, dtype=np.int32) - 1
        #: Beginnings of ``n`` bytes have the places ``base[n]`` to ``base[n + 1]``.
        self.base = np.cumsum([0, 1, *map(len, rows)])
        #: For the beginnings of ``n + 1`` bytes: the last byte, and the number of the beginning without it.
        self.last = [codes[r, n] - 1 for n, r in enumerate(rows)]
        self.without = [self.number[n - 1, r] if n else np.zeros(len(r), np.int32) for n, r in enumerate(rows)]

    def whole(self) -> np.ndarray:
        """Place of every string."""
        out = np.zeros(len(self.lengths), np.int64)
        some = np.flatnonzero(self.lengths)
        size = self.lengths[some]
        out[some] = self.base[size] + self.number[size - 1, some]
        return out


class Lookup:
    """Pieces byte by byte: from a beginning of pieces (0 is the empty one) and a byte to the next, and the piece that it is."""

    def __init__(self, vocabulary: list[bytes]) -> None:
        order = sorted(range(len(vocabulary)), key=vocabulary.__getitem__)
        tree = Beginnings([vocabulary[i] for i in order])
        size = int(tree.base[-1])
        byte = np.concatenate([[0], *tree.last]).astype(np.int64)
        without = np.concatenate([[0], *(tree.base[n] + x for n, x in enumerate(tree.without))])
        # Beginnings that go on are named first; all others share one row of steps, which leads to none.
        goes_on = np.zeros(size, bool)
        goes_on[without] = True
        self.rows = int(goes_on.sum())
        name = np.empty(size, np.int64)
        name[goes_on], name[~goes_on] = np.arange(self.rows), np.arange(self.rows, size)
        self.steps = np.full((self.rows + 1) * 256, size, np.int32)
        self.steps[name[without[1:]] * 256 + byte[1:]] = name[1:]
        self.piece = np.full(size + 1, -1, np.int32)
        self.piece[name[tree.whole()]] = order

    def step(self, at: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return self.steps.take(np.minimum(at, self.rows) * 256 + byte)


@dataclass
class Model:
    """Languages in order, the vocabulary, and the probability of each piece in each language."""

    languages: list[str]
    vocabulary: list[bytes]
    chances: np.ndarray


class Words:
    """Different words, and where which piece fits: for every end and length, the beginnings of words and the pieces.

    The sum over the ways to cut a beginning is the same in all words that begin
    so, and expected uses add up over words: each beginning is treated once.
    """

    def __init__(self, words: list[bytes], lookup: Lookup) -> None:
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        tree = Beginnings([words[i] for i in order.tolist()])
        self.base, self.n = tree.base, len(words)
        self.ends = np.empty(self.n, np.int64)
        self.ends[order] = tree.whole()
        self.longest = len(tree.last)
        # The places of beginnings that end with a piece and of what is before it, and the piece.
        self.fits: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for begin in range(self.longest):
            part = np.arange(self.base[begin], self.base[begin + 1])
            at = np.zeros(len(part), np.int32)
            for end in range(begin + 1, min(begin + MAX_PIECE, self.longest) + 1):
                without = tree.without[end - 1]
                at, part = lookup.step(at.take(without), tree.last[end - 1]), part.take(without)
                piece = lookup.piece.take(at)
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    self.fits[end, end - begin] = (self.base[end] + hit, part.take(hit), piece.take(hit))

    def forward(self, chances: np.ndarray) -> np.ndarray:
        """Sum over segmentations of every beginning, by language: (beginning, language)."""
        out = np.zeros((self.base[-1], chances.shape[1]))
        out[0] = 1
        for end in range(1, self.longest + 1):
            for size in range(1, min(MAX_PIECE, end) + 1):
                if (end, size) in self.fits:
                    whole, part, piece = self.fits[end, size]
                    out[whole] += out.take(part, axis=0) * chances.take(piece, axis=0)
        return out

    def whole(self, forward: np.ndarray) -> np.ndarray:
        return forward[self.ends]

    def used(self, chances: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece by language, for words that occur ``counts`` (word, language) times."""
        ahead = self.forward(chances)
        total = self.whole(ahead)
        share = np.divide(counts, total, out=np.zeros_like(total), where=total > 0)
        languages = range(chances.shape[1])
        back = np.stack([np.bincount(self.ends, share[:, k], len(ahead)) for k in languages], axis=1)
        out = np.zeros_like(chances)
        for end in range(self.longest, 0, -1):
            used, flows = [], []
            for size in range(1, min(MAX_PIECE, end) + 1):
                if (end, size) in self.fits:
                    whole, part, piece = self.fits[end, size]
                    flow = back.take(whole, axis=0) * chances.take(piece, axis=0)
                    # Beginnings with the same part stand side by side.
                    first = np.flatnonzero(np.diff(part, prepend=-1))
                    back[part[first]] += np.add.reduceat(flow, first, axis=0)
                    flow *= ahead.take(part, axis=0)
                    used.append(piece)
                    flows.append(flow)
            if used:
                piece, flow = np.concatenate(used), np.concatenate(flows)
                for k in languages:
                    out[:, k] += np.bincount(piece, flow[:, k], len(chances))
        return out


def words_in(column: pa.Array):
    """Words of a column in lower case, cut at MAX_WORD - 1 bytes: spans, hashes and number per text."""
    words = words_of(column, lower=True)
    lengths = words.ends - words.starts
    room = MAX_WORD - 1
    if len(lengths) and lengths.max() > room:
        parts = -(-lengths // room)
        of = np.repeat(np.arange(len(lengths)), parts)
        nth = np.arange(len(of)) - np.repeat(np.append(0, np.cumsum(parts)[:-1]), parts)
        words.starts, words.ends = words.starts[of] + nth * room, np.minimum(words.starts[of] + (nth + 1) * room, words.ends[of])
        words.first = np.searchsorted(of, words.first)
    return words, word_hashes(words)


def different(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different hashes, the first place of each, and for every place the number of its hash."""
    coded = pa.array(hashes).dictionary_encode()
    index = coded.indices.to_numpy().astype(np.int64)
    first = np.empty(len(coded.dictionary), np.int64)
    first[index[::-1]] = np.arange(len(index))[::-1]
    return coded.dictionary.to_numpy(), first, index


def places(kinds: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Place of each hash in ``seen``, -1 where it is not there."""
    return pc.fill_null(pc.index_in(pa.array(kinds), value_set=pa.array(seen)), -1).to_numpy().astype(np.int64)


def spelled(words, at: np.ndarray) -> list[bytes]:
    data = words.buf.tobytes()
    return [b" " + data[s:e] for s, e in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]


def _expected(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Expected uses of pieces by language in a task's texts."""
    lookup, size = Lookup(model.vocabulary), len(model.languages)
    uses = np.zeros((len(model.vocabulary), size))
    seen = np.zeros(0, np.uint64)
    words_seen: list[bytes] = []
    counts = np.zeros((0, size))

    def flush() -> None:
        nonlocal seen, counts
        # In order, so that words with the same beginnings come together.
        order = sorted(range(len(words_seen)), key=words_seen.__getitem__)
        for low in range(0, len(order), GROUP_WORDS):
            cut = order[low : low + GROUP_WORDS]
            uses[:] += Words([words_seen[i] for i in cut], lookup).used(model.chances, counts[cut])
        seen = seen[:0]
        words_seen.clear()
        counts = np.zeros((0, size))

    for batch in batches:
        for piece in pieces(batch, "text"):
            words, hashes = words_in(piece.column("text"))
            language = np.repeat(np.array(piece.column("language"), np.int64), words.per_text())
            kinds, first, index = different(hashes)
            own = np.bincount(index * size + language, minlength=len(kinds) * size).reshape(-1, size)
            place = places(kinds, seen)
            new = np.flatnonzero(place < 0)
            place[new] = len(words_seen) + np.arange(len(new))
            seen = np.concatenate([seen, kinds[new]])
            words_seen += spelled(words, first[new])
            counts = np.concatenate([counts, np.zeros((len(new), size))])
            counts[place] += own
            if len(words_seen) >= KNOWN_WORDS:
                flush()
    flush()
    at, language = np.nonzero(uses)
    yield pa.RecordBatch.from_arrays([pa.array(language, pa.int32()), pa.array(at, pa.int32()), pa.array(uses[at, language])], ["language", "piece", "uses"])


def train(docs: DataFrame, vocabulary: list[bytes], sample_texts: int = SAMPLE_TEXTS) -> Model:
    """Train on documents (text, lang); rows with a null in either teach nothing.

    The first rounds, which only lead from equal chances to likely ones, see a
    sample; the last one counts all texts.  The driver holds one number per
    piece and language.
    """
    rows = docs.select("text", "lang").dropna()
    texts_of = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(texts_of)
    model = Model(languages, vocabulary, np.full((len(vocabulary), len(languages)), 1 / len(vocabulary)))
    if not languages:
        return model
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    # Every language has its part of the sample, and all of its texts if they are few.
    wanted = sample_texts / len(languages)
    chance = F.element_at(F.array(*[F.lit(wanted / texts_of[g]) for g in languages]), (F.col("language") + 1))
    rows = rows.select("text", number.cast("int").alias("language"))
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < chance * (1 << 20))
    for texts in [sample] * SAMPLE_ROUNDS + [rows] * ROUNDS:
        uses = texts.mapInArrow(partial(_expected, model=model), "language int, piece int, uses double")
        sums = uses.groupBy("language", "piece").agg(F.sum("uses").alias("uses")).toArrow()
        table = np.full(model.chances.shape, SMOOTH)
        table[sums.column("piece").to_numpy(), sums.column("language").to_numpy()] += sums.column("uses").to_numpy()
        model = Model(languages, vocabulary, table / table.sum(axis=0))
    return model


def _scores(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Language and posterior of every text, for equally likely languages."""
    lookup, known = Lookup(model.vocabulary), np.zeros(0, np.uint64)
    logs = np.zeros((0, len(model.languages)))
    names = np.array([*model.languages, UNKNOWN], object)
    for batch in batches:
        for piece in pieces(batch, "text"):
            words, hashes = words_in(piece.column("text"))
            kinds, first, index = different(hashes)
            if len(known) > KNOWN_WORDS:
                known, logs = known[:0], logs[:0]
            place = places(kinds, known)
            new = np.flatnonzero(place < 0)
            place[new] = len(logs) + np.arange(len(new))
            known = np.concatenate([known, kinds[new]])
            for low in range(0, len(new), GROUP_WORDS):
                group = Words(spelled(words, first[new[low : low + GROUP_WORDS]]), lookup)
                logs = np.concatenate([logs, np.log(np.maximum(group.whole(group.forward(model.chances)), 1e-300))])
            total = np.concatenate([np.zeros((1, logs.shape[1])), np.cumsum(logs[place[index]], axis=0)])
            total = total[words.first[1:]] - total[words.first[:-1]]
            letters = np.array(piece.column("letters"), bool) if piece.num_rows else np.zeros(0, bool)
            some = letters & (len(model.languages) > 0)
            if len(model.languages):
                best = total.argmax(axis=1)
                score = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            else:
                best, score = np.zeros(piece.num_rows, np.int64), np.zeros(piece.num_rows)
            found = pa.array(names[np.where(some, best, len(model.languages))], pa.string())
            yield pa.RecordBatch.from_arrays([piece.column("id"), found, pa.array(np.where(some, score, 0.0))], ["doc_id", "lang_pred", "score"])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every document: the most probable language and its posterior, by the text alone.

    A text that is null or without a letter, and any text for a model of no
    language, is `und` with score 0.  Of equally probable languages the first in
    order of code points is given.
    """
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text", letters.alias("letters"))
    return rows.mapInArrow(partial(_scores, model=model), "doc_id long, lang_pred string, score double")


def remainder(column: Column, by: int) -> Column:
    """The checksum of an id as text, modulo ``by``; -1 for a null id."""
    return F.coalesce(F.crc32(column.cast("string")) % by, F.lit(-1))


def identified(docs: DataFrame, vocabulary: str | None = None, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Predictions for all documents by a model trained outside of the held-out fold; held_out says which is which.

    A null doc_id is not held out.
    """
    fold = remainder(F.col("doc_id"), folds)
    model = train(docs.filter(fold != held_out), load_vocabulary(vocabulary or vocabulary_file()))
    return predict(docs, model).withColumn("held_out", remainder(F.col("doc_id"), folds) == held_out).select(
        "doc_id", "held_out", "lang_pred", "score"
    )
