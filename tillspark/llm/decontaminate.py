"""Benchmark decontamination: items found in documents up to a share of edited words.

Words are compared in lower case and without punctuation.  A passage matches an
item of n words if its edit distance to it, counted in words, is at most a fifth
of n.  Passages are found by hashing:

The CGK embedding walks through a text; in every step it writes the word it
stands on, and a random bit of that word and step says whether it moves on.
Two texts that differ by a few edits soon walk in step again, so that edit
distance becomes Hamming distance between what the walks wrote.  Locality-
sensitive hashing samples places of the embedding: an item and a window that
agree on the sampled places are a candidate pair.  That is repeated with other
bits and places until the recall, measured on items edited at random up to the
limit, reaches its target.  Every candidate is then verified exactly.

Windows are as large as the items, in bands of size, and start at every word.
Only windows that touch a run of words of some item of their band are embedded.
That loses nothing: k edits cut an item into at most k + 1 runs, of which the
longest has at least (n - k) / (k + 1) words and occurs unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.tables import free_names
from tillspark.llm.words import bytes_of, lower_ascii, mix, pieces, split, windows, word_hashes

#: The share of an item's words that edits may change, in percent, and the fewest words of an item that says anything.
EDIT_PERCENT, LEAST_WORDS = 20, 5
#: Sampled places per key, the recall to reach, and the edited copies per band it is measured on.
SAMPLES, RECALL, TRIALS = 2, 0.99, 500
BAND_GROWTH = 1.25
#: Items of one pass over the documents; more items mean more passes.
PASS_ITEMS = 20_000
CHUNK = 1 << 14


def normalised_gaps() -> np.ndarray:
    """Bytes between words: all ASCII but letters and digits."""
    out = np.ones(256, bool)
    out[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
    return out


def normalised(column: pa.Array):
    buf, offsets = bytes_of(column)
    return split(lower_ascii(buf), offsets, normalised_gaps())


def edits(n: np.ndarray | int) -> np.ndarray | int:
    return n * EDIT_PERCENT // 100


@dataclass
class Band:
    """Items of similar size: their words side by side, the walks' bits and places, and keys per repetition."""

    items: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    run: int
    seeds: np.ndarray
    steps: np.ndarray
    places: np.ndarray
    keys: list[tuple[np.ndarray, np.ndarray]]


def embed(words: np.ndarray, steps: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Key of every row of words: what one walk writes at the sampled places."""
    n, width = words.shape
    flat, base = words.ravel(), np.arange(n) * width
    at, key = np.zeros(n, np.int64), np.zeros(n, np.uint64)
    for j in range(int(places.max()) + 1):
        here = flat[base + at]
        for _ in range(int((places == j).sum())):
            key = mix(key + here)
        at += ((here >> steps[j]) & np.uint64(1)).astype(np.int64)
        np.minimum(at, width - 1, out=at)
    return key


def edited(words: np.ndarray, n: int, draw: np.random.Generator) -> np.ndarray:
    """A row of words with as many random edits as the limit allows: a third each replaced, left out and put in."""
    out = list(words[:n])
    for _ in range(int(edits(n))):
        at, kind = int(draw.integers(len(out))), int(draw.integers(3))
        new = np.uint64(draw.integers(1, 1 << 63))
        if kind == 0:
            out[at] = new
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, new)
    row = np.zeros(len(words), np.uint64)
    row[: min(len(out), len(words))] = out[: len(words)]
    return row


def repetitions(words: np.ndarray, sizes: np.ndarray, steps: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits and places of as many walks as reach the recall on edited copies of the items."""
    draw = np.random.Generator(np.random.PCG64(seed))
    chosen = draw.integers(len(sizes), size=TRIALS)
    copies = np.stack([edited(words[i], int(sizes[i]), draw) for i in chosen])
    found, bits, places = np.zeros(TRIALS, bool), [], []
    while not bits or found.mean() < RECALL:
        bits.append(draw.integers(64, size=steps, dtype=np.uint64))
        places.append(np.sort(draw.integers(steps, size=SAMPLES)))
        found |= embed(words, bits[-1], places[-1])[chosen] == embed(copies, bits[-1], places[-1])
    return np.stack(bits), np.stack(places)


def prepare(rows: list[tuple[int, str]]) -> list[Band]:
    """Bands of the given items (id, text); items of too few words are left out."""
    words = normalised(pa.array([t for _, t in rows], pa.string()))
    hashes, sizes = word_hashes(words) | np.uint64(1), words.per_text()
    out, low = [], LEAST_WORDS
    while low <= sizes.max(initial=0):
        high = int(low * BAND_GROWTH)
        own = np.flatnonzero((sizes >= low) & (sizes <= high))
        if len(own):
            width = high + int(edits(high)) + 1
            table = np.zeros((len(own), width), np.uint64)
            for k, i in enumerate(own):
                table[k, : sizes[i]] = hashes[words.first[i] : words.first[i + 1]]
            n = np.arange(low, high + 1)
            run = int((-(-(n - edits(n)) // (edits(n) + 1))).min())
            inside = np.flatnonzero(words.inside(run) & np.isin(words.text_of(), own))
            bits, places = repetitions(table, sizes[own], 2 * low, low)
            keys = []
            for b, p in zip(bits, places, strict=True):
                key = embed(table, b, p)
                order = np.argsort(key, kind="stable")
                keys.append((key[order], order))
            ids = np.array([rows[i][0] for i in own], np.int64)
            out.append(Band(ids, sizes[own], table, run, np.unique(windows(hashes, run)[inside]), bits, places, keys))
        low = high + 1
    return out


def distances(band: Band, item: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edit distance of each item to the best beginning of a row of words, and that beginning's length."""
    size, k = band.sizes[item], edits(band.sizes[item])
    width = text.shape[1]
    columns = np.arange(width + 1, dtype=np.int32)
    row = np.broadcast_to(columns, (len(item), width + 1)).copy()
    best, length = np.full(len(item), 1 << 30), np.zeros(len(item), np.int64)
    for i in range(int(size.max())):
        word = band.words[item, i]
        moved = row[:, :-1] + (text != word[:, None])
        row = row + 1
        row[:, 1:] = np.minimum(row[:, 1:], moved)
        row = np.minimum.accumulate(row - columns, axis=1) + columns
        done = np.flatnonzero(size == i + 1)
        if len(done):
            reach = np.where(columns[None, :] <= (size + k)[done][:, None], row[done], 1 << 30)
            length[done] = reach.argmin(axis=1)
            best[done] = reach.min(axis=1)
    return best, length


def search(column: pa.Array, bands: list[Band]) -> list[tuple[int, int, int, int, int]]:
    """Matches in a column of texts: row, item, first word, number of words, distance; the best of overlapping ones."""
    words = normalised(column)
    if not len(words.starts):
        return []
    hashes = word_hashes(words) | np.uint64(1)
    ends = np.repeat(words.first[1:], words.per_text())
    row_of, out = words.text_of(), []
    for band in bands:
        width, total = band.words.shape[1], len(hashes)
        runs = windows(hashes, band.run)
        at = np.searchsorted(band.seeds, runs)
        hit = np.flatnonzero((band.seeds[np.minimum(at, len(band.seeds) - 1)] == runs) & words.inside(band.run))
        if not len(hit):
            continue
        near = np.zeros(total + width + 1, np.int32)
        np.add.at(near, np.maximum(hit - width, words.first[row_of[hit]]), 1)
        np.add.at(near, np.minimum(hit + width // 5 + 1, ends[hit]), -1)
        starts = np.flatnonzero(np.cumsum(near)[:total] > 0)
        for low in range(0, len(starts), CHUNK):
            out += _candidates(band, hashes, ends, starts[low : low + CHUNK])
    return _best(out, words.first, row_of)


def _candidates(band: Band, hashes: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Verified matches of windows that start at the given words: item, start, length, distance."""
    width = band.words.shape[1]
    at = starts[:, None] + np.arange(width)
    text = np.where(at < ends[starts][:, None], hashes[np.minimum(at, len(hashes) - 1)], np.uint64(0))
    pairs = []
    for (key, order), bits, places in zip(band.keys, band.steps, band.places, strict=True):
        own = embed(text, bits, places)
        low, high = np.searchsorted(key, own), np.searchsorted(key, own, "right")
        some = np.flatnonzero(high > low)
        n = (high - low)[some]
        which = np.repeat(some, n)
        place = np.repeat(low[some] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        pairs.append(which * len(band.items) + order[place])
    found = np.unique(np.concatenate(pairs))
    out = []
    for low in range(0, len(found), CHUNK):
        window, item = np.divmod(found[low : low + CHUNK], len(band.items))
        distance, length = distances(band, item, text[window])
        for k in np.flatnonzero(distance <= edits(band.sizes[item])):
            out.append((int(band.items[item[k]]), int(starts[window[k]]), int(length[k]), int(distance[k])))
    return out


def _best(found: list[tuple[int, int, int, int]], first: np.ndarray, row_of: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    out: list[tuple[int, int, int, int, int]] = []
    last: dict[tuple[int, int], int] = {}
    for item, start, length, distance in sorted(found, key=lambda x: (x[3], x[0], x[1])):
        row = int(row_of[start])
        taken = [m for m in out if m[0] == row and m[1] == item] if (row, item) in last else []
        begin = start - int(first[row])
        if all(begin >= m[2] + m[3] or begin + length <= m[2] for m in taken):
            out.append((row, item, begin, length, distance))
            last[row, item] = 1
    return out


MATCHES = "doc_id long, item_id long, first_word long, n_words long, distance long"


def _matches(batches: Iterator[pa.RecordBatch], bands: list[Band]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            found = search(piece.column("text"), bands)
            ids = piece.column("id").to_pylist()
            columns = list(zip(*((ids[row], *rest) for row, *rest in found), strict=True)) or [[]] * 5
            names = [c.split()[0] for c in MATCHES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _clean(batches: Iterator[pa.RecordBatch], bands: list[Band], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, text):
            keep = np.ones(piece.num_rows, bool)
            keep[[m[0] for m in search(piece.column(text), bands)]] = False
            yield piece.filter(pa.array(keep))


def passes(items: DataFrame) -> Iterator[list[Band]]:
    """Prepared items, so many at a time that a task can hold them; a null id or text is no item."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna()
    n = -(-rows.count() // PASS_ITEMS)
    for k in range(n):
        own = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        if bands := prepare(sorted((r["item_id"], r["text"]) for r in own.collect())):
            yield bands


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per passage of a document that matches an item: place in normalised words, length and distance.

    A null text matches nothing; of overlapping passages for one item the
    nearest counts, the first of equally near ones.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    out = own.limit(0).select(*[F.lit(None).cast("long").alias(c.split()[0]) for c in MATCHES.split(", ")])
    for bands in passes(items):
        out = out.unionByName(own.mapInArrow(partial(_matches, bands=bands), MATCHES))
    return out


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any passage that matches an item, in all their columns."""
    names = free_names(docs, *[f"c{i}" for i in range(len(docs.columns))])
    rows = docs.toDF(*names)
    for bands in passes(items):
        rows = rows.mapInArrow(partial(_clean, bands=bands, text=names[docs.columns.index("text")]), rows.schema)
    return rows.toDF(*docs.columns)
