"""Words of text columns as arrays: spans and hashes of whole Arrow batches at once.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, so any UTF-8
character but these six belongs to a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

WORD = "[^\\x20\\x09-\\x0D]+"
GAP = "[\\x20\\x09-\\x0D]+"

#: Text bytes that a task turns into arrays at a time; a longer text is one piece.
PIECE_BYTES = 2 << 20


@dataclass
class Words:
    """Words of consecutive texts; word i is ``buf[starts[i]:ends[i]]``, text d has words ``first[d]`` to ``first[d + 1]``."""

    buf: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def inside(self, size: int) -> np.ndarray:
        """Mask over word positions: the next ``size`` words exist in the same text."""
        out = np.zeros(len(self.starts), bool)
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))
        out[left >= size] = True
        return out


def pieces(table: pa.Table | pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.Table | pa.RecordBatch]:
    """Slices of consecutive rows with up to ``limit`` bytes in a string column, one row at least."""
    if table.num_rows == 0:
        return
    _, offsets = bytes_of(table.column(column))
    at = 0
    while at < table.num_rows:
        upto = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        upto = min(max(upto, at + 1), table.num_rows)
        yield table.slice(at, upto - at)
        at = upto


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if offsets is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    out = buf.copy()
    out[(buf >= 65) & (buf <= 90)] += 32
    return out


def _gaps() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def split(buf: np.ndarray, offsets: np.ndarray, gaps: np.ndarray | None = None) -> Words:
    """Words between bytes of ``gaps`` (white space); no word spans two texts."""
    word = ~(_gaps() if gaps is None else gaps)[buf]
    edge = offsets[(offsets > 0) & (offsets < len(buf))]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    begins[edge] = word[edge]
    stops[:-1] &= ~word[1:]
    stops[edge - 1] = word[edge - 1]
    starts = np.flatnonzero(begins)
    return Words(buf, offsets, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def words_of(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    buf, offsets = bytes_of(column)
    return split(lower_ascii(buf) if lower else buf, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(words: Words, seed: int = 1) -> np.ndarray:
    """64-bit hash of every word: random numbers per byte value, weighted by powers per position."""
    if not len(words.starts):
        return np.zeros(0, np.uint64)
    draw = np.random.Generator(np.random.PCG64(seed))
    table = draw.integers(0, 1 << 64, 256, np.uint64)
    base = np.uint64(draw.integers(0, 1 << 63, dtype=np.uint64)) * np.uint64(2) + np.uint64(1)
    lengths = words.ends - words.starts
    powers = np.cumprod(np.full(int(lengths.max()), base, np.uint64))
    # Each byte's place in its word; bytes of a gap count on from the word before and weigh nothing.
    lead = int(words.starts[0])
    spread = np.diff(np.append(words.starts, len(words.buf)))
    place = np.arange(lead, len(words.buf)) - np.repeat(words.starts, spread)
    inside = place < np.repeat(lengths, spread)
    parts = table[words.buf[lead:]]
    parts *= powers[np.where(inside, place, 0)]
    parts[~inside] = 0
    return mix(np.add.reduceat(parts, words.starts - lead) + lengths.astype(np.uint64))


def windows(hashes: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """Hash of the ``size`` words from each position on; the last positions have no whole window and hold 0."""
    base = np.uint64((0x9E3779B97F4A7C15 * (2 * seed + 1)) & 0xFFFFFFFFFFFFFFFF | 1)
    out = np.zeros(len(hashes), np.uint64)
    n = len(hashes) - size + 1
    if n <= 0:
        return out
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total *= base
        total += hashes[k : k + n]
    out[:n] = mix(total + np.uint64(seed))
    return out
