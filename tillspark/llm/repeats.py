"""Removal of repeated passages: windows of words that an earlier text already has.

A window is a number of consecutive words of one document.  Counting all
windows exactly would shuffle one row per word, so a count-min sketch comes
first.  Each block of documents counts its windows into a partial sketch, the
partial sketches are merged per range of counters, and every block learns which
of its counters reach two.  Estimates are never too low, so a window that occurs
twice passes; few others do.  A second pass over the blocks groups only those
windows exactly, by 96 bits of hash, and learns which occur earlier.

Earlier means a smaller doc_id, or the same doc_id and an earlier start; a null
doc_id comes before all others.  Rows with the same doc_id have their places in
common: of two equal rows neither comes earlier, and both stay whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.blocks import BLOCK_ROWS, in_blocks, packed, unpacked
from tillspark.llm.tables import stored
from tillspark.llm.words import WORD, mix, pieces, windows, word_hashes, words_of

WINDOW = 20
#: Rows of the sketch, counters in each per window, and the bits of a counter's number within a range.
DEPTH, COUNTERS_PER_WINDOW, RANGE_BITS = 2, 4, 24
#: Bytes that a word takes at least on average, to size the sketch; a wrong guess costs time only.
BYTES_PER_WORD = 6
#: Windows of the input per group of the exact pass.
EXACT_WINDOWS = 1 << 19

NO_ID = np.iinfo(np.int64).min
REQUEST = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("id", pa.binary()), ("row", pa.binary()), ("start", pa.binary())])
COUNTS = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())])
ANSWER = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("repeated", pa.binary())])
PLACES = pa.schema([("block", pa.int64()), ("row", pa.binary()), ("start", pa.binary())])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def rows_of(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def block_windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a block: two hashes, row of the block, start in words."""
    out: list[tuple] = []
    at = 0
    for piece in pieces(table, "text"):
        words = words_of(piece.column("text"))
        ok = np.flatnonzero(words.inside(WINDOW))
        hashes, row = word_hashes(words), words.text_of()[ok]
        start = ok - words.first[row]
        out.append((windows(hashes, WINDOW, 1)[ok], (windows(hashes, WINDOW, 2)[ok] >> np.uint64(32)).astype(np.uint32), (row + at).astype(np.int32), start.astype(np.int32)))
        at += piece.num_rows
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.int32), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def counters(hashes: np.ndarray, width: int) -> list[np.ndarray]:
    """A window's counter in each row of the sketch, numbered through all rows; every row begins a range of its own."""
    row = -(-width >> RANGE_BITS) + 1 << RANGE_BITS
    return [mix(hashes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(k)) % np.uint64(width) + np.uint64(k * row) for k in range(DEPTH)]


def count(table: pa.Table, width: int) -> pa.Table:
    """A block's partial sketch: per range of counters those it hits once or more, and of them those it hits again."""
    return partial_sketch(block_windows(table)[0], table.column("block")[0].as_py(), width)


def partial_sketch(hashes: np.ndarray, block: int, width: int) -> pa.Table:
    """Ranges of counters with those that the hashes of a block hit, and hit again."""
    rows = []
    for cells in counters(hashes, width):
        cells.sort()
        new = np.ones(len(cells), bool)
        new[1:] = cells[1:] != cells[:-1]
        again = cells[~new]
        cells = cells[new]
        part = cells >> np.uint64(RANGE_BITS)
        edges = np.append(np.flatnonzero(np.diff(part, prepend=part[:1] + np.uint64(1))), len(part))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            base = part[low] << np.uint64(RANGE_BITS)
            twice = again[np.searchsorted(again, base) : np.searchsorted(again, base + np.uint64(1 << RANGE_BITS))]
            rows.append((int(part[low]), block, packed((cells[low:high] - base).astype(np.uint32)), packed((np.unique(twice) - base).astype(np.uint32))))
    return rows_of(COUNTS, rows)


def merge(table: pa.Table) -> pa.Table:
    """Add up one range of counters over all blocks; answer each block with a bit for each of its counters: it reaches two."""
    hit = np.zeros(1 << RANGE_BITS, np.uint8)
    for column in ("once", "twice"):
        for data in table.column(column).to_pylist():
            cells = unpacked(data, np.uint32)
            hit[cells] = np.minimum(hit[cells] + 1, 2)
    rows = []
    for part, block, data in zip(*(table.column(c).to_pylist() for c in ("part", "block", "once")), strict=True):
        bits = np.packbits(hit[unpacked(data, np.uint32)] > 1)
        rows.append((part, block, zstandard.ZstdCompressor(level=1).compress(bits.tobytes())))
    return rows_of(ANSWER, rows)


def estimated_repeated(cells: np.ndarray, answers: dict[int, bytes]) -> np.ndarray:
    """Mask of the windows whose counters, given in any order, reach two by the answers for their ranges."""
    kinds, index = np.unique(cells, return_inverse=True)
    parts, sizes = np.unique(kinds >> np.uint64(RANGE_BITS), return_counts=True)
    flags = [np.zeros(0, np.uint8)]
    for part, size in zip(parts.tolist(), sizes.tolist(), strict=True):
        bits = np.frombuffer(zstandard.ZstdDecompressor().decompress(answers[part]), np.uint8)
        flags.append(np.unpackbits(bits, count=size))
    return np.concatenate(flags)[index] > 0


def later(a: np.ndarray, b: np.ndarray, ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by window and place, and a mask in that order: the same window has an earlier place."""
    order = np.lexsort((start, ids, b, a))
    a, b, ids, start = a[order], b[order], ids[order], start[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    return order, (ids != ids[first]) | (start != start[first])


def ask(table: pa.Table, answers: pa.Table, width: int, parts: int) -> pa.Table:
    """A block's windows that the sketch estimates to be repeated.

    Those that the block itself has earlier are settled: they go to part -1.
    The others ask the task for their range of hashes.
    """
    if not table.num_rows:
        return rows_of(REQUEST, [])
    block = table.column("block")[0].as_py()
    a, b, row, start = block_windows(table)
    known = dict(zip(answers.column("part").to_pylist(), answers.column("repeated").to_pylist(), strict=True))
    keep = np.ones(len(a), bool)
    for cells in counters(a, width):
        keep &= estimated_repeated(cells, known)
    a, b, row, start = a[keep], b[keep], row[keep], start[keep]
    ids = table.column("id").fill_null(int(NO_ID)).to_numpy()[row]
    order, settled = later(a, b, ids, start)
    a, b, ids, row, start = (x[order] for x in (a, b, ids, row, start))
    rows = [(-1, block, b"", b"", b"", packed(row[settled]), packed(start[settled]))]
    a, b, ids, row, start = (x[~settled] for x in (a, b, ids, row, start))
    part = ((a >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    edges = np.searchsorted(part, np.arange(parts + 1))
    for p in np.unique(part):
        cut = slice(edges[int(p)], edges[int(p) + 1])
        rows.append((int(p), block, *(packed(x[cut]) for x in (a, b, ids, row, start))))
    return rows_of(REQUEST, rows)


def settle(table: pa.Table) -> pa.Table:
    """Group the windows of one range of hashes exactly; answer each block with its places that come later."""
    asked = [[unpacked(d, t) for d in table.column(c).to_pylist()] for c, t in zip(("a", "b", "id", "row", "start"), (np.uint64, np.uint32, np.int64, np.int32, np.int32), strict=True)]
    of = np.repeat(np.arange(table.num_rows), [len(x) for x in asked[0]])
    a, b, ids, row, start = map(np.concatenate, asked)
    order, mask = later(a, b, ids, start)
    lost = np.sort(order[mask])
    edges = np.searchsorted(of[lost], np.arange(table.num_rows + 1))
    rows = []
    for k, block in enumerate(table.column("block").to_pylist()):
        mine = lost[edges[k] : edges[k + 1]]
        if len(mine):
            rows.append((block, packed(row[mine]), packed(start[mine])))
    return rows_of(PLACES, rows)


def without_words(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the marked words and the gap after each, or before a last one; all else as it is."""
    spans = [m.span() for m in re.finditer(WORD.encode(), text)]
    out, at = [], 0
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    for first, after in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        last = after == len(spans)
        out.append(text[at : spans[first - 1][1] if last and first else spans[first][0]])
        at = spans[after - 1][1] if last else spans[after][0]
    return b"".join([*out, text[at:]])


def cut(table: pa.Table, places: pa.Table, names: list[str], gaps: bool = False) -> pa.Table:
    """Remove the words that the given windows cover: the block's rows with n_words, n_removed and what is left of the text."""
    n = table.num_rows
    row = np.concatenate([unpacked(d, np.int32) for d in places.column("row").to_pylist()] or [np.zeros(0, np.int32)])
    start = np.concatenate([unpacked(d, np.int32) for d in places.column("start").to_pylist()] or [np.zeros(0, np.int32)])
    order = np.argsort(row, kind="stable")
    start, edges = start[order], np.searchsorted(row[order], np.arange(n + 1))
    total, removed, kept = [], [], []
    for k, text in enumerate(table.column("text")):
        whole = text.as_buffer().to_pybytes() if text.is_valid else b""
        own = whole.split()
        mine = start[edges[k] : edges[k + 1]]
        total.append(len(own))
        if len(mine):
            change = np.zeros(len(own) + 1, np.int32)
            np.add.at(change, mine, 1)
            np.add.at(change, mine + WINDOW, -1)
            gone = np.cumsum(change[:-1]) > 0
            own = [own[i] for i in np.flatnonzero(~gone)]
            whole = without_words(whole, gone) if gaps else whole
        removed.append(total[-1] - len(own))
        kept.append((whole if text.is_valid else None) if gaps else b" ".join(own))
    columns = [*(table.column(c) for c in names), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.table(columns, names=[*names, "n_words", "n_removed", "kept_text"])


def without_repeats(docs: DataFrame, block_rows: int = BLOCK_ROWS, gaps: bool = False) -> DataFrame:
    """Every document with all its columns, by position as c0, c1, ..., and n_words, n_removed and kept_text.

    kept_text has the words that stay, joined by single spaces, or with ``gaps``
    the text as it is but for the words that go.  A null text has no words.  Documents of fewer words than a window stay whole.
    """
    columns = docs.columns
    names = [f"c{i}" for i in range(len(columns))]
    plain = docs.toDF(*names)
    own = plain.select(
        *names, F.col(names[columns.index("doc_id")]).cast("long").alias("id"), F.col(names[columns.index("text")]).alias("text"),
        F.octet_length(names[columns.index("text")]).cast("long").alias("n_bytes"),
    )
    carried = [c for c, name in zip(names, columns, strict=True) if name != "text"]
    table = in_blocks(own, [*carried, "id", "text", "n_bytes"], block_rows)
    n_windows = max(1, (table.agg(F.sum("n_bytes")).first()[0] or 0) // BYTES_PER_WORD)
    width, parts = COUNTERS_PER_WINDOW * n_windows, -(-n_windows // EXACT_WINDOWS)

    read = table.select("id", "text", "block")
    sketch = read.groupBy("block").applyInArrow(lambda own: count(own, width), ddl(COUNTS))
    answers = sketch.groupBy("part").applyInArrow(merge, ddl(ANSWER))
    requests = read.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda own, answered: ask(own, answered, width, parts), ddl(REQUEST)
    )
    requests = stored(requests, "window-requests")
    settled = requests.filter("part >= 0").groupBy("part").applyInArrow(settle, ddl(PLACES))
    places = settled.unionByName(requests.filter("part < 0").select("block", "row", "start"))

    schema = ", ".join(f"{c} {t}" for c, t in table.select(*carried).dtypes)
    rows = table.drop("id", "n_bytes").groupBy("block").cogroup(places.groupBy("block"))
    return rows.applyInArrow(lambda own, gone: cut(own, gone, carried, gaps), f"{schema}, n_words long, n_removed long, kept_text string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents with repeated passages removed, in their own columns; those of which nothing stays go.

    A text that loses nothing stays as it is, and of others all that is not
    removed; n_chars, where there is such a column, is counted anew for those.
    """
    columns, kinds = docs.columns, dict(docs.dtypes)
    rows = without_repeats(docs, gaps=True).filter("n_words = 0 or n_removed < n_words")

    def own(i: int, name: str) -> Column:
        if name == "text":
            return F.col("kept_text")
        if name == "n_chars":
            return F.when(F.col("n_removed") > 0, F.length("kept_text").cast(kinds[name])).otherwise(F.col(f"c{i}"))
        return F.col(f"c{i}")

    return rows.select(*[own(i, c).alias(c) for i, c in enumerate(columns)])
