"""Licence scan: texts, lines and passages against licence templates by Dice's coefficient over word bigrams.

Words are lower-cased and stripped of punctuation.  Units are the whole text,
every line, and every passage: consecutive lines of which each has a good part
of its bigrams in the templates, so that a licence text set in lines is one unit.
The coefficient of two sets is twice their common bigrams over the sum of their
sizes.  A unit of any size reaches a limit t with a template of T bigrams only if
it has at least T t / (2 - t) of them; an index from bigrams to templates counts
them, and only templates within that bound are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.decontaminate import normalised
from tillspark.llm.licence_texts import TEMPLATES
from tillspark.llm.words import pieces, windows, word_hashes

LIMIT = 0.8
#: The share of a line's bigrams that must occur in templates for the line to continue a passage.
PASSAGE_SHARE = 0.4
UNITS = ("text", "line", "passage")


class Index:
    """Bigrams of all templates, the templates of each, and how many bigrams each template has."""

    def __init__(self, templates: list[tuple[str, str]]) -> None:
        words = normalised(pa.array([t for _, t in templates], pa.string()))
        ok = np.flatnonzero(words.inside(2))
        pairs = np.unique(np.stack([windows(word_hashes(words), 2)[ok], words.text_of()[ok].astype(np.uint64)], 1), axis=0)
        self.names = [name for name, _ in templates]
        self.sizes = np.bincount(pairs[:, 1].astype(np.int64), minlength=len(templates))
        self.bigrams, self.first = np.unique(pairs[:, 0], return_index=True)
        self.first = np.append(self.first, len(pairs))
        self.templates = pairs[:, 1].astype(np.int64)

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each bigram, and whether any template has it."""
        at = np.minimum(np.searchsorted(self.bigrams, hashes), len(self.bigrams) - 1)
        return at, self.bigrams[at] == hashes


def scored(index: Index, unit: np.ndarray, bigrams: np.ndarray, limit: float) -> list[tuple[int, int, float]]:
    """Unit, template and coefficient of every pair that reaches the limit; units and bigrams side by side, unit rising."""
    at, known = index.place(bigrams)
    hits = np.unique(unit[known] * len(index.bigrams) + at[known])
    of, bigram = np.divmod(hits, len(index.bigrams))
    n = index.first[bigram + 1] - index.first[bigram]
    template = index.templates[np.repeat(index.first[bigram] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]
    pairs, common = np.unique(np.repeat(of, n) * len(index.names) + template, return_counts=True)
    of, template = np.divmod(pairs, len(index.names))
    fits = common * (2 - limit) >= limit * index.sizes[template] - 1e-9
    of, template, common = of[fits], template[fits], common[fits]
    out = []
    for u in np.unique(of):
        own = slice(*np.searchsorted(unit, [u, u + 1]))
        size = len(np.unique(bigrams[own]))
        for k in np.flatnonzero(of == u):
            dice = 2 * int(common[k]) / (size + int(index.sizes[template[k]]))
            if dice >= limit:
                out.append((int(u), int(template[k]), dice))
    return out


def scan(column: pa.Array, index: Index, limit: float) -> list[tuple[int, str, float, str, int, int]]:
    """Row, licence, coefficient, kind of unit, first word and number of words: the best unit per row and licence."""
    words = normalised(column)
    if len(words.starts) < 2:
        return []
    hashes, text = windows(word_hashes(words), 2), words.text_of()
    breaks = np.cumsum(words.buf == 10)
    line = breaks[words.starts] + text
    line = np.cumsum(np.diff(line, prepend=line[:1]) > 0)  # lines that have words, numbered on
    pair = words.inside(2)
    within = pair.copy()
    within[:-1] &= line[1:] == line[:-1]
    n_lines = int(line[-1]) + 1
    share = np.bincount(line[within], index.place(hashes[within])[1], n_lines) / np.maximum(np.bincount(line[within], minlength=n_lines), 1)
    in_passage = share >= PASSAGE_SHARE
    line_text = text[np.append(0, np.flatnonzero(np.diff(line)) + 1)]
    joins = np.zeros(n_lines, bool)
    joins[1:] = in_passage[1:] & in_passage[:-1] & (line_text[1:] == line_text[:-1])
    passage = np.cumsum(~joins)[line]
    through = pair & in_passage[line]
    through[:-1] &= passage[1:] == passage[:-1]

    best: dict[tuple[int, str], tuple] = {}
    for kind, unit, ok in zip(UNITS, (text, line, passage), (pair, within, through), strict=True):
        at = np.flatnonzero(ok)
        for u, template, dice in scored(index, unit[at], hashes[at], limit):
            first, last = np.searchsorted(unit, [u, u + 1])
            row = int(text[first])
            found = (dice, -UNITS.index(kind), -int(first - words.first[row]), int(last - first))
            key = (row, index.names[template])
            best[key] = max(best.get(key, found), found)
    return [(row, name, d, UNITS[-kind], -first, n) for (row, name), (d, kind, first, n) in sorted(best.items())]


FOUND = "doc_id long, licence string, dice double, unit string, first_word long, n_words long"


def _scan(batches: Iterator[pa.RecordBatch], templates: list[tuple[str, str]], limit: float) -> Iterator[pa.RecordBatch]:
    index = Index(templates)
    types = [pa.int64(), pa.string(), pa.float64(), pa.string(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in FOUND.split(", ")]
    for batch in batches:
        for piece in pieces(batch, "text"):
            ids = piece.column("id").to_pylist()
            rows = [(ids[row], *rest) for row, *rest in scan(piece.column("text"), index, limit)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def licences(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, limit: float = LIMIT) -> DataFrame:
    """One row per document row and licence found: the best coefficient, and the unit and words it was found in.

    A null text, or one of fewer than two words, has no bigram and no licence.
    Of equally good units the whole text comes first, then lines, then passages,
    and of these the earliest.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return own.mapInArrow(partial(_scan, templates=templates, limit=limit), FOUND)
