"""Exact Jaccard self-join of shingle sets by partitions of the universe, and its components.

Two sets whose Jaccard similarity reaches the limit differ in few shingles: for
the smaller of size s, in at most s (1 - t) / t.  Shingles are hashed into more
segments than that, so some segment has the same subset in both sets, or nearly:
the pigeonhole.  Sets are grouped in bands of size, each with its number of
segments; a set is indexed in its own band, and in the one below if that holds
sets it may be similar to.

What a segment contributes is allocated by cost.  In bands of small sets, whose
segments would hold too few shingles to tell sets apart, some segments count
twice: half as many larger segments then suffice, each indexed with its subset
and its one-deletion neighbourhood.  In bands of larger sets there are a few
segments to spare, and every set leaves out those of its subsets that are the
most common, being the smallest.  Two similar sets share one subset more than
either leaves out, and the largest shared one is left out by neither.

Most entries are of one set only and of no use.  So blocks of texts first count
their entries into partial count-min sketches, which are merged per range of
counters; a second pass over the blocks writes only entries that are estimated
to occur twice.  Estimates are never too low, so no shared entry is lost.

Equal sets are one class, and of entries with the same members one is kept.  All
members of an entry are compared with its hub, the member with the most shared
entries, on their texts and exactly; near copies of one text mostly have the same
hub in all their entries, and so few pairs.  Where that leaves members of an entry
in different components, all pairs across components are compared: small entries
pair by pair, larger ones in blocks of members against blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillspark.llm.blocks import in_blocks
from tillspark.llm.components import components
from tillspark.llm.repeats import ANSWER, COUNTS, counters, ddl, estimated_repeated, merge, partial_sketch
from tillspark.llm.tables import stored
from tillspark.llm.words import mix, pieces, windows, word_hashes, words_of

#: Words of a shingle and similarity limit in percent, where the caller gives none.
SHINGLE, PERCENT = 3, 90
#: Growth of sizes within a band.
BAND_GROWTH = 1.2
#: Words that a subset's shingles should have on average; bands below use larger segments and deletions.
SUBSET_WORDS = 18
#: A set may leave out one of so many subsets.
SPARE = 8
#: Entries up to this many members are compared pair by pair, others in blocks of so many.
SMALL_ENTRY, BLOCK = 32, 1024
#: Large entries of a member that are looked at to see which pairs its blocks compare anyway.
LARGE_KNOWN = 16


class Band:
    """Sizes from ``low`` to ``high``; ``segments`` of them, the first ``double`` of which count twice; ``spare`` are left out."""

    def __init__(self, low: int, shingle: int, percent: int) -> None:
        self.low, self.high = low, max(low, int(low * BAND_GROWTH))
        differ = self.high * (100 - percent) // percent
        need = differ + 1
        if differ and low < SUBSET_WORDS // shingle * need:
            self.double, self.spare = need // 2, 0
            self.segments = need - self.double
        else:
            self.double, self.spare = 0, need // SPARE
            self.segments = need + self.spare


def bands_of(shingle: int, percent: int) -> list[Band]:
    bands = [Band(1, shingle, percent)]
    while bands[-1].high < 1 << 40:
        bands.append(Band(bands[-1].high + 1, shingle, percent))
    return bands


def shingle_sets(column: pa.Array, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and 64-bit hash of every distinct shingle, in order; a text of fewer words is one shingle of all of them."""
    words = words_of(column, lower=True)
    hashes, per = word_hashes(words), words.per_text()
    ok = np.flatnonzero(words.inside(shingle))
    row, value = [words.text_of()[ok]], [windows(hashes, shingle, shingle)[ok]]
    for size in range(1, shingle):
        short = np.flatnonzero(per == size)
        row.append(short)
        value.append(windows(hashes, size, size)[words.first[short]])
    rows, values = np.concatenate(row), np.concatenate(value)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[new], values[new]


def entries(rows: np.ndarray, values: np.ndarray, sizes: np.ndarray, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Row and index entry of every set, for sets given as sorted (row, shingle) pairs."""
    edges = np.append(0, np.cumsum(sizes))
    bands = bands_of(shingle, percent)
    lows = np.array([b.low for b in bands])
    own = np.searchsorted(lows, sizes, "right") - 1
    least = -(-sizes * percent // 100)
    below = np.searchsorted(lows, least, "right") - 1
    out_rows, out_entries = [], []
    has = sizes > 0
    for k in np.unique(np.append(own[has], below[has])):
        band, members = bands[k], np.flatnonzero(has & (below <= k) & (own >= k))
        lengths = sizes[members]
        at = np.repeat(edges[members] - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
        local, tokens = np.repeat(np.arange(len(members)), lengths), mix(values[at] + np.uint64(int(k)))
        m = band.segments
        cell = local * m + ((tokens >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell, tokens = cell[order], tokens[order]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        sums, counts = np.zeros(len(members) * m, np.uint64), np.bincount(cell, minlength=len(members) * m)
        sums[cell[first]] = np.add.reduceat(tokens, first)
        name = np.tile(mix(np.arange(m).astype(np.uint64) + np.uint64(int(k) << 32)), len(members))
        subsets = mix(sums + name)
        owner = np.repeat(np.arange(len(members)), m)
        if band.spare:
            rank = np.lexsort((subsets, counts, owner)).reshape(len(members), m)[:, band.spare :].ravel()
            subsets, owner_kept = subsets[rank], owner[rank]
        else:
            owner_kept = owner
        out_rows.append(members[owner_kept])
        out_entries.append(subsets)
        if band.double:
            twice = cell % m < band.double
            out_rows.append(members[cell[twice] // m])
            out_entries.append(mix(sums[cell[twice]] - tokens[twice] + name[cell[twice]]))
    if not out_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    all_rows, all_entries = np.concatenate(out_rows), np.concatenate(out_entries)
    order = np.lexsort((all_entries, all_rows))
    return all_rows[order], all_entries[order]


DESCRIBED = "block long, id long, n long, h1 long, h2 long"
#: Counters of the sketch per shingle, of which a set has fewer entries than two.
COUNTERS_PER_SHINGLE = 2


def _describe(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """Size and two sums of hashes (equal for equal sets) of every text."""
    for batch in batches:
        for piece in pieces(batch, "text"):
            rows, values = shingle_sets(piece.column("text"), shingle)
            sizes = np.bincount(rows, minlength=piece.num_rows)
            edges = np.append(0, np.cumsum(sizes))
            sums = []
            for seed in (1, 2):
                total = np.append(np.uint64(0), np.cumsum(mix(values + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64))
                sums.append((total[edges[1:]] - total[edges[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([piece.column("block"), piece.column("id"), pa.array(sizes, pa.int64()), pa.array(sums[0]), pa.array(sums[1])], ["block", "id", "n", "h1", "h2"])


def _entries_of(table: pa.Table, wanted: pa.Array, shingle: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and index entries of a block's texts with a wanted id, some texts at a time."""
    own = table.filter(pc.is_in(table.column("id"), value_set=wanted))
    for piece in pieces(own, "text"):
        rows, values = shingle_sets(piece.column("text"), shingle)
        owner, index = entries(rows, values, np.bincount(rows, minlength=piece.num_rows), shingle, percent)
        yield piece.column("id").to_numpy()[owner], index


def _count_entries(table: pa.Table, wanted: pa.Table, width: int, shingle: int, percent: int) -> pa.Table:
    """A block's partial sketch of the entries of its wanted texts."""
    if not table.num_rows or not wanted.num_rows:
        return COUNTS.empty_table()
    found = [index for _, index in _entries_of(table, wanted.column("id").combine_chunks(), shingle, percent)]
    return partial_sketch(np.concatenate([np.zeros(0, np.uint64), *found]), table.column("block")[0].as_py(), width)


def _shared_entries(table: pa.Table, asked: pa.Table, width: int, shingle: int, percent: int) -> pa.Table:
    """A block's ids and entries that the merged sketch says occur twice, with an id's number of them; ``asked`` has its wanted ids and its answers."""
    wanted = asked.filter(pc.is_null(asked.column("part"))).column("id").combine_chunks()
    answered = asked.filter(pc.is_valid(asked.column("part")))
    known = dict(zip(answered.column("part").to_pylist(), answered.column("repeated").to_pylist(), strict=True))
    ids, kept = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    if table.num_rows and known:
        found = list(_entries_of(table, wanted, shingle, percent))
        owner, index = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        keep = np.ones(len(index), bool)
        for cells in counters(index, width):
            keep &= estimated_repeated(cells, known)
        ids, kept = [owner[keep]], [index[keep]]
    owner = np.concatenate(ids)
    _, which, times = np.unique(owner, return_inverse=True, return_counts=True)
    return pa.table({"id": owner, "entry": np.concatenate(kept).view(np.int64), "degree": times[which].astype(np.int64)})


def _wanted_texts(table: pa.Table, wanted: pa.Table) -> pa.Table:
    """A block's texts with a wanted id, and the number of shingles that goes with the id."""
    own = table.select(["id", "text"]).join(wanted.select(["id", "n"]), "id", join_type="inner", use_threads=False)
    return own.select(["id", "n", "text"])


def alike(left_size: np.ndarray, right_size: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (left_size + right_size - common)


def _compare(batches: Iterator[pa.RecordBatch], shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of rows (a, b, text_a, text_b), those pairs whose sets are similar."""
    for batch in batches:
        for piece in pieces(batch, "text_a"):
            n = piece.num_rows
            (ra, va), (rb, vb) = (shingle_sets(piece.column(c), shingle) for c in ("text_a", "text_b"))
            rows, values = np.concatenate([ra, rb]), np.concatenate([va, vb])
            order = np.lexsort((values, rows))
            rows, values = rows[order], values[order]
            both = (rows[1:] == rows[:-1]) & (values[1:] == values[:-1])
            common = np.bincount(rows[1:][both], minlength=n)
            yes = alike(np.bincount(ra, minlength=n), np.bincount(rb, minlength=n), common, percent)
            yield pa.RecordBatch.from_arrays([piece.column(c).filter(pa.array(yes)) for c in ("a", "b")], ["a", "b"])


def common_counts(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Matrix of the numbers of shingles that each two of n sets share, from those that at least two have."""
    kinds, index, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    some = times[index] > 1
    column, row = shared[index[some]], rows[some]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        cut = slice(*np.searchsorted(column, [low, low + width]))
        x = np.zeros((n, width), np.float32)
        x[row[cut], column[cut] - low] = 1
        out += x @ x.T
    return out


def _compare_blocks(table: pa.Table, shingle: int, percent: int) -> pa.Table:
    """Links between components within two blocks of members of an entry, reduced to trees: each component with the smallest it reaches."""
    part, text = table.column("part").to_numpy(), table.column("text")
    rows, values = shingle_sets(text, shingle)
    n = len(part)
    sizes = np.bincount(rows, minlength=n)
    linked = alike(sizes[:, None], sizes[None, :], common_counts(rows, values, n), percent)
    label = part.copy()
    while True:
        least = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        least = np.minimum(label, least)
        if (least == label).all():
            break
        label = least
    some = label != part
    return pa.table({"a": part[some], "b": label[some]}).group_by(["a", "b"]).aggregate([])


def similar_pairs(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Of pairs (a, b) of ids, those with similar sets; texts are (id, n, text)."""
    left = texts.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("text").alias("text_b"))
    sizes_fit = (100 * F.least("n_a", "n_b")) >= (percent * F.greatest("n_a", "n_b"))
    # Bands leave few pairs whose sizes don't fit: looking the sizes up first costs more than it saves.
    rows = pairs.join(left, "a").join(right, "b").filter(sizes_fit).select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(partial(_compare, shingle=shingle, percent=percent), "a long, b long")


def kept_entries(entry: DataFrame) -> DataFrame:
    """Of entries (id, entry, degree) those with different members, one for each set of members: its number of members, smallest and largest id, and hub.

    Long passages that several texts share make many entries with the same
    members, which would all ask for the same comparisons.
    """
    hub = F.max(F.struct(F.col("degree"), (-F.col("id")).alias("negative"), F.col("id"))).getField("id")
    # Sets of ids are told apart by their ends, their number and two hashes that don't depend on the order.
    ends = entry.groupBy("entry").agg(
        F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("members"), hub.alias("hub"),
        F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("h2"),
    ).filter("low < high")
    return ends.groupBy("members", "low", "high", "h1", "h2").agg(F.min("entry").alias("entry"), F.min_by("hub", "entry").alias("hub")).drop("h1", "h2")


def linked(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document: shingles of so many words, linked from so many percent on.

    A null text or one without words has no shingles and links with nothing.  A
    null doc_id can't be reached: its component_id is null.  Rows with the same
    doc_id are one document of several texts, and so in one component.
    """
    own_texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    blocks = in_blocks(own_texts, ["id", "text"])
    described = stored(blocks.mapInArrow(partial(_describe, shingle=shingle), DESCRIBED), "described")
    known = described.filter("n > 0 and id is not null")
    classes = stored(known.groupBy("n", "h1", "h2").agg(F.min("id").alias("class"), F.min_by("block", "id").alias("block")), "classes")

    # Index entries of one member of each class; those with other members too.
    width = max(1, COUNTERS_PER_SHINGLE * (classes.agg(F.sum("n")).first()[0] or 0))
    members = classes.select("block", F.col("class").alias("id")).distinct()
    sketch = blocks.groupBy("block").cogroup(members.groupBy("block")).applyInArrow(
        lambda own, wanted: _count_entries(own, wanted, width, shingle, percent), ddl(COUNTS)
    )
    answers = sketch.groupBy("part").applyInArrow(merge, ddl(ANSWER)).select("block", "part", "repeated", F.lit(None).cast("long").alias("id"))
    nothing = [F.lit(None).cast("long").alias("part"), F.lit(None).cast("binary").alias("repeated")]
    asked = answers.unionByName(members.select("block", *nothing, "id"))
    entry = blocks.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(
        lambda own, answered: _shared_entries(own, answered, width, shingle, percent), "id long, entry long, degree long"
    )
    entry = stored(entry, "repeated-entries")
    shared = stored(entry.drop("degree").join(kept_entries(entry), "entry"), "entries")

    # Texts of the members, which their blocks pick without a shuffle, then the pairs of each with the hubs of its entries.
    wanted = shared.select("id").distinct().join(classes.select("block", F.col("class").alias("id"), "n").distinct(), "id")
    texts = blocks.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(_wanted_texts, "id long, n long, text string")
    texts = stored(texts, "entry-texts", "zstd")
    ordered = lambda x, y: [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]
    # Up to three members are all compared by way of the smallest and the largest; others are looked at again.
    few = shared.filter("members <= 3")
    tested = few.select(*ordered("id", "low")).unionByName(few.select(*ordered("id", "high"))).unionByName(shared.filter("members > 3").select(*ordered("id", "hub")))
    tested = stored(tested.filter("a < b").distinct(), "tested-pairs")
    own = known.join(classes.drop("block"), ["n", "h1", "h2"])
    several = own.groupBy("id").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high").select("id", "low")
    same_id = own.select("id", "class").join(several, "id").select(F.col("class").alias("a"), F.col("low").alias("b"))
    first = components(similar_pairs(tested, texts, shingle, percent).unionByName(same_id))

    # Entries that still have members in different components.
    part = shared.filter("members > 3").join(first, "id", "left").withColumn("part", F.coalesce("component", "id"))
    # The main part of an entry is the one with the most members; only the others have to be compared with all.
    per_part = part.groupBy("entry", "part").agg(F.count(F.lit(1)).alias("n"))
    split = per_part.groupBy("entry").agg(F.max(F.struct("n", "part")).alias("most"), F.sum("n").alias("all")).filter("most.n < all")
    split = split.select("entry", F.col("most.part").alias("main"), (F.col("all") - F.col("most.n")).alias("others"))
    open_ = stored(part.join(split, "entry").select("entry", "members", "id", "part", "main", "others"), "open-entries")
    large = open_.filter(F.col("members") > SMALL_ENTRY)
    # Two that meet in a large entry are compared there, in blocks; some of its entries tell that of a member.
    met = large.groupBy("id").agg(F.slice(F.sort_array(F.collect_set("entry")), 1, LARGE_KNOWN).alias("large"))
    side = open_.filter(F.col("members") <= SMALL_ENTRY).select("entry", "id", "part").join(met, "id", "left")
    other = side.select("entry", F.col("id").alias("id_b"), F.col("part").alias("part_b"), F.col("large").alias("large_b"))
    apart = ~F.coalesce(F.arrays_overlap("large", "large_b"), F.lit(False))
    rest = side.join(other, "entry").filter("id < id_b and part != part_b").filter(apart).select(F.col("id").alias("a"), F.col("id_b").alias("b"))
    rest = rest.distinct().join(tested, ["a", "b"], "left_anti")
    more = similar_pairs(rest, texts, shingle, percent)

    # Blocks: those outside of the main part against all, in as few blocks as they fill.
    n_i, n_j = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("others", "members"))
    number = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    outside = large.filter("part != main").select("entry", "id", "part", number(n_i).alias("i"), every(n_j).alias("j"))
    inside = large.select("entry", "id", "part", every(n_i).alias("i"), number(n_j).alias("j"))
    needed = outside.select("entry", "i").distinct()
    groups = outside.unionByName(inside).distinct().join(needed, ["entry", "i"], "left_semi")
    groups = groups.join(texts.select("id", "text"), "id").repartition("entry", "i", "j")
    more = more.unionByName(groups.groupBy("entry", "i", "j").applyInArrow(lambda own: _compare_blocks(own, shingle, percent), "a long, b long"))

    final = components(first.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = classes.drop("block").join(final.withColumnRenamed("id", "class"), "class", "left").select("n", "h1", "h2", F.coalesce("component", "class").alias("component_id"))
    result = described.select("id", "n", "h1", "h2").join(named, ["n", "h1", "h2"], "left")
    return result.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
    )


def representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents with the smallest doc_id of their component, and those without a doc_id, in all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    own = docs.toDF(*names).withColumn("id", F.col(names[docs.columns.index("doc_id")]).cast("long"))
    gone = linked(docs, shingle, percent).filter("component_id != doc_id").select(F.col("doc_id").alias("id"))
    return own.join(gone, "id", "left_anti").select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
