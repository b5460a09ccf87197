"""Prefix trie of conversations: what they share from their first turn on.

Every turn gets an id of 128 bits from its role and text, and a conversation is
its sequence of ids.  Conversations are dealt to shards by ranges of sequence
and conv_id, so a group of equal conversations is split like any other.  A shard
sorts the padded matrix of its ids; where a column, or one before it, changes
from one row to the next, a node starts.  Sums over the rows of a node then give
its aggregates at every depth, from the deepest up.

Nodes that hold a shard's first or last row may go on in its neighbours.  They
stay open, as two paths per shard.  Neighbouring runs of shards are merged in
rounds, a bounded number at a time: nodes that both paths have are added up, and
those that no later run can have are closed.  Parents that were open are named
afterwards.

A matrix has a bounded number of columns; rows that go on have a part in the
next one.  So memory follows the number of turns, not rows times the longest
row.  A conversation's ids, 16 bytes a turn, have to fit in a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillspark.llm.blocks import packed, unpacked
from tillspark.llm.tables import stored
from tillspark.llm.words import WORD, mix

#: Conversations share a base in groups of so many, and take fewer than so many turns of it.
GROUP, HEADS = 20, 4
#: Columns of a matrix, turns of a shard, and runs of shards that are merged at a time.
COLUMNS, SHARD_TURNS, FAN_IN = 32, 1 << 18, 64

NO_TURN = np.iinfo(np.int64).min
OPEN = "shard long, first boolean, depth int, hi long, lo long, n long, least long, children long, leaves long, saved long, words long"
NODE = "key binary, depth int, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
ROW = f"kind int, shard long, up_depth int, up_first boolean, ends binary, first boolean, hi long, lo long, words long, {NODE}"
EMPTY = hashlib.sha256(b"").hexdigest()


def sequences(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and ``turns``, its turns in order as (turn, hi, lo, words).

    Turns without a number come first.  Turns of the same number are ordered by
    a hash of role and text.  Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    one = F.struct(
        F.col("turn").cast("long").alias("turn"), F.xxhash64(role, text).alias("hi"), F.xxhash64(text, role, F.lit(1)).alias("lo"),
        F.regexp_count(text, F.lit(WORD)).cast("int").alias("words"),
    )
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one")).filter("conv_id is not null")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("one")).alias("turns"))


def heads(conv_id: Column) -> Column:
    """How many turns a conversation takes of its base."""
    return (F.crc32(conv_id.cast("string")) % HEADS).cast("int")


def rebuilt(own: DataFrame) -> DataFrame:
    """Every conversation with the first turns of its base in place of its own: conv_id, ``ids`` (two a turn) and ``words``."""
    base = own.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("base_turns"))
    h = heads(F.col("conv_id"))
    joined = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(base, "base", "left")
    taken = F.coalesce(F.slice("base_turns", F.lit(1), h), F.slice("turns", 1, 0))
    kept = F.slice("turns", h + 1, F.size("turns"))
    whole = joined.select("conv_id", F.concat(taken, kept).alias("t"))
    return whole.select("conv_id", F.flatten(F.transform("t", lambda x: F.array(x.hi, x.lo))).alias("ids"), F.col("t.words").alias("words"))


@dataclass
class Open:
    """A node that may go on: sums over its rows so far and over the closed nodes below it."""

    hi: int
    lo: int
    n: int
    least: int
    children: int
    leaves: int
    saved: int
    words: int
    key: bytes = b""


@dataclass
class Run:
    """Neighbouring shards: the open nodes of their first and last row by depth; nodes that both rows have are the same objects."""

    first: list[Open] = field(default_factory=list)
    last: list[Open] = field(default_factory=list)


@dataclass
class Closed:
    key: bytes
    up: bytes | None
    depth: int
    node: Open


def sort_rows(ids: np.ndarray, offsets: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Order of sequences by ids, shorter ones first, then by conversation: from the last columns to the first."""
    lengths = np.diff(offsets)
    by_conv = np.argsort(conv, kind="stable")
    order = np.zeros(0, np.int64)
    for k in range(max(0, int(lengths.max(initial=0)) - 1) // COLUMNS, -1, -1):
        ends_here = (lengths[by_conv] <= (k + 1) * COLUMNS) & ((lengths[by_conv] > k * COLUMNS) | (k == 0))
        order = np.concatenate([by_conv[ends_here], order])
        matrix = padded(ids, offsets, order, k)
        order = order[np.lexsort(matrix.T[::-1])] if matrix.size else order
    return order


def padded(ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Part k of the rows' ids as a matrix, two columns a turn."""
    start = offsets[rows] + k * COLUMNS
    length = np.clip(offsets[rows + 1] - start, 0, COLUMNS)
    width = int(length.max(initial=0))
    inside = np.arange(width) < length[:, None]
    at = (start[:, None] + np.arange(width))[inside]
    out = np.full((len(rows), width, 2), NO_TURN)
    out[inside] = ids.reshape(-1, 2)[at]
    return out.reshape(len(rows), 2 * width)


def node_starts(ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For sorted sequences, depth by depth from 1: the rows that reach it, and which of them start a node."""
    lengths = np.diff(offsets)
    node = np.zeros(len(lengths), np.int64)
    k = 0
    rows = np.flatnonzero(lengths > 0)
    while len(rows):
        matrix = padded(ids, offsets, rows, k).reshape(len(rows), -1, 2)
        change = (matrix[1:] != matrix[:-1]).any(axis=2)
        change[:, 0] |= node[rows[1:]] != node[rows[:-1]]
        change = np.logical_or.accumulate(change, axis=1)
        for c in range(matrix.shape[1]):
            reach = lengths[rows] > k * COLUMNS + c
            start = np.append(True, change[:, c])[reach]
            yield k * COLUMNS + c + 1, rows[reach], start
            if c == COLUMNS - 1:
                node[rows[reach]] = np.cumsum(start)
        k += 1
        rows = rows[lengths[rows] > k * COLUMNS]


def path_keys(ids: np.ndarray) -> list[bytes]:
    """128-bit name of every prefix of a sequence, the empty one first."""
    a, b = np.uint64(1), np.uint64(2)
    out = [a.tobytes() + b.tobytes()]
    for hi, lo in ids.reshape(-1, 2).view(np.uint64):
        a, b = mix(np.array([a]) * np.uint64(0x9E3779B97F4A7C15) + hi)[0], mix(np.array([b]) * np.uint64(0xC2B2AE3D27D4EB4F) + lo)[0]
        out.append(a.tobytes() + b.tobytes())
    return out


def digest(ids: Iterable[np.ndarray]) -> str:
    """Checksum of ascending numbers in decimal, with commas."""
    state, first = hashlib.sha256(), True
    for own in ids:
        if len(own):
            state.update((b"" if first else b",") + ",".join(map(str, own.tolist())).encode())
            first = False
    return state.hexdigest()


KINDS = NODE_ROW, OPEN_ROW, ENDS_ROW = 0, 1, 2


def shard_rows(conv: np.ndarray, ids: np.ndarray, words: np.ndarray, offsets: np.ndarray, shard: int) -> dict[str, list]:
    """Closed nodes, open nodes and the conversations that end in open nodes, for one shard."""
    order = sort_rows(ids, offsets, conv)
    lengths = np.diff(offsets)[order]
    at = np.repeat(offsets[order] - np.append(0, np.cumsum(lengths)[:-1]), lengths) + np.arange(lengths.sum())
    conv, ids, words = conv[order], ids.reshape(-1, 2)[at].ravel(), words[at]
    offsets = np.append(0, np.cumsum(lengths))
    n, last = len(conv), len(conv) - 1
    out: dict[str, list] = {c.split()[0]: [] for c in ROW.split(", ")}

    def add(kind: int, **values: object) -> None:
        for name, column in out.items():
            column.append(kind if name == "kind" else shard if name == "shard" else values.get(name))

    paths = [path_keys(ids[2 * offsets[r] : 2 * offsets[r + 1]]) for r in (0, last)]
    levels = list(node_starts(ids, offsets))
    child, leaf, saved = (np.zeros(n, np.int64) for _ in range(3))
    below: tuple | None = None
    everyone = np.append(True, np.zeros(n - 1, bool))
    for depth, rows, start in [*levels[::-1], (0, np.arange(n), everyone)]:
        seg = np.flatnonzero(start)
        top = rows[seg]
        convs, least = np.diff(np.append(seg, len(rows))), np.minimum.reduceat(conv[rows], seg)
        children = np.add.reduceat(child[rows], seg)
        last_words = words[offsets[top] + depth - 1].astype(np.int64) if depth else np.zeros(len(top), np.int64)
        is_open = np.zeros(len(top), bool)
        is_open[0] |= rows[0] == 0
        is_open[-1] |= rows[-1] == last
        closed = ~is_open
        leaf[top[closed]] += children[closed] == 0
        saved[top[closed]] += (convs[closed] - 1) * last_words[closed]
        leaves, save = np.add.reduceat(leaf[rows], seg), np.add.reduceat(saved[rows], seg)
        child[:] = 0
        child[top[closed]] = 1
        ends = np.add.reduceat((lengths[rows] == depth).astype(np.int64), seg)
        if below is not None:
            # The nodes one deeper learn their parent: its smallest member, or that it is open.
            (d, tops, columns) = below
            parent = np.searchsorted(top, tops, "right") - 1
            for i, p in enumerate(parent.tolist()):
                up_open = bool(is_open[p])
                add(NODE_ROW, depth=d, parent_conv_id=None if up_open else int(least[p]), up_depth=depth if up_open else None,
                    up_first=bool(rows[0] == 0 and p == 0) if up_open else None, **{name: column[i] for name, column in columns.items()})
        for i in np.flatnonzero(is_open).tolist():
            first = bool(rows[0] == 0 and i == 0)
            key = paths[0 if first else 1][depth]
            hi, lo = (int(x) for x in ids[2 * (offsets[top[i]] + depth - 1) :][:2]) if depth else (0, 0)
            add(OPEN_ROW, first=first, depth=depth, key=key, hi=hi, lo=lo, n_convs=int(convs[i]), conv_id=int(least[i]), n_children=int(children[i]),
                n_leaves=int(leaves[i]), saved_tokens=int(save[i]), words=int(last_words[i]))
            if ends[i]:
                add(ENDS_ROW, key=key, ends=packed(conv[top[i] : top[i] + ends[i]]))
        some = np.flatnonzero(closed)
        below = (depth, top[some], {
            "conv_id": least[some].tolist(), "n_convs": convs[some].tolist(), "n_children": children[some].tolist(), "n_leaves": leaves[some].tolist(),
            "saved_tokens": save[some].tolist(),
            "ends_sha256": [digest([conv[t : t + e]]) if e else EMPTY for t, e in zip(top[some].tolist(), ends[some].tolist(), strict=True)],
        })
    return out


def _as_batch(rows: dict[str, list], ddl: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    types = dict(c.split() for c in ddl.split(", "))
    return pa.RecordBatch.from_arrays([pa.array(rows[c], kinds[t]) for c, t in types.items()], [*types])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's rows are one shard."""
    own = [b for b in batches if b.num_rows]
    if not own:
        return
    table = pa.Table.from_batches(own).combine_chunks()
    ids, words = (table.column(c).combine_chunks() for c in ("ids", "words"))
    ids, words = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (ids, words))
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.values.to_numpy(zero_copy_only=False)
    rows = shard_rows(table.column("conv_id").to_numpy(), ids.values.to_numpy(zero_copy_only=False), flat, offsets, TaskContext.get().partitionId())
    for low in range(0, len(rows["kind"]), 50_000):
        yield _as_batch({c: v[low : low + 50_000] for c, v in rows.items()}, ROW)


def runs_of(table: pa.Table) -> list[Run]:
    """Runs from their open nodes, in order."""
    found: dict[int, Run] = {}
    for r in sorted(table.to_pylist(), key=lambda r: (r["shard"], not r["first"], r["depth"])):
        run = found.setdefault(r["shard"], Run())
        node = Open(r["hi"], r["lo"], r["n"], r["least"], r["children"], r["leaves"], r["saved"], r["words"], r["key"])
        if r["first"]:
            run.first.append(node)
        else:
            if not run.last:
                run.last = run.first[: r["depth"]]
            run.last.append(node)
    for run in found.values():
        run.last = run.last or list(run.first)
    return [found[s] for s in sorted(found)]


def close(path: list[Open], keep: int, out: list[Closed]) -> None:
    """Close the nodes of a path from depth ``keep`` on; what they hold goes to those above."""
    leaves = saved = 0
    for depth in range(len(path) - 1, -1, -1):
        node = path[depth]
        if depth >= keep:
            leaves += node.children == 0
            saved += (node.n - 1) * node.words
        node.leaves += leaves
        node.saved += saved
        if depth >= keep:
            out.append(Closed(node.key, path[depth - 1].key if depth else None, depth, replace(node)))
            if depth:
                path[depth - 1].children += 1


def merged(a: Run, b: Run, out: list[Closed]) -> Run:
    """One run of two neighbours; nodes that end between them are closed."""
    common = 0
    for x, y in zip(a.last, b.first):  # noqa: B905
        if (x.hi, x.lo) != (y.hi, y.lo):
            break
        common += 1
    on_first = sum(x is y for x, y in zip(a.first, a.last))  # noqa: B905
    on_last = sum(x is y for x, y in zip(b.first, b.last))  # noqa: B905
    # What only one of the touching rows has ends here, unless the far row of its run has it too.
    close(a.last, max(common, on_first), out)
    close(b.first, max(common, on_last), out)
    for x, y in zip(a.last[:common], b.first[:common], strict=True):
        x.n, x.least, x.children = x.n + y.n, min(x.least, y.least), x.children + y.children
        x.leaves, x.saved = x.leaves + y.leaves, x.saved + y.saved
    # What both touching rows have, but neither far row.
    close(a.last[:common], max(on_first, on_last), out)
    k = min(common, on_last)
    return Run(a.first, a.last[:k] + b.last[k:])


def merge_group(table: pa.Table, final: bool) -> pa.Table:
    """Merge neighbouring runs; closed nodes, and the open ones of the whole run unless nothing follows."""
    out: list[Closed] = []
    run: Run | None = None
    for other in runs_of(table):
        run = other if run is None else merged(run, other, out)
    rows: dict[str, list] = {c.split()[0]: [] for c in MERGED.split(", ")}
    group = table.column("group")[0].as_py()

    def add(**values: object) -> None:
        for name, column in rows.items():
            column.append(group if name == "shard" else values.get(name))

    def as_open(node: Open, first: bool, depth: int) -> None:
        add(first=first, depth=depth, key=node.key, hi=node.hi, lo=node.lo, n=node.n, least=node.least, children=node.children, leaves=node.leaves, saved=node.saved, words=node.words)

    shared = sum(x is y for x, y in zip(run.first, run.last))  # noqa: B905
    if final:
        close(run.last, shared, out)
        close(run.first, 0, out)
    else:
        for depth, node in enumerate(run.first):
            as_open(node, True, depth)
        for depth, node in enumerate(run.last[shared:], shared):
            as_open(node, False, depth)
    for c in out:
        add(up=c.up, depth=c.depth, key=c.key, n=c.node.n, least=c.node.least, children=c.node.children, leaves=c.node.leaves, saved=c.node.saved, words=c.node.words)
    return pa.Table.from_batches([_as_batch(rows, MERGED)])


MERGED = f"{OPEN}, key binary, up binary"


def joined_runs(open_nodes: DataFrame, shards: int) -> DataFrame:
    """Complete nodes of all open ones: key, up (the parent's key), depth and sums."""
    done = None
    while True:
        final = shards <= FAN_IN
        grouped = open_nodes.withColumn("group", F.floor(F.col("shard") / FAN_IN).cast("long"))
        step = stored(grouped.groupBy("group").applyInArrow(lambda own: merge_group(own, final), MERGED), "trie-runs")
        closed = step.filter("first is null").drop("first", "shard", "hi", "lo")
        done = closed if done is None else done.unionByName(closed)
        if final:
            return done
        open_nodes, shards = step.filter("first is not null").drop("up"), -(-shards // FAN_IN)


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksum per node of its ends, which come in order of node and shard; one part of them is in memory at a time."""
    key, state = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for k, data in zip(batch.column("key").to_pylist(), batch.column("ends"), strict=True):
            numbers = ",".join(map(str, unpacked(data.as_py(), np.int64).tolist())).encode()
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(numbers)
            else:
                state.update(b"," + numbers)
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "digest"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "digest"])


OUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, the root first in depth.

    A conversation in which nothing is left is a member of the root.  Rows that
    are repeated are turns of their own.  An empty table has no nodes.
    """
    spark = conversations.sparkSession
    own = stored(sequences(conversations), "sequences")
    whole = stored(rebuilt(own), "rebuilt")
    turns = whole.agg(F.sum(F.size("words"))).first()[0]
    if turns is None:
        return spark.createDataFrame([], ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in OUT))
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    dealt = whole.repartitionByRange(shards, "ids", "conv_id")
    rows = stored(dealt.mapInArrow(_shards, ROW), "trie-shards")

    open_nodes = rows.filter(F.col("kind") == OPEN_ROW).select(
        "shard", "first", "depth", "hi", "lo", F.col("n_convs").alias("n"), F.col("conv_id").alias("least"), F.col("n_children").alias("children"),
        F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), "words", "key",
    )
    numbers = open_nodes.agg(F.max("shard")).first()[0] + 1
    done = stored(joined_runs(open_nodes, numbers), "trie-boundary")
    ends = rows.filter(F.col("kind") == ENDS_ROW).select("key", "shard", "ends")
    digests = ends.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(_end_digests, "key binary, digest string")
    names = done.select(F.col("key").alias("up"), F.col("least").alias("parent_conv_id"))
    boundary = done.join(digests, "key", "left").join(names, "up", "left").select(
        F.col("least").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("digest", F.lit(EMPTY)).alias("ends_sha256"),
    )

    # Nodes within a shard whose parent was open: per shard and depth, so that a parent of many is no single key.
    closed = rows.filter(F.col("kind") == NODE_ROW).withColumn("depth", F.col("depth").cast("long"))
    inner = closed.filter("up_depth is null").select(*OUT)
    named = rows.filter(F.col("kind") == OPEN_ROW).select("shard", F.col("first").alias("up_first"), F.col("depth").alias("up_depth"), "key")
    named = named.join(done.select("key", F.col("least").alias("_parent")), "key").drop("key")
    outer = closed.filter("up_depth is not null").drop("parent_conv_id", "key").join(named, ["shard", "up_first", "up_depth"]).withColumnRenamed("_parent", "parent_conv_id").select(*OUT)
    return inner.unionByName(outer).unionByName(boundary)
