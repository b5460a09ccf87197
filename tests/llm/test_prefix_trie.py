"""Prefix trie against a plain version."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tillspark.llm import prefix_trie
from tillspark.llm.oracle import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = (own.get(base, [])[:h]) + own[c][h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        own_saved = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        saved[node] = own_saved + sum(saved[c] for c in children[node])
    return sorted([
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest())
        for node, m in members.items()
    ], key=str)


def conversations(seed, n=120, kinds=3):
    rng = random.Random(seed)
    texts = [None, "", "one", "two words", "three words here"][: kinds + 2]
    rows = []
    for c in rng.sample(range(-30, n * 2), n):
        for turn in range(rng.choice([1, 2, 2, 3, 5, 9])):
            rows.append((c, None if turn == 0 and c % 7 == 0 else turn, rng.choice(["user", None]), rng.choice(texts)))
    same = [(500 + k, turn, "user", f"shared {turn}") for k in range(60) for turn in range(6)]
    long = [(800, turn, "user", f"turn {turn}") for turn in range(90)] + [(801, turn, "user", f"turn {turn}") for turn in range(70)]
    odd = [(None, 1, "user", "no conversation"), (900, 1, "user", "x" * 4000), rows[0], rows[0]]
    return rows + same + long + odd


@pytest.mark.parametrize(("seed", "partitions", "columns", "fan_in"), [(1, 1, 32, 64), (2, 7, 2, 2), (3, 40, 3, 3), (4, 13, 1, 2)])
def test_trie_matches_a_plain_one(spark, monkeypatch, seed, partitions, columns, fan_in):
    monkeypatch.setattr(prefix_trie, "COLUMNS", columns)
    monkeypatch.setattr(prefix_trie, "FAN_IN", fan_in)
    rows = [r for r in conversations(seed)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = prefix_trie.trie(spark.createDataFrame(rows, SCHEMA).repartition(3)).select(*prefix_trie.OUT).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=str) == plain_trie(rows)


def test_sql_matches_the_plain_trie():
    rows = conversations(6)
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = db.execute(ORACLE_SQL["op13_prefix_trie"]).fetchall()
    assert sorted(got, key=str) == plain_trie(rows)


@pytest.mark.parametrize("pieces", [1, 2, 3, 5, 8, 20])
def test_runs_of_any_size_give_the_same_nodes(pieces):
    """Merging neighbouring shards closes every node once, with the sums of the whole."""
    rng = np.random.default_rng(pieces)
    paths = sorted([rng.integers(0, 2, rng.integers(0, 6)).tolist() for _ in range(40)])

    def nodes(cut):
        opened = prefix_trie.OPEN.replace(", ", " ").split()[::2]
        out, run = [], None
        done = set()
        for shard, own in enumerate(np.array_split(np.arange(len(paths)), cut)):
            if not len(own):
                continue
            offsets = np.append(0, np.cumsum([len(paths[i]) for i in own]))
            flat = np.array([[x, x] for i in own for x in paths[i]], np.int64).ravel()
            rows = prefix_trie.shard_rows(own.astype(np.int64), flat, np.ones(offsets[-1], np.int32), offsets, shard)
            table = [dict(zip(rows, r, strict=True)) for r in zip(*rows.values(), strict=True)]
            done |= {(r["depth"], r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in table if r["kind"] == prefix_trie.NODE_ROW}
            names = dict(n="n_convs", least="conv_id", children="n_children", leaves="n_leaves", saved="saved_tokens")
            open_rows = [{c: r[names.get(c, c)] for c in [*opened, "key"]} for r in table if r["kind"] == prefix_trie.OPEN_ROW]
            for other in prefix_trie.runs_of(pa.Table.from_pylist(open_rows)):
                run = other if run is None else prefix_trie.merged(run, other, out)
        shared = sum(x is y for x, y in zip(run.first, run.last, strict=False))
        prefix_trie.close(run.last, shared, out)
        prefix_trie.close(run.first, 0, out)
        assert len({c.key for c in out}) == len(out)
        return done | {(c.depth, c.node.least, c.node.n, c.node.children, c.node.leaves, c.node.saved) for c in out}

    assert nodes(pieces) == nodes(1)


def test_nothing_and_extra_columns(spark):
    rows = [(1, 0, "user", "a b", "x"), (2, 0, "user", "a b", "y"), (None, 0, "user", "c", "z")]
    table = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, ids string")
    assert sorted(map(tuple, prefix_trie.trie(table).collect()), key=str) == plain_trie([r[:4] for r in rows])
    assert prefix_trie.trie(table.limit(0)).collect() == []
