"""Repeated passages, set join, decontamination, licences."""

from __future__ import annotations

import glob
import hashlib
import random
import re
import tempfile
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import SCHEMA, documents, prose, words
from tillspark.llm import blocks, components, decontaminate, licences, repeats, set_join, tables
from tillspark.llm.licence_texts import TEMPLATES


@pytest.fixture(scope="module")
def rows():
    return documents(seed=2)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def first_places(rows):
    places = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        for s in range(len(w) - repeats.WINDOW + 1):
            key, place = tuple(w[s : s + repeats.WINDOW]), (-1 if doc_id is None else doc_id, s)
            places[key] = min(places.get(key, place), place)
    return places


def test_repeats_match_brute_force(docs, rows):
    places = first_places(rows)
    expected = []
    for doc_id, text, *_ in rows:
        w = words(text)
        gone = set()
        for s in range(len(w) - repeats.WINDOW + 1):
            if places[tuple(w[s : s + repeats.WINDOW])] < (-1 if doc_id is None else doc_id, s):
                gone.update(range(s, s + repeats.WINDOW))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        expected.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = repeats.without_repeats(docs, block_rows=16).select("c0", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert any(e[2] for e in expected)


def test_repeats_in_blocks_of_few_rows(spark, rows):
    docs = spark.createDataFrame(rows[:60], SCHEMA).repartition(3)
    table = blocks.in_blocks(docs, ["doc_id", "text"], rows=7)
    sizes = [r["count"] for r in table.groupBy("block").count().collect()]
    assert sum(sizes) == 60 and max(sizes) <= 7


def test_repeats_of_nothing_and_columns(spark, docs):
    assert repeats.without_repeats(docs.limit(0)).count() == 0
    text = " ".join(prose(random.Random(5), 30))
    df = spark.createDataFrame([(1, text, 3, "a"), (2, text, 4, "b"), (3, "short", 5, "c"), (4, None, 6, None)], "doc_id long, text string, block int, id string")
    kept = repeats.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(r["block"] for r in kept.collect()) == [3, 5, 6]


def test_only_repeated_passages_change(spark):
    rng = random.Random(8)
    passage, lines = " ".join(prose(rng, 30)), lambda: "\t" + "\n".join("  ".join(prose(rng, 8)) for _ in range(4)) + "\r\n"
    clean, head, tail, other = lines(), lines(), lines(), lines()
    rows = [(1, clean, 7), (2, passage, 8), (3, f"{head}{passage}\n{tail}", 9), (4, f"{clean[:40]}\n{passage} \n", 9), (5, f" {passage}  {other}", 9), (6, None, None), (7, " \n", 2), (8, passage, 3)]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in repeats.deduplicated(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert got.pop(5)[0] == f" {other.lstrip()}"
    left = {3: f"{head}{tail.lstrip()}", 4: f"{clean[:40].rstrip()} \n"}
    assert got == {1: (clean, 7), 2: (passage, 8), 6: (None, None), 7: (" \n", 2)} | {k: (v, len(v)) for k, v in left.items()}


def test_sketch_never_counts_too_low():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    hashes[100:140] = hashes[:40]
    for cells in repeats.counters(hashes, 64):
        counted = np.bincount((cells % np.uint64(64)).astype(np.int64), minlength=64)
        assert (counted[(cells[:40] % np.uint64(64)).astype(np.int64)] >= 2).all()


def shingles(text):
    w = words(text, lower=True)
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [(d, shingles(t)) for d, t, *_ in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 90 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def near_group(rng, first_id, members, size, most):
    """Copies of one text with different numbers of edits, so that some link and others don't."""
    base = prose(rng, size)
    out = []
    for k in range(members):
        w = list(base)
        for _ in range(rng.randrange(0, most)):
            w[rng.randrange(len(w))] = "".join(prose(rng, 2))
        out.append((first_id + k, " ".join(w), None, None, 0))
    return out


@pytest.mark.parametrize("small_entry", [32, 4])
def test_components_match_brute_force(spark, rows, monkeypatch, small_entry):
    monkeypatch.setattr(set_join, "SMALL_ENTRY", small_entry)
    monkeypatch.setattr(set_join, "BLOCK", 8)
    rng = random.Random(7)
    rows = rows + near_group(rng, 1000, 60, 120, 9) + near_group(rng, 2000, 40, 14, 3)
    rng.shuffle(rows)
    got = set_join.linked(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    expected = brute_components(rows)
    assert sorted(map(tuple, got), key=str) == expected
    assert len({c for _, _, c in expected}) < len(expected) - 20


def test_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    rng = random.Random(11)
    rows = near_group(rng, 1000, 200, 150, 16)
    rng.shuffle(rows)
    pairs, similar_pairs = [], set_join.similar_pairs

    def counted(found, *args):
        pairs.append(found.count())
        return similar_pairs(found, *args)

    monkeypatch.setattr(set_join, "similar_pairs", counted)
    got = set_join.linked(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == brute_components(rows)
    assert sum(pairs) <= 8 * len(rows)


def test_of_entries_with_the_same_members_one_is_kept(spark):
    members = {1: [5, 6, 7, 8], 2: [5, 6, 7, 8], 3: [5, 6, 7, 9], 4: [5, 8], 5: [4], 6: [5, 5, 8], 7: [5, 8, 8]}
    rows = [(i, entry, 9 if i == 6 else 2) for entry, ids in members.items() for i in ids]
    got = set_join.kept_entries(spark.createDataFrame(rows, "id long, entry long, degree long")).collect()
    kept = sorted((r["entry"], r["members"], r["low"], r["high"], r["hub"]) for r in got)
    assert kept == [(1, 4, 5, 8, 6), (3, 4, 5, 9, 6), (4, 2, 5, 8, 5), (6, 3, 5, 8, 5), (7, 3, 5, 8, 5)]


def test_set_join_of_nothing(docs):
    assert set_join.linked(docs.limit(0)).count() == 0
    alone = set_join.linked(docs.filter("doc_id < 3")).collect()
    assert len(alone) == 3


def test_similar_sets_share_an_entry():
    rng = np.random.default_rng(5)
    sets = []
    for trial in range(800):
        base = rng.integers(0, 1 << 62, int(rng.integers(1, 40 if trial % 2 else 400))).astype(np.uint64)
        other = base[rng.random(len(base)) > 0.04]
        more = rng.integers(0, 1 << 62, int(rng.integers(0, len(base) // 20 + 2))).astype(np.uint64)
        sets += [np.unique(base), np.unique(np.append(other, more))]
    sizes = np.array([len(s) for s in sets])
    owner, entry = set_join.entries(np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets), sizes)
    of = [set(entry[owner == k].tolist()) for k in range(len(sets))]
    similar = 0
    for k in range(0, len(sets), 2):
        a, b = set(sets[k].tolist()), set(sets[k + 1].tolist())
        if 100 * len(a & b) >= 90 * len(a | b):
            similar += 1
            assert of[k] & of[k + 1]
    assert similar > 200


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 140)] + [(7, 7), (200, 150), (150, 200)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 51)}, **{k: 100 for k in range(101, 140)}, 200: 150}


def edit_distance_to_some_part(item, text, start):
    """Least distance of the item to a part of the text that begins at ``start``."""
    row = list(range(len(text) - start + 1))
    for i, x in enumerate(item, 1):
        new = [i]
        for j in range(1, len(row)):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != text[start + j - 1])))
        row = new
    return min(row)


def test_passages_of_items_are_found(spark):
    rng = random.Random(4)
    common = ["".join(prose(rng, 1)) for _ in range(60)]
    make = lambda n: [rng.choice(common) if rng.random() < 0.4 else "".join(prose(rng, 2)) for _ in range(n)]
    items = [(i, " ".join(make(rng.randrange(8, 60)))) for i in range(40)] + [(90, "too few"), (91, None), (None, "no id of the item at all")]
    rows, truth = [], {}
    for d in range(160):
        w = make(rng.randrange(5, 200))
        if d % 2:
            i = rng.randrange(40)
            part = items[i][1].split()
            for _ in range(rng.randrange(len(part) // 5 + 1)):
                at = rng.randrange(len(part))
                part[at : at + rng.randrange(2)] = make(rng.randrange(2))
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() + "," for x in part]
            truth[d] = i
        rows.append((d, " ".join(w)))
    rows += [(500, None), (501, ""), (None, items[0][1]), (502, items[1][1] + " " + items[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.matches(docs, bench).collect()
    texts, by_id = {d: words(t, lower=True) for d, t in rows}, dict(items)
    for r in got:
        text, item = [w.strip(",") for w in texts[r["doc_id"]]], words(by_id[r["item_id"]], lower=True)
        assert r["distance"] <= len(item) // 5
        assert edit_distance_to_some_part(item, text[: r["first_word"] + len(item) * 2], r["first_word"]) == r["distance"]
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(found & set(truth.items())) >= 0.95 * len(truth)
    assert not [d for d, _ in found if d is not None and d < 500 and d not in truth]
    assert sum(r["doc_id"] == 502 and r["item_id"] == 1 for r in got) == 2
    assert (None, 0) in found
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in rows if d is not None} - {d for d, _ in found}
    assert decontaminate.matches(docs.limit(0), bench).count() == 0
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == len(rows)


def test_walks_match_a_plain_version():
    rng = np.random.default_rng(2)
    rows = rng.integers(1, 1 << 62, (20, 12)).astype(np.uint64)
    steps, places = rng.integers(64, size=18, dtype=np.uint64), np.array([4, 17])
    got = decontaminate.embed(rows, steps, places)
    for row, key in zip(rows, got, strict=True):
        at, expected = 0, np.zeros(1, np.uint64)
        for j in range(18):
            if j in places:
                expected = decontaminate.mix(expected + row[at : at + 1])
            at = min(at + (int(row[at]) >> int(steps[j]) & 1), 11)
        assert key == expected[0]


def dice(a, b):
    pairs = lambda t: set(zip(t, t[1:], strict=False))
    x, y = pairs(a), pairs(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def plain(text):
    out = "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text)
    return words(out)


def test_licences_match_brute_force(spark):
    rng = random.Random(9)
    rows = documents(seed=3, n=40)
    for k, (_, text) in enumerate(TEMPLATES):
        edited = text.split()
        for _ in range(len(edited) // 15):
            edited[rng.randrange(len(edited))] = "changed"
        body = " ".join(prose(rng, 40))
        rows.append((3000 + k, f"{body}\n{' '.join(edited)}\n{body}", None, None, 0))
        rows.append((4000 + k, text.upper(), None, None, 0))
    got = {}
    for r in licences.licences(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect():
        got.setdefault(r["doc_id"], {})[r["licence"]] = r["dice"]
    for doc_id, text, *_ in rows:
        expected: dict[str, float] = {}
        for unit in [text or "", *(text or "").split("\n")]:
            for name, template in TEMPLATES:
                value = dice(plain(unit), plain(template))
                if value >= licences.LIMIT:
                    expected[name] = max(expected.get(name, 0), value)
        assert got.get(doc_id, {}) == pytest.approx(expected), doc_id
    assert sum(1 for d in got if d and d >= 3000) > 40


def test_licence_text_set_in_lines_is_one_passage(spark):
    lines = TEMPLATES[0][1].split()
    body = "\n".join(" ".join(lines[i : i + 9]) for i in range(0, len(lines), 9))
    text = f"{' '.join(prose(random.Random(1), 300))}\n\n{body}\n\n{' '.join(prose(random.Random(2), 300))}"
    (found,) = licences.licences(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (found["licence"], found["unit"], found["first_word"]) == ("MIT", "passage", 300)
    assert found["dice"] > 0.99
    assert licences.licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def shuffle_files():
    return set(glob.glob(f"{tempfile.gettempdir()}/blockmgr-*/*/shuffle_*"))


def test_shuffle_files_of_a_stored_table_go(spark):
    before, setting = shuffle_files(), spark.conf.get(tables.SHUFFLES_GO)
    table = tables.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(20):
        if not (left := shuffle_files() - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(tables.SHUFFLES_GO) == setting
    assert sum(r["count"] for r in table.collect()) == 1000


def test_set_join_picks_member_texts_without_a_shuffle(spark, docs, monkeypatch, capsys):
    plans, stored = {}, set_join.stored

    def explained(df, name, *args):
        capsys.readouterr()
        df.explain("formatted")
        plans[name] = capsys.readouterr().out
        return stored(df, name, *args)

    monkeypatch.setattr(set_join, "stored", explained)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert set_join.linked(docs).count() == docs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [x for x in plans["entry-texts"].split("\n\n") if re.match(r"\(\d+\) Exchange", x.strip())]
    assert moved and not any("text#" in x for x in moved)


def test_member_texts_of_a_block():
    own = pa.table({"id": pa.array([5, 5, 6, None, 7], pa.int64()), "text": ["a", "b", "c", "d", None], "block": pa.array([0] * 5, pa.int64())})
    wanted = pa.table({"block": pa.array([0] * 4, pa.int64()), "id": pa.array([5, 5, 7, 8], pa.int64()), "n": pa.array([1, 2, 3, 4], pa.int64())})
    got = set_join._wanted_texts(own, wanted)
    assert sorted(map(str, got.to_pylist())) == sorted(str({"id": i, "n": n, "text": t}) for i, n, t in [(5, 1, "a"), (5, 2, "a"), (5, 1, "b"), (5, 2, "b"), (7, 3, None)])
    assert set_join._wanted_texts(own.slice(0, 0), wanted).num_rows == set_join._wanted_texts(own, wanted.slice(0, 0)).num_rows == 0
