"""The pipeline's stages, each on what the one before has kept."""

from __future__ import annotations

import os
import random

import pytest

import corpus_pipeline
from tests.llm.corpus import SCHEMA, prose, words
from tillspark.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    passage, leak = prose(rng, 60), prose(rng, 40)
    clean = [" ".join(prose(rng, 150)).capitalize() + "." for _ in range(60)]
    near = clean[3].split()
    near[50] = "changed"
    junk = [" ".join(f"{w}***" for w in prose(rng, 150)) for _ in range(4)] + ["spam " * 200, "short text"]
    texts = [*clean, clean[0], " ".join(near), *junk, " ".join([*prose(rng, 100), *leak, *prose(rng, 100)])]
    texts += [" ".join([*prose(rng, 120), *passage, *prose(rng, 120)]) for _ in range(3)] + [None]
    rows = [(i, t, "en", f"s{i % 4}", 0) for i, t in enumerate(texts)] + [(None, " ".join(prose(rng, 150)), None, None, None)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(leak))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs, seen = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    quality, near, cut, leaks = seen.values()
    everything = set(range(73)) | {None}
    assert everything - set(quality) == {*range(62, 68), 72}
    assert set(quality) - set(near) == {60, 61}
    assert set(near) == set(cut)
    assert len(words(cut[69])) == 300 and len(words(cut[70])) == len(words(cut[71])) == 240
    assert all(words(cut[i]) == words(near[i]) for i in range(60))
    assert set(cut) - set(leaks) == {68}
    mixed = docs.collect()
    assert {r["doc_id"] for r in mixed} == set(leaks)
    assert all(r["size"] == len(words(leaks[r["doc_id"]])) and r["taken"] <= 3 * r["size"] for r in mixed)


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(12)
    rows = []
    for base in range(40):
        text = prose(rng, rng.choice([12, 40, 60, 150, 400]))
        for _ in range(4):
            near = list(text)
            for at in rng.sample(range(len(text)), rng.randrange(len(text) // 40 + 2)):
                near[at] = "".join(prose(rng, 3))
            rows.append((len(rows), " ".join(near), "en", "a", 0))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for _, t, *_ in rows for w in [words(t, lower=True)]]
    threes = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for _, t, *_ in rows for w in [words(t, lower=True)]]
    label, between = list(range(len(rows))), 0
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
                between += 100 * len(threes[a] & threes[b]) < 90 * len(threes[a] | threes[b])
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "")
    assert {r["doc_id"] for r in kept.collect()} == set(label)
    assert between > 5


def test_run_applies_all_stages(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() == 64


def test_every_operator_is_registered():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are missing")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for table in ("documents", "pages", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = queries.QUERIES[name](spark, FOLDER)
    answer = connection.execute(queries.ORACLE_SQL[name])
    assert sorted(d[0] for d in answer.description) == sorted(result.columns)
    found = result.select(*[d[0] for d in answer.description]).collect()
    assert sorted(map(tuple, found), key=str) == sorted(answer.fetchall(), key=str)
