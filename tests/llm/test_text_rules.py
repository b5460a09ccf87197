"""Quality rules, host reputation, mixing."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.corpus import SCHEMA, documents, words
from tillspark.llm import host_reputation, mixing, weak_rules


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3)


def counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_counts_match_a_plain_version(spark, docs):
    odd = [(1, "a b c a b c", None, None, 0), (2, "x\nx\n \nx", None, None, 0), (3, "# a *b $%&|<>", None, None, 0), (4, "a a a a", None, None, 0)]
    both = docs.unionByName(spark.createDataFrame(odd, SCHEMA).withColumn("doc_id", F.col("doc_id") + 10_000))
    got = weak_rules.judge(both, ["doc_id", "text"]).collect()
    assert len(got) == both.count()
    for r in got:
        expected = counts(r["text"])
        assert tuple(r[c] for c in weak_rules.COUNTS) == expected, r["text"]
        assert r["base_failed"] == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r["base_failed"] and r["kept"])
        assert 0 <= r["quality"] <= 1


def posterior(model, votes):
    odds = model.prior + sum(w[v + 1] for w, v in zip(model.weights, votes, strict=True))
    return 1 / (1 + math.exp(-odds))


def test_rounds_match_a_plain_version(spark):
    n = len(weak_rules.RULES)
    rows = [[1] * n] * 60 + [[1] * (n - 2) + [-1, -1]] * 8 + [[-1, 0] + [1] * (n - 2)] * 3 + [[0] * n] * 2
    model = weak_rules.fit(spark.createDataFrame([(r,) for r in rows], "votes array<int>"), rounds=3)
    good, rates = weak_rules.FIRST_GOOD, [(weak_rules.FIRST_ON_GOOD, weak_rules.FIRST_ON_BAD)] * n
    for _ in range(3):
        p = [posterior(weak_rules._model(good, rates), r) for r in rows]
        g, t, s = sum(p), len(rows), weak_rules.PRIOR_VOTES
        rates = []
        for k in range(n):
            on = [sum(x for x, r in zip(p, rows, strict=True) if r[k] == v) for v in (-1, 0, 1)]
            every = [sum(r[k] == v for r in rows) for v in (-1, 0, 1)]
            rates.append((tuple((x + s) / (g + 3 * s) for x in on), tuple((e - x + s) / (t - g + 3 * s) for e, x in zip(every, on, strict=True))))
        good = (g + s) / (t + 2 * s)
    expected = weak_rules._model(good, rates)
    assert model.prior == pytest.approx(expected.prior)
    for a, b in zip(model.weights, expected.weights, strict=True):
        assert a == pytest.approx(b)


def test_filter_keeps_columns_whatever_their_names(spark):
    text = " ".join(f"word{i}" for i in range(200))
    df = spark.createDataFrame([(1, text, "z", 5), (2, "short", "z", 6), (None, text, None, None)], "doc_id long, text string, _words string, n_words int")
    kept = weak_rules.good_documents(df)
    assert kept.columns == df.columns
    assert sorted((r["n_words"] or 0) for r in kept.collect()) == [0, 5]
    assert weak_rules.good_documents(df.limit(0)).count() == 0


def test_host_and_path(spark):
    urls = ["http://A.Example.COM/x/y?q#f", "https://h", "h/no/scheme", None, "", "http://h?x/y", "a://b://c/d", "http://É.org#", "http://u:p@H:80/p"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(host_reputation.host(F.col("url")), host_reputation.path(F.col("url"))).collect()
    assert [tuple(r) for r in rows] == [
        ("a.example.com", "/x/y"), ("h", ""), ("", ""), ("", ""), ("", ""), ("h", ""), ("b:", "//c/d"), ("É.org", ""), ("u:p@h:80", "/p"),
    ]


def test_longest_rule_wins_and_bad_hosts_are_blocked(spark):
    pages = [(i, f"http://bad{i % 2}.example.org/p{i}") for i in range(60)] + [(i, f"http://good.net/p{i}") for i in range(60, 160)]
    pages += [(200, "http://x.good.net/en/a"), (201, "http://good.net/en"), (202, None), (None, "http://bad0.example.org/")]
    outcomes = [(i, 1) for i in range(60)] + [(i, 0) for i in range(60, 160)] + [(None, 1), (5, None), (999, 1)]
    rules = spark.createDataFrame([("net/", "block"), ("good.net/en/", "allow")], "rule string, verdict string")
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = host_reputation.judge(df, spark.createDataFrame(outcomes, "page_id long, bad int"), rules).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(pages)
    assert (by[200]["rule"], by[200]["verdict"]) == ("good.net/en/", "allow")
    assert (by[201]["rule"], by[201]["verdict"]) == ("net/", "block")
    assert (by[202]["host"], by[202]["path"], by[202]["rule"]) == ("", "", None)
    assert by[3]["verdict"] == by[None]["verdict"] == "block" and by[3]["rule"] is None
    none = host_reputation.judge(df, spark.createDataFrame([], "page_id long, bad int"), rules.limit(0))
    assert {r["verdict"] for r in none.collect()} == {"allow"}
    assert host_reputation.judge(df.limit(0), spark.createDataFrame(outcomes, "page_id long, bad int"), rules).count() == 0


def shared_out(sizes):
    """Targets by sharing again and again what exceeds three times a source's size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        part = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s: 3 * sizes[s] for s in rest if part[s] > 3 * sizes[s]}
        if not over:
            return {**fixed, **part}
        fixed |= over


def test_mix_reaches_its_targets(spark, docs):
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(5)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["taken"])
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    sizes, taken = Counter(), Counter()
    texts = defaultdict(set)
    for r in docs.collect():
        texts[r["doc_id"]].add(len(words(r["text"])))
    for r in sorted(got, key=key):
        assert r["size"] in texts[r["doc_id"]]
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    targets = shared_out(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]])
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 2 * mixing.BLOCK_WORDS


def test_mix_draws_every_block_equally_often(spark, docs):
    sizes = mixing.sized(docs)
    sources = mixing.with_targets(sizes)
    drawn = mixing.block_draws(sources).collect()
    placed = mixing.placed(sizes, sources, docs.count())
    rows = mixing.mixed(placed, sources).select("shard", "number", "draw", "block").distinct().collect()
    assert Counter(r["number"] for r in rows) == {r["number"]: r["draws"] for r in drawn if r["draws"]}
    for d in drawn:
        times = Counter(r["block"] for r in rows if r["number"] == d["number"])
        assert all(0 <= b < d["n_blocks"] for b in times)
        assert not d["draws"] or max(times.values()) - min([times[b] for b in range(d["n_blocks"])]) <= 1


def test_permutations_are_permutations(spark):
    for n in (1, 2, 7, 1000):
        image = mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5))
        assert sorted(r["id"] for r in spark.range(n).select(image.alias("id")).collect()) == list(range(n))


def test_mix_of_nothing(spark, docs):
    assert mixing.mix(docs.limit(0)).count() == 0
    empty = mixing.mix(docs.withColumn("text", F.lit(None).cast("string"))).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in empty} == {(0, 0.0, 0)}
