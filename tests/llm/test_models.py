"""Language identification, hidden Markov model, WARC archives."""

from __future__ import annotations

import base64
import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.corpus import SCHEMA, documents, words
from tillspark.llm import hmm, language_id, warc


@pytest.fixture(scope="module")
def rows():
    return documents(seed=5, n=60)


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def cuts(word):
    for marks in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, mark in enumerate(marks, 1):
            if mark:
                parts.append(word[start:i])
                start = i
        yield [*parts, word[start:]]


def test_forward_and_uses_match_all_segmentations():
    vocabulary = language_id.load_vocabulary(language_id.vocabulary_file())
    lookup, number = language_id.Lookup(vocabulary), {p: i for i, p in enumerate(vocabulary)}
    chances = np.random.default_rng(0).random((len(vocabulary), 2))
    spelled = [b" hello", b" le", b" x\xc3\xa9z", b" a"]
    counts = np.array([[1, 2], [3, 0], [0, 1], [2, 2.0]])
    group = language_id.Words(spelled, lookup)
    total, uses = group.whole(group.forward(chances)), group.used(chances, counts)
    expected = np.zeros_like(chances)
    for i, word in enumerate(spelled):
        for k in range(2):
            ways = [(p, math.prod(chances[number[x], k] for x in p)) for p in cuts(word) if all(x in number for x in p)]
            whole = sum(v for _, v in ways)
            assert total[i, k] == pytest.approx(whole)
            for parts, v in ways:
                for x in parts:
                    expected[number[x], k] += counts[i, k] * v / whole
    assert np.allclose(uses, expected)


def test_words_share_the_work_on_their_beginnings():
    vocabulary = language_id.load_vocabulary(language_id.vocabulary_file())
    lookup = language_id.Lookup(vocabulary)
    chances = np.random.default_rng(1).random((len(vocabulary), 2))
    rng = random.Random(2)
    spelled = [b" information" + bytes(x) for x in itertools.permutations(b"abcdefgh", 3)] + [b" \x00", b" \x00\x00", b" \xff\xfe", b" i", b" "]
    rng.shuffle(spelled)
    group = language_id.Words(spelled, lookup)
    beginnings = {x[:i] for x in spelled for i in range(len(x) + 1)}
    assert group.forward(chances).size == 2 * len(beginnings)
    known = set(vocabulary)
    fits = sum(x[-k:] in known for x in beginnings for k in range(1, min(len(x), language_id.MAX_PIECE) + 1))
    assert sum(len(f[0]) for f in group.fits.values()) == fits
    counts = np.array([[rng.randrange(4), rng.randrange(4)] for _ in spelled], float)
    total, uses = group.whole(group.forward(chances)), group.used(chances, counts)
    alone = [language_id.Words([x], lookup) for x in spelled]
    assert np.allclose(total, [g.whole(g.forward(chances))[0] for g in alone], rtol=1e-12)
    assert np.allclose(uses, sum(g.used(chances, c[None]) for g, c in zip(alone, counts, strict=True)))
    nothing = language_id.Words([], lookup)
    assert nothing.whole(nothing.forward(chances)).shape == (0, 2) and not nothing.used(chances, counts[:0]).any()


def test_counts_and_scores_do_not_depend_on_how_many_words_are_kept(monkeypatch):
    vocabulary = language_id.load_vocabulary(language_id.vocabulary_file())
    chances = np.random.default_rng(3).dirichlet(np.ones(len(vocabulary)), 2).T
    model = language_id.Model(["a", "b"], vocabulary, chances)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("aeinrst\u00e9") for _ in range(rng.randrange(1, 9))) for _ in range(40)) for _ in range(30)] + ["", None, "x" * 100]
    texts += texts[:5]
    table = pa.table({"id": range(len(texts)), "text": texts, "language": [i % 2 for i in range(len(texts))], "letters": [bool(x) for x in texts]})

    def both():
        uses = np.zeros_like(chances)
        for b in language_id._expected(iter(table.to_batches(max_chunksize=4)), model):
            uses[b.column("piece").to_numpy(), b.column("language").to_numpy()] += b.column("uses").to_numpy()
        return uses, pa.Table.from_batches(language_id._scores(iter(table.to_batches(max_chunksize=4)), model)).to_pydict()

    uses, scores = both()
    monkeypatch.setattr(language_id, "KNOWN_WORDS", 200)
    monkeypatch.setattr(language_id, "GROUP_WORDS", 7)
    few_uses, few_scores = both()
    assert np.allclose(uses, few_uses)
    assert scores["lang_pred"] == few_scores["lang_pred"] and np.allclose(scores["score"], few_scores["score"])
    assert scores["lang_pred"][30:32] == ["und", "und"] and scores["score"][:5] == pytest.approx(scores["score"][-5:])


def test_languages_are_told_apart(spark):
    rng = random.Random(1)
    lines = {"en": ["the", "and", "with", "ing", "there", "house"], "de": ["der", "und", "mit", "ung", "straße", "haus"], "es": ["el", "y", "con", "ción", "niño", "casa"]}
    rows = [(i, " ".join(rng.choice(lines[g]) for _ in range(rng.randrange(4, 60))), g) for i in range(240) for g in [["en", "de", "es"][i % 3]]]
    rows += [(900, None, "en"), (901, "", "de"), (902, "12 !!", None), (903, "中文 text", None), (None, "the house", "en"), (904, "y" * 3000, "es")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r["doc_id"]: r for r in language_id.identified(docs).collect()}
    assert len(got) == len(rows)
    for doc_id, _, lang in rows[:240]:
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
        assert got[doc_id]["lang_pred"] == lang and 0.5 < got[doc_id]["score"] <= 1
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert got[903]["lang_pred"] != "und" and got[None]["held_out"] is False
    moved = {r["doc_id"]: r["lang_pred"] for r in language_id.identified(docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit("xx")).otherwise(F.col("lang")))).collect()}
    assert moved == {k: r["lang_pred"] for k, r in got.items()}
    assert language_id.identified(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language_id.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_chains_match_all_state_paths():
    rng, k, s = np.random.default_rng(1), 3, 5
    model = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(s), k).T)
    texts = [rng.integers(0, s, n) for n in (1, 4, 6, 2)]
    sequence, first = np.concatenate(texts), np.append(0, np.cumsum([len(x) for x in texts]))
    scores = hmm.log10_forward(model, sequence, first)
    starts, moves, emissions = np.zeros(k), np.zeros((k, k)), np.zeros((s, k))
    for i, x in enumerate(texts):
        paths = []
        for p in itertools.product(range(k), repeat=len(x)):
            v = model.start[p[0]] * model.emit[x[0], p[0]]
            for t in range(1, len(x)):
                v *= model.move[p[t - 1], p[t]] * model.emit[x[t], p[t]]
            paths.append((p, v))
        whole = sum(v for _, v in paths)
        assert scores[i] == pytest.approx(math.log10(whole))
        for p, v in paths:
            starts[p[0]] += v / whole
            for t in range(len(x)):
                emissions[x[t], p[t]] += v / whole
                if t:
                    moves[p[t - 1], p[t]] += v / whole
    for a, b in zip(hmm.baum_welch(model, *hmm.segments(sequence, first)), (starts, moves, emissions), strict=True):
        assert np.abs(a - b).max() < 1e-5


def test_every_round_of_training_sees_all_texts(spark):
    rng, topics = random.Random(6), [["sun", "rain", "wind", "snow"], ["bread", "salt", "oil"], ["lute", "drum", "horn", "harp", "bell"]]
    texts = [" ".join(rng.choice(topics[rng.randrange(3) if rng.random() < 0.1 else i % 3]) for _ in range(rng.randrange(10, 30))) for i in range(1500)]
    _, hashes, _ = hmm.tokens(pa.array(texts))
    symbols = hmm.Symbols(np.unique(hashes), np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES))
    sequence, first = hmm.sequences(pa.array(texts), symbols)
    model, before, calm = hmm.first_model(symbols, 3), -math.inf, 0
    while calm < 3:
        *counts, chance = hmm.expected_counts(model, *hmm.segments(sequence, first))
        model = hmm.improved(*counts)
        calm = calm + 1 if chance / len(sequence) - before < 1e-5 else 0
        before = chance / len(sequence)
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    got = hmm.train(rows, len(texts), symbols, 3)
    assert np.abs(got.emit - model.emit).max() < 1e-3 and np.abs(got.move - model.move).max() < 1e-3
    assert before == pytest.approx(hmm.log10_forward(model, sequence, first).sum() * math.log(10) / len(sequence), abs=1e-3)


def test_base_scores_match_brute_force(docs, rows):
    fold = lambda d: -1 if d is None else zlib.crc32(str(d).encode()) % 7
    counts = Counter()
    for d, text, *_ in rows:
        if fold(d) != 2:
            counts.update([*words(text, lower=True), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for d, text, *_ in rows:
        tokens = [*words(text, lower=True), None]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in tokens)
        expected.append((str(d), fold(d) == 2, len(tokens), sum(counts[x] > 0 for x in tokens), n, round(base, 6)))
    got = hmm.scored(docs).collect()
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == sorted(expected)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])


def test_chances_of_next_words_sum_to_one():
    """Over all known words and the room for unknown ones, every class gives out exactly its chance."""
    counts = np.array([5, 3, 0, 2])
    n, v = counts.sum(), (counts > 0).sum()
    assert ((counts[counts > 0] + 1) / (n + v + 1)).sum() + 1 / (n + v + 1) == pytest.approx(1)


def test_scoring_nothing(docs):
    assert hmm.scored(docs.limit(0)).count() == 0


def sha1(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(3)
    rows = [(i, f"http://h/{i}", f"<p>{rng.choice('abc') * rng.randrange(6)}</p>") for i in range(300)]
    rows += [(400, None, None), (401, "http://x\r\ny", ""), (402, "http://é", "é中\u0000\r\n\r\n" + "z" * 200_000), (None, "n", "<p></p>"), (5, "again", "<p>only here</p>"), rows[7]]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_archives_round_trip(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", 40)
    folder = str(tmp_path / "archives")
    warc.write_archives(pages, folder)
    got = warc.read_archives(spark, folder).collect()
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    last = {}
    for page_id, payload in rows:
        last[payload] = max(last.get(payload, -1), -1 if page_id is None else page_id)
    expected = []
    for page_id, payload in rows:
        response = (-1 if page_id is None else page_id) == last[payload]
        expected.append((page_id, len(payload), sha1(payload), "response" if response else "revisit", None if response else last[payload]))
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str) == sorted(expected, key=str)
    assert {bytes(r["payload"]) for r in got if r["record_type"] == "response"} == {p for _, p in rows}
    assert {r["url"] for r in got if r["page_id"] in (400, 401, 402)} == {None, "http://x%0D%0Ay", "http://é"}
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "archives").glob("part-*")))
    for magic, frame in warc.frames(memoryview(whole)):
        assert magic in warc.SKIPPABLE or zstandard.get_frame_parameters(bytes(frame)).dict_id >= 0


def archive(*records, dictionary=b"WARC/1.1 dictionary content"):
    d = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    head = (warc.DICTIONARY_MAGIC).to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary
    return head + b"".join(zstandard.ZstdCompressor(dict_data=d, write_checksum=True).compress(r) for r in records)


def test_faults_are_found():
    good = warc.record(1, "u", b"abc", sha1(b"abc"), None, False)
    (row,) = warc.read_records(archive(good))
    assert (row["page_id"], row["payload"]) == (1, b"abc")
    bad = {
        "length": good.replace(b"Content-Length: 3", b"Content-Length: 4"),
        "digest": good.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"),
        "version": good.replace(b"WARC/1.1", b"WARC/9.9"),
        "missing": good.replace(b"WARC-Date: ", b"X-Date: "),
    }
    for record in bad.values():
        with pytest.raises(warc.BadArchive):
            list(warc.read_records(archive(record)))
    for data in (archive(good)[:-3], archive(good) + b"junk", archive(good)[30:], good):
        with pytest.raises(warc.BadArchive):
            list(warc.read_records(data))
    assert list(warc.read_records(b"")) == []


def test_archives_of_nothing(spark, pages, tmp_path):
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
