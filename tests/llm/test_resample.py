"""Importance resampling against a plain version, and the cutoff search against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tunesmith.llm import resample as R
from tunesmith.llm.words import pieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [*w, *(a + " " + b for a, b in zip(w, w[1:], strict=False))]


def brute(docs, target, percent, min_words, seed, buckets):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, features(x)[1]))
    for x in target:
        t.update(map(bucket, features(x)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))

    rows = []
    for d, x in docs:
        n, fs = features(x)
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n >= min_words))
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = Counter()
    ranked = []
    for i, r in enumerate(able[: percent * len(able) // 100]):
        drawn[r] += 1
        ranked.append((*r[:4], i + 1))
    left = Counter(rows) - drawn
    return ranked, sorted((r[:4] for r in left.elements()), key=str)


def some_docs():
    rng = random.Random(4)
    vocab = ["alpha", "Beta", "gamma9", "été", "ÉTÉ", "東京", "x", "de-lta"]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(0, 30)))) for i in range(200)]
    docs += [(7, docs[7][1])] * 3 + [(None, "alpha beta " * 12), (None, "gamma9 " * 25), (None, None)]
    docs += [(500, ""), (501, None), (502, "..."), (503, "a\x00b\x1fc" * 30), (504, "lang " * 3000)]
    return docs


@pytest.mark.parametrize("direct", [1, 7, 10_000])
def test_resample_equals_a_plain_version(spark, direct):
    docs, target = some_docs(), ["alpha Beta", None, "", "東京 x x", "gamma9"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("_key2", F.lit(1)).repartition(5)
    out = R.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), 25, 10, 7, 97, direct=direct)
    rows = [(r.doc_id, r._n, r._weight, r._score, r._rank, r.score) for r in out.collect()]
    assert {r[5] for r in rows} == {"mine"}
    ranked, rest = brute(docs, target, 25, 10, 7, 97)
    assert sorted((r[:5] for r in rows if r[4] is not None), key=lambda r: r[4]) == ranked
    assert sorted((r[:4] for r in rows if r[4] is None), key=str) == rest


def test_drawn_documents_keep_their_columns(spark):
    df = spark.createDataFrame(some_docs(), "doc_id long, text string").withColumn("rank", F.lit(0))
    out = R.resampled_documents(df, spark.createDataFrame([("alpha",)], "text string"), min_words=1)
    assert out.columns == ["doc_id", "text", "rank"] and out.count() == sum(features(t)[0] > 0 for _, t in some_docs()) * 25 // 100


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, none.select("text")).count() == 0
    one = spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string")
    assert [tuple(r) for r in R.resample(one, none.select("text"), keep=["doc_id"]).select("_n", "_rank").collect()] == [(59, None)]


def test_cutoff_key_is_that_of_a_sort(spark):
    rng = random.Random(2)
    keys = [(rng.randrange(-5, 5) if i % 3 else 0, rng.randrange(6) if i % 2 else 1, rng.randrange(4)) for i in range(600)]
    df = spark.createDataFrame(keys, "a long, b long, c long").repartition(7)
    for k in (1, 2, 77, 300, 599, 600):
        assert R.kth_key(df, k, direct=3) == sorted(keys)[k - 1]


def test_pieces_hold_all_words():
    data = ("ab " * 50 + "x" * 40 + "\n" + "c\td " * 30 + "y" * 99).encode()
    for size in (1, 5, 16, 1000):
        assert [w for p in pieces(data, size) for w in p] == data.split()


def test_long_texts_have_the_features_of_whole_ones(monkeypatch):
    data = ("alpha Beta " * 50 + "x" * 40 + "\n" + "c\td " * 30).encode()
    whole = sorted(R.features_of(data, 997)[1].tolist())
    monkeypatch.setattr("tunesmith.llm.words.pieces.__defaults__", (16,))
    assert sorted(R.features_of(data, 997)[1].tolist()) == whole
