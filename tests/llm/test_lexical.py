"""Ranked lexical search against scoring every document, and the bounds of the signatures."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunesmith.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    found = [(d, Counter(terms(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in found)
    total = sum(c.total() for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in found:
            s = 0
            for t in terms(text):
                if t in df and c[t]:
                    m = 75 + (25 * c.total() * n_docs) // total
                    s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def tables():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)] + ["Éte", "東京", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, " ".join(rng.choices(vocab, weights, k=rng.choice([1, 5, 40, 300])))) for i in range(250)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(5, docs[5][1])] * 2 + [(None, docs[6][1]), (None, None), (2000, None), (2001, ""), (2002, "-- ,"), (2003, "w1 W1, w1-w1 " * 900 + "w250 rare")]
    items = [(i, " ".join(rng.choices(vocab, k=rng.randrange(1, 12)))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "unheard"), (103, "w0 w0 w1"), (104, docs[3][1]), (104, "rare w250"), (None, "w7")]
    return docs, items


@pytest.mark.parametrize("item_terms, k", [(50_000, 20), (20, 3)])
def test_search_equals_scoring_every_document(spark, monkeypatch, item_terms, k):
    monkeypatch.setattr(L, "VOCABULARY_ROWS", 100)
    monkeypatch.setattr(L, "BOUND_CELLS", 4000)
    docs, items = tables()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit(0))
    got = L.search(L.build_index(df), asked, k, item_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, k)


def test_bounds_are_never_below_scores():
    docs, items = tables()
    found = [Counter(t.encode() for t in terms(x)) for _, x in docs]
    df = Counter(t for c in found for t in c)
    n_docs, total = sum(bool(c) for c in found), sum(c.total() for c in found)
    block = L.Items([(i, [t.encode() for t in terms(x)]) for i, x in items if terms(x)], df, n_docs, total)
    maker, made, order = L._Maker(0), [], {}
    for i, c in enumerate(found):
        at = maker.add(c.total(), L._hashes(list(c)), np.array(list(c.values()), np.int64))
        order[at[0], at[1]] = i
        made += [at[2]] if at[2] else []
    made += [maker.close(m) for m in list(maker.held)]
    tight = 0
    for b in made:
        bounds = block.bounds(b["m"], np.array(b["n"], np.int64), b["levels"], b["slices"])
        for r in range(len(b["n"])):
            c = found[order[b["block"], r]]
            exact = block.scores(list(range(len(block.ids))), c, c.total())
            assert all(u >= s for u, s in zip(bounds[:, r].tolist(), exact, strict=True))
            tight += sum(u == 0 for u, s in zip(bounds[:, r].tolist(), exact, strict=True) if s == 0)
    assert tight > 0.8 * sum(s == 0 for c in found for s in block.scores(list(range(len(block.ids))), c, c.total()))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert L.search(L.build_index(none), items).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert L.search(L.build_index(docs), items.limit(0)).count() == 0
    assert L.search(L.build_index(docs), spark.createDataFrame([(1, "zz")], "item_id long, text string")).count() == 0
