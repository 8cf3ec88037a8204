"""The Jaccard join against all pairs on small tables."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunesmith.llm import jaccard
from tunesmith.llm.shingles import shingles


def word_sets(rows):
    out = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        out.append((d, {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()))
    return out


def brute(rows):
    sets = word_sets(rows)
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = {d: 0 for d, _ in sets}
    for i, (d, s) in enumerate(sets):
        for e, r in sets[:i]:
            if s and r and 5 * len(s & r) >= 4 * len(s | r):
                links[d] += 1
                links[e] += 1
                a, b = sorted((find(d), find(e)))
                root[b] = a
    same = {d: sum(s == r for _, r in sets) if s else 1 for d, s in sets}
    return sorted((d, find(d), links[d], same[d]) for d, _ in sets)


def make_rows():
    rng = np.random.default_rng(8)
    vocabulary = [f"w{i}" for i in range(300)] + ["é", "東京"]
    rows, n = [], 0
    for g in range(25):
        base = rng.choice(vocabulary, rng.integers(6, 120)).tolist()
        for c in range(rng.integers(1, 14)):
            words = list(base)
            for _ in range(rng.integers(0, 4) if c else 0):
                words[rng.integers(0, len(words))] = str(rng.choice(vocabulary))
            rows.append((n, ("\n" if g % 2 else " ").join(words)))
            n += 1
    rows += [(1000, None), (1001, ""), (1002, "\t \n"), (1003, "one"), (1004, " one "), (1005, "one two"), (1006, "a b c d"), (1007, "a  b\tc d"), (1008, "a b c d e")]
    rows += [(1010, "x y z " * 9000), (1011, "x y z " * 8000 + "end")]
    return rows


@pytest.mark.parametrize("block_rows", [256, 5])
def test_join_finds_all_links(docs_of, block_rows):
    rows = make_rows()
    df = docs_of(rows).withColumn("cls", F.lit(1)).withColumn("rep", F.lit(2)).withColumn("block", F.lit(3))
    got = jaccard.jaccard_groups(df, block_rows=block_rows)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)
    kept = jaccard.representative_documents(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _, _ in brute(rows)})


def test_many_pairs_in_one_block(docs_of):
    rng = np.random.default_rng(1)
    base = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join(base[:j] + [f"q{i}"] + base[j:])) for i, j in enumerate(rng.integers(0, 80, 90).tolist())]
    assert sorted(tuple(r) for r in jaccard.jaccard_groups(docs_of(rows), block_rows=50).collect()) == brute(rows)


def test_empty_nulls_and_repeats(docs_of):
    assert jaccard.jaccard_groups(docs_of([(1, "x")]).filter("doc_id < 0")).count() == 0
    text = "a b c d e f g h"
    got = jaccard.jaccard_groups(docs_of([(None, text), (5, text), (5, text), (6, "other words that stand alone here")])).collect()
    assert sorted((str(r.doc_id), r.class_id, r.n_links, r.copies) for r in got) == [("5", 5, 2, 3), ("5", 5, 2, 3), ("6", 6, 0, 1), ("None", 5, 2, 3)]


def test_rows_that_share_a_doc_id_are_grouped_by_their_texts(docs_of):
    text = lambda name, end="": " ".join(f"{name}{i}" for i in range(40)) + end
    rows = [(5, text("a")), (None, text("a", " more")), (None, text("b")), (None, text("c")), (None, text("c", " more")), (None, None), (None, " ")]
    rows += [(7, text("d")), (7, text("e")), (8, text("d", " more")), (9, text("f")), (9, text("f"))]
    got = jaccard.jaccard_groups(docs_of(rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links, r.copies) for r in got) == sorted(
        [("5", "5", 1, 1), ("None", "5", 1, 1), ("None", "None", 0, 1), ("7", "7", 1, 1), ("7", "7", 0, 1), ("8", "7", 1, 1)] + [("None", "None", 1, 1)] * 2 + [("None", "None", 0, 1)] * 2 + [("9", "9", 1, 2)] * 2
    )
    kept = [(r.doc_id, r.text) for r in jaccard.representative_documents(docs_of(rows)).collect()]
    c = [x for x in kept if x[1] in (text("c"), text("c", " more"))]
    assert len(c) == 1 and c[0][0] is None
    want = [(5, text("a")), (None, text("b")), (None, None), (None, " "), (7, text("d")), (7, text("e")), (9, text("f"))]
    assert sorted((x for x in kept if x not in c), key=str) == sorted(want, key=str)


def test_a_long_chain_is_one_group(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)] + [(1000, 1001)], "u long, v long")
    got = {r.node: r.root for r in jaccard.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 501)} | {1001: 1000}


def test_posterior_rule():
    assert jaccard.least_matches(0.8, 1e-9, 128) < 80
    assert jaccard.least_matches(0.8, 0.5, 128) >= 100
    assert jaccard.least_matches(0.8, 1e-9, 16) <= 2


def test_shingles_of_a_batch_equal_those_of_each_text():
    texts = [t or "" for _, t in make_rows()]
    parts = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    data = np.frombuffer(b"".join(parts), np.uint8)
    for t, s in zip(parts, shingles(data, offsets), strict=True):
        alone = shingles(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert alone.tolist() == s.tolist()
    assert [len(s) for s in shingles(data, offsets)] == [len(s) for _, s in word_sets(make_rows())]
