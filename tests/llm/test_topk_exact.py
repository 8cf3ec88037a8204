"""Exact top-k and exact dedup against brute force on small tables."""

import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunesmith.llm import exact_dedup, topk

WHITE = r"[\x20\x09-\x0D]"


def brute_top(rows, k, every):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in good:
        if i is None or i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("bucket_rows, coordinate_from", [(16, 0.2), (1000, 0.99), (7, 0.0)])
def test_top_k_is_exact(spark, bucket_rows, coordinate_from):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=6) * rng.lognormal()]) for i in range(150)]
    rows += [(200 + i, [1.0, 0.5, -0.25, 0.0, 0.0, 0.0]) for i in range(40)]  # ties
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (305, [float("nan")] * 6), (310, [float("inf")] * 6), (315, [0.0] * 6), (400, [1.0, 2.0]), (405, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("rank", F.lit(1))
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=4, bucket_rows=bucket_rows, query_rows=9, coordinate_from=coordinate_from)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 4, 5)


def test_top_k_of_an_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 5 == 0).count() == 0


def brute_dedup(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(WHITE, "", t or ""), []).append((-len(t or ""), d))
    return sorted((d, min(g)[1], len(g), d == min(g)[1], hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, d in g)


def dedup_rows():
    rng = np.random.default_rng(3)
    long = " ".join("".join(rng.choice(list("abcdehiowr"), 5)) for _ in range(3000))
    rows = [(1, long), (2, long.replace(" ", "\n\t")), (3, long[:9000] + "x" + long[9000:]), (4, ""), (5, None), (6, " \x0b\x0c\r"), (7, "a\x85b"), (8, "ab"), (9, "a b"), (10, " ab")]
    rows += [(100 + i, "copy  of" if i % 2 else "copyof") for i in range(60)] + [(200, "東京" * 9000), (201, "東 京" * 9000)]
    return rows


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(docs_of, weak):
    # The weak fingerprint gives many contents one number: the identifiers must still tell them apart.
    fp = (lambda c: F.length(c).cast("long") % 3) if weak else exact_dedup.fingerprint
    df = docs_of(dedup_rows()).withColumn("norm", F.lit(1)).withColumn("row", F.lit(2))
    got = exact_dedup.exact_dedup(df, fp).collect()
    assert sorted(map(tuple, got)) == brute_dedup(dedup_rows())


def test_exact_dedup_null_ids_repeats_and_empty(docs_of):
    got = exact_dedup.exact_dedup(docs_of([(None, "a"), (3, "a"), (3, "a"), (4, "b")])).collect()
    assert sorted((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in got) == [("3", 3, 3, True), ("3", 3, 3, True), ("4", 4, 1, True), ("None", 3, 3, False)]
    assert exact_dedup.exact_dedup(docs_of([(1, "x")]).filter("doc_id < 0")).count() == 0


def test_chunks_are_the_text_and_resynchronise(spark):
    text = dedup_rows()[0][1].replace(" ", "")
    df = spark.createDataFrame([(text,), ("zz" + text,)], "t string")
    a, b = (r[0] for r in df.select(exact_dedup.chunks_of(F.col("t"))).collect())
    assert "".join(a) == text and len(a) > 10
    assert len(set(a) & set(b)) > len(a) - 4


def test_repeated_rows_under_one_fingerprint(spark):
    """Equal rows share a key; all contents share one fingerprint."""
    rows = [(1, "alpha"), (1, "alpha"), (2, "beta"), (3, "alpha ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_dedup(df, lambda chunk: F.length(chunk) * 0)
    assert sorted(((r.doc_id, r.group_size) for r in got.collect())) == [(1, 3), (1, 3), (2, 1), (3, 3)]
