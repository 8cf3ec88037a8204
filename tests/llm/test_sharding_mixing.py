"""Sharding and mixing: laws on small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tunesmith.llm import mixing, sharding


def test_hypergeometric_law(spark):
    df = spark.range(4000).select(sharding.hypergeometric(F.lit(20), F.lit(8), F.lit(6), sharding._uniform(F.lit(1), F.col("id"))).alias("x"))
    seen = Counter(r.x for r in df.collect())
    for x in range(7):
        p = math.comb(8, x) * math.comb(12, 6 - x) / math.comb(20, 6)
        assert abs(seen[x] / 4000 - p) < 4 * math.sqrt(p * (1 - p) / 4000) + 1e-3


@pytest.mark.parametrize("r, m, k, x", [(10, 0, 5, 0), (10, 10, 5, 5), (10, 4, 0, 0), (10, 4, 10, 4), (0, 0, 0, 0)])
def test_hypergeometric_edges(spark, r, m, k, x):
    got = spark.range(3).select(sharding.hypergeometric(F.lit(r), F.lit(m), F.lit(k), F.rand(1))).collect()
    assert [g[0] for g in got] == [x] * 3


def test_large_draws_stay_near_the_mean(spark):
    df = spark.range(200).select(sharding.hypergeometric(F.lit(10_000_000), F.lit(400_000), F.lit(500_000), sharding._uniform(F.lit(2), F.col("id"))).alias("x"))
    xs = [r.x for r in df.collect()]
    assert len(set(xs)) > 100 and abs(sum(xs) / 200 - 20_000) < 50



def test_matrix_has_its_margins(spark):
    rows = [(p, 5 * p) for p in range(13)]
    got = sharding.communication_matrix(spark.createDataFrame(rows, "part long, n long"), 4, 7, 3).collect()
    sizes = dict(rows)
    assert {r.part: sum(r.counts) for r in got} == {p: sizes.get(p, 0) for p in range(16)}
    columns = [sum(r.counts[s] for r in got) for s in range(7)]
    assert sum(columns) == sum(sizes.values()) and max(columns) - min(columns) <= 1


@pytest.mark.parametrize("per_partition", [20, 50_000])
def test_shards_are_exact_and_gapless(spark, per_partition):
    rows = [(i, f"t{i % 50}") for i in range(500)] + [(None, None), (7, "t7"), (7, "t7")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit("x")).repartition(5)
    out = sharding.shuffle_into_shards(df.select("doc_id", "text"), ["doc_id", "text"], 24, rows_per_partition=per_partition)
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    shards = defaultdict(list)
    for r in got:
        shards[r.shard].append(r.slot)
    assert set(shards) <= set(range(24)) and max(map(len, shards.values())) - min(map(len, shards.values())) <= 1 and len(shards) == 24
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, got), key=str)


def test_shards_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shuffle_into_shards(df, ["doc_id"], 24).count() == 0


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit("s"))).collect()
        assert sorted(r[0] for r in got) == list(range(n))


def brute_targets(sizes, most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free -= over


def mix_rows():
    rows = [(i, "w " * (i % 37) + "end", "en", f"s{i % 5}") for i in range(400)]
    rows += [(1000, None, "en", "s1"), (1001, "", "en", None), (1002, "a  b\tc", "en", None), (1003, "x", "en", "tiny"), (1004, "long " * 3000, "en", "s2"), (7, "twice", "en", "s2"), (7, "twice", "en", "s2"), (1005, " \n", "en", "empty")]
    return rows


@pytest.mark.parametrize("block, slots", [(4, 64), (16, 4096)])
def test_mix_follows_targets(docs_of, block, slots):
    rows = mix_rows()
    df = docs_of(rows).withColumn("block", F.lit(1)).withColumn("size", F.lit("x")).withColumn("target", F.lit(2))
    got = mixing.mix(df, block_words=block, shard_slots=slots).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += size(t)
    want = brute_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.1 * want[s] + 3 * block


def test_sources_at_their_cap_are_taken_whole_over_many_shards(docs_of):
    rows = [(i, "w " * 200, "en", "hot") for i in range(300)]
    rows += [(1000 + i, "v " * (3 + i), "en", f"small{i:02}") for i in range(30)] + [(2000 + i, "u " * 40, "en", None) for i in range(10)]
    got = mixing.mix(docs_of(rows), block_words=8, shard_slots=16).collect()
    hot = sum(r.taken for r in got if r.source == "hot")
    assert len(got) == len(rows) and {r.source for r in got if r.target < 3 * r.source_size} == {"hot"}
    assert all(r.taken == 3 * r.size for r in got if r.source != "hot")
    assert hot == pytest.approx(next(r.target for r in got if r.source == "hot"), rel=1e-2)


def test_draws_beyond_the_cap_are_dealt_again(spark):
    rows = [(f"s{i:03}", 80, 1.0, 238.0) for i in range(40)] + [(None, 80, 1.0, 240.0), ("wide", 8000, 1.0, 8400.0)]
    table = spark.createDataFrame(rows, "source string, source_size long, weight double, target double")
    got = mixing.drawn_blocks(table, 8, 16, 3, 5).collect()
    slots = Counter()
    for r in got:
        assert 0 <= r.block < (1000 if r.source == "wide" else 10) and r.times <= 3
        slots[r.source] += r.times
    assert sum(slots.values()) == round(40 * 238 / 80 * 10 + 30 + 1050) and slots[None] == 30


def test_mixed_text_has_the_taken_words(docs_of):
    rows = mix_rows()
    df = docs_of(rows)
    plan = Counter((r.doc_id, r.taken) for r in mixing.mix(df, block_words=8).collect() if r.taken)
    out = mixing.mixed_documents(df, block_words=8)
    assert out.columns == df.columns
    got = out.collect()
    assert Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in got) == plan
    assert all(r.n_chars == len(r.text) for r in got)


def test_mix_of_nothing(docs_of):
    df = docs_of([(1, "x")])
    assert mixing.mix(df.filter("doc_id < 0")).count() == 0
    assert [(r.target, r.taken) for r in mixing.mix(docs_of([(1, " "), (2, None)])).collect()] == [(0.0, 0)] * 2


def test_crc(spark):
    assert spark.range(1).select(F.crc32(F.lit("añ").cast("binary"))).first()[0] == zlib.crc32("añ".encode())


def test_mixed_documents_with_clashing_columns(docs_of):
    df = docs_of([(i, "some words of a text " * 5, "en", f"s{i % 2}") for i in range(20)])
    for c in ("pieces", "fp", "nth", "taken", "size", "block"):
        df = df.withColumn(c, F.lit("x"))
    got = mixing.mixed_documents(df, block_words=4, shard_slots=8)
    assert got.columns == df.columns and {r.pieces for r in got.collect()} == {"x"}
