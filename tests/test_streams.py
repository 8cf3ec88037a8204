"""Streams with keyed state: histories that close, repeats over window borders, sketches, rows without a time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tunesmith.operators import stats
from tunesmith.streaming import streams

T0 = dt.datetime(2024, 1, 1)
LOG = "conv_id long, turn long, role string, text string, ts timestamp_ntz"


def minutes(m):
    return T0 + dt.timedelta(minutes=m)


def state_of(progress):
    """What the last report of a stateful run says about its state."""
    return [p["stateOperators"][0] for p in progress if p["stateOperators"]]


def test_in_time_order_delivers_rows_without_a_time(spark):
    rows = [(i, None if i % 5 == 0 else minutes(i)) for i in range(20)]
    parts = streams.in_time_order(spark.createDataFrame(rows, "event_id long, ts timestamp_ntz"), 4)
    got = [sorted(r.event_id for r in p.collect()) for p in parts]
    assert sorted(x for g in got for x in g) == list(range(20)) and {0, 5, 10, 15} <= set(got[0])


def test_history_closes_after_the_idle_time_and_its_state_goes(spark):
    first = [(1, t, "user" if t % 2 == 0 else "assistant", "x", minutes(t)) for t in range(4)] + [(2, 0, "user", "y", minutes(1)), (None, 7, "user", "z", minutes(2)), (3, None, None, None, minutes(3))]
    second = [(1, 9, "user", "again", minutes(300))]
    frames = [spark.createDataFrame(r, LOG) for r in (first, second)]
    progress = []
    parts = [*frames, streams.closing_row(frames[1], "ts", "1 day")]
    rows = [tuple(r) for r in streams.run_deliveries(parts, streams.stream_chat_history, "t-history", progress).collect()]
    closed = sorted((r[:5] for r in rows if r[5]), key=str)
    assert closed == [(1, 1, 9, "user", "user"), (1, 4, 3, "assistant", "user,assistant,user,assistant"), (2, 1, 0, "user", "user"), (3, 1, -1, None, "")]
    assert sorted((r[:4] for r in rows if not r[5]), key=str) == [(1, 1, 9, "user"), (1, 4, 3, "assistant"), (2, 1, 0, "user"), (3, 1, -1, None)]
    assert state_of(progress)[-1]["numRowsTotal"] == 0


def test_a_batch_writes_its_new_turns_only(spark):
    """A history of 1,500 turns grows by 100 turns a batch: the bytes written by the first and the last batches are alike."""
    text = "word " * 40
    frames = [spark.createDataFrame([(1, 100 * b + t, "user", text, minutes((100 * b + t) / 100)) for t in range(100)], LOG) for b in range(15)]
    progress = []
    streams.run_deliveries(frames, streams.stream_chat_history, "t-growth", progress)
    written = [s["customMetrics"]["rocksdbTotalBytesWritten"] for s in state_of(progress)]
    written = [w for w in written if w > 100 * len(text)]
    assert len(written) == 15 and max(written[-3:]) < 1.3 * max(written[:3])


def brute_first(rows, hold):
    out, until = [], {}
    for ts, event_id, k in sorted((ts, i, k) for i, ts, k in rows if ts is not None):
        if k not in until or ts >= until[k]:
            out.append((event_id, k))
            until[k] = ts + dt.timedelta(seconds=hold)
    return sorted([*out, *((i, k) for i, ts, k in rows if ts is None)], key=str)


@pytest.mark.parametrize("n", [1, 4])
def test_first_of_a_key_over_window_borders_however_cut(spark, n):
    rng = random.Random(3)
    rows = [(200 + i, minutes(rng.choice([58, 61, 70, 119, 121, 200, 300]) + rng.randrange(3)), rng.choice(["a", "b", None])) for i in range(80)]
    rows = [(i, t, k or "none") for i, t, k in rows] + [(100, None, "a"), (101, None, "a"), (102, minutes(59), "c"), (103, minutes(61), "c")]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, k string")
    parts = [*streams.in_time_order(events, n), streams.closing_row(events, "ts", "1 day")]
    progress = []
    out = streams.run_deliveries(parts, lambda s: streams.stream_dedupe(s, ["k"], 3600, "30 minutes"), "t-first", progress)
    assert out.columns == ["event_id", "ts", "k"]
    got = sorted(((r.event_id, r.k) for r in out.collect()), key=str)
    assert got == brute_first(rows, 3600) and (103, "c") not in got
    # Only the closing row still waits, with its mark.
    assert state_of(progress)[-1]["numRowsTotal"] <= 2


@pytest.mark.parametrize("n", [1, 5])
def test_keys_share_their_state_in_groups(spark, n):
    """300 keys (numbers and texts, null or not) in 4 groups, rows in no order within a delivery: some state for each group, not for each key."""
    rng = random.Random(7)
    names = [(f"{i % 20}" if i % 20 else None, [0.0, -0.0, float("nan"), None][i // 20 % 4], i // 80 or None) for i in range(400)]
    rows = [(1000 + i, None if i % 97 == 0 else minutes(rng.randrange(600)), *rng.choice(names)) for i in range(2500)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, a string, b double, c long")
    parts = [*streams.in_time_order(events, n), streams.closing_row(events, "ts", "1 day")]
    progress = []
    out = streams.run_deliveries(parts, lambda s: streams.stream_dedupe(s, ["a", "b", "c"], 3600, "30 minutes", groups=4), "t-groups", progress)
    keyed = [(i, ts, (a, str(abs(b)) if b is not None else None, c)) for i, ts, a, b, c in rows]
    assert sorted(r.event_id for r in out.collect()) == sorted(i for i, _ in brute_first(keyed, 3600))
    assert max(s["numRowsTotal"] for s in state_of(progress)) <= 4 * (2 + n)


def test_quantile_sketches_merge_and_keep_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"), (F.col("id") % 7).alias("part")).repartition(4)
    df = df.unionByName(spark.createDataFrame([(9, None, 0)], "g long, v double, part long"))
    q = stats.length_quantiles(df, "v", (0.01, 0.5, 0.99), ["g"])
    assert q.count() == 9 and stats.within_rank(df, q, "v", ["g"]).filter("within").count() == 9
    parts = df.groupBy("g", "part").agg(stats.quantile_sketch("v").alias("s")).groupBy("g").agg(stats.merged_sketch("s").alias("s"))
    merged = parts.filter("g < 3").select("g", F.lit(0.99).alias("prob"), stats.sketch_quantile("s", 0.99).alias("value"))
    assert stats.within_rank(df, merged, "v", ["g"]).filter("within").count() == 3
    wrong = merged.withColumn("value", F.col("value") * 0.9)
    assert stats.within_rank(df, wrong, "v", ["g"]).filter("within").count() == 0


def test_large_and_negative_conversation_ids_have_keys(spark):
    from tunesmith.operators import chat

    ids = [3_000_000_000, -5, (1 << 63) - 1, -(1 << 63), 4]
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}") for c in ids for t in range(6)]
    rows = chat.turns_to_instructions(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    assert len(rows) == 15 == len({r.row_id for r in rows}) and {int(r.row_id) for r in rows} == {c * 2**32 + t for c in ids for t in (0, 2, 4)}
