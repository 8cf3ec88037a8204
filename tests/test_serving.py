"""Sessions, sliding windows and percentiles against plain versions, with one key that holds a third of the rows."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tunesmith.operators import serving, stats
from tunesmith.plans.ranks import exact_percentile

T0 = dt.datetime(2024, 1, 1)


def requests_of(spark, n=1500, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if i % 3 == 0 else rng.choice([1, 2, 3, None])
        ts = None if i % 97 == 0 else T0 + dt.timedelta(seconds=rng.choice([rng.randrange(4 * 86400), rng.randrange(7200)]))
        rows.append((i, ts, user, rng.choice([0.25, 0.25, 0.25, round(rng.expovariate(1), 3)]), rng.randrange(50), rng.random() < 0.9))
    schema = "event_id long, ts timestamp_ntz, user_id long, latency double, tokens long, ok boolean"
    return rows, spark.createDataFrame(rows, schema).repartition(4)


def plain_sessions(rows, gap):
    out, by_user = [], {}
    for _, ts, user, *_ in rows:
        if ts is not None:
            by_user.setdefault(user, []).append(ts)
    for user, times in by_user.items():
        start = last = None
        for t in sorted(times):
            if last is None or t >= last + gap:
                if last is not None:
                    out.append((user, start, last + gap, n))
                start, n = t, 0
            last, n = t, n + 1
        out.append((user, start, last + gap, n))
    return sorted(out, key=str)


@pytest.mark.parametrize("gap, bucket", [(30, "1 hour"), (30, "10 minutes"), (200, "1 hour"), (30, "20 days")])
def test_sessions_in_two_phases(spark, gap, bucket):
    rows, df = requests_of(spark)
    got = serving.chat_sessions(df, f"{gap} minutes", bucket=bucket).collect()
    naive = lambda t: t.replace(tzinfo=None)
    assert sorted(((r.user_id, naive(r.session_start), naive(r.session_end), r.n_requests) for r in got), key=str) == plain_sessions(rows, dt.timedelta(minutes=gap))


def test_a_busy_user_spreads_over_tasks(spark):
    """Every task of the first phase gets a share of the one user's requests."""
    rows = [(i, T0 + dt.timedelta(minutes=7 * i), 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cut = df.withColumn("_b", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000)).repartition(4, "user_id", "_b")
        sizes = [r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 900
    assert [tuple(r)[3] for r in serving.chat_sessions(df).collect()] == [2000]


def test_windows_are_merged_from_panes(spark):
    rows, df = requests_of(spark)
    out = serving.serving_sliding(df, "6 hours", "2 hours")
    got = {r.window_start.replace(tzinfo=None): r for r in out.collect()}
    windows = {}
    for _, ts, _, latency, tokens, ok in rows:
        if ts is not None:
            pane = ts.replace(hour=ts.hour - ts.hour % 2, minute=0, second=0, microsecond=0)
            for k in range(3):
                windows.setdefault(pane - dt.timedelta(hours=2 * k), []).append((latency, tokens, ok))
    assert set(got) == set(windows)
    for start, held in windows.items():
        r = got[start]
        assert (r.n_requests, r.n_errors, r.tokens) == (len(held), sum(not x[2] for x in held), sum(x[1] for x in held))
        assert math.isclose(r.latency_p99, np.quantile([x[0] for x in held], 0.99), abs_tol=1e-9)
        assert math.isclose(r.tokens_per_sec, sum(x[1] for x in held) / sum(x[0] for x in held), rel_tol=1e-9)
    with pytest.raises(ValueError):
        serving.serving_sliding(df, "5 hours", "2 hours")


def test_rows_are_not_copied_for_windows(spark):
    """Only counted rows are multiplied: every Generate of the plan stands above an aggregate."""
    _, df = requests_of(spark)
    plan = serving.serving_sliding(df)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Generate explode" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            below = [x for x in lines[i + 1 :] if len(x) - len(x.lstrip(" :+-")) > depth]
            assert any("Aggregate" in x for x in below[:3])


@pytest.mark.parametrize("q", [0.0, 0.5, 0.99, 1.0])
def test_percentile_with_a_value_that_many_rows_hold(spark, q):
    rng = random.Random(1)
    rows = [("a", 5.0)] * 700 + [("a", rng.random() * 10) for _ in range(300)] + [("b", 5.0 + i * 1e-6) for i in range(500)] + [(None, 1.0), ("c", None)]
    got = {r.g: r.p for r in exact_percentile(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", q, "p").collect()}
    assert set(got) == {"a", "b", None}
    for g in got:
        assert math.isclose(got[g], np.quantile([v for h, v in rows if h == g], q), abs_tol=1e-9)


def test_bootstrap_is_one_aggregate(spark):
    df = spark.range(300).select(F.col("id").alias("row_id"), (F.col("id") % 7 * 1.0).alias("m"))
    got = {r.rep: r["mean"] for r in stats.bootstrap_means(df, "m", n_boot=20).collect()}
    assert sorted(got) == list(range(20)) and all(2 < x < 4 for x in got.values()) and len(set(got.values())) > 15
