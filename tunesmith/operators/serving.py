"""Serving-log metrics (L1-L4) over a request table
(ts, user_id, adapter, latency seconds, tokens, ok)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.plans.ranks import exact_percentile, exact_rank
from tunesmith.session import stored_once


def _sums(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n_requests", "n_errors", "tokens", "latency_sum")])


def _metrics(sums: DataFrame, p99: DataFrame, keys: list[str]) -> DataFrame:
    p99 = p99.select(*[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)], "latency_p99")
    joined = sums.join(p99, [F.col(k).eqNullSafe(F.col(f"_p{i}")) for i, k in enumerate(keys)], "left")
    rate = F.col("tokens") / F.greatest(F.col("latency_sum"), F.lit(1e-6))
    return joined.select(*keys, "n_requests", "n_errors", "tokens", "latency_p99", rate.alias("tokens_per_sec"))


def _counted(requests: DataFrame, window: str, group_cols: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows with their tumbling window, the sums of each window, and the window's columns."""
    rows = requests.select(F.window("ts", window).alias("w"), *group_cols, "ok", "tokens", "latency")
    rows = rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *group_cols, "ok", "tokens", "latency")
    keys = ["window_start", "window_end", *group_cols]
    each = [F.count(F.lit(1)).alias("n_requests"), F.count_if(~F.col("ok")).alias("n_errors"), F.sum("tokens").alias("tokens"), F.sum("latency").alias("latency_sum")]
    return rows, rows.groupBy(*keys).agg(*each), keys


def serving_metrics(requests: DataFrame, window: str = "1 hour", group_cols=()) -> DataFrame:
    """L1: tokens/second, p99 latency and errors per tumbling window."""
    rows, sums, keys = _counted(requests, window, list(group_cols))
    return _metrics(sums, exact_percentile(rows, keys, "latency", 0.99, "latency_p99"), keys)


def interval_micros(spark, interval: str) -> int:
    """The microseconds of a day-time interval such as ``6 hours``."""
    zero = "timestamp'1970-01-02 00:00:00'"
    return spark.sql(f"SELECT unix_micros({zero} + interval {interval}) - unix_micros({zero}) AS us").first().us


def serving_sliding(requests: DataFrame, length: str = "6 hours", slide: str = "1 hour", group_cols=()) -> DataFrame:
    """L2: the same metrics over overlapping windows, each merged from its length/slide panes.

    A request is counted once, in its pane of ``slide`` and its bin of latency; what is multiplied are the counts of panes."""
    groups = list(group_cols)
    spark = requests.sparkSession
    n, rest = divmod(interval_micros(spark, length), interval_micros(spark, slide))
    if rest:
        raise ValueError("a window's length must be a multiple of its slide")
    rows, sums, keys = _counted(requests, slide, groups)
    panes = ["pane_start", *groups]
    rows = rows.withColumnRenamed("window_start", "pane_start").drop("window_end")

    def windows_of(counted: DataFrame) -> DataFrame:
        each = counted.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        each = each.withColumn("window_start", F.expr(f"pane_start - _k * interval {slide}"))
        return each.withColumn("window_end", F.expr(f"window_start + interval {length}")).drop("_k")

    merged = _sums(windows_of(sums.withColumnRenamed("window_start", "pane_start").drop("window_end")), keys)
    return _metrics(merged, exact_percentile(rows, keys, "latency", 0.99, "latency_p99", panes=panes, regroup=windows_of), keys)


def queue_depth(requests: DataFrame, id_col: str = "event_id") -> DataFrame:
    """L3: requests in flight at each arrival: #{starts <= mine (by time, id)} - #{ends <= my start}.

    Starts (+1) and ends (-1) become one event table (union); its running sum in
    (time, kind, id) order comes from the bucketed prefix-sum helper — no range
    join, and no per-day window that would lose requests open across midnight.
    """
    # microseconds since the epoch, computed on the zone-less value (no session time zone)
    start_us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    end_us = start_us + F.round(F.col("latency") * 1_000_000).cast("long")
    r = requests.select(id_col, start_us.alias("_s"), end_us.alias("_e"))
    starts = r.select(id_col, F.col("_s").alias("_t"), F.lit(1).alias("_kind"), F.lit(1).alias("_d"))
    ends = r.select(id_col, F.col("_e").alias("_t"), F.lit(0).alias("_kind"), F.lit(-1).alias("_d"))
    ev = starts.unionByName(ends)
    key = F.col("_t").cast("double") * 2.0 + F.col("_kind").cast("double")
    ranked = exact_rank(ev, [F.col("_t"), F.col("_kind"), F.col(id_col)], key, weight=F.col("_d"), offset_col="_before", rank_col="_rk")
    return ranked.filter(F.col("_kind") == 1).select(id_col, (F.col("_before") + 1).alias("depth"))


def chat_sessions(requests: DataFrame, gap: str = "30 minutes", user_col: str = "user_id", bucket: str = "1 hour") -> DataFrame:
    """L4: an idle gap closes a session; requests per session.

    Two phases: sessions within (user, ``bucket`` of time), which spread a busy user over tasks; then the first
    and the last session of each bucket, at most two rows for it, are merged along the user's buckets. Requests without a time
    are in no session; requests without a user are one user's."""
    size = interval_micros(requests.sparkSession, bucket)
    timed = requests.filter(F.col("ts").isNotNull()).withColumn("_b", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / size))
    inside = timed.groupBy(user_col, "_b", F.session_window("ts", gap).alias("_s"))
    parts = inside.agg(F.count(F.lit(1)).alias("n_requests")).select(
        user_col, "_b", F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), "n_requests"
    )
    # Read three times below.
    parts = stored_once(parts, "session-parts")
    ends = parts.groupBy(user_col, "_b").agg(F.min("session_start").alias("_first"), F.max("session_start").alias("_last"))
    ends = ends.select(F.col(user_col).alias("_user"), F.col("_b").alias("_of"), "_first", "_last")
    marked = parts.join(ends, F.col(user_col).eqNullSafe(F.col("_user")) & (F.col("_b") == F.col("_of")))
    border = (F.col("session_start") == F.col("_first")) | (F.col("session_start") == F.col("_last"))
    out = [user_col, "session_start", "session_end", "n_requests"]
    whole = marked.filter(~border).select(*out)
    order = Window.partitionBy(user_col).orderBy("session_start")
    chain = marked.filter(border).select(*out).withColumn("_new", F.coalesce((F.col("session_start") >= F.lag("session_end").over(order)).cast("int"), F.lit(1)))
    chain = chain.withColumn("_n", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = chain.groupBy(user_col, "_n").agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("n_requests").alias("n_requests"))
    return whole.unionByName(merged.select(*out))
