"""Exact global rank and prefix sums without a single-task window.

A ``Window.orderBy`` with no ``partitionBy`` moves every row into one task. Here
the order is cut into quantile buckets instead:

1. a numeric *bucket key* that never decreases along the order is sampled once
   (``approxQuantile``) into at most ``n_buckets`` split points;
2. ``Bucketizer`` (a binary search, JVM side) gives each row its bucket; the
   bucket is a pure function of the row, so recomputing a lost task gives the
   same answer (no checkpoint or partition-id trick needed);
3. per-bucket counts/sums (partial aggregation, at most ``n_buckets`` rows)
   get an exclusive running sum — a global window over that small frame only;
4. that frame, bounded by ``n_buckets``, is broadcast back and a window
   *partitioned by bucket* finishes the rank / running sum.

Buckets come from quantiles, so each holds about N / n_buckets rows even when
keys cluster. The order columns must be unique (ties are broken by the caller).
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.session import default_parallelism

MAX_BUCKETS = 100_000  # size bound of the broadcast bucket table


def md5_order_key(seed, id_col) -> Column:
    """Hex md5 of "<seed>|<id>": the seeded shuffle order (ties broken by id)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))


def md5_bucket_key(hex_col: Column) -> Column:
    """First 13 hex digits (52 bits) as a double: exact, and monotone in the hex order."""
    return F.conv(F.substring(hex_col, 1, 13), 16, 10).cast("double")


def _bucketize(df: DataFrame, bucket_key: Column, n_buckets: int, bounds_source: DataFrame | None = None) -> DataFrame:
    keyed = df.withColumn("_bk", bucket_key.cast("double"))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    sample = keyed if bounds_source is None else bounds_source.select(bucket_key.cast("double").alias("_bk"))
    bounds = sample.approxQuantile("_bk", probs, 1.0 / (4 * n_buckets)) if probs else []
    splits = [float("-inf")]
    for b in sorted(set(x for x in bounds if x is not None)):
        if b > splits[-1]:
            splits.append(b)
    splits.append(float("inf"))
    bucketizer = Bucketizer(splits=splits, inputCol="_bk", outputCol="_bucket_d", handleInvalid="keep")
    return bucketizer.transform(keyed).withColumn("_bucket", F.col("_bucket_d").cast("int")).drop("_bk", "_bucket_d")


def exact_rank(
    df: DataFrame,
    order_cols: list,
    bucket_key: Column,
    *,
    weight: Column | None = None,
    rank_col: str = "rank",
    offset_col: str | None = None,
    total_col: str | None = None,
    total_weight_col: str | None = None,
    n_buckets: int | None = None,
    bounds_source: DataFrame | None = None,
) -> DataFrame:
    """Add a 0-based global ``rank_col`` under ``order_cols`` (unique), and optionally
    the exclusive running sum of ``weight`` (``offset_col``) and the grand totals.

    ``bounds_source``: a cheaper DataFrame on which ``bucket_key`` can be evaluated
    (e.g. the id column of the scanned table before filters and dedupe). Bucket
    boundaries only balance the work — any boundaries give the exact same ranks —
    so sampling them from a superset of the keys saves a pass over ``df``'s lineage.
    """
    spark = df.sparkSession
    p = n_buckets or max(4 * default_parallelism(spark), 8)
    p = min(p, MAX_BUCKETS)
    w_expr = weight if weight is not None else F.lit(0)
    b = _bucketize(df, bucket_key, p, bounds_source).withColumn("_w", w_expr.cast("long"))

    stats = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_sw"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    stats = stats.select(
        "_bucket",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base_n"),
        F.coalesce(F.sum("_sw").over(before), F.lit(0)).alias("_base_w"),
        F.sum("_n").over(everything).alias("_total_n"),
        F.sum("_sw").over(everything).alias("_total_w"),
    )
    # stats has at most p rows (p <= MAX_BUCKETS): a proven bound for the broadcast.
    joined = b.join(F.broadcast(stats), "_bucket")
    inner = Window.partitionBy("_bucket").orderBy(*order_cols)
    out = joined.withColumn(rank_col, F.col("_base_n") + F.row_number().over(inner) - 1)
    if offset_col:
        running = F.sum("_w").over(inner.rowsBetween(Window.unboundedPreceding, 0))
        out = out.withColumn(offset_col, F.col("_base_w") + running - F.col("_w"))
    if total_col:
        out = out.withColumn(total_col, F.col("_total_n"))
    if total_weight_col:
        out = out.withColumn(total_weight_col, F.col("_total_w"))
    return out.drop("_bucket", "_w", "_base_n", "_base_w", "_total_n", "_total_w")


def exact_percentile(df: DataFrame, keys: list[str], value: str, q: float, out: str, resolution: float = 0.01, panes: list[str] | None = None, regroup=None) -> DataFrame:
    """keys, ``out``: the percentile of ``value`` (linear between ranks) in each group, without holding a group's values.

    Values are counted by bin of ``resolution`` (partial aggregation); running counts over the bins
    tell which bins hold the two ranks that are needed. Of these bins alone the distinct values are counted, and ranked by
    their counts: a value that very many rows hold is one row from the map side on, and no rows are sorted.

    With ``panes`` the rows are counted by these columns, and ``regroup`` turns counted rows (panes and others) into rows of
    ``keys`` (panes kept): overlapping groups are merged from the counts of their panes, and rows themselves are never copied."""
    panes = keys if panes is None else panes
    regroup = regroup or (lambda counted: counted)
    some = df.filter(F.col(value).isNotNull()).select(*panes, F.col(value).cast("double").alias("_v"))
    some = some.withColumn("_bin", F.floor(F.col("_v") / resolution))
    by_pane = regroup(some.groupBy(*panes, "_bin").agg(F.count(F.lit(1)).alias("_n")))
    by = Window.partitionBy(*keys)
    bins = by_pane.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_n"))
    bins = bins.withColumn("_before", F.coalesce(F.sum("_n").over(by.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    bins = bins.withColumn("_at", (F.sum("_n").over(by) - 1) * F.lit(q))
    low, high = F.floor("_at"), F.ceil("_at")
    bins = bins.filter((F.col("_before") <= high) & (F.col("_before") + F.col("_n") > low)).drop("_n")
    # Which bins of which panes are needed: as few rows as groups, times two.
    needed = _joined(by_pane.select(*dict.fromkeys([*panes, *keys]), "_bin"), bins.select(*keys, "_bin"), [*keys, "_bin"]).select(*panes, "_bin").distinct()
    counted = _joined(some, needed, [*panes, "_bin"]).groupBy(*panes, "_bin", "_v").agg(F.count(F.lit(1)).alias("_c"))
    values = regroup(counted).groupBy(*keys, "_bin", "_v").agg(F.sum("_c").alias("_c"))
    held = _joined(values, bins, [*keys, "_bin"])
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = held.withColumn("_upto", upto)
    # A value stands at the ranks from _upto - _c to _upto - 1.
    at = lambda rank: F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (F.col("_upto") > rank), F.col("_v")))
    share = F.max("_at") - F.floor(F.max("_at"))
    ends = ranked.groupBy(*keys).agg(at(low).alias("_low"), at(high).alias("_high"), share.alias("_share"))
    return ends.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias(out))


def _joined(rows: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with what ``few`` adds to its rows of equal ``on`` (nulls are equal); its columns come once."""
    renamed = few.select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(on)], *[c for c in few.columns if c not in on])
    met = rows.join(renamed, [F.col(c).eqNullSafe(F.col(f"_on{i}")) for i, c in enumerate(on)])
    return met.drop(*[f"_on{i}" for i in range(len(on))])
