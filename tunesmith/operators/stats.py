"""Aggregations (H-group). All are partial + final hash aggregates; the only
windows run over already-aggregated, small frames (length histograms)."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows whose bootstrap weights a task holds at a time.
DRAWN_ROWS = 2048


def length_stats(df: DataFrame, length_col: str = "n_tokens", group_cols=()) -> DataFrame:
    """H1: min, upper median (sorted[n // 2]), max and mean of lengths; no row when empty.

    Built from the length histogram (one row per distinct length), so the
    running count that finds the median never touches the raw rows.
    """
    groups = list(group_cols)
    hist = df.groupBy(*groups, length_col).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*groups) if groups else Window.partitionBy()
    wc = w.orderBy(length_col).rowsBetween(Window.unboundedPreceding, 0)
    h = hist.withColumn("_cum", F.sum("_c").over(wc)).withColumn("_n", F.sum("_c").over(w))
    return h.groupBy(*groups).agg(
        F.sum("_c").alias("n_rows"),
        F.min(length_col).cast("long").alias("min_len"),
        F.min(F.when(F.col("_cum") > F.floor(F.col("_n") / 2), F.col(length_col))).cast("long").alias("median_len"),
        F.max(length_col).cast("long").alias("max_len"),
        (F.sum(F.col(length_col) * F.col("_c")) / F.sum("_c")).alias("mean_len"),
    ).filter(F.col("n_rows").isNotNull())  # a global aggregate of nothing: no row, like the reference


def length_histogram(df: DataFrame, length_col: str = "n_tokens", width: int = 64) -> DataFrame:
    """H2: counts per length bin [k*width, (k+1)*width)."""
    b = F.floor(F.col(length_col) / F.lit(width)).cast("long")
    return df.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("bin_start", F.col("bin") * width)


#: Size of quantile sketches, and the error of their ranks (with 99 % confidence) by the sketch's published bound.
SKETCH_K = 4096
SKETCH_ERROR = 2.296 / SKETCH_K**0.9021


def quantile_sketch(column: str) -> Column:
    """Aggregate: a KLL sketch of a double column. It holds some thousand values whatever the group's size, map tasks
    sketch their rows, and sketches merge (``merged_sketch``), across batches and windows too."""
    return F.expr(f"kll_sketch_agg_double(cast(`{column}` AS double), {SKETCH_K})")


def merged_sketch(column: str) -> Column:
    """Aggregate: one sketch of many."""
    return F.expr(f"kll_merge_agg_double(`{column}`)")


def sketch_quantile(column: str, q: float) -> Column:
    """The value of rank ``q`` by a sketch: one of the values that went in."""
    return F.expr(f"kll_sketch_get_quantile_double(`{column}`, {float(q)}D)")


def length_quantiles(df: DataFrame, length_col: str = "n_tokens", probs=(0.5, 0.9, 0.99), group_cols=()) -> DataFrame:
    """H2 at scale: group, n_rows, prob, value by one mergeable sketch for each group, in one pass. The rank of a value
    is within ``SKETCH_ERROR`` of its prob. Null lengths don't count; a group without lengths has no rows."""
    some = df.filter(F.col(length_col).isNotNull())
    sketched = some.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n_rows"), quantile_sketch(length_col).alias("_sketch")).filter("n_rows > 0")
    each = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("prob"), sketch_quantile("_sketch", q).alias("value")) for q in probs]))
    return sketched.select(*group_cols, "n_rows", each.alias("_q")).select(*group_cols, "n_rows", "_q.prob", "_q.value")


def within_rank(df: DataFrame, quantiles: DataFrame, value_col: str, keys, error: float = SKETCH_ERROR) -> DataFrame:
    """``quantiles`` (keys, prob, value) with ``within``: whether the value's exact rank among ``value_col`` of ``df`` is
    at most ``error`` from prob. Counts with partial aggregation; for tests and reports."""
    q = quantiles.withColumnsRenamed({k: f"_q_{k}" for k in keys})
    pairs = df.filter(F.col(value_col).isNotNull()).join(q, [F.col(k).eqNullSafe(F.col(f"_q_{k}")) for k in keys])
    counts = pairs.groupBy(*[f"_q_{k}" for k in keys], "prob", "value").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(value_col) < F.col("value")).alias("_below"), F.count_if(F.col(value_col) <= F.col("value")).alias("_upto")
    )
    slack = F.lit(error) * F.col("_n") + 1
    ok = (F.col("_below") <= F.col("prob") * F.col("_n") + slack) & (F.col("_upto") >= F.col("prob") * F.col("_n") - slack)
    return counts.select(*[F.col(f"_q_{k}").alias(k) for k in keys], "prob", "value", ok.alias("within"))


def metric_means(scores: DataFrame, group_cols=()) -> DataFrame:
    """H3: mean EM, mean F1 and n (null means on empty input, not an error)."""
    return scores.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), F.avg("em").alias("exact_match"), F.avg("f1").alias("token_f1")
    )


def judge_summary(scores: DataFrame, score_col: str = "judge", group_cols=()) -> DataFrame:
    """H4: mean judge score, n, and the 1..5 distribution as columns."""
    aggs = [F.count(F.lit(1)).alias("n"), F.avg(score_col).alias("mean_score")]
    aggs += [F.count_if(F.col(score_col) == s).alias(f"n_score_{s}") for s in range(1, 6)]
    return scores.groupBy(*group_cols).agg(*aggs)


def corpus_perplexity(scored: DataFrame, nll_col: str = "nll", n_col: str = "n_tokens", weight: str = "all", group_cols=()) -> DataFrame:
    """H5: exp(sum(nll_i * n_i) / max(sum(n_i), 1)) — token-weighted, not a mean of perplexities.

    ``weight="shifted"`` weights by n - 1 (the positions a causal model predicts).
    """
    n = F.col(n_col) if weight == "all" else F.greatest(F.col(n_col) - 1, F.lit(0))
    agg = scored.groupBy(*group_cols).agg(
        F.sum(F.col(nll_col) * n).alias("_loss"), F.sum(n).alias("n_tokens"), F.count(F.lit(1)).alias("n_texts")
    )
    mean_nll = F.col("_loss") / F.greatest(F.col("n_tokens"), F.lit(1))
    return agg.select(*group_cols, "n_texts", "n_tokens", mean_nll.alias("mean_nll"), F.exp(mean_nll).alias("perplexity"))


def sliced_metrics(df: DataFrame, dims, metrics: dict, mode: str = "rollup") -> DataFrame:
    """H6: metrics for every slice of ``dims`` (rollup or cube) with grouping_id."""
    g = df.rollup(*dims) if mode == "rollup" else df.cube(*dims)
    aggs = [F.grouping_id().alias("grouping_id"), F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(c).alias(name) for name, c in metrics.items()]
    return g.agg(*aggs)


def metric_uncertainty(df: DataFrame, metric_col: str, group_cols=(), z: float = 1.959963984540054) -> DataFrame:
    """H7: n, mean, standard error and a normal 95% interval per group."""
    agg = df.groupBy(*group_cols).agg(
        F.count(metric_col).alias("n"), F.avg(metric_col).alias("mean"), F.stddev_samp(metric_col).alias("_sd")
    )
    se = F.col("_sd") / F.sqrt(F.col("n").cast("double"))
    return agg.select(
        *group_cols, "n", "mean", se.alias("std_error"), (F.col("mean") - z * se).alias("ci_low"), (F.col("mean") + z * se).alias("ci_high")
    )


def bootstrap_weights(ids: list[str | None], n_boot: int, seed: int) -> np.ndarray:
    """(rows, n_boot): the Poisson(1) weight of a row in each replicate, from an md5 of "<seed>|<replicate>|<id>" ("<seed>|<replicate>" of no id)."""
    # Poisson(1) by inverse CDF over its first terms (P(k > 8) < 1e-5).
    cdf = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(9)]
    begun = [hashlib.md5(f"{seed}|{rep}".encode()) for rep in range(n_boot)]
    digests = []
    for tail in ids:
        tail = b"" if tail is None else f"|{tail}".encode()
        for h in begun:
            h = h.copy()
            h.update(tail)
            digests.append(h.digest()[:8])
    u = (np.frombuffer(b"".join(digests), ">u8") >> np.uint64(12)).astype(np.float64) / float(16**13)
    # How many of the bounds lie at or below u.
    return np.searchsorted(cdf, u, side="right").astype(np.float64).reshape(len(ids), n_boot)


def bootstrap_means(df: DataFrame, metric_col: str, id_col: str = "row_id", n_boot: int = 100, seed: int = 42, group_cols=()) -> DataFrame:
    """H7 bootstrap: md5-derived Poisson(1) weights per (replicate, row); group, rep, mean per replicate.

    Tasks draw the weights of some rows at a time and add them up by group; of these only the sums travel: rows are
    not copied for the replicates, weights need no random state, and a lost task computes the same
    ones again. Rows without a metric don't count; a replicate that draws no row is left out."""
    groups = list(group_cols)
    rows = df.filter(F.col(metric_col).isNotNull()).select(*groups, F.col(metric_col).cast("double").alias("_m"), F.col(id_col).cast("string").alias("_id"))
    schema = rows.select(*groups, F.array(F.lit(0.0)).alias("_w"), F.array(F.lit(0.0)).alias("_s")).schema

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, len(whole), DRAWN_ROWS):
                batch = whole.slice(first, DRAWN_ROWS)
                w, m = bootstrap_weights(batch.column("_id").to_pylist(), n_boot, seed), batch.column("_m").to_numpy(zero_copy_only=False)
                held = pa.Table.from_batches([batch]).select(groups).append_column("_at", pa.array(np.arange(len(batch)))).append_column("_all", pa.array(np.zeros(len(batch), np.int8)))
                held = held.group_by([*groups, "_all"]).aggregate([("_at", "list")])
                own = [np.asarray(x) for x in held.column("_at_list").to_pylist()]
                totals = [pa.array([f(x).tolist() for x in own], pa.list_(pa.float64())) for f in (lambda x: w[x].sum(0), lambda x: m[x] @ w[x])]
                yield pa.RecordBatch.from_arrays([*(held.column(g).combine_chunks() for g in groups), *totals], names=schema.names)

    each = rows.mapInArrow(sums, schema).select(*groups, F.posexplode(F.arrays_zip("_w", "_s")).alias("rep", "_p"))
    total = each.groupBy(*groups, "rep").agg(F.sum("_p._w").alias("_w"), F.sum("_p._s").alias("_s"))
    return total.filter("_w > 0").select(*groups, "rep", (F.col("_s") / F.col("_w")).alias("mean"))


def bootstrap_interval(df: DataFrame, metric_col: str, id_col: str = "row_id", n_boot: int = 100, seed: int = 42, group_cols=(), level: float = 0.95) -> DataFrame:
    """H7: group, n_boot, and the percentile interval (linear between ranks) of the replicate means."""
    tail = (1 - level) / 2
    means = bootstrap_means(df, metric_col, id_col, n_boot, seed, group_cols)
    q = F.percentile("mean", F.array(F.lit(tail), F.lit(1 - tail)))  # over n_boot values for each group
    return means.groupBy(*group_cols).agg(F.count("mean").alias("n_boot"), q.alias("_q")).select(*group_cols, "n_boot", F.col("_q")[0].alias("ci_low"), F.col("_q")[1].alias("ci_high"))
