"""Splits, seeded shuffles and samples (G-group).

Row membership is decided by the md5 of "<seed>|<id>" (hex text, ties by id),
which is reproducible and independent of partitioning — unlike ``rand(seed)``.
Split sizes need an exact global rank, which comes from the bucketed rank
helper, never from a single-task window.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.plans.ranks import exact_rank, md5_bucket_key, md5_order_key


def seeded_shuffle(df: DataFrame, seed: int = 42, id_col: str = "row_id", rank_col: str = "shuffle_rank", total_col: str | None = None, ids_source: DataFrame | None = None) -> DataFrame:
    """0-based position of each row in the seeded order.

    ``ids_source``: optional cheap frame with a superset of the ids in ``id_col``
    (e.g. the scanned table), used only to place bucket boundaries."""
    keyed = df.withColumn("_h", md5_order_key(seed, id_col))
    ranked = exact_rank(
        keyed, [F.col("_h"), F.col(id_col)], md5_bucket_key(md5_order_key(seed, id_col)), rank_col=rank_col, total_col=total_col,
        bounds_source=ids_source,
    )
    return ranked.drop("_h")


def split_three_way(df: DataFrame, val_fraction: float = 0.15, test_fraction: float = 0.15, seed: int = 42, id_col: str = "row_id", ids_source: DataFrame | None = None) -> DataFrame:
    """G1: n_test = floor(n * test), n_val = floor(n * val) in double; test first, then val, rest train."""
    r = seeded_shuffle(df, seed, id_col, rank_col="_rank", total_col="_n", ids_source=ids_source)
    n = F.col("_n").cast("double")
    n_test = F.floor(n * F.lit(float(test_fraction)))
    n_val = F.floor(n * F.lit(float(val_fraction)))
    split = F.when(F.col("_rank") < n_test, "test").when(F.col("_rank") < n_test + n_val, "val").otherwise("train")
    return r.withColumn("split", split).drop("_rank", "_n")


def split_two_way(df: DataFrame, test_fraction: float = 0.2, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """Test count = ceil(n * test); the rest is train."""
    r = seeded_shuffle(df, seed, id_col, rank_col="_rank", total_col="_n")
    n_test = F.ceil(F.col("_n").cast("double") * F.lit(float(test_fraction)))
    return r.withColumn("split", F.when(F.col("_rank") < n_test, "test").otherwise("train")).drop("_rank", "_n")


def split_overlap_check(df: DataFrame, key_col: str, split_col: str = "split") -> DataFrame:
    """Keys present in more than one split (expect none). One row per leaking key."""
    return (
        df.groupBy(key_col)
        .agg(F.countDistinct(split_col).alias("n_splits"), F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_splits") > 1)
    )


def split_overlap_summary(df: DataFrame, key_col: str, split_col: str = "split") -> DataFrame:
    leaks = split_overlap_check(df, key_col, split_col)
    return leaks.agg(F.count(F.lit(1)).alias("n_leaking_keys"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_leaking_rows"))


def group_split(df: DataFrame, group_col: str, val_fraction: float = 0.15, test_fraction: float = 0.15, seed: int = 42) -> DataFrame:
    """The split is decided per group (md5 of "<seed>|<group>" as a fraction), so
    rows sharing a prompt or cluster always share a split. No rank, no shuffle of rows:
    the decision is a pure function of the group key."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(group_col).cast("string")))
    u = F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    split = F.when(u < F.lit(float(test_fraction)), "test").when(u < F.lit(float(test_fraction + val_fraction)), "val").otherwise("train")
    return df.withColumn("split", split)


def spot_check(df: DataFrame, n: int = 20, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """N rows in seeded order — plans as TakeOrderedAndProject (top-n per task, then merge)."""
    h = md5_order_key(seed, id_col)
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(n).drop("_h")


def head_sample(df: DataFrame, n: int = 20, order_col: str = "row_id") -> DataFrame:
    """First n rows by key."""
    return df.orderBy(order_col).limit(n)
