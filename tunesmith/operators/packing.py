"""Packing and batching (F-group).

Packing needs each row's start in the concatenated token stream: an exact
prefix sum in row order, from the bucketed helper in ``plans.ranks``. From there
block ids are arithmetic — a row covering stream positions [start, end) touches
blocks start div B .. (end - 1) div B — so each row emits one *slice* per block
it touches (never one row per token), and blocks are assembled by a groupBy on
block id whose groups hold at most B tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.plans.ranks import exact_rank, md5_bucket_key
from tunesmith.session import stored_once


def pack_sequences(df: DataFrame, ids_col: str = "input_ids", order_col: str = "row_id", block_size: int = 128, eos_id: int = 2, ids_source: DataFrame | None = None) -> DataFrame:
    """every row followed by EOS, one stream in ``order_col`` order, cut into
    ``block_size`` blocks; the last short block is dropped. -> (block_id, input_ids).
    ``ids_source``: optional cheap frame holding a superset of ``order_col`` values,
    used only to place rank buckets. ``order_col`` must be unique."""
    B = block_size
    x = df.select(order_col, F.concat(F.col(ids_col), F.array(F.lit(eos_id))).alias("_s"))
    # The sequences are computed once; only (key, length) goes through the rank, and offsets come back by key.
    x = stored_once(x.withColumn("_len", F.size("_s")), "pack-rows")
    r = exact_rank(
        x.select(order_col, "_len"), [F.col(order_col)], F.col(order_col), weight=F.col("_len"), offset_col="_start", total_weight_col="_total", rank_col="_rank",
        bounds_source=ids_source,
    )
    r = x.select(order_col, "_s").join(r, order_col)
    full_blocks = F.floor(F.col("_total") / F.lit(B))
    r = r.withColumn("_end", F.col("_start") + F.col("_len"))
    first = F.floor(F.col("_start") / F.lit(B))
    last = F.least(F.floor((F.col("_end") - 1) / F.lit(B)), full_blocks - 1)
    pieces = r.filter(first <= last).select(
        "_s", "_start", "_end", F.explode(F.sequence(first, last)).alias("block_id")
    )
    lo = F.greatest(F.col("_start"), F.col("block_id") * B)
    hi = F.least(F.col("_end"), (F.col("block_id") + 1) * B)
    pieces = pieces.select(
        "block_id", lo.alias("_lo"), F.slice("_s", (lo - F.col("_start") + 1).cast("int"), (hi - lo).cast("int")).alias("_piece")
    )
    blocks = pieces.groupBy("block_id").agg(F.array_sort(F.collect_list(F.struct("_lo", "_piece"))).alias("_p"))
    return blocks.select(F.col("block_id").cast("long"), F.flatten(F.transform("_p", lambda p: p["_piece"])).alias("input_ids"))


def padding_waste(df: DataFrame, ids_col: str = "input_ids", block_size: int = 128) -> DataFrame:
    """pad-every-row cost. real = sum of lengths without EOS; waste may be negative
    when rows are longer than the block (they are not truncated here)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count(F.lit(1)) * F.lit(block_size)).alias("allocated_tokens"),
        F.coalesce(F.sum(F.size(ids_col)), F.lit(0)).alias("real_tokens"),
    ).withColumn(
        "waste_pct", 100.0 * (1.0 - F.col("real_tokens") / F.greatest(F.col("allocated_tokens"), F.lit(1)))
    )


def packing_efficiency(df: DataFrame, ids_col: str = "input_ids", block_size: int = 128) -> DataFrame:
    """real = tokens + one EOS per row; packed = full blocks x B;
    min(100, 100 * real / max(packed, 1)) — 100 when nothing packs. Needs no packing pass."""
    a = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.size(ids_col) + 1), F.lit(0)).alias("real_tokens"))
    blocks = F.floor(F.col("real_tokens") / F.lit(block_size))
    return a.withColumn("n_blocks", blocks).withColumn("packed_tokens", blocks * block_size).withColumn(
        "real_pct", F.least(F.lit(100.0), 100.0 * F.col("real_tokens") / F.greatest(F.col("packed_tokens"), F.lit(1)))
    )


def _epoch_key(seed: int, id_col: str):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(id_col).cast("string")))


def assign_batches(df: DataFrame, n_epochs: int = 1, seed: int = 42, per_device_batch: int = 4, accumulation: int = 4, n_devices: int = 1, id_col: str = "row_id") -> DataFrame:
    """per-epoch seeded order -> micro-batch id -> optimizer-step id.

    Effective batch = per-device batch x accumulation x devices. Epochs are a
    fixed-size array exploded next to each row (no join); the rank within an
    epoch comes from one exact global rank over (epoch, md5, id).
    """
    x = df.select(id_col, F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1))).alias("epoch"))
    x = x.withColumn("_h", _epoch_key(seed, id_col))
    bucket = F.col("epoch").cast("double") * F.lit(float(2**52)) + md5_bucket_key(F.col("_h"))
    r = exact_rank(x, [F.col("epoch"), F.col("_h"), F.col(id_col)], bucket, rank_col="_g", total_col="_tot")
    per_epoch = F.col("_tot") / F.lit(n_epochs)
    pos = (F.col("_g") - F.col("epoch") * per_epoch).cast("long")
    micro = F.floor(pos / F.lit(per_device_batch * n_devices))
    return r.select(
        "epoch",
        id_col,
        pos.alias("position"),
        micro.cast("long").alias("micro_batch"),
        F.floor(micro / F.lit(accumulation)).cast("long").alias("step"),
    )


def dynamic_padding_waste(df: DataFrame, length_col: str = "n_tokens", batch_size: int = 8, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """pad each micro-batch to its own longest row; compare a seeded random order
    with a length-sorted order. Batch maxima are aggregated per batch (bounded groups)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
    x = df.select(id_col, F.col(length_col).alias("_len")).withColumn("_h", h)
    rnd = exact_rank(x, [F.col("_h"), F.col(id_col)], md5_bucket_key(F.col("_h")), rank_col="_r")
    srt_key = F.col("_len").cast("double") * F.lit(float(2**40)) + F.conv(F.substring("_h", 1, 10), 16, 10).cast("double")
    srt = exact_rank(x, [F.col("_len"), F.col("_h"), F.col(id_col)], srt_key, rank_col="_r")

    def summarize(r: DataFrame, name: str) -> DataFrame:
        b = r.groupBy(F.floor(F.col("_r") / F.lit(batch_size)).alias("_b")).agg(
            F.max("_len").alias("_m"), F.count(F.lit(1)).alias("_c"), F.sum("_len").alias("_real")
        )
        return b.agg(
            F.lit(name).alias("order"),
            F.count(F.lit(1)).alias("n_batches"),
            F.sum("_real").alias("real_tokens"),
            F.sum(F.col("_m") * F.col("_c")).alias("padded_tokens"),
        )

    out = summarize(rnd, "random").unionByName(summarize(srt, "length_sorted"))
    return out.withColumn("waste_pct", 100.0 * (1.0 - F.col("real_tokens") / F.greatest(F.col("padded_tokens"), F.lit(1))))


def context_coverage(df: DataFrame, length_col: str = "n_tokens", lengths=(512, 1024, 2048, 4096)) -> DataFrame:
    """share of rows that fit each context length, and share of tokens kept when
    truncating to it. One aggregate pass; the per-length results are unpivoted."""
    aggs = [F.count(F.lit(1)).alias("_n"), F.sum(length_col).alias("_t")]
    for L in lengths:
        aggs.append(F.count_if(F.col(length_col) <= L).alias(f"_f{L}"))
        aggs.append(F.sum(F.least(F.col(length_col), F.lit(L))).alias(f"_k{L}"))
    a = df.agg(*aggs)
    rows = F.explode(
        F.array(*[F.struct(F.lit(L).cast("long").alias("context_length"), F.col(f"_f{L}").alias("n_fit"), F.col(f"_k{L}").alias("kept")) for L in lengths])
    ).alias("r")
    x = a.select("_n", "_t", rows)
    return x.select(
        "r.context_length",
        F.col("r.n_fit").cast("long").alias("rows_fit"),
        (F.col("r.n_fit") / F.col("_n")).alias("row_share"),
        (F.col("r.kept") / F.col("_t")).alias("token_share"),
    )
