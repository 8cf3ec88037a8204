"""Operator 6, exact top-k inner products by norm-bucketed retrieval.

Every vector becomes integers floor(scale * x). The candidates are grouped into buckets
of similar length (Euclidean norm), at most ``bucket_rows`` rows each: ranges of the squared
norm, ranges with more rows being split by a hash of the id (as equal lengths may be
many). Queries are dealt to blocks and meet every bucket block by block; nothing but
scores that can still matter leaves a task:

1. each query gets its k-th best score over the bucket of the longest vectors and over
   one bucket near its own length: a lower bound of its final k-th score;
2. in every bucket, that bound divided by the query's length and the bucket's greatest
   length is the local cosine threshold of the query. Over 1, the whole bucket is skipped.
   Up to ``coordinate_from``, the bucket is pruned by length (only vectors at least
   bound / query length long); above, by coordinates: a vector whose cosine reaches the
   threshold t is at most arccos(t) away from the query, which bounds its
   normalised value in each of the query's largest coordinates;
3. products of what is left are verified in 64-bit integers, and those at or above the
   bound are ranked: score descending, vec_id ascending.

Vectors that are null, or hold null or non-finite components, take no part; vectors of
different dimension are never compared. |floor(scale * x)| must stay below 2^26, else the
task raises. A query is never its own answer: the rows of its own vec_id are left
out. Repeated vec_ids (or null ones, which are no queries) remain separate candidates.
Queries with no candidate have no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import n_groups, read_table, stored

HITS = "query_id long, vec_id long, score long"
LARGEST = 1 << 26


def quantised(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (array<long>), dim, norm2 of the vectors that take part."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    ints = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    kept = vectors.filter(x.isNotNull() & ~bad).select(F.col(id_col).cast("long").alias("vec_id"), ints.alias("v"))
    wide = F.exists("v", lambda c: F.abs(c) >= LARGEST)
    checked = kept.withColumn("v", F.when(wide, F.raise_error(F.lit("a component is too large for exact 64-bit products"))).otherwise(F.col("v")))
    norm2 = F.aggregate("v", F.lit(0).cast("long"), lambda a, c: a + c * c)
    return checked.withColumn("dim", F.size("v")).withColumn("norm2", norm2)


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in column])


def search(c_ids: np.ndarray, c: np.ndarray, q_ids: np.ndarray, q: np.ndarray, bounds: np.ndarray, k: int, coordinate_from: float, focus: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of what one bucket adds to a block of queries; ``bounds``
    holds the queries' lower bounds (the smallest integer: none yet)."""
    order = np.argsort(-(c * c).sum(axis=1), kind="stable")
    c, c_ids = c[order], c_ids[order]
    exact_in_floats = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, c.shape[1]) < 1 << 52
    work = c.astype(np.float64) if exact_in_floats else c
    lengths = np.sqrt((c.astype(np.float64) ** 2).sum(axis=1))
    unit = c / np.maximum(lengths, 1e-300)[:, None]
    out = []
    for qid, query, bound in zip(q_ids, q, bounds, strict=True):
        length = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        some: np.ndarray | slice = slice(None)
        if bound > 0 and length > 0:
            need = float(bound) / length * (1 - 1e-9)  # the least length that can reach the bound, with room for rounding
            if need > lengths[0]:
                continue
            some = slice(0, int(np.searchsorted(-lengths, -need, side="right")))
            cosine = need / lengths[0]
            if cosine >= coordinate_from:
                near = np.ones(some.stop, dtype=bool)
                unit_query = np.clip(query / length, -1.0, 1.0)
                apart = np.arccos(min(1.0, cosine)) + 1e-6  # the widest angle between query and answer
                for f in np.argsort(-np.abs(unit_query))[:focus]:
                    angle = np.arccos(unit_query[f])
                    low, high = np.cos(min(np.pi, angle + apart)), np.cos(max(0.0, angle - apart))
                    near &= (unit[: some.stop, f] >= low - 1e-9) & (unit[: some.stop, f] <= high + 1e-9)
                some = np.flatnonzero(near)
        held, ids = work[some], c_ids[some]
        if not len(ids):
            continue
        scores = (held @ (query.astype(np.float64) if exact_in_floats else query)).astype(np.int64)
        keep = (scores >= bound) & (ids != qid)
        scores, ids = scores[keep], ids[keep]
        if len(ids) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            keep = scores >= least
            scores, ids = scores[keep], ids[keep]
        best = np.lexsort((ids, -scores))[:k]
        out.extend((int(qid), int(i), int(s)) for i, s in zip(ids[best], scores[best], strict=True))
    return out


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, bucket_rows: int = 2048, query_rows: int = 512, coordinate_from: float = 0.6, focus: int = 6, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of every row for which ``is_query`` (over vec_id) holds."""
    rows = stored(quantised(vectors, scale, id_col, vector_col), "topk-vectors")
    buckets = n_groups(rows.count(), bucket_rows)
    # Ranges of the squared norm; a range of many rows is split by a hash of the id.
    cuts = rows.stat.approxQuantile("norm2", [i / buckets for i in range(1, buckets)], 0.01 / buckets) if buckets > 1 else []
    edges = sorted(set(cuts))

    def with_range(some: DataFrame) -> DataFrame:
        if not edges:
            return some.withColumn("range", F.lit(0))
        # A binary search, however many ranges there are.
        at = Bucketizer(splits=[float("-inf"), *edges, float("inf")], inputCol="of_norm2", outputCol="of_range")
        return at.transform(some.withColumn("of_norm2", F.col("norm2").cast("double"))).withColumn("range", F.col("of_range").cast("int")).drop("of_norm2", "of_range")

    ranged = with_range(rows)
    sizes = ranged.groupBy("dim", "range").agg(F.count("*").alias("n"))
    ranged = ranged.join(sizes, ["dim", "range"])
    cut = F.pmod(F.xxhash64("vec_id", "v"), F.ceil(F.col("n") / F.lit(float(bucket_rows))))
    items = ranged.select("vec_id", "v", "dim", "range", cut.cast("int").alias("cut"), "norm2")
    queries = rows.filter(is_query & F.col("vec_id").isNotNull())
    blocks = n_groups(queries.count(), query_rows)
    queries = with_range(queries).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "dim", "range", "norm2", F.pmod(F.xxhash64(F.lit(3), "vec_id"), F.lit(blocks)).cast("int").alias("block"))

    def meet(queries: DataFrame, buckets: DataFrame, name: str) -> DataFrame:
        """Each row of ``queries`` (query_id, q, bound, block, dim, range, cut) against its bucket."""

        def task(key: tuple, items: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
            if items.empty or qs.empty:
                return pd.DataFrame([], columns=["query_id", "vec_id", "score"])
            # Null vec_ids cannot be told from numbers here, so they travel as a flag.
            found = search(np.where(items["null"], np.iinfo(np.int64).min, items["id"]).astype(np.int64), _matrix(items["v"]), qs["query_id"].to_numpy(np.int64), _matrix(qs["q"]), qs["bound"].to_numpy(np.int64), k, coordinate_from, focus)
            return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

        keys = ["dim", "range", "cut", "block"]
        wanted = queries.select(*keys).distinct()
        left = buckets.drop("norm2").join(wanted, ["dim", "range", "cut"]).select(*[F.col(c).alias(f"of_{c}") for c in keys], "v", F.col("vec_id").isNull().alias("null"), F.coalesce("vec_id", F.lit(0)).alias("id"))
        return stored(left.groupBy(*[f"of_{c}" for c in keys]).cogroup(queries.groupBy(*keys)).applyInPandas(task, HITS), name)

    none = F.lit(-(1 << 62))
    cells = stored(items.groupBy("dim", "range", "cut").agg(F.max("norm2").alias("most")), "topk-buckets")
    longest = cells.groupBy("dim").agg(F.max(F.struct("range", F.col("cut").alias("cut"))).alias("m")).select("dim", "m.range", "m.cut")
    own = cells.select("dim", "range", "cut").filter("cut = 0")
    seeds = queries.drop("range").join(longest, "dim").unionByName(queries.join(own, ["dim", "range"])).distinct()
    first = meet(seeds.withColumn("bound", none), items, "topk-first")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    seen = first.distinct().withColumn("r", F.row_number().over(best)).filter(F.col("r") == k).select("query_id", F.col("score").alias("bound"))
    everywhere = queries.drop("range").join(seen, "query_id", "left").withColumn("bound", F.coalesce("bound", none)).join(cells, "dim")
    # A bucket whose longest vector can't reach the bound is left out before any vector moves (with room for rounding).
    reach = F.sqrt(F.col("norm2").cast("double")) * F.sqrt(F.col("most").cast("double")) * (1 + 1e-9)
    hits = meet(everywhere.filter((F.col("bound") <= 0) | (F.col("bound") <= reach)).drop("most"), items, "topk-hits")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    nameless = F.col("vec_id") == F.lit(int(np.iinfo(np.int64).min))
    return ranked.select("query_id", "rank", F.when(~nameless, F.col("vec_id")).alias("vec_id"), "score")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every vec_id divisible by 20 against all other rows, 20 best."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
