"""Operator 13, target-distribution importance resampling of documents.

A document's features are its words and pairs of neighbouring words, hashed into
``buckets``. The gain of a bucket is the scaled log ratio of its smoothed share in the
target texts to that in all documents; a document's weight is the floored mean of the
gains of its features, its score the weight plus Gumbel noise that depends on the seed and
its doc_id alone. Drawing the highest scores is drawing without replacement by weight.

1. Bucket counts of documents and target: each task adds up arrays, one row for each bucket
   and task is summed by Spark; ``buckets`` gains reach the driver and are sent to all tasks.
2. Scores of all documents are written once.
3. The key of the last drawn document is found by weighted median-of-medians: every
   partition reports the median and the number of its remaining keys; the median of those,
   weighted by the numbers, leaves at least a quarter of the keys on each side, so each round
   discards at least a quarter. A round reads the written keys and brings one row of each
   partition to the driver. Once at most ``direct`` keys remain they are fetched and sorted.
4. Only the drawn documents are ordered, by buckets of their keys (``plans/ranks.py``).

Defined results: a null or empty text has no words, hence 0 features and weight 0, and is never
drawn if ``min_words`` is over 0. A null doc_id counts as the empty string in the noise and
comes last among equal scores; rows with equal scores and doc_ids are ordered by a hash of the text, and
rows equal in this too in any order (as many of them are drawn as fit). An empty documents table gives no
rows; an empty target has 0 counts everywhere. Texts of any length are read piece by piece.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.llm.common import read_table, stored, tidied
from tunesmith.llm.words import terms, texts_of
from tunesmith.plans.ranks import exact_rank

LAST = (1 << 63) - 1


def features_of(text: bytes | None, buckets: int) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the bucket of each of its features."""
    n, before, found = 0, None, []
    for some in terms(text):
        if not some:
            continue
        n += len(some)
        ones = list(map(zlib.crc32, some))
        # The checksum of "a b" goes on from that of "a".
        spaced = list(map(zlib.crc32, repeat(b" "), ones if before is None else [before, *ones]))
        pairs = list(map(zlib.crc32, some if before is not None else some[1:], spaced))
        found += [np.array(ones, np.uint32), np.array(pairs, np.uint32)]
        before = ones[-1]
    return n, (np.concatenate(found) if found else np.empty(0, np.uint32)) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all ``texts`` (column text) fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for t in texts_of(batch.column("text")):
                held += np.bincount(features_of(t, buckets)[1], minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at, pa.int64()), "n": pa.array(held[at])})

    found = texts.select("text").mapInArrow(tidied(count), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains_of(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed target share / smoothed source share)) for each bucket."""
    n, s, t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(seed: int, key: str) -> int:
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: int, min_words: int) -> DataFrame:
    """The columns of ``docs`` with _n, _weight, _score, _may (enough words), _id and _tie."""
    sent = docs.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket
    names = docs.columns
    rows = docs.select(
        *[F.col(c) for c in names],
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_key"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_tie"),
        F.col("text").alias("_text"),
    )
    schema = rows.select(*names, "_id", "_tie").schema.add("_n", "long").add("_weight", "long").add("_score", "long").add("_may", "boolean")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = sent.value
        for batch in batches:
            found = []
            for key, text in zip(batch.column("_key").to_pylist(), texts_of(batch.column("_text")), strict=True):
                n, at = features_of(text, len(gains))
                weight = int(gains[at].sum()) // len(at) if len(at) else 0
                found.append((len(at), weight, weight + noise(seed, key), n >= min_words))
            columns = [batch.column(c) for c in [*names, "_id", "_tie"]] + [pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64()] * 3 + [pa.bool_()], strict=True)] if found else None
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(tidied(score), schema)


KEY = ("a", "b", "c")
_REPORT = "below long, equal long, above long, " + ", ".join(f"{side}_{k} long" for side in ("low", "high") for k in KEY)


def _less(keys: np.ndarray, bound: tuple[int, int, int]) -> np.ndarray:
    """Which columns of ``keys`` come before ``bound``."""
    (a, b, c), (x, y, z) = keys, bound
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & (c < z))))


def _median(keys: np.ndarray) -> list[int]:
    order = np.lexsort(keys[::-1])
    return keys[:, order[(len(order) - 1) // 2]].tolist() if len(order) else [0, 0, 0]


def _kept(keys: np.ndarray, low, high) -> np.ndarray:
    """The columns strictly between ``low`` and ``high`` (None: no bound)."""
    if high is not None:
        keys = keys[:, _less(keys, high)]
    if low is not None:
        keys = keys[:, ~_less(keys, low) & ~(keys == np.array(low, np.int64)[:, None]).all(axis=0)]
    return keys


def kth_key(keys: DataFrame, k: int, direct: int = 10_000) -> tuple[int, int, int]:
    """The k-th smallest (from 1) of the keys (a, b, c) by weighted median-of-medians; ``keys`` is
    read once a round, so it should be a written table, and holds at least k rows."""

    def columns(batches: Iterator[pa.RecordBatch], low, high) -> np.ndarray:
        some = [_kept(np.stack([b.column(c).to_numpy() for c in KEY]), low, high) for b in batches if b.num_rows]
        return np.concatenate(some, axis=1) if some else np.empty((3, 0), np.int64)

    def report(low, high, pivot):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = columns(batches, low, high)
            if not held.shape[1]:
                return
            before = _less(held, pivot) if pivot else np.ones(held.shape[1], bool)
            same = (held == np.array(pivot, np.int64)[:, None]).all(axis=0) if pivot else ~before
            under, over = held[:, before], held[:, ~before & ~same]
            row = [under.shape[1], int(same.sum()), over.shape[1], *_median(under), *_median(over)]
            names = ["below", "equal", "above", *(f"{s}_{k}" for s in ("low", "high") for k in KEY)]
            yield pa.RecordBatch.from_pydict({n: pa.array([v], pa.int64()) for n, v in zip(names, row, strict=True)})

        return keys.mapInArrow(run, _REPORT).collect()

    def weighted(rows, side: str, weight: str) -> tuple[int, int, int]:
        found = sorted((tuple(r[f"{side}_{k}"] for k in KEY), r[weight]) for r in rows if r[weight])
        half, run = sum(w for _, w in found) / 2, 0
        for key, w in found:
            run += w
            if run >= half:
                return key
        raise ValueError("fewer keys than asked for")

    low = high = pivot = None
    while True:
        rows = report(low, high, pivot)
        below, equal = sum(r.below for r in rows), sum(r.equal for r in rows)
        if k <= below:
            high, left, after = pivot or high, below, weighted(rows, "low", "below")
        elif k <= below + equal:
            return pivot
        else:
            low, k, left, after = pivot, k - below - equal, sum(r.above for r in rows), weighted(rows, "high", "above")
        if left <= direct:

            def rest(batches: Iterator[pa.RecordBatch], low=low, high=high) -> Iterator[pa.RecordBatch]:
                held = columns(batches, low, high)
                yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in zip(KEY, held, strict=True)})

            found = keys.mapInArrow(rest, "a long, b long, c long").collect()
            return tuple(sorted(map(tuple, found))[k - 1])
        pivot = after


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, buckets: int = 10_000, keep: list[str] | None = None, direct: int = 10_000) -> DataFrame:
    """Every row of ``docs`` with the columns ``keep`` (all of its own if None) and _n (features),
    _weight, _score and _rank: 1, 2, 3... for the floor(percent * N / 100) best of the N rows with at
    least ``min_words`` words, null for the others."""
    keep = docs.columns if keep is None else keep
    gains = gains_of(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    wanted = docs.select(*[F.col(c) for c in dict.fromkeys([*keep, "doc_id", "text"])])
    rows = stored(scored(wanted, gains, seed, min_words).select(*keep, "_id", "_tie", "_n", "_weight", "_score", "_may"), "resample-scores")
    may = rows.filter("_may")
    stats = may.agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("low"), F.max(F.when(F.col("_id") < LAST, F.col("_id"))).alias("high")).first()
    draw = percent * stats.n // 100
    out = [*keep, "_n", "_weight", "_score"]
    if not draw:
        return rows.select(*out, F.lit(None).cast("long").alias("_rank"))
    a, b, c = kth_key(may.select((-F.col("_score")).alias("a"), F.col("_id").alias("b"), F.col("_tie").alias("c")), draw, direct)
    mine = F.struct((-F.col("_score")).alias("a"), F.col("_id").alias("b"), F.col("_tie").alias("c"))
    won = F.col("_may") & (mine <= F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"), F.lit(c).cast("long").alias("c")))
    span = float((stats.high if stats.high is not None else 0) - (stats.low if stats.low < LAST else 0) + 1)
    part = F.when(F.col("_id") == LAST, F.lit(1.0)).otherwise((F.col("_id") - F.lit(stats.low if stats.low < LAST else 0)) / F.lit(span))
    ranked = exact_rank(rows.filter(won), [F.col("_score").desc(), F.col("_id"), F.col("_tie")], part - F.col("_score"), rank_col="_at")
    ranked = ranked.select(*out, F.when(F.col("_at") < draw, F.col("_at") + 1).cast("long").alias("_rank"))
    return ranked.unionByName(rows.filter(~won).select(*out, F.lit(None).cast("long").alias("_rank")))


def resampled_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with their own columns."""
    return resample(docs, target, **options).filter(F.col("_rank").isNotNull()).select(*docs.columns)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents, drawn towards the benchmark texts."""
    out = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", F.col("_n").alias("n_features"), F.col("_weight").alias("weight"), F.col("_score").alias("score"), F.col("_rank").alias("rank"))


#: The contract in DuckDB: crc32 by its table of 256 entries, which the rule of the polynomial makes.
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS step, i::UBIGINT AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE step < 8),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
texts AS (
  SELECT 0 AS side, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
worded AS MATERIALIZED (
  SELECT side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS MATERIALIZED (
  SELECT side, row, f FROM (
    SELECT side, row, unnest(w) AS f FROM worded
    UNION ALL
    SELECT side, row, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded WHERE len(w) > 1)),
hashed AS MATERIALIZED (
  SELECT f, xor(list_reduce(
      list_transform(range(len(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::UBIGINT),
      lambda c, b: xor(t[((xor(c, b) & 255) + 1)::BIGINT], c >> 8), 4294967295::UBIGINT), 4294967295::UBIGINT) % 10000 AS bucket
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)), crc_table),
placed AS MATERIALIZED (SELECT side, row, bucket FROM features JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM placed GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM counts),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1) * (ss + 10000))::DOUBLE / ((s + 1) * (tt + 10000))::DOUBLE))::BIGINT AS gain FROM counts, totals),
weights AS (SELECT row, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
scores AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded d LEFT JOIN weights USING (row) WHERE d.side = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS r, count(*) OVER (PARTITION BY n_words >= 20) AS n FROM scores)
SELECT doc_id, n_features, weight, score::BIGINT AS score, (CASE WHEN n_words >= 20 AND r <= 25 * n // 100 THEN r END)::BIGINT AS rank FROM ranked
"""
