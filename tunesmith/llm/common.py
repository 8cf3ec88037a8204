"""Helpers shared by the corpus operators of this subpackage."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.session import release_memory, shared_scratch, tidied  # noqa: F401

#: The white space of every contract here: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
#: Rows handed to Python at a time; texts are long, so far fewer than Spark's default of 10,000.
ARROW_ROWS = 512
ARROW_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; also bounds an Arrow batch for this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and a lost
    executor costs no more than re-reading files that every machine sees."""
    path = shared_scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, with null counted as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def n_groups(rows: int, per_group: int) -> int:
    """How many groups of about ``per_group`` rows hold ``rows`` rows."""
    return max(1, math.ceil(rows / per_group))


def running_total(df: DataFrame, keys: list[str], order: list, weight: str, out: str, rows_per_bucket: int = 50_000) -> DataFrame:
    """Adds the exclusive running sum of ``weight`` within ``keys``, in an order that is
    pseudorandom but fixed: by hash bucket of ``order``, then by ``order``.

    No key is handled by one task: a key is cut into hash buckets of about
    ``rows_per_bucket`` rows, the sums of the buckets are accumulated (one row for
    each bucket), and each bucket then finishes alone. ``df`` is read twice, so it
    should be a written table.
    """
    buckets = n_groups(df.count(), rows_per_bucket)
    cut = df.withColumn("_b", F.pmod(F.xxhash64(F.lit(17), *order), F.lit(buckets)).cast("int"))
    sums = cut.groupBy(*keys, "_b").agg(F.sum(weight).alias("_s"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_bb"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    joined = cut.join(base, on=[*on, F.col("_b") == F.col("_bb")])
    inner = Window.partitionBy(*keys, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(out, F.col("_base") + F.coalesce(F.sum(weight).over(inner), F.lit(0))).drop("_b", "_bb", "_base", *[f"_k{i}" for i in range(len(keys))])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(at):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def compressed(docs: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and z: the bytes of ``text``, compressed for the way through a shuffle."""

    def pack(batches):
        import zstandard

        c = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            z = [c.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({k: batch.column(k) for k in keys} | {"z": pa.array(z, pa.binary())})

    return docs.select(*keys, "text").mapInArrow(tidied(pack), ", ".join([*(f"{k} {dict(docs.dtypes)[k]}" for k in keys), "z binary"]))


def decompress(z: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(z)
