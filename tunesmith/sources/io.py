"""Sources and sinks (A-group): parquet scans, JSON lines in and out, split and shard writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunesmith.session import default_parallelism

INSTRUCTION_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("instruction", T.StringType()),
        T.StructField("input", T.StringType()),
        T.StructField("output", T.StringType()),
    ]
)
PREFERENCE_SCHEMA = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("chosen", T.StringType()),
        T.StructField("rejected", T.StringType()),
    ]
)

CORRUPT_COL = "_corrupt_record"


def scan_parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A3: lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = INSTRUCTION_SCHEMA, *, quarantine: bool = False) -> DataFrame:
    """A1: one JSON object per line, UTF-8, blank lines skipped.

    A malformed line fails the job (FAILFAST), as the Python reader raises. With
    ``quarantine=True`` bad lines are kept in ``_corrupt_record`` instead, for the
    caller to split off; no row is dropped silently.
    """
    reader = spark.read.schema(schema).option("encoding", "UTF-8")
    if quarantine:
        full = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType())])
        return (
            spark.read.schema(full)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .json(path)
        )
    return reader.option("mode", "FAILFAST").json(path)


def read_jsonl_rows(spark: SparkSession, path: str, id_col: str = "row_id") -> DataFrame:
    """A1 for files without ids: every key of the objects is kept (the schema is inferred in a pass of its own), and
    rows that come without ``id_col`` get one from their file and line.

    Line numbers need no sort: reading gives consecutive numbers within a block of a file, and
    the lines before a block are summed over one row for each block. The id holds the file's
    place among the sorted paths above 40 bits of line number, so it is the same however the files are
    split. Blank lines are skipped (and counted); a malformed line fails the job.
    """
    schema = spark.read.option("mode", "FAILFAST").json(path).schema
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = spark.read.text(path).select("value", at.alias("_at")).withColumn("_n", F.monotonically_increasing_id())
    blocks = lines.groupBy("_at").agg(F.min("_n").alias("_first"), F.count(F.lit(1)).alias("_lines"))
    before = Window.partitionBy("_at.file").orderBy("_at.block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_base", F.coalesce(F.sum("_lines").over(before), F.lit(0)))
    blocks = blocks.withColumn("_file", F.dense_rank().over(Window.orderBy("_at.file")))
    numbered = lines.join(blocks.select(F.col("_at").alias("_of"), "_first", "_base", "_file"), F.col("_at") == F.col("_of"))
    line = F.col("_file").cast("long") * F.lit(1 << 40) + F.col("_base") + F.col("_n") - F.col("_first")
    rows = numbered.filter(F.trim("value") != "").select(line.alias("_line"), F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_row")).select("_line", "_row.*")
    if id_col in schema.names:
        return rows.withColumn(id_col, F.coalesce(F.col(id_col).cast("long"), F.col("_line"))).drop("_line")
    return rows.withColumnRenamed("_line", id_col)


def write_jsonl(df: DataFrame, path: str) -> str:
    """A2: JSON lines, nulls written (not dropped), non-ASCII unescaped, overwrite."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def save_splits(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Keep only ``split`` and ``text``; one folder per split."""
    df.select("split", "text").write.mode("overwrite").partitionBy("split").format(fmt).save(path)
    return path


def assign_shards(df: DataFrame, n_shards: int, order_col: str = "row_id", seed: int = 42) -> DataFrame:
    """Exact rank in seeded order, shard = rank mod n, so shard sizes differ by at most one."""
    from tunesmith.plans.ranks import exact_rank, md5_bucket_key, md5_order_key

    keyed = df.withColumn("_h", md5_order_key(seed, order_col))
    ranked = exact_rank(keyed, [F.col("_h"), F.col(order_col)], md5_bucket_key(F.col("_h")), rank_col="_rank")
    return ranked.withColumn("shard", F.pmod(F.col("_rank"), F.lit(n_shards)).cast("int")).drop("_h", "_rank")


def write_shards(df: DataFrame, path: str, n_shards: int, order_col: str = "row_id", seed: int = 42) -> str:
    """Write disjoint, equal-size shards for data-parallel readers (one folder per shard, whose rows
    are spread over as many writers as there are shuffle partitions for it)."""
    sharded = assign_shards(df, n_shards, order_col, seed)
    writers = max(1, default_parallelism(df.sparkSession) // n_shards)
    spread = F.pmod(F.xxhash64(order_col), F.lit(writers))
    sharded.repartition(n_shards * writers, "shard", spread).write.mode("overwrite").partitionBy("shard").parquet(path)
    return path


def load_sample_dataset(rows: DataFrame, val_fraction: float = 0.2, seed: int = 42, id_col: str = "row_id") -> DataFrame:
    """A4: instruction rows with a two-way ``split`` column (train/test)."""
    from tunesmith.operators.splits import split_two_way

    return split_two_way(rows, test_fraction=val_fraction, seed=seed, id_col=id_col)


def load_preference_dataset(rows: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """A5: validated preference rows with a two-way split."""
    from tunesmith.operators.prefs import validate_preferences
    from tunesmith.operators.splits import split_two_way

    return split_two_way(validate_preferences(rows), test_fraction=test_fraction, seed=seed)
