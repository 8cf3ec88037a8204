"""Operator 5, sharding by a hypergeometric communication matrix (DataFrame operations only).

A uniform shuffle into shards of exact size (row counts at most one apart, law ``rows``):

1. rows fall into P logical partitions by a hash; only their counts are needed;
2. the matrix of how many rows partition p sends to shard s is drawn from the law that
   a uniform permutation of all rows would give it: with fixed row and column sums, the
   multivariate hypergeometric law. A binary tree over the partitions splits the
   shard sizes level by level, so a draw needs only its parent and all
   nodes of a level are drawn in parallel; one draw inverts the distribution function
   with the ratios of neighbouring probabilities, over all values within 12 standard
   deviations (what lies beyond has less probability than a double can express);
3. each partition permutes its rows (rank by a keyed hash) and deals them out by its row
   of the matrix, rows meet in their shard, and the shard permutes them again.

No step handles a shard or the table in one task: a partition holds about
``rows_per_partition`` rows, and slots are running counts over hash buckets of a shard. The law
looks at neither text nor source, so copies and hot sources spread like all rows.

Null text has 0 bytes and the checksum of an empty one. Rows with equal (doc_id, size, text_crc32)
are interchangeable; null doc_ids are rows like others. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import n_groups, read_table, running_total, stored, text_of

SIGMAS = 12


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (an array of one element, transformed)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _uniform(*parts) -> Column:
    """A double in [0, 1) that is a fixed function of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def _steps(first: Column, last: Column, down: bool = False) -> Column:
    none = F.expr("cast(array() as array<bigint>)")
    return F.when(first >= last, F.sequence(first, last, F.lit(-1).cast("long"))).otherwise(none) if down else F.when(first <= last, F.sequence(first, last, F.lit(1).cast("long"))).otherwise(none)


def hypergeometric(population: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` rows are marked, if ``marked`` of ``population`` are: the value at
    which the distribution function, summed from the mode up and then down, passes ``u``."""

    def with_shape(p: Column) -> Column:
        r, m, k = p["r"], p["m"], p["k"]
        share = m / F.greatest(r, F.lit(1.0))
        sigma = F.sqrt(k * share * (1 - share) * (r - k) / F.greatest(r - 1, F.lit(1.0)))
        low, high = F.greatest(F.lit(0.0), k - (r - m)), F.least(m, k)
        mode = F.least(high, F.greatest(low, F.floor((k + 1) * (m + 1) / (r + 2)).cast("double")))
        reach = F.ceil(sigma * SIGMAS).cast("double") + SIGMAS
        shape = F.struct(p["u"].alias("u"), r.alias("r"), m.alias("m"), k.alias("k"), mode.cast("long").alias("mode"), F.greatest(low, mode - reach).cast("long").alias("a"), F.least(high, mode + reach).cast("long").alias("b"))
        return let(shape, with_total)

    def ratio_up(p: Column, x: Column) -> Column:  # P(x) / P(x - 1)
        return (p["m"] - x + 1) * (p["k"] - x + 1) / (x * (p["r"] - p["m"] - p["k"] + x))

    def ratio_down(p: Column, x: Column) -> Column:  # P(x) / P(x + 1)
        return (x + 1) * (p["r"] - p["m"] - p["k"] + x + 1) / ((p["m"] - x) * (p["k"] - x))

    def walk(p: Column, steps: Column, ratio, start: Column) -> Column:
        def step(s: Column, x: Column) -> Column:
            return let(s["w"] * ratio(p, x), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum"), F.when(s["at"].isNull() & (s["sum"] + w > s["goal"]), x).otherwise(s["at"]).alias("at"), s["goal"].alias("goal")))

        return F.aggregate(steps, start, step)

    def state(total: Column, at: Column, goal: Column) -> Column:
        return F.struct(F.lit(1.0).alias("w"), total.alias("sum"), at.alias("at"), goal.alias("goal"))

    def with_total(p: Column) -> Column:
        up, down = _steps(p["mode"] + 1, p["b"]), _steps(p["mode"] - 1, p["a"], down=True)
        nowhere, endless = F.lit(None).cast("long"), F.lit(float("inf"))
        whole = walk(p, down, ratio_down, state(walk(p, up, ratio_up, state(F.lit(1.0), nowhere, endless))["sum"], nowhere, endless))["sum"]

        def pick(goal: Column) -> Column:
            first = state(F.lit(1.0), F.when(goal < 1.0, p["mode"]), goal)
            return let(walk(p, up, ratio_up, first), lambda s: F.coalesce(s["at"], walk(p, down, ratio_down, state(s["sum"], nowhere, goal))["at"], p["mode"]))

        return let(whole * p["u"], pick)

    return let(F.struct(population.cast("double").alias("r"), marked.cast("double").alias("m"), drawn.cast("double").alias("k"), u.alias("u")), with_shape)


def split_counts(counts: Column, drawn: Column, *key) -> Column:
    """A multivariate hypergeometric draw: of each shard's ``counts``, how many fall among ``drawn`` rows."""
    every = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
    start = F.struct(every.alias("left"), drawn.cast("long").alias("k"), F.expr("cast(array() as array<bigint>)").alias("x"))

    def step(s: Column, c: Column) -> Column:
        x = hypergeometric(s["left"], c, s["k"], _uniform(*key, F.size(s["x"])))
        return let(x, lambda x: F.struct((s["left"] - c).alias("left"), (s["k"] - x).alias("k"), F.concat(s["x"], F.array(x)).alias("x")))

    return F.aggregate(counts, start, step)["x"]


def communication_matrix(sizes: DataFrame, levels: int, shards: int, seed: int) -> DataFrame:
    """part, counts (array over shards) for the 2^levels partitions of ``sizes`` (part, n)."""
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    even = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.floor(F.col("rows") / shards).cast("long") + F.when(s < F.col("rows") % shards, 1).otherwise(0))
    nodes = total.select(F.lit(0).cast("long").alias("node"), even.alias("counts"))
    for level in range(levels):
        # The rows of each node's left child.
        child = F.shiftright("part", levels - level - 1)
        left = sizes.filter(child % 2 == 0).groupBy(F.shiftright(child, 1).alias("node")).agg(F.sum("n").alias("n"))
        drawn = nodes.join(left, "node", "left").withColumn("x", split_counts(F.col("counts"), F.coalesce("n", F.lit(0)), F.lit(seed), F.lit(level), F.col("node")))
        rest = F.zip_with("counts", "x", lambda c, x: c - x)
        nodes = drawn.select(F.inline(F.array(F.struct((F.col("node") * 2).alias("node"), F.col("x").alias("counts")), F.struct((F.col("node") * 2 + 1).alias("node"), rest.alias("counts")))))
        if level % 3 == 2:
            nodes = stored(nodes, "matrix")
    return nodes.select(F.col("node").alias("part"), "counts")


def shuffle_into_shards(rows: DataFrame, key: list[str], shards: int, seed: int = 11, rows_per_partition: int = 50_000, least_levels: int = 4) -> DataFrame:
    """``rows`` with shard (0 to shards - 1) and slot (gapless from 0 in each shard); ``key`` columns identify a row."""
    rows = stored(rows, "shard-rows")
    levels = max(least_levels, (n_groups(rows.count(), rows_per_partition) - 1).bit_length())
    part = F.pmod(F.xxhash64(F.lit(seed), F.lit("part"), *key), F.lit(1 << levels)).cast("long")
    sizes = stored(rows.groupBy(part.alias("part")).agg(F.count("*").alias("n")), "shard-sizes")
    matrix = communication_matrix(sizes, levels, shards, seed)
    locally = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), F.lit("local"), *key), *key)
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda s: F.aggregate(F.slice("counts", F.lit(1), s), F.lit(0).cast("long"), lambda a, c: a + c))
    dealt = rows.withColumn("part", part).withColumn("_r", F.row_number().over(locally)).join(matrix.select("part", ends.alias("_ends")), "part")
    dealt = dealt.withColumn("shard", F.size(F.filter("_ends", lambda e: e < F.col("_r")))).drop("part", "_r", "_ends")
    again = stored(dealt.withColumn("_one", F.lit(1).cast("long")).withColumn("_again", F.xxhash64(F.lit(seed), F.lit("again"), *key)), "shard-dealt")
    return running_total(again, ["shard"], ["_again", *key], "_one", "slot").drop("_one", "_again")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all documents into 24 shards by law ``rows``."""
    docs = read_table(spark, sf_dir, "documents")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text_of()) + 8).cast("long").alias("size"), F.crc32(text_of().cast("binary")).cast("long").alias("text_crc32"))
    out = shuffle_into_shards(rows, ["doc_id", "size", "text_crc32"], 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
