"""Operator 9, mixing sources to target weights (DataFrame operations only).

1. Each source's documents, in a fixed pseudorandom order, form one stream of words that
   is cut into blocks of ``block_words`` words.
2. Targets: every source gets a share of all words by its weight; no target exceeds ``most``
   times its source, and what is cut off is shared again by weight.
3. The mix is a row of slots, in output shards of ``shard_slots``. A source whose target is ``most``
   times its size has ``most`` slots for each of its blocks, without chance. Of the slots that
   each shard has left, the number of every other source is drawn: the whole part of its
   expectation, and for the rest a multinomial draw with the remaining fractions as
   probabilities. A source of few slots strays from its target by chance, up or down.
4. The j-th slot of a source over all shards takes the block that the source's
   pseudorandom permutation of block numbers gives to j modulo the number of blocks; each
   round through the blocks has a permutation of its own (a swap-or-not shuffle, a
   bijection on any range). Draws beyond ``most`` rounds are dealt to the drawn sources that have
   room, in proportion to it, so no word is taken more often and no slot is lost.
5. Slots and documents meet by (source, block); a block reaches the documents whose words it holds.

Offsets, draws and joins are dealt by hash bucket or block, never by source; only one row for
each source and one for each shard and source are ordered. All choices are hashes of
ids, so reruns agree.

Words are maximal runs without [\x20\x09-\x0D]. Null text has none, null sources are one
source (last in order), documents without words take part with 0 taken. Rows that repeat a doc_id
are separate documents. An empty table, or one without words, gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunesmith.llm.common import read_table, running_total, stored, text_of
from tunesmith.llm.sharding import _uniform, let
from tunesmith.session import default_parallelism

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``sources`` (source, source_size) with weight and target. One row for each source, so it may be ordered whole.

    With the sources in order of size / weight, those below some place are cut off at
    ``most`` times their size, and the rest share what is left by weight: the first place at which
    the source that follows isn't cut off."""
    place = Window.orderBy(F.col("source").isNull(), "source")
    n = len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(place) - 1, F.lit(n)) + 1).cast("int"))
    every = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    ranked = sources.withColumn("weight", weight).withColumn("_all", F.sum("source_size").over(every)).withColumn("_w", F.sum("weight").over(every))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumn("_cut", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most).withColumn("_gone", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    level = (F.col("_all") - F.col("_cut")) / (F.col("_w") - F.col("_gone"))  # words for each unit of weight, if all before are cut off
    ranked = ranked.withColumn("_level", level).withColumn("_free", F.col("_level") * F.col("weight") <= F.col("source_size") * most)
    water = F.min(F.when(F.col("_free"), F.struct(F.col("_gone"), F.col("_level")))).over(every)
    target = F.least(F.col("source_size") * F.lit(float(most)), F.coalesce(water["_level"], F.lit(0.0)) * F.col("weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def permuted(x: Column, n: Column, *key, rounds: int = 16) -> Column:
    """A pseudorandom bijection of 0 .. n - 1: in each round, x and its partner swap places or not,
    by one bit that both share."""

    def step(at: Column, r: Column) -> Column:
        partner = F.pmod(F.xxhash64(*key, r) - at, n)
        return F.when(F.xxhash64(*key, r, F.greatest(at, partner)) % 2 == 0, at).otherwise(partner)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), step)


def drawn_blocks(mix: DataFrame, block_words: int, shard_slots: int, most: int, seed: int) -> DataFrame:
    """source, block, times: how often each block is taken. ``mix``: one row for each source."""
    blocks = F.ceil(F.col("source_size") / F.lit(float(block_words))).cast("long")
    some = mix.filter("source_size > 0").withColumn("blocks", blocks).withColumn("slots", F.col("target") / F.col("source_size") * F.col("blocks"))
    some = some.withColumn("room", F.col("blocks") * most).withColumn("full", F.col("target") >= F.col("source_size") * F.lit(float(most)))
    drawn = F.when(~F.col("full"), F.col("slots"))
    one = some.agg(
        F.sort_array(F.collect_list(F.when(~F.col("full"), F.struct(F.col("source").isNull().alias("no"), "source", "room", "slots")))).alias("all"),
        F.round(F.sum("slots")).cast("long").alias("total"),
        F.round(F.sum(drawn)).cast("long").alias("left"),
    )
    shards = F.ceil(F.col("total") / F.lit(float(shard_slots))).cast("long")
    one = one.filter("left > 0").withColumn("shards", shards)
    edge = lambda k: F.floor(F.col("left") * k / F.col("shards"))
    shard = one.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    shard = shard.withColumn("n", edge(F.col("shard") + 1) - edge(F.col("shard")))
    sum_slots = F.aggregate("all", F.lit(0.0), lambda a, s: a + s["slots"])
    shard = shard.withColumn("expected", F.transform(F.col("all"), lambda s: s["slots"])).withColumn("scale", F.col("n") / sum_slots)
    shard = shard.withColumn("expected", F.transform("expected", lambda e: e * F.col("scale")))
    shard = shard.withColumn("whole", F.transform("expected", lambda e: F.floor(e))).withColumn("parts", F.transform("expected", lambda e: e - F.floor(e)))
    rest = F.col("n") - F.aggregate("whole", F.lit(0).cast("long"), lambda a, w: a + w)
    shard = shard.withColumn("rest", F.greatest(rest, F.lit(0))).withColumn("sum_parts", F.aggregate("parts", F.lit(0.0), lambda a, p: a + p))
    # Running sums of the fractions; the draws fall into them.
    start = F.struct(F.lit(0.0).alias("s"), F.expr("cast(array() as array<double>)").alias("ends"))
    ends = F.aggregate("parts", start, lambda a, p: F.struct((a["s"] + p).alias("s"), F.concat(a["ends"], F.array(a["s"] + p)).alias("ends")))["ends"]
    shard = shard.withColumn("ends", ends)
    draws = F.when(F.col("rest") > 0, F.transform(F.sequence(F.lit(1).cast("long"), F.col("rest")), lambda i: _uniform(F.lit(seed), F.lit("draw"), F.col("shard"), i) * F.col("sum_parts"))).otherwise(F.expr("cast(array() as array<double>)"))
    shard = shard.withColumn("draws", draws)
    picked = F.transform("draws", lambda d: F.least(F.size(F.filter("ends", lambda e: e <= d)), F.size("ends") - 1))
    shard = stored(shard.withColumn("picked", picked).select("shard", "all", "whole", "picked"), "mix-draws")
    counts = F.transform(F.col("all"), lambda s, i: F.struct(s["source"].alias("source"), s["room"].alias("room"), (F.element_at("whole", i + 1) + F.size(F.filter("picked", lambda p: p == i))).alias("n")))
    counted = shard.select(F.inline(counts)).groupBy("source", "room").agg(F.sum("n").alias("n"))
    # One row for each source: what was drawn beyond a source's room goes to places in the room of the others.
    every, until = Window.partitionBy(), Window.orderBy(F.col("source").isNull(), "source")
    counted = counted.withColumn("free", F.greatest(F.col("room") - F.col("n"), F.lit(0)))
    counted = counted.withColumn("over", F.sum(F.greatest(F.col("n") - F.col("room"), F.lit(0))).over(every)).withColumn("places", F.sum("free").over(every)).withColumn("end", F.sum("free").over(until.rowsBetween(Window.unboundedPreceding, 0)))
    dealt = lambda at: F.expr(f"cast(over as decimal(19, 0)) * cast({at} as decimal(19, 0)) div cast(places as decimal(19, 0))")
    more = F.when(F.col("places") > 0, dealt("end") - dealt("end - free")).otherwise(0)
    dealt_to = counted.select(F.col("source").alias("_source"), F.least(F.col("n") + more, F.col("room")).alias("n"))
    some = some.join(dealt_to, F.col("source").eqNullSafe(F.col("_source")), "left")
    some = some.withColumn("n", F.when(F.col("full"), F.col("room")).otherwise(F.coalesce("n", F.lit(0)))).filter("n > 0")
    # Few rows that become many: dealt to all tasks first (by a fixed number, as their own size says nothing).
    runs = some.select("source", "blocks", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(shard_slots).cast("long"))).alias("first"))
    runs = runs.withColumn("last", F.least(F.col("first") + shard_slots, F.col("n")) - 1).repartition(default_parallelism(mix.sparkSession), "first", "source")
    slots = runs.select("source", "blocks", F.explode(F.sequence("first", "last")).alias("j"))
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    at = permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.lit(seed), name, F.floor(F.col("j") / F.col("blocks")))
    return slots.select("source", at.alias("block")).groupBy("source", "block").agg(F.count("*").alias("times"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, block_words: int = 128, shard_slots: int = 4096, seed: int = 5) -> DataFrame:
    """One row for each document: doc_id, fp and nth (which tell rows of one doc_id apart), source, size,
    source_size, target, taken, pieces (array of first word, words, times)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in(text_of()).alias("size"), F.xxhash64("text").alias("fp"))
    sizes = stored(base.withColumn("nth", F.row_number().over(Window.partitionBy("doc_id", "fp").orderBy("source"))), "mix-sizes")
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    mixed = stored(targets(sources, weights, float(most)), "mix-targets")
    order = [F.xxhash64(F.lit(seed), "doc_id", "fp", "nth"), F.col("doc_id"), F.col("fp"), F.col("nth")]
    placed = stored(running_total(sizes, ["source"], order, "size", "start"), "mix-placed")
    # Written, so that the join below knows its size (its plan would take it for as small as the draws).
    times = stored(drawn_blocks(mixed, block_words, shard_slots, most, seed), "mix-times")
    touched = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words))))
    first = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0))
    end = F.least((F.col("block") + 1) * block_words - F.col("start"), F.col("size"))
    held = touched.select("doc_id", "fp", "nth", F.col("source").alias("_s"), F.col("block").alias("_b"), first.alias("first"), (end - first).alias("words"))
    met = held.join(times, F.col("_s").eqNullSafe(F.col("source")) & (F.col("_b") == F.col("block")))
    of = ["doc_id", "fp", "nth"]
    taken = met.groupBy(*of).agg(F.sum(F.col("words") * F.col("times")).alias("taken"), F.sort_array(F.collect_list(F.struct("first", "words", "times"))).alias("pieces"))
    right = taken.select(*[F.col(c).alias(f"_{c}") for c in of], "taken", "pieces")
    rows = placed.join(right, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("fp") == F.col("_fp")) & (F.col("nth") == F.col("_nth")), "left")
    few = mixed.select(F.col("source").alias("_source"), "source_size", "target")
    rows = rows.join(few, F.col("source").eqNullSafe(F.col("_source")))
    return rows.select(*of, "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "pieces")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents with the text that the mix takes of each: its taken words in order, and once
    more, on a new line, those taken twice, and so on. Documents of which nothing is taken go."""
    plan = mix(docs, **options).filter("taken > 0").select(F.col("doc_id").alias("_doc"), F.col("fp").alias("_fp"), F.col("nth").alias("_nth"), F.col("pieces").alias("_pieces"))
    rows = docs.withColumn("_hash", F.xxhash64("text"))
    rows = rows.withColumn("_row", F.row_number().over(Window.partitionBy("doc_id", "_hash").orderBy("source")))
    met = rows.join(plan, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_fp")) & (F.col("_row") == F.col("_nth")))
    most = F.aggregate("_pieces", F.lit(0).cast("long"), lambda a, p: F.greatest(a, p["times"]))

    def taken(words: Column) -> Column:  # with the words bound once, not computed again for each piece
        def copy(k: Column) -> Column:
            pieces = F.filter("_pieces", lambda p: p["times"] >= k)
            return F.array_join(F.transform(pieces, lambda p: F.array_join(F.slice(words, (p["first"] + 1).cast("int"), p["words"].cast("int")), "")), "")

        return F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), most), copy), "\n")

    text = let(F.regexp_extract_all("text", F.lit(f"{WORD}{SPACE}*"), F.lit(0)), taken)
    out = met.withColumn("text", text).withColumn("n_chars", F.length("text").cast(dict(docs.dtypes).get("n_chars", "long")))
    return out.select(*docs.columns)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
