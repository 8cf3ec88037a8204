"""Tokenization on tables (E-group).

The native tokenizer is a regex (``TOKEN_PATTERN``) run JVM side by
``regexp_extract_all``; the vocabulary is counted from the corpus in Spark.
Everything downstream of ``encode`` only sees ``array<int>``, so a real subword
tokenizer can replace the first two steps (see ``infer.udf_tokenizer``).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.functions.text import explode_values, split_ws
from tunesmith.functions.text import tokenize as tokenize_col
from tunesmith.plans.ranks import exact_rank
from tunesmith.session import bounded_batches, default_parallelism, stored_once

# Reserved tokens and their ids.
SPECIAL_TOKENS = (("pad", "<pad>", 0), ("bos", "<s>", 1), ("eos", "</s>", 2), ("unk", "<unk>", 3))
PAD_ID, BOS_ID, EOS_ID, UNK_ID = 0, 1, 2, 3
N_RESERVED = len(SPECIAL_TOKENS)
IGNORE_INDEX = -100
#: Rows of a vocabulary at most that reach every task when arrays are looked up in it.
HEAD = 1 << 18
#: Pairs of neighbours that a task counts at a time.
PAIRS = 1 << 22


def tokenize(df: DataFrame, text_col: str = "text", out: str = "tokens") -> DataFrame:
    """Text -> token strings."""
    return df.withColumn(out, tokenize_col(text_col))


def build_vocab(df: DataFrame, tokens_col: str = "tokens", k: int | None = None) -> DataFrame:
    """Every token by (count desc, token asc) after the reserved ids, or the first k of them.

    Token counts aggregate partially on the map side (a very common token costs
    one row per task). Without ``k`` the ids are ranks over buckets of the order; with ``k``
    a TakeOrderedAndProject sends only k rows per task to the final merge.
    """
    spark = df.sparkSession
    counts = df.select(explode_values(tokens_col).alias("token")).filter(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("token").asc()]
    if k is None:
        # A number that never decreases along the order: the count, then the token's first bytes as a fraction.
        head = F.rpad(F.hex(F.substring(F.encode("token", "UTF-8"), 1, 6)), 12, "0")
        fraction = F.conv(head, 16, 10).cast("double") / F.lit(float(1 << 48))
        counts = stored_once(counts, "vocabulary")
        ranked = exact_rank(counts, order, -F.col("n").cast("double") + fraction, rank_col="_rank")
    else:
        ranked = counts.orderBy(*order).limit(k).withColumn("_rank", F.row_number().over(Window.orderBy(*order)) - 1)
    ranked = ranked.select("token", (F.col("_rank") + N_RESERVED).cast("int").alias("id"), F.col("n").cast("long").alias("n"))
    specials = spark.createDataFrame([(tok, i, 0) for _, tok, i in SPECIAL_TOKENS], "token string, id int, n long")
    return stored_once(specials.unionByName(ranked), "vocabulary")  # read several times


def _flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All elements of the lists, and the n + 1 offsets of the lists among them; a null list has none."""
    return lists.flatten(), np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))])


def _lists(offsets: np.ndarray, values: pa.Array, nulls: pa.Array | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values, mask=nulls)


def _known(lists: pa.Array, keys: pa.Array, found: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The elements replaced by ``found`` at their place in ``keys`` (null where they have none), and the lists' offsets."""
    flat, offsets = _flat(lists)
    return found.take(pc.index_in(flat.cast(keys.type), value_set=keys)), offsets


def _unknown(lists: pa.Array, keys: pa.Array, found: pa.Array) -> pa.Array:
    """Of each list the elements that ``keys`` lacks, and their positions."""
    flat, offsets = _flat(lists)
    at = np.flatnonzero(pc.is_null(pc.index_in(flat.cast(keys.type), value_set=keys)).to_numpy(zero_copy_only=False))
    row = np.searchsorted(offsets, at, side="right") - 1
    cuts = np.searchsorted(at, offsets)
    pos = pa.array((at - offsets[row]).astype(np.int32))
    return pa.StructArray.from_arrays([_lists(cuts, pos), _lists(cuts, flat.take(pa.array(at)))], names=["pos", "value"])


def _patched(known: pa.Array, offsets: np.ndarray, pos: pa.Array, more: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``known`` with the lists ``more`` in place of what it lacks at the positions ``pos`` (one may come several times)."""
    at, cuts = _flat(pos)
    row = np.repeat(np.arange(len(pos)), np.diff(cuts))
    there = np.flatnonzero(pc.is_valid(known).to_numpy(zero_copy_only=False))
    places = np.concatenate([there, offsets[row] + at.to_numpy(zero_copy_only=False)])
    both = pa.concat_arrays([known.take(pa.array(there)), more.flatten().cast(known.type)])
    order = np.argsort(places, kind="stable")
    return both.take(pa.array(order)), np.searchsorted(places[order], offsets)


def _head(table: DataFrame, key: str, found: str) -> tuple[pa.Array, pa.Array, bool]:
    """Keys of one row among those with the lowest ids, what they give, and whether that is not the whole table."""
    low = (F.col("id") >= 0) & (F.col("id") < HEAD) & F.col(key).isNotNull() & F.col(found).isNotNull()
    rows = table.filter(low).select(F.col(key).alias("key"), F.col(found).alias("found")).limit(HEAD).toArrow()  # at most HEAD rows
    every = table.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    twice = [k for k, n in Counter(rows.column("key").to_pylist()).items() if n > 1]
    if every > rows.num_rows:  # a key may also have a row beyond the head
        spark = table.sparkSession
        ours = spark.createDataFrame(rows.select(["key"])).distinct()
        beyond = table.filter(~F.coalesce(low, F.lit(False))).select(F.col(key).alias("key"))
        twice += [r["key"] for r in beyond.join(F.broadcast(ours), "key", "left_semi").distinct().collect()]
    if twice:
        rows = rows.filter(pc.invert(pc.is_in(rows.column("key"), value_set=pa.array(twice, rows.column("key").type))))
    return rows.column("key").combine_chunks(), rows.column("found").combine_chunks(), every > rows.num_rows


def _looked_up(df: DataFrame, table: DataFrame, values_col: str, key: str, found: str, missing, out: str, id_col: str, ids_source: DataFrame | None = None) -> DataFrame:
    """Each element of an array replaced by ``found`` of the row of ``table`` whose ``key`` equals it.

    The ``HEAD`` rows of the lowest ids (the most frequent tokens, so nearly all elements) reach every task, which replaces
    them in place. Only elements that these lack are joined with the whole ``table``, gathered by the caller's unique ``id_col`` and put
    in their places; ids travel for that, not strings. A null array gives null, an empty one an empty one.

    Of rows that share an id each gets the elements of all of them, by position; rows of no id get none.
    ``ids_source``: a cheaper frame with the ids of ``df``, which says whether ids are shared."""
    spark = df.sparkSession
    bounded_batches(spark)
    kind = {"int": "int", "bigint": "long"}.get(dict(table.dtypes)[found], dict(table.dtypes)[found])
    of = dict(df.dtypes)[values_col].removeprefix("array<").removesuffix(">")
    keys, values, more = _head(table, key, found)
    sent = spark.sparkContext.broadcast((keys, values, None if missing is None else pa.scalar(missing, values.type)))

    def replace(lists: pa.Array) -> pa.Array:
        got, offsets = _known(lists, *sent.value[:2])
        # Where more is to come, what is missing stays null for now.
        return _lists(offsets, got if more or sent.value[2] is None else got.fill_null(sent.value[2]), lists.is_null())

    def unknown(lists: pa.Array) -> pa.Array:
        return _unknown(lists, *sent.value[:2])

    def complete(lists: pa.Array, pos: pa.Array, rest: pa.Array) -> pa.Array:
        got, offsets = _flat(lists) if first else _known(lists, *sent.value[:2])
        got, offsets = _patched(got, offsets, pos, rest)
        return _lists(offsets, got if sent.value[2] is None else got.fill_null(sent.value[2]), lists.is_null())

    if not more:
        looked = df.withColumn("_values", F.arrow_udf(replace, f"array<{kind}>")(F.col(values_col)))
    else:
        first = kind != "string"
        each = df.select(F.col(id_col).alias("_row"), F.arrow_udf(unknown, f"struct<pos: array<int>, value: array<{of}>>")(F.col(values_col)).alias("_u"))
        each = each.filter(F.col("_row").isNotNull()).select("_row", explode_values(F.arrays_zip("_u.pos", "_u.value")).alias("_e")).filter(F.col("_e").isNotNull()).select("_row", F.col("_e.pos").alias("_pos"), F.col("_e.value").alias("_value"))
        met = each.join(table.select(F.col(key).alias("_key"), F.col(found).alias("_found")), F.col("_value") == F.col("_key"), "left")
        rest = met.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_pos", "_found"))).alias("_all"))
        rest = rest.select("_row", F.col("_all._pos").alias("_at"), F.col("_all._found").alias("_more"))
        carried = df.withColumn("_carried", F.arrow_udf(replace, f"array<{kind}>")(F.col(values_col)) if first else F.col(values_col))
        joined = carried.join(rest, F.col(id_col) == F.col("_row"), "left")
        looked = joined.withColumn("_values", F.arrow_udf(complete, f"array<{kind}>")("_carried", "_at", "_more")).drop("_row", "_carried", "_at", "_more")
    ids = df.select(id_col) if ids_source is None else ids_source.select(id_col)
    shared = stored_once(ids.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select(F.col(id_col).alias("_shared")), "lookup-shared")
    value = F.when(F.col(id_col).isNull(), F.slice("_values", 1, 0)).otherwise(F.col("_values"))
    if not shared.isEmpty():
        own = df.join(shared, F.col(id_col) == F.col("_shared"), "left_semi").select(F.col(id_col).alias("_row"), F.posexplode(values_col).alias("_pos", "_value"))
        own = own.join(table.select(F.col(key).alias("_key"), F.col(found).alias("_found")), F.col("_value") == F.col("_key"), "left")
        element = F.col("_found") if missing is None else F.coalesce("_found", F.lit(missing))
        own = own.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_pos", element.alias("_found")))).alias("_all")).select("_row", F.col("_all._found").alias("_together"))
        looked = looked.join(own, F.col(id_col) == F.col("_row"), "left").drop("_row")
        value = F.when(F.col("_values").isNotNull() & F.col("_together").isNotNull(), F.col("_together")).otherwise(value)
    return looked.withColumn(out, value).drop("_values", "_together")


def encode(df: DataFrame, vocab: DataFrame, tokens_col: str = "tokens", out: str = "input_ids", id_col: str = "row_id", ids_source: DataFrame | None = None) -> DataFrame:
    """Token strings -> ids (unknown -> unk), order kept; ``id_col`` must be unique."""
    return _looked_up(df, vocab, tokens_col, "token", "id", UNK_ID, out, id_col, ids_source)


def ids_to_tokens(df: DataFrame, vocab: DataFrame, ids_col: str = "input_ids", out: str = "id_tokens", id_col: str = "row_id", ids_source: DataFrame | None = None) -> DataFrame:
    """Ids -> token strings (an id that the vocabulary lacks -> null)."""
    return _looked_up(df, vocab, ids_col, "id", "token", None, out, id_col, ids_source)


def decode(df: DataFrame, vocab: DataFrame, ids_col: str = "input_ids", out: str = "decoded", skip_special_tokens: bool = True, id_col: str = "row_id", ids_source: DataFrame | None = None) -> DataFrame:
    """E5: ids -> text (tokens joined by one space); reserved ids dropped when asked."""
    ids = F.col(ids_col)
    if skip_special_tokens:
        ids = F.filter(ids, lambda x: x >= F.lit(N_RESERVED))
    tmp = df.withColumn("_ids", ids)
    return ids_to_tokens(tmp, vocab, "_ids", "_toks", id_col, ids_source).withColumn(out, F.array_join("_toks", " ")).drop("_ids", "_toks")


def special_tokens(vocab: DataFrame) -> DataFrame:
    """The reserved tokens and the vocabulary size; pad falls back to eos when absent."""
    # one-row frames are attached with an equi-join on a constant key (no cross join)
    size = vocab.agg(F.count(F.lit(1)).alias("vocab_size")).withColumn("_one", F.lit(1))
    roles = vocab.filter(F.col("id") < N_RESERVED)
    eos = roles.filter(F.col("id") == EOS_ID).select(F.col("token").alias("_eos_tok"), F.col("id").alias("_eos_id"), F.lit(1).alias("_one"))
    names = vocab.sparkSession.createDataFrame([(name, i, 1) for name, _, i in SPECIAL_TOKENS], "name string, want int, _one int")
    out = names.join(roles, names.want == roles.id, "left").join(F.broadcast(eos), "_one", "left")
    fallback = F.col("name") == "pad"
    out = out.select(
        "name",
        "_one",
        F.when(F.col("token").isNull() & fallback, F.col("_eos_tok")).otherwise(F.col("token")).alias("token"),
        F.when(F.col("id").isNull() & fallback, F.col("_eos_id")).otherwise(F.col("id")).alias("id"),
    )
    return out.join(F.broadcast(size), "_one", "left").drop("_one")


def token_stats(df: DataFrame, text_col: str = "text", group_cols=("lang",)) -> DataFrame:
    """Tokens per text and tokens per whitespace word ("fertility") per group."""
    x = df.select(*group_cols, F.size(tokenize_col(text_col)).alias("_t"), F.size(split_ws(text_col)).alias("_w"))
    return x.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum("_t").alias("n_tokens"),
        F.sum("_w").alias("n_words"),
        (F.sum("_t") / F.sum("_w")).alias("fertility"),
        F.avg("_t").alias("mean_tokens"),
    )


def truncate(df: DataFrame, ids_col: str = "input_ids", max_length: int = 512, out: str | None = None) -> DataFrame:
    """Keep the first max_length ids."""
    return df.withColumn(out or ids_col, F.slice(ids_col, 1, max_length))


def pad(df: DataFrame, ids_col: str = "input_ids", batch_col: str = "batch_id", pad_id: int = PAD_ID, side: str = "right") -> DataFrame:
    """Pad each row to its batch's longest row; attention mask 1 for real, 0 for pad.

    The window is partitioned by batch, and a batch is bounded by the batch size.
    """
    L = F.max(F.size(ids_col)).over(Window.partitionBy(batch_col))
    x = df.withColumn("_L", L).withColumn("_k", F.col("_L") - F.size(ids_col))
    fill = F.array_repeat(F.lit(pad_id), F.col("_k"))
    ones = F.array_repeat(F.lit(1), F.size(ids_col))
    zeros = F.array_repeat(F.lit(0), F.col("_k"))
    if side == "right":
        ids, mask = F.concat(F.col(ids_col), fill), F.concat(ones, zeros)
    else:
        ids, mask = F.concat(fill, F.col(ids_col)), F.concat(zeros, ones)
    return x.withColumns({ids_col: ids, "attention_mask": mask}).withColumnRenamed("_L", "padded_length").drop("_k")


def causal_labels(df: DataFrame, ids_col: str = "input_ids", mask_col: str = "attention_mask", out: str = "labels") -> DataFrame:
    """labels = ids, -100 where the attention mask is 0."""
    return df.withColumn(out, F.zip_with(ids_col, mask_col, lambda x, m: F.when(m == 0, F.lit(IGNORE_INDEX)).otherwise(x)))


def collator_labels(df: DataFrame, ids_col: str = "input_ids", pad_id: int = PAD_ID, out: str = "labels") -> DataFrame:
    """The collator's rule — -100 wherever id == pad id (also masks a real EOS when pad == eos)."""
    return df.withColumn(out, F.transform(ids_col, lambda x: F.when(x == F.lit(pad_id), F.lit(IGNORE_INDEX)).otherwise(x)))


def completion_tokens(df: DataFrame, template, messages_col: str = "messages") -> DataFrame:
    """E12, first half: tokens of the rendered conversation and a 0/1 "trainable" mask.

    Per message: the role header is never trained on; content and end marker are
    trained on only for assistant messages. Tokenizing the pieces separately
    equals tokenizing the rendered text, because every header/suffix boundary
    falls on whitespace or a punctuation token.
    """
    def piece(m):
        head = tokenize_col(template.prefix_of(m["role"]))
        body = F.concat(tokenize_col(m["content"]), tokenize_col(template.suffix_of(m["role"])))
        return head, body

    toks = F.flatten(F.transform(messages_col, lambda m: F.concat(*piece(m))))
    mask = F.flatten(
        F.transform(
            messages_col,
            lambda m: F.concat(
                F.array_repeat(F.lit(0), F.size(piece(m)[0])),
                F.array_repeat(F.when(m["role"] == "assistant", F.lit(1)).otherwise(F.lit(0)), F.size(piece(m)[1])),
            ),
        )
    )
    return df.withColumn("tokens", toks).withColumn("train_mask", mask)


def completion_labels(df: DataFrame, vocab: DataFrame, template, messages_col: str = "messages", id_col: str = "conv_id") -> DataFrame:
    """-100 on every token outside an assistant reply (multi-turn safe)."""
    t = encode(completion_tokens(df, template, messages_col), vocab, "tokens", "input_ids", id_col)
    return t.withColumn(
        "labels", F.zip_with("input_ids", "train_mask", lambda x, m: F.when(m == 1, x).otherwise(F.lit(IGNORE_INDEX)))
    )


def _neighbours(lists: pa.Array) -> pa.Table:
    """Each element of a list with the next one."""
    flat, offsets = _flat(lists)
    last = np.zeros(len(flat), bool)
    last[offsets[1:][np.diff(offsets) > 0] - 1] = True
    at = np.flatnonzero(~last)
    return pa.table({"context_id": flat.take(pa.array(at)), "next_id": flat.take(pa.array(at + 1))})


def _pair_counts(batches):
    """Counts of the pairs in every ``PAIRS`` pairs or a few more, in the order of the pairs (which shuffles to fewer bytes)."""

    def counted() -> list[pa.RecordBatch]:
        got = pa.concat_tables(held).group_by(["context_id", "next_id"], use_threads=False).aggregate([([], "count_all")])
        got = got.sort_by([("context_id", "ascending"), ("next_id", "ascending")]).combine_chunks()
        return got.rename_columns(["context_id", "next_id", "n"]).to_batches(max_chunksize=1 << 16)

    held, n = [], 0
    for batch in batches:
        held.append(_neighbours(batch.column(0)))
        n += len(held[-1])
        if n >= PAIRS:
            yield from counted()
            held, n = [], 0
    if n:
        yield from counted()


def next_token_pairs(df: DataFrame, ids_col: str = "input_ids") -> DataFrame:
    """(context id, next id) counts — the label at t is the input at t + 1.

    Tasks count ``PAIRS`` pairs at a time, so their memory doesn't grow with the pairs they meet and nothing is
    spilled for it; the counts are dealt out by pair and added up. Most pairs are rare, so little more is sent than by a whole task's counts."""
    bounded_batches(df.sparkSession)
    kind = df.schema[ids_col].dataType.elementType.simpleString()
    counts = df.select(ids_col).mapInArrow(_pair_counts, f"context_id {kind}, next_id {kind}, n long")
    # Dealt out first: else each task would add up its counts once more, in memory that grows with its pairs.
    dealt = counts.repartition(default_parallelism(df.sparkSession), "context_id", "next_id")
    return dealt.groupBy("context_id", "next_id").agg(F.sum("n").alias("n"))
