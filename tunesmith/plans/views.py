"""How the driver's tables play the fine-tuning inputs (Spark side).

Each view is a lazy projection over the parquet tables; nothing is materialised.
The DuckDB twins of these views live in ``tunesmith.plans.sqlviews``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.sources.io import scan_parquet


def instr_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> instruction rows: instruction = text before the first newline,
    output = text after it ("" if none), input = "", row_id = doc_id."""
    d = scan_parquet(spark, sf_dir, "documents")
    pos = F.instr("text", "\n")
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.when(pos > 0, F.expr("substring(text, 1, instr(text, '\\n') - 1)")).otherwise(F.col("text")).alias("instruction"),
        F.lit("").alias("input"),
        F.when(pos > 0, F.expr("substring(text, instr(text, '\\n') + 1)")).otherwise(F.lit("")).alias("output"),
        "lang",
        "source",
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, sf_dir, "conversations")


def chat_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns with a time: a minute apart within a conversation, whose start depends on its id."""
    start = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, pmod(conv_id, 7200))")
    return turns(spark, sf_dir).withColumn("ts", start + F.expr("make_dt_interval(0, 0, cast(turn AS int), 0)"))


def instr_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user turn directly followed by an assistant turn -> instruction row."""
    from tunesmith.operators.chat import turns_to_instructions

    return turns_to_instructions(turns(spark, sf_dir)).withColumn("row_id", F.col("row_id").cast("long"))


def _edited_answer(output_col: str = "output", id_col: str = "row_id"):
    """Deterministic edit used to make predictions/rejected answers from references:
    id % 7 = 0 -> ""; id % 5 = 0 -> lower-cased + " !"; else every 4th space-separated word removed.
    (lower, not upper: Java upper-cases "ß" to "SS", other engines to "ẞ".)"""
    words = F.split(F.col(output_col), " ")
    kept = F.array_join(F.filter(words, lambda x, i: (i + 1) % 4 != 0), " ")
    return (
        F.when(F.col(id_col) % 7 == 0, F.lit(""))
        .when(F.col(id_col) % 5 == 0, F.concat(F.lower(F.col(output_col)), F.lit(" !")))
        .otherwise(kept)
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, question, reference, answer) — the model's answer is a deterministic edit."""
    t = instr_turns(spark, sf_dir)
    return t.select(
        "row_id",
        F.col("instruction").alias("question"),
        F.col("output").alias("reference"),
        _edited_answer().alias("answer"),
    )


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = instr_turns(spark, sf_dir)
    return t.select(
        "row_id",
        F.col("instruction").alias("prompt"),
        F.col("output").alias("chosen"),
        _edited_answer().alias("rejected"),
    )


def logprobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four summed log-probabilities per preference row, derived from events.value."""
    e = scan_parquet(spark, sf_dir, "events")
    v = F.col("value")
    i = F.col("event_id")
    return e.select(
        i.alias("row_id"),
        (-(v / 10.0)).alias("pi_chosen"),
        (-((v + i % 13) / 10.0)).alias("pi_rejected"),
        (-((v + i % 5) / 10.0)).alias("ref_chosen"),
        (-((v + i % 3) / 10.0)).alias("ref_rejected"),
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("n_tokens"),
    )


def scored_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, nll, n_tokens): a per-text mean NLL and its token count."""
    e = scan_parquet(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("row_id"),
        (F.col("value") / 20.0).alias("nll"),
        (F.get_json_object("props", "$.k").cast("long") + 1).alias("n_tokens"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Serving log: ts, user_id, adapter (= event_type), latency, tokens, ok."""
    e = scan_parquet(spark, sf_dir, "events")
    return e.select(
        "event_id",
        "ts",
        "user_id",
        F.col("event_type").alias("adapter"),
        F.col("value").alias("latency"),
        F.get_json_object("props", "$.k").cast("long").alias("tokens"),
        (F.col("event_type") != F.lit("error")).alias("ok"),
    )


def candidate_answer(output_col: str = "output", id_col: str = "row_id"):
    """A second deterministic 'model': id % 3 = 0 -> ""; else every other word kept."""
    words = F.split(F.col(output_col), " ")
    return F.when(F.col(id_col) % 3 == 0, F.lit("")).otherwise(F.array_join(F.filter(words, lambda x, i: i % 2 == 0), " "))


def two_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, row_id, question, reference, answer) for a baseline and a candidate model."""
    t = instr_turns(spark, sf_dir)
    # Both models from one pass over the turns.
    answers = F.array(
        F.struct(F.lit("baseline").alias("model"), _edited_answer().alias("answer")),
        F.struct(F.lit("candidate").alias("model"), candidate_answer().alias("answer")),
    )
    both = t.select("row_id", F.col("instruction").alias("question"), F.col("output").alias("reference"), F.inline(answers))
    return both.select("model", "row_id", "question", "reference", "answer")


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge replies derived from conversations: some rows carry a score-like reply."""
    c = turns(spark, sf_dir)
    reply = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Score: "), (F.col("conv_id") % 12).cast("string"), F.lit("/5"))).otherwise(F.col("text"))
    return c.select("conv_id", "turn", reply.alias("reply"))
