"""Cleaning and exact deduplication (B- and C1/C2-groups)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunesmith.functions.text import tokenize, ustrip
from tunesmith.plans.ranks import exact_percentile

REQUIRED_FIELDS = ("instruction", "output")
DEDUPE_SEPARATOR = "||"


def _present(c: str):
    return F.col(c).isNotNull() & (F.col(c) != F.lit(""))


def require_fields(df: DataFrame, fields=REQUIRED_FIELDS) -> DataFrame:
    """B1: required fields non-null and non-empty, tested *before* trimming."""
    cond = F.lit(True)
    for f in fields:
        cond = cond & _present(f)
    return df.filter(cond)


def output_length_filter(df: DataFrame, min_chars: int = 1, max_chars: int = 8000) -> DataFrame:
    """B2: min <= len(strip(output)) <= max, both ends inclusive (code points)."""
    return df.filter(F.length(ustrip("output")).between(min_chars, max_chars))


def trim_fields(df: DataFrame) -> DataFrame:
    """Strip instruction/input/output; null input -> ""; other columns untouched."""
    return df.withColumns(
        {
            "instruction": ustrip("instruction"),
            "input": ustrip(F.coalesce(F.col("input"), F.lit(""))),
            "output": ustrip("output"),
        }
    )


def clean_rows(df: DataFrame, min_output_chars: int = 1, max_output_chars: int = 8000) -> DataFrame:
    """B1 -> B2 -> B3 in one narrow stage (no shuffle)."""
    if "input" not in df.columns:
        df = df.withColumn("input", F.lit(None).cast("string"))
    return trim_fields(output_length_filter(require_fields(df), min_output_chars, max_output_chars))


def drop_reason(min_output_chars: int = 1, max_output_chars: int = 8000):
    n = F.length(ustrip("output"))
    missing = ~(_present("instruction") & _present("output"))
    return (
        F.when(missing, F.lit("missing_field"))
        .when(n < min_output_chars, F.lit("too_short"))
        .when(n > max_output_chars, F.lit("too_long"))
        .otherwise(F.lit("kept"))
    )


def clean_report(df: DataFrame, min_output_chars: int = 1, max_output_chars: int = 8000) -> DataFrame:
    """Rows kept and dropped, one reason per dropped row."""
    return (
        df.select(drop_reason(min_output_chars, max_output_chars).alias("reason"))
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def clean_rows_observed(df: DataFrame, min_output_chars: int = 1, max_output_chars: int = 8000):
    """B4 + B5 in one pass: returns (cleaned rows, Observation). The kept/dropped counts
    are gathered by ``df.observe`` while the pipeline runs; read ``obs.get`` after the
    first action on the returned frame (no second pass over the input)."""
    from pyspark.sql import Observation

    if "input" not in df.columns:
        df = df.withColumn("input", F.lit(None).cast("string"))
    obs = Observation("clean_report")
    reason = drop_reason(min_output_chars, max_output_chars)
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(reason == "kept").alias("kept"),
        F.count_if(reason == "missing_field").alias("missing_field"),
        F.count_if(reason == "too_short").alias("too_short"),
        F.count_if(reason == "too_long").alias("too_long"),
    )
    return clean_rows(observed, min_output_chars, max_output_chars), obs


def length_outlier_filter(df: DataFrame, length_col: str, group_cols=(), lo: float = 0.01, hi: float = 0.99) -> DataFrame:
    """Drop rows whose length lies outside the per-group [lo, hi] percentiles.

    The bounds come from counts by length, so no task holds a group's lengths. They are one row per group
    (a null group is one, too) and are joined back; AQE broadcasts them once it has measured them.
    """
    keys = list(group_cols) or ["_all"]
    rows = df if group_cols else df.withColumn("_all", F.lit(1))
    low, high = (exact_percentile(rows, keys, length_col, q, name, resolution=1.0) for q, name in ((lo, "_lo"), (hi, "_hi")))
    both = low.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_lo").join(high.select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)], "_hi"), [F.col(f"_g{i}").eqNullSafe(F.col(f"_h{i}")) for i in range(len(keys))])
    same = [F.col(k).eqNullSafe(F.col(f"_g{i}")) for i, k in enumerate(keys)]
    joined = rows.join(both.select(*[f"_g{i}" for i in range(len(keys))], F.array("_lo", "_hi").alias("_b")), same)
    joined = joined.drop("_all", *[f"_g{i}" for i in range(len(keys))])
    return joined.filter(F.col(length_col).between(F.col("_b")[0], F.col("_b")[1])).drop("_b")


def format_lint(df: DataFrame, template, text_col: str = "text", other_markers=()) -> DataFrame:
    """Per-row flags for template problems."""
    t = F.col(text_col)
    first_prefix = template.prefix.get("user", "")
    flags = {
        "missing_markers": ~t.contains(first_prefix) if first_prefix else F.lit(False),
        "no_eos": ~t.endswith(template.eos) if template.eos else F.lit(False),
        "foreign_markers": F.lit(False),
    }
    for m in other_markers:
        flags["foreign_markers"] = flags["foreign_markers"] | t.contains(m)
    return df.withColumns(flags)


def format_lint_report(flagged: DataFrame) -> DataFrame:
    return flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("missing_markers").alias("n_missing_markers"),
        F.count_if("no_eos").alias("n_no_eos"),
        F.count_if("foreign_markers").alias("n_foreign_markers"),
    )


def drop_columns(df: DataFrame, keep) -> DataFrame:
    """Keep only the new columns; Catalyst prunes the rest from the scan."""
    return df.select(*keep)


def preview(df: DataFrame, question_col: str = "question", answer_cols=("reference", "answer")) -> DataFrame:
    """First 60 characters of the question, first 80 of each answer."""
    out = df.withColumn(f"{question_col}_preview", F.substring(question_col, 1, 60))
    for c in answer_cols:
        out = out.withColumn(f"{c}_preview", F.substring(c, 1, 80))
    return out


def dedupe_key(df_cols=("instruction", "input", "output")):
    """sha256 of the fields joined with '||' (built after trimming, nulls as "")."""
    parts = [F.coalesce(F.col(c), F.lit("")) for c in df_cols]
    return F.sha2(F.concat_ws(DEDUPE_SEPARATOR, *parts), 256)


def dedupe_exact(df: DataFrame, order_col: str = "row_id", key_cols=("instruction", "input", "output")) -> DataFrame:
    """The first row (lowest ``order_col``) of each key survives.

    ``min_by`` over a struct of the row aggregates partially on the map side, so
    a key holding a third of all rows still shuffles one row per map task. Rows without
    an id come after those with one; of several without, any one survives.
    """
    cols = df.columns
    keyed = df.withColumn("_key", dedupe_key(key_cols))
    survivors = keyed.groupBy("_key").agg(F.min_by(F.struct(*cols), F.struct(F.col(order_col).isNull(), F.col(order_col))).alias("_r"))
    return survivors.select("_r.*")


def dedupe_report(df: DataFrame, key_cols=("instruction", "input", "output")) -> DataFrame:
    """Rows before, unique keys, duplicate groups and the largest group."""
    groups = df.groupBy(dedupe_key(key_cols).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_unique"),
        F.count_if(F.col("_n") > 1).alias("n_duplicate_groups"),
        F.max("_n").alias("largest_group"),
    )


def with_token_length(df: DataFrame, text_col: str = "text", out: str = "n_tokens") -> DataFrame:
    return df.withColumn(out, F.size(tokenize(text_col)).cast("long"))


__all__ = [name for name in dir() if not name.startswith("_") and name not in ("DataFrame", "Window", "F")]
