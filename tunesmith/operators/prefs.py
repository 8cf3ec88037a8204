"""Preference data (J-group): validation, splits, truncation, DPO/ORPO metrics from
log-probabilities, unpairing, verifiable rewards, distillation and rank-to-pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.operators.clean import dedupe_exact
from tunesmith.operators.evals import normalize_answer
from tunesmith.operators.splits import group_split, split_two_way


def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != F.lit(""))


def validate_preferences(df: DataFrame, order_col: str = "row_id") -> DataFrame:
    """Non-empty triple, chosen != rejected, exact dedupe on the triple (first row wins)."""
    ok = df.filter(_present("prompt") & _present("chosen") & _present("rejected") & (F.col("chosen") != F.col("rejected")))
    return dedupe_exact(ok, order_col, key_cols=("prompt", "chosen", "rejected"))


def preference_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42, by_prompt: bool = False) -> DataFrame:
    """0.2 test split; ``by_prompt`` keeps every pair of one prompt in one split."""
    if by_prompt:
        return group_split(df, "prompt", val_fraction=0.0, test_fraction=test_fraction, seed=seed)
    return split_two_way(df, test_fraction=test_fraction, seed=seed)


def preference_truncate(df: DataFrame, max_length: int = 512, max_prompt_length: int | None = None, prompt="prompt_ids", completions=("chosen_ids", "rejected_ids")) -> DataFrame:
    """The prompt keeps its *last* max_prompt_length tokens (default max_length // 2),
    each completion its first max_length - len(prompt) tokens."""
    mp = max_prompt_length if max_prompt_length is not None else max_length // 2
    p = F.col(prompt)
    kept = F.slice(p, F.greatest(F.size(p) - mp, F.lit(0)) + 1, mp)
    out = df.withColumn(prompt, kept)
    room = F.greatest(F.lit(max_length) - F.size(prompt), F.lit(0))
    return out.withColumns({c: F.slice(c, 1, room) for c in completions})


def softplus(x: Column) -> Column:
    """log(1 + exp(x)) without overflow."""
    return F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))


def dpo_rows(df: DataFrame, beta: float = 0.1) -> DataFrame:
    margin = (F.col("pi_chosen") - F.col("ref_chosen")) - (F.col("pi_rejected") - F.col("ref_rejected"))
    return df.withColumns(
        {
            "margin": margin,
            "reward_chosen": F.lit(beta) * (F.col("pi_chosen") - F.col("ref_chosen")),
            "reward_rejected": F.lit(beta) * (F.col("pi_rejected") - F.col("ref_rejected")),
            "loss": softplus(-F.lit(beta) * margin),
        }
    )


def dpo_metrics(df: DataFrame, beta: float = 0.1) -> DataFrame:
    """Loss -log sigmoid(beta * margin), accuracy (margin > 0) and reward means."""
    r = dpo_rows(df, beta)
    return r.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("loss").alias("loss"),
        F.avg((F.col("margin") > 0).cast("double")).alias("accuracy"),
        F.avg(F.col("reward_chosen") - F.col("reward_rejected")).alias("reward_margin"),
        F.avg("reward_chosen").alias("reward_chosen"),
        F.avg("reward_rejected").alias("reward_rejected"),
    )


def orpo_metrics(df: DataFrame, lam: float = 0.1, n_col: str = "n_tokens") -> DataFrame:
    """No reference model. On mean token log-probabilities m = logp / n:
    log odds(m) = m - log(1 - exp(m)); loss = -m_chosen + lam * -log sigmoid(odds ratio).

    The odds of a mean that isn't below 0 are undefined: such rows count in ``n`` and ``n_invalid``,
    and the means are over the others."""
    mc = F.col("pi_chosen") / F.col(n_col)
    mr = F.col("pi_rejected") / F.col(n_col)

    def log_odds(m):
        return m - F.log1p(-F.exp(m))

    ratio = log_odds(mc) - log_odds(mr)
    valid = F.coalesce((mc < 0) & (mr < 0), F.lit(False))
    ratio = F.when(valid, ratio)
    r = df.select(valid.alias("valid"), F.when(valid, -mc).alias("nll_chosen"), softplus(-ratio).alias("or_loss"), ratio.alias("log_odds_ratio"))
    return r.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("valid")).alias("n_invalid"),
        F.avg("nll_chosen").alias("nll_chosen"),
        F.avg("or_loss").alias("or_loss"),
        F.avg(F.col("nll_chosen") + F.lit(lam) * F.col("or_loss")).alias("loss"),
        F.avg((F.col("log_odds_ratio") > 0).cast("double")).alias("accuracy"),
    )


def unpair_preferences(df: DataFrame) -> DataFrame:
    """Triples -> unpaired (prompt, completion, label) rows for thumbs-up/down methods."""
    return df.selectExpr("row_id", "prompt", "stack(2, chosen, true, rejected, false) AS (completion, label)")


def final_answer(c) -> Column:
    """The last non-empty line of a text (the whole text when it has one line)."""
    lines = F.filter(F.split(F.col(c) if isinstance(c, str) else c, "\n"), lambda x: F.trim(x) != "")
    return F.coalesce(F.try_element_at(lines, F.lit(-1)), F.lit(""))


def verifiable_reward(samples: DataFrame, prompt_key: str = "row_id", answer="answer", reference="reference") -> DataFrame:
    """Reward 1.0 when the extracted final answer matches exactly; mean per prompt."""
    r = samples.withColumn("reward", (normalize_answer(final_answer(answer)) == normalize_answer(final_answer(reference))).cast("double"))
    return r.groupBy(prompt_key).agg(F.count(F.lit(1)).alias("n_samples"), F.avg("reward").alias("mean_reward"))


def distillation_rows(prompts: DataFrame, teacher: DataFrame, key=("conv_id", "turn")) -> DataFrame:
    """Teacher outputs joined to prompts become instruction rows (then cleaned and
    deduplicated); prompts without a teacher output are returned with status 'missing', and
    those whose row cleaning drops with status 'rejected' (rows that repeat an earlier one go)."""
    from tunesmith.operators.clean import clean_rows, drop_reason

    keys = list(key)
    j = prompts.join(teacher, keys, "left")
    have = j.filter(F.col("output").isNotNull()).drop("status")
    rows = dedupe_exact(clean_rows(have)).withColumn("status", F.lit("ok"))
    rejected = have.filter(drop_reason() != "kept").withColumn("status", F.lit("rejected"))
    rows = rows.unionByName(rejected, allowMissingColumns=True)
    missing = j.filter(F.col("output").isNull()).drop("output").withColumn("output", F.lit(None).cast("string")).withColumn("status", F.lit("missing"))
    if "input" not in missing.columns:
        missing = missing.withColumn("input", F.lit(""))
    return rows.unionByName(missing, allowMissingColumns=True)


def rank_to_pairs(scored: DataFrame, prompt_key: str = "row_id", score_col: str = "judge", answer_key: str = "model") -> DataFrame:
    """Best-scored answer per prompt as chosen, worst as rejected; prompts whose
    answers all tie are dropped. max_by/min_by aggregate partially per prompt."""
    k = F.struct(F.col(score_col), F.col(answer_key))
    g = scored.groupBy(prompt_key).agg(
        F.max_by(F.struct(score_col, answer_key, "answer"), k).alias("_best"),
        F.min_by(F.struct(score_col, answer_key, "answer"), k).alias("_worst"),
    )
    g = g.filter(F.col("_best")[score_col] > F.col("_worst")[score_col])
    return g.select(
        prompt_key,
        F.col("_best")[answer_key].alias("chosen_model"),
        F.col("_worst")[answer_key].alias("rejected_model"),
        F.col("_best")[score_col].alias("chosen_score"),
        F.col("_worst")[score_col].alias("rejected_score"),
        F.col("_best")["answer"].alias("chosen"),
        F.col("_worst")["answer"].alias("rejected"),
    )
