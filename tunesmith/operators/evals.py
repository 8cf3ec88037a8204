"""Evaluation scoring (I-group): per-row metric expressions, table-level comparisons,
n-gram language-model perplexity and benchmark contamination."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunesmith.functions.text import col_, explode_values, normalize_answer, split_ws, tokenize, ustrip, word_ngrams


def answer_words(c) -> Column:
    return split_ws(normalize_answer(c))


def exact_match(pred, ref) -> Column:
    """1.0 when the normalized strings are equal."""
    return (normalize_answer(pred) == normalize_answer(ref)).cast("double")


def multiset_overlap(p: Column, r: Column) -> Column:
    """Size of the multiset intersection of two word arrays (pass array *columns*:
    Spark re-evaluates a lambda's captured expressions on every call)."""
    return F.aggregate(
        F.array_distinct(p),
        F.lit(0),
        lambda acc, t: acc + F.least(F.size(F.filter(p, lambda x: x == t)), F.size(F.filter(r, lambda x: x == t))),
    )


def f1_from_words(p: Column, r: Column) -> Column:
    """I3 on word-array columns."""
    ov = multiset_overlap(p, r)
    prec = F.try_divide(ov, F.size(p))
    rec = F.try_divide(ov, F.size(r))
    return (
        F.when((F.size(p) == 0) | (F.size(r) == 0), (F.size(p) == F.size(r)).cast("double"))
        .when(ov == 0, F.lit(0.0))
        .otherwise(2 * prec * rec / (prec + rec))
    )


def with_token_f1(df: DataFrame, pred: str, ref: str, out: str = "f1", key: str | None = None) -> DataFrame:
    """Multiset word-overlap F1; when either side is empty, 1.0 only if both are.

    With a unique ``key`` the multiset overlap is computed as a join of per-(key,
    word) counts — linear in text length, groups bounded by one row's words —
    instead of a per-word scan of both arrays inside a lambda (quadratic, fine
    only for short answers).
    """
    x = df.withColumns({"_p": answer_words(pred), "_r": answer_words(ref)})
    if key is None:
        return x.withColumn(out, f1_from_words(F.col("_p"), F.col("_r"))).drop("_p", "_r")

    # Words of both sides counted in one pass, told apart by a flag.
    def sided(words: str, side: int) -> Column:
        return F.transform(words, lambda w: F.struct(F.lit(side).alias("side"), w.alias("word")))

    each = x.select(key, explode_values(F.concat(sided("_p", 0), sided("_r", 1))).alias("_w")).filter(F.col("_w").isNotNull())
    held = each.groupBy(key, F.col("_w.word").alias("_word")).agg(F.count_if(F.col("_w.side") == 0).alias("_cp"), F.count_if(F.col("_w.side") == 1).alias("_cr"))
    ov = held.groupBy(key).agg(F.sum(F.least("_cp", "_cr")).alias("_ov"))
    y = x.join(ov, key, "left").withColumn("_ov", F.coalesce(F.col("_ov"), F.lit(0)))
    np_, nr = F.size("_p"), F.size("_r")
    prec = F.try_divide(F.col("_ov"), np_)
    rec = F.try_divide(F.col("_ov"), nr)
    f1 = F.when((np_ == 0) | (nr == 0), (np_ == nr).cast("double")).when(F.col("_ov") == 0, F.lit(0.0)).otherwise(2 * prec * rec / (prec + rec))
    return y.withColumn(out, f1).drop("_p", "_r", "_ov")


def token_f1(pred, ref) -> Column:
    """I3 as one Column (fine for short answers; ``with_token_f1`` for long texts)."""
    return f1_from_words(answer_words(pred), answer_words(ref))


def judge_from_sets(answer_blank: Column, ref: Column, ans: Column) -> Column:
    overlap = F.try_divide(F.size(F.array_intersect(ref, ans)), F.size(ref))
    return (
        F.when(answer_blank, F.lit(1))
        .when(F.size(ref) == 0, F.lit(3))
        .when(overlap >= F.lit(0.6), F.lit(5))
        .when(overlap >= F.lit(0.3), F.lit(4))
        .when(overlap >= F.lit(0.1), F.lit(3))
        .otherwise(F.lit(2))
    )


def heuristic_judge(question, reference, answer) -> Column:
    """I4: blank answer -> 1 (tested first); empty reference -> 3; else share of the
    reference's distinct lower-cased words found in the answer: >=.6 5, >=.3 4, >=.1 3, else 2."""
    ref = F.array_distinct(split_ws(F.lower(col_(reference))))
    ans = F.array_distinct(split_ws(F.lower(col_(answer))))
    return judge_from_sets(F.length(ustrip(answer)) == 0, ref, ans)


def with_heuristic_judge(df: DataFrame, reference: str = "reference", answer: str = "answer", out: str = "judge") -> DataFrame:
    x = df.withColumns(
        {"_rs": F.array_distinct(split_ws(F.lower(F.col(reference)))), "_as": F.array_distinct(split_ws(F.lower(F.col(answer))))}
    )
    return x.withColumn(out, judge_from_sets(F.length(ustrip(answer)) == 0, F.col("_rs"), F.col("_as"))).drop("_rs", "_as")


def parse_judge_reply(reply) -> Column:
    """First ASCII digit of the reply clamped to 1..5; no digit -> 3 ("10" -> 1)."""
    d = F.regexp_extract(col_(reply), "[0-9]", 0)
    return F.when(d == "", F.lit(3)).otherwise(F.least(F.lit(5), F.greatest(F.lit(1), d.cast("int"))))


def score_table(df: DataFrame, question="question", reference="reference", answer="answer", key: str | None = None) -> DataFrame:
    """One row per example — previews, EM, F1 and the heuristic judge.
    Pass a unique ``key`` (e.g. ["model", "row_id"] folded into one column) for long texts."""
    x = df.withColumns(
        {
            "question_preview": F.substring(question, 1, 60),
            "reference_preview": F.substring(reference, 1, 80),
            "answer_preview": F.substring(answer, 1, 80),
            "em": exact_match(answer, reference),
        }
    )
    return with_heuristic_judge(with_token_f1(x, answer, reference, "f1", key), reference, answer, "judge")


def ngram_perplexity(train: DataFrame, test: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Held-out perplexity of add-one unigram and bigram models fitted on ``train``.

    unigram p(w) = (c(w) + 1) / (N + V); bigram p(b | a) = (c(a, b) + 1) / (c(a) + V),
    with V = distinct training tokens + 1 (for unseen). Counts are aggregated,
    then test grams are left-joined to them; two scalars (N, V) reach the driver.
    """
    uni = train.select(explode_values(tokens_col).alias("w")).filter(F.col("w").isNotNull()).groupBy("w").agg(F.count(F.lit(1)).alias("c"))
    s = uni.agg(F.sum("c").alias("N"), F.count(F.lit(1)).alias("V")).first()
    N, Vsz = int(s["N"] or 0), int(s["V"] or 0) + 1

    def bigrams(df):
        n = F.size(tokens_col)
        z = F.arrays_zip(F.slice(tokens_col, 1, n - 1).alias("a"), F.slice(tokens_col, 2, n - 1).alias("b"))
        return df.filter(n > 1).select(F.explode(z).alias("g")).select("g.a", "g.b")

    bi = bigrams(train).groupBy("a", "b").agg(F.count(F.lit(1)).alias("cab"))
    tu = test.select(explode_values(tokens_col).alias("w")).filter(F.col("w").isNotNull()).join(uni, "w", "left")
    u = tu.agg(
        F.lit("unigram").alias("model"),
        F.count(F.lit(1)).alias("n_tokens"),
        F.sum(-F.log((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(N + Vsz)))).alias("_nll"),
    )
    tb = bigrams(test).join(bi, ["a", "b"], "left").join(uni.withColumnRenamed("w", "a").withColumnRenamed("c", "ca"), "a", "left")
    b = tb.agg(
        F.lit("bigram").alias("model"),
        F.count(F.lit(1)).alias("n_tokens"),
        F.sum(-F.log((F.coalesce("cab", F.lit(0)) + 1) / (F.coalesce("ca", F.lit(0)) + F.lit(Vsz)))).alias("_nll"),
    )
    out = u.unionByName(b)
    return out.select("model", "n_tokens", F.exp(F.col("_nll") / F.col("n_tokens")).alias("perplexity"))


def regression_suite(baseline: DataFrame, candidate: DataFrame, key: str = "row_id", metric: str = "f1", tolerance: float = 0.01) -> DataFrame:
    """I8: candidate against baseline on the same examples (full outer join on the key):
    per-example delta, wins/losses/ties, missing rows on either side, pass/fail."""
    b = baseline.select(key, F.col(metric).alias("_b"))
    c = candidate.select(key, F.col(metric).alias("_c"))
    j = b.join(c, key, "full_outer")
    d = F.col("_c") - F.col("_b")
    summary = j.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_b").isNull()).alias("missing_baseline"),
        F.count_if(F.col("_c").isNull()).alias("missing_candidate"),
        F.count_if(d > 0).alias("wins"),
        F.count_if(d < 0).alias("losses"),
        F.count_if(d == 0).alias("ties"),
        F.avg("_b").alias("mean_baseline"),
        F.avg("_c").alias("mean_candidate"),
        F.avg(d).alias("mean_delta"),
    )
    return summary.withColumn(
        "passed", (F.col("mean_delta") >= -F.lit(tolerance)) & (F.col("missing_candidate") == 0)
    )


def win_rate(a: DataFrame, b: DataFrame, key: str = "row_id", score: str = "judge") -> DataFrame:
    """Share of examples where A beats, ties or loses to B."""
    j = a.select(key, F.col(score).alias("_a")).join(b.select(key, F.col(score).alias("_b")), key)
    n = F.count(F.lit(1))
    return j.agg(
        n.alias("n"),
        (F.count_if(F.col("_a") > F.col("_b")) / n).alias("win_rate"),
        (F.count_if(F.col("_a") == F.col("_b")) / n).alias("tie_rate"),
        (F.count_if(F.col("_a") < F.col("_b")) / n).alias("loss_rate"),
    )


def randomize_ab_order(df: DataFrame, seed: int = 42, key: str = "row_id") -> DataFrame:
    """Show the two answers in a seeded random order (md5 parity), keeping the
    mapping so a positional verdict ("first"/"second") can be mapped back to a model."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    swapped = F.conv(F.substring(h, 32, 1), 16, 10).cast("int") % 2 == 1
    return df.withColumn("swapped", swapped).withColumns(
        {
            "first_answer": F.when(F.col("swapped"), F.col("answer_b")).otherwise(F.col("answer_a")),
            "second_answer": F.when(F.col("swapped"), F.col("answer_a")).otherwise(F.col("answer_b")),
        }
    )


def unswap_verdict(df: DataFrame, verdict_col: str = "verdict") -> DataFrame:
    """Map a positional verdict back to "a" or "b"."""
    first_is_a = ~F.col("swapped")
    v = F.col(verdict_col)
    return df.withColumn(
        "winner",
        F.when((v == "first") & first_is_a, "a").when(v == "first", "b").when((v == "second") & first_is_a, "b").when(v == "second", "a"),
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows that have both sides; null (not an error) when a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def judge_length_bias(scores: DataFrame, score_col: str = "judge", text_col: str = "answer") -> DataFrame:
    """Mean answer length per score, plus the score/length correlation overall
    (rollup: the grand-total row has ``is_total``; a null score alone means rows without one)."""
    x = scores.select(F.col(score_col).alias("score"), F.length(text_col).alias("_len"))
    return x.rollup("score").agg(
        (F.grouping("score") == 1).alias("is_total"),
        F.count(F.lit(1)).alias("n"),
        F.avg("_len").alias("mean_answer_chars"),
        F.when(F.grouping("score") == 1, pearson(F.col("score").cast("double"), F.col("_len").cast("double"))).alias("corr_score_length"),
    )


def contamination_check(train: DataFrame, bench: DataFrame, n: int = 8, train_key: str = "doc_id", bench_key: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, document) pairs sharing word n-grams, with the share of the item's
    distinct n-grams found in the document. An item of fewer than n words is one gram, which
    is looked up among the documents' runs of as many words.

    The benchmark's grams become 64-bit hashes; documents keep only grams whose hash is among
    them before anything is shuffled by text, and the text of the grams decides. AQE broadcasts the
    hashes when it measures them as small and joins by shuffle otherwise.
    """
    words = bench.select(bench_key, split_ws(F.lower(F.col(text_col))).alias("_w"))
    short = F.when((F.size("_w") > 0) & (F.size("_w") < n), F.array(F.concat_ws(" ", "_w"))).otherwise(F.array().cast("array<string>"))
    grams = F.when(F.size("_w") >= n, word_ngrams("_w", n)).otherwise(short)
    bg = words.select(bench_key, explode_values(grams).alias("gram")).filter(F.col("gram").isNotNull())
    sizes = bg.groupBy(bench_key).agg(F.count(F.lit(1)).alias("item_grams"))
    # Which lengths below n occur: one row of at most n - 1 numbers, attached by a constant key.
    lengths = words.filter((F.size("_w") > 0) & (F.size("_w") < n)).agg(F.collect_set(F.size("_w")).alias("_lens")).withColumn("_one", F.lit(1))
    texts = train.select(train_key, F.lower(F.col(text_col)).alias("_t"), F.lit(1).alias("_one")).join(F.broadcast(lengths), "_one")
    texts = texts.select(train_key, "_lens", split_ws("_t").alias("_w"))
    none = F.array().cast("array<string>")
    runs = [word_ngrams("_w", n)] + [F.when(F.array_contains("_lens", k), word_ngrams("_w", k)).otherwise(none) for k in range(1, n)]
    tg = texts.select(train_key, explode_values(F.concat(*runs)).alias("gram")).filter(F.col("gram").isNotNull())
    wanted = bg.select("gram").distinct().select(F.col("gram").alias("_gram"))
    found = tg.join(wanted.select(F.xxhash64("_gram").alias("_hash")).distinct(), F.xxhash64("gram") == F.col("_hash"), "left_semi")
    shared = found.join(bg, "gram").groupBy(bench_key, train_key).agg(F.count(F.lit(1)).alias("shared_grams"))
    return shared.join(sizes, bench_key).withColumn("coverage", F.col("shared_grams") / F.col("item_grams"))


def decontaminate(train: DataFrame, hits: DataFrame, key: str = "doc_id", min_coverage: float = 0.0) -> DataFrame:
    """Drop training rows hit by the contamination check (left anti join)."""
    bad = hits.filter(F.col("coverage") > F.lit(min_coverage)).select(key).distinct()
    return train.join(bad, key, "left_anti")


# Our behaviour rules (name -> case-insensitive pattern).
BEHAVIOUR_RULES = {
    "refusal": r"(?i)(i cannot|i can't|i am unable|as an ai)",
    "unsafe": r"(?i)(password|api[ _-]?key|secret)",
    "placeholder": r"(?i)(lorem ipsum|todo|tbd)",
}


def behaviour_flags(df: DataFrame, text_col: str = "answer", model_col: str = "model", rules=BEHAVIOUR_RULES) -> DataFrame:
    """Format, refusal and safety flags counted per model."""
    t = F.col(text_col)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.length(ustrip(t)) == 0).alias("n_empty"),
        F.count_if((F.upper(t) == t) & (F.lower(t) != t)).alias("n_shouting"),
    ]
    aggs += [F.count_if(t.rlike(p)).alias(f"n_{name}") for name, p in rules.items()]
    return df.groupBy(model_col).agg(*aggs)


# ---------------------------------------------------------------- I14: flags learned from labels

#: Buckets of hashed word n-grams: the bound of a flag model, whatever the size of the texts.
FLAG_BUCKETS = 1 << 20
_ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _bucket(gram: Column) -> Column:
    return F.conv(F.substring(F.md5(gram.cast("binary")), 1, 5), 16, 10).cast("int")


def _gram_rows(df: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """keys and bucket, once for each bucket of a row's words and pairs of neighbouring words (letters and digits, A-Z lower-cased)."""
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text_col), F.lit("")), *_ASCII), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    listed = df.select(*keys, words.alias("_w"))
    following = F.transform(F.arrays_zip(F.slice("_w", 1, F.greatest(F.size("_w") - 1, F.lit(0))).alias("a"), F.slice("_w", 2, F.greatest(F.size("_w") - 1, F.lit(0))).alias("b")), lambda p: F.concat_ws(" ", p["a"], p["b"]))
    grams = listed.select(*keys, F.concat("_w", following).alias("_g"))
    buckets = grams.select(*keys, F.array_distinct(F.transform("_g", _bucket)).alias("_b"))
    return buckets.select(*keys, explode_values("_b").alias("bucket")).filter(F.col("bucket").isNotNull())


def fit_flags(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", min_rows: int = 5, strength: int = 10, z: int = 8) -> tuple[DataFrame, int]:
    """A linear model over hashed word n-grams, (bucket, weight) and the weight of every text, from all labelled rows.

    A bucket's weight is 1000 times the log ratio of its shares in the rows with label 1 and label 0, each smoothed towards
    its share in all by ``strength`` rows. Buckets in fewer than ``min_rows`` rows have none, nor have those whose rows with label 1
    are within ``z`` standard deviations of what chance gives: over many buckets their noise would outweigh the others. Training is one aggregate
    with partial sums over buckets; the model has ``FLAG_BUCKETS`` rows at most. Null labels don't count."""
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(text_col, F.col(label_col).cast("long").alias("_y"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_y"), F.lit(0)).alias("n1")).first()
    n1, n0 = float(total.n1), float(total.n - total.n1)
    held = _gram_rows(rows, ["_y"], text_col).groupBy("bucket").agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").alias("_c1")).filter(F.col("_c") >= min_rows)
    share = n1 / max(n0 + n1, 1.0)
    off = F.col("_c1") - F.col("_c") * share
    held = held.filter(off * off > F.col("_c") * F.lit(z * z * share * (1 - share)))
    all_share = F.col("_c") / F.lit(max(n0 + n1, 1.0)) * strength
    ratio = ((F.col("_c1") + all_share) / F.lit(n1 + strength)) / ((F.col("_c") - F.col("_c1") + all_share) / F.lit(n0 + strength))
    base = math.floor(1000 * math.log((n1 + 1) / (n0 + 1)))
    return held.select("bucket", F.floor(F.lit(1000) * F.log(ratio)).cast("long").alias("weight")), base


def flag_scores(df: DataFrame, model: tuple[DataFrame, int], keys: list[str], text_col: str = "text") -> DataFrame:
    """keys, score of each row, over 0 if the model sees it as label 1. ``keys`` identify a row; the weights, at most ``FLAG_BUCKETS``
    rows, are broadcast, so the grams of a text meet on their own task before they are summed."""
    weights, base = model
    sums = _gram_rows(df, keys, text_col).join(F.broadcast(weights), "bucket").groupBy(*keys).agg(F.sum("weight").alias("_s"))
    sums = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_s")
    scored = df.select(*keys).join(sums, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], "left")
    return scored.select(*keys, (F.coalesce("_s", F.lit(0)) + F.lit(base)).alias("score"))


def learned_flags(df: DataFrame, model: tuple[DataFrame, int], text_col: str = "answer", model_col: str = "model", key: str = "row_id") -> DataFrame:
    """Per model, the answers and how many of them the learned flag marks."""
    scored = flag_scores(df, model, [model_col, key], text_col)
    return scored.groupBy(model_col).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("score") > 0).alias("n_flagged"), F.sum("score").alias("score_sum"))


def flag_quality(scored: DataFrame, label_col: str = "toxic") -> DataFrame:
    """One row: how many labelled rows were flagged rightly and wrongly."""
    flagged, y = F.col("score") > 0, F.col(label_col) == 1
    return scored.filter(F.col(label_col).isin(0, 1)).agg(
        F.count_if(flagged & y).alias("n_hit"), F.count_if(flagged & ~y).alias("n_false"), F.count_if(~flagged & y).alias("n_missed"), F.count_if(~flagged & ~y).alias("n_clean")
    )
