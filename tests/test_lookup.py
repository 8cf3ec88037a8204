"""Looking arrays up in a vocabulary whose head alone reaches the tasks, tokenizer plug-ins and bootstrap weights over batches."""

import hashlib
import math
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tunesmith.operators import infer, stats, tokens

ROWS = [(1, ["a", "b", "z", "a"]), (2, []), (3, None), (4, ["c", None, "d", "a"]), (5, ["d"] * 40 + ["q"])]
IDS = {"a": 4, "b": 5, "c": 6, "d": 7}


def vocab_of(spark, extra=()):
    rows = [(t, i, 0) for _, t, i in tokens.SPECIAL_TOKENS] + [(t, i, 1) for t, i in IDS.items()] + list(extra)
    return spark.createDataFrame(rows, "token string, id int, n long")


@pytest.mark.parametrize("head", [0, 6, 1000])
def test_lookup_is_the_same_for_any_head(spark, monkeypatch, head):
    monkeypatch.setattr(tokens, "HEAD", head)
    df, vocab = spark.createDataFrame(ROWS, "row_id long, tokens array<string>"), vocab_of(spark)
    e = tokens.encode(df, vocab)
    want = {i: None if t is None else [IDS.get(x, tokens.UNK_ID) for x in t] for i, t in ROWS}
    assert {r.row_id: r.input_ids for r in e.collect()} == want
    names = {i: t for t, i in IDS.items()} | {i: t for _, t, i in tokens.SPECIAL_TOKENS}
    back = tokens.ids_to_tokens(e.withColumn("input_ids", F.concat("input_ids", F.array(F.lit(99)))), vocab)
    assert {r.row_id: r.id_tokens for r in back.collect()} == {i: None if x is None else [*(names[y] for y in x), None] for i, x in want.items()}


@pytest.mark.parametrize("head", [0, 6, 1000])
def test_lookup_with_repeated_keys_and_shared_or_missing_row_ids(spark, monkeypatch, head):
    monkeypatch.setattr(tokens, "HEAD", head)
    df = spark.createDataFrame([(1, ["a", "b"]), (1, ["c"]), (None, ["a"]), (2, ["</s>", "d"])], "row_id long, tokens array<string>")
    got = sorted(((r.row_id, r.input_ids) for r in tokens.encode(df, vocab_of(spark, [("</s>", 8, 1)])).collect()), key=str)
    assert got == [(1, [4, 6, 5]), (1, [4, 6, 5]), (2, [2, 8, 7]), (None, [])]


def test_a_vocabulary_that_is_all_head_is_looked_up_without_rows_for_tokens(spark):
    df = spark.createDataFrame(ROWS, "row_id long, tokens array<string>")
    plan = tokens.encode(df, vocab_of(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan


LISTS = [[1, 2, 1, 2, None, None, None], [], None, [4], [2, 1], [1, 2], [None, None]]


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_pairs_are_counted_a_bounded_number_at_a_time(monkeypatch, most):
    monkeypatch.setattr(tokens, "PAIRS", most)
    sent, read = [], []

    def batches():
        for x in LISTS:
            read.append(x)
            yield pa.record_batch([pa.array([x], pa.list_(pa.int32()))], names=["ids"])

    for b in tokens._pair_counts(batches()):
        sent.append((len(read), [tuple(r.values()) for r in b.to_pylist()]))
    total = Counter()
    for _, rows in sent:
        assert len({r[:2] for r in rows}) == len(rows)
        for context, following, n in rows:
            total[context, following] += n
    assert total == Counter(p for x in LISTS for p in zip(x or [], (x or [])[1:]))
    assert [at for at, _ in sent] == {1: [1, 5, 6, 7], 4: [1, 7], 1000: [7]}[most]


def test_next_token_pairs_holds_no_row_for_each_pair_before_the_shuffle(spark):
    df = spark.createDataFrame([(x,) for x in LISTS], "ids array<bigint>")
    counts = tokens.next_token_pairs(df, "ids")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Aggregate" not in plan[plan.index("Exchange") :]
    assert sorted(map(tuple, counts.collect()), key=str) == [(1, 2, 3), (2, 1, 2), (2, None, 1), (None, None, 3)]
    assert counts.dtypes == [("context_id", "bigint"), ("next_id", "bigint"), ("n", "bigint")]


def test_tokenizer_batches_are_bounded_by_bytes(spark):
    """3,000 texts of 20,000 bytes are far more than one batch may hold."""
    held = lambda: lambda text: list(text.encode())
    df = spark.range(0, 3000, 1, 1).select("id", F.when(F.col("id") % 1000 != 7, F.repeat(F.lit("ab"), 10_000)).alias("text"))
    got = df.select("id", infer.udf_tokenizer(held)("text").alias("ids")).select("id", F.size("ids").alias("n"), F.col("ids")[1].alias("second"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 16 << 20
    assert got.groupBy("n", "second").count().orderBy("n").collect()[-1]["count"] == 2997
    assert got.filter("n = 20000 AND second = 98").count() == 2997 and got.filter("second IS NULL").count() == 3


def test_bootstrap_weights_by_group_and_batch(spark, monkeypatch):
    monkeypatch.setattr(stats, "DRAWN_ROWS", 3)
    rows = [(i if i else None, float(i % 7), ["x", None, "y"][i % 3]) for i in range(20)] + [(99, None, "x")]
    df = spark.createDataFrame(rows, "row_id long, m double, g string")
    means = stats.bootstrap_means(df, "m", n_boot=5, group_cols=["g"])
    got = {(r.g, r.rep): r["mean"] for r in means.collect()}
    cdf = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(9)]

    def weight(rep, i):
        u = int(hashlib.md5("|".join(["42", str(rep), *([] if i is None else [str(i)])]).encode()).hexdigest()[:13], 16) / 16**13
        return sum(b <= u for b in cdf)

    want = {}
    for g in ("x", None, "y"):
        for rep in range(5):
            own = [(weight(rep, i), m) for i, m, h in rows if h == g and m is not None]
            if sum(w for w, _ in own):
                want[g, rep] = sum(w * m for w, m in own) / sum(w for w, _ in own)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    plan = means._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan  # drawn in the tasks by batches
