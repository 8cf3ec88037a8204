"""Chat, label, preference, inference and serving operators on rows worked out by hand."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tunesmith.operators import chat, evals, infer, prefs, serving, tokens

TURNS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "bye"),
    (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "assistant", "c"),
]
SCHEMA = "conv_id long, turn long, role string, text string"
U, A, S, END = "<|im_start|>user\n", "<|im_start|>assistant\n", "<|im_start|>system\n", "<|im_end|>\n"


def test_conversations(spark):
    turns = spark.createDataFrame(TURNS, SCHEMA)
    conv = chat.assemble_conversations(turns)
    text = {r.conv_id: r.text for r in chat.render_chat(conv).collect()}
    assert text[1] == f"{S}be brief{END}{U}hi{END}{A}hello{END}{U}bye{END}"
    prompt = {r.conv_id: r.prompt for r in chat.render_generation_prompt(conv).collect()}
    assert prompt[2] == f"{U}a{END}{A}b{END}{A}" and prompt[1] == text[1] + A
    systems = {r.conv_id: r.messages[0].content for r in chat.with_system_prompt(conv, "new").collect()}
    assert systems == {1: "be brief", 2: "new"}
    flags = {r.conv_id: (r.has_system, r.ends_on_user, r.valid_order, r.trainable) for r in chat.validate_conversations(turns).collect()}
    assert flags == {1: (True, True, True, False), 2: (False, False, False, False)}
    history = {(r.conv_id, r.turn): [m.content for m in r.history] for r in chat.history_per_turn(turns).collect()}
    assert history == {(1, 2): ["be brief", "hi"], (2, 1): ["a"], (2, 2): ["a", "b"]}
    rows = sorted((r.conv_id, r.turn, r.instruction, r.output) for r in chat.turns_to_instructions(turns).collect())
    assert rows == [(1, 1, "hi", "hello"), (2, 0, "a", "b")]


def test_grading_request_holds_its_fields(spark):
    df = spark.createDataFrame([("q?", "r!", "{answer}")], "question string, reference string, answer string")
    prompt = chat.judge_prompts(df).first().judge_prompt
    assert [prompt.index(x) for x in ("q?", "r!", "{answer}")] == sorted(prompt.index(x) for x in ("q?", "r!", "{answer}"))


def test_padding_and_labels(spark):
    df = spark.createDataFrame([(1, 0, [7, 2, 2]), (2, 0, [5]), (3, 1, [9, 8])], "row_id long, batch_id long, input_ids array<int>")
    left = {r.row_id: (r.input_ids, r.attention_mask) for r in tokens.pad(df, pad_id=0, side="left").collect()}
    assert left == {1: ([7, 2, 2], [1, 1, 1]), 2: ([0, 0, 5], [0, 0, 1]), 3: ([9, 8], [1, 1])}
    right = tokens.pad(df, pad_id=2)
    assert {r.row_id: r.labels for r in tokens.causal_labels(right).collect()}[2] == [5, -100, -100]
    assert {r.row_id: r.labels for r in tokens.collator_labels(right, pad_id=2).collect()}[1] == [7, -100, -100]


def test_completion_labels_train_on_replies_only(spark):
    conv = chat.assemble_conversations(spark.createDataFrame(TURNS, SCHEMA))
    vocab = tokens.build_vocab(tokens.tokenize(spark.createDataFrame([("hi hello bye a b c be brief",)], "text string")))
    ids = {r.token: r.id for r in vocab.collect()}
    got = {r.conv_id: r.labels for r in tokens.completion_labels(conv, vocab, chat.CHATML).collect()}
    for conv_id, replies in ((1, ["hello"]), (2, ["b", "c"])):
        trained = [x for x in got[conv_id] if x not in (-100, tokens.UNK_ID)]
        assert trained == [ids[w] for w in replies]


def test_preferences(spark):
    rows = [(1, "p", "x", "y"), (2, "p", "x", "y"), (3, "p", "x", "x"), (4, "", "x", "y"), (5, "q", "x", None), (6, "q", "u", "v")]
    df = spark.createDataFrame(rows, "row_id long, prompt string, chosen string, rejected string")
    valid = prefs.validate_preferences(df)
    assert sorted(r.row_id for r in valid.collect()) == [1, 6]
    assert prefs.unpair_preferences(valid).filter("label").count() == 2
    many = spark.createDataFrame([(i, f"p{i % 7}", "a", "b") for i in range(70)], "row_id long, prompt string, chosen string, rejected string")
    split = prefs.preference_split(many, 0.3, by_prompt=True)
    assert split.count() == 70 and split.groupBy("prompt").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    ids = spark.createDataFrame([(list(range(10)), [1, 2, 3, 4], [])], "prompt_ids array<int>, chosen_ids array<int>, rejected_ids array<int>")
    cut = prefs.preference_truncate(ids, max_length=6).first()
    assert (cut.prompt_ids, cut.chosen_ids, cut.rejected_ids) == ([7, 8, 9], [1, 2, 3], [])
    logp = spark.createDataFrame([(-1.0, -2.0, -1.0, -1.0)], "pi_chosen double, pi_rejected double, ref_chosen double, ref_rejected double")
    m = prefs.dpo_metrics(logp, beta=0.5).first()
    assert math.isclose(m.loss, math.log(1 + math.exp(-0.5))) and m.accuracy == 1.0
    scored = spark.createDataFrame([(1, "m", "x", 3), (1, "n", "y", 5), (2, "m", "x", 4), (2, "n", "y", 4)], "row_id long, model string, answer string, judge int")
    assert [(r.row_id, r.chosen, r.rejected) for r in prefs.rank_to_pairs(scored).collect()] == [(1, "y", "x")]
    samples = spark.createDataFrame([(1, "so\n42", "42"), (1, "41", "42")], "row_id long, answer string, reference string")
    assert prefs.verifiable_reward(samples).first().mean_reward == 0.5


def test_inference_plumbing(spark):
    prompts = spark.createDataFrame([(1, f"{U}first{END}{A}x{END}{U}whole question{END}{A}"), (2, "no message")], "row_id long, prompt string")
    assert {r.row_id: r.reply for r in infer.batch_generate(prompts, infer.echo_model()).collect()} == {1: "whole question", 2: ""}
    outs = spark.createDataFrame([([5, 6], [5, 6, 7, 8, 2, 0])], "prompt_ids array<int>, output_ids array<int>")
    got = infer.strip_prompt(outs).withColumn("n", infer.non_pad_tokens("output_ids", 0)).first()
    assert (got.new_ids, got.n) == ([7, 8], 5)
    judged = spark.createDataFrame([("q", "abcd", "ab"), ("q", "abcd", "abcd"), ("q", "", "")], "question string, reference string, answer string")
    assert [r.judge for r in infer.udf_judge(judged, infer.length_judge).collect()] == [3, 5, 1]
    routed = spark.createDataFrame([("a", "1"), ("zzz", "2")], "adapter string, prompt string")
    replies = infer.route_by_adapter(routed, {"a": infer.tagged_model("a")}, infer.tagged_model("base")).collect()
    assert {r.reply for r in replies} == {"a:1", "base:2"}


def test_scores_per_key_and_correlation(spark):
    scores = spark.createDataFrame([(1, "a"), (3, "aaa"), (None, "zzzzzz"), (5, "aaaaa")], "judge int, answer string")
    total = evals.judge_length_bias(scores).filter("is_total").first()
    assert total.n == 4 and math.isclose(total.corr_score_length, 1.0)
    flat = evals.judge_length_bias(scores.filter("judge = 1")).filter("is_total").first()
    assert flat.corr_score_length is None


def test_serving(spark):
    t0 = dt.datetime(2024, 5, 1, 10)
    rows = [(i, t0 + dt.timedelta(minutes=i), 1, float(i), 2, i != 3) for i in range(60)] + [(99, t0 + dt.timedelta(hours=3), 2, 1.0, 4, True)]
    requests = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, latency double, tokens long, ok boolean")
    got = {r.window_start: r for r in serving.serving_metrics(requests).collect()}
    first = got[t0]
    assert (first.n_requests, first.n_errors, first.tokens) == (60, 1, 120) and math.isclose(first.latency_p99, 58.41)
    sessions = sorted((r.user_id, r.n_requests) for r in serving.chat_sessions(requests).collect())
    assert sessions == [(1, 60), (2, 1)]
