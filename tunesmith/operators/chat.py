"""Chat formatting (D-group) with native string and array-of-struct functions.

A chat template is a small record (bos, per-role prefix/suffix, generation
prompt, eos) turned into Column expressions — never a UDF.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MESSAGE_TYPE = "array<struct<role:string,content:string>>"


@dataclass(frozen=True)
class ChatTemplate:
    name: str
    bos: str = ""
    prefix: dict = field(default_factory=dict)
    suffix: dict = field(default_factory=dict)
    generation_prompt: str = ""
    eos: str = ""

    def prefix_of(self, role: Column) -> Column:
        return _lookup(role, self.prefix)

    def suffix_of(self, role: Column) -> Column:
        return _lookup(role, self.suffix)


def _lookup(role: Column, table: dict) -> Column:
    expr = F.lit("")
    for r, text in table.items():
        expr = F.when(role == F.lit(r), F.lit(text)).otherwise(expr)
    return expr


# Our ChatML-style template and the plain two-heading fallback.
CHATML = ChatTemplate(
    name="chatml",
    bos="",
    prefix={"system": "<|im_start|>system\n", "user": "<|im_start|>user\n", "assistant": "<|im_start|>assistant\n"},
    suffix={"system": "<|im_end|>\n", "user": "<|im_end|>\n", "assistant": "<|im_end|>\n"},
    generation_prompt="<|im_start|>assistant\n",
    eos="<|im_end|>",
)
FALLBACK_INSTRUCTION_HEADING = "### Instruction:\n"
FALLBACK_RESPONSE_HEADING = "\n\n### Response:\n"
DEFAULT_EOS = "</s>"

TEMPLATES = {"chatml": CHATML}


def template_registry(name: str | None) -> ChatTemplate | None:
    """M4: named template records; None means "no chat template" -> fallback rendering."""
    if name is None:
        return None
    return TEMPLATES[name]


def user_content(instruction="instruction", input_="input") -> Column:
    """instruction, plus a blank line and the input when the input is non-empty."""
    inp = F.coalesce(F.col(input_), F.lit(""))
    return F.when(inp != F.lit(""), F.concat(F.col(instruction), F.lit("\n\n"), inp)).otherwise(F.col(instruction))


def message(role, content) -> Column:
    return F.struct(F.lit(role).alias("role") if isinstance(role, str) else role.alias("role"), content.alias("content"))


def to_chat_messages(df: DataFrame, out: str = "messages") -> DataFrame:
    """[{user: instruction(+input)}, {assistant: output}]."""
    return df.withColumn(out, F.array(message("user", user_content()), message("assistant", F.col("output"))))


def render_fallback(df: DataFrame, eos: str = DEFAULT_EOS, out: str = "text") -> DataFrame:
    """The two-heading plain template, EOS appended ("" for none)."""
    return df.withColumn(
        out,
        F.concat(F.lit(FALLBACK_INSTRUCTION_HEADING), user_content(), F.lit(FALLBACK_RESPONSE_HEADING), F.col("output"), F.lit(eos or "")),
    )


def render_messages(messages: Column, template: ChatTemplate) -> Column:
    pieces = F.transform(messages, lambda m: F.concat(template.prefix_of(m["role"]), m["content"], template.suffix_of(m["role"])))
    return F.concat(F.lit(template.bos), F.array_join(pieces, ""))


def render_chat(df: DataFrame, template: ChatTemplate = CHATML, messages: str = "messages", out: str = "text") -> DataFrame:
    """D3: apply a template record to a message list."""
    return df.withColumn(out, render_messages(F.col(messages), template))


def render_generation_prompt(df: DataFrame, template: ChatTemplate = CHATML, messages: str = "messages", out: str = "prompt") -> DataFrame:
    """Render without a trailing assistant reply, then append the assistant header."""
    m = F.col(messages)
    n = F.size(m)
    without_reply = F.when((n > 0) & (F.element_at(m, -1)["role"] == F.lit("assistant")), F.slice(m, 1, n - 1)).otherwise(m)
    return df.withColumn(out, F.concat(render_messages(without_reply, template), F.lit(template.generation_prompt)))


def with_system_prompt(df: DataFrame, system_text: str, messages: str = "messages") -> DataFrame:
    """Prepend a system message unless the list already opens with one."""
    m = F.col(messages)
    has_system = (F.size(m) > 0) & (F.element_at(m, 1)["role"] == F.lit("system"))
    sys_msg = F.array(message("system", F.lit(system_text)))
    return df.withColumn(messages, F.when(has_system, m).otherwise(F.concat(sys_msg, m)))


def assemble_conversations(turns: DataFrame) -> DataFrame:
    """Turns -> one ordered message list per conversation.

    The list is the operator's output; a conversation is bounded by the model's
    context, so one row per conversation is the intended granularity.
    """
    grouped = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("_t")
    )
    return grouped.select(
        "conv_id",
        F.transform("_t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"),
    )


def history_per_turn(turns: DataFrame) -> DataFrame:
    """One row per assistant turn with every message before it (what the model saw)."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    hist = turns.withColumn("_h", F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))).over(w))
    return hist.filter(F.col("role") == "assistant").select(
        "conv_id",
        "turn",
        F.transform(F.array_sort("_h"), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("history"),
        F.col("text").alias("reply"),
    )


def conversation_segments(turns: DataFrame, size: int = 256) -> DataFrame:
    """D6 for conversations of any length: a conversation as a chain of segments, (conv_id, segment, messages, n_before).

    A segment holds the messages whose turn numbers lie in [segment * size, (segment + 1) * size), in order, so
    at most ``size`` where turns don't repeat; ``n_before`` is how many messages come before it. Segments are grouped by
    (conv_id, segment), so a conversation of very many turns is built by many tasks; what runs along a conversation is a window
    over the counts of its segments, a row for each ``size`` messages. Turns without a number come first."""
    placed = turns.select("conv_id", F.coalesce(F.floor(F.col("turn") / size), F.lit(NO_SEGMENT)).alias("segment"), F.struct("turn", "role", F.col("text").alias("content")).alias("_m"))
    grouped = placed.groupBy("conv_id", "segment").agg(F.array_sort(F.collect_list("_m")).alias("_t"))
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    # Counted before the messages are there: only (conv_id, segment, count) passes the window.
    counts = placed.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("_n")).withColumn("n_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    few = counts.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), "n_before")
    # Merged, so that the segments are never sent to the tasks that hold the counts of one conversation.
    met = grouped.join(few.hint("merge"), F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("segment") == F.col("_segment")))
    messages = F.transform("_t", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"), x["turn"].alias("turn")))
    return met.select("conv_id", "segment", messages.alias("messages"), "n_before")


NO_SEGMENT = -(1 << 62)


def history_references(turns: DataFrame, size: int = 256) -> DataFrame:
    """D7 for conversations of any length: one row per assistant turn whose history is a reference, (conv_id, turn, segment, end, n_history, reply).

    The history of the turn is every ``conversation_segments`` of the conversation before ``segment`` and the first ``end`` messages
    of that one, ``n_history`` in all; so a turn costs one row however long its history is. ``history_of`` reads one back."""
    inside = F.posexplode("messages").alias("end", "_m")
    rows = conversation_segments(turns, size).select("conv_id", "segment", "n_before", inside).filter(F.col("_m.role") == "assistant")
    return rows.select("conv_id", F.col("_m.turn").alias("turn"), "segment", F.col("end"), (F.col("n_before") + F.col("end")).alias("n_history"), F.col("_m.content").alias("reply"))


def history_of(segments: DataFrame, reference, window: int | None = None) -> DataFrame:
    """(place, role, content) of the history that one row of ``history_references`` names, its last ``window`` messages if given."""
    mine = segments.filter(F.col("conv_id").eqNullSafe(F.lit(reference["conv_id"])) & (F.col("segment") <= F.lit(reference["segment"])))
    rows = mine.select("n_before", F.posexplode("messages").alias("_p", "_m"))
    placed = rows.select((F.col("n_before") + F.col("_p")).alias("place"), F.col("_m.role").alias("role"), F.col("_m.content").alias("content"))
    first = 0 if window is None else max(0, reference["n_history"] - window)
    return placed.filter((F.col("place") < F.lit(reference["n_history"])) & (F.col("place") >= F.lit(first)))


def turn_key(conv="conv_id", turn="turn") -> Column:
    """(conv_id, turn) as one number, conv_id * 2^32 + turn, as a decimal that holds it for every 64-bit conv_id (hashed and
    negative ones too). Two pairs never share a key; a turn that isn't between 0 and 2^32 - 1 fails the job instead."""
    key = (F.col(conv).cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col(turn).cast("decimal(10,0)")).cast("decimal(31,0)")
    return F.when(F.col(turn).between(0, (1 << 32) - 1), key).when(F.col(turn).isNull() | F.col(conv).isNull(), F.lit(None)).otherwise(F.raise_error(F.lit("turn is too large for a key")).cast("decimal(31,0)"))


def turns_to_instructions(turns: DataFrame) -> DataFrame:
    """A user turn directly followed by an assistant turn -> instruction row.

    An equi-join on (conv_id, turn + 1) rather than ``lead`` over a conversation
    window: the join hashes on both columns, so one very long conversation is
    spread over many tasks instead of landing in one.
    """
    u = turns.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    a = turns.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    return u.join(a, ["conv_id", "turn"]).select(
        turn_key().alias("row_id"),
        "conv_id",
        "turn",
        "instruction",
        F.lit("").alias("input"),
        "output",
    )


def validate_conversations(turns: DataFrame) -> DataFrame:
    """Flag conversations the chat loop cannot produce (system?, (user, assistant)*),
    and those ending on a user turn (not trainable).

    Each turn is checked against its predecessor through an equi-join on
    (conv_id, turn), then flags are summed per conversation with partial
    aggregation — no conversation is ever collected into one list.
    """
    prev = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("prev_role"))
    t = turns.join(prev, ["conv_id", "turn"], "left")
    bad = (
        ((F.col("role") == "system") & (F.col("turn") > 0))
        | ((F.col("turn") == 0) & (F.col("role") == "assistant"))
        | ((F.col("prev_role") == "user") & (F.col("role") != "assistant"))
        | ((F.col("prev_role") == "assistant") & (F.col("role") != "user"))
        | ((F.col("prev_role") == "system") & (F.col("role") != "user"))
        | (~F.col("role").isin("system", "user", "assistant"))
    )
    per_conv = t.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.count_if(bad).alias("n_bad_turns"),
        F.min_by("role", "turn").alias("_first"),
        F.max_by("role", "turn").alias("_last"),
    )
    return per_conv.select(
        "conv_id",
        "n_turns",
        (F.col("_first") == "system").alias("has_system"),
        (F.col("_last") == "user").alias("ends_on_user"),
        (F.col("n_bad_turns") == 0).alias("valid_order"),
        ((F.col("n_bad_turns") == 0) & (F.col("_last") == "assistant")).alias("trainable"),
    )


# The request for a grade; the three fields are filled in between the parts.
JUDGE_RUBRIC_PARTS = (
    "Below are a task, notes on what a good response contains, and a response. Start from 5 points and take off "
    "one point for each fact of the notes that the response lacks, two for each statement that contradicts them, "
    "and one if it leaves the topic; never go below 1. Write nothing but the points that remain.\n\n[task]\n",
    "\n[notes]\n",
    "\n[response]\n",
    "\n[points]\n",
)


def judge_prompts(df: DataFrame, question="question", reference="reference", answer="answer", out="judge_prompt") -> DataFrame:
    """Fill the rubric -> one request per row (placeholders filled once, like str.format)."""
    p = JUDGE_RUBRIC_PARTS
    return df.withColumn(
        out, F.concat(F.lit(p[0]), F.col(question), F.lit(p[1]), F.col(reference), F.lit(p[2]), F.col(answer), F.lit(p[3]))
    )


def preference_messages(df: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """(prompt, chosen) and (prompt, rejected) as message lists and rendered texts."""
    chosen = F.array(message("user", F.col("prompt")), message("assistant", F.col("chosen")))
    rejected = F.array(message("user", F.col("prompt")), message("assistant", F.col("rejected")))
    return df.withColumns({"chosen_messages": chosen, "rejected_messages": rejected}).withColumns(
        {
            "chosen_text": render_messages(F.col("chosen_messages"), template),
            "rejected_text": render_messages(F.col("rejected_messages"), template),
        }
    )
