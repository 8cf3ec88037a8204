"""Registered queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame,
with its DuckDB oracle SQL where the result is SQL-expressible.

Result columns are scalars only (arrays rendered as '1,2,3' text), integers as
bigint and doubles rounded to 6 places, so both engines hash the same values.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunesmith.functions.text import round6
from tunesmith.operators import chat, clean, splits, stats
from tunesmith.plans import sqlviews as S
from tunesmith.plans import views as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# ---------------------------------------------------------------- shared plans


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> instruction rows -> clean -> exact dedupe -> fallback text -> token length."""
    rows = clean.dedupe_exact(clean.clean_rows(V.instr_docs(spark, sf_dir)))
    return clean.with_token_length(chat.render_fallback(rows))


PREPARED_CTES = [S.INSTR_DOCS, S.CLEANED, S.DEDUPED, S.RENDERED, S.TOKLEN]


def doc_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All document ids (a superset of every derived row_id): cheap rank-bucket boundaries."""
    return V.scan_parquet(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"))


# ---------------------------------------------------------------- flagship


@register(
    "prepare_report",
    S.with_(*PREPARED_CTES, S.three_way("toklen"))
    + """SELECT split, count(*)::BIGINT AS n_rows, min(n_tokens)::BIGINT AS min_len,
       list_sort(list(n_tokens))[count(*) // 2 + 1]::BIGINT AS median_len, max(n_tokens)::BIGINT AS max_len,
       round(avg(n_tokens), 6) AS mean_len
FROM split3 GROUP BY split""",
)
def prepare_report(spark, sf_dir):
    """The reference's main preparation pipeline end to end, reported per split."""
    p = splits.split_three_way(prepared(spark, sf_dir), ids_source=doc_ids(spark, sf_dir))
    r = stats.length_stats(p, "n_tokens", ["split"])
    return r.select("split", F.col("n_rows").cast("long"), "min_len", "median_len", "max_len", round6("mean_len").alias("mean_len"))


# ---------------------------------------------------------------- A: sources


@register(
    "scan_parquet",
    "SELECT doc_id, source, n_chars::BIGINT AS n_chars FROM documents WHERE lang = 'fr' AND n_chars > 1000",
)
def q_scan_parquet(spark, sf_dir):
    d = V.scan_parquet(spark, sf_dir, "documents")
    return d.filter((F.col("lang") == "fr") & (F.col("n_chars") > 1000)).select("doc_id", "source", F.col("n_chars").cast("long"))


# ---------------------------------------------------------------- B: cleaning


@register(
    "require_fields",
    S.with_(S.INSTR_DOCS)
    + "SELECT row_id, instruction, output FROM instr_docs WHERE instruction IS NOT NULL AND instruction <> '' AND output IS NOT NULL AND output <> ''",
)
def q_require_fields(spark, sf_dir):
    return clean.require_fields(V.instr_docs(spark, sf_dir)).select("row_id", "instruction", "output")


@register(
    "output_length_filter",
    S.with_(S.INSTR_DOCS)
    + f"SELECT row_id, length({S.ustrip('output')})::BIGINT AS output_chars FROM instr_docs WHERE length({S.ustrip('output')}) BETWEEN 1 AND 8000",
)
def q_output_length_filter(spark, sf_dir):
    from tunesmith.functions.text import ustrip

    d = clean.output_length_filter(V.instr_docs(spark, sf_dir))
    return d.select("row_id", F.length(ustrip("output")).cast("long").alias("output_chars"))


@register(
    "trim_fields",
    S.with_(S.INSTR_DOCS)
    + f"SELECT row_id, {S.ustrip('instruction')} AS instruction, {S.ustrip(S.COALESCED_INPUT)} AS input, {S.ustrip('output')} AS output, source FROM instr_docs",
)
def q_trim_fields(spark, sf_dir):
    return clean.trim_fields(V.instr_docs(spark, sf_dir)).select("row_id", "instruction", "input", "output", "source")


@register("clean_rows", S.with_(S.INSTR_DOCS, S.CLEANED) + "SELECT row_id, instruction, input, output, lang FROM cleaned")
def q_clean_rows(spark, sf_dir):
    return clean.clean_rows(V.instr_docs(spark, sf_dir)).select("row_id", "instruction", "input", "output", "lang")


@register(
    "clean_report",
    S.with_(S.INSTR_DOCS)
    + f"""SELECT reason, count(*)::BIGINT AS n_rows FROM (
  SELECT CASE WHEN NOT (instruction IS NOT NULL AND instruction <> '' AND output IS NOT NULL AND output <> '') THEN 'missing_field'
              WHEN length({S.ustrip('output')}) < 1 THEN 'too_short'
              WHEN length({S.ustrip('output')}) > 8000 THEN 'too_long' ELSE 'kept' END AS reason
  FROM instr_docs) GROUP BY reason""",
)
def q_clean_report(spark, sf_dir):
    r = clean.clean_report(V.instr_docs(spark, sf_dir))
    return r.select("reason", F.col("n_rows").cast("long"))


@register("dedupe_exact", S.with_(S.INSTR_DOCS, S.CLEANED, S.DEDUPED) + "SELECT row_id, instruction, output, source FROM deduped")
def q_dedupe_exact(spark, sf_dir):
    return clean.dedupe_exact(clean.clean_rows(V.instr_docs(spark, sf_dir))).select("row_id", "instruction", "output", "source")


@register(
    "dedupe_report",
    S.with_(S.INSTR_DOCS, S.CLEANED)
    + """SELECT sum(_n)::BIGINT AS n_rows, count(*)::BIGINT AS n_unique, count(*) FILTER (WHERE _n > 1)::BIGINT AS n_duplicate_groups,
       max(_n)::BIGINT AS largest_group
FROM (SELECT sha256(instruction || '||' || input || '||' || output) AS k, count(*) AS _n FROM cleaned GROUP BY k)""",
)
def q_dedupe_report(spark, sf_dir):
    r = clean.dedupe_report(clean.clean_rows(V.instr_docs(spark, sf_dir)))
    return r.select(*[F.col(c).cast("long").alias(c) for c in r.columns])


# ---------------------------------------------------------------- D: chat


@register(
    "to_chat_messages",
    S.with_(*PREPARED_CTES[:3])
    + f"SELECT row_id, 2::BIGINT AS n_messages, 'user' AS first_role, {S.USER_CONTENT} AS user_content, output AS assistant_content FROM deduped",
)
def q_to_chat_messages(spark, sf_dir):
    rows = clean.dedupe_exact(clean.clean_rows(V.instr_docs(spark, sf_dir)))
    m = chat.to_chat_messages(rows)
    return m.select(
        "row_id",
        F.size("messages").cast("long").alias("n_messages"),
        F.col("messages")[0]["role"].alias("first_role"),
        F.col("messages")[0]["content"].alias("user_content"),
        F.col("messages")[1]["content"].alias("assistant_content"),
    )


@register("render_fallback", S.with_(*PREPARED_CTES[:4]) + "SELECT row_id, text FROM rendered")
def q_render_fallback(spark, sf_dir):
    rows = clean.dedupe_exact(clean.clean_rows(V.instr_docs(spark, sf_dir)))
    return chat.render_fallback(rows).select("row_id", "text")


# ---------------------------------------------------------------- G: splits


@register("split_three_way", S.with_(*PREPARED_CTES[:3], S.three_way("deduped")) + "SELECT row_id, split FROM split3")
def q_split_three_way(spark, sf_dir):
    rows = clean.dedupe_exact(clean.clean_rows(V.instr_docs(spark, sf_dir)))
    return splits.split_three_way(rows, ids_source=doc_ids(spark, sf_dir)).select("row_id", "split")


@register("split_two_way", S.with_(S.INSTR_DOCS, S.two_way("instr_docs")) + "SELECT row_id, split FROM split2")
def q_split_two_way(spark, sf_dir):
    return splits.split_two_way(V.instr_docs(spark, sf_dir)).select("row_id", "split")


# ---------------------------------------------------------------- H: aggregations


@register(
    "length_stats",
    S.with_(*PREPARED_CTES)
    + """SELECT count(*)::BIGINT AS n_rows, min(n_tokens)::BIGINT AS min_len, list_sort(list(n_tokens))[count(*) // 2 + 1]::BIGINT AS median_len,
       max(n_tokens)::BIGINT AS max_len, round(avg(n_tokens), 6) AS mean_len FROM toklen""",
)
def q_length_stats(spark, sf_dir):
    r = stats.length_stats(prepared(spark, sf_dir), "n_tokens")
    return r.select(F.col("n_rows").cast("long"), "min_len", "median_len", "max_len", round6("mean_len").alias("mean_len"))


# ---------------------------------------------------------------- E: tokens

from tunesmith.functions.text import ids_text  # noqa: E402
from tunesmith.operators import packing, tokens  # noqa: E402

WHOLE_CTES = [S.WHOLE]
ENCODED_CTES = WHOLE_CTES + [S.TOK, S.VOCAB, S.ENC]


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it is: row_id, text, lang, source and its token length."""
    d = V.scan_parquet(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text", "lang", "source")
    return clean.with_token_length(d)


def tokenized(spark, sf_dir):
    return tokens.tokenize(whole(spark, sf_dir))


def vocab_of(spark, sf_dir):
    return tokens.build_vocab(tokenized(spark, sf_dir))


def encoded(spark, sf_dir, vocab=None):
    return tokens.encode(tokenized(spark, sf_dir), vocab or vocab_of(spark, sf_dir), "tokens", "input_ids", ids_source=doc_ids(spark, sf_dir))


def encoded_and_vocab(spark, sf_dir):
    """The vocabulary, and row_id and ids of every document, written once: decoding reads them twice."""
    vocab = vocab_of(spark, sf_dir)
    return stored_once(encoded(spark, sf_dir, vocab).select("row_id", "input_ids"), "encoded"), vocab


def padded_batch(spark, sf_dir):
    """Whole encoded sequences batched by row_id div 16, padded to each batch's longest row."""
    e = encoded(spark, sf_dir).withColumn("batch_id", F.floor(F.col("row_id") / 16).cast("long"))
    return tokens.pad(e, "input_ids", "batch_id", pad_id=tokens.EOS_ID, side="right")


@register(
    "tokenize",
    S.with_(*WHOLE_CTES, S.TOK) + "SELECT row_id, len(tokens)::BIGINT AS n_tokens, array_to_string(tokens, ' ') AS tokens_text FROM tok",
)
def q_tokenize(spark, sf_dir):
    t = tokenized(spark, sf_dir)
    return t.select("row_id", F.size("tokens").cast("long").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens_text"))


@register("build_vocab", S.with_(*WHOLE_CTES, S.TOK, S.VOCAB) + "SELECT token, id::BIGINT AS id, n::BIGINT AS n FROM vocab")
def q_build_vocab(spark, sf_dir):
    v = vocab_of(spark, sf_dir)
    return v.select("token", F.col("id").cast("long"), F.col("n").cast("long"))


@register(
    "build_vocab_top",
    S.with_(*WHOLE_CTES, S.TOK) + "SELECT token, (row_number() OVER (ORDER BY n DESC, token) + 3)::BIGINT AS id, n::BIGINT AS n FROM (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM tok) GROUP BY token ORDER BY n DESC, token LIMIT 1000)",
)
def q_build_vocab_top(spark, sf_dir):
    """E2 with a size: the 1,000 most frequent tokens."""
    v = tokens.build_vocab(tokenized(spark, sf_dir), k=1000).filter(F.col("id") >= tokens.N_RESERVED)
    return v.select("token", F.col("id").cast("long"), F.col("n").cast("long"))


@register("encode", S.with_(*ENCODED_CTES) + "SELECT row_id, array_to_string(ids, ',') AS input_ids FROM enc")
def q_encode(spark, sf_dir):
    return encoded(spark, sf_dir).select("row_id", ids_text("input_ids").alias("input_ids"))


@register(
    "ids_to_tokens",
    S.with_(*ENCODED_CTES)
    + """SELECT e.row_id, array_to_string(list(v.token ORDER BY e.pos), ' ') AS id_tokens FROM (
  SELECT row_id, unnest(ids) AS id, unnest(generate_series(1, len(ids))) AS pos FROM enc) e JOIN vocab v USING (id) GROUP BY e.row_id""",
)
def q_ids_to_tokens(spark, sf_dir):
    e, vocab = encoded_and_vocab(spark, sf_dir)
    t = tokens.ids_to_tokens(e, vocab, ids_source=doc_ids(spark, sf_dir))
    return t.select("row_id", F.array_join("id_tokens", " ").alias("id_tokens"))


@register(
    "decode",
    S.with_(*ENCODED_CTES)
    + """SELECT e.row_id, coalesce(array_to_string(list(v.token ORDER BY e.pos) FILTER (WHERE e.id >= 4), ' '), '') AS decoded FROM (
  SELECT row_id, unnest(ids) AS id, unnest(generate_series(1, len(ids))) AS pos FROM enc) e JOIN vocab v USING (id) GROUP BY e.row_id""",
)
def q_decode(spark, sf_dir):
    e, vocab = encoded_and_vocab(spark, sf_dir)
    d = tokens.decode(e, vocab, ids_source=doc_ids(spark, sf_dir))
    return d.select("row_id", "decoded")


@register(
    "special_tokens",
    S.with_(*WHOLE_CTES, S.TOK, S.VOCAB)
    + """SELECT s.name, v.token, v.id::BIGINT AS id, (SELECT count(*) FROM vocab)::BIGINT AS vocab_size
FROM (VALUES ('pad', 0), ('bos', 1), ('eos', 2), ('unk', 3)) s(name, want) LEFT JOIN vocab v ON v.id = s.want""",
)
def q_special_tokens(spark, sf_dir):
    s = tokens.special_tokens(vocab_of(spark, sf_dir))
    return s.select("name", "token", F.col("id").cast("long"), F.col("vocab_size").cast("long"))


@register(
    "token_stats",
    f"""SELECT lang, count(*)::BIGINT AS n_texts, sum(len({S.tokenize('text')}))::BIGINT AS n_tokens,
       sum(len({S.split_ws('text')}))::BIGINT AS n_words,
       round(sum(len({S.tokenize('text')})) / sum(len({S.split_ws('text')})), 6) AS fertility,
       round(avg(len({S.tokenize('text')})), 6) AS mean_tokens
FROM documents GROUP BY lang""",
)
def q_token_stats(spark, sf_dir):
    d = V.scan_parquet(spark, sf_dir, "documents")
    s = tokens.token_stats(d, "text", ["lang"])
    return s.select(
        "lang", F.col("n_texts").cast("long"), F.col("n_tokens").cast("long"), F.col("n_words").cast("long"),
        round6("fertility").alias("fertility"), round6("mean_tokens").alias("mean_tokens"),
    )


@register("truncate", S.with_(*ENCODED_CTES) + "SELECT row_id, array_to_string(ids[1:64], ',') AS input_ids FROM enc")
def q_truncate(spark, sf_dir):
    t = tokens.truncate(encoded(spark, sf_dir), "input_ids", 64)
    return t.select("row_id", ids_text("input_ids").alias("input_ids"))


@register(
    "pad",
    S.with_(*ENCODED_CTES, S.TRUNC_PAD)
    + "SELECT row_id, batch_id::BIGINT AS batch_id, L::BIGINT AS padded_length, array_to_string(ids, ',') AS input_ids, array_to_string(mask, ',') AS attention_mask FROM padded",
)
def q_pad(spark, sf_dir):
    p = padded_batch(spark, sf_dir)
    return p.select(
        "row_id", "batch_id", F.col("padded_length").cast("long"), ids_text("input_ids").alias("input_ids"), ids_text("attention_mask").alias("attention_mask")
    )


@register(
    "pad_left",
    S.with_(*ENCODED_CTES)
    + """SELECT row_id, batch_id::BIGINT AS batch_id, L::BIGINT AS padded_length,
       array_to_string(list_transform(range(L - len(ids)), lambda x: 0) || ids, ',') AS input_ids,
       array_to_string(list_transform(range(L - len(ids)), lambda x: 0) || list_transform(range(len(ids)), lambda x: 1), ',') AS attention_mask
FROM (SELECT row_id, row_id // 16 AS batch_id, ids, max(len(ids)) OVER (PARTITION BY row_id // 16) AS L FROM enc)""",
)
def q_pad_left(spark, sf_dir):
    """E9 for generation: the pad token stands before the sequence."""
    e = encoded(spark, sf_dir).withColumn("batch_id", F.floor(F.col("row_id") / 16).cast("long"))
    p = tokens.pad(e, "input_ids", "batch_id", pad_id=tokens.PAD_ID, side="left")
    return p.select(
        "row_id", "batch_id", F.col("padded_length").cast("long"), ids_text("input_ids").alias("input_ids"), ids_text("attention_mask").alias("attention_mask")
    )


@register(
    "causal_labels",
    S.with_(*ENCODED_CTES, S.TRUNC_PAD)
    + "SELECT row_id, array_to_string(list_transform(list_zip(ids, mask), lambda p: CASE WHEN p[2] = 0 THEN -100 ELSE p[1] END), ',') AS labels FROM padded",
)
def q_causal_labels(spark, sf_dir):
    p = tokens.causal_labels(padded_batch(spark, sf_dir))
    return p.select("row_id", ids_text("labels").alias("labels"))


@register(
    "collator_labels",
    S.with_(*ENCODED_CTES, S.TRUNC_PAD)
    + "SELECT row_id, array_to_string(list_transform(ids, lambda x: CASE WHEN x = 2 THEN -100 ELSE x END), ',') AS labels FROM padded",
)
def q_collator_labels(spark, sf_dir):
    p = tokens.collator_labels(padded_batch(spark, sf_dir), pad_id=tokens.EOS_ID)
    return p.select("row_id", ids_text("labels").alias("labels"))


COMPLETION_SQL = S.with_(
    *WHOLE_CTES,
    S.TOK,
    S.VOCAB,
    f"""msg AS (
  SELECT conv_id, turn, role,
         {S.tokenize("CASE WHEN role IN ('system', 'user', 'assistant') THEN '<|im_start|>' || role || chr(10) ELSE '' END")} AS head,
         {S.tokenize('text')} || {S.tokenize("CASE WHEN role IN ('system', 'user', 'assistant') THEN '<|im_end|>' || chr(10) ELSE '' END")} AS body
  FROM conversations)""",
    """tr AS (
  SELECT conv_id, turn, 0 AS part, unnest(head) AS token, unnest(generate_series(1, len(head))) AS pos, 0 AS lab FROM msg
  UNION ALL
  SELECT conv_id, turn, 1 AS part, unnest(body) AS token, unnest(generate_series(1, len(body))) AS pos,
         CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS lab FROM msg)""",
) + """SELECT conv_id, count(*)::BIGINT AS n_tokens, count(*) FILTER (WHERE lab = 1)::BIGINT AS n_labeled,
       array_to_string(list(CASE WHEN lab = 1 THEN coalesce(v.id, 3) ELSE -100 END ORDER BY turn, part, pos), ',') AS labels
FROM tr LEFT JOIN vocab v USING (token) GROUP BY conv_id"""


@register("completion_labels", COMPLETION_SQL)
def q_completion_labels(spark, sf_dir):
    conv = chat.assemble_conversations(V.turns(spark, sf_dir))
    c = tokens.completion_labels(conv, vocab_of(spark, sf_dir), chat.CHATML)
    return c.select(
        "conv_id",
        F.size("input_ids").cast("long").alias("n_tokens"),
        F.size(F.filter("labels", lambda x: x != tokens.IGNORE_INDEX)).cast("long").alias("n_labeled"),
        ids_text("labels").alias("labels"),
    )


@register(
    "next_token_pairs",
    S.with_(*ENCODED_CTES)
    + """SELECT context_id::BIGINT AS context_id, next_id::BIGINT AS next_id, count(*)::BIGINT AS n FROM (
  SELECT unnest(ids[1:len(ids) - 1]) AS context_id, unnest(ids[2:len(ids)]) AS next_id FROM enc WHERE len(ids) > 1) GROUP BY ALL""",
)
def q_next_token_pairs(spark, sf_dir):
    p = tokens.next_token_pairs(encoded(spark, sf_dir))
    return p.select(F.col("context_id").cast("long"), F.col("next_id").cast("long"), F.col("n").cast("long"))


# ---------------------------------------------------------------- F: packing and batching

BLOCK = 128


@register(
    "pack_sequences",
    S.with_(
        *ENCODED_CTES,
        "s AS (SELECT row_id, ids || [2] AS s, len(ids) + 1 AS n FROM enc)",
        "o AS (SELECT *, (sum(n) OVER (ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n)::BIGINT AS st, (sum(n) OVER ())::BIGINT AS total FROM s)",
        f"""p AS (SELECT *, unnest(generate_series(st // {BLOCK}, least((st + n - 1) // {BLOCK}, total // {BLOCK} - 1))) AS block_id FROM o
       WHERE st // {BLOCK} <= least((st + n - 1) // {BLOCK}, total // {BLOCK} - 1))""",
        f"pc AS (SELECT block_id, greatest(st, block_id * {BLOCK}) AS lo, least(st + n, (block_id + 1) * {BLOCK}) AS hi, s, st FROM p)",
    )
    + "SELECT block_id::BIGINT AS block_id, array_to_string(flatten(list(s[lo - st + 1:hi - st] ORDER BY lo)), ',') AS input_ids FROM pc GROUP BY block_id",
)
def q_pack_sequences(spark, sf_dir):
    b = packing.pack_sequences(encoded(spark, sf_dir), "input_ids", "row_id", BLOCK, tokens.EOS_ID, ids_source=doc_ids(spark, sf_dir))
    return b.select("block_id", ids_text("input_ids").alias("input_ids"))


@register(
    "padding_waste",
    S.with_(*ENCODED_CTES)
    + f"""SELECT count(*)::BIGINT AS n_rows, (count(*) * {BLOCK})::BIGINT AS allocated_tokens, sum(len(ids))::BIGINT AS real_tokens,
       round(100.0 * (1.0 - sum(len(ids)) / greatest(count(*) * {BLOCK}, 1)), 6) AS waste_pct FROM enc""",
)
def q_padding_waste(spark, sf_dir):
    w = packing.padding_waste(encoded(spark, sf_dir), "input_ids", BLOCK)
    return w.select(F.col("n_rows").cast("long"), F.col("allocated_tokens").cast("long"), F.col("real_tokens").cast("long"), round6("waste_pct").alias("waste_pct"))


@register(
    "packing_efficiency",
    S.with_(*ENCODED_CTES)
    + f"""SELECT n_rows::BIGINT AS n_rows, real_tokens::BIGINT AS real_tokens, (real_tokens // {BLOCK})::BIGINT AS n_blocks,
       (real_tokens // {BLOCK} * {BLOCK})::BIGINT AS packed_tokens,
       round(least(100.0, 100.0 * real_tokens / greatest(real_tokens // {BLOCK} * {BLOCK}, 1)), 6) AS real_pct
FROM (SELECT count(*) AS n_rows, sum(len(ids) + 1) AS real_tokens FROM enc)""",
)
def q_packing_efficiency(spark, sf_dir):
    e = packing.packing_efficiency(encoded(spark, sf_dir), "input_ids", BLOCK)
    return e.select(*[F.col(c).cast("long") for c in ("n_rows", "real_tokens", "n_blocks", "packed_tokens")], round6("real_pct").alias("real_pct"))


@register(
    "assign_batches",
    S.with_(
        *WHOLE_CTES,
        "e AS (SELECT row_id, unnest(range(2)) AS epoch FROM toklen)",
        "r AS (SELECT epoch, row_id, row_number() OVER (PARTITION BY epoch ORDER BY md5(concat_ws('|', '42', CAST(epoch AS VARCHAR), CAST(row_id AS VARCHAR))), row_id) - 1 AS position FROM e)",
    )
    + "SELECT epoch::BIGINT AS epoch, row_id, position::BIGINT AS position, (position // 4)::BIGINT AS micro_batch, (position // 16)::BIGINT AS step FROM r",
)
def q_assign_batches(spark, sf_dir):
    b = packing.assign_batches(doc_ids(spark, sf_dir), n_epochs=2, seed=42, per_device_batch=4, accumulation=4)
    return b.select(F.col("epoch").cast("long"), "row_id", "position", "micro_batch", "step")


@register(
    "dynamic_padding_waste",
    S.with_(
        *WHOLE_CTES,
        f"x AS (SELECT row_id, n_tokens AS len, {S.md5_key(42, 'row_id')} AS h FROM toklen)",
        "rnd AS (SELECT (row_number() OVER (ORDER BY h, row_id) - 1) // 8 AS b, len FROM x)",
        "srt AS (SELECT (row_number() OVER (ORDER BY len, h, row_id) - 1) // 8 AS b, len FROM x)",
        """summ AS (SELECT 'random' AS ordering, b, max(len) AS m, count(*) AS c, sum(len) AS rl FROM rnd GROUP BY b
  UNION ALL SELECT 'length_sorted' AS ordering, b, max(len) AS m, count(*) AS c, sum(len) AS rl FROM srt GROUP BY b)""",
    )
    + """SELECT ordering, count(*)::BIGINT AS n_batches, sum(rl)::BIGINT AS real_tokens, sum(m * c)::BIGINT AS padded_tokens,
       round(100.0 * (1.0 - sum(rl) / greatest(sum(m * c), 1)), 6) AS waste_pct FROM summ GROUP BY ordering""",
)
def q_dynamic_padding_waste(spark, sf_dir):
    w = packing.dynamic_padding_waste(whole(spark, sf_dir), "n_tokens", batch_size=8)
    return w.select(
        F.col("order").alias("ordering"), F.col("n_batches").cast("long"), F.col("real_tokens").cast("long"),
        F.col("padded_tokens").cast("long"), round6("waste_pct").alias("waste_pct"),
    )


@register(
    "context_coverage",
    S.with_(*WHOLE_CTES)
    + """SELECT L::BIGINT AS context_length, count(*) FILTER (WHERE n_tokens <= L)::BIGINT AS rows_fit,
       round(count(*) FILTER (WHERE n_tokens <= L) / count(*), 6) AS row_share,
       round(sum(least(n_tokens, L)) / sum(n_tokens), 6) AS token_share
FROM toklen, (VALUES (256), (512), (1024), (2048)) v(L) GROUP BY L""",
)
def q_context_coverage(spark, sf_dir):
    c = packing.context_coverage(whole(spark, sf_dir), "n_tokens", (256, 512, 1024, 2048))
    return c.select("context_length", "rows_fit", round6("row_share").alias("row_share"), round6("token_share").alias("token_share"))


# ---------------------------------------------------------------- I: evaluation scoring

from tunesmith.functions.text import normalize_answer  # noqa: E402
from tunesmith.operators import evals, prefs  # noqa: E402

PRED_CTES = [S.INSTR_TURNS, S.PREDICTIONS]
MODEL_CTES = [S.INSTR_TURNS, S.TWO_MODELS, S.SCORED_MODELS]


def scored_models(spark, sf_dir):
    m = V.two_models(spark, sf_dir).withColumn("_key", F.concat_ws("|", "model", F.col("row_id").cast("string")))
    return evals.score_table(m, key="_key").drop("_key")


@register(
    "normalize_answer",
    S.with_(*PRED_CTES) + f"SELECT row_id, {S.normalize('answer')} AS answer_norm, {S.normalize('reference')} AS reference_norm FROM predictions",
)
def q_normalize_answer(spark, sf_dir):
    p = V.predictions(spark, sf_dir)
    return p.select("row_id", normalize_answer("answer").alias("answer_norm"), normalize_answer("reference").alias("reference_norm"))


@register("exact_match", S.with_(*PRED_CTES) + f"SELECT row_id, (({S.normalize('answer')}) = ({S.normalize('reference')}))::DOUBLE AS em FROM predictions")
def q_exact_match(spark, sf_dir):
    return V.predictions(spark, sf_dir).select("row_id", evals.exact_match("answer", "reference").alias("em"))


@register(
    "token_f1",
    S.with_(*PRED_CTES) + f"SELECT row_id, round({S.f1_of('_p', '_r')}, 6) AS f1 FROM (SELECT *, {S.words('answer')} AS _p, {S.words('reference')} AS _r FROM predictions)",
)
def q_token_f1(spark, sf_dir):
    f = evals.with_token_f1(V.predictions(spark, sf_dir), "answer", "reference", "f1", key="row_id")
    return f.select("row_id", round6("f1").alias("f1"))


@register("heuristic_judge", S.with_(*PRED_CTES) + f"SELECT row_id, {S.judge_of('reference', 'answer')}::BIGINT AS judge FROM predictions")
def q_heuristic_judge(spark, sf_dir):
    return V.predictions(spark, sf_dir).select("row_id", evals.heuristic_judge("question", "reference", "answer").cast("long").alias("judge"))


@register(
    "parse_judge_reply",
    """SELECT conv_id, turn, (CASE WHEN regexp_extract(reply, '[0-9]', 0) = '' THEN 3
        ELSE least(5, greatest(1, CAST(regexp_extract(reply, '[0-9]', 0) AS INTEGER))) END)::BIGINT AS score
FROM (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'Score: ' || CAST(conv_id % 12 AS VARCHAR) || '/5' ELSE text END AS reply FROM conversations)""",
)
def q_parse_judge_reply(spark, sf_dir):
    r = V.judge_replies(spark, sf_dir)
    return r.select("conv_id", "turn", evals.parse_judge_reply("reply").cast("long").alias("score"))


@register(
    "score_table",
    S.with_(*MODEL_CTES)
    + """SELECT model, row_id, substr(question, 1, 60) AS question_preview, substr(reference, 1, 80) AS reference_preview,
       substr(answer, 1, 80) AS answer_preview, em, round(f1, 6) AS f1, judge::BIGINT AS judge FROM scored_models""",
)
def q_score_table(spark, sf_dir):
    s = scored_models(spark, sf_dir)
    return s.select(
        "model", "row_id", "question_preview", "reference_preview", "answer_preview", "em", round6("f1").alias("f1"), F.col("judge").cast("long")
    )


NGRAM_SQL = S.with_(
    *WHOLE_CTES,
    S.TOK,
    S.two_way("tok"),
    "tr AS (SELECT tokens FROM split2 WHERE split = 'train')",
    "te AS (SELECT tokens FROM split2 WHERE split = 'test')",
    "uni AS (SELECT w, count(*) AS c FROM (SELECT unnest(tokens) AS w FROM tr) GROUP BY w)",
    "nv AS (SELECT sum(c) AS N, count(*) + 1 AS V FROM uni)",
    "bi AS (SELECT a, b, count(*) AS cab FROM (SELECT unnest(tokens[1:len(tokens) - 1]) AS a, unnest(tokens[2:len(tokens)]) AS b FROM tr WHERE len(tokens) > 1) GROUP BY a, b)",
    "tu AS (SELECT -ln((coalesce(u.c, 0) + 1) / (nv.N + nv.V)) AS nll FROM (SELECT unnest(tokens) AS w FROM te) t LEFT JOIN uni u USING (w), nv)",
    """tb AS (SELECT -ln((coalesce(bi.cab, 0) + 1) / (coalesce(u.c, 0) + nv.V)) AS nll
  FROM (SELECT unnest(tokens[1:len(tokens) - 1]) AS a, unnest(tokens[2:len(tokens)]) AS b FROM te WHERE len(tokens) > 1) t
  LEFT JOIN bi USING (a, b) LEFT JOIN uni u ON u.w = t.a, nv)""",
) + """SELECT 'unigram' AS model, count(*)::BIGINT AS n_tokens, round(exp(sum(nll) / count(*)), 6) AS perplexity FROM tu
UNION ALL SELECT 'bigram' AS model, count(*)::BIGINT AS n_tokens, round(exp(sum(nll) / count(*)), 6) AS perplexity FROM tb"""


@register("ngram_perplexity", NGRAM_SQL)
def q_ngram_perplexity(spark, sf_dir):
    t = splits.split_two_way(tokenized(spark, sf_dir))
    r = evals.ngram_perplexity(t.filter(F.col("split") == "train"), t.filter(F.col("split") == "test"), "tokens")
    return r.select("model", F.col("n_tokens").cast("long"), round6("perplexity").alias("perplexity"))


@register(
    "regression_suite",
    S.with_(*MODEL_CTES)
    + """SELECT count(*)::BIGINT AS n, count(*) FILTER (WHERE b.f1 IS NULL)::BIGINT AS missing_baseline,
       count(*) FILTER (WHERE c.f1 IS NULL)::BIGINT AS missing_candidate,
       count(*) FILTER (WHERE c.f1 - b.f1 > 0)::BIGINT AS wins, count(*) FILTER (WHERE c.f1 - b.f1 < 0)::BIGINT AS losses,
       count(*) FILTER (WHERE c.f1 - b.f1 = 0)::BIGINT AS ties, round(avg(b.f1), 6) AS mean_baseline, round(avg(c.f1), 6) AS mean_candidate,
       round(avg(c.f1 - b.f1), 6) AS mean_delta,
       (avg(c.f1 - b.f1) >= -0.01 AND count(*) FILTER (WHERE c.f1 IS NULL) = 0) AS passed
FROM (SELECT row_id, f1 FROM scored_models WHERE model = 'baseline') b
FULL OUTER JOIN (SELECT row_id, f1 FROM scored_models WHERE model = 'candidate') c USING (row_id)""",
)
def q_regression_suite(spark, sf_dir):
    s = scored_models(spark, sf_dir)
    r = evals.regression_suite(s.filter(F.col("model") == "baseline"), s.filter(F.col("model") == "candidate"))
    return r.select(
        *[F.col(c).cast("long") for c in ("n", "missing_baseline", "missing_candidate", "wins", "losses", "ties")],
        *[round6(c).alias(c) for c in ("mean_baseline", "mean_candidate", "mean_delta")],
        "passed",
    )


@register(
    "win_rate",
    S.with_(*MODEL_CTES)
    + """SELECT count(*)::BIGINT AS n, round(count(*) FILTER (WHERE c.judge > b.judge) / count(*), 6) AS win_rate,
       round(count(*) FILTER (WHERE c.judge = b.judge) / count(*), 6) AS tie_rate,
       round(count(*) FILTER (WHERE c.judge < b.judge) / count(*), 6) AS loss_rate
FROM (SELECT row_id, judge FROM scored_models WHERE model = 'candidate') c JOIN (SELECT row_id, judge FROM scored_models WHERE model = 'baseline') b USING (row_id)""",
)
def q_win_rate(spark, sf_dir):
    s = scored_models(spark, sf_dir)
    w = evals.win_rate(s.filter(F.col("model") == "candidate"), s.filter(F.col("model") == "baseline"))
    return w.select(F.col("n").cast("long"), *[round6(c).alias(c) for c in ("win_rate", "tie_rate", "loss_rate")])


@register(
    "randomize_ab_order",
    S.with_(*MODEL_CTES)
    + f"""SELECT row_id, swapped, CASE WHEN (v = 'first') = NOT swapped THEN 'a' ELSE 'b' END AS winner FROM (
  SELECT row_id, swapped, CASE WHEN (CASE WHEN swapped THEN fb ELSE fa END) >= (CASE WHEN swapped THEN fa ELSE fb END) THEN 'first' ELSE 'second' END AS v
  FROM (SELECT a.row_id, a.f1 AS fa, b.f1 AS fb, (('0x' || substr({S.md5_key(42, 'a.row_id')}, 32, 1))::INTEGER % 2 = 1) AS swapped
        FROM (SELECT row_id, f1 FROM scored_models WHERE model = 'candidate') a JOIN (SELECT row_id, f1 FROM scored_models WHERE model = 'baseline') b USING (row_id)))""",
)
def q_randomize_ab_order(spark, sf_dir):
    s = scored_models(spark, sf_dir)
    a = s.filter(F.col("model") == "candidate").select("row_id", F.col("answer").alias("answer_a"), F.col("f1").alias("f1_a"))
    b = s.filter(F.col("model") == "baseline").select("row_id", F.col("answer").alias("answer_b"), F.col("f1").alias("f1_b"))
    r = evals.randomize_ab_order(a.join(b, "row_id"))
    first_f1 = F.when(F.col("swapped"), F.col("f1_b")).otherwise(F.col("f1_a"))
    second_f1 = F.when(F.col("swapped"), F.col("f1_a")).otherwise(F.col("f1_b"))
    # stand-in judge with a position bias: ties go to the answer shown first
    r = r.withColumn("verdict", F.when(first_f1 >= second_f1, "first").otherwise("second"))
    return evals.unswap_verdict(r).select("row_id", "swapped", "winner")


@register(
    "judge_length_bias",
    S.with_(*MODEL_CTES)
    + """SELECT coalesce(judge, 0)::BIGINT AS score, GROUPING(judge) = 1 AS is_total, count(*)::BIGINT AS n, round(avg(length(answer)), 6) AS mean_answer_chars,
       CASE WHEN GROUPING(judge) = 1 AND stddev_pop(judge) > 0 AND stddev_pop(length(answer)) > 0 THEN round(corr(judge, length(answer)), 6) END AS corr_score_length
FROM scored_models GROUP BY ROLLUP (judge)""",
)
def q_judge_length_bias(spark, sf_dir):
    b = evals.judge_length_bias(scored_models(spark, sf_dir))
    # a null score is shown as 0; is_total tells the total row from rows without a score
    return b.select(F.coalesce(F.col("score"), F.lit(0)).cast("long").alias("score"), "is_total", F.col("n").cast("long"), round6("mean_answer_chars").alias("mean_answer_chars"), round6("corr_score_length").alias("corr_score_length"))


NGRAM_N = 8


def _grams_sql(w: str) -> str:
    """Distinct n-grams of the word-list *column* w (a column, so the lambda does not
    re-evaluate the word split per element)."""
    return f"CASE WHEN len({w}) >= {NGRAM_N} THEN list_distinct(list_transform(range(1, len({w}) - {NGRAM_N} + 2), lambda i: array_to_string({w}[i:i + {NGRAM_N - 1}], ' '))) ELSE [] END"


_WORDS = S.split_ws("lower(text)")
CONTAM_CTE = f"""bw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
bg AS (SELECT item_id, unnest(CASE WHEN len(w) BETWEEN 1 AND {NGRAM_N - 1} THEN [array_to_string(w, ' ')] ELSE {_grams_sql('w')} END) AS gram FROM bw),
sizes AS (SELECT item_id, count(*) AS item_grams FROM bg GROUP BY item_id),
lens AS (SELECT DISTINCT len(w) AS k FROM bw WHERE len(w) BETWEEN 1 AND {NGRAM_N - 1}),
tg AS (SELECT doc_id, unnest({_grams_sql('w')}) AS gram FROM dw
  UNION SELECT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS gram FROM dw, lens WHERE len(w) >= k),
hits AS (SELECT item_id, doc_id, count(*) AS shared_grams FROM tg JOIN bg USING (gram) GROUP BY item_id, doc_id),
contam AS (SELECT h.item_id, h.doc_id, h.shared_grams, s.item_grams, h.shared_grams / s.item_grams AS coverage FROM hits h JOIN sizes s USING (item_id))"""


def contamination(spark, sf_dir):
    docs = V.scan_parquet(spark, sf_dir, "documents")
    bench = V.scan_parquet(spark, sf_dir, "benchmark")
    return evals.contamination_check(docs, bench, NGRAM_N)


@register(
    "contamination_check",
    "WITH " + CONTAM_CTE + "\nSELECT item_id, doc_id, shared_grams::BIGINT AS shared_grams, item_grams::BIGINT AS item_grams, round(coverage, 6) AS coverage FROM contam",
)
def q_contamination_check(spark, sf_dir):
    c = contamination(spark, sf_dir)
    return c.select("item_id", "doc_id", F.col("shared_grams").cast("long"), F.col("item_grams").cast("long"), round6("coverage").alias("coverage"))


@register(
    "decontaminate",
    "WITH " + CONTAM_CTE + "\nSELECT d.doc_id, d.lang FROM documents d ANTI JOIN (SELECT DISTINCT doc_id FROM contam WHERE coverage > 0) c ON c.doc_id = d.doc_id",
)
def q_decontaminate(spark, sf_dir):
    docs = V.scan_parquet(spark, sf_dir, "documents")
    return evals.decontaminate(docs, contamination(spark, sf_dir)).select("doc_id", "lang")


@register(
    "behaviour_flags",
    S.with_(S.INSTR_TURNS, S.TWO_MODELS)
    + f"""SELECT model, count(*)::BIGINT AS n, count(*) FILTER (WHERE length({S.ustrip('answer')}) = 0)::BIGINT AS n_empty,
       count(*) FILTER (WHERE upper(answer) = answer AND lower(answer) <> answer)::BIGINT AS n_shouting,
       count(*) FILTER (WHERE regexp_matches(answer, '(?i)(i cannot|i can''t|i am unable|as an ai)'))::BIGINT AS n_refusal,
       count(*) FILTER (WHERE regexp_matches(answer, '(?i)(password|api[ _-]?key|secret)'))::BIGINT AS n_unsafe,
       count(*) FILTER (WHERE regexp_matches(answer, '(?i)(lorem ipsum|todo|tbd)'))::BIGINT AS n_placeholder
FROM two_models GROUP BY model""",
)
def q_behaviour_flags(spark, sf_dir):
    f = evals.behaviour_flags(V.two_models(spark, sf_dir))
    return f.select("model", *[F.col(c).cast("long") for c in f.columns if c != "model"])


HELD_OUT = f"('0x' || substr({S.md5_key(42, 'doc_id')}, 1, 13))::BIGINT / 4503599627370496.0 < 0.2::DOUBLE"
FLAG_CTES = [
    """texts AS (SELECT 'd' AS kind, doc_id AS id, text, toxic, """
    + HELD_OUT
    + """ AS held FROM documents JOIN labels USING (doc_id)
  UNION ALL SELECT model, row_id, answer, NULL, NULL FROM two_models)""",
    r"""worded AS (SELECT *, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\p{L}\p{N}]+') AS w FROM texts)""",
    """grams AS (SELECT DISTINCT kind, id, toxic, held, ('0x' || substr(md5(g), 1, 5))::INT AS bucket FROM (
  SELECT kind, id, toxic, held, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM worded))""",
    "counts AS (SELECT count(*)::DOUBLE AS n, sum(toxic)::DOUBLE AS n1 FROM texts WHERE NOT held)",
    """weights AS (SELECT bucket, floor(1000 * ln(((c1 + c / n * 10) / (n1 + 10)) / ((c - c1 + c / n * 10) / (n - n1 + 10))))::BIGINT AS weight
  FROM (SELECT bucket, count(*) AS c, sum(toxic) AS c1 FROM grams WHERE NOT held GROUP BY bucket HAVING count(*) >= 5), counts
  WHERE (c1 - c * (n1 / n)) * (c1 - c * (n1 / n)) > c * (64 * (n1 / n) * (1 - n1 / n)))""",
    """flags AS (SELECT t.kind, t.id, t.toxic, t.held, coalesce(s.s, 0) + floor(1000 * ln((n1 + 1) / (n - n1 + 1)))::BIGINT AS score
  FROM texts t LEFT JOIN (SELECT kind, id, sum(weight) AS s FROM grams JOIN weights USING (bucket) GROUP BY kind, id) s ON s.kind = t.kind AND s.id = t.id, counts)""",
]


def _labelled(spark, sf_dir):
    """The labelled documents and whether each is held out (a fifth, by its id)."""
    d = V.scan_parquet(spark, sf_dir, "documents").select("doc_id", "text").join(V.scan_parquet(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id")
    return splits.group_split(d, "doc_id", 0.0, 0.2).withColumn("held", F.col("split") == "test")


@register(
    "flag_quality",
    S.with_(S.INSTR_TURNS, S.TWO_MODELS, *FLAG_CTES)
    + """SELECT count(*) FILTER (WHERE score > 0 AND toxic = 1)::BIGINT AS n_hit, count(*) FILTER (WHERE score > 0 AND toxic = 0)::BIGINT AS n_false,
       count(*) FILTER (WHERE score <= 0 AND toxic = 1)::BIGINT AS n_missed, count(*) FILTER (WHERE score <= 0 AND toxic = 0)::BIGINT AS n_clean FROM flags WHERE held""",
)
def q_flag_quality(spark, sf_dir):
    """The flag learned from four fifths of the labels, on the other fifth."""
    rows = _labelled(spark, sf_dir)
    scored = evals.flag_scores(rows.filter("held"), evals.fit_flags(rows.filter("NOT held")), ["doc_id", "toxic"])
    r = evals.flag_quality(scored)
    return r.select(*[F.col(c).cast("long") for c in r.columns])


@register(
    "learned_flags",
    S.with_(S.INSTR_TURNS, S.TWO_MODELS, *FLAG_CTES)
    + "SELECT kind AS model, count(*)::BIGINT AS n, count(*) FILTER (WHERE score > 0)::BIGINT AS n_flagged, sum(score)::BIGINT AS score_sum FROM flags WHERE kind <> 'd' GROUP BY kind",
)
def q_learned_flags(spark, sf_dir):
    """Answers that the learned flag marks, by model."""
    f = evals.learned_flags(V.two_models(spark, sf_dir), evals.fit_flags(_labelled(spark, sf_dir).filter("NOT held")))
    return f.select("model", *[F.col(c).cast("long") for c in ("n", "n_flagged", "score_sum")])


# ---------------------------------------------------------------- J: preference data

PREF_CTES = [S.INSTR_TURNS, S.PREFERENCES]
VALID_PREFS = """valid AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha256(prompt || '||' || chosen || '||' || rejected) ORDER BY row_id) AS _rn
  FROM preferences WHERE prompt IS NOT NULL AND prompt <> '' AND chosen IS NOT NULL AND chosen <> '' AND rejected IS NOT NULL AND rejected <> ''
    AND chosen <> rejected) WHERE _rn = 1)"""


@register("validate_preferences", S.with_(*PREF_CTES, VALID_PREFS) + "SELECT row_id, prompt, chosen, rejected FROM valid")
def q_validate_preferences(spark, sf_dir):
    return prefs.validate_preferences(V.preferences(spark, sf_dir)).select("row_id", "prompt", "chosen", "rejected")


@register("preference_split", S.with_(*PREF_CTES, VALID_PREFS, S.two_way("valid")) + "SELECT row_id, split FROM split2")
def q_preference_split(spark, sf_dir):
    v = prefs.validate_preferences(V.preferences(spark, sf_dir))
    return prefs.preference_split(v).select("row_id", "split")


@register(
    "preference_split_by_prompt",
    S.with_(*PREF_CTES, VALID_PREFS)
    + f"""SELECT row_id, CASE WHEN ('0x' || substr({S.md5_key(42, 'prompt')}, 1, 13))::BIGINT / 4503599627370496.0 < 0.2::DOUBLE THEN 'test' ELSE 'train' END AS split FROM valid""",
)
def q_preference_split_by_prompt(spark, sf_dir):
    """J2 without leaks: all pairs of a prompt in one split."""
    v = prefs.validate_preferences(V.preferences(spark, sf_dir))
    return prefs.preference_split(v, by_prompt=True).select("row_id", "split")


@register(
    "preference_truncate",
    S.with_(
        *PREF_CTES,
        f"t AS (SELECT row_id, {S.tokenize('prompt')} AS p, {S.tokenize('chosen')} AS c, {S.tokenize('rejected')} AS r FROM preferences)",
        "tp AS (SELECT row_id, p[greatest(len(p) - 32, 0) + 1:greatest(len(p) - 32, 0) + 32] AS p, c, r FROM t)",
    )
    + """SELECT row_id, array_to_string(p, ' ') AS prompt_tokens, array_to_string(c[1:greatest(64 - len(p), 0)], ' ') AS chosen_tokens,
       array_to_string(r[1:greatest(64 - len(p), 0)], ' ') AS rejected_tokens FROM tp""",
)
def q_preference_truncate(spark, sf_dir):
    from tunesmith.functions.text import tokenize as tok

    p = V.preferences(spark, sf_dir).select("row_id", tok("prompt").alias("prompt_ids"), tok("chosen").alias("chosen_ids"), tok("rejected").alias("rejected_ids"))
    t = prefs.preference_truncate(p, max_length=64)
    return t.select(
        "row_id",
        F.array_join("prompt_ids", " ").alias("prompt_tokens"),
        F.array_join("chosen_ids", " ").alias("chosen_tokens"),
        F.array_join("rejected_ids", " ").alias("rejected_tokens"),
    )


SOFTPLUS = "(greatest({x}, 0.0) + ln(1 + exp(-abs({x}))))"


@register(
    "dpo_metrics",
    S.with_(
        S.LOGPROBS,
        "m AS (SELECT (pi_chosen - ref_chosen) - (pi_rejected - ref_rejected) AS margin, 0.1 * (pi_chosen - ref_chosen) AS rc, 0.1 * (pi_rejected - ref_rejected) AS rr FROM logprobs)",
    )
    + f"""SELECT count(*)::BIGINT AS n, round(avg({SOFTPLUS.format(x='(-0.1 * margin)')}), 6) AS loss,
       round(avg((margin > 0)::DOUBLE), 6) AS accuracy, round(avg(rc - rr), 6) AS reward_margin,
       round(avg(rc), 6) AS reward_chosen, round(avg(rr), 6) AS reward_rejected FROM m""",
)
def q_dpo_metrics(spark, sf_dir):
    d = prefs.dpo_metrics(V.logprobs(spark, sf_dir), beta=0.1)
    return d.select(F.col("n").cast("long"), *[round6(c).alias(c) for c in d.columns if c != "n"])


@register(
    "orpo_metrics",
    S.with_(
        S.LOGPROBS,
        "mm AS (SELECT pi_chosen / n_tokens AS mc, pi_rejected / n_tokens AS mr FROM logprobs)",
        "o AS (SELECT CASE WHEN mc < 0 AND mr < 0 THEN -mc END AS nll_chosen, CASE WHEN mc < 0 AND mr < 0 THEN (mc - ln(1 - exp(mc))) - (mr - ln(1 - exp(mr))) END AS ratio FROM mm)",
    )
    + f"""SELECT count(*)::BIGINT AS n, count(*) FILTER (WHERE ratio IS NULL)::BIGINT AS n_invalid, round(avg(nll_chosen), 6) AS nll_chosen, round(avg(CASE WHEN ratio IS NOT NULL THEN {SOFTPLUS.format(x='(-ratio)')} END), 6) AS or_loss,
       round(avg(nll_chosen + 0.1 * CASE WHEN ratio IS NOT NULL THEN {SOFTPLUS.format(x='(-ratio)')} END), 6) AS loss, round(avg((ratio > 0)::DOUBLE), 6) AS accuracy FROM o""",
)
def q_orpo_metrics(spark, sf_dir):
    d = prefs.orpo_metrics(V.logprobs(spark, sf_dir), lam=0.1)
    return d.select(F.col("n").cast("long"), F.col("n_invalid").cast("long"), *[round6(c).alias(c) for c in d.columns if c not in ("n", "n_invalid")])


@register(
    "unpair_preferences",
    S.with_(*PREF_CTES) + "SELECT row_id, chosen AS completion, true AS label FROM preferences UNION ALL SELECT row_id, rejected AS completion, false AS label FROM preferences",
)
def q_unpair_preferences(spark, sf_dir):
    return prefs.unpair_preferences(V.preferences(spark, sf_dir)).select("row_id", "completion", "label")


def _final_sql(x: str) -> str:
    return f"coalesce(list_filter(string_split({x}, chr(10)), lambda l: trim(l) <> '')[-1], '')"


@register(
    "verifiable_reward",
    S.with_(S.INSTR_TURNS, S.TWO_MODELS)
    + f"""SELECT row_id, count(*)::BIGINT AS n_samples,
       round(avg(({S.normalize(_final_sql('answer'))} = {S.normalize(_final_sql('reference'))})::DOUBLE), 6) AS mean_reward
FROM two_models GROUP BY row_id""",
)
def q_verifiable_reward(spark, sf_dir):
    r = prefs.verifiable_reward(V.two_models(spark, sf_dir))
    return r.select("row_id", F.col("n_samples").cast("long"), round6("mean_reward").alias("mean_reward"))


@register(
    "distillation_rows",
    S.with_(
        "pr AS (SELECT conv_id, turn, text AS instruction FROM conversations WHERE role = 'user')",
        "te AS (SELECT conv_id, turn - 1 AS turn, text AS output FROM conversations WHERE role = 'assistant')",
        f"""ok AS (SELECT conv_id, turn, {S.ustrip('instruction')} AS instruction, {S.ustrip('output')} AS output FROM pr JOIN te USING (conv_id, turn)
   WHERE instruction <> '' AND output <> '' AND length({S.ustrip('output')}) BETWEEN 1 AND 8000)""",
        "okd AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sha256(instruction || '||' || '' || '||' || output) ORDER BY conv_id, turn) AS _rn FROM ok) WHERE _rn = 1)",
    )
    + f"""SELECT conv_id, turn, 'ok' AS status, instruction, output FROM okd
UNION ALL SELECT conv_id, turn, 'rejected' AS status, instruction, output FROM pr JOIN te USING (conv_id, turn)
   WHERE output IS NOT NULL AND coalesce(instruction = '' OR output = '' OR length({S.ustrip('output')}) NOT BETWEEN 1 AND 8000, true)
UNION ALL SELECT conv_id, turn, 'missing' AS status, instruction, NULL AS output FROM pr WHERE NOT EXISTS (SELECT 1 FROM te WHERE te.conv_id = pr.conv_id AND te.turn = pr.turn AND te.output IS NOT NULL)""",
)
def q_distillation_rows(spark, sf_dir):
    t = V.turns(spark, sf_dir)
    prompts = t.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("instruction"))
    teacher = t.filter(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    prompts = prompts.withColumn("row_id", chat.turn_key())
    d = prefs.distillation_rows(prompts, teacher)
    return d.select("conv_id", "turn", "status", "instruction", "output")


@register(
    "rank_to_pairs",
    S.with_(
        *MODEL_CTES,
        """allm AS (SELECT row_id, model, judge FROM scored_models
  UNION ALL SELECT row_id, 'reference' AS model, 5 AS judge FROM instr_turns)""",
        "ag AS (SELECT row_id, max(judge) AS hi, min(judge) AS lo FROM allm GROUP BY row_id)",
    )
    + """SELECT ag.row_id, (SELECT max(model) FROM allm a WHERE a.row_id = ag.row_id AND a.judge = ag.hi) AS chosen_model,
       (SELECT min(model) FROM allm a WHERE a.row_id = ag.row_id AND a.judge = ag.lo) AS rejected_model,
       hi::BIGINT AS chosen_score, lo::BIGINT AS rejected_score FROM ag WHERE hi > lo""",
)
def q_rank_to_pairs(spark, sf_dir):
    s = scored_models(spark, sf_dir).select("row_id", "model", "answer", F.col("judge").cast("int"))
    ref = V.instr_turns(spark, sf_dir).select("row_id", F.lit("reference").alias("model"), F.col("output").alias("answer"), F.lit(5).alias("judge"))
    p = prefs.rank_to_pairs(s.unionByName(ref))
    return p.select("row_id", "chosen_model", "rejected_model", F.col("chosen_score").cast("long"), F.col("rejected_score").cast("long"))


# ---------------------------------------------------------------- D: chat (templates, conversations)


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _chatml_sql(role: str, content: str) -> str:
    """SQL twin of one ChatML message."""
    pre = "CASE " + " ".join(f"WHEN {role} = {_lit(r)} THEN {_lit(p)}" for r, p in chat.CHATML.prefix.items()) + " ELSE '' END"
    suf = "CASE " + " ".join(f"WHEN {role} = {_lit(r)} THEN {_lit(p)}" for r, p in chat.CHATML.suffix.items()) + " ELSE '' END"
    return f"({pre} || {content} || {suf})"


def turn_messages(spark, sf_dir):
    return chat.to_chat_messages(V.instr_turns(spark, sf_dir))


@register(
    "render_chat",
    S.with_(S.INSTR_TURNS) + f"SELECT row_id, {_chatml_sql(_lit('user'), 'instruction')} || {_chatml_sql(_lit('assistant'), 'output')} AS text FROM instr_turns",
)
def q_render_chat(spark, sf_dir):
    return chat.render_chat(turn_messages(spark, sf_dir), chat.CHATML).select("row_id", "text")


@register(
    "render_generation_prompt",
    S.with_(S.INSTR_TURNS) + f"SELECT row_id, {_chatml_sql(_lit('user'), 'instruction')} || {_lit(chat.CHATML.generation_prompt)} AS prompt FROM instr_turns",
)
def q_render_generation_prompt(spark, sf_dir):
    return chat.render_generation_prompt(turn_messages(spark, sf_dir), chat.CHATML).select("row_id", "prompt")


SYSTEM_TEXT = "You are a helpful assistant."


@register(
    "with_system_prompt",
    f"""SELECT conv_id, (count(*) + CASE WHEN min_by(role, turn) = 'system' THEN 0 ELSE 1 END)::BIGINT AS n_messages,
       CASE WHEN min_by(role, turn) = 'system' THEN min_by(text, turn) ELSE {_lit(SYSTEM_TEXT)} END AS first_content
FROM conversations GROUP BY conv_id""",
)
def q_with_system_prompt(spark, sf_dir):
    c = chat.with_system_prompt(chat.assemble_conversations(V.turns(spark, sf_dir)), SYSTEM_TEXT)
    return c.select("conv_id", F.size("messages").cast("long").alias("n_messages"), F.col("messages")[0]["content"].alias("first_content"))


@register(
    "assemble_conversations",
    f"""SELECT conv_id, count(*)::BIGINT AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
       string_agg({_chatml_sql('role', 'text')}, '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id""",
)
def q_assemble_conversations(spark, sf_dir):
    c = chat.assemble_conversations(V.turns(spark, sf_dir))
    return c.select(
        "conv_id",
        F.size("messages").cast("long").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        chat.render_messages(F.col("messages"), chat.CHATML).alias("text"),
    )


@register(
    "history_per_turn",
    """SELECT conv_id, turn, len(h)::BIGINT AS n_history, array_to_string(h, ',') AS history_roles, reply FROM (
  SELECT conv_id, turn, role, text AS reply,
         coalesce(list(role) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS h
  FROM conversations) WHERE role = 'assistant'""",
)
def q_history_per_turn(spark, sf_dir):
    h = chat.history_per_turn(V.turns(spark, sf_dir))
    return h.select(
        "conv_id", "turn", F.size("history").cast("long").alias("n_history"),
        F.array_join(F.transform("history", lambda m: m["role"]), ",").alias("history_roles"), "reply",
    )


@register(
    "conversation_segments",
    """SELECT conv_id, segment::BIGINT AS segment, n::BIGINT AS n_messages, roles, chars::BIGINT AS n_chars, coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS n_before
FROM (SELECT conv_id, turn // 3 AS segment, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles, sum(length(text)) AS chars FROM conversations GROUP BY ALL)""",
)
def q_conversation_segments(spark, sf_dir):
    """D6 in segments of three turns."""
    c = chat.conversation_segments(V.turns(spark, sf_dir), size=3)
    chars = F.aggregate("messages", F.lit(0).cast("long"), lambda a, m: a + F.length(m["content"]))
    return c.select("conv_id", F.col("segment").cast("long"), F.size("messages").cast("long").alias("n_messages"), F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"), chars.alias("n_chars"), F.col("n_before").cast("long"))


@register(
    "history_references",
    """SELECT conv_id, turn::BIGINT AS turn, segment::BIGINT AS segment, "end"::BIGINT AS "end", n_history::BIGINT AS n_history, reply FROM (
  SELECT conv_id, turn, role, text AS reply, turn // 3 AS segment, row_number() OVER (PARTITION BY conv_id, turn // 3 ORDER BY turn) - 1 AS "end", row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n_history FROM conversations)
WHERE role = 'assistant'""",
)
def q_history_references(spark, sf_dir):
    """D7 by reference into segments of three turns."""
    h = chat.history_references(V.turns(spark, sf_dir), size=3)
    return h.select("conv_id", *[F.col(c).cast("long") for c in ("turn", "segment", "end", "n_history")], "reply")


@register("turns_to_instructions", S.with_(S.INSTR_TURNS) + "SELECT row_id, instruction, output FROM instr_turns")
def q_turns_to_instructions(spark, sf_dir):
    return V.instr_turns(spark, sf_dir).select("row_id", "instruction", "output")


@register(
    "validate_conversations",
    """SELECT conv_id, count(*)::BIGINT AS n_turns, min_by(role, turn) = 'system' AS has_system, max_by(role, turn) = 'user' AS ends_on_user,
       count(*) FILTER (WHERE bad) = 0 AS valid_order, (count(*) FILTER (WHERE bad) = 0 AND max_by(role, turn) = 'assistant') AS trainable
FROM (SELECT conv_id, turn, role,
        coalesce((role = 'system' AND turn > 0) OR (turn = 0 AND role = 'assistant')
          OR (prev = 'user' AND role <> 'assistant') OR (prev = 'assistant' AND role <> 'user') OR (prev = 'system' AND role <> 'user')
          OR role NOT IN ('system', 'user', 'assistant'), false) AS bad
      FROM (SELECT c.*, p.role AS prev FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1))
GROUP BY conv_id""",
)
def q_validate_conversations(spark, sf_dir):
    return chat.validate_conversations(V.turns(spark, sf_dir)).select(
        "conv_id", F.col("n_turns").cast("long"), "has_system", "ends_on_user", "valid_order", "trainable"
    )


@register(
    "judge_prompts",
    S.with_(*PRED_CTES)
    + "SELECT row_id, "
    + f"{_lit(chat.JUDGE_RUBRIC_PARTS[0])} || question || {_lit(chat.JUDGE_RUBRIC_PARTS[1])} || reference || {_lit(chat.JUDGE_RUBRIC_PARTS[2])} || answer || {_lit(chat.JUDGE_RUBRIC_PARTS[3])} AS judge_prompt FROM predictions",
)
def q_judge_prompts(spark, sf_dir):
    return chat.judge_prompts(V.predictions(spark, sf_dir)).select("row_id", "judge_prompt")


@register(
    "preference_messages",
    S.with_(*PREF_CTES)
    + f"""SELECT row_id, {_chatml_sql(_lit('user'), 'prompt')} || {_chatml_sql(_lit('assistant'), 'chosen')} AS chosen_text,
       {_chatml_sql(_lit('user'), 'prompt')} || {_chatml_sql(_lit('assistant'), 'rejected')} AS rejected_text FROM preferences""",
)
def q_preference_messages(spark, sf_dir):
    return chat.preference_messages(V.preferences(spark, sf_dir)).select("row_id", "chosen_text", "rejected_text")


# ---------------------------------------------------------------- B: remaining cleaning operators


@register(
    "length_outlier_filter",
    S.with_(*WHOLE_CTES)
    + """SELECT t.row_id, t.lang, t.n_tokens FROM toklen t JOIN (SELECT lang, quantile_cont(n_tokens, [0.01, 0.99]) AS b FROM toklen GROUP BY lang) q ON q.lang IS NOT DISTINCT FROM t.lang
WHERE t.n_tokens BETWEEN q.b[1] AND q.b[2]""",
)
def q_length_outlier_filter(spark, sf_dir):
    f = clean.length_outlier_filter(whole(spark, sf_dir), "n_tokens", ["lang"], 0.01, 0.99)
    return f.select("row_id", "lang", "n_tokens")


FALLBACK_LINT = chat.ChatTemplate(name="fallback", prefix={"user": chat.FALLBACK_INSTRUCTION_HEADING}, eos=chat.DEFAULT_EOS)


@register(
    "format_lint",
    S.with_(S.INSTR_DOCS, S.RENDERED_ALL)
    + f"""SELECT count(*)::BIGINT AS n_rows, count(*) FILTER (WHERE NOT contains(text, {_lit(chat.FALLBACK_INSTRUCTION_HEADING)}))::BIGINT AS n_missing_markers,
       count(*) FILTER (WHERE NOT ends_with(text, '</s>'))::BIGINT AS n_no_eos,
       count(*) FILTER (WHERE contains(text, '<|im_start|>') OR contains(text, '<|im_end|>'))::BIGINT AS n_foreign_markers FROM rendered""",
)
def q_format_lint(spark, sf_dir):
    flagged = clean.format_lint(chat.render_fallback(V.instr_docs(spark, sf_dir)), FALLBACK_LINT, "text", other_markers=("<|im_start|>", "<|im_end|>"))
    r = clean.format_lint_report(flagged)
    return r.select(*[F.col(c).cast("long") for c in r.columns])


@register("drop_columns", S.with_(S.INSTR_DOCS, S.RENDERED_ALL) + "SELECT row_id, text FROM rendered")
def q_drop_columns(spark, sf_dir):
    return clean.drop_columns(chat.render_fallback(V.instr_docs(spark, sf_dir)), ["row_id", "text"])


@register(
    "preview",
    S.with_(*PRED_CTES)
    + "SELECT row_id, substr(question, 1, 60) AS question_preview, substr(reference, 1, 80) AS reference_preview, substr(answer, 1, 80) AS answer_preview FROM predictions",
)
def q_preview(spark, sf_dir):
    return clean.preview(V.predictions(spark, sf_dir)).select("row_id", "question_preview", "reference_preview", "answer_preview")


# ---------------------------------------------------------------- G: remaining split operators


@register(
    "split_overlap_check",
    S.with_(S.INSTR_DOCS, S.CLEANED, S.three_way("cleaned"))
    + """SELECT count(*)::BIGINT AS n_leaking_keys, coalesce(sum(n_rows), 0)::BIGINT AS n_leaking_rows FROM (
  SELECT sha256(instruction || '||' || input || '||' || output) AS k, count(DISTINCT split) AS n_splits, count(*) AS n_rows FROM split3 GROUP BY k)
WHERE n_splits > 1""",
)
def q_split_overlap_check(spark, sf_dir):
    s = splits.split_three_way(clean.clean_rows(V.instr_docs(spark, sf_dir))).withColumn("_key", clean.dedupe_key())
    r = splits.split_overlap_summary(s, "_key")
    return r.select(F.col("n_leaking_keys").cast("long"), F.col("n_leaking_rows").cast("long"))


@register(
    "group_split",
    f"""SELECT doc_id, source, CASE WHEN u < 0.15::DOUBLE THEN 'test' WHEN u < 0.3::DOUBLE THEN 'val' ELSE 'train' END AS split FROM (
  SELECT doc_id, source, ('0x' || substr({S.md5_key(42, 'source')}, 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents)""",
)
def q_group_split(spark, sf_dir):
    d = V.scan_parquet(spark, sf_dir, "documents").select("doc_id", "source")
    return splits.group_split(d, "source", 0.15, 0.15).select("doc_id", "source", "split")


@register(
    "seeded_shuffle",
    f"SELECT doc_id AS row_id, (row_number() OVER (ORDER BY {S.md5_key(42, 'doc_id')}, doc_id) - 1)::BIGINT AS position FROM documents",
)
def q_seeded_shuffle(spark, sf_dir):
    """Every row's place in the seeded order."""
    return splits.seeded_shuffle(doc_ids(spark, sf_dir), rank_col="position").select("row_id", "position")


@register("spot_check", S.with_(*PREPARED_CTES[:4]) + f"SELECT row_id, text FROM rendered ORDER BY {S.md5_key(42, 'row_id')}, row_id LIMIT 20")
def q_spot_check(spark, sf_dir):
    rows = clean.dedupe_exact(clean.clean_rows(V.instr_docs(spark, sf_dir)))
    return splits.spot_check(chat.render_fallback(rows).select("row_id", "text"), 20)


@register("head_sample", S.with_(*PRED_CTES) + "SELECT row_id, question, reference FROM predictions ORDER BY row_id LIMIT 20")
def q_head_sample(spark, sf_dir):
    return splits.head_sample(V.predictions(spark, sf_dir).select("row_id", "question", "reference"), 20)


# ---------------------------------------------------------------- H: remaining aggregations


@register(
    "length_histogram",
    S.with_(*WHOLE_CTES) + "SELECT (n_tokens // 64)::BIGINT AS bin, (n_tokens // 64 * 64)::BIGINT AS bin_start, count(*)::BIGINT AS n_rows FROM toklen GROUP BY ALL",
)
def q_length_histogram(spark, sf_dir):
    h = stats.length_histogram(whole(spark, sf_dir), "n_tokens", 64)
    return h.select("bin", F.col("bin_start").cast("long"), F.col("n_rows").cast("long"))


@register(
    "metric_means",
    S.with_(*MODEL_CTES) + "SELECT model, count(*)::BIGINT AS n, round(avg(em), 6) AS exact_match, round(avg(f1), 6) AS token_f1 FROM scored_models GROUP BY model",
)
def q_metric_means(spark, sf_dir):
    m = stats.metric_means(scored_models(spark, sf_dir), ["model"])
    return m.select("model", F.col("n").cast("long"), round6("exact_match").alias("exact_match"), round6("token_f1").alias("token_f1"))


@register(
    "judge_summary",
    S.with_(*MODEL_CTES)
    + "SELECT model, count(*)::BIGINT AS n, round(avg(judge), 6) AS mean_score, "
    + ", ".join(f"count(*) FILTER (WHERE judge = {s})::BIGINT AS n_score_{s}" for s in range(1, 6))
    + " FROM scored_models GROUP BY model",
)
def q_judge_summary(spark, sf_dir):
    j = stats.judge_summary(scored_models(spark, sf_dir), "judge", ["model"])
    return j.select("model", F.col("n").cast("long"), round6("mean_score").alias("mean_score"), *[F.col(f"n_score_{s}").cast("long") for s in range(1, 6)])


@register(
    "corpus_perplexity",
    S.with_(S.SCORED)
    + """SELECT count(*)::BIGINT AS n_texts, sum(n_tokens)::BIGINT AS n_tokens, round(sum(nll * n_tokens) / greatest(sum(n_tokens), 1), 6) AS mean_nll,
       round(exp(sum(nll * n_tokens) / greatest(sum(n_tokens), 1)), 6) AS perplexity FROM scored""",
)
def q_corpus_perplexity(spark, sf_dir):
    p = stats.corpus_perplexity(V.scored_texts(spark, sf_dir))
    return p.select(F.col("n_texts").cast("long"), F.col("n_tokens").cast("long"), round6("mean_nll").alias("mean_nll"), round6("perplexity").alias("perplexity"))


@register(
    "sliced_metrics",
    """SELECT lang, source, GROUPING(lang, source)::BIGINT AS grouping_id, count(*)::BIGINT AS n, round(avg(quality), 6) AS quality,
       round(avg(toxic), 6) AS toxic FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (lang, source)""",
)
def q_sliced_metrics(spark, sf_dir):
    d = V.scan_parquet(spark, sf_dir, "documents").join(V.scan_parquet(spark, sf_dir, "labels"), "doc_id")
    m = stats.sliced_metrics(d, ["lang", "source"], {"quality": F.col("quality"), "toxic": F.col("toxic")})
    return m.select("lang", "source", F.col("grouping_id").cast("long"), F.col("n").cast("long"), round6("quality").alias("quality"), round6("toxic").alias("toxic"))


@register(
    "metric_uncertainty",
    S.with_(*MODEL_CTES)
    + """SELECT model, count(f1)::BIGINT AS n, round(avg(f1), 6) AS mean, round(stddev_samp(f1) / sqrt(count(f1)), 6) AS std_error,
       round(avg(f1) - 1.959963984540054 * stddev_samp(f1) / sqrt(count(f1)), 6) AS ci_low,
       round(avg(f1) + 1.959963984540054 * stddev_samp(f1) / sqrt(count(f1)), 6) AS ci_high FROM scored_models GROUP BY model""",
)
def q_metric_uncertainty(spark, sf_dir):
    u = stats.metric_uncertainty(scored_models(spark, sf_dir), "f1", ["model"])
    return u.select("model", F.col("n").cast("long"), *[round6(c).alias(c) for c in ("mean", "std_error", "ci_low", "ci_high")])


# ---------------------------------------------------------------- A: remaining sources and sinks

from tunesmith.session import shared_scratch, stored_once  # noqa: E402
from tunesmith.sources import io  # noqa: E402


@register("read_jsonl", S.with_(S.INSTR_DOCS) + "SELECT row_id, instruction, input, output FROM instr_docs")
def q_read_jsonl(spark, sf_dir):
    """A1 + A2: rows written as JSON lines to the shared folder, then read back strictly."""
    rows = V.instr_docs(spark, sf_dir).select("row_id", "instruction", "input", "output")
    path = io.write_jsonl(rows, shared_scratch(spark, "jsonl"))
    return io.read_jsonl(spark, path).select("row_id", "instruction", "input", "output")


@register("read_jsonl_rows", S.with_(S.INSTR_DOCS) + "SELECT instruction, input, output, lang, count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_ids FROM instr_docs GROUP BY ALL")
def q_read_jsonl_rows(spark, sf_dir):
    """A1: files without ids and with a further key; every row gets an id of its own."""
    rows = V.instr_docs(spark, sf_dir).select("instruction", "input", "output", "lang")
    back = io.read_jsonl_rows(spark, io.write_jsonl(rows, shared_scratch(spark, "jsonl")))
    grouped = back.groupBy("instruction", "input", "output", "lang")
    return grouped.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))


@register(
    "quarantine_jsonl",
    S.with_(S.INSTR_DOCS) + "SELECT row_id, false AS is_corrupt FROM instr_docs WHERE row_id % 50 <> 0 UNION ALL SELECT -1 AS row_id, true AS is_corrupt FROM instr_docs WHERE row_id % 50 = 0",
)
def q_quarantine_jsonl(spark, sf_dir):
    """A1 with quarantine: every 50th line is cut short; such lines are kept apart, not dropped."""
    rows = V.instr_docs(spark, sf_dir).select("row_id", "instruction", "input", "output")
    line = F.to_json(F.struct("row_id", "instruction", "input", "output"))
    path = shared_scratch(spark, "jsonl-bad")
    rows.select(F.when(F.col("row_id") % 50 == 0, F.substring(line, 1, 5)).otherwise(line).alias("value")).write.text(path)
    back = io.read_jsonl(spark, path, quarantine=True)
    return back.select(F.coalesce("row_id", F.lit(-1)).alias("row_id"), F.col(io.CORRUPT_COL).isNotNull().alias("is_corrupt"))


@register(
    "write_jsonl",
    S.with_(S.INSTR_DOCS, S.RENDERED_ALL) + "SELECT row_id, text, lang, NULL::VARCHAR AS note FROM rendered",
)
def q_write_jsonl(spark, sf_dir):
    """A2: nulls are written as JSON null (not dropped) and read back as null."""
    out = chat.render_fallback(V.instr_docs(spark, sf_dir)).select("row_id", "text", "lang", F.lit(None).cast("string").alias("note"))
    path = io.write_jsonl(out, shared_scratch(spark, "jsonl"))
    import pyspark.sql.types as T

    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("note", T.StringType())])
    return io.read_jsonl(spark, path, schema).select("row_id", "text", "lang", "note")


@register("load_sample_dataset", S.with_(S.INSTR_DOCS, S.two_way("instr_docs")) + "SELECT row_id, split FROM split2")
def q_load_sample_dataset(spark, sf_dir):
    return io.load_sample_dataset(V.instr_docs(spark, sf_dir), 0.2, 42).select("row_id", "split")


@register("load_preference_dataset", S.with_(*PREF_CTES, VALID_PREFS, S.two_way("valid")) + "SELECT row_id, split FROM split2")
def q_load_preference_dataset(spark, sf_dir):
    return io.load_preference_dataset(V.preferences(spark, sf_dir)).select("row_id", "split")


@register(
    "save_splits",
    S.with_(*PREPARED_CTES[:4], S.three_way("rendered")) + "SELECT split, count(*)::BIGINT AS n_rows, sum(length(text))::BIGINT AS total_chars FROM split3 GROUP BY split",
)
def q_save_splits(spark, sf_dir):
    rows = clean.dedupe_exact(clean.clean_rows(V.instr_docs(spark, sf_dir)))
    s = splits.split_three_way(chat.render_fallback(rows))
    path = io.save_splits(s, shared_scratch(spark, "splits"))
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("n_rows"), F.sum(F.length("text")).cast("long").alias("total_chars"))


@register(
    "write_shards",
    S.with_(S.INSTR_DOCS)
    + f"SELECT (_rk % 4)::BIGINT AS shard, count(*)::BIGINT AS n_rows, sum(row_id)::BIGINT AS id_sum FROM (SELECT row_id, row_number() OVER (ORDER BY {S.md5_key(42, 'row_id')}, row_id) - 1 AS _rk FROM instr_docs) GROUP BY shard",
)
def q_write_shards(spark, sf_dir):
    rows = V.instr_docs(spark, sf_dir).select("row_id", "instruction", "output")
    path = io.write_shards(rows, shared_scratch(spark, "shards"), 4)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("shard").cast("long").alias("shard")).agg(F.count(F.lit(1)).cast("long").alias("n_rows"), F.sum("row_id").cast("long").alias("id_sum"))


# ---------------------------------------------------------------- C: near duplicates

from tunesmith.operators import neardup  # noqa: E402

NEARDUP_CTES = [
    f"""g AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
                  ELSE [array_to_string(w, ' ')] END AS grams
  FROM (SELECT doc_id, {S.split_ws('lower(text)')} AS w FROM documents))""",
    "sg AS (SELECT doc_id, grams, sha256(array_to_string(list_sort(grams), chr(1))) AS sig FROM g)",
    "reps AS (SELECT sig, min(doc_id) AS rep, min_by(grams, doc_id) AS grams FROM sg GROUP BY sig)",
    """pairs AS (SELECT id_a, id_b, inter, na + nb - inter AS uni FROM (
  SELECT a.rep AS id_a, b.rep AS id_b, len(a.grams) AS na, len(b.grams) AS nb, len(list_intersect(a.grams, b.grams)) AS inter
  FROM reps a JOIN reps b ON a.rep < b.rep AND 5 * least(len(a.grams), len(b.grams)) >= 4 * greatest(len(a.grams), len(b.grams)))
  WHERE 5 * inter >= 4 * (na + nb - inter))""",
]


def _docs(spark, sf_dir):
    return V.scan_parquet(spark, sf_dir, "documents")


@register(
    "near_dup_pairs",
    S.with_(*NEARDUP_CTES) + "SELECT id_a, id_b, inter::BIGINT AS inter, uni::BIGINT AS \"union\", round(inter / uni, 6) AS jaccard FROM pairs",
)
def q_near_dup_pairs(spark, sf_dir):
    p = neardup.near_dup_pairs(_docs(spark, sf_dir))
    return p.select("id_a", "id_b", F.col("inter").cast("long"), F.col("union").cast("long"), round6("jaccard").alias("jaccard"))


@register(
    "near_dup_links",
    S.with_(
        *NEARDUP_CTES,
        "n AS (SELECT rep, count(*) AS copies FROM sg JOIN reps USING (sig) GROUP BY rep)",
        "e AS (SELECT id_a AS x, id_b AS y FROM pairs UNION ALL SELECT id_b, id_a FROM pairs)",
        "l AS (SELECT x AS rep, sum(n.copies) AS links FROM e JOIN n ON n.rep = e.y GROUP BY x)",
    )
    + """SELECT sg.doc_id, n.rep, n.copies::BIGINT AS copies, (n.copies - 1 + coalesce(l.links, 0))::BIGINT AS n_links
FROM sg JOIN reps USING (sig) JOIN n ON n.rep = reps.rep LEFT JOIN l ON l.rep = n.rep""",
)
def q_near_dup_links(spark, sf_dir):
    """C3, one row for each document."""
    return neardup.near_dup_links(_docs(spark, sf_dir))


@register("near_dup_minhash")
def q_near_dup_minhash(spark, sf_dir):
    """Approximate candidates, exact verification: a subset of near_dup_pairs (``near_dup_recall`` says how much of it)."""
    p = neardup.near_dup_minhash(_docs(spark, sf_dir))
    return p.select("id_a", "id_b", round6("jaccard").alias("jaccard"))


@register(
    "near_dup_recall",
    S.with_(*NEARDUP_CTES) + "SELECT count(*)::BIGINT AS n_pairs, true AS recall_ok, 0::BIGINT AS n_wrong FROM pairs",
)
def q_near_dup_recall(spark, sf_dir):
    """C4 against C3: whether MinHash finds at least 0.9 of the pairs, and how many pairs it reports that are none."""
    docs = _docs(spark, sf_dir)
    reps, _ = neardup.collapse_copies(neardup.gram_sets(docs))  # once for both
    exact = stored_once(neardup.near_dup_pairs(docs, reps=reps).select("id_a", "id_b"), "near-dup-exact")
    found = neardup.near_dup_minhash(docs, reps=reps).select("id_a", "id_b", F.lit(1).alias("found"))
    both = exact.withColumn("exact", F.lit(1)).join(found, ["id_a", "id_b"], "full")
    n, hit = F.sum(F.coalesce("exact", F.lit(0))), F.count_if(F.col("exact").isNotNull() & F.col("found").isNotNull())
    return both.agg(F.coalesce(n, F.lit(0)).cast("long").alias("n_pairs"), (hit >= F.lit(0.9) * F.coalesce(n, F.lit(0))).alias("recall_ok"), F.count_if(F.col("exact").isNull()).cast("long").alias("n_wrong"))


@register(
    "near_dup_clusters",
    "WITH RECURSIVE "
    + ",\n".join(NEARDUP_CTES)
    + """,
edges AS (SELECT id_a AS src, id_b AS dst FROM pairs UNION ALL SELECT id_b AS src, id_a AS dst FROM pairs),
cc(node, label) AS (SELECT rep, rep FROM reps UNION SELECT e.dst, cc.label FROM cc JOIN edges e ON e.src = cc.node),
lab AS (SELECT node AS rep, min(label) AS label FROM cc GROUP BY node)
SELECT sg.doc_id, lab.label AS cluster_id, sg.doc_id = lab.label AS keep FROM sg JOIN reps USING (sig) JOIN lab ON lab.rep = reps.rep""",
)
def q_near_dup_clusters(spark, sf_dir):
    return neardup.near_dup_clusters(_docs(spark, sf_dir)).select("doc_id", "cluster_id", "keep")


# ---------------------------------------------------------------- K, M: batch inference and plug-ins

from tunesmith.operators import infer, serving  # noqa: E402


@register("batch_generate", S.with_(S.INSTR_TURNS) + "SELECT row_id, instruction AS reply FROM instr_turns")
def q_batch_generate(spark, sf_dir):
    prompts = chat.render_generation_prompt(turn_messages(spark, sf_dir), chat.CHATML).select("row_id", "prompt")
    return infer.batch_generate(prompts, infer.echo_model()).select("row_id", "reply")


@register(
    "udf_generate",
    """SELECT a.conv_id, a.turn, coalesce(max_by(u.text, u.turn), '') AS reply
FROM conversations a LEFT JOIN conversations u ON u.conv_id = a.conv_id AND u.turn < a.turn AND u.role = 'user'
WHERE a.role = 'assistant' GROUP BY a.conv_id, a.turn""",
)
def q_udf_generate(spark, sf_dir):
    """M3: a generate plug-in over multi-turn histories (each assistant turn's context)."""
    h = chat.history_per_turn(V.turns(spark, sf_dir)).withColumnRenamed("history", "messages")
    prompts = chat.render_generation_prompt(h, chat.CHATML).select("conv_id", "turn", "prompt")
    return infer.batch_generate(prompts, infer.echo_model()).select("conv_id", "turn", "reply")


@register(
    "strip_prompt",
    S.with_(*ENCODED_CTES)
    + """SELECT e.row_id, coalesce(array_to_string(list(v.token ORDER BY e.pos) FILTER (WHERE e.id >= 4), ' '), '') AS reply FROM (
  SELECT row_id, unnest(ids) AS id, unnest(generate_series(1, len(ids))) AS pos FROM enc) e JOIN vocab v USING (id) GROUP BY e.row_id""",
)
def q_strip_prompt(spark, sf_dir):
    """Generated sequence = prompt ids, the same once more, then [eos, pad, pad]; strip and decode the new part."""
    e, vocab = encoded_and_vocab(spark, sf_dir)
    e = e.withColumnRenamed("input_ids", "prompt_ids")
    e = e.withColumn("output_ids", F.concat("prompt_ids", F.col("prompt_ids"), F.array(F.lit(tokens.EOS_ID), F.lit(tokens.PAD_ID), F.lit(tokens.PAD_ID))))
    return infer.strip_and_decode(e, vocab, ids_source=doc_ids(spark, sf_dir)).select("row_id", "reply")


@register(
    "throughput",
    S.with_(S.REQUESTS)
    + "SELECT adapter, count(*)::BIGINT AS n, sum(tokens)::BIGINT AS tokens, round(sum(latency), 6) AS elapsed, round(sum(tokens) / greatest(sum(latency), 1e-6), 6) AS tokens_per_sec FROM requests GROUP BY adapter",
)
def q_throughput(spark, sf_dir):
    t = infer.throughput(V.requests(spark, sf_dir), F.col("tokens"), F.col("latency"), ["adapter"])
    return t.select("adapter", F.col("n").cast("long"), F.col("tokens").cast("long"), round6("elapsed").alias("elapsed"), round6("tokens_per_sec").alias("tokens_per_sec"))


@register(
    "throughput_non_pad",
    S.with_(*ENCODED_CTES, S.TRUNC_PAD)
    + """SELECT batch_id::BIGINT AS batch_id, count(*)::BIGINT AS n, sum(L)::BIGINT AS padded_tokens, sum(list_sum(mask))::BIGINT AS tokens, round(sum(L) / 1000, 6) AS elapsed,
       round(sum(list_sum(mask)) / greatest(sum(L) / 1000, 1e-6), 6) AS tokens_per_sec FROM padded GROUP BY batch_id""",
)
def q_throughput_non_pad(spark, sf_dir):
    """K3 without pad tokens: a batch takes a millisecond for each position; only positions that aren't padding count as tokens."""
    p = padded_batch(spark, sf_dir).withColumn("_real", F.aggregate("attention_mask", F.lit(0).cast("long"), lambda a, x: a + x))
    t = infer.throughput(p, F.col("_real"), F.col("padded_length") / 1000, ["batch_id"]).withColumnRenamed("batch_id", "_batch")
    all_positions = p.groupBy("batch_id").agg(F.sum("padded_length").alias("padded_tokens"))
    t = t.join(all_positions, F.col("_batch") == F.col("batch_id"))
    return t.select(F.col("batch_id").cast("long"), F.col("n").cast("long"), F.col("padded_tokens").cast("long"), F.col("tokens").cast("long"), round6("elapsed").alias("elapsed"), round6("tokens_per_sec").alias("tokens_per_sec"))


ADAPTERS = ("view", "click", "purchase")


@register(
    "route_by_adapter",
    S.with_(S.REQUESTS)
    + f"""SELECT event_id, CASE WHEN adapter IN {tuple(ADAPTERS)} THEN adapter ELSE 'base' END AS adapter_used,
       (CASE WHEN adapter IN {tuple(ADAPTERS)} THEN adapter ELSE 'base' END) || ':' || CAST(user_id AS VARCHAR) AS reply FROM requests""",
)
def q_route_by_adapter(spark, sf_dir):
    r = V.requests(spark, sf_dir).select("event_id", "adapter", F.col("user_id").cast("string").alias("prompt"))
    out = infer.route_by_adapter(r, {a: infer.tagged_model(a) for a in ADAPTERS}, infer.tagged_model("base"))
    return out.select("event_id", "adapter_used", "reply")


@register("udf_tokenizer", "SELECT doc_id, strlen(text)::BIGINT AS n_ids FROM documents")
def q_udf_tokenizer(spark, sf_dir):
    enc = infer.udf_tokenizer(infer.byte_tokenizer)
    d = V.scan_parquet(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(enc(F.col("text"))).cast("long").alias("n_ids"))


@register(
    "udf_judge",
    S.with_(S.INSTR_TURNS, S.TWO_MODELS)
    + "SELECT model, row_id, (1 + 4 * least(length(answer), length(reference)) // greatest(length(answer), length(reference), 1))::BIGINT AS judge FROM two_models",
)
def q_udf_judge(spark, sf_dir):
    j = infer.udf_judge(V.two_models(spark, sf_dir), infer.length_judge)
    return j.select("model", "row_id", F.col("judge").cast("long"))


@register(
    "template_registry",
    S.with_(S.INSTR_TURNS)
    + f"""SELECT row_id, 'chatml' AS template, {_chatml_sql(_lit('user'), 'instruction')} || {_chatml_sql(_lit('assistant'), 'output')} AS text FROM instr_turns
UNION ALL SELECT row_id, 'fallback' AS template, '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) || '### Response:' || chr(10) || output || '</s>' AS text FROM instr_turns""",
)
def q_template_registry(spark, sf_dir):
    m = turn_messages(spark, sf_dir)
    outs = []
    for name in ("chatml", None):
        t = chat.template_registry(name)
        r = chat.render_chat(m, t) if t is not None else chat.render_fallback(m)
        outs.append(r.select("row_id", F.lit(name or "fallback").alias("template"), "text"))
    return outs[0].unionByName(outs[1])


# ---------------------------------------------------------------- L: serving logs

HOUR_FMT = "yyyy-MM-dd HH:mm:ss"
US_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _serving_out(df):
    return df.select(
        F.date_format("window_start", HOUR_FMT).alias("window_start"), F.col("n_requests").cast("long"), F.col("n_errors").cast("long"),
        F.col("tokens").cast("long"), round6("latency_p99").alias("latency_p99"), round6("tokens_per_sec").alias("tokens_per_sec"),
    )


SERVING_AGG = """count(*)::BIGINT AS n_requests, count(*) FILTER (WHERE NOT ok)::BIGINT AS n_errors, sum(tokens)::BIGINT AS tokens,
       round(quantile_cont(latency, 0.99), 6) AS latency_p99, round(sum(tokens) / greatest(sum(latency), 1e-6), 6) AS tokens_per_sec"""


@register(
    "serving_metrics",
    S.with_(S.REQUESTS) + f"SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, {SERVING_AGG} FROM requests GROUP BY 1",
)
def q_serving_metrics(spark, sf_dir):
    return _serving_out(serving.serving_metrics(V.requests(spark, sf_dir), "1 hour"))


@register(
    "serving_sliding",
    S.with_(S.REQUESTS)
    + f"""SELECT strftime(date_trunc('hour', ts) - k * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_start, {SERVING_AGG}
FROM requests, range(6) r(k) GROUP BY 1""",
)
def q_serving_sliding(spark, sf_dir):
    return _serving_out(serving.serving_sliding(V.requests(spark, sf_dir), "6 hours", "1 hour"))


@register(
    "queue_depth",
    S.with_(
        S.REQUESTS,
        """ev AS (SELECT event_id, epoch_us(ts) AS t, 1 AS kind, 1 AS d FROM requests
  UNION ALL SELECT event_id, epoch_us(ts) + CAST(round(latency * 1000000) AS BIGINT) AS t, 0 AS kind, -1 AS d FROM requests)""",
    )
    + "SELECT event_id, depth::BIGINT AS depth FROM (SELECT event_id, kind, sum(d) OVER (ORDER BY t, kind, event_id ROWS UNBOUNDED PRECEDING) AS depth FROM ev) WHERE kind = 1",
)
def q_queue_depth(spark, sf_dir):
    return serving.queue_depth(V.requests(spark, sf_dir)).select("event_id", F.col("depth").cast("long"))


@register(
    "chat_sessions",
    S.with_(
        S.REQUESTS,
        """s AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                              OR ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM requests)""",
        "g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)",
    )
    + """SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS session_start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S.%f') AS session_end,
       count(*)::BIGINT AS n_requests FROM g GROUP BY user_id, sid""",
)
def q_chat_sessions(spark, sf_dir):
    s = serving.chat_sessions(V.requests(spark, sf_dir), "30 minutes")
    return s.select("user_id", F.date_format("session_start", US_FMT).alias("session_start"), F.date_format("session_end", US_FMT).alias("session_end"), F.col("n_requests").cast("long"))


# ---------------------------------------------------------------- streaming forms

from tunesmith.streaming import streams  # noqa: E402


@register("stream_jsonl", S.with_(S.INSTR_DOCS) + "SELECT row_id, instruction, input, output FROM instr_docs")
def q_stream_jsonl(spark, sf_dir):
    """Rows land as JSON-lines files; a file stream picks them up."""
    rows = V.instr_docs(spark, sf_dir).select("row_id", "instruction", "input", "output")
    src = io.write_jsonl(rows, shared_scratch(spark, "jsonl-in"))
    s = streams.stream_jsonl(spark, src, io.INSTRUCTION_SCHEMA)
    return streams.run_to_table(s, "stream-jsonl").select("row_id", "instruction", "input", "output")


@register(
    "stream_dedupe_windows",
    "SELECT DISTINCT user_id, event_type, props, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start FROM events",
)
def q_stream_dedupe_windows(spark, sf_dir):
    """C6 by fixed windows over four deliveries in time order: a key once in each hour, however the rows are cut into batches."""
    events = V.scan_parquet(spark, sf_dir, "events")
    out = streams.run_deliveries(streams.in_time_order(events, 4), lambda s: streams.stream_dedupe_windows(s, ["user_id", "event_type", "props"]), "stream-dedupe-windows")
    return out.select("user_id", "event_type", "props", F.date_format("window_start", HOUR_FMT).alias("window_start"))


@register(
    "stream_dedupe",
    """WITH RECURSIVE e AS (SELECT row_number() OVER () AS row, *, min(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts RANGE BETWEEN INTERVAL 6 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM events),
firsts AS (
  SELECT user_id, event_type, min(ts) AS ts FROM e WHERE ts IS NOT NULL GROUP BY ALL
  UNION
  SELECT e.user_id, e.event_type, e.after FROM firsts f JOIN e ON e.user_id IS NOT DISTINCT FROM f.user_id AND e.event_type IS NOT DISTINCT FROM f.event_type AND e.ts = f.ts WHERE e.after IS NOT NULL)
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, min(event_id) AS event_id FROM firsts JOIN events USING (user_id, event_type, ts) GROUP BY ALL
UNION ALL SELECT user_id, event_type, NULL, event_id FROM events WHERE ts IS NULL""",
)
def q_stream_dedupe(spark, sf_dir):
    """C6 over four deliveries in time order: a user's first event of a type, then none of it for six hours."""
    events = V.scan_parquet(spark, sf_dir, "events")
    parts = [*streams.in_time_order(events, 4), streams.closing_row(events, "ts", "2 days")]
    out = streams.run_deliveries(parts, lambda s: streams.stream_dedupe(s, ["user_id", "event_type"], hold_seconds=6 * 3600), "stream-dedupe")
    return out.select("user_id", "event_type", F.date_format("ts", US_FMT).alias("ts"), "event_id")


@register(
    "stream_serving_metrics",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*)::BIGINT AS n_requests,
       count(*) FILTER (WHERE event_type = 'error')::BIGINT AS n_errors, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS tokens,
       round(sum(value), 6) AS latency_sum, round(max(value), 6) AS latency_max,
       round(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) / greatest(sum(value), 1e-6), 6) AS tokens_per_sec, true AS p99_within
FROM events GROUP BY date_trunc('hour', ts)""",
)
def q_stream_serving_metrics(spark, sf_dir):
    """L5 over five deliveries; the 99th percentiles of its sketches are held against exact ranks of the log."""
    events = V.scan_parquet(spark, sf_dir, "events")
    r = streams.run_deliveries([*streams.in_time_order(events, 4), streams.closing_row(events, "ts", "1 day")], streams.stream_serving_metrics, "stream-serving")
    asked = r.select("window_start", F.lit(0.99).alias("prob"), F.col("latency_p99").alias("value"))
    log = events.select(F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("window_start"), F.col("value").alias("latency"))
    held = stats.within_rank(log, asked, "latency", ["window_start"]).select("window_start", F.col("within").alias("p99_within"))
    return r.join(held, "window_start").select(
        F.date_format("window_start", HOUR_FMT).alias("window_start"), F.col("n_requests").cast("long"), F.col("n_errors").cast("long"),
        F.col("tokens").cast("long"), round6("latency_sum").alias("latency_sum"), round6("latency_max").alias("latency_max"),
        round6("tokens_per_sec").alias("tokens_per_sec"), "p99_within",
    )


@register(
    "stream_chat_history",
    """SELECT conv_id, count(*)::BIGINT AS n_messages, max(turn)::BIGINT AS last_turn, max_by(role, turn) AS last_role, string_agg(role, ',' ORDER BY turn) AS roles
FROM conversations GROUP BY conv_id""",
)
def q_stream_chat_history(spark, sf_dir):
    """L6 over five deliveries in time order: the histories as the idle timeout closes them."""
    turns = V.chat_log(spark, sf_dir)
    parts = [*streams.in_time_order(turns, 4), streams.closing_row(turns, "ts", "1 day")]
    r = streams.run_deliveries(parts, streams.stream_chat_history, "stream-history")
    return r.filter("closed").select("conv_id", F.col("n_messages").cast("long"), F.col("last_turn").cast("long"), "last_role", "roles")


@register(
    "length_quantiles",
    f"WITH t AS (SELECT lang, len({S.tokenize('text')}) AS n_tokens FROM documents) SELECT lang, prob, count(n_tokens)::BIGINT AS n_rows, true AS within FROM t, (VALUES (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) v(prob) GROUP BY lang, prob",
)
def q_length_quantiles(spark, sf_dir):
    """H2: quantiles of token lengths by language from sketches, held against exact ranks."""
    rows = whole(spark, sf_dir)
    q = stats.length_quantiles(rows, "n_tokens", group_cols=["lang"])
    held = stats.within_rank(rows, q.drop("n_rows"), "n_tokens", ["lang"])
    return q.join(held.select(F.col("lang").alias("_lang"), F.col("prob").alias("_prob"), "within"), F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("prob") == F.col("_prob"))).select("lang", "prob", F.col("n_rows").cast("long"), "within")


# ---------------------------------------------------------------- H7: bootstrap

_POISSON = " ".join(f"WHEN u < {sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))!r}::DOUBLE THEN {k}" for k in range(9))
BOOTSTRAP_CTES = [
    f"""boot AS (SELECT lang, rep, sum(w * m) / sum(w) AS mean FROM (
  SELECT lang, rep, m, CASE {_POISSON} ELSE 9 END AS w FROM (
    SELECT lang, rep, n_chars::DOUBLE AS m, ('0x' || substr(md5('42|' || rep || '|' || doc_id), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents, range(100) r(rep)))
GROUP BY lang, rep HAVING sum(w) > 0)"""
]


@register("bootstrap_means", S.with_(*BOOTSTRAP_CTES) + "SELECT lang, rep::BIGINT AS rep, round(mean, 6) AS mean FROM boot")
def q_bootstrap_means(spark, sf_dir):
    """H7: mean characters by language in a hundred replicates."""
    b = stats.bootstrap_means(_docs(spark, sf_dir), "n_chars", "doc_id", 100, 42, ["lang"])
    return b.select("lang", F.col("rep").cast("long"), round6("mean").alias("mean"))


@register(
    "bootstrap_interval",
    S.with_(*BOOTSTRAP_CTES) + "SELECT lang, count(mean)::BIGINT AS n_boot, round(quantile_cont(mean, 0.025), 6) AS ci_low, round(quantile_cont(mean, 0.975), 6) AS ci_high FROM boot GROUP BY lang",
)
def q_bootstrap_interval(spark, sf_dir):
    b = stats.bootstrap_interval(_docs(spark, sf_dir), "n_chars", "doc_id", 100, 42, ["lang"])
    return b.select("lang", F.col("n_boot").cast("long"), round6("ci_low").alias("ci_low"), round6("ci_high").alias("ci_high"))
