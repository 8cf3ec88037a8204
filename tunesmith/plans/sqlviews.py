"""DuckDB twins of the Spark views and helpers, used only by the oracle SQL.

Each helper returns an SQL snippet; the constants are built from the same fixed
values as the Spark side (tunesmith.functions.text) so both engines use one set.
"""

from __future__ import annotations

from tunesmith.functions.text import ASCII_PUNCTUATION, TOKEN_PATTERN, WHITESPACE_CLASS, WHITESPACE_CODEPOINTS

WS_CHARS = "(" + " || ".join(f"chr({c})" for c in WHITESPACE_CODEPOINTS) + ")"
PUNCT = "'" + ASCII_PUNCTUATION.replace("'", "''") + "'"
WS_RE = "'" + WHITESPACE_CLASS + "+'"
TOKEN_RE = "'" + TOKEN_PATTERN + "'"
NL = "chr(10)"
COALESCED_INPUT = "coalesce(input, '')"


def ustrip(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def normalize(x: str) -> str:
    return f"regexp_replace(translate({ustrip(f'lower({x})')}, {PUNCT}, ''), {WS_RE}, ' ', 'g')"


def split_ws(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {WS_RE}), lambda w: w <> '')"


def tokenize(x: str) -> str:
    return f"regexp_extract_all({x}, {TOKEN_RE})"


def ids_text(x: str) -> str:
    return f"array_to_string({x}, ',')"


def md5_key(seed, id_expr: str) -> str:
    return f"md5(concat_ws('|', '{seed}', CAST({id_expr} AS VARCHAR)))"


INSTR_DOCS = f"""instr_docs AS (
  SELECT doc_id AS row_id,
         CASE WHEN instr(text, {NL}) > 0 THEN substr(text, 1, instr(text, {NL}) - 1) ELSE text END AS instruction,
         '' AS input,
         CASE WHEN instr(text, {NL}) > 0 THEN substr(text, instr(text, {NL}) + 1) ELSE '' END AS output,
         lang, source
  FROM documents)"""

CLEANED = f"""cleaned AS (
  SELECT row_id, {ustrip('instruction')} AS instruction, {ustrip("coalesce(input, '')")} AS input,
         {ustrip('output')} AS output, lang, source
  FROM instr_docs
  WHERE instruction IS NOT NULL AND instruction <> '' AND output IS NOT NULL AND output <> ''
    AND length({ustrip('output')}) BETWEEN 1 AND 8000)"""

DEDUPED = """deduped AS (
  SELECT row_id, instruction, input, output, lang, source FROM (
    SELECT *, row_number() OVER (PARTITION BY sha256(instruction || '||' || input || '||' || output) ORDER BY row_id) AS _rn
    FROM cleaned) WHERE _rn = 1)"""

USER_CONTENT = f"CASE WHEN coalesce(input, '') <> '' THEN instruction || {NL} || {NL} || input ELSE instruction END"

RENDERED = f"""rendered AS (
  SELECT *, '### Instruction:' || {NL} || ({USER_CONTENT}) || {NL} || {NL} || '### Response:' || {NL} || output || '</s>' AS text
  FROM deduped)"""

TOKLEN = f"""toklen AS (SELECT *, len({tokenize('text')})::BIGINT AS n_tokens FROM rendered)"""


def three_way(src: str, seed=42, val=0.15, test=0.15, name="split3") -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN _rk < floor(_n * {test}::DOUBLE) THEN 'test'
                 WHEN _rk < floor(_n * {test}::DOUBLE) + floor(_n * {val}::DOUBLE) THEN 'val'
                 ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY {md5_key(seed, 'row_id')}, row_id) - 1 AS _rk, count(*) OVER () AS _n FROM {src}))"""


def two_way(src: str, seed=42, test=0.2, name="split2", id_col="row_id") -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN _rk < ceil(_n * {test}::DOUBLE) THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY {md5_key(seed, id_col)}, {id_col}) - 1 AS _rk, count(*) OVER () AS _n FROM {src}))"""


INSTR_TURNS = """instr_turns AS (
  SELECT u.conv_id * 4294967296 + u.turn AS row_id, u.conv_id, u.turn, u.text AS instruction, '' AS input, a.text AS output
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

EDITED = """CASE WHEN row_id % 7 = 0 THEN ''
     WHEN row_id % 5 = 0 THEN lower(output) || ' !'
     ELSE array_to_string(list_filter(string_split(output, ' '), lambda x, i: i % 4 <> 0), ' ') END"""

PREDICTIONS = f"""predictions AS (
  SELECT row_id, instruction AS question, output AS reference, {EDITED} AS answer FROM instr_turns)"""

PREFERENCES = f"""preferences AS (
  SELECT row_id, instruction AS prompt, output AS chosen, {EDITED} AS rejected FROM instr_turns)"""

LOGPROBS = """logprobs AS (
  SELECT event_id AS row_id, -(value / 10.0) AS pi_chosen, -((value + event_id % 13) / 10.0) AS pi_rejected,
         -((value + event_id % 5) / 10.0) AS ref_chosen, -((value + event_id % 3) / 10.0) AS ref_rejected,
         CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS n_tokens
  FROM events)"""

SCORED = """scored AS (
  SELECT event_id AS row_id, value / 20.0 AS nll, CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS n_tokens FROM events)"""

REQUESTS = """requests AS (
  SELECT event_id, ts, user_id, event_type AS adapter, value AS latency,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS tokens, event_type <> 'error' AS ok
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


WHOLE = f"""toklen AS (SELECT doc_id AS row_id, text, lang, source, len({tokenize('text')})::BIGINT AS n_tokens FROM documents)"""

RENDERED_ALL = RENDERED.replace("FROM deduped", "FROM instr_docs")

TOK = f"""tok AS (SELECT row_id, lang, source, text, n_tokens, {tokenize('text')} AS tokens FROM toklen)"""

VOCAB = f"""vocab AS (
  SELECT token, id, n FROM (
    SELECT token, (row_number() OVER (ORDER BY n DESC, token) + 3)::INTEGER AS id, n::BIGINT AS n
    FROM (SELECT token, count(*) AS n FROM (SELECT unnest(tokens) AS token FROM tok) GROUP BY token))
  UNION ALL SELECT * FROM (VALUES ('<pad>', 0, 0::BIGINT), ('<s>', 1, 0::BIGINT), ('</s>', 2, 0::BIGINT), ('<unk>', 3, 0::BIGINT)) v(token, id, n))"""

ENC = """enc AS (
  SELECT t.row_id, list(coalesce(v.id, 3) ORDER BY t.pos) AS ids FROM (
    SELECT row_id, unnest(tokens) AS token, unnest(generate_series(1, len(tokens))) AS pos FROM tok) t
  LEFT JOIN vocab v USING (token) GROUP BY t.row_id)"""

TRUNC_PAD = """trunc AS (SELECT row_id, row_id // 16 AS batch_id, ids FROM enc),
padded AS (
  SELECT row_id, batch_id, L,
         ids || list_transform(range(L - len(ids)), lambda x: 2) AS ids,
         list_transform(range(len(ids)), lambda x: 1) || list_transform(range(L - len(ids)), lambda x: 0) AS mask
  FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS L FROM trunc))"""

CANDIDATE = """CASE WHEN row_id % 3 = 0 THEN '' ELSE array_to_string(list_filter(string_split(output, ' '), lambda x, i: i % 2 = 1), ' ') END"""

TWO_MODELS = f"""two_models AS (
  SELECT 'baseline' AS model, row_id, instruction AS question, output AS reference, {EDITED} AS answer FROM instr_turns
  UNION ALL
  SELECT 'candidate' AS model, row_id, instruction AS question, output AS reference, {CANDIDATE} AS answer FROM instr_turns)"""


def words(x: str) -> str:
    return split_ws(normalize(x))


def f1_of(p: str, r: str) -> str:
    """F1 over two word-list columns p, r."""
    ov = f"coalesce(list_sum(list_transform(list_distinct({p}), lambda t: least(len(list_filter({p}, lambda x: x = t)), len(list_filter({r}, lambda x: x = t))))), 0)"
    return f"""(CASE WHEN len({p}) = 0 OR len({r}) = 0 THEN CASE WHEN len({p}) = len({r}) THEN 1.0 ELSE 0.0 END
      WHEN {ov} = 0 THEN 0.0
      ELSE 2 * ({ov} / len({p})) * ({ov} / len({r})) / (({ov} / len({p})) + ({ov} / len({r}))) END)"""


def judge_of(reference: str, answer: str) -> str:
    ref = f"list_distinct({split_ws(f'lower({reference})')})"
    ans = f"list_distinct({split_ws(f'lower({answer})')})"
    ov = f"(len(list_intersect({ref}, {ans})) / len({ref}))"
    return f"""(CASE WHEN length({ustrip(answer)}) = 0 THEN 1 WHEN len({ref}) = 0 THEN 3
      WHEN {ov} >= 0.6::DOUBLE THEN 5 WHEN {ov} >= 0.3::DOUBLE THEN 4 WHEN {ov} >= 0.1::DOUBLE THEN 3 ELSE 2 END)"""


SCORED_MODELS = f"""scored_models AS (
  SELECT *, (({normalize('answer')}) = ({normalize('reference')}))::DOUBLE AS em, {f1_of('_p', '_r')} AS f1, {judge_of('reference', 'answer')} AS judge
  FROM (SELECT *, {words('answer')} AS _p, {words('reference')} AS _r FROM two_models))"""
