"""Conversations: validation, rendering, adapters, generators, tool calls."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardloom.operators import audit, chat, tasks
from shardloom.operators.requests import validate_requests
from shardloom.plans import inputs
from shardloom.plans import sqltext as sq
from shardloom.plans.registry import query, table

BASE = 256 + sq.N_MERGES
_JOIN = lambda c: F.array_join(c.cast("array<string>"), " ")


def _turns(spark, sf_dir):
    return table(spark, sf_dir, "conversations")


@query(
    "conv_assemble",
    """SELECT conv_id, count(*)::INT AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
md5(string_agg(text, chr(30) ORDER BY turn)) AS digest FROM conversations GROUP BY conv_id""",
)
def conv_assemble(spark, sf_dir):
    rows = chat.assemble(_turns(spark, sf_dir))
    return rows.select(
        "conv_id", F.size("messages").alias("n_messages"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["parts"][0]["text"]), "\x1e")).alias("digest"),
    )


def _damaged(spark, sf_dir):
    """Faults without dropped turns: one role changed, a text emptied, roles missing.

    Turn numbers start at 3 and leave gaps, so only their order counts.
    """
    turns = _turns(spark, sf_dir)
    role = F.when((F.col("conv_id") % 5 == 0) & (F.col("turn") == 2), "assistant").otherwise(F.col("role"))
    text = F.when((F.col("conv_id") % 11 == 0) & (F.col("turn") == 1), F.lit(None)).otherwise(F.col("text"))
    role = F.when((F.col("conv_id") % 7 == 0) & (F.col("turn") == 1), F.lit(None)).otherwise(role)
    return turns.select("conv_id", (F.col("turn") * 5 + 3).alias("turn"), role.alias("role"), text.alias("text"))


@query(
    "conv_validate",
    """WITH t AS (SELECT conv_id, turn, CASE WHEN conv_id % 7 = 0 AND turn = 1 THEN NULL WHEN conv_id % 5 = 0 AND turn = 2 THEN 'assistant' ELSE role END AS role,
CASE WHEN conv_id % 11 = 0 AND turn = 1 THEN NULL ELSE text END AS text FROM conversations),
s AS (SELECT *, max(CASE WHEN turn = 0 AND role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys,
row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS rn FROM t),
g AS (SELECT conv_id, count(*) AS n, max(sys) AS sys, bool_or(rn >= sys AND role IS DISTINCT FROM CASE WHEN (rn - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END) AS bad,
bool_or(role IS NULL) AS nobody, bool_or(text IS NULL) AS hole FROM s GROUP BY conv_id)
SELECT conv_id, n AS n_messages, NOT (n - sys < 2 OR bad OR hole) AS valid,
concat_ws(',', CASE WHEN n - sys < 2 THEN 'too_few_messages' END, CASE WHEN bad THEN 'role_order' END, CASE WHEN nobody THEN 'missing_role' END, CASE WHEN hole THEN 'missing_content' END) AS reasons FROM g""",
)
def conv_validate(spark, sf_dir):
    checked = chat.validate_turns(_damaged(spark, sf_dir))
    return checked.withColumn("reasons", F.array_join("reasons", ","))


@query(
    "conv_quarantine",
    """WITH t AS (SELECT *, max(CASE WHEN turn = 0 AND role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM conversations
WHERE conv_id % 3 <> 0 OR turn < 2)
SELECT conv_id AS idx, 'too_few_messages' AS reasons FROM t GROUP BY conv_id HAVING count(*) - max(sys) < 2""",
)
def conv_quarantine(spark, sf_dir):
    """Assembled conversations that fail the rules, with their reasons."""
    short = _turns(spark, sf_dir).where((F.col("conv_id") % 3 != 0) | (F.col("turn") < 2))
    _, bad = chat.split_valid(chat.assemble(short).withColumnRenamed("conv_id", "idx"))
    return bad.select("idx", F.array_join("reasons", ",").alias("reasons"))


_MERGED_SQL = """sysrow AS (SELECT conv_id, text AS stext FROM conversations WHERE turn = 0 AND role = 'system'),
merged AS (SELECT c.conv_id, c.turn - CASE WHEN s.conv_id IS NULL THEN 0 ELSE 1 END AS turn, c.role,
CASE WHEN s.conv_id IS NOT NULL AND c.turn = 1 THEN s.stext || chr(10) || chr(10) || c.text ELSE c.text END AS text
FROM conversations c LEFT JOIN sysrow s USING (conv_id) WHERE NOT (c.turn = 0 AND c.role = 'system'))"""


@query("system_merge", f"WITH {_MERGED_SQL} SELECT conv_id, turn, role, md5(text) AS digest FROM merged")
def system_merge(spark, sf_dir):
    merged = chat.merge_system_turns(_turns(spark, sf_dir))
    return merged.select("conv_id", "turn", "role", F.md5("text").alias("digest"))


# Ids and mask of a turn as text; the marks of the special tokens come from the vocabulary size.
_RENDERED_SQL = f"""{sq.train()}, {_MERGED_SQL},
enc AS MATERIALIZED (SELECT conv_id, turn, role, {sq.encoded('text')} AS syms FROM merged),
parts AS (SELECT conv_id, turn, role, [CASE role WHEN 'user' THEN {BASE + 1} ELSE {BASE + 3} END] || {sq.ids('syms')}
 || [CASE role WHEN 'user' THEN {BASE + 2} ELSE {BASE + 4} END] AS ids,
 [0] || list_transform({sq.ids('syms')}, lambda i: CASE role WHEN 'user' THEN 0 ELSE 1 END) || [CASE role WHEN 'user' THEN 0 ELSE 1 END] AS mask FROM enc),
rendered AS MATERIALIZED (SELECT conv_id, ([{BASE}] || flatten(list(ids ORDER BY turn)))[1:2048] AS ids, ([0] || flatten(list(mask ORDER BY turn)))[1:2048] AS mask,
 last(role ORDER BY turn) AS last_role FROM parts GROUP BY conv_id)"""


def rendered(spark, sf_dir):
    """Rendered conversations: key ``conv_id``, ``ids``, ``mask``."""
    turns = chat.first_turns(_turns(spark, sf_dir))
    return chat.render(chat.assemble(turns), inputs.tokenizer(spark, sf_dir))


@query(
    "conv_render",
    f"""WITH {_RENDERED_SQL} SELECT conv_id, len(ids)::INT AS n_tokens, list_sum(mask)::INT AS n_supervised,
md5({sq.joined('ids')}) AS ids, md5({sq.joined('mask')}) AS mask FROM rendered""",
)
def conv_render(spark, sf_dir):
    total = F.aggregate("mask", F.lit(0), lambda a, b: a + b)
    return rendered(spark, sf_dir).select(
        "conv_id", F.size("ids").alias("n_tokens"), total.alias("n_supervised"),
        F.md5(_JOIN(F.col("ids"))).alias("ids"), F.md5(_JOIN(F.col("mask"))).alias("mask"),
    )


@query(
    "completion_prompt",
    f"""WITH {_RENDERED_SQL.rsplit('rendered AS', 1)[0]} lastturn AS (SELECT conv_id, max(turn) AS t, last(role ORDER BY turn) AS r FROM parts GROUP BY conv_id)
SELECT conv_id, md5({sq.joined(f"([{BASE}] || flatten(list(ids ORDER BY turn)))[1:2048] || [{BASE + 3}]")}) AS ids
FROM parts JOIN lastturn USING (conv_id) WHERE r = 'assistant' AND turn < t GROUP BY conv_id""",
)
def completion_prompt(spark, sf_dir):
    prompts = chat.completion_prompts_of_turns(_turns(spark, sf_dir), inputs.tokenizer(spark, sf_dir))
    return prompts.select("conv_id", F.md5(_JOIN(F.col("ids"))).alias("ids"))


_MC_SQL = lambda question, letters, choices: (
    f"'Multiple Choice question: ' || {question} || chr(10) || array_to_string(list_transform(list_zip({choices}, {letters}), "
    f"lambda z: '- ' || z[1] || '=' || z[2] || chr(10)), '') || chr(10) || 'Respond only with the letter of the correct answer.'"
)


@query("render_mc", f"WITH {inputs.ARC_SQL} SELECT idx, {_MC_SQL('question', 'labels', 'texts')} AS prompt FROM arc")
def render_mc(spark, sf_dir):
    prompt = tasks.render_mc(F.col("question"), F.col("choices")["label"], F.col("choices")["text"])
    return inputs.arc(spark, sf_dir).select("idx", prompt.alias("prompt"))


def _text(i):
    return F.col("messages")[i]["parts"][0]["text"]


@query(
    "mmlu_conv",
    f"""WITH {inputs.MMLU_SQL} SELECT idx, md5({_MC_SQL('question', "['A', 'B', 'C', 'D']", 'choices')}) AS prompt,
substr('ABCD', answer + 1, 1) AS answer, subject, 'ABCD' AS letters FROM mmlu""",
)
def mmlu_conv(spark, sf_dir):
    rows = tasks.mmlu_conversations(inputs.mmlu(spark, sf_dir))
    return rows.select("idx", F.md5(_text(0)).alias("prompt"), _text(1).alias("answer"), "subject", F.array_join("letters", "").alias("letters"))


@query(
    "arc_conv",
    f"""WITH {inputs.ARC_SQL} SELECT idx, {_MC_SQL('question', 'labels', 'texts')} AS prompt, answer_key AS answer, array_to_string(labels, '') AS letters FROM arc""",
)
def arc_conv(spark, sf_dir):
    rows = tasks.arc_conversations(inputs.arc(spark, sf_dir))
    return rows.select("idx", _text(0).alias("prompt"), _text(1).alias("answer"), F.array_join("letters", "").alias("letters"))


@query(
    "gsm8k_parts",
    f"""WITH {inputs.GSM8K_SQL},
marked AS (SELECT idx, question, string_split(regexp_replace(answer, '(<<[^>]+>>)', chr(29) || '\\1' || chr(29), 'g'), chr(29)) AS p FROM gsm8k),
u AS (SELECT idx, question, unnest(p) AS s, generate_subscripts(p, 1) AS k FROM marked),
typed AS (SELECT idx, question, k * 2 AS k, CASE WHEN s LIKE '<<%>>' THEN 'python' ELSE 'text' END AS type,
 CASE WHEN s NOT LIKE '<<%>>' THEN s WHEN s LIKE '%=%' THEN regexp_extract(s, '^<<(.*)=[^=]*>>$', 1) ELSE s[3:-3] END AS text FROM u
 UNION ALL SELECT idx, question, k * 2 + 1, 'python_output', CASE WHEN s LIKE '%=%' THEN regexp_extract(s, '=([^=]*)>>$', 1) ELSE '' END FROM u WHERE s LIKE '<<%>>')
SELECT idx, question, string_agg(type || ':' || text, '|' ORDER BY k) AS parts FROM typed GROUP BY idx, question""",
)
def gsm8k_parts(spark, sf_dir):
    rows = tasks.gsm8k_conversations(inputs.gsm8k(spark, sf_dir))
    parts = F.transform(F.col("messages")[1]["parts"], lambda p: F.concat(p["type"], F.lit(":"), p["text"]))
    return rows.select("idx", _text(0).alias("question"), F.array_join(parts, "|").alias("parts"))


@query(
    "humaneval_conv",
    f"""WITH {inputs.HUMANEVAL_SQL} SELECT idx, prompt, prompt || chr(10) || canonical_solution AS answer, entry_point, test FROM humaneval""",
)
def humaneval_conv(spark, sf_dir):
    rows = tasks.humaneval_conversations(inputs.humaneval(spark, sf_dir))
    return rows.select("idx", _text(0).alias("prompt"), _text(1).alias("answer"), "entry_point", "test")


@query(
    "chat_conv",
    """SELECT conv_id AS idx, count(*)::INT AS n_messages, first(role ORDER BY turn) AS first_role, md5(string_agg(text, chr(30) ORDER BY turn)) AS digest
FROM conversations GROUP BY conv_id HAVING count(*) - max(CASE WHEN turn = 0 AND role = 'system' THEN 1 ELSE 0 END) >= 2""",
)
def chat_conv(spark, sf_dir):
    """Chats that pass validation."""
    good, _ = chat.split_valid(inputs.chat(spark, sf_dir))
    rows = tasks.chat_conversations(good)
    return rows.select(
        "idx", F.size("messages").alias("n_messages"), F.col("messages")[0]["role"].alias("first_role"),
        F.md5(F.array_join(F.transform("messages", lambda m: m["parts"][0]["text"]), "\x1e")).alias("digest"),
    )


# --- generators --------------------------------------------------------------

_D = lambda slot, bound: sq.draw(f"'bee|train|' || i || '|{slot}'", bound)
_QUOTE = "['', '''', '\"']"
_TEMPLATES_SQL = "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in tasks.COUNT_TEMPLATES) + "]"
_INDEXED_SQL = lambda salt: (
    f"{inputs.WORDS_SQL}, iw AS MATERIALIZED (SELECT word, row_number() OVER (ORDER BY md5('{salt}|' || word)) - 1 AS word_idx, count(*) OVER () AS n FROM words)"
)
BEE_SQL = f"""{_INDEXED_SQL('bee')},
ex AS (SELECT doc_id AS i, {sq.draw("'bee|train|' || doc_id || '|word'", '(SELECT count(*) FROM iw)')} AS word_idx FROM documents),
bee0 AS (SELECT i, word, CASE WHEN {_D('own', 10)} < 9 THEN substr(word, {_D('at', 'length(word)')} + 1, 1)
 ELSE substr('{tasks.LETTERS}', {_D('any', 26)} + 1, 1) END AS letter FROM ex JOIN iw USING (word_idx)),
bee1 AS (SELECT i, word, letter, (length(word) - length(replace(word, letter, '')))::INT AS cnt,
 {_TEMPLATES_SQL}[{_D('template', len(tasks.COUNT_TEMPLATES))} + 1] AS t FROM bee0),
bee AS (SELECT i, word, letter, cnt, replace(replace(CASE WHEN {_D('lower', 10)} < 3 THEN lower(t) ELSE t END,
 '{{word}}', {_QUOTE}[{_D('quote_word', 3)} + 1] || word || {_QUOTE}[{_D('quote_word', 3)} + 1]),
 '{{letter}}', {_QUOTE}[{_D('quote_letter', 3)} + 1] || letter || {_QUOTE}[{_D('quote_letter', 3)} + 1])
 || CASE WHEN {_D('mark', 2)} < 1 THEN '?' ELSE '' END AS question FROM bee1)"""
_BEE_TEXT_SQL = """'We are asked to find the number ''' || letter || ''' in the word ''' || word || '''. Let me try a manual approach first.' || chr(10) || chr(10)
 || 'First spell the word out:' || chr(10) || word || ':' || array_to_string(string_split(word, ''), ',') || chr(10) || chr(10)
 || 'Then count the occurrences of ''' || letter || ''':' || chr(10)
 || array_to_string(list_transform(range(1, length(word) + 1), lambda k: k || ':' || substr(word, k, 1) ||
   CASE WHEN substr(word, k, 1) = letter THEN ' hit! count=' || (k - length(replace(substr(word, 1, k), letter, ''))) ELSE '' END || chr(10)), '')
 || chr(10) || 'This gives us ' || cnt || '.'"""


def _size(spark, sf_dir):
    """As many examples as there are documents."""
    return inputs.documents(spark, sf_dir).agg(F.count("*")).first()[0]


@query(
    "spelling_bee",
    f"""WITH {BEE_SQL} SELECT i AS idx, question, {_BEE_TEXT_SQL} AS manual,
'''' || word || '''.count(''' || letter || ''')' AS call, cnt::VARCHAR AS output,
chr(10) || chr(10) || 'Python gives us ' || cnt || '.' || chr(10) || chr(10) || 'My final answer is:' || chr(10) || chr(10) || '#### ' || cnt AS final FROM bee""",
)
def spelling_bee(spark, sf_dir):
    words = tasks.index_words(inputs.words(spark, sf_dir), "bee")
    rows = tasks.letter_count_conversations(spark, words, _size(spark, sf_dir), "train")
    part = lambda i: F.col("messages")[1]["parts"][i]["text"]
    return rows.select(
        "idx", _text(0).alias("question"), part(0).alias("manual"), part(2).alias("call"),
        part(3).alias("output"), part(4).alias("final"),
    )


SPELL_SQL = f"""{_INDEXED_SQL('spell')}, spell AS (SELECT doc_id AS idx, word FROM documents
 JOIN iw ON iw.word_idx = {sq.draw("'spell|train|' || doc_id || '|word'", '(SELECT count(*) FROM iw)')})"""


@query(
    "simple_spelling",
    f"WITH {SPELL_SQL} SELECT idx, 'Spell the word: ' || word AS question, word || ':' || array_to_string(string_split(word, ''), ',') AS answer FROM spell",
)
def simple_spelling(spark, sf_dir):
    words = tasks.index_words(inputs.words(spark, sf_dir), "spell")
    rows = tasks.spelling_conversations(spark, words, _size(spark, sf_dir), "train")
    return rows.select("idx", _text(0).alias("question"), _text(1).alias("answer"))


@query(
    "tool_audit",
    f"""WITH {inputs.GSM8K_SQL}, {BEE_SQL},
calls AS (SELECT 'GSM8K' AS task, idx, 1 AS k, a || '*' || b AS call, (CASE kind WHEN 2 THEN a * b + 1 ELSE a * b END)::VARCHAR AS recorded, (a * b)::VARCHAR AS result FROM gsm8k WHERE kind < 3
UNION ALL SELECT 'GSM8K', idx, 2, (a * b) || '+' || a, (a * b + a)::VARCHAR, (a * b + a)::VARCHAR FROM gsm8k WHERE kind = 1
UNION ALL SELECT 'GSM8K', idx, 1, a::VARCHAR, '', a::VARCHAR FROM gsm8k WHERE kind = 3
UNION ALL SELECT 'SpellingBee', i, 1, '''' || word || '''.count(''' || letter || ''')', cnt::VARCHAR, CASE WHEN regexp_matches(word || ' ' || letter,
 '__|import|exec|eval|compile|open|file|input|raw_input|globals|locals|vars|dir|getattr|setattr|delattr|hasattr') THEN NULL ELSE cnt::VARCHAR END FROM bee)
SELECT task, idx, call, recorded, coalesce(result, 'none') AS result,
CASE WHEN result IS NULL THEN 'rejected' WHEN recorded = result THEN 'match' ELSE 'mismatch' END AS verdict FROM calls""",
)
def tool_audit(spark, sf_dir):
    words = tasks.index_words(inputs.words(spark, sf_dir), "bee")
    bees = tasks.letter_count_conversations(spark, words, _size(spark, sf_dir), "train")
    problems = tasks.gsm8k_conversations(inputs.gsm8k(spark, sf_dir))
    audited = audit.audit_tool_calls(problems.unionByName(bees))
    return audited.select("task", "idx", "call", "recorded", F.coalesce("result", F.lit("none")).alias("result"), "verdict")


# --- requests ----------------------------------------------------------------


def request_lines(spark, sf_dir):
    """Conversations as JSON requests; some are spoilt."""
    rows = chat.assemble(_turns(spark, sf_dir))
    message = lambda m: F.struct(m["role"].alias("role"), m["parts"][0]["text"].alias("content"))
    messages = F.when(F.col("conv_id") % 13 == 0, F.array().cast("array<struct<role:string,content:string>>")).otherwise(
        F.transform("messages", message)
    )
    tokens = F.when(F.col("conv_id") % 3 == 0, F.lit(100))
    body = F.struct(messages.alias("messages"), tokens.alias("max_tokens"))
    return rows.select("conv_id", F.to_json(F.struct(body.alias("input"))).alias("request"))


REQUESTS_SQL = """SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN 100 ELSE 256 END AS max_tokens, 1.0::DOUBLE AS temperature, 50 AS top_k,
CASE WHEN conv_id % 13 = 0 THEN 'No messages provided' WHEN max(role = 'system') THEN 'Invalid role: system. Must be ''user'' or ''assistant'''
WHEN last(role ORDER BY turn) <> 'user' THEN 'Last message must be from ''user''' ELSE 'ok' END AS error FROM conversations GROUP BY conv_id"""


def shown_requests(checked):
    return checked.select("conv_id", "max_tokens", "temperature", "top_k", F.coalesce("error", F.lit("ok")).alias("error"))


@query("request_validate", REQUESTS_SQL)
def request_validate(spark, sf_dir):
    return shown_requests(validate_requests(request_lines(spark, sf_dir)))
