"""Mixtures, packing and collation over the given tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import functions as F

from shardloom.operators import mix, pack, tasks
from shardloom.operators.tokens import encode_corpus
from shardloom.plans import inputs
from shardloom.plans import sqltext as sq
from shardloom.plans.chat_queries import _MC_SQL, _RENDERED_SQL, BASE, BEE_SQL, rendered
from shardloom.plans.registry import query, table
from shardloom.session import materialize, scratch_path
from shardloom.sources import conversations as conv_source
from shardloom.sources.shards import assign_ranks

_JOIN = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")


# --- mixtures ----------------------------------------------------------------


def _slim(df, task, key):
    return df.select(F.lit(task).alias("task"), F.col(key).alias("idx"))


@query("seeded_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id)) - 1 AS idx FROM documents")
def seeded_shuffle(spark, sf_dir):
    return mix.seeded_shuffle(inputs.documents(spark, sf_dir).select("doc_id"), "doc_id")


_MEMBERS_SQL = """m AS (SELECT 0 AS member, 'docs' AS task, doc_id AS idx FROM documents
UNION ALL SELECT 1, 'parts', p_partkey FROM part UNION ALL SELECT 2, 'parts', p_partkey FROM part
UNION ALL SELECT 3, 'orders', o_orderkey FROM orders)"""


def _three_members(spark, sf_dir):
    parts = _slim(table(spark, sf_dir, "part"), "parts", "p_partkey")
    return [
        _slim(inputs.documents(spark, sf_dir), "docs", "doc_id"), parts, parts,
        _slim(table(spark, sf_dir, "orders"), "orders", "o_orderkey"),
    ]


@query(
    "mixture",
    f"WITH {_MEMBERS_SQL} SELECT row_number() OVER (ORDER BY md5('42|' || member || '|' || idx)) - 1 AS pos, member, task, idx FROM m",
)
def mixture(spark, sf_dir):
    """Four members, one of them listed twice."""
    return mix.mixture(_three_members(spark, sf_dir)).select("pos", "member", "task", "idx")


@query("oversample", "SELECT p_partkey AS idx, p_name, c::INT AS copy FROM part CROSS JOIN range(3) t(c)")
def oversample(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("idx"), "p_name")
    return mix.oversample(rows, 3)


@query(
    "sequence",
    f"WITH {_MEMBERS_SQL} SELECT row_number() OVER (ORDER BY member, idx) - 1 AS pos, member, task, idx FROM m",
)
def sequence(spark, sf_dir):
    return mix.sequence(_three_members(spark, sf_dir)).select("pos", "member", "task", "idx")


def _conversation_tables(spark, sf_dir, members):
    """The task tables that ``members`` name, each with its rows' places in a shuffle of its own.

    Places come from row keys; conversations are built where the mixture reads them.
    """
    def half(rows, rest, adapt, *name):
        chosen = rows.where(F.col("idx") % 2 == rest)
        return mix.shuffled(adapt(chosen, *name).withColumnRenamed("idx", "_row"), "_row")

    @lru_cache(maxsize=1)
    def words():
        return materialize(inputs.words(spark, sf_dir), "words")

    def generated(make, salt):
        n = inputs.documents(spark, sf_dir).agg(F.count("*")).first()[0]
        rows = make(spark, tasks.index_words(words(), salt), n, "train").withColumnRenamed("idx", "_row")
        return mix.Placed(rows, "_row", spark.range(n).select(F.col("id").alias("_row"), F.col("id").alias("idx")))

    gsm = lambda: inputs.gsm8k(spark, sf_dir).drop("a", "b", "kind")
    makers = {
        ("SmolTalk", "train"): lambda: half(inputs.chat(spark, sf_dir), 0, tasks.chat_conversations),
        ("SmolTalk", "test"): lambda: half(inputs.chat(spark, sf_dir), 1, tasks.chat_conversations),
        ("CustomJSON", "train"): lambda: half(inputs.chat(spark, sf_dir), 1, tasks.chat_conversations, "CustomJSON"),
        ("MMLU", "auxiliary_train"): lambda: half(inputs.mmlu(spark, sf_dir), 0, tasks.mmlu_conversations),
        ("MMLU", "test"): lambda: half(inputs.mmlu(spark, sf_dir), 1, tasks.mmlu_conversations),
        ("GSM8K", "train"): lambda: half(gsm(), 0, tasks.gsm8k_conversations),
        ("GSM8K", "test"): lambda: half(gsm(), 1, tasks.gsm8k_conversations),
        ("ARC-Easy", "train"): lambda: half(inputs.arc(spark, sf_dir), 0, tasks.arc_conversations),
        ("ARC-Challenge", "train"): lambda: half(inputs.arc(spark, sf_dir), 1, tasks.arc_conversations, "ARC-Challenge"),
        ("SimpleSpelling", "train"): lambda: generated(tasks.spelling_conversations, "spell"),
        ("SpellingBee", "train"): lambda: generated(tasks.letter_count_conversations, "bee"),
    }
    return {(m.task, m.split): makers[(m.task, m.split)]() for m in members}


def _preset(spark, sf_dir, stage, tier="full", split="train"):
    tables = _conversation_tables(spark, sf_dir, mix.PRESETS[(stage, tier, split)])
    return mix.preset_mixture(tables, stage, tier, split).select("pos", "member", "task", "idx", "messages")


_SHUFFLED_SQL = lambda name, task, key, source, text, where: (
    f"{name} AS (SELECT '{task}' AS task, row_number() OVER (ORDER BY md5('42|' || {key})) - 1 AS idx, md5({text}) AS first FROM {source} WHERE {where})"
)
_CHAT_FIRST = "(SELECT conv_id, first(text ORDER BY turn) AS t FROM conversations GROUP BY conv_id)"
_MMLU_FIRST = _MC_SQL("question", "['A', 'B', 'C', 'D']", "choices")
_ARC_FIRST = _MC_SQL("question", "labels", "texts")
_TASKS_SQL = f"""{inputs.MMLU_SQL}, {inputs.GSM8K_SQL}, {inputs.ARC_SQL}, {BEE_SQL},
iw2 AS MATERIALIZED (SELECT word, row_number() OVER (ORDER BY md5('spell|' || word)) - 1 AS word_idx FROM words),
{_SHUFFLED_SQL('talk0', 'SmolTalk', 'conv_id', _CHAT_FIRST, 't', 'conv_id % 2 = 0')},
{_SHUFFLED_SQL('talk1', 'CustomJSON', 'conv_id', _CHAT_FIRST, 't', 'conv_id % 2 = 1')},
{_SHUFFLED_SQL('mmlu0', 'MMLU', 'idx', 'mmlu', _MMLU_FIRST, 'idx % 2 = 0')},
{_SHUFFLED_SQL('gsm_train', 'GSM8K', 'idx', 'gsm8k', 'question', 'idx % 2 = 0')},
{_SHUFFLED_SQL('talk_test', 'SmolTalk', 'conv_id', _CHAT_FIRST, 't', 'conv_id % 2 = 1')},
{_SHUFFLED_SQL('mmlu1', 'MMLU', 'idx', 'mmlu', _MMLU_FIRST, 'idx % 2 = 1')},
{_SHUFFLED_SQL('gsm_test', 'GSM8K', 'idx', 'gsm8k', 'question', 'idx % 2 = 1')},
{_SHUFFLED_SQL('arc0', 'ARC-Easy', 'idx', 'arc', _ARC_FIRST, 'idx % 2 = 0')},
{_SHUFFLED_SQL('arc1', 'ARC-Challenge', 'idx', 'arc', _ARC_FIRST, 'idx % 2 = 1')},
spell0 AS (SELECT 'SimpleSpelling' AS task, doc_id AS idx, md5('Spell the word: ' || word) AS first FROM documents
 JOIN iw2 ON iw2.word_idx = {sq.draw("'spell|train|' || doc_id || '|word'", '(SELECT count(*) FROM iw2)')}),
bee2 AS (SELECT 'SpellingBee' AS task, i AS idx, md5(question) AS first FROM bee)"""


def _preset_sql(members: list[tuple[str, int | None]]) -> str:
    union = " UNION ALL ".join(
        f"SELECT {i} AS member, task, idx, first FROM {name}" + (f" WHERE idx < {stop}" if stop else "")
        for i, (name, stop) in enumerate(members)
    )
    return (
        f"WITH {_TASKS_SQL}, u AS ({union}) "
        "SELECT row_number() OVER (ORDER BY md5('42|' || member || '|' || idx)) - 1 AS pos, member, task, idx, first FROM u"
    )


def _shown_mixture(df):
    """Positions with a digest of the first message."""
    first = F.md5(F.col("messages")[0]["parts"][0]["text"])
    return df.select("pos", "member", "task", "idx", first.alias("first"))


@query(
    "mid_mixture",
    _preset_sql([("talk0", None), ("mmlu0", None), ("gsm_train", None), ("spell0", 200_000), ("bee2", 80_000)]),
)
def mid_mixture(spark, sf_dir):
    """The full mid-training preset; the row limits are those of the preset."""
    return _shown_mixture(_preset(spark, sf_dir, "mid"))


@query(
    "sft_mixture",
    _preset_sql([("arc0", None), ("arc1", None), ("gsm_train", None), ("talk0", 10_000), ("talk1", None), ("spell0", 300), ("bee2", 300)]),
)
def sft_mixture(spark, sf_dir):
    """The full fine-tuning preset; the row limits are those of the preset."""
    return _shown_mixture(_preset(spark, sf_dir, "sft"))


def _register_preset(name: str, stage: str, tier: str, split: str, members: list[tuple[str, int | None]]) -> None:
    @query(name, _preset_sql(members))
    def preset(spark, sf_dir):
        return _shown_mixture(_preset(spark, sf_dir, stage, tier, split))


_register_preset("mid_small", "mid", "small", "train", [("talk0", 1000), ("mmlu0", 500)])
_register_preset("mid_small_val", "mid", "small", "val", [("talk_test", 100), ("mmlu1", 100)])
_register_preset("mid_val", "mid", "full", "val", [("talk_test", None), ("mmlu1", 5200), ("gsm_test", 420)])
_register_preset(
    "sft_small", "sft", "small", "train",
    [("arc0", 50), ("arc1", 30), ("gsm_train", 100), ("talk0", 200), ("talk1", None), ("spell0", 20), ("bee2", 20)],
)
_register_preset("sft_small_val", "sft", "small", "val", [("talk_test", 100)])
_register_preset("sft_val", "sft", "full", "val", [("talk_test", 1000)])


_LINES_SQL = lambda split, members: (
    f"SELECT '{split}' AS split, m.pos, m.task, m.first, CASE m.task WHEN 'SpellingBee' THEN 5 WHEN 'GSM8K' THEN 3 * CASE g.kind WHEN 1 THEN 2 WHEN 4 THEN 0 ELSE 1 END + 1 ELSE 1 END AS n_parts, "
    "CASE WHEN m.task LIKE 'ARC%' THEN 4 ELSE 0 END AS n_letters "
    f"FROM ({_preset_sql(members)}) m LEFT JOIN (SELECT kind, question, md5(question) AS q FROM "
    f"(WITH {inputs.GSM8K_SQL} SELECT kind, question FROM gsm8k)) g ON m.task = 'GSM8K' AND g.q = m.first"
)
_SFT_SMALL = [("arc0", 50), ("arc1", 30), ("gsm_train", 100), ("talk0", 200), ("talk1", None), ("spell0", 20), ("bee2", 20)]


@query("jsonl_mixture", f"SELECT split, pos, first, n_parts::INT AS n_parts, n_letters::INT AS n_letters FROM ({_LINES_SQL('train', _SFT_SMALL)} UNION ALL {_LINES_SQL('val', [('talk_test', 100)])})")
def jsonl_mixture(spark, sf_dir):
    """Both splits of a preset written as JSON lines in mixture order and read back by place, with parts and letters."""
    root, parts = scratch_path(spark, "mixture"), []
    for split in ("train", "val"):
        members = mix.PRESETS[("sft", "small", split)]
        rows = materialize(mix.preset_mixture(_conversation_tables(spark, sf_dir, members), "sft", "small", split), "mixture")
        path = conv_source.write_jsonl(rows, root, "sft", "d4", split, order="pos", rows_per_file=64)
        lines = conv_source.scan_jsonl_in_order(spark, path, rows_per_file=64)
        # A line must be the one that was written for its place.
        read = lines.join(rows.select("pos", F.md5(conv_source.line_of()).alias("told")), "pos")
        same = F.when(F.md5("value") == F.col("told"), F.col("value")).otherwise(F.raise_error(F.lit("another line")).cast("string"))
        parsed = conv_source.parse_lines(read.select("pos", same.alias("value")), "pos")
        last = F.element_at("messages", -1)
        parts.append(
            parsed.select(
                F.lit(split).alias("split"), "pos", F.md5(F.col("messages")[0]["parts"][0]["text"]).alias("first"),
                F.size(last["parts"]).alias("n_parts"), F.coalesce(F.size("letters"), F.lit(0)).alias("n_letters"),
            )
        )
    return parts[0].unionByName(parts[1])


# --- packing -----------------------------------------------------------------

_ENC_DOCS_SQL = f"""{sq.train()},
enc AS MATERIALIZED (SELECT doc_id, {sq.encoded('text')} AS syms FROM documents)"""
BATCH, LENGTH = 4, 256


def _packed_sql(stream: str, batch: int, length: int, key: str) -> str:
    """CTE ``packed`` from a CTE of (key, ids): one row per token, then windows."""
    width = batch * length + 1
    return f"""tok AS MATERIALIZED (SELECT {key} AS k, unnest(ids) AS id, generate_subscripts(ids, 1) AS j FROM {stream}),
starts AS (SELECT {key} AS k, coalesce(sum(len(ids)) OVER (ORDER BY {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM {stream}),
win AS MATERIALIZED (SELECT (o + j - 1)::BIGINT // {width} AS batch_id, list(id ORDER BY o + j) AS w, max(k) AS last_key FROM tok JOIN starts USING (k) GROUP BY 1 HAVING count(*) = {width}),
packed AS (SELECT batch_id, r::INT AS row_in_batch, last_key, w[r * {length} + 1 : r * {length} + {length}] AS inputs,
 w[r * {length} + 2 : r * {length} + {length} + 1] AS targets FROM win CROSS JOIN range({batch}) t(r))"""


@query(
    "pack_pretrain",
    f"""WITH {_ENC_DOCS_SQL}, s AS (SELECT doc_id, [{BASE}] || {sq.ids('syms')} AS ids FROM enc), {_packed_sql('s', BATCH, LENGTH, 'doc_id')}
SELECT batch_id, row_in_batch, md5({sq.joined('inputs')}) AS inputs, md5({sq.joined('targets')}) AS targets FROM packed""",
)
def pack_pretrain(spark, sf_dir):
    docs = inputs.heavy_documents(spark, sf_dir).select("doc_id", "text")
    encoded = encode_corpus(docs, inputs.tokenizer(spark, sf_dir), prepend="<|bos|>")
    stored = materialize(encoded.select("doc_id", "ids", F.size("ids").alias("n_tokens")), "encoded")
    packed = pack.pack(stored, "doc_id", BATCH, LENGTH, sizes="n_tokens")
    return packed.select(
        "batch_id", "row_in_batch", F.md5(_JOIN("inputs")).alias("inputs"), F.md5(_JOIN("targets")).alias("targets")
    )


@query(
    "batch_sink",
    f"""WITH {_ENC_DOCS_SQL}, s AS (SELECT doc_id, [{BASE}] || {sq.ids('syms')} AS ids FROM enc), {_packed_sql('s', BATCH, LENGTH, 'doc_id')}
SELECT 'train' AS split, (batch_id % 3)::INT AS rank, (batch_id // 3 * {BATCH} + row_in_batch)::BIGINT AS position, md5({sq.joined('inputs')}) AS inputs, md5({sq.joined('targets')}) AS targets FROM packed""",
)
def batch_sink(spark, sf_dir):
    """Packed batches written for three workers; every worker reads its own rows back in order."""
    docs = inputs.heavy_documents(spark, sf_dir).select("doc_id", "text")
    encoded = encode_corpus(docs, inputs.tokenizer(spark, sf_dir), prepend="<|bos|>")
    stored = materialize(encoded.select("doc_id", "ids", F.size("ids").alias("n_tokens")), "encoded")
    path = scratch_path(spark, "batches")
    pack.write_rank_batches(pack.pack(stored, "doc_id", BATCH, LENGTH, sizes="n_tokens"), path, "train", BATCH, 3, rows_per_file=256)
    parts = [pack.read_rank_batches(spark, path, "train", rank) for rank in range(3)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(
        "split", "rank", "position", F.md5(_JOIN("inputs")).alias("inputs"), F.md5(_JOIN("targets")).alias("targets")
    )


@query(
    "pack_pretrain_ranks",
    f"""WITH {_ENC_DOCS_SQL}, s AS (SELECT doc_id, doc_id // 16 % 2 AS rank, [{BASE}] || {sq.ids('syms')} AS ids FROM enc),
tok AS MATERIALIZED (SELECT doc_id, rank, unnest(ids) AS id, generate_subscripts(ids, 1) AS j FROM s),
starts AS (SELECT doc_id, coalesce(sum(len(ids)) OVER (PARTITION BY rank ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM s)
SELECT rank::INT AS rank, (o + j - 1)::BIGINT // 1025 AS batch_id, md5(string_agg(id, ' ' ORDER BY o + j)) AS tokens FROM tok JOIN starts USING (doc_id) GROUP BY 1, 2 HAVING count(*) = 1025""",
)
def pack_pretrain_ranks(spark, sf_dir):
    """Two workers, each with a stream of its own units of 16 documents."""
    docs = inputs.heavy_documents(spark, sf_dir).select("doc_id", "text", F.expr("doc_id div 16").alias("unit"))
    encoded = encode_corpus(assign_ranks(docs, "unit", 2), inputs.tokenizer(spark, sf_dir), prepend="<|bos|>")
    windows = pack.windows(materialize(encoded.select("doc_id", "rank", "ids"), "encoded"), "doc_id", BATCH * LENGTH + 1, ["rank"])
    return windows.select("rank", F.col("window_id").alias("batch_id"), F.md5(_JOIN("tokens")).alias("tokens"))


@query(
    "pack_mid",
    f"""WITH {_RENDERED_SQL}, n AS (SELECT count(*) AS n FROM rendered),
placed AS (SELECT row_number() OVER (ORDER BY md5('42|' || conv_id)) - 1 AS pos, ids FROM rendered),
s AS (SELECT e * (SELECT n FROM n) + pos AS k, ids FROM placed CROSS JOIN range(2) t(e)), {_packed_sql('s', 2, 128, 'k')}
SELECT batch_id, row_in_batch, md5({sq.joined('inputs')}) AS inputs, md5({sq.joined('targets')}) AS targets,
((last_key + 1) % (SELECT n FROM n))::DOUBLE / (SELECT n FROM n)::DOUBLE AS progress, last_key + 1 >= (SELECT n FROM n) AS last_step FROM packed""",
)
def pack_mid(spark, sf_dir):
    """Rendered conversations in mixture order, read twice."""
    whole = materialize(rendered(spark, sf_dir).select("conv_id", "ids"), "rendered")
    convs = materialize(mix.seeded_shuffle(whole, "conv_id", out="pos"), "shuffled")
    packed = pack.pack_epochs(convs, "pos", convs.count(), 2, 128, epochs=2)
    return packed.select(
        "batch_id", "row_in_batch", F.md5(_JOIN("inputs")).alias("inputs"), F.md5(_JOIN("targets")).alias("targets"),
        "progress", "last_step",
    )


_COLLATED_SQL = f"""{_RENDERED_SQL},
placed AS (SELECT conv_id AS idx, (conv_id % 2)::INT AS rank, conv_id // 2 // 4 AS batch_id, (conv_id // 2 % 4)::INT AS row_in_batch, ids, mask FROM rendered),
wide AS (SELECT *, max(len(ids) - 1) OVER (PARTITION BY rank, batch_id) AS w FROM placed),
collated AS MATERIALIZED (SELECT rank, batch_id, row_in_batch, idx, w, ids[1:-2] || list_transform(range(w - len(ids) + 1), lambda i: {BASE + 4}) AS inputs,
 list_transform(range(2, len(ids) + 1), lambda i: CASE WHEN mask[i] = 0 THEN -1 ELSE ids[i] END) || list_transform(range(w - len(ids) + 1), lambda i: -1) AS targets FROM wide)"""


def _collated(spark, sf_dir):
    tok = inputs.tokenizer(spark, sf_dir)
    return pack.collate(rendered(spark, sf_dir), tok.special_id("<|assistant_end|>"), 4, "conv_id", world_size=2)


@query(
    "sft_collate",
    f"""WITH {_COLLATED_SQL} SELECT rank, batch_id, row_in_batch, idx AS conv_id, w::INT AS width, md5({sq.joined('inputs')}) AS inputs, md5({sq.joined('targets')}) AS targets FROM collated""",
)
def sft_collate(spark, sf_dir):
    return _collated(spark, sf_dir).select(
        "rank", "batch_id", "row_in_batch", "conv_id", F.size("inputs").alias("width"),
        F.md5(_JOIN("inputs")).alias("inputs"), F.md5(_JOIN("targets")).alias("targets"),
    )


@query(
    "supervised_tokens",
    f"WITH {_COLLATED_SQL} SELECT batch_id AS step, sum(len(list_filter(targets, lambda t: t >= 0)))::BIGINT AS n_supervised FROM collated GROUP BY 1",
)
def supervised_tokens(spark, sf_dir):
    return pack.supervised_tokens(_collated(spark, sf_dir).withColumnRenamed("batch_id", "step"), "step")


@query(
    "pad_stack",
    f"""WITH {_RENDERED_SQL}, g AS (SELECT conv_id, ids, max(len(ids)) OVER (PARTITION BY conv_id // 8) AS w FROM rendered)
SELECT conv_id, w::INT AS width, md5({sq.joined(f'ids || list_transform(range(w - len(ids)), lambda i: {BASE})')}) AS padded FROM g""",
)
def pad_stack(spark, sf_dir):
    """Groups of eight prompts padded to their longest with BOS."""
    rows = materialize(rendered(spark, sf_dir).select("conv_id", "ids", F.expr("conv_id div 8").alias("batch")), "prompts")
    padded = pack.pad_right(rows, "batch", inputs.tokenizer(spark, sf_dir).special_id("<|bos|>"))
    return padded.select("conv_id", F.size("padded").alias("width"), F.md5(_JOIN("padded")).alias("padded"))


@query(
    "step_plan",
    "SELECT count(*) AS train_size, 4 AS grad_accum_steps, ((count(*) // 16) * 3)::BIGINT AS num_iterations, 8192 AS tokens_per_step FROM documents",
)
def step_plan(spark, sf_dir):
    return pack.step_plan(inputs.documents(spark, sf_dir), target=16, batch=4, epochs=3, seq_len=512)
