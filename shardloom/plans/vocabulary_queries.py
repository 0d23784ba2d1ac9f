"""Vocabulary training, encoding, decoding and token statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardloom.functions.text import SPLIT_DIGITS_2
from shardloom.operators import tokens as tk
from shardloom.operators import vocabulary as vb
from shardloom.plans import inputs
from shardloom.plans import sqltext as sq
from shardloom.plans.registry import query
from shardloom.session import materialize, scratch_path
from shardloom.sources import artifacts

_JOIN_IDS = lambda c: F.array_join(F.col(c).cast("array<string>") if isinstance(c, str) else c.cast("array<string>"), " ")
_SPECIALS_SQL = ", ".join(f"({i}, '{name}')" for i, name in enumerate(vb.SPECIAL_TOKENS))
_ENCODED_DOCS = f"enc AS MATERIALIZED (SELECT doc_id, lang, text, {sq.encoded('text')} AS syms FROM documents)"
BOS = 256 + sq.N_MERGES
LONG_RULES = 1000


@query(
    "pretokenize",
    f"""SELECT doc_id, lang, len(p)::INT AS n_pieces, md5(array_to_string(p, chr(30))) AS digest
FROM (SELECT doc_id, lang, {sq.pieces('text')} AS p FROM documents)""",
)
def pretokenize(spark, sf_dir):
    split = inputs.heavy_documents(spark, sf_dir).select("doc_id", "lang", vb.split_pieces(F.col("text")).alias("p"))
    return split.select("doc_id", "lang", F.size("p").alias("n_pieces"), F.md5(F.array_join("p", "\x1e")).alias("digest"))


@query(
    "piece_counts",
    f"SELECT piece, count(*) AS cnt FROM (SELECT unnest({sq.pieces('text', 2)}) AS piece FROM documents) GROUP BY piece",
)
def piece_counts(spark, sf_dir):
    return vb.piece_counts(inputs.heavy_documents(spark, sf_dir), pattern=SPLIT_DIGITS_2)


def _words(spark, sf_dir):
    return vb.with_symbols(vb.piece_counts(inputs.heavy_documents(spark, sf_dir)))


@query(
    "pair_counts",
    f"""WITH {sq.train(0).rsplit(',', 1)[0]}
SELECT unicode(pair) - 19968 AS l, unicode(substr(pair, 2, 1)) - 19968 AS r, sum(cnt)::BIGINT AS cnt
FROM (SELECT cnt, unnest(list_transform(range(1, length(syms)), lambda i: substr(syms, i, 2))) AS pair FROM w0 WHERE length(syms) > 1) GROUP BY pair""",
)
def pair_counts(spark, sf_dir):
    return vb.pair_counts(_words(spark, sf_dir))


@query("best_pair", f"WITH {sq.train(1)} SELECT l, r, cnt FROM merges")
def best_pair(spark, sf_dir):
    return vb.best_pairs(vb.pair_counts(_words(spark, sf_dir)), 1)


@query(
    "merge_once",
    f"""WITH {sq.train(1)}, spelled AS MATERIALIZED (SELECT piece, cnt, {sq.symbols('piece')} AS syms FROM piece_counts)
SELECT piece, spelled.cnt, replace(syms, ab, chr(20224)) AS syms FROM spelled CROSS JOIN m1""",
)
def merge_once(spark, sf_dir):
    """The best pair merged in every word."""
    words = materialize(_words(spark, sf_dir), "words")
    best = vb.best_pairs(vb.pair_counts(words), 1).first()
    rule = (vb.id_to_symbol(best.l) + vb.id_to_symbol(best.r), vb.id_to_symbol(256))
    return words.withColumn("syms", vb.merge_symbols(F.col("syms"), [rule]))


@query(
    "bpe_train_long",
    f"WITH {sq.train()} SELECT rank, l, r, token_id, cnt, {LONG_RULES}::BIGINT AS n_rules, {LONG_RULES}::BIGINT AS n_older, {LONG_RULES}::BIGINT AS n_once, {LONG_RULES}::BIGINT AS n_falling FROM merges",
)
def bpe_train_long(spark, sf_dir):
    """The first of a thousand rules, with how many of all keep what holds of greedy training."""
    tok = vb.train_tokenizer(inputs.heavy_documents(spark, sf_dir), 256 + LONG_RULES, "doc_id")
    rules = vb.rule_checks(vb.merge_table(spark, tok))
    kept = [F.sum(F.col(c).cast("bigint")).alias(f"n_{name}") for c, name in (("older_parts", "older"), ("once", "once"), ("falling", "falling"))]
    told = rules.agg(F.count("*").alias("n_rules"), *kept)
    first = rules.where(F.col("rank") < sq.N_MERGES).select("rank", "l", "r", "token_id", "cnt")
    return first.join(F.broadcast(told))


@query("bpe_train", f"WITH {sq.train()} SELECT rank, l, r, token_id, cnt FROM merges")
def bpe_train(spark, sf_dir):
    """Merge rules learnt from all documents; trains anew on every call."""
    docs = inputs.heavy_documents(spark, sf_dir)
    tok = vb.train_tokenizer(docs, 256 + sq.N_MERGES, "doc_id")
    return vb.merge_table(spark, tok)


@query(
    "bpe_train_specials_reserved",
    f"WITH {sq.train(16, digits=2)} SELECT rank, l, r, token_id, cnt FROM merges",
)
def bpe_train_specials_reserved(spark, sf_dir):
    """Room for the special tokens is taken off the size; digit runs of two."""
    tok = vb.train_tokenizer(
        inputs.heavy_documents(spark, sf_dir), 256 + 16 + len(vb.SPECIAL_TOKENS), "doc_id",
        pattern=SPLIT_DIGITS_2, reserve_specials=True,
    )
    return vb.merge_table(spark, tok)


@query(
    "vocab_table",
    f"""WITH {sq.train()}, {sq.token_bytes()} SELECT token_id, upper(hx) AS token_hex, n_bytes::INT AS n_bytes, false AS is_special FROM vocab
UNION ALL SELECT {BOS} + i, hex(encode(name)), 0, true FROM (VALUES {_SPECIALS_SQL}) s(i, name)""",
)
def vocab_table(spark, sf_dir):
    vocabulary = vb.vocabulary_table(spark, inputs.tokenizer(spark, sf_dir))
    return vocabulary.select("token_id", F.hex("token_bytes").alias("token_hex"), "n_bytes", "is_special")


@query(
    "special_tokens",
    f"WITH {sq.train()} SELECT (SELECT max(token_id) + 1 FROM merges) + i AS token_id, i AS position, name FROM (VALUES {_SPECIALS_SQL}) s(i, name)",
)
def special_tokens(spark, sf_dir):
    return vb.special_table(spark, inputs.tokenizer(spark, sf_dir))


@query(
    "vocab_specials_first",
    f"""WITH {sq.train()}, a AS (SELECT i::INT AS token_id, 1 AS class, false AS is_special FROM range(256) t(i)
UNION ALL SELECT token_id, 2, false FROM merges UNION ALL SELECT {BOS} + i, 0, true FROM (VALUES {_SPECIALS_SQL}) s(i, name))
SELECT (row_number() OVER (ORDER BY class, token_id) - 1)::INT AS new_id, token_id, class, is_special FROM a""",
)
def vocab_specials_first(spark, sf_dir):
    return vb.specials_first(vb.vocabulary_table(spark, inputs.tokenizer(spark, sf_dir)))


@query(
    "token_bytes",
    f"""WITH {sq.train()}, {sq.token_bytes()} SELECT token_id, n_bytes::INT AS n_bytes FROM vocab
UNION ALL SELECT {BOS} + i, 0 FROM (VALUES {_SPECIALS_SQL}) s(i, name)""",
)
def token_bytes(spark, sf_dir):
    tok = inputs.tokenizer(spark, sf_dir)
    lengths = tk.token_lengths(tok)
    return vb.vocabulary_table(spark, tok).select("token_id", F.get(lengths, F.col("token_id")).alias("n_bytes"))


@query(
    "tokenizer_roundtrip",
    f"""WITH {sq.train()}, {sq.token_bytes()} SELECT token_id, upper(hx) AS token_hex, {BOS} AS vocab_size FROM vocab""",
)
def tokenizer_roundtrip(spark, sf_dir):
    """The artifact written and its JSON form read back."""
    tok = inputs.tokenizer(spark, sf_dir)
    docs = inputs.heavy_documents(spark, sf_dir)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    path = scratch_path(spark, "tokenizer")
    artifacts.write_tokenizer(spark, tok, path, 1, total)
    read = artifacts.read_vocabulary_json(spark, f"{path}/json")
    return read.select("token_id", F.hex("token_bytes").alias("token_hex"), "vocab_size")


@query(
    "encode_corpus",
    f"WITH {sq.train()}, {_ENCODED_DOCS} SELECT doc_id, length(syms)::INT AS n_tokens, md5({sq.joined(sq.ids('syms'))}) AS ids FROM enc",
)
def encode_corpus(spark, sf_dir):
    encoded = tk.encode_corpus(inputs.heavy_documents(spark, sf_dir), inputs.tokenizer(spark, sf_dir))
    return encoded.select("doc_id", F.size("ids").alias("n_tokens"), F.md5(_JOIN_IDS("ids")).alias("ids"))


@query(
    "encode_bos",
    f"""WITH {sq.train()}, {_ENCODED_DOCS} SELECT doc_id, {BOS} AS first_id, {BOS + 4} AS last_id,
md5('{BOS} ' || {sq.joined(sq.ids('syms'))} || ' {BOS + 4}') AS ids FROM enc""",
)
def encode_bos(spark, sf_dir):
    encoded = tk.encode_corpus(
        inputs.heavy_documents(spark, sf_dir), inputs.tokenizer(spark, sf_dir), prepend="<|bos|>", append="<|assistant_end|>"
    )
    return encoded.select(
        "doc_id", F.get("ids", F.lit(0)).alias("first_id"), F.element_at("ids", -1).alias("last_id"),
        F.md5(_JOIN_IDS("ids")).alias("ids"),
    )


@query("decode_corpus", "SELECT doc_id, md5(text) AS digest, length(text)::INT AS n_chars FROM documents")
def decode_corpus(spark, sf_dir):
    tok = inputs.tokenizer(spark, sf_dir)
    encoded = tk.encode_corpus(inputs.heavy_documents(spark, sf_dir), tok)
    decoded = encoded.select("doc_id", tk.decode_ids(tok, F.col("ids")).alias("text"))
    return decoded.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("n_chars"))


@query(
    "token_view",
    f"""WITH {sq.train()}, {sq.token_bytes()},
enc AS MATERIALIZED (SELECT item_id, {sq.encoded('text')} AS syms FROM benchmark),
t AS (SELECT item_id, unnest({sq.ids('syms')}) AS id, generate_subscripts(string_split(syms, ''), 1) AS p FROM enc)
SELECT item_id, string_agg(CASE WHEN id % 2 = 1 THEN '+' ELSE '-' END || coalesce(try(decode(unhex(hx))), replace(decode(unhex(hx), 'replace'), '?', chr(65533))) || '(' || id || ')', '|' ORDER BY p) AS view
FROM t JOIN vocab ON id = token_id GROUP BY item_id""",
)
def token_view(spark, sf_dir):
    """Tokens of the benchmark texts; odd ids stand for supervised ones."""
    tok = inputs.tokenizer(spark, sf_dir)
    encoded = tk.encode_corpus(inputs.table(spark, sf_dir, "benchmark"), tok)
    mask = F.transform("ids", lambda i: i % 2)
    return encoded.select("item_id", tk.token_view(tok, F.col("ids"), mask, with_id=True).alias("view"))


@query(
    "vocab_stats",
    f"""WITH {sq.train()}, {sq.token_bytes()} SELECT count(*) + {len(vb.SPECIAL_TOKENS)} AS vocab_size, {len(vb.SPECIAL_TOKENS)}::BIGINT AS n_special,
max(n_bytes)::INT AS longest_token FROM vocab""",
)
def vocab_stats(spark, sf_dir):
    return vb.vocabulary_stats(vb.vocabulary_table(spark, inputs.tokenizer(spark, sf_dir)))


@query(
    "compression_ratio",
    f"""WITH {sq.train()}, {_ENCODED_DOCS} SELECT coalesce(lang, 'all') AS lang, sum(octet_length(encode(text)))::BIGINT AS n_bytes,
sum(length(syms))::BIGINT AS n_tokens, sum(octet_length(encode(text)))::DOUBLE / sum(length(syms))::DOUBLE AS ratio FROM enc GROUP BY ROLLUP(lang)""",
)
def compression_ratio(spark, sf_dir):
    encoded = tk.encode_corpus(inputs.heavy_documents(spark, sf_dir), inputs.tokenizer(spark, sf_dir))
    return tk.compression_ratio(encoded, "lang").withColumn("lang", F.coalesce("lang", F.lit("all")))
