"""Scans, sinks and corpus preparation over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardloom.functions.text import draw, seeded_hash
from shardloom.operators import corpus, mix, tasks
from shardloom.plans import inputs
from shardloom.plans.registry import query, table
from shardloom.plans.sqltext import draw as sql_draw
from shardloom.session import scratch_path
from shardloom.sources import conversations as conv_source
from shardloom.sources import shards
from shardloom.sources.row_groups import scan_row_groups

SHARD_ROWS = 64  # documents per shard of the derived shard folders


def _sharded(spark, sf_dir):
    shard = F.expr(f"doc_id div {SHARD_ROWS}").cast("int")
    return inputs.documents(spark, sf_dir).withColumn("shard_id", shard)


def _written_shards(spark, sf_dir):
    """``documents`` written as numbered shard files, plus a half-written leftover."""
    path = scratch_path(spark, "shards")
    docs = _sharded(spark, sf_dir)
    shards.export_shards(docs.select("doc_id", "text", "shard_id"), path)
    docs.select("text").write.text(f"{path}/shard_99999.parquet.tmp")
    return path


@query("shard_scan", "SELECT doc_id // 64 AS shard_id, count(*) AS n_rows, sum(octet_length(encode(text)))::BIGINT AS n_bytes FROM documents GROUP BY 1")
def shard_scan(spark, sf_dir):
    """A folder of shards read back with its shard numbers."""
    df = shards.scan_shards(spark, _written_shards(spark, sf_dir))
    return df.groupBy(F.col("shard_id").cast("bigint").alias("shard_id")).agg(
        F.count("*").alias("n_rows"), F.sum(F.octet_length("text")).alias("n_bytes")
    )


@query(
    "split_scan",
    """WITH s AS (SELECT doc_id, doc_id // 64 AS shard_id, text FROM documents), l AS (SELECT max(shard_id) AS last FROM s)
SELECT CASE WHEN shard_id = last THEN 'val' ELSE 'train' END AS split, count(*) AS n_docs, sum(length(text))::BIGINT AS n_chars,
min(shard_id)::INT AS first_shard FROM s, l GROUP BY 1""",
)
def split_scan(spark, sf_dir):
    """The last shard lies in a folder of its own and is the validation split."""
    docs = _sharded(spark, sf_dir)
    last = docs.agg(F.max("shard_id")).first()[0]
    folders = {split: scratch_path(spark, split) for split in ("train", "val")}
    for split, path in folders.items():
        shards.export_shards(shards.split_by_shard(docs, split, last).select("text", "shard_id"), path)
    parts = [
        shards.scan_split(spark, split, folders["train"], folders["val"]).withColumn("split", F.lit(split))
        for split in folders
    ]
    return parts[0].unionByName(parts[1]).groupBy("split").agg(
        F.count("*").alias("n_docs"), F.sum(F.length("text")).alias("n_chars"), F.min("shard_id").alias("first_shard")
    )


@query("stride_assign", "SELECT doc_id, doc_id // 16 AS unit, ((doc_id // 16) % 4)::INT AS rank FROM documents")
def stride_assign(spark, sf_dir):
    """Units of 16 documents dealt to four workers."""
    units = inputs.documents(spark, sf_dir).select("doc_id", F.expr("doc_id div 16").alias("unit"))
    return shards.assign_ranks(units, "unit", 4)


@query(
    "row_group_assign",
    """SELECT doc_id, (doc_id // 64)::INT AS shard_id, (doc_id % 64 // 16)::INT AS row_group, (doc_id % 64 // 16 % 3)::INT AS rank, length(text)::INT AS n_chars
FROM documents""",
)
def row_group_assign(spark, sf_dir):
    """Row groups of written shards dealt to three workers; each worker reads its own alone."""
    path = scratch_path(spark, "shards")
    docs = _sharded(spark, sf_dir).select("doc_id", "text", "shard_id")
    shards.export_shards(docs, path, order="doc_id", group_rows=16)
    parts = [scan_row_groups(spark, path, ["doc_id", "text"], rank, 3) for rank in range(3)]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    shard = F.regexp_extract("file_name", r"(\d+)", 1).cast("int")
    return every.select("doc_id", shard.alias("shard_id"), "row_group", "rank", F.length("text").alias("n_chars"))


@query(
    "shard_land",
    f"""SELECT doc_id // 64 AS shard_id, count(*) AS n_rows, ({sql_draw("'present|' || (doc_id // 64)", 2)} = 0) AS was_present
FROM documents GROUP BY 1, 3""",
)
def shard_land(spark, sf_dir):
    """Half of the shards are present, each fifth of them in part; landing adds and completes the others and repeats none."""
    target = scratch_path(spark, "landed")
    docs = _sharded(spark, sf_dir).select("doc_id", "text", "shard_id")
    present = draw(seeded_hash("present", F.col("shard_id")), 2) == 0
    shards.land_shards(docs.where(present & ((F.col("shard_id") % 5 > 0) | (F.col("doc_id") % 2 == 0))), target)
    landed = shards.land_shards(docs, target)
    return landed.groupBy(F.col("shard_id").cast("bigint").alias("shard_id")).agg(F.count("*").alias("n_rows")).withColumn(
        "was_present", present
    )


@query(
    "shard_inventory",
    "SELECT (doc_id // 64)::INT AS shard_id, count(*) AS n_rows, sum(octet_length(encode(text)))::BIGINT AS n_bytes FROM documents GROUP BY 1",
)
def shard_inventory(spark, sf_dir):
    """Shards by the numbers in their file names, with what the files hold."""
    path = _written_shards(spark, sf_dir)
    held = shards.shard_inventory(shards.scan_shards(spark, path))
    return shards.shard_ids(spark, path).join(held, "shard_id")


@query(
    "jsonl_scan",
    """SELECT md5(string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS digest, count(*)::INT AS n_messages FROM conversations
GROUP BY conv_id""",
)
def jsonl_scan(spark, sf_dir):
    """Conversations written as JSON lines (arrays and objects, blank lines) and read back."""
    rows = inputs.chat(spark, sf_dir)
    lines = conv_source.to_lines(
        rows.selectExpr("idx", "messages", "cast(null as array<string>) letters", "cast(null as string) subject",
                        "cast(null as string) entry_point", "cast(null as string) test")
    )
    bare = F.regexp_replace("value", r'(?s)^\{"messages":(.*)\}$', "$1")
    mixed = lines.select(F.when(F.col("idx") % 2 == 0, bare).otherwise(F.col("value")).alias("value"))
    path = scratch_path(spark, "lines")
    mixed.select(F.explode(F.array("value", F.lit(" "))).alias("value")).write.text(path)
    parsed = conv_source.scan_jsonl(spark, path)
    text = F.array_join(
        F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["parts"][0]["text"])), "\n"
    )
    return parsed.select(F.md5(text).alias("digest"), F.size("messages").alias("n_messages"))


@query(
    "bench_scan",
    f"""WITH {inputs.MMLU_SQL} SELECT idx, md5(question) AS question, answer, subject FROM mmlu WHERE idx % 3 = 0""",
)
def bench_scan(spark, sf_dir):
    """The wrapped training subset of a benchmark table, opened."""
    rows = inputs.mmlu(spark, sf_dir)
    subset = F.when(F.col("idx") % 3 == 0, "auxiliary_train").otherwise("all")
    stored = rows.select(
        subset.alias("subset"),
        F.when(F.col("idx") % 3 == 0, "train").otherwise("test").alias("split"),
        F.struct("idx", "question", "choices", "answer", "subject").alias("train"),
    )
    path = scratch_path(spark, "bench")
    stored.write.partitionBy("subset", "split").parquet(path)
    opened = conv_source.select_benchmark(spark.read.parquet(path), "mmlu", "auxiliary_train", "train")
    return opened.select("idx", F.md5("question").alias("question"), "answer", "subject")


@query("word_list", f"WITH {inputs.WORDS_SQL} SELECT word, length(word)::INT AS n_letters FROM words")
def word_list(spark, sf_dir):
    path = scratch_path(spark, "words")
    inputs.words(spark, sf_dir).write.text(path)
    return conv_source.scan_words(spark, path).select("word", F.length("word").alias("n_letters"))


@query(
    "jsonl_sink",
    """SELECT '{"messages":[' || string_agg('{"role":' || to_json(role)::VARCHAR || ',"content":' || to_json(text)::VARCHAR || '}', ',' ORDER BY turn) || ']}' AS line
FROM conversations GROUP BY conv_id""",
)
def jsonl_sink(spark, sf_dir):
    """The lines of a written mixture."""
    rows = tasks.chat_conversations(inputs.chat(spark, sf_dir))
    path = conv_source.write_jsonl(rows, scratch_path(spark, "sink"), "sft", "d4", "train", order="idx")
    return spark.read.text(path).select(F.col("value").alias("line"))


@query(
    "dataset_info",
    """WITH m AS (SELECT CASE WHEN doc_id % 10 = 0 THEN 'val' ELSE 'train' END AS split, lang AS task FROM documents
UNION ALL SELECT 'train', 'chat' FROM (SELECT DISTINCT conv_id FROM conversations))
SELECT split, count(*) AS size, count(DISTINCT task) AS n_datasets, string_agg(DISTINCT task, ',' ORDER BY task) AS datasets FROM m GROUP BY split""",
)
def dataset_info(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir).select(
        F.when(F.col("doc_id") % 10 == 0, "val").otherwise("train").alias("split"), F.col("lang").alias("task")
    )
    talks = table(spark, sf_dir, "conversations").select("conv_id").distinct().select(
        F.lit("train").alias("split"), F.lit("chat").alias("task")
    )
    info = mix.dataset_info(docs.unionByName(talks))
    return info.withColumn("datasets", F.array_join("datasets", ","))


@query(
    "prep_corpus",
    f"""WITH t AS (SELECT doc_id, CASE WHEN {sql_draw("'null|' || doc_id", 7)} = 0 THEN NULL ELSE text END AS text FROM documents)
SELECT doc_id, octet_length(encode(text))::INT AS n_bytes, md5(text) AS digest FROM t WHERE text IS NOT NULL""",
)
def prep_corpus(spark, sf_dir):
    """Null texts (one in seven, made null here) are dropped."""
    absent = draw(seeded_hash("null", F.col("doc_id")), 7) == 0
    docs = inputs.documents(spark, sf_dir).select("doc_id", F.when(~absent, F.col("text")).alias("text"))
    kept = corpus.prepare_corpus(docs, "doc_id")
    return kept.select("doc_id", F.octet_length("text").alias("n_bytes"), F.md5("text").alias("digest"))


@query(
    "doc_cap",
    r"""WITH b AS (SELECT doc_id, text, substr(hex(encode(text)), 1, 2000) AS h, substr(hex(encode(text)), 2001, 2) AS nxt FROM documents),
c AS (SELECT doc_id, text, CASE WHEN octet_length(encode(text)) <= 1000 THEN text
 WHEN nxt >= '80' AND nxt < 'C0' THEN decode(unhex(regexp_replace(h, '(..)((?:C|D|E|F).(?:[89AB].)*)$', '\1'))) ELSE decode(unhex(h)) END AS capped FROM b)
SELECT doc_id, octet_length(encode(capped))::INT AS n_bytes, md5(capped) AS digest FROM c""",
)
def doc_cap(spark, sf_dir):
    """At most 1,000 bytes, never half a character."""
    capped = corpus.cap_documents(inputs.documents(spark, sf_dir), 1000)
    return capped.select("doc_id", F.octet_length("text").alias("n_bytes"), F.md5("text").alias("digest"))


@query(
    "byte_budget",
    """WITH s AS (SELECT doc_id, octet_length(encode(text)) AS n, sum(octet_length(encode(text))) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
sum(octet_length(encode(text))) OVER () AS total FROM documents)
SELECT doc_id, n::INT AS n_bytes FROM s WHERE coalesce(before, 0) < total // 2""",
)
def byte_budget(spark, sf_dir):
    """Half of the corpus by bytes, in document order."""
    docs = inputs.documents(spark, sf_dir)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    kept = corpus.byte_budget(docs, "doc_id", total // 2)
    return kept.select("doc_id", F.octet_length("text").alias("n_bytes"))


@query(
    "slice_view",
    "SELECT (doc_id - 7) // 3 AS idx, lang, n_chars FROM (SELECT *, count(*) OVER () AS n FROM documents) WHERE doc_id >= 7 AND doc_id < n - n // 4 AND (doc_id - 7) % 3 = 0",
)
def slice_view(spark, sf_dir):
    docs = inputs.documents(spark, sf_dir).select(F.col("doc_id").alias("idx"), "lang", "n_chars")
    n = docs.agg(F.count("*")).first()[0]
    return corpus.slice_view(docs, 7, n - n // 4, 3)


@query("problem_cap", "SELECT o_orderkey AS idx, o_totalprice FROM orders WHERE o_orderkey < 256")
def problem_cap(spark, sf_dir):
    """The evaluation limit of 256 problems is the feature here."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx"), "o_totalprice")
    return corpus.problem_cap(orders, 256)


@query(
    "corpus_stats",
    """SELECT source, sum(length(text))::BIGINT AS n_chars, sum(length(text) - length(replace(text, chr(10), '')) + 1)::BIGINT AS n_lines,
count(*) AS n_files, (sum(length(text)) // 4)::BIGINT AS n_tokens_approx FROM documents GROUP BY source""",
)
def corpus_stats(spark, sf_dir):
    return corpus.corpus_stats(inputs.documents(spark, sf_dir), "source")
