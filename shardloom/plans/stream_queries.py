"""Structured Streaming forms, driven to the end of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shardloom.functions.text import split_pieces
from shardloom.operators.tokens import encode_corpus
from shardloom.plans import inputs
from shardloom.plans import sqltext as sq
from shardloom.plans.chat_queries import BASE, REQUESTS_SQL, request_lines, shown_requests
from shardloom.plans.registry import query
from shardloom.session import scratch_path
from shardloom.sources.shards import assign_ranks
from shardloom.streaming import levels, streams
from shardloom.streaming.ordered_pack import end_mark, pack_in_order

DOC_SCHEMA = "doc_id bigint, text string, lang string"


def _doc_files(spark, sf_dir):
    path = scratch_path(spark, "docs")
    docs = inputs.heavy_documents(spark, sf_dir).select("doc_id", "text", "lang")
    docs.repartitionByRange(8, "doc_id").write.parquet(path)
    return path


@query("stream_docs", "SELECT doc_id, lang, length(text)::INT AS n_chars FROM documents")
def stream_docs(spark, sf_dir):
    """Shard files read three at a time."""
    stream = streams.shard_stream(spark, _doc_files(spark, sf_dir), DOC_SCHEMA, files_per_trigger=3)
    return streams.run_to_table(stream.select("doc_id", "lang", F.length("text").alias("n_chars")), "stream-docs")


@query("stream_piece_counts", f"SELECT piece, count(*) AS cnt FROM (SELECT unnest({sq.pieces('text')}) AS piece FROM documents) GROUP BY piece")
def stream_piece_counts(spark, sf_dir):
    stream = streams.shard_stream(spark, _doc_files(spark, sf_dir), DOC_SCHEMA, files_per_trigger=4)
    pieces = stream.select(F.explode(split_pieces(F.col("text"))).alias("piece"))
    return levels.count_stream(pieces, "piece", scratch_path(spark, "stream-pieces"), scratch_path(spark, "progress"))


@query("stream_running_counts", "SELECT lang, count(*) AS cnt FROM documents GROUP BY lang")
def stream_running_counts(spark, sf_dir):
    """The same counts in the state store, for keys that are few."""
    stream = streams.shard_stream(spark, _doc_files(spark, sf_dir), DOC_SCHEMA, files_per_trigger=4)
    return streams.run_to_table(stream.groupBy("lang").agg(F.count("*").alias("cnt")), "stream-langs", "complete")


_STREAM_PACK_SQL = f"""WITH {sq.train()}, enc AS MATERIALIZED (SELECT doc_id, {sq.encoded('text')} AS syms FROM documents),
s AS (SELECT doc_id, doc_id // 16 % 2 AS rank, [{BASE}] || {sq.ids('syms')} AS ids FROM enc),
tok AS MATERIALIZED (SELECT doc_id, rank, unnest(ids) AS id, generate_subscripts(ids, 1) AS j FROM s),
starts AS (SELECT doc_id, coalesce(sum(len(ids)) OVER (PARTITION BY rank ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM s)
SELECT rank::INT AS rank, (o + j - 1)::BIGINT // 1025 AS window_id, md5(string_agg(id, ' ' ORDER BY o + j)) AS tokens FROM tok JOIN starts USING (doc_id) GROUP BY 1, 2 HAVING count(*) = 1025"""


@query("stream_pack", _STREAM_PACK_SQL)
def stream_pack(spark, sf_dir):
    """Shards land in three steps; the remainder of each rank is carried over."""
    tok = inputs.tokenizer(spark, sf_dir)
    source, out, progress = (scratch_path(spark, f"pack-{part}") for part in ("in", "out", "progress"))
    docs = inputs.heavy_documents(spark, sf_dir).select("doc_id", "text", F.expr("doc_id div 16").alias("unit"))
    last = docs.agg(F.max("doc_id")).first()[0]
    encoded = encode_corpus(assign_ranks(docs, "unit", 2), tok, prepend="<|bos|>").select("doc_id", "rank", "ids")
    result = None
    for step in range(3):
        low, high = (last + 1) * step // 3, (last + 1) * (step + 1) // 3
        encoded.where((F.col("doc_id") >= low) & (F.col("doc_id") < high)).write.mode("append").parquet(source)
        stream = streams.shard_stream(spark, source, "doc_id bigint, rank int, ids array<int>", files_per_trigger=10_000)
        result = streams.pack_stream(stream, "rank", "doc_id", 4, 256, out, progress)
    return result.select("rank", "window_id", F.md5(F.array_join(F.col("tokens").cast("array<string>"), " ")).alias("tokens"))


@query("stream_pack_ordered", _STREAM_PACK_SQL)
def stream_pack_ordered(spark, sf_dir):
    """The same windows from files that hold the documents in any order, one file a trigger."""
    tok = inputs.tokenizer(spark, sf_dir)
    source, out, progress = (scratch_path(spark, f"ordered-{part}") for part in ("in", "out", "progress"))
    docs = inputs.heavy_documents(spark, sf_dir).select("doc_id", "text", F.expr("doc_id div 16").alias("unit"))
    last = docs.agg(F.max("doc_id")).first()[0]
    encoded = encode_corpus(assign_ranks(docs, "unit", 2), tok, prepend="<|bos|>").select("rank", F.col("doc_id").alias("order"), "ids")
    # Dealt by hash: every file reaches over the whole order, so rows wait for all of them.
    encoded.repartition(6, F.xxhash64("order")).write.parquet(source)
    end_mark(spark, last, last + 1).coalesce(1).write.mode("append").parquet(source)
    stream = streams.shard_stream(spark, source, "rank int, order bigint, ids array<int>", files_per_trigger=1)
    result = pack_in_order(stream, "rank", "order", 4 * 256 + 1, last + 1, out, progress)
    return result.select("rank", "window_id", F.md5(F.array_join(F.col("tokens").cast("array<string>"), " ")).alias("tokens"))


@query("stream_requests", REQUESTS_SQL)
def stream_requests(spark, sf_dir):
    source = scratch_path(spark, "requests")
    request_lines(spark, sf_dir).write.parquet(source)
    stream = streams.shard_stream(spark, source, "conv_id bigint, request string")
    return shown_requests(streams.run_to_table(streams.stream_requests(stream), "stream-requests"))
