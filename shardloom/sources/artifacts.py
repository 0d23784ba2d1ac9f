"""The tokenizer artifact: parquet tables and the single-line JSON form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators.vocabulary import (
    N_BYTES, SPECIAL_TOKENS, Tokenizer, merge_table, vocabulary_table,
)

_JSON = (
    "vocab_size int, pattern string, "
    "mergeable_ranks array<struct<bytes array<int>, token_id int>>, "
    "num_training_files bigint, max_chars_processed bigint"
)
REQUIRED_FIELDS = ("vocab_size", "pattern", "mergeable_ranks")


def write_tokenizer(
    spark: SparkSession, tok: Tokenizer, path: str, num_training_files: int, bytes_processed: int
) -> None:
    """Merge rules and vocabulary as parquet, and the JSON export.

    All three are as small as the vocabulary; ``bytes_processed`` is the real total.
    """
    merge_table(spark, tok).coalesce(1).write.parquet(f"{path}/merges")
    vocabulary = vocabulary_table(spark, tok)
    vocabulary.coalesce(1).write.parquet(f"{path}/vocabulary")
    tokenizer_json(vocabulary, tok.pattern, num_training_files, bytes_processed).write.text(f"{path}/json")


def tokenizer_json(vocabulary: DataFrame, pattern: str, num_training_files: int, bytes_processed: int) -> DataFrame:
    hexes = F.regexp_extract_all(F.hex("token_bytes"), F.lit("(..)"), F.lit(1))
    as_ints = F.transform(hexes, lambda h: F.conv(h, 16, 10).cast("int"))
    entry = F.struct(as_ints.alias("bytes"), "token_id")
    ranks = F.array_sort(F.collect_list(entry), lambda a, b: a["token_id"] - b["token_id"])
    return vocabulary.where(~F.col("is_special")).agg(
        F.count("*").cast("int").alias("vocab_size"), ranks.alias("mergeable_ranks")
    ).select(
        F.to_json(
            F.struct(
                "vocab_size", F.lit(pattern).alias("pattern"), "mergeable_ranks",
                F.lit(num_training_files).alias("num_training_files"),
                F.lit(bytes_processed).alias("max_chars_processed"),
            )
        ).alias("value")
    )


def read_vocabulary_json(spark: SparkSession, path: str) -> DataFrame:
    """Token table of a JSON export; fails when a required field is missing."""
    parsed = spark.read.text(path).select(F.from_json("value", _JSON).alias("t"))
    missing = F.lit(False)
    for name in REQUIRED_FIELDS:
        missing = missing | F.col("t")[name].isNull()
    present = F.when(missing, F.raise_error(F.lit("tokenizer file lacks a required field")).cast("boolean")).otherwise(True)
    entry = F.explode("t.mergeable_ranks").alias("e")
    rows = parsed.where(present).select(F.col("t.vocab_size").alias("vocab_size"), F.col("t.pattern").alias("pattern"), entry)
    to_hex = lambda b: F.lpad(F.hex(b.cast("bigint")), 2, "0")
    return rows.select(
        "vocab_size", "pattern", F.col("e.token_id").alias("token_id"),
        F.unhex(F.array_join(F.transform("e.bytes", to_hex), "")).alias("token_bytes"),
    )


def read_tokenizer(spark: SparkSession, path: str, pattern: str, specials: tuple[str, ...] = SPECIAL_TOKENS) -> Tokenizer:
    rows = spark.read.parquet(f"{path}/merges").orderBy("rank").collect()
    if any(r.token_id != N_BYTES + i for i, r in enumerate(rows)):
        raise ValueError("merge table has gaps")
    return Tokenizer(tuple((r.l, r.r, r.cnt) for r in rows), pattern, specials)
