"""Quality checks; every check is one row of the same shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of the checks.
MIN_COMPRESSION = 1.5
MAX_EXTRA_TOKENS_PCT = 30.0
ACCURACY_LIMITS = {"MMLU": 0.28, "ARC-Easy": 0.30}
RANDOM_BASELINE = 0.25
CHECKED_PROBLEMS = 256

CHECK_SCHEMA = (
    "check_name string, passed boolean, blocking boolean, severity string, "
    "description string, metadata map<string,string>"
)


def check_row(
    df: DataFrame, name: Column | str, passed: Column, blocking: bool, description: Column, metadata: dict[str, Column]
) -> DataFrame:
    pairs = [c for key, value in metadata.items() for c in (F.lit(key), value.cast("string"))]
    return df.select(
        (F.lit(name) if isinstance(name, str) else name).alias("check_name"),
        passed.alias("passed"),
        F.lit(blocking).alias("blocking"),
        F.when(passed, "INFO").otherwise("ERROR" if blocking else "WARN").alias("severity"),
        description.alias("description"),
        F.create_map(*pairs).alias("metadata"),
    )


def check_tokenizer(vocabulary: DataFrame, declared_size: int | Column, has_pattern: bool = True) -> DataFrame:
    """Declared size equals the number of tokens, 256 at least, ids dense, bytes distinct."""
    facts = vocabulary.where(~F.col("is_special")).agg(
        F.count("*").alias("actual"),
        F.countDistinct("token_id").alias("ids"),
        F.max("token_id").alias("top"),
        F.countDistinct("token_bytes").alias("byte_strings"),
        F.sum(F.col("token_bytes").isNull().cast("int")).alias("no_bytes"),
    )
    declared = declared_size if isinstance(declared_size, Column) else F.lit(declared_size)
    actual = F.col("actual")
    gaps = (F.col("ids") != actual) | (F.col("top") != actual - 1)
    description = (
        F.when(F.lit(not has_pattern) | (F.col("no_bytes") > 0), "missing required fields")
        .when(declared != actual, F.concat(F.lit("declared "), declared.cast("string"), F.lit(", found "), actual.cast("string")))
        .when(declared < 256, "vocabulary smaller than the byte alphabet")
        .when(gaps, "token ids are not dense")
        .otherwise("tokenizer is valid")
    )
    duplicates = actual - F.col("byte_strings") - F.col("no_bytes")
    return check_row(
        facts, "tokenizer_file_valid", description == "tokenizer is valid", True, description,
        {"declared": declared, "actual": actual, "duplicate_bytes": duplicates},
    )


def check_roundtrip(df: DataFrame, text: str, decoded: Column) -> DataFrame:
    """decode(encode(text)) gives the text back, for every row."""
    bad = df.agg(
        F.sum((~decoded.eqNullSafe(F.col(text))).cast("int")).alias("bad"), F.count("*").alias("n")
    )
    return check_row(
        bad, "tokenizer_encode_decode", F.col("bad") == 0, False,
        F.concat(F.col("bad").cast("string"), F.lit(" of "), F.col("n").cast("string"), F.lit(" texts changed")),
        {"bad": F.col("bad"), "n": F.col("n")},
    )


def check_compression(ratios: DataFrame, group: str) -> DataFrame:
    """Overall ratio against its limit; ``ratios`` is the rollup of compression_ratio."""
    overall = ratios.where(F.col(group).isNull())
    ratio = F.col("ratio")
    return check_row(
        overall, "tokenizer_compression_ratio", ratio >= MIN_COMPRESSION, False,
        F.concat(F.lit("bytes per token: "), F.format_string("%.2f", ratio)),
        {"n_bytes": F.col("n_bytes"), "n_tokens": F.col("n_tokens")},
    )


def compare_tokenizers(counts: DataFrame, group: str, ours: str = "our_tokens", base: str = "base_tokens") -> DataFrame:
    """Token counts of two tokenizers per text type.

    ``extra_pct`` is how many more tokens we need; above the limit the check
    fails. ``counts``: one row per text with both counts and ``n_bytes``.
    """
    sums = counts.groupBy(group).agg(
        F.sum("n_bytes").alias("n_bytes"), F.sum(ours).alias("our_tokens"), F.sum(base).alias("base_tokens")
    )
    ratio = lambda n: F.when(F.col(n) > 0, F.col("n_bytes") / F.col(n)).otherwise(F.lit(0.0))
    extra = F.when(
        F.col("base_tokens") > 0,
        (F.col("our_tokens") - F.col("base_tokens")) / F.col("base_tokens") * 100,
    ).otherwise(F.lit(0.0))
    return sums.select(
        group, "n_bytes", "our_tokens", "base_tokens", ratio("our_tokens").alias("our_ratio"),
        ratio("base_tokens").alias("base_ratio"), extra.alias("extra_pct"),
        (extra <= MAX_EXTRA_TOKENS_PCT).alias("passed"),
    )


def check_accuracy(accuracies: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Accuracy per task (``task, n, n_correct, accuracy``) against its limit."""
    spark = accuracies.sparkSession
    rows = list((limits or ACCURACY_LIMITS).items())
    limit = F.broadcast(spark.createDataFrame(rows, "task string, min_accuracy double"))
    joined = accuracies.where(F.col("task").isNotNull()).join(limit, "task")
    passed = F.col("accuracy") >= F.col("min_accuracy")
    return check_row(
        joined, F.concat(F.lit("sft_accuracy_"), F.col("task")), passed, False,
        F.concat(F.format_string("%.4f", "accuracy"), F.lit(" against "), F.format_string("%.2f", "min_accuracy")),
        {"n": F.col("n"), "n_correct": F.col("n_correct"), "baseline": F.lit(RANDOM_BASELINE)},
    )


def union_checks(*checks: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def check_gate(checks: DataFrame) -> DataFrame:
    """Downstream work stops when a blocking check failed."""
    failed = ~F.col("passed")
    return checks.agg(
        F.count("*").alias("n_checks"),
        F.sum(failed.cast("int")).alias("n_failed"),
        F.sum((failed & ~F.col("blocking")).cast("int")).alias("n_warnings"),
        F.bool_or(failed & F.col("blocking")).alias("stop"),
    )
