"""Inference requests: parsing, defaults, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults of a request.
DEFAULT_MAX_TOKENS, DEFAULT_TEMPERATURE, DEFAULT_TOP_K = 256, 1.0, 50
_REQUEST = (
    "input struct<messages:array<struct<role:string,content:string>>,"
    "max_tokens:int,temperature:double,top_k:int>"
)


def validate_requests(df: DataFrame, request: str = "request") -> DataFrame:
    """Parsed request with defaults and the first error, null when it is valid.

    Works row by row, on tables and on streams alike.
    """
    parsed = df.withColumn("_input", F.from_json(request, _REQUEST)["input"])
    messages = F.col("_input")["messages"]
    incomplete = lambda m: m["role"].isNull() | m["content"].isNull()
    # Messages are looked at in order: whichever fault comes first is reported.
    # The error texts.
    faults = F.filter(
        F.transform(
            messages,
            lambda m: F.when(incomplete(m), "Each message must have 'role' and 'content'").when(
                ~m["role"].isin("user", "assistant"),
                F.concat(F.lit("Invalid role: "), m["role"], F.lit(". Must be 'user' or 'assistant'")),
            ),
        ),
        lambda e: e.isNotNull(),
    )
    error = (
        F.when(messages.isNull() | (F.size(messages) == 0), "No messages provided")
        .when(F.size(faults) > 0, F.get(faults, F.lit(0)))
        .when(F.element_at(messages, -1)["role"] != "user", "Last message must be from 'user'")
    )
    return parsed.select(
        *df.columns,
        messages.alias("messages"),
        F.coalesce(F.col("_input")["max_tokens"], F.lit(DEFAULT_MAX_TOKENS)).alias("max_tokens"),
        F.coalesce(F.col("_input")["temperature"], F.lit(DEFAULT_TEMPERATURE)).alias("temperature"),
        F.coalesce(F.col("_input")["top_k"], F.lit(DEFAULT_TOP_K)).alias("top_k"),
        error.alias("error"),
    )
