"""Corpus preparation: null drop, byte cap, byte budget, slices, size facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.functions.text import cap_bytes
from shardloom.operators.ordered import RANGE, with_ranges
from shardloom.session import materialize


def drop_null_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(F.col(text).isNotNull())


def cap_documents(df: DataFrame, cap: int, text: str = "text") -> DataFrame:
    return df.withColumn(text, cap_bytes(F.col(text), cap))


def budget_cut(df: DataFrame, key: str, max_bytes: int, text: str = "text"):
    """First key whose preceding documents already fill the budget, or None.

    The texts are read once, for their sizes, which are written beside. Range
    totals (a few thousand numbers at most) name the range in which the budget
    runs out; only that range is then ordered.
    """
    sizes = materialize(df.select(key, F.octet_length(text).alias("_bytes")), "sizes")
    slim = with_ranges(sizes, key)
    totals = slim.groupBy(RANGE).agg(F.sum("_bytes").alias("n")).orderBy(RANGE).collect()
    filled = 0
    for row in totals:
        if filled + row.n >= max_bytes:
            break
        filled += row.n
    else:
        return None
    before = Window.partitionBy(RANGE).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    inside = slim.where(F.col(RANGE) == row[RANGE]).withColumn(
        "_before", F.coalesce(F.sum("_bytes").over(before), F.lit(0)) + F.lit(filled)
    )
    cut = inside.where(F.col("_before") >= max_bytes).agg(F.min(key)).first()[0]
    if cut is not None:
        return cut
    later = slim.where(F.col(RANGE) > row[RANGE]).agg(F.min(key)).first()[0]
    return later


def byte_budget(df: DataFrame, key: str, max_bytes: int, text: str = "text") -> DataFrame:
    """Documents in key order until the total reaches the budget.

    The document that crosses is kept; 0 turns the budget off. The result is a
    plain filter on the key, so no text is shuffled and the scan can skip files.
    """
    if max_bytes <= 0:
        return df
    cut = budget_cut(df, key, max_bytes, text)
    return df if cut is None else df.where(F.col(key) < F.lit(cut))


def prepare_corpus(
    df: DataFrame, key: str, text: str = "text", doc_cap: int = 0, max_bytes: int = 0
) -> DataFrame:
    """Null drop, then cap, then budget."""
    capped = cap_documents(drop_null_text(df, text), doc_cap, text)
    return byte_budget(capped, key, max_bytes, text)


def slice_view(
    df: DataFrame, start: int = 0, stop: int | None = None, step: int = 1, idx: str = "idx"
) -> DataFrame:
    """Rows start, start+step, ... below stop, renumbered densely from 0."""
    if start < 0:
        raise ValueError(f"start must not be negative, got {start}")
    if stop is not None and stop < start:
        raise ValueError(f"stop {stop} lies before start {start}")
    if step < 1:
        raise ValueError(f"step must be positive, got {step}")
    if (start, stop, step) == (0, None, 1):
        return df
    at = F.col(idx)
    keep = (at >= start) & (F.pmod(at - start, F.lit(step)) == 0)
    if stop is not None:
        keep = keep & (at < stop)
    return df.where(keep).withColumn(idx, F.expr(f"({idx} - {start}) div {step}"))


def problem_cap(df: DataFrame, max_problems: int | None, idx: str = "idx") -> DataFrame:
    return df if max_problems is None else df.where(F.col(idx) < max_problems)


def corpus_stats(df: DataFrame, group: str, text: str = "text") -> DataFrame:
    """Characters, lines, files and approximate tokens (characters over four)."""
    lines = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1
    return df.groupBy(group).agg(
        F.sum(F.length(text)).alias("n_chars"),
        F.sum(lines).alias("n_lines"),
        F.count("*").alias("n_files"),
    ).withColumn("n_tokens_approx", F.expr("n_chars div 4"))
