"""Run metrics and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators.ordered import running

# Report sections in order, metric names, stage names, hourly rates.
SECTION_ORDER = (
    "tokenizer-training", "tokenizer-evaluation", "base-model-training", "base-model-loss",
    "base-model-evaluation", "midtraining", "chat-evaluation-mid", "chat-sft",
    "chat-evaluation-sft", "chat-rl", "chat-evaluation-rl",
)
STAGES = ("base", "mid", "sft", "rl")
CHAT_METRICS = ("ARC-Easy", "ARC-Challenge", "MMLU", "GSM8K", "HumanEval", "ChatCORE")
HOURLY_RATES = (("H100", 3.00), ("A100", 1.79), ("V100", 0.55))
DEFAULT_RATE = 2.0


def slugify(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit("-"))


def _to_even(number: Column) -> Column:
    """A number whose fifth decimal is an exact half, moved towards the even fourth one.

    Exact halves of a ten-thousandth are the odd multiples of 1/32; the formatter
    would round them up.
    """
    steps = F.abs(number) * 32
    half = (steps == F.floor(steps)) & (F.pmod(steps, F.lit(2.0)) == 1)
    even_below = F.pmod(F.floor(F.abs(number) * 10_000), F.lit(2)) == 0
    return F.when(half & even_below, number - F.signum(number) * 0.00001).otherwise(number)


def format_value(kind: Column, value: Column) -> Column:
    """Floats with four decimals, integers from 10,000 with separators, else as is."""
    number = F.when(kind.isin("float", "int"), value.cast("double"))
    whole = F.when(kind == "int", value.cast("bigint"))
    return (
        F.when(kind == "float", F.format_string("%.4f", _to_even(number)))
        .when((kind == "int") & (whole >= 10000), F.format_number(whole, 0))
        .otherwise(value)
    )


def section_text(metrics: DataFrame, section: str = "section") -> DataFrame:
    """Markdown of every section from rows ``section, ts, ord, key, kind, value``.

    An item of kind ``raw`` is text that goes in as it is, without key and line end; an empty one is skipped. A
    metric without a value shows ``None``. A section is one document of metric
    lines, so its lines meet in one row.
    """
    shown = F.coalesce(format_value(F.col("kind"), F.col("value")), F.lit("None"))  # fixed value: the text of no value
    line = F.concat(F.lit("- "), "key", F.lit(": "), shown, F.lit("\n"))
    is_raw = F.col("kind").eqNullSafe("raw")
    item = F.when(is_raw, F.nullif("value", F.lit(""))).otherwise(line)
    lines = F.array_sort(F.collect_list(F.when(item.isNotNull(), F.struct("ord", item.alias("line")))))
    body = F.array_join(F.transform(lines, lambda l: l["line"]), "")
    stamp = F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss")
    text = F.concat(F.lit("## "), F.col(section), F.lit("\ntimestamp: "), "_stamp", F.lit("\n\n"), "_body", F.lit("\n"))
    return (
        metrics.groupBy(section).agg(stamp.alias("_stamp"), body.alias("_body"))
        .select(slugify(F.col(section)).alias("slug"), section, text.alias("text"))
    )


def extract_metrics(sections: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Value of each key of a section: text between the first and second colon.

    Keys must match whole, not as part of a longer name; the last line wins.
    """
    lines = sections.select(
        *[c for c in sections.columns if c != text], F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    )
    key = F.trim(F.regexp_replace(F.element_at(F.split("line", ":"), 1), r"^-\s*", ""))
    value = F.trim(F.get(F.split("line", ":"), F.lit(1)))
    others = [c for c in sections.columns if c != text]
    found = lines.select(*others, "line_no", key.alias("key"), value.alias("value")).where(
        F.col("key").isin(*keys) & F.col("value").isNotNull()
    )
    return found.groupBy(*others, "key").agg(F.max_by("value", "line_no").alias("value"))


def extract_timestamp(text: Column, prefix: str) -> Column:
    """First line with the prefix that holds a time."""
    found = F.regexp_extract(text, r"(?m)^\Q" + prefix + r"\E\s*(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)\s*$", 1)
    return F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("yyyy-MM-dd HH:mm:ss"))


def summary_matrix(metrics: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Metric by stage with ``-`` for absent values; CORE first, ChatCORE last."""
    table = metrics.groupBy("metric").pivot("stage", list(stages)).agg(F.first("value"))
    filled = table.select("metric", *[F.coalesce(F.col(s), F.lit("-")).alias(s) for s in stages])
    place = F.when(F.col("metric") == "CORE", 0).when(F.col("metric") == "ChatCORE", 2).otherwise(1)
    return filled.withColumn("place", place).orderBy("place", "metric")


def wall_clock(sections: DataFrame, start: Column, *group: str) -> DataFrame:
    """Time from the start to the last section that is not of the RL stage, as ``XhYm``."""
    ends = sections.where(~F.contains("slug", F.lit("rl"))).groupBy(*group).agg(
        F.min(start).alias("_start"), F.max("ts").alias("_end")
    )
    seconds = F.timestamp_diff("SECOND", F.col("_start"), F.col("_end"))
    text = F.concat(F.expr("seconds div 3600").cast("string"), F.lit("h"),
                    F.expr("(seconds % 3600) div 60").cast("string"), F.lit("m"))
    return ends.withColumn("seconds", seconds).select(*group, "seconds", text.alias("wall_clock"))


def run_catalog(listing: DataFrame) -> DataFrame:
    """Highest step and last change of every model tag, from rows ``path, modified``."""
    tag = F.regexp_extract("path", r"([^/]+)/model_\d+\.pt$", 1)
    step = F.regexp_extract("path", r"model_(\d+)\.pt$", 1).cast("int")
    return (
        listing.where(F.col("path").rlike(r"[^/]+/model_\d+\.pt$"))
        .groupBy(tag.alias("tag"))
        .agg(F.max(step).alias("last_step"), F.max("modified").alias("modified"), F.count("*").alias("n_files"))
        .withColumn("depth", F.nullif(F.regexp_extract("tag", r"^d(\d+)", 1), F.lit("")).cast("int"))
    )


def largest_model(catalog: DataFrame) -> DataFrame:
    """The deepest tag, or the latest one where no tag names a depth."""
    return catalog.orderBy(F.desc_nulls_last("depth"), F.desc("modified"), "tag").limit(1)


def best_so_far(log: DataFrame, run: str = "run", step: str = "step", value: str = "value") -> DataFrame:
    """Running minimum of every run, the current step included."""
    return running(log, step, F.col(value), "best", by=[run], agg=F.min, inclusive=True)


def thin_log(log: DataFrame, every: int, step: str = "step") -> DataFrame:
    return log.where(F.col(step) % every == 0)


def run_cost(runs: DataFrame, device: str = "device", count: str = "n_devices", hours: str = "hours") -> DataFrame:
    """Hourly rate and total; the first known device name found in the text decides."""
    rate = F.lit(None).cast("double")
    for name, price in reversed(HOURLY_RATES):
        rate = F.when(F.contains(device, F.lit(name)), F.lit(price)).otherwise(rate)
    hourly = F.coalesce(rate, F.lit(DEFAULT_RATE)) * F.col(count)
    return runs.withColumn("hourly_rate", hourly).withColumn("total", F.col("hourly_rate") * F.col(hours))


def section_order(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(SECTION_ORDER)), "ord int, slug string")


def assemble_report(sections: DataFrame, header: Column, summary: Column, *group: str) -> DataFrame:
    """Header, the expected sections in order, summary; absent sections are skipped.

    At most one row per expected section and group, so groups stay small.
    """
    spark = sections.sparkSession
    known = sections.join(F.broadcast(section_order(spark)), "slug")
    ordered = F.array_sort(F.collect_list(F.struct("ord", "text")))
    body = F.array_join(F.transform(ordered, lambda s: F.concat(s["text"], F.lit("\n"))), "")
    return known.groupBy(*group).agg(body.alias("_body")).select(
        *group, F.concat(header, "_body", summary).alias("report")
    )
