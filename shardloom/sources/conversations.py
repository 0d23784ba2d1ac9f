"""Conversation rows as JSON lines, in and out; word lists; benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.functions.text import json_string

ROWS_PER_FILE = 100_000  # lines of one file
PART = "struct<type:string,text:string>"
MESSAGE = f"struct<role:string,is_plain:boolean,parts:array<{PART}>>"
CONVERSATION_SCHEMA = (
    f"task string, idx bigint, messages array<{MESSAGE}>, letters array<string>, "
    "subject string, entry_point string, test string"
)
_LINE_OBJECT = (
    "messages array<struct<role string, content variant>>, letters array<string>, "
    "subject string, entry_point string, test string"
)


def plain_message(role: Column | str, text: Column) -> Column:
    """A message whose content is one plain string."""
    return F.struct(
        (F.lit(role) if isinstance(role, str) else role).alias("role"),
        F.lit(True).alias("is_plain"),
        F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))).alias("parts"),
    )


def parts_message(role: str, parts: Column) -> Column:
    """A message whose content is a list of typed parts."""
    return F.struct(
        F.lit(role).alias("role"), F.lit(False).alias("is_plain"), parts.alias("parts")
    )


def _normal_message(message: Column) -> Column:
    content = message["content"]
    kind = F.schema_of_variant(content)
    plain = kind == "STRING"
    text = F.try_variant_get(content, "$", "string")
    parts = F.try_variant_get(content, "$", f"array<{PART}>")
    return F.struct(
        message["role"].alias("role"),
        plain.alias("is_plain"),
        F.when(plain, F.array(F.struct(F.lit("text").alias("type"), text.alias("text"))))
        .otherwise(parts)
        .alias("parts"),
    )


def parse_lines(lines: DataFrame, *keys: str) -> DataFrame:
    """Parse text lines (column ``value``): an array of messages or a whole object; ``keys`` are kept.

    Blank lines are skipped. A line that is no conversation gives null messages,
    which validation reports.
    """
    kept = lines.where(F.trim("value") != "")
    is_array = F.ltrim(F.col("value")).startswith("[")
    as_object = F.when(is_array, F.concat(F.lit('{"messages":'), "value", F.lit("}"))).otherwise(
        F.col("value")
    )
    parsed = kept.select(*keys, F.from_json(as_object, _LINE_OBJECT).alias("c"))
    return parsed.select(
        *keys,
        F.transform("c.messages", _normal_message).alias("messages"),
        "c.letters",
        "c.subject",
        "c.entry_point",
        "c.test",
    )


def scan_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return parse_lines(spark.read.text(path))


def _content_json(message: Column) -> Column:
    def part_json(part: Column) -> Column:
        return F.concat(
            F.lit('{"type":'), json_string(part["type"]),
            F.lit(',"text":'), json_string(part["text"]), F.lit("}"),
        )

    listed = F.concat(
        F.lit("["), F.array_join(F.transform(message["parts"], part_json), ","), F.lit("]")
    )
    return F.when(message["is_plain"], json_string(message["parts"][0]["text"])).otherwise(listed)


def conversation_line(messages: Column, extras: dict[str, Column]) -> Column:
    """One JSON object; plain contents stay strings, absent extras are left out."""
    def message_json(message: Column) -> Column:
        return F.concat(
            F.lit('{"role":'), json_string(message["role"]),
            F.lit(',"content":'), _content_json(message), F.lit("}"),
        )

    fields = [
        F.concat(
            F.lit('"messages":['), F.array_join(F.transform(messages, message_json), ","), F.lit("]")
        )
    ]
    for name, value in extras.items():
        fields.append(F.concat(F.lit(f'"{name}":'), value))
    return F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))


def line_of() -> Column:
    """The JSON line of a conversation row."""
    extras = {
        "letters": F.to_json("letters"),
        "subject": json_string(F.col("subject")),
        "entry_point": json_string(F.col("entry_point")),
        "test": json_string(F.col("test")),
    }
    extras = {k: F.when(F.col(k).isNotNull(), v) for k, v in extras.items()}
    return conversation_line(F.col("messages"), extras)


def to_lines(df: DataFrame) -> DataFrame:
    """Conversations as JSON lines, in column ``value``."""
    return df.withColumn("value", line_of())


def jsonl_path(root: str, stage: str, tag: str, split: str) -> str:
    return f"{root}/datasets/{stage}/{tag}/{split}"


def write_jsonl(
    df: DataFrame, root: str, stage: str, tag: str, split: str, order: str | None = None, rows_per_file: int = ROWS_PER_FILE
) -> str:
    """Write ``root/datasets/<stage>/<tag>/<split>``; ``order`` keeps line order.

    ``order`` holds dense positions from 0. Line ``i`` is then line ``i mod rows_per_file`` of file
    ``i div rows_per_file``: the files are known without sampling, every task sorts one of them, and their names
    count up. Written lines are counted as they go by; positions that are not dense are an error.
    """
    path = jsonl_path(root, stage, tag, split)
    last = None if order is None else df.agg(F.max(order)).first()[0]
    if last is None and (order is None or df.isEmpty()):
        to_lines(df).select("value").write.text(path)
        return path
    if last is None:
        raise ValueError(f"rows without a position in {order!r}")
    size = last + 1
    told = Observation("lines")
    lines = to_lines(df).select("value", F.col(order).alias("_pos"), F.expr(f"cast({order} div {rows_per_file} as int)").alias("_file"))
    place = F.col("_pos").cast("decimal(38, 0)")
    counted = lines.observe(told, F.count("*").alias("n"), F.sum(place).alias("total"), F.sum(place * place).alias("squares"))
    dealt = counted.repartitionById(max(1, -(-size // rows_per_file)), "_file").sortWithinPartitions("_pos")
    dealt.select("value").write.option("maxRecordsPerFile", 0).text(path)
    found, sums = told.get, (size * (size - 1) // 2, (size - 1) * size * (2 * size - 1) // 6)
    if (found["n"], int(found["total"] or 0), int(found["squares"] or 0)) != (size, *sums):
        raise ValueError(f"positions in {order!r} are not 0 to {size - 1}: {found}")
    return path


def scan_jsonl_in_order(spark: SparkSession, path: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Lines (``pos``, ``value``) of a folder that :func:`write_jsonl` wrote in order.

    A line's place follows from its file's number and its place in the file.
    """
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("bigint")
    lines = spark.read.text(path).select("value", number.alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    # A file has rows_per_file lines at most.
    place = F.row_number().over(Window.partitionBy("file").orderBy("block", "id"))
    return lines.select((F.col("file") * rows_per_file + place - 1).alias("pos"), "value")


def scan_words(spark: SparkSession, path: str) -> DataFrame:
    """A word list, one trimmed word a line."""
    return spark.read.text(path).select(F.trim("value").alias("word"))


# Accepted subsets and splits of each benchmark.
BENCHMARK_SPLITS = {
    "mmlu": {"all": ("train", "validation", "dev", "test"), "auxiliary_train": ("train",)},
    "arc": {
        "ARC-Easy": ("train", "validation", "test"),
        "ARC-Challenge": ("train", "validation", "test"),
    },
    "gsm8k": {"main": ("train", "test"), "socratic": ("train", "test")},
    "humaneval": {"default": ("test",)},
    "smoltalk": {"default": ("train", "test")},
}


def select_benchmark(table: DataFrame, benchmark: str, subset: str, split: str) -> DataFrame:
    """One subset and split of a benchmark table; unknown names fail at once.

    Rows of ``auxiliary_train`` come wrapped in a struct ``train``, which is opened.
    """
    subsets = BENCHMARK_SPLITS.get(benchmark)
    if subsets is None:
        raise ValueError(f"unknown benchmark {benchmark!r}")
    if subset not in subsets or split not in subsets[subset]:
        raise ValueError(f"{benchmark} has no {subset!r}/{split!r}")
    rows = table.where((F.col("subset") == subset) & (F.col("split") == split))
    if subset == "auxiliary_train":
        rows = rows.select("subset", "split", "train.*")
    return rows
