"""Evaluation: few-shot prompts, answer spans, grading, accuracy, bits per byte.

Model outputs (losses, predictions, scores, completions) arrive as tables.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.text import draw, py_strip, seeded_hash
from shardloom.operators.ordered import shuffled_positions
from shardloom.session import materialize

# Fixed value: seed added to the item number when few-shot examples are drawn.
FEWSHOT_SEED = 1234


# --- few-shot examples and prompts -------------------------------------------


def fewshot_pairs(
    items: DataFrame, k: int, task: str = "task", idx: str = "idx", strict: bool = False
) -> DataFrame:
    """``k`` other items of the task for every item: ``(task, idx, shot, shot_idx)``.

    Items of a task have dense places in hash order. Every item draws k places of its own from the others, without
    putting back and in random order: the i-th draw is one of n - 1 - i numbers, raised by one for each
    smaller place drawn before, and places from its own on are raised by one too. So sets of different items overlap as by
    chance. Places become items by an equi-join: k rows per
    item, whatever the size of a task. Items of a task with fewer than k others
    take all of them (``short_tasks`` lists such tasks); ``strict`` fails instead.
    """
    digest = seeded_hash("ring", F.col(task), F.col(idx))
    places = materialize(shuffled_positions(items.select(task, idx), digest, "place", [task]), "places")
    seats = places.join(F.broadcast(places.groupBy(task).agg(F.count("*").alias("n"))), task)  # a row a task
    few = F.concat(F.lit("too few examples in task "), F.col(task).cast("string"))
    others = F.col("n") - 1
    fewer = F.raise_error(few).cast("int") if strict else others.cast("int")
    count = F.when(others >= k, F.lit(k)).otherwise(fewer)

    def next_place(drawn: Column, i: Column) -> Column:
        number = draw(seeded_hash(FEWSHOT_SEED, F.col(idx), i), others - i)
        free = F.aggregate(F.array_sort(drawn), number, lambda at, taken: at + (at >= taken).cast("bigint"))
        return F.concat(drawn, F.array(free))

    drawn = F.aggregate(F.sequence(F.lit(0), count - 1), F.array().cast("array<bigint>"), next_place)
    wanted = (
        seats.where((F.lit(strict) | (F.col("n") > 1)) & (F.lit(k) > 0))
        .select(task, idx, F.col("place").alias("own"), F.posexplode(drawn).alias("shot", "drawn"))
        .select(task, idx, F.col("shot").cast("int").alias("shot"), (F.col("drawn") + (F.col("drawn") >= F.col("own")).cast("bigint")).alias("place"))
    )
    found = places.select(task, F.col(idx).alias("shot_idx"), "place")
    return wanted.join(found, [task, "place"]).drop("place")


def short_tasks(items: DataFrame, k: int, task: str = "task") -> DataFrame:
    """Tasks whose items have fewer than ``k`` others: ``task, n, missing``."""
    sizes = items.groupBy(task).agg(F.count("*").alias("n"))
    return sizes.where(F.col("n") <= k).select(task, "n", (F.lit(k + 1) - F.col("n")).alias("missing"))


def fewshot_text(items: DataFrame, pairs: DataFrame, solved: Column, task: str = "task", idx: str = "idx") -> DataFrame:
    """The solved examples of every item as one text, each followed by a blank line.

    A prompt holds k examples by definition, so groups have k rows.
    """
    examples = items.select(task, F.col(idx).alias("shot_idx"), F.concat(solved, F.lit("\n\n")).alias("_example"))
    shots = pairs.join(examples, [task, "shot_idx"])
    ordered = F.array_sort(F.collect_list(F.struct("shot", "_example")))
    text = F.array_join(F.transform(ordered, lambda s: s["_example"]), "")
    return shots.groupBy(task, idx).agg(text.alias("_fewshot"))


def _with_fewshot(items: DataFrame, pairs: DataFrame | None, solved: Column, task: str, idx: str) -> DataFrame:
    if pairs is None:
        return items.withColumn("_fewshot", F.lit(""))
    text = fewshot_text(items, pairs, solved, task, idx)
    return items.join(text, [task, idx], "left").withColumn(
        "_fewshot", F.coalesce("_fewshot", F.lit(""))
    )


def prompts_mc(items: DataFrame, delimiter: Column, pairs: DataFrame | None = None, task: str = "task", idx: str = "idx") -> DataFrame:
    """One prompt per choice; rows ``query, choices, gold``."""
    solved = F.concat("query", delimiter, F.get("choices", F.col("gold")))
    return _with_fewshot(items, pairs, solved, task, idx).select(
        "*", F.posexplode("choices").alias("option", "_choice")
    ).withColumn("prompt", F.concat("_fewshot", "query", delimiter, "_choice")).drop("_fewshot", "_choice")


def prompts_schema(items: DataFrame, delimiter: Column, pairs: DataFrame | None = None, task: str = "task", idx: str = "idx") -> DataFrame:
    """One prompt per context; rows ``context_options, continuation, gold``."""
    solved = F.concat(F.get("context_options", F.col("gold")), delimiter, F.col("continuation"))
    return _with_fewshot(items, pairs, solved, task, idx).select(
        "*", F.posexplode("context_options").alias("option", "_context")
    ).withColumn("prompt", F.concat("_fewshot", "_context", delimiter, "continuation")).drop("_fewshot", "_context")


def prompts_lm(items: DataFrame, delimiter: Column, pairs: DataFrame | None = None, task: str = "task", idx: str = "idx") -> DataFrame:
    """Prompt without (stripped) and with the continuation; rows ``context, continuation``."""
    context = py_strip(F.col("context"))
    solved = F.concat(context, delimiter, F.col("continuation"))
    opened = F.concat("_fewshot", context, delimiter)
    return _with_fewshot(items, pairs, solved, task, idx).select(
        "*", py_strip(opened).alias("prompt_without"), F.concat(opened, F.col("continuation")).alias("prompt_with")
    ).drop("_fewshot")


# --- spans -------------------------------------------------------------------


def common_length(seqs: Column, direction: str = "left") -> Column:
    """Length of the common prefix (``left``) or suffix (``right``) of id arrays."""
    if direction not in ("left", "right"):
        raise ValueError("direction must be left|right")
    flip = F.reverse if direction == "right" else (lambda s: s)
    first = flip(seqs[0])

    def shared_with_first(seq: Column) -> Column:
        same = F.zip_with(first, flip(seq), lambda x, y: F.coalesce(x == y, F.lit(False)))
        first_difference = F.array_position(same, False)
        return F.coalesce(F.nullif(first_difference, F.lit(0)) - 1, F.size(seq)).cast("int")

    return F.array_min(F.transform(seqs, shared_with_first))


def answer_spans(encoded: DataFrame, kind: str, keys: Sequence[str], ids: str = "ids") -> DataFrame:
    """Start and end of the answer in every prompt (``option``, ids).

    A group holds the options of one item. ``multiple_choice``: after the common
    prefix; ``schema``: the common suffix; ``language_modeling``: option 0 is the
    prompt without, option 1 the one with the continuation, and the first must
    be a true prefix of the second (``valid`` tells).
    """
    keys = list(keys)
    options = F.array_sort(F.collect_list(F.struct("option", F.col(ids).alias("ids"))))
    grouped = encoded.groupBy(*keys).agg(options.alias("_o"))
    seqs = F.transform("_o", lambda o: o["ids"])
    if kind == "language_modeling":
        without, whole = F.col("_o")[0]["ids"], F.col("_o")[1]["ids"]
        start, end = F.size(without), F.size(whole)
        valid = (start < end) & (F.slice(whole, F.lit(1), start) == without)
        return grouped.select(
            *keys, F.col("_o")[1]["option"].alias("option"), whole.alias("ids"),
            start.alias("start"), end.alias("end"), valid.alias("valid"),
        )
    if kind not in ("multiple_choice", "schema"):
        raise ValueError(f"unsupported task type {kind!r}")
    direction = "left" if kind == "multiple_choice" else "right"
    flat = grouped.withColumn("_common", common_length(seqs, direction)).select(
        *keys, "_common", F.explode("_o").alias("o")
    )
    end = F.size(F.col("o")["ids"])
    start = F.col("_common") if kind == "multiple_choice" else end - F.col("_common")
    return flat.select(
        *keys, F.col("o")["option"].alias("option"), F.col("o")["ids"].alias("ids"),
        start.alias("start"), end.alias("end"), F.lit(True).alias("valid"),
    )


def left_truncate(spans: DataFrame, max_tokens: int) -> DataFrame:
    """Keep the last ``max_tokens`` ids and move the span; ``valid`` is false
    where the span would start before the sequence."""
    crop = F.greatest(F.size("ids") - max_tokens, F.lit(0))
    kept = F.when(F.size("ids") > max_tokens, F.slice("ids", -max_tokens, max_tokens)).otherwise(F.col("ids"))
    return (
        spans.withColumn("_crop", crop)
        .withColumn("ids", kept)
        .withColumn("start", F.col("start") - F.col("_crop"))
        .withColumn("end", F.col("end") - F.col("_crop"))
        .withColumn("valid", F.col("valid") & (F.col("start") >= 0) & (F.col("end") >= 0))
        .drop("_crop")
    )


def next_tokens(ids: Column) -> Column:
    """Target at every position: the following token, null at the end."""
    return F.concat(F.slice(ids, F.lit(2), F.greatest(F.size(ids) - 1, F.lit(0))), F.array(F.lit(None).cast("int")))


# --- grading -----------------------------------------------------------------


def grade_choice(losses: DataFrame, spans: DataFrame, gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest mean loss over the span wins, the first option on ties.

    ``losses``: keys, option, pos, loss; ``spans``: keys, option, start, end;
    ``gold``: keys, gold. The loss at ``pos`` is that of predicting ``pos + 1``.
    """
    keys = list(keys)
    inside = (F.col("pos") >= F.col("start") - 1) & (F.col("pos") < F.col("end") - 1)
    means = (
        losses.join(spans.select(*keys, "option", "start", "end"), [*keys, "option"])
        .where(inside)
        .groupBy(*keys, "option")
        .agg(F.avg("loss").alias("mean_loss"))
    )
    best = means.groupBy(*keys).agg(
        F.min(F.struct("mean_loss", "option")).alias("b")
    )
    return best.join(gold, keys).select(
        *keys, F.col("b")["option"].alias("predicted"), F.col("b")["mean_loss"].alias("mean_loss"),
        "gold", (F.col("b")["option"] == F.col("gold")).alias("correct"),
    )


def grade_lm(predictions: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Correct when all predicted ids inside the span equal the actual ones.

    ``predictions``: keys, pos, token_id, pred_id, where ``pred_id`` at ``pos``
    predicts the token at ``pos + 1``; the actual token comes with it as ``target_id``.
    Ids are compared where they are read: blocks of 64 positions go to the spans, with a
    bit for each that is equal, different or unknown (null), and are cut at the borders of the span by a mask.
    """
    keys = list(keys)
    whole = lambda c: F.col(c).cast("bigint")
    bit = F.expr("shiftleft(1L, cast(cast(pos as bigint) & 63 as int))")
    equal = F.col("pred_id") == F.col("target_id")
    marked = lambda which: F.coalesce(F.bit_or(F.when(which, bit)), F.lit(0).cast("bigint"))
    blocks = (
        predictions.where(F.col("pos").isNotNull())
        .groupBy(*keys, F.expr("shiftright(cast(pos as bigint), 6)").alias("_block"))
        .agg(marked(equal).alias("_equal"), marked(~equal).alias("_different"), marked(equal.isNull()).alias("_unknown"))
    )
    first = whole("start") - 1 - whole("_block") * 64
    end = whole("end") - 1 - whole("_block") * 64
    low, high = F.greatest(first, F.lit(0)), F.least(end, F.lit(64))
    inside = (
        blocks.join(spans.select(*keys, "start", "end"), keys)
        .where((first < 64) & (end > 0) & (first < end))
        .withColumns({"_low": low.cast("int"), "_n": (high - low).cast("int")})
        .withColumn("_mask", F.expr("shiftleft(shiftrightunsigned(-1L, 64 - _n), _low)"))
    )
    found = lambda c: F.col(c).bitwiseAND(F.col("_mask")) != 0
    return (
        inside.where(found("_equal") | found("_different") | found("_unknown"))
        .groupBy(*keys)
        .agg(F.bool_and(F.when(found("_different"), False).when(found("_equal"), True)).alias("correct"))
    )


def accuracy(graded: DataFrame, *group: str, correct: str = "correct") -> DataFrame:
    """Share of correct results per group level and overall (rollup)."""
    hit = F.col(correct).cast("int")
    return graded.rollup(*group).agg(
        F.count("*").alias("n"), F.sum(hit).alias("n_correct")
    ).withColumn("accuracy", F.col("n_correct") / F.col("n"))


def bits_per_byte(losses: DataFrame, lengths: DataFrame, *group: str) -> DataFrame:
    """Loss of counted tokens over ln 2 times their bytes; infinite without bytes.

    ``losses``: target_id, loss; ``lengths``: token_id, n_bytes (the vocabulary,
    small by construction). Negative targets and special tokens do not count.
    """
    counted = losses.where(F.col("target_id") >= 0).join(
        F.broadcast(lengths.select(F.col("token_id").alias("target_id"), "n_bytes")), "target_id"
    )
    nats = F.sum(F.when(F.col("n_bytes") > 0, F.col("loss")).otherwise(F.lit(0.0)))
    size = F.sum("n_bytes")
    per_byte = F.when(size > 0, nats / (F.lit(math.log(2)) * size)).otherwise(F.lit(float("inf")))
    return counted.groupBy(*group).agg(
        nats.alias("nats"), size.alias("n_bytes"), per_byte.alias("bpb")
    )


def single_token_letters(letters: DataFrame, ids: str = "ids") -> DataFrame:
    """Letters with their token id; fails when a letter is no single token."""
    single = F.when(F.size(ids) == 1, True).otherwise(
        F.raise_error(F.concat(F.lit("not a single token: "), "letter")).cast("boolean")
    )
    return letters.where(single).select("letter", F.col(ids)[0].alias("token_id"))


def letter_argmax(items: DataFrame, scores: DataFrame, letters: DataFrame, key: str = "problem_id") -> DataFrame:
    """Best-scored allowed letter at the answer position, the first on ties.

    ``items``: key, letters, answer_pos; ``scores``: key, pos, token_id, score;
    ``letters``: letter, token_id (a short table).
    """
    wanted = (
        items.select(key, "answer_pos", F.posexplode("letters").alias("place", "letter"))
        .join(letters, "letter")
        .withColumnRenamed("answer_pos", "pos")
    )
    found = wanted.join(scores, [key, "pos", "token_id"])
    best = found.groupBy(key).agg(F.min(F.struct((-F.col("score")).alias("s"), "place", "letter")).alias("b"))
    return best.select(key, F.col("b")["letter"].alias("predicted"), (-F.col("b")["s"]).alias("score"))


def extract_answer(text: Column) -> Column:
    """Number after ``#### ``, without commas; null when absent."""
    found = F.regexp_extract(text, r"#### (\-?[0-9\.\,]+)", 1)
    return F.replace(F.nullif(found, F.lit("")), F.lit(","), F.lit(""))


def grade_numeric(reference: Column, completion: Column) -> Column:
    """1 when both answers are the same text, also when both are missing."""
    return extract_answer(reference).eqNullSafe(extract_answer(completion)).cast("int")


def reward(graded: Column) -> Column:
    return graded.cast("double")


def grade_letter(predicted: Column, answer: Column, letters: Column) -> Column:
    """True or false for an allowed letter, null for any other."""
    return F.when(F.array_contains(letters, predicted), predicted == answer)


def leading_imports(prompt: Column) -> Column:
    """Import lines in front of the first line that is neither import, comment nor blank."""
    lines = F.transform(F.split(prompt, "\n", -1), py_strip)
    is_import = lambda l: l.startswith("import ") | l.startswith("from ")
    is_code = lambda l: ~is_import(l) & (l != "") & ~l.startswith("#")
    first_code = F.array_position(F.transform(lines, is_code), True)
    head = F.when(first_code > 0, F.slice(lines, F.lit(1), (first_code - 1).cast("int"))).otherwise(lines)
    return F.array_join(F.filter(head, is_import), "\n")


def program_of(completion: Column) -> Column:
    """First fenced code block, or the whole completion, stripped."""
    fence = r"(?s)```(?:python)?\s*\n(.*?)\n```"
    return py_strip(
        F.when(completion.rlike(fence), F.regexp_extract(completion, fence, 1)).otherwise(completion)
    )


def assemble_program(prompt: Column, completion: Column, test: Column, entry_point: Column) -> Column:
    """Program text ready to be run elsewhere against its tests."""
    return F.concat(
        leading_imports(prompt), F.lit("\n\n"), program_of(completion), F.lit("\n\n"), test,
        F.lit("\ncheck("), entry_point, F.lit(")"),
    )


def pass_any(graded: DataFrame, *keys: str, correct: str = "correct") -> DataFrame:
    """A problem passes when one of its samples does."""
    return graded.groupBy(*keys).agg(
        F.bool_or(F.col(correct)).alias("passed"), F.count("*").alias("n_samples")
    )


def cut_completions(generated: DataFrame, terminals: Sequence[int], by: str = "row_id") -> DataFrame:
    """Tokens before the first terminal of each row.

    The first terminal is a minimum per row joined back: no sort of the tokens.
    """
    ends = generated.where(F.col("token_id").isin(*terminals)).groupBy(by).agg(F.min("step").alias("_end"))
    return generated.join(ends, by, "left").where(
        F.col("_end").isNull() | (F.col("step") < F.col("_end"))
    ).drop("_end")


def shape_response(text: Column) -> Column:
    """Response text without assistant markers and outer white space."""
    for marker in ("<|assistant_end|>", "<|assistant_start|>"):
        text = F.replace(text, F.lit(marker), F.lit(""))
    return py_strip(text)


def finish_reason(n_tokens: Column, max_tokens: Column, last_raw: Column, assistant_end: int) -> Column:
    """``max_tokens``, else ``eos`` after an assistant end, else ``stop``."""
    return (
        F.when(n_tokens >= max_tokens, "max_tokens")
        .when(last_raw == assistant_end, "eos")
        .otherwise("stop")
    )
