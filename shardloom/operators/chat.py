"""Conversations: assembly, validation, system merge, rendering to ids and mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.functions.text import split_pieces
from shardloom.operators.ordered import running
from shardloom.operators.tokens import piece_encoder
from shardloom.operators.vocabulary import Tokenizer
from shardloom.session import materialize
from shardloom.sources.conversations import plain_message

# Longest rendered conversation; known part types.
MAX_TOKENS = 2048
_NO_TURN = -(1 << 62)  # order key of a turn without number: before all others
PART_TYPES = ("text", "python", "python_output")


def assemble(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation with its messages in turn order.

    A conversation is a single value of the data model, so its turns meet in
    one row; counts and checks that need no such row work on the turns.
    """
    message = plain_message(F.col("role"), F.col("text"))
    ordered = F.array_sort(F.collect_list(F.struct("turn", message.alias("message"))))
    return turns.groupBy(conv).agg(F.transform(ordered, lambda t: t["message"]).alias("messages"))


def positions(turns: DataFrame, conv: str = "conv_id", out: str = "position") -> DataFrame:
    """Place of every turn in its conversation, counted from 0 in order of turn, role and text.

    Turn numbers may start anywhere, repeat and have gaps. Only counts by turn number are summed in
    order (``ordered.running``, by key ranges), and rows of one turn number are numbered
    among themselves, so a conversation of any size is spread over tasks and its
    texts are shuffled once, by conversation and turn.
    """
    return _placed(turns, _turn_starts(turns, conv), conv, out)


def _turn_starts(turns: DataFrame, conv: str) -> DataFrame:
    """``conv, turn, _rows, _before``: rows of each turn number and of all smaller ones. A written table."""
    counts = turns.groupBy(conv, "turn").agg(F.count("*").alias("_rows"))
    return materialize(running(materialize(counts, "turns"), "turn", F.col("_rows"), "_before", by=[conv]), "starts")


def _placed(turns: DataFrame, starts: DataFrame, conv: str, out: str) -> DataFrame:
    same = Window.partitionBy(conv, "turn").orderBy("role", "text")
    numbered = turns.join(starts, [conv, "turn"]).withColumn(out, F.col("_before") + F.row_number().over(same) - 1)
    return numbered.withColumn(out, F.col(out).cast("bigint")).drop("_rows", "_before")


def first_turns(turns: DataFrame, max_tokens: int = MAX_TOKENS, conv: str = "conv_id", longest: int | None = None) -> DataFrame:
    """Turns that can reach the rendered result.

    Every turn renders to two tokens at least, and a system turn joins the next
    one, so turns after that many lie past ``max_tokens`` for certain. Turns are
    counted in order, whatever their numbers; the literal limit on the counter makes every
    task drop later turns before the shuffle. With ``longest``, the bytes of the longest token, the
    texts so far bound the tokens from below too. The session's threshold for limits of this kind is raised to the limit.
    """
    limit = max_tokens // 2 + 2
    conf, threshold = turns.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(conf.get(threshold)) < limit:
        conf.set(threshold, str(limit))
    order = Window.partitionBy(conv).orderBy("turn", "role", "text")
    first = turns.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= limit)
    if longest is not None:
        least = 2 + F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / longest)
        # The first turn may be a system text, which has no tokens of its own around it.
        before = F.sum(least).over(order.rowsBetween(Window.unboundedPreceding, -1))
        first = first.withColumn("_least", F.coalesce(before, F.lit(0))).where(F.col("_least") <= max_tokens + 2).drop("_least")
    return first.drop("_place")


def validate_turns(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Validity and reasons per conversation, from plain sums over its turns.

    The expected role follows from the parity of the turn's place in the
    conversation, counted with and without a leading system turn. Where turn numbers are
    distinct and without gaps, the place is the number less the smallest one, so sums by parity of the number do, and no row
    is ordered. Only turns of other conversations are numbered, on rows without texts.
    """
    slim = turns.select(conv, "turn", "role", F.col("text").isNull().alias("no_text"))
    by_turn = slim.groupBy(conv, "turn").agg(F.count("*").alias("c"))
    shape = by_turn.groupBy(conv).agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.sum("c").alias("n"), F.max("c").alias("most"), F.count("turn").alias("known"))
    dense = (F.col("most") == 1) & (F.col("known") == F.col("n")) & (F.col("high") - F.col("low") + 1 == F.col("n"))
    gapped = materialize(shape.where(~F.coalesce(dense, F.lit(False))).select(conv), "gapped")
    rows = slim.withColumn("place", F.col("turn"))
    if not gapped.isEmpty():
        some = materialize(slim.join(gapped, conv, "left_semi").withColumn("text", F.lit(None).cast("string")), "gapped-turns")
        known = some.withColumn("turn", F.coalesce("turn", F.lit(_NO_TURN)))
        placed = positions(known, conv, "place").select(conv, "turn", "role", "no_text", "place")
        rows = rows.join(gapped, conv, "left_anti").unionByName(placed)
    odd = lambda parity, role: F.sum(((F.pmod("place", F.lit(2)) == parity) & ~F.col("role").eqNullSafe(role)).cast("int"))
    first = F.min(F.struct("place", F.col("role").isNull().alias("none"), "role"))
    sums = rows.groupBy(conv).agg(
        F.count("*").alias("n"), first.alias("first"),
        odd(0, "user").alias("u0"), odd(1, "user").alias("u1"), odd(0, "assistant").alias("a0"), odd(1, "assistant").alias("a1"),
        F.sum(F.col("role").isNull().cast("int")).alias("no_role"),
        F.sum(F.col("no_text").cast("int")).alias("no_content"),
    )
    even = F.pmod("first.place", F.lit(2)) == 0
    opening = F.col("first.role")
    # With a system turn the user speaks at odd places and the first turn is not counted.
    plain = F.when(even, F.col("u0") + F.col("a1")).otherwise(F.col("u1") + F.col("a0"))
    after_system = F.when(even, F.col("u1") + F.col("a0")).otherwise(F.col("u0") + F.col("a1")) - 1
    sums = sums.withColumn("has_system", opening.eqNullSafe("system")).withColumn("bad_plain", plain).withColumn("bad_system", after_system)
    rest = F.col("n") - F.col("has_system").cast("int")
    bad = F.when(F.col("has_system"), F.col("bad_system")).otherwise(F.col("bad_plain"))
    reasons = F.array_compact(
        F.array(
            F.when(rest < 2, "too_few_messages"),
            F.when(bad > 0, "role_order"),
            F.when(F.col("no_role") > 0, "missing_role"),
            F.when(F.col("no_content") > 0, "missing_content"),
        )
    )
    return sums.select(
        conv, F.col("n").alias("n_messages"), (F.size(reasons) == 0).alias("valid"), reasons.alias("reasons")
    )


def message_reasons(messages: Column) -> Column:
    """The same rules on a message array, plus those on parts."""
    has_system = F.coalesce(messages[0]["role"] == "system", F.lit(False)).cast("int")
    rest = F.slice(messages, has_system + 1, F.greatest(F.size(messages) - has_system, F.lit(0)))

    def out_of_order(m: Column, i: Column) -> Column:
        expected = F.when(F.pmod(i, F.lit(2)) == 0, "user").otherwise("assistant")
        return F.when(~m["role"].eqNullSafe(expected), 1).otherwise(0)

    total = lambda flags: F.aggregate(flags, F.lit(0), lambda a, b: a + b)
    part_known = lambda p: F.coalesce(p["type"].isin(*PART_TYPES) & p["text"].isNotNull(), F.lit(False))
    return F.when(messages.isNull(), F.array(F.lit("not_a_conversation"))).otherwise(
        F.array_compact(
            F.array(
                F.when(F.size(rest) < 2, "too_few_messages"),
                F.when(total(F.transform(rest, out_of_order)) > 0, "role_order"),
                F.when(F.exists(messages, lambda m: m["role"].isNull()), "missing_role"),
                F.when(
                    F.exists(messages, lambda m: m["parts"].isNull() | (m["is_plain"] & m["parts"][0]["text"].isNull())),
                    "missing_content",
                ),
                F.when(
                    F.exists(messages, lambda m: (m["role"] != "assistant") & ~m["is_plain"]),
                    "content_not_plain",
                ),
                F.when(
                    F.exists(messages, lambda m: F.exists(m["parts"], lambda p: ~part_known(p))),
                    "unknown_part",
                ),
            )
        )
    )


def split_valid(df: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good conversations and quarantined ones with reasons.

    ``strict`` fails the job at the first bad conversation instead.
    """
    checked = df.withColumn("reasons", message_reasons(F.col("messages")))
    bad = F.size("reasons") > 0
    if strict:
        stop = F.raise_error(F.concat(F.lit("bad conversation: "), F.array_join("reasons", ",")))
        return checked.where(F.when(bad, stop.cast("boolean")).otherwise(True)).drop("reasons"), checked.limit(0)
    return checked.where(~bad).drop("reasons"), checked.where(bad)


def merge_system(messages: Column) -> Column:
    """A leading system text goes in front of the first user text."""
    first, second = messages[0], messages[1]
    joined = plain_message(
        second["role"],
        F.concat(first["parts"][0]["text"], F.lit("\n\n"), second["parts"][0]["text"]),
    )
    rest = F.slice(messages, F.lit(3), F.greatest(F.size(messages) - 2, F.lit(0)))
    return F.when(
        (first["role"] == "system") & (F.size(messages) > 1), F.concat(F.array(joined), rest)
    ).otherwise(messages)


def merge_system_turns(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """System merge on turn rows: only the first two turns of a conversation meet.

    Turns are counted in order; the result numbers them from 0. The system text is the least row of a
    conversation, by a partial aggregate, and travels with the start of the second turn's number, so
    all turns are shuffled once, by conversation and turn.
    """
    head = turns.groupBy(conv).agg(F.min(F.struct("turn", "role", "text")).alias("head"))
    # The text follows only where there is one; without it nothing is merged.
    system = head.where("head.role = 'system' AND head.text IS NOT NULL").select(conv, F.col("head.text").alias("_system"))
    starts = _turn_starts(turns, conv).join(system, conv, "left").withColumn("_merged", F.col("_system").isNotNull())
    holds_second = (F.col("_before") <= 1) & (F.col("_before") + F.col("_rows") > 1)
    starts = starts.withColumn("_system", F.when(holds_second, F.col("_system")))
    placed = _placed(turns, starts, conv, "_position")
    text = F.when(F.col("_merged") & (F.col("_position") == 1), F.concat("_system", F.lit("\n\n"), "text")).otherwise(F.col("text"))
    rows = placed.where(~((F.col("_position") == 0) & F.coalesce(F.col("role") == "system", F.lit(False))))
    return rows.select(conv, (F.col("_position") - F.col("_merged").cast("int")).alias("turn"), "role", text.alias("text"))


# --- rendering ---------------------------------------------------------------


def segments(messages: Column, tok: Tokenizer) -> Column:
    """Messages as a flat list of texts and special tokens, each with its mask bit."""
    def special(name: str, mask: int) -> Column:
        return F.struct(
            F.lit(None).cast("string").alias("text"),
            F.lit(tok.special_id(f"<|{name}|>")).alias("special"),
            F.lit(mask).alias("mask"),
        )

    def content(part: Column, mask: int) -> Column:
        return F.struct(
            part["text"].alias("text"), F.lit(None).cast("int").alias("special"), F.lit(mask).alias("mask")
        )

    def part_segments(part: Column) -> Column:
        return (
            F.when(
                part["type"] == "python",
                F.array(special("python_start", 1), content(part, 1), special("python_end", 1)),
            )
            .when(
                part["type"] == "python_output",
                F.array(special("output_start", 0), content(part, 0), special("output_end", 0)),
            )
            .otherwise(F.array(content(part, 1)))
        )

    def message_segments(message: Column) -> Column:
        user = F.array(
            special("user_start", 0), content(message["parts"][0], 0), special("user_end", 0)
        )
        assistant = F.concat(
            F.array(special("assistant_start", 0)),
            F.flatten(F.transform(message["parts"], part_segments)),
            F.array(special("assistant_end", 1)),
        )
        return F.when(message["role"] == "user", user).otherwise(assistant)

    body = F.flatten(F.transform(merge_system(messages), message_segments))
    return F.concat(F.array(special("bos", 0)), body)


def render(df: DataFrame, tok: Tokenizer, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Add ``ids`` and ``mask`` of equal length, cut to ``max_tokens``."""
    pieces = F.transform(
        "_segments", lambda s: F.coalesce(split_pieces(s["text"], tok.pattern), F.array().cast("array<string>"))
    )
    encode = piece_encoder(df.sparkSession, tok, nested=True)
    return (
        df.withColumn("_segments", segments(F.col("messages"), tok))
        .withColumn("_encoded", encode(pieces))
        .withColumn(
            "_tokens",
            F.zip_with(
                "_segments", "_encoded",
                lambda s, e: F.struct(
                    F.when(s["special"].isNotNull(), F.array(s["special"])).otherwise(e).alias("ids"),
                    s["mask"].alias("mask"),
                ),
            ),
        )
        .withColumn("ids", F.slice(F.flatten(F.transform("_tokens", lambda t: t["ids"])), 1, max_tokens))
        .withColumn(
            "mask",
            F.slice(
                F.flatten(F.transform("_tokens", lambda t: F.array_repeat(t["mask"], F.size(t["ids"])))),
                1, max_tokens,
            ),
        )
        .drop("_segments", "_encoded", "_tokens")
    )


def completion_prompts(df: DataFrame, tok: Tokenizer, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Prompts without the final assistant message, ending in assistant-start.

    Conversations that do not end with the assistant have no such prompt and are
    left out; ``open_conversations`` lists them.
    """
    n = F.size("messages")
    closed = df.where(F.element_at("messages", -1)["role"] == "assistant")
    prompts = render(closed.withColumn("messages", F.slice("messages", F.lit(1), n - 1)), tok, max_tokens)
    start = F.array(F.lit(tok.special_id("<|assistant_start|>")))
    return prompts.withColumn("ids", F.concat("ids", start)).drop("mask", "messages")


def completion_prompts_of_turns(
    turns: DataFrame, tok: Tokenizer, conv: str = "conv_id", max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """The same prompts from turn rows.

    The last turn is found by a partial aggregate and only turns that can reach
    the prompt are gathered, however long a conversation is.
    """
    closing = turns.groupBy(conv).agg(
        F.max("turn").alias("_last"), F.max_by("role", "turn").alias("_last_role")
    )
    kept = (
        first_turns(turns, max_tokens, conv, max(map(len, tok.token_bytes())))
        .join(closing.where(F.col("_last_role") == "assistant"), conv)
        .where(F.col("turn") < F.col("_last"))
    )
    start = F.array(F.lit(tok.special_id("<|assistant_start|>")))
    prompts = render(assemble(kept, conv), tok, max_tokens)
    return prompts.withColumn("ids", F.concat("ids", start)).drop("mask", "messages")


def open_conversations(df: DataFrame) -> DataFrame:
    return df.where(F.element_at("messages", -1)["role"] != "assistant")
