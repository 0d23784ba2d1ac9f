"""Mixing sources to target weights by hash-random keys and prefix sums of word counts.

Every row gets a random key from a hash of its id and text. Keys are cut into
ranges of equal width; word counts are summed by (source, range), prefix sums
run over those totals, and only the range in which a source's budget ends is
sorted by key. A row is then taken or not by comparing its key with its range's
entry, so no text is shuffled and a source with a third of all rows is spread
over all ranges. A budget beyond the source's size repeats whole epochs first.

Null texts and texts without words have size 0 and take nothing. A null source
is a source of its own, the last in order. Rows equal in id and text have equal
keys: they share what the cut leaves them evenly (rounded down). An empty table
gives an empty result. The table of sources (one row each) is the only thing
sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import if_small
from shardloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Rows that a range of keys holds of the largest source, about.
RANGE_ROWS = 20_000
KEY_BITS = 60


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """60 random bits from the id and the text, the same on every run."""
    told = F.concat(
        F.lit(seed + "|"),
        F.coalesce(doc_id.cast("string"), F.lit("null")),
        F.lit("|"),
        F.md5(F.coalesce(text, F.lit("")).cast("binary")),
    )
    return F.conv(F.substring(F.md5(told.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def source_key(source: Column) -> Column:
    """A text that is never null: other for a null source than for any other."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT
) -> DataFrame:
    """``source, source_size`` -> the same with ``target``: shares of the total by weight.

    No target is above ``max_repeat`` times the source's size; what is over goes
    to the others by weight. Sources in order of size per weight: ``level`` is
    what a unit of weight gets if all before are at their limit, and the right
    level is the largest of them.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    nth = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), nth.cast("int")))
    weighed = weighed.withColumn("_cap", F.col("source_size") * F.lit(float(max_repeat)))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    levels = weighed.withColumn("_level", left / F.sum("_w").over(onward))
    level = F.max("_level").over(everything)
    return levels.select(
        "source", "source_size", F.least(F.col("_cap"), F.greatest(level, F.lit(0.0)) * F.col("_w")).alias("target")
    )


def _sized(docs: DataFrame, seed: str) -> DataFrame:
    return docs.select(
        "doc_id",
        "source",
        source_key(F.col("source")).alias("_source"),
        word_count(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), F.col("text"), seed).alias("_key"),
    )


def cut_table(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT
) -> tuple[DataFrame, int]:
    """One row per (source, key range): whole epochs, and where the last one is cut.

    ``sized`` (a written table) has ``source, _source, size, _key``. Returns the
    table and the number of ranges.
    """
    ranges = 1 << max(3, (sized.count() // RANGE_ROWS).bit_length())
    ranged = sized.withColumn("_range", range_of(F.col("_key"), ranges))
    totals = materialize(
        ranged.groupBy("_source", "_range").agg(F.first("source").alias("source"), F.sum("size").alias("_sum")), "ranges"
    )
    sizes = totals.groupBy("_source").agg(F.first("source").alias("source"), F.sum("_sum").alias("source_size"))
    targets = source_targets(sizes.select("source", "source_size"), weights, max_repeat)
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_repeat).cast("bigint")
    epochs = F.when(F.col("source_size") > 0, F.expr("_budget div source_size")).otherwise(F.lit(0))
    plan = targets.withColumn("_source", source_key(F.col("source"))).withColumn("_budget", budget)
    plan = plan.withColumn("_epochs", epochs.cast("bigint"))
    plan = plan.withColumn("_rest", F.col("_budget") - F.col("_epochs") * F.col("source_size")).drop("source", "_budget")
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("_rest") - F.coalesce(F.sum("_sum").over(before), F.lit(0))
    table = totals.join(plan, "_source").withColumn("_left", F.least(F.greatest(left, F.lit(0)), F.col("_sum")))
    table = table.drop("source")
    # The range in which the budget ends, one for each source at most: its keys in order.
    ends = table.where((F.col("_left") > 0) & (F.col("_left") < F.col("_sum")))
    in_order = Window.partitionBy("_source").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    keys = (
        ranged.join(if_small(materialize(ends.select("_source", "_range", "_left"), "ends")), ["_source", "_range"])
        .groupBy("_source", "_range", "_left", "_key")
        .agg(F.sum("size").alias("_size"), F.count("*").alias("_same"))
        .withColumn("_room", F.col("_left") - F.coalesce(F.sum("_size").over(in_order), F.lit(0)))
        .where((F.col("_room") >= 0) & (F.col("_room") < F.col("_size")))
        .select("_source", "_range", F.col("_key").alias("_cut"), F.expr("_room div _same").alias("_part"))
    )
    full = F.when(F.col("_left") == F.col("_sum"), F.lit(1 << KEY_BITS)).otherwise(F.lit(0))
    table = table.join(keys, ["_source", "_range"], "left").withColumn("_cut", F.coalesce("_cut", full.cast("bigint")))
    return materialize(table.select(
        "_source", "_range", "source_size", "target", "_epochs", "_cut", F.coalesce("_part", F.lit(0)).alias("_part")
    ), "cuts"), ranges


def range_of(key: Column, ranges: int) -> Column:
    return F.shiftright(key, KEY_BITS - (ranges.bit_length() - 1)).cast("int")


def _taken(size: Column) -> Column:
    last = F.when(F.col("_key") < F.col("_cut"), size).when(F.col("_key") == F.col("_cut"), F.col("_part")).otherwise(0)
    return (F.col("_epochs") * size + last).cast("bigint")


def mix_plan(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT, seed: str = "mix"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, taken``."""
    sized = materialize(_sized(docs, seed), "sized")
    cuts, ranges = cut_table(sized, weights, max_repeat)
    joined = sized.withColumn("_range", range_of(F.col("_key"), ranges)).join(if_small(cuts), ["_source", "_range"])
    return joined.select("doc_id", "source", "size", "source_size", "target", _taken(F.col("size")).alias("taken"))


def mix_documents(
    docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: float = MAX_REPEAT, seed: str = "mix"
) -> DataFrame:
    """The mixture itself: the columns of ``docs``, one row per document and epoch.

    Adds ``epoch`` (from 1), ``size``, ``source_size``, ``target`` and ``taken``
    (words of this row), in place of columns of the same names. The row at a
    source's cut holds its first ``taken`` words only, joined by spaces.
    """
    added = ("epoch", "size", "source_size", "target", "taken")
    docs = docs.drop(*added)
    cuts, ranges = cut_table(materialize(_sized(docs, seed), "sized"), weights, max_repeat)
    keyed = (
        docs.withColumn("_source", source_key(F.col("source")))
        .withColumn("_key", random_key(F.col("doc_id"), F.col("text"), seed))
        .withColumn("size", word_count(F.col("text")))
        .withColumn("_range", range_of(F.col("_key"), ranges))
        .join(if_small(cuts), ["_source", "_range"])
        .withColumn("_all", _taken(F.col("size")))
        .where(F.col("_all") > 0)
    )
    rows = keyed.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_all") / F.col("size")).cast("int"))))
    taken = F.least(F.col("size"), F.col("_all") - (F.col("epoch") - 1) * F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("taken").cast("int")), " ")
    rows = rows.withColumn("taken", taken.cast("bigint"))
    rows = rows.withColumn("text", F.when(F.col("taken") < F.col("size"), cut).otherwise(F.col("text")))
    return rows.select(*docs.columns, *added)
