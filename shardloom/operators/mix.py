"""Dataset mixtures: shuffles, oversampling, sequences, stage presets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.functions.text import seeded_hash
from shardloom.operators.ordered import shuffled_positions
from shardloom.session import materialize

# Fixed value: the shuffle seed of every mixture and benchmark.
SEED = 42


@dataclass(frozen=True)
class Placed:
    """A table whose rows have not been moved yet: ``places`` maps ``key`` to the dense ``idx`` of each row."""

    rows: DataFrame
    key: str
    places: DataFrame

    def table(self) -> DataFrame:
        """The rows with their ``idx`` instead of the key."""
        return self.rows.join(self.places, self.key).drop(self.key)


def shuffled(rows: DataFrame, key: str, seed: int = SEED) -> Placed:
    """A reproducible random order of ``rows``; only the key column is read for it. ``places`` is a written table."""
    return Placed(rows, key, materialize(shuffled_positions(rows.select(key), seeded_hash(seed, F.col(key)), "idx"), "places"))


def _is_wide(df: DataFrame, *keys: str) -> bool:
    """Whether rows hold more than numbers besides their keys and names of tasks."""
    plain = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)
    return any(not isinstance(f.dataType, plain) for f in df.schema if f.name not in (*keys, "task"))


def seeded_shuffle(df: DataFrame, key: str, seed: int = SEED, out: str = "idx") -> DataFrame:
    """Dense index in a reproducible random order. Keys are unique; only keys are ordered, rows are joined to their place."""
    digest = seeded_hash(seed, F.col(key))
    if not _is_wide(df, key):
        return shuffled_positions(df, digest, out)
    return df.join(shuffled_positions(df.select(key), digest, out), key)


def _members(tasks: list[DataFrame]) -> DataFrame:
    """All members under each other; ``member`` is the place in the list."""
    numbered = [df.withColumn("member", F.lit(i)) for i, df in enumerate(tasks)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def mixture(tasks: list[DataFrame | Placed], seed: int = SEED, stops: Sequence[int | None] = ()) -> DataFrame:
    """Members mixed by a reproducible shuffle, with dense ``pos``.

    A member listed twice counts twice. Members have a unique ``idx`` each; of a member with a stop only rows with a smaller
    ``idx`` take part.

    Late materialisation: positions are found on (member, key, idx) alone, then
    each table is read once and joined to its places, however often it is listed. Rows
    that are no wider than their places are ordered as they are.
    """
    stops = [*stops, *[None] * (len(tasks) - len(stops))]
    within = lambda df, stop: df if stop is None else df.where(F.col("idx") < stop)
    digest = seeded_hash(seed, F.col("member"), F.col("idx"))
    if not any(isinstance(t, Placed) or _is_wide(t, "idx") for t in tasks):
        return shuffled_positions(_members([within(t, stop) for t, stop in zip(tasks, stops)]), digest)
    placed = [t if isinstance(t, Placed) else Placed(t, "idx", t.select("idx")) for t in tasks]
    slim = [within(t.places, stop).select(F.col(t.key).cast("string").alias("_key"), "idx") for t, stop in zip(placed, stops)]
    places = materialize(shuffled_positions(_members(slim), digest), "mixed")
    sources: dict[int, list[int]] = {}
    for i, t in enumerate(placed):
        sources.setdefault(id(t.rows), []).append(i)
    parts = []
    for members in sources.values():
        t = placed[members[0]]
        own = places.where(F.col("member").isin(members)).withColumnRenamed("idx", "_idx")
        joined = t.rows.join(own, t.rows[t.key].cast("string") == own["_key"]).drop("_key", t.key)
        parts.append(joined.withColumnRenamed("_idx", "idx"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def oversample(df: DataFrame, times: int) -> DataFrame:
    """Every row ``times`` times, told apart by ``copy``."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))


def sequence(tasks: list[DataFrame]) -> DataFrame:
    """Members one after another; ``idx`` must be dense within each.

    Only member sizes (one row per list entry) are added up, the rows are not sorted.
    """
    union = _members(tasks)
    sizes = union.groupBy("member").agg(F.count("*").alias("size"))
    before = Window.partitionBy().orderBy("member").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("member", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    return (
        union.join(F.broadcast(starts), "member")
        .withColumn("pos", F.col("start") + F.col("idx"))
        .drop("start")
    )


@dataclass(frozen=True)
class Member:
    """One entry of a preset: which task and split, how many rows at most."""

    task: str
    split: str
    stop: int | None = None


# Members of the stage presets (small tier, full tier).
PRESETS: dict[tuple[str, str, str], tuple[Member, ...]] = {
    ("mid", "small", "train"): (
        Member("SmolTalk", "train", 1000),
        Member("MMLU", "auxiliary_train", 500),
    ),
    ("mid", "small", "val"): (Member("SmolTalk", "test", 100), Member("MMLU", "test", 100)),
    ("mid", "full", "train"): (
        Member("SmolTalk", "train"),
        Member("MMLU", "auxiliary_train"),
        Member("GSM8K", "train"),
        Member("SimpleSpelling", "train", 200_000),
        Member("SpellingBee", "train", 80_000),
    ),
    ("mid", "full", "val"): (
        Member("SmolTalk", "test"),
        Member("MMLU", "test", 5200),
        Member("GSM8K", "test", 420),
    ),
    ("sft", "small", "train"): (
        Member("ARC-Easy", "train", 50),
        Member("ARC-Challenge", "train", 30),
        Member("GSM8K", "train", 100),
        Member("SmolTalk", "train", 200),
        Member("CustomJSON", "train"),
        Member("SimpleSpelling", "train", 20),
        Member("SpellingBee", "train", 20),
    ),
    ("sft", "small", "val"): (Member("SmolTalk", "test", 100),),
    ("sft", "full", "train"): (
        Member("ARC-Easy", "train"),
        Member("ARC-Challenge", "train"),
        Member("GSM8K", "train"),
        Member("SmolTalk", "train", 10_000),
        Member("CustomJSON", "train"),
        Member("SimpleSpelling", "train", 300),
        Member("SpellingBee", "train", 300),
    ),
    ("sft", "full", "val"): (Member("SmolTalk", "test", 1000),),
}


def preset_mixture(
    tables: dict[tuple[str, str], DataFrame | Placed], stage: str, tier: str, split: str, seed: int = SEED
) -> DataFrame:
    """Mixture of a preset; ``tables`` maps (task, split) to conversation rows, or to rows and their places.

    A row limit is a filter on the dense ``idx``, applied before any conversation is moved.
    """
    members = PRESETS[(stage, tier, split)]
    return mixture([tables[(m.task, m.split)] for m in members], seed, [m.stop for m in members])


def dataset_info(df: DataFrame, split: str = "split", task: str = "task") -> DataFrame:
    """Size, number and names of the member datasets of every split.

    Sizes are summed per task first; names are as few as the tasks.
    """
    per_task = df.groupBy(split, task).agg(F.count("*").alias("n"))
    return per_task.groupBy(split).agg(
        F.sum("n").alias("size"),
        F.count("*").alias("n_datasets"),
        F.array_sort(F.collect_set(task)).alias("datasets"),
    )
