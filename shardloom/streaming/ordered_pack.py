"""Packing of rows that come in any order: they wait in written tables until the watermark has passed their place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators.pack import windows
from shardloom.streaming.streams import remove_folder

WINDOWS = "rank int, window_id bigint, tokens array<int>"
_WAITING = "rank int, key bigint, n int, ids array<int>"
#: What a trigger hands on: the mark, the tables that wait (id: trigger, number: newest key) or are done with, the
#: ranks (number: next window) with less than one window of tokens.
_STATE = "kind string, id bigint, number bigint, left array<int>"
_FIRST_KEY = -(2**62)  # order key of carried tokens: before every row


def end_mark(spark: SparkSession, order: int, delay: int) -> DataFrame:
    """A row without tokens whose order key lets the watermark pass all keys up to ``order``."""
    return spark.createDataFrame([(None, order + delay + 1, [])], "rank int, order bigint, ids array<int>")


def _release(waiting: DataFrame, ranks: DataFrame, width: int, path: str) -> DataFrame:
    """Packs rows after what their ranks carry, writes the windows, and gives the state of the ranks."""
    again = waiting.groupBy("rank", "key").agg(F.count("*").alias("n")).where("n > 1").first()
    if again is not None:
        raise ValueError(f"order key {again['key']} comes twice in rank {again['rank']}")
    carried = ranks.select(F.col("id").cast("int").alias("rank"), F.col("number").alias("_next"), "left")
    left = carried.where(F.size("left") > 0).select("rank", F.lit(_FIRST_KEY).cast("bigint").alias("key"), F.size("left").alias("n"), F.col("left").alias("ids"))
    cut = windows(left.unionByName(waiting), "key", width, ["rank"], keep_rest=True, sizes="n")
    number = F.col("window_id") + F.coalesce("_next", F.lit(0))
    numbered = cut.select("rank", "window_id", "tokens").join(F.broadcast(carried.select("rank", "_next")), "rank", "left")  # a row per rank
    numbered.select("rank", number.alias("window_id"), "tokens").write.mode("overwrite").parquet(path)
    written = waiting.sparkSession.read.schema(WINDOWS).parquet(path)
    short = F.size("tokens") < width
    ends = written.groupBy("rank").agg((F.max("window_id") + 1).alias("end"), F.max(F.when(short, F.struct("window_id", "tokens"))).alias("rest"))
    now = ends.select(
        F.lit("rank").alias("kind"), F.col("rank").cast("bigint").alias("id"), F.coalesce(F.col("rest")["window_id"], "end").alias("number"),
        F.coalesce(F.col("rest")["tokens"], F.array().cast("array<int>")).alias("left"),
    )
    return now.unionByName(ranks.join(now.select("id"), "id", "left_anti").select("kind", "id", "number", "left"))


def pack_in_order(
    encoded: DataFrame, rank: str, order: str, width: int, delay: int, out: str, progress: str, ids: str = "ids"
) -> DataFrame:
    """Windows per rank of a stream whose rows come out of order by at most ``delay`` in their order key.

    The order key is not negative and distinct in a rank. Rows wait until a key larger by
    ``delay`` has been seen, so the last ones come out with later runs or an ``end_mark``. A row
    later than that cannot be packed any more: it is left out, and the run fails. Rows without
    a rank only move the watermark.

    A trigger writes its rows to a table that waits; those that the watermark has now passed are packed by the batch plan of
    ``windows``, so a rank is spread over tasks. Tables are named by trigger: a repeated trigger overwrites its own, and a run
    that ended anywhere goes on with the same ``out`` and ``progress``.
    """
    spark = encoded.sparkSession
    late_rows: list[int] = []

    def pack_trigger(df: DataFrame, trigger: int) -> None:
        key = F.col(order).cast("bigint")
        rows = df.select(F.col(rank).cast("int").alias("rank"), key.alias("key"), F.size(ids).alias("n"), F.col(ids).alias("ids"))
        rows.write.mode("overwrite").parquet(f"{out}/waiting/{trigger}")
        state = spark.read.schema(_STATE).parquet(f"{out}/state/{trigger - 1}") if trigger else spark.createDataFrame([], _STATE)
        held = state.where("kind <> 'rank'").collect()  # a row for each table that waits
        mark = max((r.number for r in held if r.kind == "mark"), default=0)
        tables = {r.id: r.number for r in held if r.kind == "waiting"}
        for r in held:  # the trigger that was done with them is itself over
            if r.kind == "done":
                remove_folder(spark, f"{out}/waiting/{r.id}")
        new = spark.read.schema(_WAITING).parquet(f"{out}/waiting/{trigger}")
        late = F.count(F.when((F.col("key") < mark) & F.col("rank").isNotNull(), 1))
        newest, n_late = new.agg(F.max("key"), late).first()
        late_rows.append(n_late)
        if newest is not None:
            tables[trigger] = newest
        passed = max(mark, max(tables.values(), default=0) + 1 - delay)
        ranks = state.where("kind = 'rank'")
        if passed > mark:
            waiting = spark.read.schema(_WAITING).parquet(*[f"{out}/waiting/{t}" for t in sorted(tables)])
            waiting = waiting.where(F.col("rank").isNotNull() & (F.col("key") >= mark) & (F.col("key") < passed))
            ranks = _release(waiting, ranks, width, f"{out}/windows/{trigger}")
        told = [("mark", 0, passed, None)] + [("waiting" if last >= passed else "done", t, last, None) for t, last in tables.items()]
        spark.createDataFrame(told, _STATE).unionByName(ranks).write.mode("overwrite").parquet(f"{out}/state/{trigger}")

    writer = encoded.writeStream.option("checkpointLocation", progress).trigger(availableNow=True)
    writer.foreachBatch(pack_trigger).start().awaitTermination()
    if sum(late_rows):
        raise RuntimeError(f"{sum(late_rows)} rows came later than the delay of {delay} allows")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/windows")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], WINDOWS)
    every = spark.read.schema(WINDOWS).option("recursiveFileLookup", "true").parquet(f"{out}/windows")
    return every.where(F.size("tokens") == width)
