"""Structured Streaming forms: shard stream, piece counts, packing, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.text import SPLIT_DIGITS_3, split_pieces
from shardloom.operators.pack import windows
from shardloom.operators.requests import validate_requests
from shardloom.session import scratch_path

_FIRST_KEY = -(2**62)  # order key of carried tokens: before every row


def shard_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    """New shard files as they appear; the checkpoint remembers those already read."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("pathGlobFilter", "*.parquet")
        .parquet(path)
    )


def stream_piece_counts(stream: DataFrame, text: str = "text", pattern: str = SPLIT_DIGITS_3) -> DataFrame:
    """Running counts of every piece, kept in the state store by hash of the piece."""
    return (
        stream.select(F.explode(split_pieces(F.col(text), pattern)).alias("piece"))
        .groupBy("piece")
        .agg(F.count("*").alias("cnt"))
    )


def stream_requests(stream: DataFrame, request: str = "request") -> DataFrame:
    return validate_requests(stream, request)


def pack_stream(
    encoded: DataFrame, rank: str, order: str, batch: int, length: int, out: str, progress: str, ids: str = "ids"
) -> DataFrame:
    """Windows per rank, the token remainder carried from trigger to trigger.

    A trigger packs its rows with the batch plan of ``windows``, so a rank with
    most of the rows is still spread over tasks. What is carried is a table with
    less than one window per rank and the next window number; it is written
    next to the windows under the trigger number, so a repeated trigger
    overwrites its own output and nothing is counted twice. Rows must arrive in
    ``order``, trigger by trigger: the last key of each rank is carried too, and a
    row that comes after a larger key of an earlier trigger fails the stream. Runs
    until everything available is packed.
    """
    spark = encoded.sparkSession
    width = batch * length + 1
    carried_schema = "rank int, next_window bigint, left array<int>, last_key bigint"

    def carried(trigger: int) -> DataFrame:
        if trigger == 0:
            return spark.createDataFrame([], carried_schema)
        return spark.read.schema(carried_schema).parquet(f"{out}/carried/trigger={trigger - 1}")

    def pack_trigger(df: DataFrame, trigger: int) -> None:
        before = carried(trigger)
        left = before.where(F.size("left") > 0).select(
            "rank", F.lit(_FIRST_KEY).cast("bigint").alias("key"), F.col("left").alias("ids")
        )
        rows = df.select(F.col(rank).cast("int").alias("rank"), F.col(order).cast("bigint").alias("key"), F.col(ids).alias("ids"))
        newest = rows.groupBy("rank").agg(F.max("key").alias("last_key"))
        seen = before.select("rank", F.col("last_key").alias("_seen"))
        late = F.concat(F.lit("out of order in rank "), F.col("rank").cast("string"), F.lit(": "), F.col("key").cast("string"))
        stop = F.when(F.col("key") <= F.col("_seen"), F.raise_error(late).cast("bigint")).otherwise(F.col("key"))
        rows = rows.join(F.broadcast(seen), "rank", "left").select("rank", stop.alias("key"), "ids")  # a row per rank
        # Cached, not written: a trigger must not leave tables behind.
        stream = left.unionByName(rows).persist()
        cut = windows(stream, "key", width, ["rank"], keep_rest=True)
        numbered = cut.join(before.select("rank", "next_window"), "rank", "left").withColumn(
            "window_id", F.col("window_id") + F.coalesce("next_window", F.lit(0))
        )
        cut = numbered.select("rank", "window_id", "tokens").persist()
        full = F.size("tokens") == width
        cut.where(full).write.mode("overwrite").parquet(f"{out}/windows/trigger={trigger}")
        ends = cut.groupBy("rank").agg(
            (F.max("window_id") + 1).alias("end"),
            F.max(F.when(~full, F.struct("window_id", "tokens"))).alias("rest"),
        )
        now = ends.select(
            "rank",
            F.coalesce(F.col("rest")["window_id"], F.col("end")).alias("next_window"),
            F.coalesce(F.col("rest")["tokens"], F.array().cast("array<int>")).alias("left"),
        )
        now = now.join(newest, "rank", "left").join(before.select("rank", F.col("last_key").alias("_seen")), "rank", "left")
        now = now.select("rank", "next_window", "left", F.coalesce("last_key", "_seen").alias("last_key"))
        idle = before.join(now.select("rank"), "rank", "left_anti")
        now.unionByName(idle).write.mode("overwrite").parquet(f"{out}/carried/trigger={trigger}")
        cut.unpersist()
        stream.unpersist()

    writer = encoded.writeStream.option("checkpointLocation", progress).trigger(availableNow=True)
    writer.foreachBatch(pack_trigger).start().awaitTermination()
    return spark.read.schema("rank int, window_id bigint, tokens array<int>").parquet(f"{out}/windows")


def run_to_table(
    stream: DataFrame, name: str, mode: str = "append", out: str | None = None, progress: str | None = None
) -> DataFrame:
    """Process everything available into parquet and read the result back.

    Append output goes through the file sink; a complete result is written per
    trigger, and the newest trigger's table in ``out`` is the answer, older ones
    are removed. Passing the same ``out`` and ``progress`` folders again continues
    where the last run ended; without new input the stored result comes back.
    """
    spark = stream.sparkSession
    out = out or scratch_path(spark, name)
    progress = progress or scratch_path(spark, f"{name}-progress")
    schema = stream.schema
    writer = stream.writeStream.option("checkpointLocation", progress).trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", out).outputMode("append").start().awaitTermination()
        return spark.read.schema(schema).parquet(out)

    def replace(df: DataFrame, trigger: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/{trigger}")
        # A repeated trigger may still need the one before it.
        for old in written_triggers(spark, out):
            if old < trigger - 1:
                remove_folder(spark, f"{out}/{old}")

    writer.outputMode(mode).foreachBatch(replace).start().awaitTermination()
    done = written_triggers(spark, out)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out}/{max(done)}")


def written_triggers(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the trigger folders in ``out`` that were written to the end."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(out)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/*/_SUCCESS")) or []
    return sorted(int(status.getPath().getParent().getName()) for status in found)


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
