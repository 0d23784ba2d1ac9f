"""Fixed-size training sequences: packing token streams, collating conversations."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.operators.ordered import RANGE, range_count, running, with_ranges
from shardloom.session import materialize


def token_offsets(
    encoded: DataFrame, key: str, by: Sequence[str] = (), ids: str = "ids", sizes: str | None = None
) -> DataFrame:
    """Offset of every document in the concatenated token stream.

    With a stored token count in column ``sizes`` the totals are taken without
    reading the ids.
    """
    size = F.size(ids) if sizes is None else F.col(sizes)
    return running(encoded, key, size.cast("bigint"), "offset", by)


class _Run:
    """Tokens of one key range that no window border has closed yet, for every epoch."""

    def __init__(self, name: int, starts: list[int]) -> None:
        self.name, self.starts = name, starts
        self.held = [np.empty(0, np.int32) for _ in starts]
        self.tail: tuple = ()  # group columns and key of the last document

    def add(self, epoch: int, tokens: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Adds tokens; gives the starts of the pieces that now end at a border, their ends, and their tokens."""
        start = self.starts[epoch]
        every = np.concatenate((self.held[epoch], tokens))
        end = start + len(every)
        borders = np.arange((start // width + 1) * width, end + 1, width)
        done = int(borders[-1]) if len(borders) else start
        self.starts[epoch], self.held[epoch] = done, every[done - start :].copy()
        return np.concatenate(([start], borders))[:-1], borders, every[: done - start]


def _cut(width: int, by: list[str], epochs: int, size: int):
    """Cuts rows that come in stream order (``_run``, ``_at``, ``_all``, ``_key``, ``_ids``, group columns) at window borders.

    ``_at`` is the offset at which the row's run of rows begins, ``_all`` the length of the whole stream. A
    piece that begins or ends inside a window is where a run begins or ends.
    """

    def batch(groups: list, keys: pa.Array, starts: np.ndarray, limits: np.ndarray, tokens: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(tokens))
        return pa.RecordBatch.from_arrays(
            [*groups, pa.array(starts // width), pa.array(starts), keys, lists], names=[*by, "window_id", "_start", "last_key", "tokens"]
        )

    def rest(run: _Run) -> Iterator[pa.RecordBatch]:
        for epoch, held in enumerate(run.held):
            if len(held):
                *groups, key = run.tail
                starts, limits = np.array([run.starts[epoch]]), np.array([0, len(held)])
                yield batch(groups, _later(key, epoch * size), starts, limits, held)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: _Run | None = None
        for rows in batches:
            if not rows.num_rows:
                continue
            names = rows.column("_run").to_numpy()
            edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), rows.num_rows]
            for a, b in zip(edges, edges[1:]):
                some = rows.slice(a, b - a)
                if run is None or run.name != names[a]:
                    if run is not None:
                        yield from rest(run)
                    at, every = some.column("_at")[0].as_py(), some.column("_all")[0].as_py()
                    run = _Run(names[a], [at + e * every for e in range(epochs)])
                lists = some.column("_ids")
                tokens = lists.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(np.diff(lists.offsets.to_numpy()))
                for epoch in range(epochs):
                    before = run.starts[epoch] + len(run.held[epoch])
                    starts, borders, done = run.add(epoch, tokens, width)
                    if not len(borders):
                        continue
                    # The last document of a piece is the first that reaches its border.
                    last = pa.array(np.searchsorted(ends, borders - before))
                    limits = np.concatenate(([0], borders - starts[0]))
                    groups = [some.column(name).take(last) for name in by]
                    yield batch(groups, _later(some.column("_key").take(last), epoch * size), starts, limits, done)
                run.tail = tuple(some.column(name).slice(b - a - 1) for name in [*by, "_key"])
        if run is not None:
            yield from rest(run)

    return cut


def _later(keys: pa.Array, shift: int) -> pa.Array:
    return pc.add(keys, shift).cast(keys.type) if shift else keys


def windows(
    encoded: DataFrame,
    key: str,
    width: int,
    by: Sequence[str] = (),
    ids: str = "ids",
    keep_rest: bool = False,
    sizes: str | None = None,
    epochs: int = 1,
    size: int = 0,
) -> DataFrame:
    """Token stream cut into full windows of ``width`` tokens.

    The rest at the end is left out, or kept as a shorter window with ``keep_rest``. With ``epochs`` the
    stream is read several times in a row: offsets move on by its length and keys by ``size``, the rows stay single.

    A prefix scan in two passes. The first sums token counts by key range; the second deals the rows to their range,
    once, and cuts them while they stream by in order, each range from the total of
    those before it. Only the pieces at the ends of ranges are shuffled again, to be
    joined. A task holds less than a window besides its batch, however long
    documents are. Keys must be unique and not null; ``encoded`` is read three times, so pass a written table. The
    result is a written table.
    """
    by = list(by)
    count = (F.size(ids) if sizes is None else F.col(sizes)).cast("bigint")
    ranged = with_ranges(encoded.where(count > 0), key)
    totals = ranged.groupBy(*by, RANGE).agg(F.sum(count).alias("_n"))
    # One row for each range (and group).
    every = Window.partitionBy(*by)
    before = every.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by, RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"), F.sum("_n").over(every).alias("_all")
    )
    placed = ranged.join(F.broadcast(carried), [*by, RANGE]).select(
        *by, RANGE, F.xxhash64(*by, RANGE).alias("_run"), "_at", "_all", F.col(key).alias("_key"), F.col(ids).alias("_ids")
    )
    dealt = placed.repartitionById(range_count(encoded), RANGE).sortWithinPartitions(*by, "_key").drop(RANGE)
    fields = [encoded.schema[name] for name in by]
    kind = encoded.schema[key].dataType
    schema = T.StructType(
        [*fields, T.StructField("window_id", T.LongType()), T.StructField("_start", T.LongType()), T.StructField("last_key", kind), T.StructField("tokens", T.ArrayType(T.IntegerType()))]
    )
    pieces = materialize(dealt.mapInArrow(_cut(width, by, epochs, size), schema), "windows")
    names = [*by, "window_id", "last_key", "tokens"]
    whole = pieces.where(F.size("tokens") == width).select(*names)
    joined = pieces.where(F.size("tokens") < width).groupBy(*by, "window_id").agg(
        F.max("last_key").alias("last_key"), F.array_sort(F.collect_list(F.struct("_start", "tokens"))).alias("_parts")
    )
    tokens = F.flatten(F.transform("_parts", lambda p: p["tokens"]))
    joined = joined.select(*by, "window_id", "last_key", tokens.alias("tokens"))
    return whole.union(joined if keep_rest else joined.where(F.size("tokens") == width))


def pack(
    encoded: DataFrame,
    key: str,
    batch: int,
    length: int,
    by: Sequence[str] = (),
    ids: str = "ids",
    sizes: str | None = None,
    epochs: int = 1,
    size: int = 0,
) -> DataFrame:
    """Training batches of ``batch`` rows and ``length`` columns, one row a sequence.

    Windows hold one token more than the batch; the extra target is consumed,
    so windows do not overlap.
    """
    cells = batch * length
    rows = windows(encoded, key, cells + 1, by, ids, sizes=sizes, epochs=epochs, size=size).select(
        *by, F.col("window_id").alias("batch_id"), "last_key", "tokens",
        F.explode(F.sequence(F.lit(0), F.lit(batch - 1))).alias("row_in_batch"),
    )
    at = F.col("row_in_batch") * length
    return rows.select(
        *by, "batch_id", "row_in_batch", "last_key",
        F.slice("tokens", at + 1, F.lit(length)).alias("inputs"),
        F.slice("tokens", at + 2, F.lit(length)).cast("array<bigint>").alias("targets"),
    )


def pack_epochs(
    encoded: DataFrame,
    pos: str,
    size: int,
    batch: int,
    length: int,
    epochs: int = 1,
    num_iterations: int = -1,
    ids: str = "ids",
    sizes: str | None = None,
) -> DataFrame:
    """Packing of a mixture of ``size`` conversations read ``epochs`` times in a row.

    The stream runs on over the end of an epoch; rows are not repeated, each is cut at the borders of every epoch. ``progress`` and ``last_step``
    describe the reader after it has fetched what the batch needs.
    """
    packed = pack(encoded, pos, batch, length, ids=ids, sizes=sizes, epochs=epochs, size=size)
    fetched = F.col("last_key") + 1
    if num_iterations > 0:
        progress = (F.col("batch_id") + 1) / F.lit(num_iterations)
        last = (F.col("batch_id") + 1 >= num_iterations) | (fetched >= size)
    else:
        progress = F.pmod(fetched, F.lit(size)) / F.lit(size)
        last = fetched >= size
    return packed.withColumn("progress", progress).withColumn("last_step", last).drop("last_key")


def write_batches(df: DataFrame, path: str, *partitions: str) -> None:
    """One parquet row per sequence, in folders such as ``split`` and ``rank``."""
    df.write.partitionBy(*partitions).parquet(path)


def write_rank_batches(packed: DataFrame, path: str, split: str, batch: int, world_size: int, rows_per_file: int = 1 << 16) -> None:
    """Batches for ``world_size`` workers in files of ``rows_per_file`` rows, in folders ``split``, ``rank`` and ``file``.

    Batch ``i`` is step ``i div world_size`` of worker ``i mod world_size``, so a row's position in its worker's stream, and with it
    its file, follow from ``batch_id`` and ``row_in_batch``. A task writes whole files, in order of position.
    """
    step = F.expr(f"batch_id div {world_size}")
    placed = packed.select(
        F.lit(split).alias("split"), F.pmod("batch_id", F.lit(world_size)).cast("int").alias("rank"),
        (step * batch + F.col("row_in_batch")).cast("bigint").alias("position"), "batch_id", "row_in_batch", "inputs", "targets",
    ).withColumn("file", F.expr(f"cast(position div {rows_per_file} as int)"))
    dealt = placed.repartition("split", "rank", "file").sortWithinPartitions("rank", "file", "position")
    dealt.write.mode("append").partitionBy("split", "rank", "file").parquet(path)


def read_rank_batches(spark: SparkSession, path: str, split: str, rank: int, first: int = 0, rows_per_file: int | None = None) -> DataFrame:
    """The rows of one worker in order of ``position``, from position ``first`` on.

    Folders of other workers are not opened; with ``rows_per_file``, neither are files that end before ``first``.
    """
    rows = spark.read.parquet(path).where((F.col("split") == split) & (F.col("rank") == rank) & (F.col("position") >= first))
    if rows_per_file:
        rows = rows.where(F.col("file") >= first // rows_per_file)
    return rows.drop("file").orderBy("position")


def collate(
    rendered: DataFrame,
    pad_id: int,
    batch_size: int,
    idx: str = "idx",
    world_size: int = 1,
    epochs: int = 1,
) -> DataFrame:
    """Conversations to padded inputs and masked targets, one row each.

    Rows go to ranks by stride and fill batches in order; the last batch of a
    rank may be smaller. Targets are -1 where the mask is 0 and on padding.
    """
    placed = rendered.select(
        idx, "ids", "mask",
        F.pmod(F.col(idx), F.lit(world_size)).cast("int").alias("rank"),
        F.expr(f"{idx} div {world_size}").alias("_local"),
        F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"),
    ).select(
        "*",
        F.expr(f"_local div {batch_size}").alias("batch_id"),
        F.expr(f"cast(_local % {batch_size} as int)").alias("row_in_batch"),
    )
    # Batches hold batch_size rows at most.
    in_batch = Window.partitionBy("epoch", "rank", "batch_id")
    width = F.max(F.size("ids") - 1).over(in_batch)
    n = F.size("ids")
    missing = F.col("_width") - (n - 1)
    targets = F.zip_with(
        F.slice("ids", F.lit(2), n - 1), F.slice("mask", F.lit(2), n - 1),
        lambda i, m: F.when(m == 0, F.lit(-1)).otherwise(i).cast("bigint"),
    )
    return placed.withColumn("_width", width).select(
        "epoch", "rank", "batch_id", "row_in_batch", idx,
        F.concat(F.slice("ids", F.lit(1), n - 1), F.array_repeat(F.lit(pad_id), missing)).alias("inputs"),
        F.concat(targets, F.array_repeat(F.lit(-1).cast("bigint"), missing)).alias("targets"),
    )


def pad_right(df: DataFrame, group: str | list[str], pad_id: int, ids: str = "ids", out: str = "padded") -> DataFrame:
    """Sequences of a group padded to its longest one.

    The longest length is a partial aggregate joined back, so a group of any
    size stays spread over tasks.
    """
    keys = [group] if isinstance(group, str) else group
    longest = df.groupBy(*keys).agg(F.max(F.size(ids)).alias("_longest"))
    padding = F.array_repeat(F.lit(pad_id), F.col("_longest") - F.size(ids))
    return df.join(longest, keys).withColumn(out, F.concat(ids, padding)).drop("_longest")


def supervised_tokens(batches: DataFrame, *step: str) -> DataFrame:
    """Number of targets that count towards the loss, per step."""
    return batches.groupBy(*step).agg(
        F.sum(F.size(F.filter("targets", lambda t: t >= 0))).alias("n_supervised")
    )


def step_plan(df: DataFrame, target: int, batch: int, epochs: int, seq_len: int = 1) -> DataFrame:
    """Accumulation steps, iterations and tokens per step from the dataset size."""
    return df.agg(F.count("*").alias("train_size")).select(
        "train_size",
        F.lit(max(1, target // batch)).alias("grad_accum_steps"),
        F.expr(f"(train_size div {target}) * {epochs}").alias("num_iterations"),
        F.lit(max(1, target // batch) * batch * seq_len).alias("tokens_per_step"),
    )
