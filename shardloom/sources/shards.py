"""Text shards: scans, splits, strided assignment, incremental landing."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.session import materialize

# Number of the last shard, which is the validation shard.
VALIDATION_SHARD = 1822
ROWS_PER_UNIT = 1024
# A shard of several files has a number after its own in all but the first.
_SHARD_NAME = r"shard_(\d+)(?:_\d+)?\.parquet$"
ROWS_PER_FILE = 1 << 20
MAX_TASKS = 1 << 16  # of one write
ROWS_PER_TASK = 1 << 14  # of shards that fit in one file
RENAME_THREADS = 16


def text_column(df: DataFrame, name: str = "text") -> DataFrame:
    """Fail before any job runs when the text column is missing or no string."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r}; found {df.columns}")
    if not isinstance(df.schema[name].dataType, T.StringType):
        raise ValueError(f"column {name!r} is {df.schema[name].dataType.simpleString()}, not string")
    return df


def _has_shards(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.parquet")
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    return files is not None and len(files) > 0


def scan_shards(spark: SparkSession, path: str, text: str = "text") -> DataFrame:
    """Texts of a shard folder with their file name and shard number.

    Names that do not end in ``.parquet`` (half-written files) are ignored and
    an absent folder gives no rows. Only the text column is read.
    """
    if not _has_shards(spark, path):
        return spark.createDataFrame([], f"{text} string, file_name string, shard_id int")
    df = spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    return text_column(df, text).select(text, F.col("_metadata.file_name").alias("file_name")).withColumn(
        "shard_id",
        F.nullif(F.regexp_extract("file_name", _SHARD_NAME, 1), F.lit("")).cast("int"),
    )


def scan_split(
    spark: SparkSession, split: str, data_dir: str, validation_dir: str | None = None
) -> DataFrame:
    """Training or validation shards; validation falls back to the data folder."""
    if split not in ("train", "val"):
        raise ValueError("split must be 'train' or 'val'")
    path = data_dir if split == "train" else (validation_dir or data_dir)
    if not _has_shards(spark, path):
        raise FileNotFoundError(f"no {split} shards in {path}")
    return scan_shards(spark, path)


def split_by_shard(df: DataFrame, split: str, validation_shard: int = VALIDATION_SHARD) -> DataFrame:
    """One split of a shard table; the filter reaches the scan."""
    if split not in ("train", "val"):
        raise ValueError("split must be 'train' or 'val'")
    is_validation = F.col("shard_id") == validation_shard
    return df.where(is_validation if split == "val" else ~is_validation)


def assign_ranks(df: DataFrame, unit: str, world_size: int, out: str = "rank") -> DataFrame:
    """Unit ``i`` goes to worker ``i mod world_size``."""
    return df.withColumn(out, F.pmod(F.col(unit), F.lit(world_size)).cast("int"))


def shard_inventory(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows and bytes of every shard."""
    return df.groupBy("shard_id").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.octet_length(text)).alias("n_bytes"),
    )


def missing_shards(manifest: DataFrame, landed: DataFrame) -> DataFrame:
    """Shards that are listed but not present yet."""
    return manifest.join(landed.select("shard_id").distinct(), "shard_id", "left_anti")


class _Store:
    """Folders and renames of the file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.as_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.as_path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def list(self, pattern: str) -> list[str]:
        """Paths that match a pattern, sorted."""
        found = self.fs.globStatus(self.as_path(pattern)) or []
        return sorted(status.getPath().toString() for status in found)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.as_path(path))

    def move(self, source: str, target: str) -> None:
        """Rename; a target that is there, or a rename that did not happen, is an error."""
        if self.exists(target):
            raise FileExistsError(f"{target} is there already; {source} stays where it is")
        self.fs.mkdirs(self.as_path(target).getParent())
        if not self.fs.rename(self.as_path(source), self.as_path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def each(self, call: Callable, items: Iterable) -> None:
        """``call`` for every item, several at a time; the first error is raised."""
        with ThreadPoolExecutor(RENAME_THREADS) as pool:
            for _ in pool.map(lambda item: call(*item), items):
                pass

    def remove(self, path: str) -> None:
        self.fs.delete(self.as_path(path), True)


def _shard_of(folder: str) -> int:
    return int(re.search(r"shard_id=(\d+)", folder).group(1))


def shard_totals(rows: DataFrame) -> DataFrame:
    """``shard_id, n_rows, digest``: what a shard holds, whatever the order of its rows."""
    told = F.xxhash64(*[c for c in sorted(rows.columns) if c != "shard_id"])
    return rows.groupBy("shard_id").agg(F.count("*").alias("n_rows"), F.bit_xor(told).alias("_x"), F.sum(told % 1_000_003).alias("_s")).select(
        "shard_id", "n_rows", F.concat_ws(":", "_x", "_s").alias("digest")
    )


def _deal(rows: DataFrame, counts: DataFrame, rows_per_file: int) -> DataFrame:
    """``rows`` dealt to tasks by ``shard_id`` and ``_part``, a large shard (``shard_id, n_rows``) to several.

    The part of a row comes from its values, so a repeated task writes the same rows. There is a task for each
    wanted file, as far as their hashes differ; shards of one file share tasks of ``ROWS_PER_TASK`` rows, as a
    task takes longer to start than to write a small shard.
    """
    if not counts.where("shard_id IS NULL").isEmpty():
        raise ValueError("rows without a shard_id")
    parts = counts.select("shard_id", "n_rows", F.ceil(F.col("n_rows") / rows_per_file).alias("_parts"))
    whole = F.col("_parts") == 1
    told = parts.agg(
        F.sum(F.when(~whole, F.col("_parts"))).alias("split"), F.count(F.when(whole, 1)).alias("whole"), F.sum(F.when(whole, F.col("n_rows"))).alias("rows")
    ).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    files = max(1, (told["split"] or 0) + min(told["whole"], max(4 * cores, -(-(told["rows"] or 0) // ROWS_PER_TASK))))
    names = [c for c in rows.columns if c != "shard_id"]
    salted = rows.join(F.broadcast(parts.drop("n_rows")), "shard_id").withColumn("_part", F.pmod(F.xxhash64(*names), F.col("_parts")))
    return salted.repartition(min(files, MAX_TASKS), "shard_id", "_part")


def landed_log(spark: SparkSession, target: str) -> DataFrame:
    """``shard_id, n_rows, digest`` of the shards that were landed to the end: the newest entry of each."""
    schema = "landing int, shard_id int, n_rows bigint, digest string"
    if not _Store(spark, target).list(f"{target}/_log/*/_SUCCESS"):
        return spark.createDataFrame([], schema).drop("landing")
    # A hidden folder is only read when its files are named.
    entries = spark.read.schema(schema).parquet(*_Store(spark, target).list(f"{target}/_log/*"))
    newest = F.max_by(F.struct("n_rows", "digest"), "landing").alias("last")
    return entries.groupBy("shard_id").agg(newest).select("shard_id", "last.*")


def land_shards(rows: DataFrame, target: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Add the shards that ``target`` lacks or holds in part; returns all that was landed.

    A log in ``_log`` records rows and digest of each shard that was landed to the end. A shard is
    complete when its folder is there and its entry equals what is to be landed, else all of it is written anew: first
    to a staging folder, whose rows are counted against the totals, then renamed in the place of what was there, last
    entered in the log. A landing that ends on the way leaves shards without an entry, which the next one replaces; readers
    never see a shard in part. Numbers are not null.
    """
    spark = rows.sparkSession
    rows = rows.withColumn("shard_id", F.col("shard_id").cast("int"))
    store = _Store(spark, target)
    present = [(_shard_of(path),) for path in store.list(f"{target}/shard_id=*")]
    held = spark.createDataFrame(present, "shard_id int").join(landed_log(spark, target), "shard_id")
    wanted = shard_totals(rows).join(held, ["shard_id", "n_rows", "digest"], "left_anti")
    # One entry a shard: a shard is a file of its own, so there are far fewer of them than rows.
    todo = {r.shard_id: r for r in wanted.collect()}
    if todo:
        totals = spark.createDataFrame([(r.shard_id, r.n_rows, r.digest) for r in todo.values()], "shard_id int, n_rows bigint, digest string")
        staged = f"{target}/_staged/{uuid.uuid4().hex}"
        dealt = _deal(rows, totals, rows_per_file).select(*rows.columns)
        dealt.write.partitionBy("shard_id").parquet(f"{staged}/new")
        written = spark.read.schema(rows.schema).parquet(f"{staged}/new")
        wrong = totals.exceptAll(shard_totals(written)).collect()
        if wrong:
            raise OSError(f"staged shards are not what was read: {[r.shard_id for r in wrong]}")

        def put(folder: str) -> None:
            place = f"{target}/shard_id={_shard_of(folder)}"
            if store.exists(place):
                store.move(place, f"{staged}/old/shard_id={_shard_of(folder)}")
            store.move(folder, place)

        store.each(put, [(folder,) for folder in store.list(f"{staged}/new/shard_id=*")])
        number = len(store.list(f"{target}/_log/*"))
        entry = totals.coalesce(1).select(F.lit(number).alias("landing"), "shard_id", "n_rows", "digest")
        entry.write.parquet(f"{target}/_log/{number:08d}")
        store.remove(staged)
    return spark.read.schema(rows.schema).parquet(target)


def export_shards(rows: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, order: str | None = None, group_rows: int | None = None) -> None:
    """Write ``rows`` as ``shard_00012.parquet`` files by their ``shard_id``, which is not stored.

    A shard of more than ``rows_per_file`` rows, or one that Spark writes as several files, goes on in
    ``shard_00012_0001.parquet`` and so on. Files are written by the tasks and then renamed, a call for each; a file that is
    there already or cannot be renamed is an error, and the staged files stay. ``order`` sorts
    the rows of a file, ``group_rows`` bounds its row groups.
    """
    spark = rows.sparkSession
    staged = f"{path}/_staged"
    counts = materialize(rows.groupBy("shard_id").agg(F.count("*").alias("n_rows")), "shards")
    dealt = _deal(rows, counts, rows_per_file)
    if order is not None:
        dealt = dealt.sortWithinPartitions("shard_id", "_part", order)
    writer = dealt.select(*rows.columns).write.partitionBy("shard_id")
    if group_rows is not None:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(staged)
    store = _Store(spark, path)
    found: dict[int, int] = {}
    moves = []
    for file in store.list(f"{staged}/shard_id=*/*.parquet"):
        shard = _shard_of(file)
        number = found.get(shard, 0)
        found[shard] = number + 1
        moves.append((file, f"{path}/shard_{shard:05d}{f'_{number:04d}' if number else ''}.parquet"))
    store.each(store.move, moves)
    store.remove(staged)


def shard_ids(spark: SparkSession, path: str) -> DataFrame:
    """Numbers of the shard files of a folder, from their names; none is an error."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/*.parquet")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    names = [re.search(_SHARD_NAME, status.getPath().getName()) for status in found]
    numbers = sorted({int(name.group(1)) for name in names if name})
    if not numbers:
        raise FileNotFoundError(f"no shards in {path}")
    return spark.createDataFrame([(n,) for n in numbers], "shard_id int")
