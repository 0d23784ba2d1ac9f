"""Row groups of parquet shards as the unit of work: an input partition for each, or for several small ones.

A Python data source. A row group is read if it belongs to the wanted worker (group ``i`` of a file
goes to worker ``i mod step``) and the filters of the query can meet it by
its column statistics; a task reads the columns asked for, batch by batch. Groups keep
their number, so each worker sees the same rows whatever the cluster looks like.

Of few files the driver reads the footers, in order of the file names, and plans a partition for every row group, or,
past ``MAX_PARTITIONS`` of them, for runs of neighbours. Of more than ``MAX_FOOTERS`` files it plans runs of files by their
bytes, and the tasks read the footers.

The files must lie where pyarrow can open them (local, s3, gs, hdfs); of a store that only Spark reads use
``shards.scan_shards``.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Footers that the driver reads at the same time.
FOOTER_THREADS = 16
#: Files whose footers the driver reads; of more the tasks do.
MAX_FOOTERS = 256
#: Partitions that single row groups are planned for, and bytes of files that a task reads otherwise.
MAX_PARTITIONS = 256
RUN_BYTES = 16 << 20
UNIT_FIELDS = [StructField("file_name", StringType()), StructField("row_group", IntegerType())]


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def sized_files(path: str) -> tuple[pafs.FileSystem, list[tuple[str, int]]]:
    """Parquet files of a folder in order of their names, with their bytes; half-written ones have other endings."""
    store, folder = _store(path)
    found = store.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return store, sorted((f.path, f.size) for f in found if f.is_file and f.base_name.endswith(".parquet"))


def shard_files(path: str) -> tuple[pafs.FileSystem, list[str]]:
    store, files = sized_files(path)
    return store, [file for file, _ in files]


@dataclass
class RowGroups(InputPartition):
    """Files with the numbers of their wanted row groups; None where the task is to find them."""

    files: list[tuple[str, list[int] | None]]


def runs_of(sizes: list[int], limit: int) -> list[tuple[int, int]]:
    """Runs of neighbours (start, end) whose sizes add up to ``limit``, a larger one alone."""
    runs, start, filled = [], 0, 0
    for k, size in enumerate(sizes):
        if k > start and filled + size > limit:
            runs.append((start, k))
            start, filled = k, 0
        filled += size
    return [*runs, (start, len(sizes))] if sizes else []


def can_hold(low, high, condition: Filter) -> bool:
    """Whether values between ``low`` and ``high`` can meet a filter; others than comparisons always may."""
    value = getattr(condition, "value", None)
    try:
        if isinstance(condition, In):
            return any(low <= v <= high for v in value)
        if isinstance(condition, EqualTo):
            return low <= value <= high
        if isinstance(condition, GreaterThan):
            return high > value
        if isinstance(condition, GreaterThanOrEqual):
            return high >= value
        if isinstance(condition, LessThan):
            return low < value
        if isinstance(condition, LessThanOrEqual):
            return low <= value
    except TypeError:  # statistics of another type say nothing
        pass
    return True


class RowGroupReader(DataSourceReader):
    def __init__(self, options: dict[str, str], names: list[str]) -> None:
        self.path, self.names = options["path"], names
        self.start, self.step = int(options.get("start", 0)), int(options.get("step", 1))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons drop row groups; Spark still applies them to rows."""
        for condition in filters:
            if len(condition.attribute) == 1:
                self.filters.append(condition)
            yield condition

    def _wanted(self, meta: pq.FileMetaData, number: int, file: str) -> bool:
        group = meta.row_group(number)
        bounds = {"file_name": (file, file), "row_group": (number, number)}
        for k in range(group.num_columns):
            told = group.column(k).statistics
            if told is not None and told.has_min_max:
                bounds[group.column(k).path_in_schema] = (told.min, told.max)
        return all(
            can_hold(*bounds[condition.attribute[0]], condition) for condition in self.filters if condition.attribute[0] in bounds
        )

    def _numbers(self, store: pafs.FileSystem, file: str) -> list[tuple[int, int]]:
        """Numbers and bytes of the wanted row groups of a file."""
        meta = pq.read_metadata(file, filesystem=store)
        base = file.rsplit("/", 1)[-1]
        every = range(self.start, meta.num_row_groups, self.step)
        return [(k, meta.row_group(k).total_byte_size) for k in every if self._wanted(meta, k, base)]

    def partitions(self) -> list[RowGroups]:
        store, files = sized_files(self.path)
        if len(files) > MAX_FOOTERS:
            return [RowGroups([(file, None) for file, _ in files[a:b]]) for a, b in runs_of([size for _, size in files], RUN_BYTES)]
        names = [file for file, _ in files]
        with ThreadPoolExecutor(FOOTER_THREADS) as pool:
            found = [(file, k, size) for file, some in zip(names, pool.map(lambda f: self._numbers(store, f), names)) for k, size in some]
        limit = RUN_BYTES if len(found) > MAX_PARTITIONS else 0
        return [RowGroups([(file, [k]) for file, k, _ in found[a:b]]) for a, b in runs_of([size for *_, size in found], limit)]

    def read(self, partition: RowGroups) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no row group is wanted
            return
        store, _ = _store(self.path)
        for file, numbers in partition.files:
            if numbers is None:
                numbers = [k for k, _ in self._numbers(store, file)]
            if not numbers:
                continue
            base = file.rsplit("/", 1)[-1]
            with store.open_input_file(file) as source:
                held = pq.ParquetFile(source)
                for number in numbers:
                    for batch in held.iter_batches(row_groups=[number], columns=self.names):
                        n = batch.num_rows
                        unit = [pa.array([base] * n, pa.string()), pa.array([number] * n, pa.int32())]
                        columns = [batch.column(batch.schema.get_field_index(name)) for name in self.names]
                        yield pa.RecordBatch.from_arrays([*columns, *unit], names=[*self.names, "file_name", "row_group"])


class RowGroupSource(DataSource):
    """Format ``row_groups``; options ``path``, ``columns`` (comma-separated, all if absent), ``start`` and ``step``."""

    @classmethod
    def name(cls) -> str:
        return "row_groups"

    def _columns(self) -> StructType:
        store, files = shard_files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no shards in {self.options['path']}")
        every = from_arrow_schema(pq.read_schema(files[0], filesystem=store))
        names = [c for c in self.options.get("columns", "").split(",") if c] or every.names
        missing = [c for c in names if c not in every.names]
        if missing:
            raise ValueError(f"no column {missing}; found {every.names}")
        return StructType([every[c] for c in names])

    def schema(self) -> StructType:
        return StructType([*self._columns().fields, *UNIT_FIELDS])

    def reader(self, schema: StructType) -> RowGroupReader:
        return RowGroupReader(dict(self.options), [f.name for f in schema.fields[: -len(UNIT_FIELDS)]])


def scan_row_groups(
    spark: SparkSession, path: str, columns: list[str] | None = None, rank: int | None = None, world_size: int = 1
) -> DataFrame:
    """Rows of a shard folder with ``file_name``, ``row_group`` and ``rank``, the worker that the group belongs to.

    With ``rank`` only the groups of this worker are read at all. A column that is not there and a
    folder without shards are errors.
    """
    if world_size < 1 or (rank is not None and not 0 <= rank < world_size):
        raise ValueError("need 0 <= rank < world_size")
    spark.dataSource.register(RowGroupSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("row_groups").option("path", path)
    if columns:
        reader = reader.option("columns", ",".join(columns))
    if rank is not None:
        reader = reader.option("start", rank).option("step", world_size)
    return reader.load().withColumn("rank", F.pmod("row_group", F.lit(world_size)).cast("int"))
