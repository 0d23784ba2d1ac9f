"""Running counts as levels of partial tables.

A trigger counts its own rows and writes them as a partial table of level 0, so what is written follows
the new rows and not all that were counted so far. When a level holds ``FAN_IN`` tables they are summed to
one of the next; a key is rewritten as often as there are levels, the logarithm of the triggers. A
reader sums the live tables. Nothing is kept in memory or in a state store between triggers.

The name of a table tells its level and the triggers it covers. A table of a higher level
replaces those it covers as soon as it is complete, whether or not they have been removed, and a repeated trigger
overwrites its own table or finds it covered; so a run may end anywhere and go on.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN_IN = 8
_NAME = re.compile(r"level-(\d+)-(\d+)-(\d+)$")


def _path(out: str, level: int, first: int, last: int) -> str:
    return f"{out}/level-{level:02d}-{first:09d}-{last:09d}"


def live_tables(spark: SparkSession, out: str) -> list[tuple[int, int, int]]:
    """Level, first and last trigger of the complete tables that no other one covers."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(out)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    done = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{out}/level-*/_SUCCESS")) or []
    names = [_NAME.search(status.getPath().getParent().getName()) for status in done]
    found = [tuple(int(x) for x in name.groups()) for name in names if name]
    covered = lambda t: any(o[0] > t[0] and o[1] <= t[1] and t[2] <= o[2] for o in found)
    return sorted(t for t in found if not covered(t))


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _sums(spark: SparkSession, out: str, tables: list[tuple[int, int, int]], schema: str, key: str) -> DataFrame:
    rows = spark.read.schema(schema).parquet(*[_path(out, *t) for t in tables])
    return rows.groupBy(key).agg(F.sum("cnt").alias("cnt"))


def compact(spark: SparkSession, out: str, schema: str, key: str) -> None:
    """Sums the tables of every level that is full."""
    level = 0
    while True:
        tables = live_tables(spark, out)
        if not any(t[0] >= level for t in tables):
            return
        full = [t for t in tables if t[0] == level]
        if len(full) >= FAN_IN:
            path = _path(out, level + 1, min(t[1] for t in full), max(t[2] for t in full))
            _sums(spark, out, full, schema, key).write.mode("overwrite").parquet(path)
            for t in full:
                _remove(spark, _path(out, *t))
        level += 1


def count_stream(stream: DataFrame, key: str, out: str, progress: str) -> DataFrame:
    """Counts of ``key`` over everything that is available; ``out`` and ``progress`` carry them to the next run."""
    spark = stream.sparkSession
    schema = f"{key} {stream.schema[key].dataType.simpleString()}, cnt bigint"

    def write(df: DataFrame, trigger: int) -> None:
        if any(t[0] > 0 and t[1] <= trigger <= t[2] for t in live_tables(spark, out)):
            return
        counts = df.groupBy(key).agg(F.count("*").alias("cnt"))
        counts.write.mode("overwrite").parquet(_path(out, 0, trigger, trigger))
        compact(spark, out, schema, key)

    writer = stream.select(key).writeStream.option("checkpointLocation", progress).trigger(availableNow=True)
    writer.foreachBatch(write).start().awaitTermination()
    return read_counts(spark, out, schema, key)


def read_counts(spark: SparkSession, out: str, schema: str, key: str) -> DataFrame:
    tables = live_tables(spark, out)
    if not tables:
        return spark.createDataFrame([], schema)
    return _sums(spark, out, tables, schema, key)
