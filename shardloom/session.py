"""Session helpers: where intermediate tables go and how they are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shardloom", cores: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use spark-submit's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such
    a folder would be lost with its machine, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="shardloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; every call gives another one."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def spread(scan: DataFrame) -> DataFrame:
    """More partitions for a file scan that has fewer than there are cores.

    For CPU-heavy work on one or two files. A scan of many files comes back
    unchanged, so no shuffle is added where the data is large.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint, computes the input a single time and
    survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that :func:`materialize` wrote, once all that is made of them is written too."""
    for table in tables:
        spark, path = table.sparkSession, getattr(table, "_written_to", None)
        if path is not None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def session_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings that hold inside the block only; underscores stand for dots.

    A plan that is built inside and run outside does not see them.
    """
    names = {name.replace("_", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
