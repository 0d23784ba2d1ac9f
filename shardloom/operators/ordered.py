"""Running totals in key order without a single-partition window.

The rows are cut into key ranges of similar size (boundaries from approximate
quantiles, so a crowded stretch of keys gets more ranges). Each range keeps its
own window; the totals of earlier ranges are added afterwards. Results do not
depend on where the boundaries fall. Order keys must be unique (per group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_RANGES = 1 << 16  # boundaries that the driver holds
RANGE = "_range"


def range_count(df: DataFrame) -> int:
    """Four ranges for each shuffle partition, never more than MAX_RANGES."""
    return min(MAX_RANGES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_ranges(df: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """Add the key range of every row. Reads the key column once for the boundaries."""
    n = ranges or range_count(df)
    probabilities = [i / n for i in range(1, n)]
    quantiles = df.approxQuantile(key, probabilities, 1 / (4 * n)) if n > 1 else []
    splits = [float("-inf"), *sorted(set(quantiles)), float("inf")]
    if len(splits) < 3:
        return df.withColumn(RANGE, F.lit(0))
    cut = Bucketizer(splits=splits, inputCol="_range_key", outputCol="_range_no")
    return (
        cut.transform(df.withColumn("_range_key", F.col(key).cast("double")))
        .withColumn(RANGE, F.col("_range_no").cast("int"))
        .drop("_range_key", "_range_no")
    )


def running(
    df: DataFrame,
    key: str,
    value: Column,
    out: str,
    by: Sequence[str] = (),
    agg=F.sum,
    inclusive: bool = False,
) -> DataFrame:
    """Running ``agg`` of ``value`` in ``key`` order, per ``by`` group.

    Exclusive by default (rows before this one). ``df`` is read three times
    (boundaries, range totals, rows): pass a slim or written table.
    """
    by = list(by)
    ranged = with_ranges(df, key).withColumn("_value", value)
    before = Window.partitionBy(*by) if by else Window.partitionBy()
    before = before.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, RANGE).agg(agg("_value").alias("_total"))
    # At most MAX_RANGES rows per group.
    carried = totals.select(*by, RANGE, agg("_total").over(before).alias("_carried"))
    if not by:
        carried = F.broadcast(carried)
    local = (
        Window.partitionBy(*by, RANGE)
        .orderBy(key)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    joined = ranged.withColumn("_local", agg("_value").over(local)).join(carried, [*by, RANGE])
    combined = _combine(agg, F.col("_carried"), F.col("_local"))
    return joined.withColumn(out, combined).drop(RANGE, "_value", "_local", "_carried")


def _combine(agg, carried: Column, local: Column) -> Column:
    if agg is F.min:
        return F.least(carried, local)
    if agg is F.max:
        return F.greatest(carried, local)
    return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))


def shuffled_positions(
    df: DataFrame, digest: Column, out: str = "pos", by: Sequence[str] = ()
) -> DataFrame:
    """Dense 0-based positions in digest order, per ``by`` group.

    A digest spreads rows evenly, so its first three hex digits give 4,096
    ranges of similar size, in every group. Digests must be distinct.
    """
    by = list(by)
    ranged = df.withColumn("_digest", digest).withColumn(
        RANGE, F.conv(F.substring("_digest", 1, 3), 16, 10).cast("int")
    )
    before = Window.partitionBy(*by).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranged.groupBy(*by, RANGE)
        .agg(F.count("*").alias("_n"))
        .select(*by, RANGE, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carried"))
    )
    if not by:
        carried = F.broadcast(carried)
    local = Window.partitionBy(*by, RANGE).orderBy("_digest")
    return (
        ranged.withColumn("_local", F.row_number().over(local))
        .join(carried, [*by, RANGE])
        .withColumn(out, (F.col("_carried") + F.col("_local") - 1).cast("bigint"))
        .drop(RANGE, "_digest", "_local", "_carried")
    )
