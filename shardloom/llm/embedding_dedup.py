"""Embedding near-dedup: an inverted multi-index over vector halves, traversed cell by cell.

Vectors are scaled to length one. Each half has a codebook of its own (k-means on a sample of at most
``SAMPLE_VALUES`` numbers); the pair of nearest codes is a vector's cell, one of the
product grid of its label. Every vector visits cells in the multi-sequence order, by growing
sum of squared distances of the halves to the codes, until the sum is ``slack`` above its
least. ``slack`` is what reaches ``TARGET`` recall of neighbours that are exactly as far as the threshold allows,
measured on the sample with random neighbours of that distance; nearer ones are found more
surely. In a visited cell all vectors are compared exactly, in double precision.

A pair is found if one of both visits the other's cell, and counted once for each side. Compared
are blocks of at most about ``BLOCK`` visitors and ``BLOCK`` members: a crowded cell
is cut by hash on both sides, so a group that holds a third of all rows spreads over tasks. A block gives a
count for each vector and stars that join its linked vectors, never its pairs. The counts of a group of distinct near copies still
take all their products; equal vectors are one row with a count.

Vectors of other labels or lengths are never compared. A vector that is null, has length zero or
holds a null or a non-finite component links with nothing, as does one with a null label. Equal vec_ids are rows of
their own; a null id takes part and counts as larger than all others. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.llm.common import if_small
from shardloom.llm.components import components
from shardloom.session import materialize

COSINE = 0.93
#: Numbers in the sample that codebooks and slack are fitted on.
SAMPLE_VALUES = 1 << 21
#: Vectors of a cell on average, if they spread evenly; codes a half at most.
CELL, MOST_CODES = 64, 2048
BLOCK = 2048
TARGET = 0.97


class Grid:
    """Codebooks of both halves and how far above the least cost a vector looks."""

    def __init__(self, sample: np.ndarray, codes: int, cosine: float) -> None:
        rng = np.random.default_rng(11)
        self.half = (sample.shape[1] + 1) // 2
        self.books = [_means(part, codes, rng) for part in (sample[:, : self.half], sample[:, self.half :])]
        self.slack = self._fit(sample, cosine, rng)

    def costs(self, x: np.ndarray) -> list[np.ndarray]:
        """Squared distances of both halves to all codes."""
        parts = (x[:, : self.half], x[:, self.half :])
        return [np.maximum((p**2).sum(1)[:, None] - 2 * p @ b.T + (b**2).sum(1), 0) for p, b in zip(parts, self.books)]

    def cells(self, x: np.ndarray) -> np.ndarray:
        u, v = self.costs(x)
        return u.argmin(1) * len(self.books[1]) + v.argmin(1)

    def _fit(self, sample: np.ndarray, cosine: float, rng: np.random.Generator) -> float:
        x = sample[: 1 << 13]
        away = rng.normal(size=x.shape)
        away -= (away * x).sum(1)[:, None] * x
        size = np.linalg.norm(away, axis=1)[:, None]
        y = cosine * x + math.sqrt(1 - cosine**2) * away / np.where(size > 0, size, 1)

        def above(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            u, v = self.costs(x)
            a, b = np.divmod(self.cells(y), len(self.books[1]))
            rows = np.arange(len(x))
            return u[rows, a] - u.min(1) + v[rows, b] - v.min(1)

        # Either side may visit the other.
        return float(np.quantile(np.minimum(above(x, y), above(y, x)), TARGET)) + 1e-9

    def visits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and cell of all visits of the vectors ``x``; a row's come in the order of their cost.

        The cells within the slack are a staircase in both sorted halves: step by
        step along the first half, as many codes of the second as still fit.
        """
        u, v = self.costs(x)
        left, right = u.argsort(1, kind="stable"), v.argsort(1, kind="stable")
        u, v = np.take_along_axis(u, left, 1), np.take_along_axis(v, right, 1)
        limit = u[:, 0] + v[:, 0] + self.slack
        rows, cells, cost = [], [], []
        for step in range(u.shape[1]):
            room = limit - u[:, step]
            counts = np.where(room >= v[:, 0], (v <= room[:, None]).sum(1), 0)
            if not counts.any():
                break
            row = np.repeat(np.arange(len(x)), counts)
            at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            rows.append(row)
            cells.append(left[row, step] * v.shape[1] + right[row, at])
            cost.append(u[row, step] + v[row, at])
        row, cell = np.concatenate(rows), np.concatenate(cells)
        order = np.lexsort((np.concatenate(cost), row))
        return row[order], cell[order]


def _means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    if points.shape[1] == 0:
        return np.zeros((1, 0))
    found = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(rounds):
        near = ((found**2).sum(1) - 2 * points @ found.T).argmin(1)
        counts = np.bincount(near, minlength=len(found))
        sums = np.zeros_like(found)
        np.add.at(sums, near, points)
        found = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], found)
    return found


def _unit(column: pa.Array) -> np.ndarray:
    """Vectors of one length, in double precision and scaled to length one."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    # Powers of two keep very large and very small components within range.
    flat = flat * np.exp2(-np.frexp(np.abs(flat).max(1))[1])[:, None]
    return flat / np.linalg.norm(flat, axis=1)[:, None]


def distinct_vectors(table: DataFrame, id_column: str, vector: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows (``vec_id, node``) and distinct usable vectors (``node, label, dim, vector, copies, low``).

    ``node`` is a hash of label and vector, null where a row can link with nothing.
    """
    v = F.col(vector)
    usable = F.col(label).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = usable & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    kind = table.schema[vector].dataType.elementType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        v = v.cast("array<double>")
    slim = table.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(label).cast("string").alias("label"), v.alias("vector"), usable.alias("ok"))
    node = F.when(F.col("ok"), F.xxhash64("label", "vector"))
    rows = slim.select("vec_id", node.alias("node"), F.when(F.col("ok"), F.col("label")).alias("label"), F.when(F.col("ok"), F.col("vector")).alias("vector"))
    found = rows.where("node IS NOT NULL").groupBy("node", "label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    return rows.select("vec_id", "node"), found.withColumn("dim", F.size("vector"))


def fit(vectors: DataFrame, dim: int, rows: int, labels: int, cosine: float) -> Grid:
    """Codebooks for vectors of one length, from those with the smallest hashes."""
    codes = int(min(MOST_CODES, max(1, math.sqrt(rows / labels / CELL))))
    size = max(1, min(rows, SAMPLE_VALUES // dim))
    chosen = vectors.where(F.col("dim") == dim).select("node", "vector").orderBy(F.xxhash64("node"), "node").limit(size)
    return Grid(_unit(chosen.toArrow()["vector"].combine_chunks()), codes, cosine)


def index_table(vectors: DataFrame, grids: dict[int, Grid]) -> DataFrame:
    """``vectors`` with ``cell`` and ``visits``; lengths without a grid have one cell."""
    shared = vectors.sparkSession.sparkContext.broadcast(grids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                grid = shared.value.get(int(dim))
                n = some.num_rows
                if grid is None:
                    cell, row, visits = np.zeros(n, np.int64), np.arange(n), np.zeros(n, np.int64)
                else:
                    x = _unit(some.column("vector"))
                    cell, (row, visits) = grid.cells(x), grid.visits(x)
                limits = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(limits), pa.array(visits.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(cell.astype(np.int32)), lists], names=[*some.schema.names, "cell", "visits"])

    schema = T.StructType([*vectors.schema, T.StructField("cell", T.IntegerType()), T.StructField("visits", T.ArrayType(T.IntegerType()))])
    return vectors.mapInArrow(place, schema)


FOUND = "node bigint, n bigint, star bigint"


def _stars(linked: np.ndarray, nodes: np.ndarray, guests: np.ndarray) -> np.ndarray:
    """For members, then guests, the smallest node joined to each by links between both sides."""
    mine, theirs = nodes.copy(), guests.copy()
    while True:
        best = np.where(linked, mine[:, None], np.iinfo(np.int64).max).min(0, initial=np.iinfo(np.int64).max)
        new_theirs = np.minimum(theirs, best)
        best = np.where(linked, new_theirs[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max)
        new_mine = np.minimum(mine, best)
        if (new_mine == mine).all() and (new_theirs == theirs).all():
            return np.concatenate((mine, theirs))
        mine, theirs = new_mine, new_theirs


def _compare(cosine: float):
    def block(members: pa.Table, guests: pa.Table) -> pa.Table:
        x, y = _unit(members["vector"].combine_chunks()), _unit(guests["vector"].combine_chunks())
        a, b = members["node"].to_numpy(), guests["node"].to_numpy()
        linked = (x @ y.T >= cosine) & (a[:, None] != b[None, :])
        weight = lambda t: t["copies"].to_numpy()
        # A guest counts each member; a member only guests whose cell it does not visit itself.
        visits = members["visits"].combine_chunks()
        owner = np.repeat(np.arange(len(a)), np.diff(visits.offsets.to_numpy()))
        cells, of = np.unique(guests["home"].to_numpy(), return_inverse=True)
        flat = visits.flatten().to_numpy()
        place = np.minimum(np.searchsorted(cells, flat), len(cells) - 1)
        seen = np.zeros((len(a), len(cells)), bool)
        hit = cells[place] == flat
        seen[owner[hit], place[hit]] = True
        for_guests = linked.T @ weight(members)
        for_members = (linked & ~seen[:, of]) @ weight(guests)
        nodes, n = np.concatenate((a, b)), np.concatenate((for_members, for_guests)).astype(np.int64)
        star = _stars(linked, a, b)
        keep = (n > 0) | (star != nodes)
        return pa.table({"node": nodes[keep], "n": n[keep], "star": star[keep]})

    return block


def _key(df: DataFrame, of: str, parts: str, name: str) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(of, F.lit(name)), F.col(parts)).cast("int"))


def links(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``node, n, star``: links of each vector found in a block, and a vector joined to it."""
    cell = ["label", "dim", "cell"]
    sizes = table.groupBy(*cell).agg(F.count("*").alias("members"))
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    guests = table.select("label", "dim", F.col("cell").alias("home"), F.explode("visits").alias("cell"), "node")
    asked = guests.groupBy(*cell).agg(F.count("*").alias("guests"))
    # Cells that anyone visits, with the number of parts of both sides.
    plan = sizes.join(asked, cell).select(*cell, blocks("members").alias("m"), blocks("guests").alias("g"))
    plan = if_small(materialize(plan, "cells"))
    key = [*cell, "mine", "part"]
    members = _key(table.join(plan, cell), "node", "m", "mine")
    members = members.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    members = members.select(*key, "node", "copies", "visits", "vector")
    visitors = table.select("label", "dim", F.col("cell").alias("home"), F.explode("visits").alias("cell"), "node", "copies", "vector").join(plan, cell)
    visitors = _key(visitors, "node", "g", "part").withColumn("mine", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    names = [*key, "node", "copies", "home", "vector"]
    visitors = visitors.select(*names).toDF(*names)  # columns of its own: both sides come from one table
    return members.groupBy(*key).cogroup(visitors.groupBy(*key)).applyInArrow(_compare(cosine), FOUND)


def near_duplicates(
    table: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``table``."""
    rows, vectors = distinct_vectors(table, id_column, vector, label)
    vectors = materialize(vectors, "vectors")
    # The most frequent lengths have codebooks; vectors of any other length share one cell a label.
    told = vectors.groupBy("dim").agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels"))
    grids = {r.dim: fit(vectors, r.dim, r.n, max(1, r.labels), cosine) for r in told.orderBy(F.desc("n"), "dim").limit(4).collect() if r.n > CELL}
    indexed = materialize(index_table(vectors, grids), "indexed")
    found = materialize(links(indexed, cosine), "found")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(found.where("node <> star").select(F.col("node").alias("a"), F.col("star").alias("b")))
    named = vectors.select("node", "copies", "low").join(counts, "node", "left").join(joined, "node", "left")
    named = materialize(named.select("node", "low", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "named")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    told = materialize(named.join(lows, "root").select("node", "n_links", "component_id"), "told")
    out = rows.join(told, "node", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
