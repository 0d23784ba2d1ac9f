"""Exact top-k inner products from an impact-ordered, score-at-a-time index.

Components are integers. In a block of vectors each dimension's postings are kept by
quantised value (``LEVELS`` levels), so a posting segment is a dimension and a level.
For a query a segment's impact is the least that it adds to a score, above the least
that any level of the dimension adds. Segments are processed in rounds of
falling impact into accumulators. What is not processed yet can add no more than the
next impact a dimension, so after each round a vector has an upper bound, and the
exact scores of the leading vectors give the k-th best a lower bound. A block is left only
on this proof: the vectors whose upper bound reaches the k-th best score are few
(or everything is processed); these possible members are scored exactly.

Queries are compared with all vectors, in blocks: blocks of queries meet blocks of
vectors by key. Each pair of blocks gives k rows a query, and the best k of all are
kept. Ties go to the smaller id. Rows with a null id, and vectors that are null or
hold null or non-finite components, take no part; missing components at the end
count as 0, so an empty vector scores 0. Repeated rows are vectors of their own; a
query leaves out its own row only. Components must stay below 2^15 in size for exact bounds.
Fewer than k candidates: all. Empty tables: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.session import materialize

LEVELS = 32
BLOCK = 32_768
QUERIES = 512
ROUNDS = 8
#: A block is left when at most this share of its vectors can still be members.
FEW = 0.5


@dataclass
class Block:
    """Vectors of a block and their postings by dimension and level."""

    rows: np.ndarray
    ids: np.ndarray
    x: np.ndarray  # vectors by dimensions
    step: int
    low: int  # smallest level
    postings: np.ndarray  # dimensions by vectors: vectors by falling level
    levels: np.ndarray  # dimensions by vectors: the level of each posting
    starts: np.ndarray  # dimensions by levels: where a level's postings begin


def build_block(rows: np.ndarray, ids: np.ndarray, x: np.ndarray) -> Block:
    order = np.lexsort((rows, ids))
    rows, ids, x = rows[order], ids[order], x[order]
    span = int(x.max() - x.min()) + 1 if x.size else 1
    step = max(1, -(-span // (LEVELS - 1)))
    level = x // step
    low = int(level.min()) if x.size else 0
    level -= low
    postings = np.argsort(-level, axis=0, kind="stable").T
    sizes = np.stack([np.bincount(level[:, j], minlength=LEVELS) for j in range(x.shape[1])]) if x.size else np.zeros((x.shape[1], LEVELS), int)
    # Falling levels: a level begins after all higher ones.
    starts = np.concatenate((np.cumsum(sizes[:, ::-1], axis=1)[:, ::-1], np.zeros((len(sizes), 1), int)), axis=1)
    levels = np.take_along_axis(level.T, postings, axis=1)
    return Block(rows, ids, x, step, low, np.ascontiguousarray(postings), levels, starts)


def top_k(block: Block, query: np.ndarray, own_row: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the block and exact scores of the best k vectors, own row left out."""
    n, dims = block.x.shape
    live = block.rows != own_row
    if n <= 4 * k or dims == 0:
        return _exact(block, query, np.flatnonzero(live), k)
    values = (np.arange(LEVELS) + block.low) * block.step  # least value of a level
    ends = np.stack((values, values + block.step - 1))
    adds = query[:, None] * ends[:, None, :]  # both ends of what a level adds, by dimension
    least, slack = adds.min(0), np.abs(query).sum() * (block.step - 1)
    # Only levels that hold postings count.
    held = block.starts[:, :-1] > block.starts[:, 1:]
    floor = np.where(held, least, np.iinfo(np.int64).max).min(1)
    impact = np.where(held, least - floor[:, None], -1)
    base = floor.sum()
    ranked = np.sort(impact[impact >= 0])[::-1]
    cuts = np.unique(ranked[np.linspace(0, len(ranked) - 1, ROUNDS + 1).astype(int)[1:]])[::-1]
    unit = float(1 << int(impact.clip(0).max(1).sum() + 1).bit_length())
    both, weights = np.zeros(n), impact + unit  # accumulators of both sums: scores and numbers of postings
    bar, above, best = -np.inf, np.inf, None
    for cut in cuts:
        now = (impact >= cut) & (impact < above)
        above = cut
        # Impacts rise or fall with the level, so a round's segments of a dimension lie side by side.
        first, last = now.argmax(1), LEVELS - 1 - now[:, ::-1].argmax(1)
        for j in np.flatnonzero(now.any(1)).tolist():
            segment = slice(block.starts[j, last[j] + 1], block.starts[j, first[j]])
            # A vector has one posting a dimension, so places in a segment are distinct.
            both[block.postings[j, segment]] += weights[j].take(block.levels[j, segment])
        # Whole multiples of ``unit`` count the postings.
        seen = np.floor(both / unit)
        score = both - seen * unit
        rest = np.where(impact < cut, impact, 0).max(1)  # the next impact of each dimension
        bound = base + score + slack + np.minimum((dims - seen) * rest.max(), rest.sum())
        lead = np.argpartition(-score, 8 * k)[: 8 * k] if n > 8 * k else np.arange(n)
        best = _exact(block, query, lead[live[lead]], k)
        if len(best[1]) == k:
            bar = max(bar, best[1][-1])
        possible = np.flatnonzero((bound >= bar) & live)
        if len(possible) <= max(8 * k, FEW * n):
            break
    return _exact(block, query, possible, k)


def _exact(block: Block, query: np.ndarray, places: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    scores = block.x[places] @ query
    best = np.lexsort((places, block.ids[places], -scores))[:k]
    return places[best], scores[best]


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """``row, vec_id, v``: floor(scale * x) of the vectors that take part, as bytes of 64-bit integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    used = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            packed = [np.asarray(v, np.int64).tobytes() for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows), batch.column(0), pa.array(packed, pa.binary())], names=["row", "vec_id", "v"])

    slim = used.select(F.col("vec_id").cast("bigint"), whole.alias("v"))
    return slim.mapInArrow(pack, "row bigint, vec_id bigint, v binary")


def _matrix(values: list[bytes], dims: int) -> np.ndarray:
    if all(len(v) == 8 * dims for v in values):
        return np.frombuffer(b"".join(values), np.int64).reshape(len(values), dims)
    out = np.zeros((len(values), dims), np.int64)
    for i, v in enumerate(values):
        part = np.frombuffer(v, np.int64)
        out[i, : len(part)] = part
    return out


FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"


def search(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the best k vectors of every row where ``is_query`` holds.

    ``is_query`` is a condition on ``vec_id``.
    """
    table = materialize(quantised(vectors, scale), "vectors")
    asked = table.where(is_query)
    n, n_queries = table.count(), asked.count()
    blocks, parts = max(1, -(-n // BLOCK)), max(1, -(-n_queries // QUERIES))
    block, part = F.pmod(F.xxhash64("row"), F.lit(blocks)), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts))
    every = lambda m: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(m - 1).cast("bigint")))
    left = table.select("row", "vec_id", "v", block.alias("block"), every(parts).alias("part"))
    right = asked.select("row", "vec_id", "v", part.alias("part"), every(blocks).alias("block"))

    def meet(own: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if own.num_rows and queries.num_rows:
            values, asks = own["v"].to_pylist(), queries["v"].to_pylist()
            dims = max(len(v) for v in values + asks) // 8
            held = build_block(own["row"].to_numpy(), own["vec_id"].to_numpy(), _matrix(values, dims))
            for row, vec_id, q in zip(queries["row"].to_pylist(), queries["vec_id"].to_pylist(), _matrix(asks, dims)):
                places, scores = top_k(held, q, row, k)
                out[0] += [row] * len(places)
                out[1] += [vec_id] * len(places)
                out[2] += held.ids[places].tolist()
                out[3] += scores.tolist()
        columns = [pa.array(c, pa.int64()) for c in out]
        return pa.Table.from_arrays(columns, names=["query_row", "query_id", "vec_id", "score"])

    keys = ["block", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
