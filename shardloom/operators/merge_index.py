"""Merge rules from an inverted index: pair -> words, and pair counts kept by signed deltas.

The index is a set of written segments with one row per pair and word that holds it, in order of the pair,
so that a filter on the chosen pairs prunes files and pages. A round reads the entries of its
chosen pairs alone, brings each word up to date, merges it, and writes one more segment: the entries of pairs that the
merge made, and by how much every pair of these words changed. Nothing is
updated in place: an entry whose pair has gone from the word since is passed over.

A pair can arise in a word only in the round that makes the younger of its two symbols, so a word
has one entry a pair, and a count only falls once that round is over. Hence
a window of the most frequent pairs, with the count below which others may be missing (``floor``),
stays exact on the driver: it is read again from the base counts and deltas only when
the best pair is no longer above the floor. A round's deltas reach the driver summed by pair; there are at most four
for each symbol of the vocabulary and chosen pair. Small segments are rewritten to larger ones, a
level at a time, so that their number grows with the logarithm of the rounds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush, nsmallest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.session import materialize, scratch_path, session_conf

#: Pairs on the driver; further ones stay a table until they can be chosen.
WINDOW = 1 << 16
#: Segments of one level that are rewritten to one of the next.
FAN_IN = 12

SEGMENT = "pair string, syms string, cnt bigint, delta bigint"


def current(syms: str, rules: dict[str, tuple[int, str]]) -> str:
    """The symbols of a word after all ``rules`` (pair -> rank, symbol), lowest rank first.

    Symbols form a linked list and candidates a heap, so the cost does not depend on the number of rules.
    """
    held: list[str | None] = list(syms)
    n = len(held)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rules[pair][0], i) for i in range(n - 1) if (pair := syms[i : i + 2]) in rules]
    if not heap:
        return syms
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if held[i] is None or j >= n:
            continue
        rule = rules.get(held[i] + held[j])
        if rule is None or rule[0] != rank:
            continue
        held[i], held[j] = rule[1], None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (rule := rules.get(held[i] + held[k])) is not None:
                heappush(heap, (rule[0], i))
        if (h := before[i]) >= 0 and (rule := rules.get(held[h] + held[i])) is not None:
            heappush(heap, (rule[0], h))
    return "".join(s for s in held if s is not None)


def pairs_of(syms: str) -> Iterator[str]:
    return (syms[i : i + 2] for i in range(len(syms) - 1))


def _step(rules: dict[str, tuple[int, str]], run: list[tuple[str, str]]) -> Callable:
    """Merges the words of a batch of entries by the pairs of ``run``."""
    chosen = {pair: k for k, (pair, _) in enumerate(run)}
    new = {symbol for _, symbol in run}

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deltas: Counter = Counter()
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for pair, syms, cnt in zip(*(batch.column(k).to_pylist() for k in range(3))):
                now = current(syms, rules)
                held = {p for p in pairs_of(now) if p in chosen}
                # Of a word's entries the one of its first chosen pair does the work.
                if pair not in held or any(chosen[p] < chosen[pair] for p in held):
                    continue
                merged = now
                for k, (left_right, symbol) in enumerate(run):
                    if k >= chosen[pair]:
                        merged = merged.replace(left_right, symbol)
                for p in pairs_of(now):
                    deltas[p] -= cnt
                made = set()
                for p in pairs_of(merged):
                    deltas[p] += cnt
                    if p[0] in new or p[1] in new:
                        made.add(p)
                for p in made:
                    out[0].append(p)
                    out[1].append(merged)
                    out[2].append(cnt)
            if out[0]:
                yield _segment(*out, [None] * len(out[0]))
        told = [(p, d) for p, d in deltas.items() if d]
        if told:
            yield _segment([p for p, _ in told], [None] * len(told), [None] * len(told), [d for _, d in told])

    return merge


def _segment(pair: list, syms: list, cnt: list, delta: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((pair, syms, cnt, delta), kinds)], names=["pair", "syms", "cnt", "delta"])


class MergeIndex:
    """The state of a training: segments of the index, rules so far, and the window of pair counts.

    ``words`` is a written table (``syms``, ``cnt``), ``totals`` the counts of its pairs (``pair``, ``cnt``).
    """

    def __init__(self, words: DataFrame, totals: DataFrame) -> None:
        self.spark = words.sparkSession
        chars = F.split("syms", "")
        made = words.where(F.length("syms") > 1).withColumn("chars", chars)
        every = F.array_distinct(F.zip_with(F.slice("chars", F.lit(1), F.size("chars") - 1), F.slice("chars", F.lit(2), F.size("chars") - 1), lambda a, b: F.concat(a, b)))
        entries = made.select(F.explode_outer(every).alias("pair"), "syms", "cnt", F.lit(None).cast("bigint").alias("delta"))
        self.levels: list[list[str]] = [[]]
        self.base = self._write(entries)
        self.totals = materialize(totals, "pair_counts")
        self.rules: dict[str, tuple[int, str]] = {}
        self.counts: dict[str, int] = {}
        self.floor = 0
        self.refill()

    def _write(self, rows: DataFrame) -> str:
        path = scratch_path(self.spark, "segment")
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartitionByRange(parts, "pair", "syms").sortWithinPartitions("pair").write.parquet(path)
        return path

    def _recent(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(SEGMENT).parquet(*paths) if paths else self.spark.createDataFrame([], SEGMENT)

    def refill(self) -> None:
        """The window anew: base counts and all deltas, summed by pair."""
        deltas = self._read(self._recent()).where("delta IS NOT NULL").select("pair", "delta")
        sums = self.totals.select("pair", F.col("cnt").alias("delta")).union(deltas).groupBy("pair").agg(F.sum("delta").alias("cnt"))
        top = sums.where("cnt > 0").orderBy(F.desc("cnt"), "pair").limit(WINDOW).toArrow()
        self.counts = dict(zip(top["pair"].to_pylist(), top["cnt"].to_pylist()))
        self.floor = min(self.counts.values()) if len(self.counts) == WINDOW else 0

    def ranked(self, k: int) -> list[tuple[str, int]]:
        """The ``k`` most frequent pairs, as far as the window knows them; the smaller pair wins a tie."""
        def best() -> list[tuple[str, int]]:
            above = ((p, c) for p, c in self.counts.items() if c > self.floor)
            return nsmallest(k, above, key=lambda x: (-x[1], x[0]))

        found = best()
        if not found and self.floor:
            self.refill()
            if self.floor:
                # All of the window are as frequent as its last: ties count from here.
                self.floor -= 1
                found = best()[:1]
                self.floor += 1
                return found
            found = best()
        return found

    def merge(self, run: list[tuple[str, str]]) -> None:
        """Merges all words that hold a pair of ``run`` (pairs and their symbols)."""
        pairs = [pair for pair, _ in run]
        entries = self._read([self.base, *self._recent()]).where(F.col("pair").isin(pairs) & F.col("syms").isNotNull())
        path = scratch_path(self.spark, "segment")
        step = _step(dict(self.rules), run)
        entries.select("pair", "syms", "cnt").mapInArrow(step, SEGMENT).write.parquet(path)
        told = self._read([path]).where("delta IS NOT NULL").groupBy("pair").agg(F.sum("delta").alias("delta")).toArrow()
        new = {symbol for _, symbol in run}
        for pair, delta in zip(told["pair"].to_pylist(), told["delta"].to_pylist()):
            if pair in self.counts:
                self.counts[pair] += delta
                if self.counts[pair] <= 0:
                    del self.counts[pair]
            elif delta > self.floor and (pair[0] in new or pair[1] in new):
                self.counts[pair] = delta
        for pair, symbol in run:
            self.rules[pair] = (len(self.rules), symbol)
        self.levels[0].append(path)
        self._compact()

    def _compact(self) -> None:
        for depth in range(len(self.levels)):
            if len(self.levels[depth]) < FAN_IN:
                return
            rows = self._read(self.levels[depth])
            summed = rows.where("delta IS NOT NULL").groupBy("pair").agg(F.sum("delta").alias("delta")).where("delta <> 0")
            summed = summed.select("pair", F.lit(None).cast("string").alias("syms"), F.lit(None).cast("bigint").alias("cnt"), "delta")
            path = self._write(rows.where("syms IS NOT NULL").union(summed))
            self.levels[depth] = []
            if depth + 1 == len(self.levels):
                self.levels.append([])
            self.levels[depth + 1].append(path)


def plain_rounds(spark):
    """Settings for rounds: their tables are small and even, re-planning them would only take time."""
    return session_conf(spark, spark_sql_adaptive_enabled="false")
