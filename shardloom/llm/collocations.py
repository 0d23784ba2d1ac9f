"""Phrase collocation mining on a weighted de Bruijn graph of words.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into words
``[^\\x20\\x09]+``; all counts are per language (null: ``und``). A node is a pair of
words that follow each other, an edge a phrase of three: it leads from its first pair to its last and weighs its
occurrences. Only edges are counted in the texts. What follows from them:

* the count of a pair is the flow out of its node: its edges, and a correction for
  occurrences that no edge continues (the end of a piece, or a pair too rare to be a node);
* the count of a word is the flow of the pairs it begins, corrected likewise;
* nodes with one edge in and one out, both as heavy as themselves, are inside unary paths. Paths are
  compacted by pointer doubling (the rounds grow with the logarithm of the longest path) to one row
  each, and phrases are read off the paths. A pair inside a path always stands in a longer phrase as frequent as itself.

Rare pairs would be most of the graph. A first pass counts pairs by 64-bit hash, pre-aggregated
in every task; a filter of those that reach ``min_count`` (``common.key_filter``) folds
all others into the corrections of the second pass. Clashes and false hits only
add rows there; its counts are by words. Scores are exact decimals (an overflow is an error, counts below 10^16 fit).

Words never cross texts. Null and empty texts hold no words; a text of any length is read in parts
that overlap by two words. Repeated rows count again, null ids are of no matter, an empty table gives
no rows. Columns other than text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shardloom.llm.common import STEP_BYTES, Rolling, if_small, key_filter, may_hold, mix, steps, text_buffer
from shardloom.session import materialize, session_conf

MIN_COUNT, TOP = 10, 2000
#: A candidate goes if a longer one holds this share of its occurrences, in percent.
INSIDE = 50
#: Pairs that a task counts before it gives them out.
HELD = 1 << 21

#: What ends words, and what ends pieces too.
BLANKS, ENDS = b" \t", b".,;:!?\n\x0b\x0c\r"

_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)], _KIND[list(ENDS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class Words:
    """The words of some texts: limits in ``data``, hashes, piece and text of each."""

    def __init__(self, data: np.ndarray, limits: np.ndarray) -> None:
        kind = _KIND[data]
        inside = np.concatenate(([False], kind == 0, [False]))
        edge = np.zeros(len(data) + 1, bool)
        edge[limits] = True
        self.data = data
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        lengths = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix(Rolling(data, lower=True).between(self.starts, self.ends) + lengths)
        self.text = np.searchsorted(limits, self.starts, "right") - 1
        # Pieces are numbered by the ends before them; another text is another piece.
        self.piece = np.cumsum(kind == 2)[self.starts] + self.text if len(self.starts) else self.text

    def take(self, at: np.ndarray) -> pa.Array:
        """The lower-cased words at some places; a place of -1 gives null."""
        none = at < 0
        starts = np.where(none, 0, self.starts[at])
        sizes = np.where(none, 0, self.ends[at] - self.starts[at])
        limits = np.concatenate(([0], np.cumsum(sizes)))
        flat = _LOWER[self.data[np.arange(limits[-1]) + np.repeat(starts - limits[:-1], sizes)]]
        offsets = pa.array(limits, pa.int64()).buffers()[1]
        values = pa.LargeStringArray.from_buffers(len(at), offsets, pa.py_buffer(flat))
        words = values.cast(pa.string())
        return pc.if_else(pa.array(~none), words, pa.scalar(None, pa.string()))


def _parts(data: np.ndarray, limits: np.ndarray, size: int) -> Iterator[tuple[int, Words, int]]:
    """First text, words, and how many of them to count; the two after those are only looked at."""
    for lo, hi in steps(limits, size):
        begin, end = int(limits[lo]), int(limits[hi])
        if end - begin <= 2 * size:
            words = Words(data[begin:end], limits[lo : hi + 1] - begin)
            yield lo, words, len(words.starts)
            continue
        at = begin
        while at < end:
            to = min(end, at + size)
            while to < end and _KIND[data[to]] == 0 and _KIND[data[to - 1]] == 0:
                to += 1
            reach = 256
            while True:
                stop = min(end, to + reach)
                ahead = Words(data[to:stop], np.array([0, stop - to]))
                if stop == end or len(ahead.starts) > 2:
                    break
                reach *= 2
            if len(ahead.starts) > 2:
                stop = to + int(ahead.ends[1])
            words = Words(data[at:stop], np.array([0, stop - at]))
            yield lo, words, int(np.searchsorted(words.starts, to - at))
            at = to


def _lang_keys(lang: pa.Array) -> np.ndarray:
    coded = lang.fill_null("und").dictionary_encode()
    data, limits = text_buffer(coded.dictionary)
    rolling = Rolling(data)
    keys = mix(rolling.between(limits[:-1], limits[1:]) + np.diff(limits).astype(np.uint64) + _STEPS[2])
    return keys[coded.indices.to_numpy()]


def _links(words: Words, count: int, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each counted word whether one and two words follow it in its piece, and the hash of the pair it begins."""
    piece = np.concatenate((words.piece, [-1, -2]))
    here = piece[:count]
    one, two = piece[1 : count + 1] == here, piece[2 : count + 2] == here
    after = np.concatenate((words.hashes[1:], np.zeros(1, np.uint64)))
    pair = mix((words.hashes ^ lang[words.text]) * _STEPS[0] + after)
    return one, two, pair


def pair_sums(docs: DataFrame) -> DataFrame:
    """``pair, n``: occurrences of hashed pairs, summed in each task."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, limits = text_buffer(batch.column(0))
            lang = _lang_keys(batch.column(1))
            for first, words, n in _parts(data, limits, STEP_BYTES):
                one, _, pair = _links(words, n, lang[first:])
                held.append(pair[:n][one])
                size += len(held[-1])
                if size > HELD:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return docs.mapInArrow(count, "pair bigint, n bigint")


def edge_sums(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``gram, n`` of every place: its edge, or as much of it as the graph holds, summed by part of a task.

    A gram is one string, as that is what is shuffled: three words, two where no edge goes on from the
    pair, one where the word begins no node, and after a tab the language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, limits = text_buffer(batch.column(0))
            langs = batch.column(1).fill_null("und")
            keys = _lang_keys(langs)
            for first, words, n in _parts(data, limits, 2 * STEP_BYTES):
                if not n:
                    continue
                lang = keys[first:]
                one, two, pair = _links(words, n, lang)
                node = np.zeros(len(pair) + 1, bool)
                node[:-1] = may_hold(shared.value, pair)
                node[:n] &= one
                pairs = node[:n]
                # A pair that the lookahead begins is only asked about where two words follow.
                edges = pairs & two & node[1 : n + 1]
                own = np.concatenate((words.hashes, np.zeros(2, np.uint64)))
                last = np.where(edges, own[2 : n + 2], _STEPS[1])
                # Two independent keys; places are alike where both are.
                x = np.where(pairs, pair[:n], mix(own[:n] ^ lang[words.text[:n]]))
                told = mix(x * _STEPS[1] + last), mix(x + last * _STEPS[2]) + own[:n]
                order = np.argsort(told[0], kind="stable")
                new = np.ones(n, bool)
                new[1:] = (told[0][order][1:] != told[0][order][:-1]) | (told[1][order][1:] != told[1][order][:-1])
                heads = np.flatnonzero(new)
                at = order[heads]
                words_of = [words.take(at), words.take(np.where(pairs[at], at + 1, -1)), words.take(np.where(edges[at], at + 2, -1))]
                phrase = pc.binary_join_element_wise(*words_of, " ", null_handling="skip")
                gram = pc.binary_join_element_wise(phrase, langs.take(pa.array(first + words.text[at])), "\t")
                yield pa.RecordBatch.from_arrays([gram, pa.array(np.diff(np.append(heads, n)))], names=["gram", "n"])

    return docs.mapInArrow(count, "gram string, n bigint")


def graph(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """The weighted graph: ``lang, w1, w2, w3, n``, a written table. Edges have all words."""
    slim = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    pairs = pair_sums(slim).groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    frequent = key_filter(materialize(pairs.select("pair"), "pairs"), "pair")
    grams = edge_sums(slim, frequent).groupBy("gram").agg(F.sum("n").alias("n"))
    # Words hold no blanks and no tabs; a language may.
    parts, at = F.split(F.substring_index("gram", "\t", 1), " "), F.length(F.substring_index("gram", "\t", 1))
    lang = F.substring(F.col("gram"), at + 2, F.length("gram"))
    return materialize(grams.select(lang.alias("lang"), *(F.get(parts, F.lit(k)).alias(f"w{k + 1}") for k in range(3)), "n"), "graph")


def flows(table: DataFrame, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Words (``lang, w, f``) and nodes (``lang, w1, w2, f, out, inward, before``) from the flow of edges.

    ``out`` and ``inward`` are the heaviest edges of a node, ``before`` is the word that the latter begins with.
    """
    edge = F.when(F.col("w3").isNotNull(), F.col("n"))
    flow = materialize(table.groupBy("lang", "w1", "w2").agg(F.sum("n").alias("f"), F.max(edge).alias("out")), "flow")
    words = flow.groupBy("lang", F.col("w1").alias("w")).agg(F.sum("f").alias("f"))
    flow = flow.where("w2 IS NOT NULL")
    inward = table.where(F.col("w3").isNotNull() & (F.col("n") >= min_count)).groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"))
    inward = inward.agg(F.max("n").alias("inward"), F.max_by("w1", F.struct("n", "w1")).alias("before"))
    return words, flow.where(F.col("f") >= min_count).join(inward, ["lang", "w1", "w2"], "left")


def _unary(nodes: DataFrame) -> DataFrame:
    return nodes.where((F.col("out") == F.col("f")) & (F.col("inward") == F.col("f")))


def compact(table: DataFrame, nodes: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``lang, words, n``: the paths of the graph, edges of ``min_count`` or more joined at unary nodes.

    Every edge points to the one before it, if the node between them is unary, and takes over the pointer
    of the edge it points to until all point to the first of their path. A path of unary nodes alone cannot close,
    as its first occurrence in a text has no edge before it.
    """
    name = lambda *words: F.concat_ws(" ", *words)
    edges = table.where(F.col("w3").isNotNull() & (F.col("n") >= min_count))
    middle = _unary(nodes).select("lang", "w1", "w2", "before")
    linked = edges.join(middle, ["lang", "w1", "w2"], "left").select(
        "lang", name("w1", "w2", "w3").alias("edge"), F.col("w3").alias("last"), "n",
        F.coalesce(name(F.when(F.col("before").isNotNull(), F.col("before")), "w1", "w2"), F.lit("")).alias("to"), F.col("before").isNotNull().alias("moved"),
    )
    at = linked.select("lang", "edge", "last", "n", F.when(F.col("moved"), F.col("to")).otherwise(F.col("edge")).alias("to"), F.col("moved").cast("bigint").alias("d"))
    at = materialize(at, "linked")
    while True:
        step = at.where("d > 0").select("lang", F.col("edge").alias("to"), F.col("to").alias("next"), F.col("d").alias("more"))
        at = at.join(step, ["lang", "to"], "left").select(
            "lang", "edge", "last", "n", F.coalesce("next", "to").alias("to"), (F.col("d") + F.coalesce("more", F.lit(0))).alias("d"), F.col("next").isNotNull().alias("moved")
        )
        at = materialize(at, "jumped")
        if at.where("moved").isEmpty():
            break
        at = at.drop("moved")
    tail = F.transform(F.array_sort(F.collect_list(F.struct("d", "last"))), lambda x: x["last"])
    paths = at.groupBy("lang", "to").agg(tail.alias("tail"), F.max("n").alias("n"))
    # The first edge's last word is the first of the tail.
    return paths.select("lang", F.concat(F.slice(F.split("to", " "), 1, 2), "tail").alias("words"), "n")


def _score(a: str, l: str, r: str):  # noqa: E741
    """floor(1000000 a a / (l r)) in whole numbers of 38 digits."""
    big = lambda x: f"cast({x} AS decimal(19, 0))"
    return F.expr(f"(cast({big(a)} * {big(a)} AS decimal(31, 0)) * cast(1000000 AS decimal(7, 0))) div ({big(l)} * {big(r)})")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``top`` phrases of two or three words."""
    table = graph(docs, min_count)
    words, nodes = flows(table, min_count)
    nodes = materialize(nodes, "nodes")
    paths = materialize(compact(table, nodes, min_count), "paths")
    known = nodes.select("lang", F.explode(F.array("w1", "w2")).alias("w")).distinct()
    words = materialize(words, "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    words = if_small(materialize(words.join(known, ["lang", "w"], "left_semi"), "known"))
    pairs = if_small(nodes.select("lang", F.col("w1").alias("p1"), F.col("w2").alias("p2"), F.col("f").alias("pf")))
    word = lambda k: words.select("lang", F.col("w").alias(f"w{k}"), F.col("f").alias(f"f{k}"))
    pair = lambda k: pairs.select("lang", F.col("p1").alias(f"w{k}"), F.col("p2").alias(f"w{k + 1}"), F.col("pf").alias(f"f{k}{k + 1}"))

    at = F.explode(F.sequence(F.lit(0), F.size("words") - 3)).alias("at")
    three = paths.select("lang", "words", F.col("n").alias("a"), at).select("lang", "a", *(F.col("words")[F.col("at") + k].alias(f"w{k + 1}") for k in range(3)))
    three = three.join(word(1), ["lang", "w1"]).join(word(3), ["lang", "w3"]).join(pair(1), ["lang", "w1", "w2"]).join(pair(2), ["lang", "w2", "w3"])
    three = three.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
    early = F.col("s1") <= F.col("s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    longest = F.greatest(F.coalesce("out", F.lit(0)), F.coalesce("inward", F.lit(0)))
    alone = (longest < min_count) | (100 * longest < inside * F.col("f"))
    two = nodes.where(alone).select("lang", "w1", "w2", F.col("f").alias("a"))
    two = two.join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("a", "f1", "f2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = three.union(two).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # Every task keeps its first rows of a language before they are shuffled.
    with session_conf(docs.sparkSession, spark_sql_optimizer_windowGroupLimitThreshold=str(top)):
        best = materialize(best, "best")
    best = best.join(if_small(materialize(totals, "totals")), "lang")
    return best.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
