"""Byte-pair vocabulary training on tables of distinct pieces."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shardloom.functions.text import (
    MAX_TOKEN_ID,
    SPLIT_DIGITS_3,
    byte_symbols,
    id_to_symbol,
    split_pieces,
    symbol_id,
    symbol_to_id,
)
from shardloom.operators.corpus import prepare_corpus
from shardloom.operators.merge_index import MergeIndex, plain_rounds
from shardloom.session import materialize
from shardloom.sources.shards import text_column

# The special tokens, in id order.
SPECIAL_TOKENS = (
    "<|bos|>",
    "<|user_start|>",
    "<|user_end|>",
    "<|assistant_start|>",
    "<|assistant_end|>",
    "<|python_start|>",
    "<|python_end|>",
    "<|output_start|>",
    "<|output_end|>",
)
N_BYTES = 256
_TOP_PAIRS = 512
_MAX_BATCH = 64
_DENSE_RULES = 64
#: Distinct pieces that a task holds before it passes their counts on.
_HELD_PIECES = 1 << 17


@dataclass(frozen=True)
class Tokenizer:
    """A trained vocabulary: merge rules in rank order and the split pattern.

    A few hundred thousand rules at most, so it travels with the plan.
    """

    merges: tuple[tuple[int, int, int], ...]  # left id, right id, count when chosen
    pattern: str = SPLIT_DIGITS_3
    specials: tuple[str, ...] = field(default=SPECIAL_TOKENS)

    @property
    def base_size(self) -> int:
        return N_BYTES + len(self.merges)

    @property
    def size(self) -> int:
        return self.base_size + len(self.specials)

    def special_id(self, name: str) -> int:
        return self.base_size + self.specials.index(name)

    def token_bytes(self) -> list[bytes]:
        """Bytes of every token; special tokens stand for their names."""
        tokens = [bytes([b]) for b in range(N_BYTES)]
        for left, right, _ in self.merges:
            tokens.append(tokens[left] + tokens[right])
        return tokens + [name.encode() for name in self.specials]


# --- piece and pair counts ---------------------------------------------------


def pieces(df: DataFrame, text: str = "text", pattern: str = SPLIT_DIGITS_3) -> DataFrame:
    """All pieces with their position in the row."""
    return df.select("*", F.posexplode(split_pieces(F.col(text), pattern)).alias("pos", "piece")).drop(text)


def _sum_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pieces of a task, summed while they are few enough to hold."""
    names = ["piece", "cnt"]
    held: list[pa.Table] = []
    size = 0

    def summed() -> pa.Table:
        return pa.concat_tables(held).group_by("piece").aggregate([("cnt", "sum")]).rename_columns(names)

    for batch in batches:
        found = batch.column(0).flatten().value_counts()
        held.append(pa.table([found.field("values").cast(pa.string()), found.field("counts")], names=names))
        size += len(found)
        if size > 2 * _HELD_PIECES:
            held = [summed()]
            size = held[0].num_rows
            if size > _HELD_PIECES:
                yield from held[0].to_batches()
                held, size = [], 0
    if held:
        yield from summed().to_batches()


def piece_counts(df: DataFrame, text: str = "text", pattern: str = SPLIT_DIGITS_3) -> DataFrame:
    """Counts are combined inside each task before the shuffle, so frequent pieces cost nothing.

    Arrow counts the pieces of a batch: a row for each of them would cost several times what splitting does.
    """
    split = df.select(split_pieces(F.col(text), pattern).alias("pieces"))
    return split.mapInArrow(_sum_pieces, "piece string, cnt bigint").groupBy("piece").agg(F.sum("cnt").alias("cnt"))


def with_symbols(counts: DataFrame) -> DataFrame:
    return counts.withColumn("syms", byte_symbols(F.col("piece")))


def _pair_totals(words: DataFrame) -> DataFrame:
    """One compiled stage: characters, pairs and partial sums. The outer form of
    the generator keeps the optimizer from splitting each word twice."""
    chars = words.where(F.length("syms") > 1).select(F.split("syms", "").alias("chars"), "cnt")
    placed = chars.select("cnt", "chars", F.posexplode_outer("chars").alias("pos", "left"))
    pair = F.concat("left", F.get("chars", F.col("pos") + 1))
    return (
        placed.where(F.col("pos") < F.size("chars") - 1)
        .select(pair.alias("pair"), "cnt")
        .groupBy("pair")
        .agg(F.sum("cnt").alias("cnt"))
    )


def _merge_codes(ids: np.ndarray, word: np.ndarray, left: int, right: int, new: int) -> tuple[np.ndarray, np.ndarray]:
    """``merge_symbols`` on the ids of many words, ``word`` tells which: a pair becomes ``new``, left to right."""
    at = np.flatnonzero((ids[:-1] == left) & (ids[1:] == right) & (word[:-1] == word[1:]))
    if left == right:  # of a run of overlapping pairs every other one
        place = np.arange(len(at))
        first = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, place, 0))
        at = at[(place - first) % 2 == 0]
    if not len(at):
        return ids, word
    ids[at] = new
    keep = np.ones(len(ids), bool)
    keep[at + 1] = False
    return ids[keep], word[keep]


def _sum_pairs(rules: list[tuple[int, int, int]]) -> Callable:
    """Weighted pair counts of the words (``syms`` of single bytes, ``cnt``) of a task, after ``rules``."""
    n = N_BYTES + len(rules)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(n * n, np.int64)
        for batch in batches:
            syms = batch.column(0)
            ids = np.frombuffer("".join(syms.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64) - symbol_base
            word = np.repeat(np.arange(len(syms)), pc.utf8_length(syms).to_numpy())
            for rule in rules:
                ids, word = _merge_codes(ids, word, *rule)
            inside = np.flatnonzero(word[:-1] == word[1:])
            np.add.at(totals, ids[inside] * n + ids[inside + 1], batch.column(1).to_numpy()[word[inside]])
        found = np.flatnonzero(totals)
        pairs = [id_to_symbol(k // n) + id_to_symbol(k % n) for k in found.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array(totals[found])], names=["pair", "cnt"])

    symbol_base = ord(id_to_symbol(0))
    return count


def _merged_totals(words: DataFrame, rules: list[tuple[int, int, int]]) -> DataFrame:
    """``_pair_totals`` of ``words`` after the first rules of a training, few enough to hold a number for each pair of ids."""
    counted = words.select("syms", "cnt").mapInArrow(_sum_pairs(rules), "pair string, cnt bigint")
    return counted.groupBy("pair").agg(F.sum("cnt").alias("cnt"))


def pair_counts(words: DataFrame) -> DataFrame:
    """Weighted counts of neighbouring symbols of a word table (``syms``, ``cnt``)."""
    return _pair_totals(words).select(
        symbol_id(F.substring("pair", 1, 1)).alias("l"),
        symbol_id(F.substring("pair", 2, 1)).alias("r"),
        "cnt",
    )


def best_pairs(pairs: DataFrame, k: int = 1) -> DataFrame:
    """Most frequent pairs; the smaller pair wins a tie."""
    return pairs.orderBy(F.desc("cnt"), "l", "r").limit(k)


def merge_symbols(syms: Column, rules: list[tuple[str, str]]) -> Column:
    """Replace each pair by its symbol, rule after rule, left to right."""
    for pair, symbol in rules:
        syms = F.replace(syms, F.lit(pair), F.lit(symbol))
    return syms


# --- training ----------------------------------------------------------------


def independent_prefix(ranked: list[tuple[str, int]], limit: int) -> list[tuple[str, int]]:
    """Longest run of top pairs that single-step training would pick in a row.

    A pair's count stays what it is as long as no earlier pair of the run can
    take one of its symbols away: its right symbol must not start, and its left
    symbol must not end, a pair of the run. Pairs that arise from a merge are at
    most as frequent as the neighbour they replace, and lose ties because their
    new symbol is larger. A pair of twice the same symbol overlaps itself, so it
    ends the run.
    """
    lefts: set[str] = set()
    rights: set[str] = set()
    run: list[tuple[str, int]] = []
    for pair, count in ranked[:limit]:
        left, right = pair
        if count <= 0 or right in lefts or left in rights:
            break
        run.append((pair, count))
        if left == right:
            break
        lefts.add(left)
        rights.add(right)
    return run


def train_merges(
    words: DataFrame, n_merges: int, max_batch: int = _MAX_BATCH
) -> tuple[tuple[int, int, int], ...]:
    """Greedy merge rules from a written word table (``syms``, ``cnt``).

    All rules that a round can prove are applied together. The first rules stand in most words, so
    their rounds go over all of them, with the rules so far applied to whole batches; after ``_DENSE_RULES`` a round reads only
    words that hold one of its pairs (``merge_index``).
    """
    if N_BYTES + n_merges > MAX_TOKEN_ID:
        raise ValueError(f"at most {MAX_TOKEN_ID - N_BYTES} merges")
    merges: list[tuple[int, int, int]] = []
    rules: list[tuple[str, str]] = []

    def take(ranked: list[tuple[str, int]]) -> list[tuple[str, str]]:
        run = independent_prefix(ranked, min(max_batch, n_merges - len(merges)))
        chosen = [(pair, id_to_symbol(N_BYTES + len(merges) + i)) for i, (pair, _) in enumerate(run)]
        merges.extend((symbol_to_id(pair[0]), symbol_to_id(pair[1]), count) for pair, count in run)
        rules.extend(chosen)
        return chosen

    merged = lambda: words.withColumn("syms", merge_symbols(F.col("syms"), rules))
    with plain_rounds(words.sparkSession):
        while len(merges) < min(n_merges, _DENSE_RULES):
            known = [(left, right, N_BYTES + rank) for rank, (left, right, _) in enumerate(merges)]
            top = _merged_totals(words, known).orderBy(F.desc("cnt"), "pair").limit(_TOP_PAIRS).collect()
            if not take([(r.pair, r.cnt) for r in top]):
                return tuple(merges)
    if len(merges) < n_merges:
        current = materialize(merged().where(F.length("syms") > 1), "words")
        index = MergeIndex(current, _pair_totals(current))
        with plain_rounds(words.sparkSession):
            while len(merges) < n_merges and (chosen := take(index.ranked(_TOP_PAIRS))):
                if len(merges) < n_merges:
                    index.merge(chosen)
    return tuple(merges)


def _spread(words: DataFrame) -> DataFrame:
    """Even partitions for the rounds that follow."""
    return words.repartition(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), "syms")


def train_tokenizer(
    df: DataFrame,
    vocab_size: int,
    key: str,
    text: str = "text",
    pattern: str = SPLIT_DIGITS_3,
    doc_cap: int = 0,
    max_bytes: int = 0,
    specials: tuple[str, ...] = SPECIAL_TOKENS,
    reserve_specials: bool = False,
) -> Tokenizer:
    """Train on the texts of any table, in ``key`` order where a budget applies.

    With ``reserve_specials`` the special tokens count towards ``vocab_size``.
    """
    text_column(df, text)
    base = vocab_size - (len(specials) if reserve_specials else 0)
    if base < N_BYTES:
        raise ValueError(f"vocabulary of {base} cannot hold the {N_BYTES} bytes")
    corpus = prepare_corpus(df, key, text, doc_cap, max_bytes)
    counts = piece_counts(corpus, text, pattern)
    words = with_symbols(counts.where(F.octet_length("piece") > 1)).select("syms", "cnt")
    merges = train_merges(materialize(_spread(words), "pieces"), base - N_BYTES)
    return Tokenizer(merges, pattern, specials)


# --- vocabulary tables -------------------------------------------------------


def merge_table(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    rows = [(rank, l, r, N_BYTES + rank, cnt) for rank, (l, r, cnt) in enumerate(tok.merges)]
    return spark.createDataFrame(rows, "rank int, l int, r int, token_id int, cnt bigint")


def rule_checks(rules: DataFrame) -> DataFrame:
    """``rules`` with what must hold of greedy training: parts are older tokens, no pair comes twice, counts never rise."""
    order = Window.partitionBy().orderBy("rank")  # a row a rule: bounded by the vocabulary
    again = F.count("*").over(Window.partitionBy("l", "r"))
    return rules.select(
        "*", (F.greatest("l", "r") < F.col("token_id")).alias("older_parts"), (again == 1).alias("once"),
        (F.col("cnt") <= F.coalesce(F.lag("cnt").over(order), "cnt")).alias("falling"),
    )


def vocabulary_table(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    rows = [
        (i, bytearray(token), len(token) if i < tok.base_size else 0, i >= tok.base_size)
        for i, token in enumerate(tok.token_bytes())
    ]
    return spark.createDataFrame(
        rows, "token_id int, token_bytes binary, n_bytes int, is_special boolean"
    )


def special_table(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    """Special tokens: id = size of the trained vocabulary + position."""
    names = F.array(*[F.lit(name) for name in tok.specials])
    return spark.range(1).select(F.posexplode(names).alias("position", "name")).select(
        (F.col("position") + F.lit(tok.base_size)).alias("token_id"), "position", "name"
    )


def specials_first(vocabulary: DataFrame) -> DataFrame:
    """Other numbering: special tokens, then single bytes, then merges."""
    group = (
        F.when(F.col("is_special"), 0).when(F.col("token_id") < N_BYTES, 1).otherwise(2)
    )
    n_special = vocabulary.agg(F.sum(F.col("is_special").cast("int"))).first()[0]
    base = vocabulary.count() - n_special
    moved = F.when(F.col("is_special"), F.col("token_id") - base).otherwise(
        F.col("token_id") + n_special
    )
    return vocabulary.select(
        moved.cast("int").alias("new_id"), "token_id", group.alias("class"), "is_special"
    )


def vocabulary_stats(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.agg(
        F.count("*").alias("vocab_size"),
        F.sum(F.col("is_special").cast("int")).alias("n_special"),
        F.max("n_bytes").alias("longest_token"),
    )
