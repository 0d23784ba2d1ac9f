"""Encoding, decoding and token statistics."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.text import split_pieces
from shardloom.operators.vocabulary import _DENSE_RULES, N_BYTES, Tokenizer, _merge_codes

_CACHE_TOKENS = 1 << 20  # tokens of the pieces kept by one encoder of a Python worker; only a speed matter
#: Bytes of pieces that a Python worker gets at once; a longer row is a batch of its own.
_BATCH_BYTES = 8 << 20
_RULE_BYTES = 1 << 18  # bytes of pieces that few rules go over at once; a longer piece goes alone
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def encode_piece(piece: str, ranks: dict[tuple[int, int], int]) -> list[int]:
    """Ids of one piece: the lowest-ranked pair first, left to right.

    Symbols form a linked list and candidate pairs a heap of (rank, place), so a
    piece of n bytes costs n log n, however many rules apply.
    """
    ids: list[int | None] = list(piece.encode("utf-8"))
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[pair], i) for i, pair in enumerate(zip(ids, ids[1:])) if pair in ranks]
    heapify(heap)
    while heap:
        new_id, i = heappop(heap)
        j = after[i]
        # A pair that has changed since it was put on the heap is out of date.
        if ids[i] is None or j >= n or ranks.get((ids[i], ids[j])) != new_id:
            continue
        ids[i], ids[j] = new_id, None
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (rank := ranks.get((new_id, ids[k]))) is not None:
                heappush(heap, (rank, i))
        if (h := before[i]) >= 0 and (rank := ranks.get((ids[h], new_id))) is not None:
            heappush(heap, (rank, h))
    return [i for i in ids if i is not None]


def encode_pieces(pieces: list[str], rules: list[tuple[int, int, int]]) -> pa.ListArray:
    """``encode_piece`` of many pieces: each rule (left id, right id, new id) in turn goes over all of them.

    For few rules, in rank order, whose parts are older than their token: then no rule makes work for one before it.
    """
    raw = [piece.encode("utf-8") for piece in pieces]
    ends = np.cumsum([0, *map(len, raw)], dtype=np.int64)
    codes = np.frombuffer(b"".join(raw), np.uint8)
    borders = [np.zeros(1, np.int64)]
    tokens = [np.zeros(0, np.int32)]
    at = 0
    while at < len(raw):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + _RULE_BYTES, "right")) - 1)
        ids = codes[ends[at] : ends[to]].astype(np.int32)
        word = np.repeat(np.arange(to - at, dtype=np.int32), np.diff(ends[at : to + 1]))
        for rule in rules:
            ids, word = _merge_codes(ids, word, *rule)
        borders.append(borders[-1][-1] + np.cumsum(np.bincount(word, minlength=to - at)))
        tokens.append(ids)
        at = to
    return pa.ListArray.from_arrays(pa.array(np.concatenate(borders).astype(np.int32)), pa.array(np.concatenate(tokens)))


def piece_encoder(spark: SparkSession, tok: Tokenizer, nested: bool = False):
    """Arrow function from arrays of pieces to arrays of token ids.

    No shuffle: the rules are broadcast (bounded by the vocabulary size). Per
    batch few rules go over all distinct pieces at once; with more rules those that this worker has not met are
    encoded one by one. The ids are then put in place by array kernels. ``nested`` takes
    arrays of arrays of pieces (the segments of a conversation). Workers hold batches of
    bounded bytes and a bounded cache, so their memory does not grow with the table: where the
    session sets no limit on the bytes of Arrow batches, it is set to ``_BATCH_BYTES``.
    """
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(_BATCH_BYTES))
    ranks = {(l, r): N_BYTES + rank for rank, (l, r, _) in enumerate(tok.merges)}
    few = None
    if len(ranks) <= _DENSE_RULES and all(max(pair) < new for pair, new in ranks.items()):
        few = sorted(((l, r, new) for (l, r), new in ranks.items()), key=lambda rule: rule[2])
    shared = spark.sparkContext.broadcast(ranks)
    known: dict[str, list[int]] = {}
    held = 0

    def encode_rows(rows: pa.Array) -> pa.Array:
        nonlocal held
        if held > _CACHE_TOKENS:
            known.clear()
            held = 0
        distinct = rows.flatten().dictionary_encode()
        pieces = distinct.dictionary.to_pylist()
        if few is not None:
            found = encode_pieces(pieces, few)
        else:
            encoded = []
            for piece in pieces:
                ids = known.get(piece)
                if ids is None:
                    ids = known[piece] = encode_piece(piece, shared.value)
                    held += len(ids)
                encoded.append(ids)
            found = pa.array(encoded, pa.list_(pa.int32()))
        tokens = found.take(distinct.indices)
        token_borders = np.zeros(len(tokens) + 1, dtype=np.int64)
        np.cumsum(np.diff(tokens.offsets.to_numpy()), out=token_borders[1:])
        borders = token_borders[_borders(rows)].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(borders), tokens.flatten(), mask=rows.is_null())

    if not nested:
        return F.arrow_udf(encode_rows, "array<int>")

    def encode_nested(rows: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(
            pa.array(_borders(rows).astype(np.int32)), encode_rows(rows.flatten()), mask=rows.is_null()
        )

    return F.arrow_udf(encode_nested, "array<array<int>>")


def _borders(rows: pa.Array) -> np.ndarray:
    """Start of each list in the flattened values; null lists are empty."""
    sizes = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def encode_text(spark: SparkSession, tok: Tokenizer, text: Column) -> Column:
    return piece_encoder(spark, tok)(split_pieces(text, tok.pattern))


def encode_corpus(
    df: DataFrame,
    tok: Tokenizer,
    text: str = "text",
    prepend: str | int | None = None,
    append: str | int | None = None,
    out: str = "ids",
) -> DataFrame:
    """Texts to token ids, with an optional special token at either end."""
    ids = encode_text(df.sparkSession, tok, F.col(text))
    encoded = df.withColumn(out, ids)
    ends = [[] if e is None else [_as_id(tok, e)] for e in (prepend, append)]
    if ends[0] or ends[1]:
        joined = [F.array(F.lit(ends[0][0]))] if ends[0] else []
        joined.append(F.col(out))
        joined += [F.array(F.lit(ends[1][0]))] if ends[1] else []
        encoded = encoded.withColumn(out, F.concat(*joined))
    return encoded


def _as_id(tok: Tokenizer, token: str | int) -> int:
    return token if isinstance(token, int) else tok.special_id(token)


def token_hex(tok: Tokenizer) -> Column:
    """Constant array: hex of the bytes of every token id."""
    return F.split(F.lit(",".join(t.hex().upper() for t in tok.token_bytes())), ",")


def token_lengths(tok: Tokenizer) -> Column:
    """Constant array: byte length of every token id, 0 for special tokens."""
    sizes = [len(t) for t in tok.token_bytes()[: tok.base_size]] + [0] * len(tok.specials)
    return F.split(F.lit(",".join(map(str, sizes))), ",").cast("array<int>")


def decode_ids(tok: Tokenizer, ids: Column) -> Column:
    """Ids to text, invalid bytes replaced. Stays in generated code: a constant
    array holds the bytes of each token."""
    table = token_hex(tok)
    raw = F.unhex(F.array_join(F.transform(ids, lambda i: F.get(table, i)), ""))
    return F.make_valid_utf8(raw.cast("string"))


def token_view(tok: Tokenizer, ids: Column, mask: Column, with_id: bool = False) -> Column:
    """Readable tokens: ``+`` marks supervised ones, ``-`` the others."""
    def show(i: Column, m: Column) -> Column:
        text = F.concat(
            F.when(m == 1, "+").otherwise("-"),
            decode_ids(tok, F.array(i)),
        )
        return F.concat(text, F.lit("("), i.cast("string"), F.lit(")")) if with_id else text

    return F.array_join(F.zip_with(ids, mask, show), "|")


def compression_ratio(encoded: DataFrame, group: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Bytes per token of each group and overall (group null); 0 without tokens."""
    sums = encoded.rollup(group).agg(
        F.sum(F.octet_length(text)).cast("bigint").alias("n_bytes"),
        F.sum(F.size(ids)).cast("bigint").alias("n_tokens"),
    )
    return sums.withColumn(
        "ratio",
        F.when(F.col("n_tokens") > 0, F.col("n_bytes") / F.col("n_tokens")).otherwise(F.lit(0.0)),
    )
