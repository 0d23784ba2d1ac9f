"""What the operators of this package share: tables, size-checked broadcasts, byte words."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table that may be broadcast; larger tables are joined by shuffle.
BROADCAST_ROWS = 500_000
#: Array elements of such a table, in all its rows.
BROADCAST_VALUES = 3_000_000
#: Bytes of text that one vectorised step works on.
STEP_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS, values: str | None = None) -> DataFrame:
    """``df`` marked for broadcast when it is counted to have at most ``rows`` rows.

    Only for written, slim tables: the count reads them. ``values`` names an array
    column, whose elements are counted too (BROADCAST_VALUES). Above a bound no
    hint is given and Spark joins by shuffle.
    """
    total = F.coalesce(F.sum(F.size(values)), F.lit(0)) if values else F.lit(0)
    n, held = df.agg(F.count("*"), total).first()
    return F.broadcast(df) if n <= rows and held <= BROADCAST_VALUES else df


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id's text is a multiple of 5; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


# -- words of UTF-8 bytes, hashed for whole batches --------------------------------

#: Space, tab, line feed, vertical tab, form feed, carriage return end a word.
WHITE = frozenset({0x20, *range(0x09, 0x0E)})


def not_white() -> np.ndarray:
    """Byte table of words ``[^\\x20\\x09-\\x0D]+``."""
    return np.array([b not in WHITE for b in range(256)])


def alnum_or_high() -> np.ndarray:
    """Byte table of words of digits, small letters and non-ASCII, after lower-casing A-Z."""
    return np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    values = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
    return values[_LOWER] if lower else values  # lower: A-Z count as small letters


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its row limits in them; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    limits = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    if len(limits) == 0:
        return whole[:0], np.zeros(1, np.int64)
    return whole[limits[0] : limits[-1]], limits - limits[0]


def steps(limits: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes (STEP_BYTES); a longer row is a range of its own."""
    row, n, size = 0, len(limits) - 1, size or STEP_BYTES
    while row < n:
        end = int(np.searchsorted(limits, limits[row] + size, "right")) - 1
        end = min(n, max(row + 1, end))
        yield row, end
        row = end


class Rolling:
    """Polynomial hashes of any stretches of a byte buffer; equal stretches hash alike."""

    def __init__(self, data: np.ndarray, lower: bool = False) -> None:
        self._room = 1 << max(21, len(data).bit_length())
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_byte_values(lower)[data] * _powers(_BASE, self._room)[: len(data)], out=self._sums[1:])

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * _powers(_INVERSE, self._room)[starts]

    def windows(self, size: int) -> np.ndarray:
        """The hashes of all stretches of ``size`` bytes."""
        n = max(0, len(self._sums) - size)
        return (self._sums[size : size + n] - self._sums[:n]) * _powers(_INVERSE, self._room)[:n]


def _hash_run(data: np.ndarray, limits: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(data)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = word[data]
    edge = np.zeros(n + 1, bool)
    edge[limits[limits <= n]] = True
    before = np.empty(n, bool)
    before[0], before[1:] = True, ~inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    rolling = Rolling(data, lower=True)
    hashes = rolling.between(starts, ends)
    return starts, mix(hashes + (ends - starts).astype(np.uint64))


def hashed_words(
    column: pa.Array, word: np.ndarray
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For row ranges of a text column: first row, end row, word limits per row, word hashes.

    Hashes are 64 bits of the word with A-Z lowered; equal words have equal
    hashes everywhere. A text over STEP_BYTES is hashed in parts cut between words.
    """
    data, limits = text_buffer(column)
    for lo, hi in steps(limits):
        begin, end = int(limits[lo]), int(limits[hi])
        if end - begin <= 2 * STEP_BYTES:
            own = limits[lo : hi + 1] - begin
            starts, hashes = _hash_run(data[begin:end], own, word)
            yield lo, hi, np.searchsorted(starts, own), hashes
            continue
        parts, at = [], begin
        while at < end:
            to = min(end, at + STEP_BYTES)
            while to < end and word[data[to]] and word[data[to - 1]]:
                to += 1
            parts.append(_hash_run(data[at:to], np.array([0, to - at]), word)[1])
            at = to
        hashes = np.concatenate(parts)
        yield lo, hi, np.array([0, len(hashes)]), hashes


# -- filters of keys ----------------------------------------------------------------

#: 64-bit words of a key filter at most (32 MB). Beyond, more keys pass it that are not held; none is lost.
FILTER_WORDS = 1 << 22


def key_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter of a column of 64-bit hashes, sized by their count and built by partial sums.

    ``may_hold`` is true for every key and for few others: a false hit costs work, never a result.
    """
    wanted = max(1, keys.count() // 8)  # 8 to 16 bits a key
    bits = min(max(10, wanted.bit_length()), FILTER_WORDS.bit_length() - 1)
    key = F.col(column)
    one = F.lit(1).cast("bigint")
    marks = [F.call_function("shiftleft", one, F.shiftright(key, 6 * k).bitwiseAND(63).cast("int")) for k in range(3)]
    slots = keys.select(F.shiftrightunsigned(key, 64 - bits).alias("at"), marks[0].bitwiseOR(marks[1]).bitwiseOR(marks[2]).alias("marks"))
    found = slots.groupBy("at").agg(F.bit_or("marks").alias("marks")).toArrow()
    out = np.zeros(1 << bits, np.uint64)
    out[found["at"].to_numpy()] = found["marks"].to_numpy().view(np.uint64)
    return out


def may_hold(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For 64-bit keys whether a filter may hold them."""
    one, bits = np.uint64(1), np.uint64(len(held).bit_length() - 1)
    marks = np.zeros(len(keys), np.uint64)
    for k in range(3):
        marks |= one << ((keys >> np.uint64(6 * k)) & np.uint64(63))
    return (held[(keys >> (np.uint64(64) - bits)).astype(np.int64)] & marks) == marks
